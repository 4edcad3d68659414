"""Columns that are computed once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as the new column ``name``, computed once a row.

    A plain column is copied by the optimizer into every filter and expression that reads it, and the
    generated method soon is too large to be compiled to machine code. A generated row is a value to all that follows.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
