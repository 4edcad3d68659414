"""Blank/null normalisation (a CSV cell cannot tell null from empty)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column | str) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x == "", F.lit(None).cast("string")).otherwise(x)
