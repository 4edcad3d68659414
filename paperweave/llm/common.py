"""Helpers shared by the operators: tables, the word rule, salted joins."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import hot_key_rows
from ..session import stage

# fixed values: the word rule of the operators
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
ROW = "__row number of the table"  # a name that no table has
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROW_BITS = 40  # rows of a file


def numbered(docs: DataFrame, row: str = ROW) -> DataFrame:
    """``docs`` with a number per row, on which decisions are joined back. The number is the row's file (of the scan's
    files in order) and place in it, which every scan of the same files repeats; so nothing is written. What
    is not a plain scan of Parquet files is written with its numbers first."""
    try:
        files = docs.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        return stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    paths = sorted(r[0] for r in files.select("path").distinct().collect())  # one per file of the scan
    path, number, at, index = (f"{row}: {x}" for x in ("path", "file", "at", "index"))
    order = docs.sparkSession.createDataFrame([(p, i) for i, p in enumerate(paths)], f"`{path}` string, `{number}` long")
    placed = docs.select(*docs.columns, F.col("_metadata.file_path").alias(at), F.col("_metadata.row_index").alias(index))
    known = placed.join(F.broadcast(order), placed[at] == order[path], "left")
    lost = F.col(number).isNull() | (F.col(index) >= (1 << ROW_BITS))
    value = F.when(lost, F.raise_error(F.lit("a row without a place")).cast("bigint")).otherwise(F.shiftleft(number, ROW_BITS) + F.col(index))
    return known.withColumn(row, value).select(*docs.columns, row)


def workers_import(df: DataFrame) -> DataFrame:
    """``df``, once Python workers also look for this package where the driver found it
    (a checkout that is not installed; with an installed package or --py-files it changes nothing)."""
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return df


def bound(value: Column, use) -> Column:
    """``use(x)`` with ``x`` evaluated once per row (a lambda variable, so the
    optimizer cannot copy the expression into every place that reads it)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """Words of a text (maximal runs without the six white-space characters); null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def without_space(text: Column) -> Column:
    """The text with every white-space character deleted; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def salted_join(left: DataFrame, right: DataFrame, key: str, count: str, spread: Column, how: str = "left") -> DataFrame:
    """Join ``left`` with ``right`` (unique ``key``) so that no key meets in one task.

    ``right[count]`` is the number of ``left`` rows of the key. Keys with more than the
    session's hot-key threshold are split into ``ceil(count / threshold)`` salts: their
    right rows are repeated once per salt and left rows choose a salt by ``spread`` (any
    hash of the row). The left side is read once. What is broadcast is the list of hot
    keys, at most rows / threshold entries. ``right[count]`` is dropped.
    """
    limit = hot_key_rows(left.sparkSession)
    sized = right.withColumn("__salts", F.ceil(F.col(count) / F.lit(limit)).cast("int"))
    hot = F.broadcast(sized.filter(F.col(count) > limit).select(key, F.col("__salts").alias("__n")))
    salted_left = left.join(hot, key, "left").withColumn(
        "__salt", F.when(F.col("__n").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col("__n")).cast("int"))
    ).drop("__n")
    salted_right = sized.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.greatest(F.col("__salts"), F.lit(1)) - 1))
    ).drop("__salts", count)
    return salted_left.join(salted_right, [key, "__salt"], how).drop("__salt")
