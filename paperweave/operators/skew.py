"""Equi-joins that stay balanced when one key holds a large share of the rows.

A key is *hot* when it has at least ``min_rows`` rows on the big side. Hot keys are found with an
exact, map-side combined count; there are at most ``rows / min_rows`` of them, which bounds
their broadcast. The join is salted: a row with a hot key takes one of ``rows of the key / min_rows`` salts
by a hash of its other columns, the key's one lookup row is repeated once per salt, and the two sides
meet on (key, salt). Each side is read once, and no task gets more than about ``min_rows`` rows
of one key. In a left join, rows without a key take any salt: they match nothing, and are spread
over all tasks instead of meeting in one. Results are the same as a plain join: no row is dropped, capped or sampled.

Spark's AQE skew handling is kept on as well, but it judges skew from
compressed shuffle bytes, and a hot key's rows (often one repeated value)
compress well, so it can miss exactly the partitions that matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

HOT_KEY_ROWS_CONF = "spark.paperweave.hotKeyRows"
DEFAULT_HOT_KEY_ROWS = 1_000_000
NULL_SALTS = 1 << 16


def hot_key_rows(spark: SparkSession, min_rows: int | None = None) -> int:
    """Threshold for a hot key: argument, then session setting, then default."""
    if min_rows is not None:
        return int(min_rows)
    return int(spark.conf.get(HOT_KEY_ROWS_CONF, str(DEFAULT_HOT_KEY_ROWS)))


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame | None:
    """Staged frame ``(key, rows)`` of the keys with at least ``min_rows`` rows, or None.

    At most ``rows(df) / min_rows`` keys can qualify.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return stage_nonempty(counts.filter(F.col("rows") >= min_rows), "hot_keys")


def stage_nonempty(df: DataFrame, name: str) -> DataFrame | None:
    """Stage ``df``; None when it has no rows (counted while writing, no second job)."""
    obs = Observation(name)
    staged = stage(df.observe(obs, F.count(F.lit(1)).alias("n")), name)
    return staged if (obs.get.get("n") or 0) > 0 else None


def skew_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    *,
    hot: DataFrame | None | str = "auto",
    min_rows: int | None = None,
    total_rows: int | None = None,
) -> DataFrame:
    """``left.join(right, left[left_key] == right[right_key], how)``, split on hot keys.

    ``right`` must hold at most one row per key (a lookup table), and ``how``
    is ``inner`` or ``left``. ``hot`` is a frame of hot keys (column
    ``left_key``, and ``rows``: how many rows the key has), None for "none", or ``"auto"``: count
    them, unless ``total_rows`` shows the left side is too small to hold a hot key at all.
    Column names of the two sides must not collide.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    threshold = hot_key_rows(left.sparkSession, min_rows)
    if isinstance(hot, str):
        small = total_rows is not None and total_rows < threshold
        hot = None if small else hot_keys(left, left_key, threshold)
    if hot is None and how == "inner":
        return left.join(right, left[left_key] == right[right_key], how)

    salt = F.when(F.col(left_key).isNull(), F.pmod(_row_hash(left, left_key), F.lit(NULL_SALTS)))
    if hot is None:
        salted = left.withColumn("__salt", salt.otherwise(F.lit(0)).cast("int"))
        # always 0, but no constant: the optimizer would take that out of the join's keys
        lookup = right.withColumn("__part", F.pmod(F.hash(right_key), F.lit(1)))
    else:
        salts = F.ceil(F.col("rows") / F.lit(threshold)).cast("int")
        marks = F.broadcast(hot.select(F.col(left_key).alias("__hk"), F.greatest(salts, F.lit(1)).alias("__salts")))
        spread = F.pmod(_row_hash(left, left_key), F.col("__salts"))
        salted = left.join(marks, left[left_key] == marks["__hk"], "left").withColumn(
            "__salt", salt.when(F.col("__salts").isNotNull(), spread).otherwise(F.lit(0)).cast("int")).drop("__hk", "__salts")
        lookup = right.join(marks, right[right_key] == marks["__hk"], "left").withColumn(
            "__part", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__hk", "__salts")
    met = salted.join(lookup, (salted[left_key] == lookup[right_key]) & (salted["__salt"] == lookup["__part"]), how)
    return met.drop("__salt", "__part")


def _row_hash(df: DataFrame, key: str) -> Column:
    """A hash of the row's plain columns besides the key; its place in the scan where there is none."""
    plain = [f.name for f in df.schema.fields
             if f.name != key and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*plain) if plain else F.monotonically_increasing_id()
