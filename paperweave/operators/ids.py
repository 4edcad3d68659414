"""Contiguous id assignment and id lookups.

``dense_id`` gives every row its 0-based position in a global sort order
without funnelling rows through one task (an unpartitioned ``row_number``
window would). Rows are range-partitioned and sorted on the key; within a
partition ``monotonically_increasing_id`` counts rows in key order, and the
partition index sits in its upper bits. The (key, local id) pairs are staged
to shared storage so the numbering is frozen; the row count of every
partition (one number per partition, like ``RDD.zipWithIndex`` gathers) turns
into an offsets array literal, and ``offsets[partition] + local position`` is
the global rank: no join, no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spent_shuffles, stage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1

# Row counts up to which an exact side table is broadcast instead of shuffled.
BROADCAST_ROWS = 2_000_000


def _cols(cols: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dense_id(
    df: DataFrame,
    order_by: str | Column | Sequence[str | Column],
    out: str,
    *,
    num_partitions: int | None = None,
    name: str = "dense_id",
) -> DataFrame:
    """Add ``out`` = 0..N-1 following ascending ``order_by`` (keys must be unique).

    All columns of ``df`` travel with the sort, so callers that need the id
    next to wide rows pay one range shuffle instead of a sort plus a join.
    The result is backed by staged Parquet, ordered by ``out``.
    """
    keys = _cols(order_by)
    # without an explicit count AQE may merge neighbouring range partitions
    # (keeping their order) to its advisory size
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    sorted_df = (
        ranged
        .sortWithinPartitions(*keys)
        .withColumn("__mid", F.monotonically_increasing_id())
    )
    frozen = stage(sorted_df, name + "_sorted")
    pid = F.shiftright(F.col("__mid"), _LOCAL_BITS)
    offsets = partition_offsets(frozen.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n")))
    return frozen.withColumn(
        out, (F.element_at(offsets_literal(offsets), (pid + 1).cast("int")) + F.col("__mid").bitwiseAND(F.lit(_LOCAL_MASK)))
        .cast("bigint"),
    ).drop("__mid")


def partition_offsets(sizes: DataFrame) -> list[int]:
    """Exclusive running totals of ``__n`` by ``__pid`` (0..max pid; missing = 0).

    ``sizes`` has one row per partition, so this is a list as long as the
    partition count, gathered the way ``RDD.zipWithIndex`` gathers its
    partition sizes; no data rows pass through the driver.
    """
    per = {int(r["__pid"]): int(r["__n"]) for r in sizes.collect()}
    offsets, total = [], 0
    for p in range(max(per, default=-1) + 1):
        offsets.append(total)
        total += per.get(p, 0)
    return offsets or [0]


def offsets_literal(offsets: list[int]) -> Column:
    """The offsets as one string literal, split and folded once: a list literal has a plan node per partition."""
    return F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")


def dedupe_latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep one row per ``key``: the one with the greatest ``order`` (unique per row).

    Duplicates are found with a narrow, map-side combined aggregate, so a key
    repeated millions of times costs no more than any other. When there are
    none (the normal case) the input is returned untouched; otherwise the
    losing (key, order) pairs are removed with an anti-join, broadcast only
    when their counted number is small.
    """
    keys = df.select(key, order)
    per_key = keys.groupBy(key).agg(F.count(F.lit(1)).alias("__c"), F.max(order).alias("__keep"))
    dups = per_key.filter(F.col("__c") > 1)
    with spent_shuffles(df.sparkSession):
        extra = dups.agg(F.sum(F.col("__c") - 1)).first()[0] or 0
    if extra == 0:
        return df
    # a key repeated very often is hot in this join; its count is already known
    from .skew import hot_key_rows, skew_join, stage_nonempty

    threshold = hot_key_rows(df.sparkSession)
    hot = stage_nonempty(dups.filter(F.col("__c") >= threshold).select(key, F.col("__c").alias("rows")), "hot_keys")
    losers = (
        skew_join(keys, dups.select(F.col(key).alias("__dk"), "__keep"), key, "__dk", "inner", hot=hot)
        .filter(F.col(order) != F.col("__keep"))
        .select(key, order)
    )
    losers = stage(losers, "losers")  # read by everything that is derived from the result
    if extra <= BROADCAST_ROWS:
        losers = F.broadcast(losers)
    return df.join(losers, [key, order], "left_anti")


def lookup_ids(
    df: DataFrame,
    index: DataFrame,
    ext_col: str,
    *,
    index_ext: str = "oa_id",
    index_id: str = "paper_id",
    out: str = "paper_id",
    keep_missing: bool = False,
    min_rows: int | None = None,
    total_rows: int | None = None,
) -> DataFrame:
    """Map external ids in ``ext_col`` to internal ids through any ``index`` table.

    Inner join by default (unknown ids drop out); ``keep_missing=True`` keeps
    them with id -1. An id that many rows ask for is salted (``operators.skew``). An index whose ids are
    ranks is better looked up in its ``PaperIndex``, without a join of the index.
    """
    from .skew import skew_join

    idx = index.select(F.col(index_ext).alias("__ext"), F.col(index_id).alias("__id"))
    joined = skew_join(df, idx, ext_col, "__ext", "left" if keep_missing else "inner", min_rows=min_rows, total_rows=total_rows)
    return joined.withColumn(out, F.coalesce(F.col("__id"), F.lit(-1).cast("bigint"))).drop("__ext", "__id")


class PaperIndex:
    """External id -> paper_id, the position of the external id in ascending order.

    ``table`` is the index as rows ``(oa_id, paper_id)``. ``attach`` maps a column through it. Where the ids
    are dense enough (``MOST_BYTES`` a member), the index is a rank bitmap: membership and position
    come from one small row per 32,768 ids, so mapping a table (the works themselves, or every
    reference of every work) neither sorts nor shuffles it while the bitmap can be broadcast, and
    shuffles it once, salted, beyond that. Sparse ids are numbered by a range sort and joined.
    """

    MOST_BYTES = 64

    def __init__(self, keys: DataFrame, key: str = "oa_id", out: str = "paper_id", *, num_partitions: int | None = None):
        from .rank import ROW_BITS, ROW_BYTES, rank_bitmap

        self.key, self.out = key, out
        spread = keys.groupBy(F.shiftright(key, ROW_BITS).alias("b")).agg(F.count(F.lit(1)).alias("rows")).agg(
            F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
        self.bitmap = None
        if spread["blocks"] * ROW_BYTES <= max(self.MOST_BYTES * spread["rows"], 1 << 20):
            self.bitmap = rank_bitmap(keys, key, name="paper_index")
            self.n = self.bitmap.n
            self.table = stage(self.bitmap.members(key, out), "paper_index_rows")
        else:
            self.table = dense_id(keys.select(key), key, out, num_partitions=num_partitions, name="paper_index")
            self.n = int(spread["rows"])

    @property
    def shuffles(self) -> bool:
        """Whether ``attach`` has to shuffle the table that it maps."""
        from .rank import broadcastable

        return self.bitmap is None or not broadcastable(self.bitmap, self.table.sparkSession)

    def attach(self, df: DataFrame, col: str, out: str, *, missing: int | None = None, total_rows: int | None = None,
               min_rows: int | None = None) -> DataFrame:
        """``df`` with the id of ``col`` as ``out``; unknown ids drop out, or get ``missing``."""
        from .rank import rank_lookup
        from .skew import skew_join

        if self.bitmap is not None:
            return rank_lookup(df, self.bitmap, col, out, missing=missing, total_rows=total_rows, min_rows=min_rows)
        idx = self.table.select(F.col(self.key).alias("__ext"), F.col(self.out).alias("__id"))
        met = skew_join(df, idx, col, "__ext", "inner" if missing is None else "left", total_rows=total_rows, min_rows=min_rows)
        value = F.col("__id") if missing is None else F.coalesce("__id", F.lit(missing).cast("bigint"))
        return met.select(*[c for c in df.columns if c != out], value.alias(out))
