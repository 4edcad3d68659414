"""Rank bitmap over integer ids: membership and dense renumbering without a sort or a row-by-row join.

A set of ids 0..max is kept as one row per 32,768 ids: 512 words of 64 bits, the number of set
bits before each word, and the number of ids before the row. Whether an id belongs to the set is a bit; its position
among the set's ids in ascending order is ``offset + ranks[word] + popcount(bits below)``. Filtering
and renumbering a table is then one lookup of a small row by ``id >> 15``, with built-in bit functions only.
(The words are bigints made with ``bit_or``: a hash aggregate, and a word can be read in place, which
the binary of ``bitmap_construct_agg`` does not allow.)

Size: 12 bytes for 64 ids of the range, whatever the number of members (47 MB for 250 million).
The rows are broadcast when their counted bytes allow it; beyond that the table meets them
in a join on the row number, where frequent rows are salted (``operators.skew``).

Duplicate ids count once, so no ``distinct`` is needed before a build. Null ids belong to no set.
Negative ids fail the build, and belong to no set in a lookup.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rows import with_computed
from ..session import stage
from .skew import skew_join

WORD_BITS = 6  # ids of a word: 64
ROW_BITS = 15  # ids of a row: 32,768
WORDS = 1 << (ROW_BITS - WORD_BITS)
ROW_BYTES = WORDS * 12 + 64

BROADCAST_BYTES_CONF = "spark.paperweave.bitmapBroadcastBytes"
DEFAULT_BROADCAST_BYTES = 96 << 20


@dataclass(frozen=True)
class RankBitmap:
    """``table`` (block, offset, words, ranks), one row per 32,768 ids that has members; ``n`` members."""

    table: DataFrame
    n: int
    blocks: int

    @property
    def bytes(self) -> int:
        return self.blocks * ROW_BYTES

    def members(self, old: str = "old_id", new: str = "new_id") -> DataFrame:
        """The set as a table ``(old, new)``: every member with its position."""
        bits = self.table.select("block", "offset", F.posexplode(F.arrays_zip("words", "ranks")).alias("w", "e"))
        ones = bits.select(
            ((F.col("block") * WORDS + F.col("w")) * 64).alias("__base"), (F.col("offset") + F.col("e.ranks")).alias("__before"),
            F.col("e.words").alias("__word")).filter(F.col("__word") != 0)
        places = ones.select("__base", "__before", "__word", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("__bit"))
        hit = places.filter(F.getbit("__word", "__bit") == 1)
        return hit.select(
            (F.col("__base") + F.col("__bit")).cast("bigint").alias(old),
            (F.col("__before") + _below(F.col("__word"), F.col("__bit"))).cast("bigint").alias(new))


def _below(word: Column, bit: Column) -> Column:
    """Set bits of ``word`` below place ``bit``."""
    return F.bit_count(word.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), bit.cast("int")))))


def rank_bitmap(ids: DataFrame, col: str, *, name: str = "rank") -> RankBitmap:
    """The rank bitmap of the distinct values of ``ids[col]`` (non-negative integers), staged."""
    value = F.col(col).cast("bigint")
    checked = F.when(value < 0, F.raise_error(F.lit("a rank bitmap takes no negative ids")).cast("bigint")).otherwise(value)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__id").bitwiseAND(F.lit(63)).cast("int"))
    words = (
        ids.filter(value.isNotNull()).select(checked.alias("__id"))
        .groupBy(F.shiftright("__id", WORD_BITS).alias("word")).agg(F.bit_or(one).alias("bits"))
    )
    words = stage(words.withColumn("block", F.shiftright("word", ROW_BITS - WORD_BITS)), f"{name}_words")
    # words without members are listed too, so that a word's place in its row is its number
    empty = words.select("block").distinct().select(
        F.explode(F.sequence(F.col("block") * WORDS, F.col("block") * WORDS + (WORDS - 1))).alias("word"),
        F.lit(0).cast("bigint").alias("bits"), "block")
    every = words.select("word", "bits", "block").unionByName(empty).groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    in_row = Window.partitionBy("block").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)  # 512 rows
    ranked = every.withColumn("before", F.coalesce(F.sum(F.bit_count("bits")).over(in_row), F.lit(0)).cast("int"))
    packed = ranked.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits", "before"))).alias("row"), F.sum(F.bit_count("bits")).cast("bigint").alias("members"))
    rows = stage(packed.select("block", "members", F.col("row.bits").alias("words"), F.col("row.before").alias("ranks")), f"{name}_rows")
    total = rows.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("members"), F.lit(0)).alias("n")).first()
    from .graph import running_total

    offsets = running_total(rows.select("block", "members"), "block", "members", "offset").select("block", "offset")
    table = stage(rows.join(offsets, "block").select("block", "offset", "words", "ranks"), name)
    return RankBitmap(table, int(total["n"]), int(total["blocks"]))


def _rank(id_: Column) -> tuple[Column, Column]:
    """(is a member, position) of an id against the row joined to it."""
    place = id_.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    at = (F.shiftright(place, WORD_BITS) + 1).cast("int")
    word = F.element_at("__words", at)
    bit = place.bitwiseAND(F.lit(63)).cast("int")
    member = F.getbit(word, bit) == 1
    return member, (F.col("__offset") + F.element_at("__ranks", at) + _below(word, bit)).cast("bigint")


def broadcastable(bitmap: RankBitmap, spark: SparkSession) -> bool:
    """Whether the bitmap's counted bytes are within the session's limit."""
    return bitmap.bytes <= int(spark.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))


def rank_lookup(df: DataFrame, bitmap: RankBitmap, col: str, out: str | None = None, *, missing: int | None = None,
                total_rows: int | None = None, min_rows: int | None = None) -> DataFrame:
    """``df`` with the position of ``col`` in ``bitmap`` as ``out`` (default: in place of ``col``).

    Rows whose id is no member are dropped, or get ``missing``. The bitmap is broadcast up to the
    session's byte limit; beyond it, ``df`` meets it in one join on the row number.
    """
    out = out or col
    id_ = F.col(col).cast("bigint")
    how = "inner" if missing is None else "left"
    keyed = df.withColumn("__block", F.shiftright(id_, ROW_BITS))
    rows = bitmap.table.select(
        F.col("block").alias("__b"), F.col("offset").alias("__offset"), F.col("words").alias("__words"), F.col("ranks").alias("__ranks"))
    if broadcastable(bitmap, df.sparkSession):
        met = keyed.join(F.broadcast(rows), keyed["__block"] == rows["__b"], how)
    else:
        met = skew_join(keyed, rows, "__block", "__b", how, total_rows=total_rows, min_rows=min_rows)
    member, position = _rank(id_)
    found = F.when(member, position)
    if missing is not None:
        found = F.coalesce(found, F.lit(missing).cast("bigint"))
    met = with_computed(met, "__position", found)
    if missing is None:
        met = met.filter(F.col("__position").isNotNull())
    value = F.col("__position")
    columns = [c for c in df.columns if c != out]
    if out in df.columns:
        return met.select(*[value.alias(c) if c == out else F.col(c) for c in df.columns])
    return met.select(*columns, value.alias(out))
