"""Mixing sources to target weights by entropy balancing.

Targets: the sources share 100 % of all words by weight; a target stops at ``cap`` times its
source's size and the excess is shared again by weight until no target is above (water-filling,
solved in closed form over the source table).

Rates: among all document rates r the mix takes those closest, in relative entropy weighted by
words, to taking everything once, subject to the token constraint of every source. The convex
dual has one multiplier per constraint and its solution tilts documents exponentially,
r = exp(lambda' x). Only token constraints per source are taken. The Hessian is then diagonal, and the
solution has the closed form rate = target / source size; it replaces distributed iterations. Newton's
steps run as a scalar recurrence per row of the source table; no tilted words are summed over documents.

Copies: rates are rounded to whole copies that keep every source's words: within a source the
documents are ranked by size, document i takes floor((i+1) r) - floor(i r) copies, which spreads
the extra copies evenly over the sizes and errs by at most one document. A few correction
passes then add or take one copy of the document whose size comes closest to what a source is
still off. No document takes more than ``cap`` copies.

Defined results
* null text counts as empty: size 0, nothing taken.
* null source: a source of its own, last in order. A source without words has target 0.
* repeated rows and ties: documents of equal size are ranked by identifier (null first), then by
  a number that the scan gives every row; each row is rounded for itself.
* an empty table gives an empty result; extra columns are ignored.
* nothing is random: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import dense_id
from ..session import stage
from .common import ROW, numbered, words

WEIGHTS = (1, 2, 3)
CAP = 3
NEWTON_STEPS = 40
CORRECTIONS = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with weight and target. One row per source."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sizes.withColumn(
        "weight", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    # sources in the order in which they reach their cap as the common level rises
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    level = weighted.withColumn(
        "before", F.coalesce(F.sum("source_size").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap
    ).withColumn(
        "open_weight", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing))
    ).withColumn("total", F.sum("source_size").over(everything)).withColumn(
        # words per unit of weight for this source and those after it, were all before it full
        "level", (F.col("total") - F.col("before")) / F.col("open_weight")
    )
    # the first source that stays under its cap fixes the level; all before it are full
    fits = F.col("level") * F.col("weight") <= cap * F.col("source_size")
    settled = level.withColumn("common", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.coalesce(F.col("common"), F.lit(float("inf"))) * F.col("weight"), F.lit(float(cap)) * F.col("source_size"))
    return settled.select("source", "source_size", "weight", target.cast("double").alias("target"))


def dual_multipliers(targets: DataFrame, steps: int = NEWTON_STEPS) -> DataFrame:
    """``targets`` with ``rate`` = exp(lambda): Newton on the dual  sum size exp(lambda) - target lambda.

    The step is (target - tilted) / tilted, where tilted = source_size exp(lambda) is both the
    gradient's model term and the diagonal Hessian; damped to one so that it never overshoots far.
    """
    ratio = F.col("target") / F.col("source_size")
    lam = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0),
        lambda x, _: x + F.least(ratio / F.exp(x) - 1, F.lit(1.0)),
    )
    return targets.withColumn("rate", F.when((F.col("source_size") > 0) & (F.col("target") > 0), F.exp(lam)).otherwise(0.0))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, key: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    return _mixed(docs, F.monotonically_increasing_id(), weights, cap, key, text, source).drop("row")


def _mixed(docs: DataFrame, row: Column, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, key: str = "doc_id", text: str = "text",
           source: str = "source") -> DataFrame:
    counted = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("bigint").alias("size"),
                          row.alias("row"))
    sized = stage(counted, "mix_sizes")
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), "mix_sources")
    plan = stage(dual_multipliers(source_targets(sources.drop("docs"), weights, cap)), "mix_plan")

    # rank within the source = global rank less the source's first rank; the range partitioner
    # splits a hot source by size and identifier, so no task holds a whole source
    ranked = dense_id(sized, [F.col("source"), "size", "doc_id", "row"], "rank", name="mix_rank")
    first = ranked.groupBy("source").agg(F.min("rank").alias("first"))
    plan = stage(plan.join(first, plan["source"].eqNullSafe(first["source"])).drop(first["source"]), "mix_plan")
    near = _with_source(ranked, plan)
    i = F.col("rank") - F.col("first")
    near = near.withColumn("copies", (F.floor((i + 1) * F.col("rate") + 0.5) - F.floor(i * F.col("rate") + 0.5)).cast("bigint"))
    near = near.withColumn("copies", F.least(F.when(F.col("size") > 0, F.col("copies")).otherwise(0), F.lit(cap).cast("bigint")))
    rounded = stage(near.drop("first"), "mix_rounded")
    for _ in range(CORRECTIONS):
        rounded = stage(_corrected(rounded, cap), "mix_corrected")
    return rounded.select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), "rank", "row",
    )


def _with_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with their source's columns; sources are far fewer than rows, and the broadcast is counted first."""
    t = table.withColumnRenamed("source", "__s")
    if t.count() <= 100_000:
        t = F.broadcast(t)
    return rows.join(t, rows["source"].eqNullSafe(t["__s"])).drop("__s")


def _corrected(rounded: DataFrame, cap: int) -> DataFrame:
    """One copy more or less of the document per source that brings its words closest to the target."""
    off = rounded.groupBy("source").agg(F.first("target").alias("goal"), F.sum(F.col("copies") * F.col("size")).alias("words")).select(
        "source", (F.col("goal") - F.col("words")).alias("off")
    )
    rows = _with_source(rounded, stage(off, "mix_off"))
    sign = F.when(F.col("off") > 0, 1).otherwise(-1)
    able = (F.col("size") > 0) & F.when(F.col("off") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0)
    left = F.abs(F.col("off") - sign * F.col("size"))
    best = rows.filter(able & (left < F.abs("off"))).groupBy("source").agg(F.min(F.struct(left.alias("left"), F.col("rank"))).alias("b"), F.first(sign).alias("sign"))
    change = best.select(F.col("b.rank").alias("rank"), F.col("sign"))
    if change.count() <= 100_000:  # one row per source at most
        change = F.broadcast(change)
    return rounded.join(change, "rank", "left").withColumn(
        "copies", F.col("copies") + F.coalesce(F.col("sign"), F.lit(0))
    ).select(rounded.columns)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they came."""
    rows = numbered(docs)
    copies = "__copies of the row"
    taken = _mixed(rows, F.col(ROW), **options).filter("copies > 0").select(F.col("row").alias(ROW), F.col("copies").cast("int").alias(copies))
    return rows.join(taken, ROW).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies)).select(docs.columns)
