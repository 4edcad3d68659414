"""Quality rules: base counts per document, then robust multivariate outliers.

Base rule: a document fails with fewer than 10 words, or when more than 20 % of its words
lie in 5-word windows that occur twice or more in the text. The rest is judged by the
minimum-covariance-determinant estimate (MCD) of its language and source: the statistics
are transformed to a vector, and a document is rejected when its robust Mahalanobis
distance passes a chi-square cutoff.

MCD as DataFrame jobs over the narrow vectors (the texts are read once):
* start from median and MAD per group, then concentration steps: distance of every row to
  its group's estimate, the ``h`` nearest rows give the next mean and covariance, until the
  determinant of no group falls any more. ``h`` is half of the group, so junk in bulk (up to
  half of a group) stays outside the estimate; a bin counts only up to ``h``. One step is
  one aggregation by (group, distance bin) - counts, sums and sums of products, combined
  before the shuffle, so a group with a third of all rows costs no more than another - and a
  running count over a group's bins to find the bin that reaches ``h`` rows.
* vectors are integers (thousandths) and sums are exact, so reruns agree to the bit.
* covariances are factored (Cholesky) with column arithmetic on the group table, distances by
  forward substitution: no matrix code outside the plan.

Defined results
* null or empty text: no words, base_failed, not kept.
* null language or source: a group of its own, apart from the text 'null'.
* groups with fewer than ``min_rows`` rows that pass the base rule are pooled by language,
  then all together; a pool that is still too small judges nobody (its rows are kept).
* a constant statistic (covariance 0) is carried by the variance floors, so ties and repeated
  rows never make the estimate singular.
* repeated rows are judged one by one and alike; extra columns stay untouched in the pipeline.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import ROW, SPACE, bound, numbered, without_space, words

# fixed values: the base rule
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Mcd:
    """``keep``: share of a group in the concentrated half-sample; ``gain``: a step that lowers the
    logarithm of a group's determinant by less is its last; ``tail``: chi-square tail of the cutoff;
    ``min_rows``: rows a group needs for its own estimate; ``broadcast_groups``: group tables up to
    this many rows are broadcast (about 300 bytes a row)."""

    keep: float = 0.5
    gain: float = 1e-3
    tail: float = 1e-4
    min_rows: int = 60
    broadcast_groups: int = 100_000


# name, floor of the standard deviation (natural-log units). The cutoff is 5.5 floored deviations, so
# a statistic that is 0 in its group rejects alone from 11 % symbols or repeated words (the base rule
# takes over at 20 %) and from 35 % repeated lines.
FEATURES = (
    ("x_words", 1.0),
    ("x_word_length", 0.15),
    ("x_symbols", 0.45),
    ("x_dup_lines", 0.65),
    ("x_repeats", 0.45),
    ("x_upper", 0.4),
    ("x_marks", 0.3),
)
UNIT = 1000  # vector units: thousandths


def _repeated_words(w: Column) -> Column:
    """Words covered by windows that occur twice or more. Windows are compared by 64-bit hash
    within one text; sorting (hash, position) pairs keeps this O(n log n) for any length."""
    windows = F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)])
    )).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            # neighbours outside the array are null, and null is no match
            twin = F.filter(
                F.sequence(F.lit(0), F.size(p) - 1),
                lambda j: (F.get(p, j).getField("h") == F.get(p, j + 1).getField("h"))
                | (F.get(p, j).getField("h") == F.get(p, j - 1).getField("h")),
            )
            return F.sort_array(F.transform(twin, lambda j: F.get(p, j).getField("i")))

        def length(q: Column) -> Column:
            return F.aggregate(
                F.transform(q, lambda s, j: F.least(F.coalesce(F.get(q, j + 1) - s, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0).cast("bigint"), lambda a, b: a + b,
            )

        return bound(bound(pairs, starts), length)

    return bound(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the counts every rule needs (all bigint)."""
    t = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumn("__t", t).withColumn(
        "__w", bound(words(t), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _repeated_words(w).alias("r")))
    ).withColumn("__l", bound(
        F.filter(F.split(F.col("__t"), "\n"), lambda line: F.char_length(F.translate(line, SPACE, "")) > 0),
        lambda lines: F.struct(F.size(lines).cast("bigint").alias("n"),
                               (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("d")),
    ))
    size = F.char_length("__t")
    return counted.select(
        *[c for c in docs.columns if c != text],
        F.col("__w.n").alias("n_words"),
        F.char_length(without_space(F.col("__t"))).cast("bigint").alias("word_chars"),
        (size - _without(F.col("__t"), SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.col("__l.d").alias("n_dup_lines"),
        F.col("__w.r").alias("n_repeat_words"),
        F.col("__l.n").alias("n_lines"),
        (size - _without(F.col("__t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("bigint").alias("n_upper"),
        (size - _without(F.col("__t"), ".,;:!?")).cast("bigint").alias("n_marks"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vector() -> list[Column]:
    def share(part: str, whole: str) -> Column:
        return F.log1p(100.0 * F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    values = (
        F.log1p(F.col("n_words").cast("double")),
        F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        share("n_upper", "word_chars"),
        share("n_marks", "word_chars"),
    )
    return [F.round(v * UNIT).cast("bigint").alias(n) for v, (n, _) in zip(values, FEATURES)]


def _small(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast a group table when it is counted to be small; otherwise a plain (splittable) join."""
    return F.broadcast(df) if df.count() <= limit else df


def _grouped(rows: DataFrame, lang: str, source: str, cfg: Mcd) -> DataFrame:
    """``rows`` with ``grp``: own (language, source), the language's pool, or the rest's pool."""
    own = F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s")))
    by_lang = F.to_json(F.struct(F.col(lang).alias("l"), F.lit(1).alias("pool")))
    fit = F.count(F.when(~F.col("base_failed"), 1))
    sizes = stage(rows.groupBy(own.alias("__own"), by_lang.alias("__pool")).agg(fit.alias("n")), "group_sizes")
    pools = sizes.filter(F.col("n") < cfg.min_rows).groupBy("__pool").agg(F.sum("n").alias("pn"))
    named = sizes.join(pools, "__pool", "left").select(
        "__own",
        F.when(F.col("n") >= cfg.min_rows, F.col("__own")).when(F.col("pn") >= cfg.min_rows, F.col("__pool"))
        .otherwise(F.lit("rest")).alias("grp"),
    )
    return rows.withColumn("__own", own).join(_small(stage(named, "groups"), cfg.broadcast_groups), "__own").drop("__own")


def _factored(params: DataFrame) -> DataFrame:
    """Group means m_j and covariances c_j_k (thousandths) to means, Cholesky factor l_j_k and log_det."""
    p = len(FEATURES)
    out = params
    for k in range(p):  # column by column: l_k_k, then the entries below it
        def rest(j: int, k: int = k) -> str:
            floor = f" + {(FEATURES[k][1] * UNIT) ** 2!r}D" if j == k else ""
            return f"c_{j}_{k}{floor}" + "".join(f" - l_{j}_{i} * l_{k}_{i}" for i in range(k))

        out = out.selectExpr("*", f"sqrt(greatest({rest(k)}, 1D)) AS l_{k}_{k}")
        out = out.selectExpr("*", *[f"({rest(j)}) / l_{k}_{k} AS l_{j}_{k}" for j in range(k + 1, p)])
    log_det = "2 * (" + " + ".join(f"ln(l_{j}_{j})" for j in range(p)) + ") AS log_det"
    return out.selectExpr("grp", log_det, *[f"m_{j}" for j in range(p)], *[f"l_{j}_{k}" for j in range(p) for k in range(j + 1)])


def _with_distance(rows: DataFrame, factors: DataFrame, cfg: Mcd) -> DataFrame:
    """``rows`` with ``d2``, the squared Mahalanobis distance to their group's estimate."""
    keep = rows.columns
    out = rows.join(_small(factors, cfg.broadcast_groups), "grp")
    for j, (name, _) in enumerate(FEATURES):
        done = "".join(f" - l_{j}_{k} * z_{k}" for k in range(j))
        out = out.selectExpr("*", f"({name} - m_{j}{done}) / l_{j}_{j} AS z_{j}")
    return out.selectExpr(*keep, " + ".join(f"z_{j} * z_{j}" for j in range(len(FEATURES))) + " AS d2")


def _start(rows: DataFrame) -> DataFrame:
    """Median and MAD of every statistic per group, as a diagonal covariance. The exact median
    keeps one count per distinct value, and values are thousandths of a logarithm."""
    names = [n for n, _ in FEATURES]
    med = stage(rows.groupBy("grp").agg(*[F.median(n).alias(f"m_{j}") for j, n in enumerate(names)]), "medians")
    dev = rows.join(med, "grp").groupBy("grp").agg(
        *[F.median(F.abs(F.col(n) - F.col(f"m_{j}"))).alias(f"s_{j}") for j, n in enumerate(names)]
    )
    cov = [
        (F.pow(1.4826 * F.col(f"s_{j}"), F.lit(2)) if j == k else F.lit(0.0)).alias(f"c_{j}_{k}")
        for j in range(len(names)) for k in range(j + 1)
    ]
    return med.join(dev, "grp").select("grp", *[f"m_{j}" for j in range(len(names))], *cov)


def _concentrated(rows: DataFrame, cfg: Mcd) -> DataFrame:
    """Mean and covariance per group of its nearest rows, ``keep`` of the group. The bin in which that number
    is reached counts by the part that is still needed. Covariances are scaled to those of all rows."""
    names = [n for n, _ in FEATURES]
    p = len(names)
    pairs = [(j, k) for j in range(p) for k in range(j + 1)]
    moments = [F.expr("count(1) AS n")]
    moments += [F.expr(f"sum({n}) AS s_{j}") for j, n in enumerate(names)]
    moments += [F.expr(f"sum({names[j]} * {names[k]}) AS q_{j}_{k}") for j, k in pairs]
    cells = rows.groupBy("grp", F.expr("floor(log1p(d2) * 64) AS bin")).agg(*moments)
    near = cells.selectExpr(
        "*", "sum(n) OVER (PARTITION BY grp ORDER BY bin) - n AS before", "sum(n) OVER (PARTITION BY grp) AS total"
    ).withColumn("part", F.least((F.ceil(F.col("total") * cfg.keep) - F.col("before")) / F.col("n"), F.lit(1.0))).filter("part > 0")
    # whole bins add up as integers, and only one bin of a group is taken in part: no order of adding matters
    sums = near.groupBy("grp").agg(*[
        F.expr(f"CAST(coalesce(sum(if(part = 1, {c}, NULL)), 0) AS double) + coalesce(max(if(part < 1, {c} * part, NULL)), 0D) AS {c}")
        for c in cells.columns if c not in ("grp", "bin")
    ])
    scale = consistency(cfg)
    return sums.selectExpr(
        "grp",
        *[f"s_{j} / n AS m_{j}" for j in range(p)],
        *[f"{scale!r}D * (q_{j}_{k} / n - (s_{j} / n) * (s_{k} / n)) AS c_{j}_{k}" for j, k in pairs],
    )


def chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution function by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, h = p / 2.0, x / 2.0
    term = total = 1.0 / a
    i = 0
    while term > total * 1e-16:
        i += 1
        term *= h / (a + i)
        total += term
    return min(1.0, total * math.exp(-h + a * math.log(h) - math.lgamma(a)))


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < q else (low, mid)
    return high


def consistency(cfg: Mcd) -> float:
    """A group's half-sample underestimates its covariance by this factor under normality."""
    p = len(FEATURES)
    return cfg.keep / chi2_cdf(chi2_quantile(cfg.keep, p), p + 2)


def cutoff(cfg: Mcd) -> float:
    return chi2_quantile(1 - cfg.tail, len(FEATURES))


def _estimates(vectors: DataFrame, cfg: Mcd) -> DataFrame:
    """The groups' factors after concentration; only groups whose determinant still falls take another step."""

    def step(rows: DataFrame, factors: DataFrame) -> DataFrame:
        # written before log_det is compared: a filter pushed into the factoring would expand it without bound
        return stage(_factored(_concentrated(_with_distance(rows, factors, cfg), cfg)), "mcd_step")

    factors = step(vectors, stage(_factored(_start(vectors)), "mcd_start"))
    moving = vectors
    while True:
        better = step(moving, factors).join(factors.select("grp", F.col("log_det").alias("was")), "grp").filter(
            F.col("log_det") < F.col("was") - cfg.gain).drop("was")
        better = stage(better, "mcd_better")
        if better.isEmpty():  # ends: determinants cannot fall below those of the floors
            return factors
        factors = stage(factors.join(better.select("grp"), "grp", "left_anti").unionByName(better), "mcd_estimates")
        moving = vectors.join(_small(better.select("grp"), cfg.broadcast_groups), "grp", "left_semi")


def quality_verdicts(docs: DataFrame, cfg: Mcd = Mcd(), *, lang: str = "lang", source: str = "source",
                     text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, the counts, base_failed, distance2 (null where no estimate applies), kept."""
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                         F.col(text).alias("text"))
    counted = text_statistics(narrow).withColumn("base_failed", base_failed()).select("*", *_vector())
    counted = stage(counted, "quality_stats")
    rows = stage(_grouped(counted, "lang", "source", cfg), "quality_rows")
    vectors = rows.select("grp", *[n for n, _ in FEATURES]).filter(~F.col("base_failed"))
    sized = vectors.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= cfg.min_rows).select("grp")
    vectors = vectors.join(_small(stage(sized, "sized"), cfg.broadcast_groups), "grp", "left_semi")
    factors = _estimates(vectors, cfg)
    judged = _with_distance(rows, factors, cfg).unionByName(
        rows.join(_small(factors.select("grp"), cfg.broadcast_groups), "grp", "left_anti").withColumn("d2", F.lit(None).cast("double"))
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("d2").alias("distance2"),
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff(cfg), F.lit(True))).alias("kept"),
    )


def keep_good(docs: DataFrame, cfg: Mcd = Mcd(), **columns: str) -> DataFrame:
    """The documents that the rules keep, all columns as they came."""
    rows = numbered(docs)
    kept = quality_verdicts(rows, cfg, **{**columns, "key": ROW}).filter("kept").select(F.col("doc_id").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(docs.columns)
