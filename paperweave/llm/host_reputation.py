"""URL filter: block rules, then the empirical-Bayes reputation of the host.

Labelled page outcomes (bad or not) are counted per host, registered domain and public
suffix. Every level shrinks towards the level above through a beta-binomial prior: the
prior mean is the posterior mean of the parent, the prior strength comes from the observed
over-dispersion between siblings (method of moments). A host is blocked when the lower
bound of its posterior bad rate passes ``max_bad``, i.e. only when the evidence says so
with confidence; a host without labels inherits what its domain and suffix say.

Defined results
* null url, or one without ``://``: empty host and path, no rule, verdict of the empty host
  (its labelled pages count like those of any other host).
* no labels at all: nothing is known to be bad, everything not covered by a rule is allowed.
* labels: repeated rows of an id count once (bad if any of them is bad); null flags count
  as not bad; rows with a null id are ignored.
* repeated page rows are judged and counted one by one; extra columns of the page table are
  ignored unless named.
* rules of equal length: a block rule wins, then the smaller text.

Everything is DataFrame functions. The host table is pre-aggregated before any join, the
join back onto pages salts hosts that hold more rows than the hot-key threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import ascii_lower, salted_join

# fixed values: (action, rule), rule = host + path prefix
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


@dataclass(frozen=True)
class Reputation:
    """``suffixes``: public suffixes of several labels (a single last label is always one).
    ``z``: standard deviations below the posterior mean. ``max_bad``: bad rate that a host may have.
    ``min_rho``/``max_rho``: limits of the estimated over-dispersion (strength 1/rho - 1)."""

    suffixes: tuple[str, ...] = ("co.uk", "org.uk", "com.au", "co.jp")
    z: float = 1.645
    max_bad: float = 0.3
    min_rho: float = 0.001
    max_rho: float = 0.5


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits; nulls when none does. The rules are a
    parameter of the query (a short list), so they become one CASE expression."""
    text = action = None
    for act, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(slash + rest))
        text = F.when(fits, rule) if text is None else text.when(fits, rule)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    if text is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, action


def suffix_of(host: Column, suffixes: Sequence[str] = ()) -> Column:
    bare = F.regexp_extract(host, r"([^@:]*)(?::[0-9]*)?$", 1)
    out = F.substring_index(bare, ".", -1)
    for s in sorted(suffixes, key=len):
        out = F.when((bare == s) | F.endswith(bare, F.lit("." + s)), F.lit(s)).otherwise(out)
    return out


def domain_of(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """Registered domain: the suffix and the label before it (the host itself if there is none)."""
    bare = F.regexp_extract(host, r"([^@:]*)(?::[0-9]*)?$", 1)
    labels = F.size(F.split(suffix_of(host, suffixes), r"\.")) + 1
    return F.array_join(F.slice(F.split(bare, r"\."), -F.least(labels, F.size(F.split(bare, r"\."))), labels), ".")


def _strength(units: DataFrame, group_mean: str, cfg: Reputation) -> DataFrame:
    """One row: prior strength m of ``units`` (columns n, k and the mean they shrink to)."""
    p = F.col(group_mean)
    seen = units.filter((F.col("n") > 0) & (p > 0) & (p < 1))
    excess = F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - p, 2) / (p * (1 - p))) - F.count(F.lit(1))
    rho = excess / F.nullif(F.sum("n") - F.count(F.lit(1)), F.lit(0))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(cfg.max_rho)), F.lit(cfg.min_rho)), F.lit(cfg.max_rho))
    return seen.agg((1 / rho - 1).alias("m"))


def _shrunk(units: DataFrame, cfg: Reputation) -> DataFrame:
    """``units`` (n, k, prior) with the posterior's a and b and its mean."""
    return (
        units.crossJoin(F.broadcast(_strength(units, "prior", cfg)))  # one row
        .withColumn("a", F.col("k") + F.col("m") * F.col("prior"))
        .withColumn("b", F.col("n") - F.col("k") + F.col("m") * (1 - F.col("prior")))
        .withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
        .drop("m")
    )


def host_posteriors(hosts: DataFrame, cfg: Reputation = Reputation()) -> DataFrame:
    """``hosts`` (host, n labelled, k bad, pages) with domain, suffix, posterior mean and its lower bound."""
    hosts = (
        hosts.withColumn("domain", domain_of(F.col("host"), cfg.suffixes))
        .withColumn("suffix", suffix_of(F.col("host"), cfg.suffixes))
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    # Jeffreys' rule for the root, so that the mean stays inside (0, 1)
    root = suffixes.agg(
        ((F.coalesce(F.sum("k"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1.0)).alias("prior"),
    )
    s = _shrunk(suffixes.crossJoin(F.broadcast(root)), cfg)
    d = stage(_shrunk(domains.join(s.select("suffix", F.col("mean").alias("prior")), "suffix"), cfg), "domain_rep")
    h = _shrunk(hosts.join(d.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"]), cfg)
    total = F.col("a") + F.col("b")
    return h.withColumn("bound", F.col("mean") - cfg.z * F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1))))


def judge_pages(
    pages: DataFrame, labels: DataFrame, cfg: Reputation = Reputation(), rules: Sequence[tuple[str, str]] = RULES,
    *, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the host's bad_rate and bad_rate_bound."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    judged = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    outcome = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad")
    )
    per_host = stage(
        judged.select("page_id", "host").join(outcome, F.col("page_id") == F.col("doc_id"), "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"), F.count(F.lit(1)).alias("pages")),
        "host_outcomes",
    )
    verdicts = host_posteriors(per_host, cfg).select(
        "host", "pages", F.col("mean").alias("bad_rate"), F.col("bound").alias("bad_rate_bound")
    )
    rule, action = matched_rule(F.col("host"), F.col("path"), rules)
    return salted_join(judged, verdicts, "host", "pages", F.xxhash64("page_id", "path")).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(action, F.when(F.col("bad_rate_bound") > cfg.max_bad, "block").otherwise("allow")).alias("verdict"),
        "bad_rate", "bad_rate_bound",
    )
