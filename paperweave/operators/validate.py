"""Run-time checks as ordinary queries: venue check, completeness, counters."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas

log = logging.getLogger(__name__)


def venue_papers(papers: DataFrame, sources: DataFrame, venues=schemas.VALIDATION_VENUES) -> DataFrame:
    """Papers whose source's lower-cased name is one of ``venues``."""
    named = sources.filter(F.lower("display_name").isin(list(venues))).select("source_id")
    return papers.join(named, "source_id", "left_semi")


def venue_top_cited(papers: DataFrame, sources: DataFrame, n: int = schemas.VALIDATION_TOP_N,
                    venues=schemas.VALIDATION_VENUES) -> DataFrame:
    """The ``n`` most cited papers of the venues: citations descending, nulls
    first, paper_id breaking ties (a distributed top-k, no global sort)."""
    vp = venue_papers(papers, sources, venues)
    return vp.orderBy(F.desc_nulls_first("cited_by_count"), F.asc("paper_id")).limit(n)


def venue_validation(papers: DataFrame, sources: DataFrame, n: int = schemas.VALIDATION_TOP_N,
                     warn_below: int = schemas.VALIDATION_WARN_BELOW,
                     venues=schemas.VALIDATION_VENUES) -> DataFrame:
    """One row ``(n_top, n_in_lcc, warn)`` for the top-cited venue papers.

    ``warn`` is null when no source carries a venue name (check skipped).
    """
    top = venue_top_cited(papers, sources, n, venues)
    has_venue = sources.filter(F.lower("display_name").isin(list(venues))).limit(1)
    agg = top.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_top"),
        F.coalesce(F.sum("is_connected"), F.lit(0)).cast("bigint").alias("n_in_lcc"),
    )
    flag = has_venue.agg(F.count(F.lit(1)))
    return agg.select("n_top", "n_in_lcc", F.when(flag.scalar() > 0, F.col("n_in_lcc") < warn_below).alias("warn"))


def log_venue_validation(row) -> None:
    if row["warn"] is None:
        log.info("venue names not found, validation skipped")
    elif row["warn"]:
        log.warning(
            "only %s of the top %s venue papers are in the largest component", row["n_in_lcc"], row["n_top"]
        )


def completeness(metadata: DataFrame, index: DataFrame) -> DataFrame:
    """One row ``(n_metadata, n_index)``."""
    return dataset_counts({"n_metadata": metadata, "n_index": index})


def dataset_counts(parts: dict[str, DataFrame | int]) -> DataFrame:
    """One row with the row count of each named frame (or a count that is already known), one column per
    name: scalar subqueries side by side, no join."""
    spark = next(df for df in parts.values() if isinstance(df, DataFrame)).sparkSession

    def count(part: DataFrame | int):
        return part.agg(F.count(F.lit(1))).scalar() if isinstance(part, DataFrame) else F.lit(part)

    return spark.range(1).select(*[count(part).cast("bigint").alias(name) for name, part in parts.items()])
