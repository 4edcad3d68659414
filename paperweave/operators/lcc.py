"""Restriction of an unfiltered dataset to its flagged component, with new ids.

The kept papers, and the authors with a kept paper, are rank bitmaps (``operators.rank``): one lookup of a
small row filters a table and renumbers it at once, order kept, with no map table, no sort and, within the
byte limit of the broadcast, no shuffle. Category and source ids are kept as they are; only unused entries
are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ids import dense_id
from .rank import RankBitmap, rank_bitmap, rank_lookup
from .skew import skew_join


def kept_papers(papers: DataFrame) -> RankBitmap:
    """The papers flagged ``is_connected = 1``."""
    return rank_bitmap(papers.filter(F.col("is_connected") == 1).select("paper_id"), "paper_id", name="lcc_papers")


def flagged(papers: DataFrame, connected: RankBitmap, out: str = "is_connected") -> DataFrame:
    """``papers`` with ``out``: 1 for members of the component, else 0."""
    placed = rank_lookup(papers, connected, "paper_id", "__place", missing=-1)
    return placed.withColumn(out, (F.col("__place") >= 0).cast("int")).drop("__place")


def remap_ids(df: DataFrame, id_map: DataFrame, col: str, *, hot: DataFrame | None | str = None,
              total_rows: int | None = None) -> DataFrame:
    """Keep rows whose ``col`` is in ``id_map`` and replace it by the new id.

    Rows keyed by paper are bounded per key by one record's arrays, so those
    remaps are plain joins; a remap whose key can be hot (an author on a
    third of all papers) passes ``hot="auto"`` (see ``operators.skew``).
    """
    m = id_map.select(F.col("old_id").alias("__old"), F.col("new_id").alias("__new"))
    cols = [F.col("__new").alias(col) if c == col else F.col(c) for c in df.columns]
    return skew_join(df, m, col, "__old", "inner", hot=hot, total_rows=total_rows).select(*cols)


def lcc_papers(papers: DataFrame, kept: RankBitmap, keep_flag: bool = False) -> DataFrame:
    """Kept papers renumbered; the flag column is dropped unless ``keep_flag``."""
    out = rank_lookup(papers, kept, "paper_id")
    return out if keep_flag else out.drop("is_connected")


def lcc_citation_net(edges: DataFrame, kept: RankBitmap, total_rows: int | None = None) -> DataFrame:
    """Edges with both ends kept, renumbered."""
    return rank_lookup(rank_lookup(edges, kept, "src", total_rows=total_rows), kept, "dst", total_rows=total_rows)


def lcc_paper_author_net(pa_net: DataFrame, kept: RankBitmap) -> DataFrame:
    """Rows of kept papers, paper ids renumbered, author ids still old."""
    return rank_lookup(pa_net, kept, "paper_id")


def kept_authors(lcc_pa_old_authors: DataFrame) -> RankBitmap:
    """The authors with at least one kept paper (``bit_or`` needs no distinct)."""
    return rank_bitmap(lcc_pa_old_authors, "author_id", name="lcc_authors")


def lcc_author_table(authors: DataFrame, kept: RankBitmap) -> DataFrame:
    return rank_lookup(authors, kept, "author_id")


def lcc_paper_category(pcat: DataFrame, kept: RankBitmap) -> DataFrame:
    return rank_lookup(pcat, kept, "paper_id")


def lcc_category_table(categories: DataFrame, lcc_pcat: DataFrame) -> DataFrame:
    """Categories used by a kept paper as main or sub class (ids unchanged)."""
    used = (
        lcc_pcat.select(F.col("main_class_id").alias("class_id"))
        .unionByName(lcc_pcat.select(F.col("sub_class_id").alias("class_id")))
        .filter(F.col("class_id") != -1)
        .distinct()
    )
    return categories.join(used, "class_id", "left_semi")


def lcc_abstracts(abstracts: DataFrame, kept: RankBitmap) -> DataFrame:
    return rank_lookup(abstracts, kept, "paper_id")


def lcc_source_table(sources: DataFrame, lcc_paper_rows: DataFrame) -> DataFrame:
    """Sources of kept papers (ids unchanged, -1 excluded)."""
    used = lcc_paper_rows.select("source_id").filter(F.col("source_id") != -1).distinct()
    return sources.join(used, "source_id", "left_semi")


def registry_papers(papers: DataFrame) -> DataFrame:
    """``(paper_id, openalex_id)``, listed in openalex_id order."""
    return papers.select(
        F.col("paper_id").cast("bigint"), F.col("openalex_id").cast("bigint")
    )


def registry_authors(authors: DataFrame) -> DataFrame:
    return authors.select(
        F.col("author_id").cast("bigint"), F.col("openalex_author_id").cast("bigint")
    )


def registry_meta(spark: SparkSession, n_papers: int, n_authors: int, sync_date: str | None = None) -> DataFrame:
    """One row ``(n_papers, n_authors, sync_date)``."""
    from ..functions.dates import run_date

    return spark.range(1).select(
        F.lit(n_papers).cast("bigint").alias("n_papers"), F.lit(n_authors).cast("bigint").alias("n_authors"),
        run_date(sync_date).alias("sync_date"))


def category_map(lcc_categories: DataFrame) -> DataFrame:
    """``(old_id, new_id)`` for the categories in use, order kept (optional renumbering)."""
    return dense_id(lcc_categories.select(F.col("class_id").alias("old_id")), "old_id", "new_id",
                    name="lcc_category_map")


def renumber_categories(categories: DataFrame, pcat: DataFrame, cmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contiguous class ids for the kept categories and the paper-category rows;
    a missing sub class stays -1. The map holds one row per category in use."""
    from .ids import BROADCAST_ROWS

    m = cmap.select(F.col("old_id").alias("__old"), F.col("new_id").alias("__new"))
    small = cmap.count() <= BROADCAST_ROWS

    def lookup(left: DataFrame, key: str, how: str) -> DataFrame:
        if small:
            return left.join(F.broadcast(m), left[key] == m["__old"], how)
        return skew_join(left, m, key, "__old", how)  # a popular class is a hot key

    cats = remap_ids(categories, cmap, "class_id")
    main = lookup(pcat, "main_class_id", "inner").select(
        "paper_id", F.col("__new").alias("main_class_id"), "sub_class_id", "sequence"
    )
    sub = lookup(main, "sub_class_id", "left").select(
        "paper_id", "main_class_id", F.coalesce("__new", F.lit(-1).cast("bigint")).alias("sub_class_id"), "sequence"
    )
    return cats, sub

