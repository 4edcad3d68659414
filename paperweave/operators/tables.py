"""Entity tables: first-seen numbering of authors and sources, categories,
paper-category assignments, the paper-author graph and the paper table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..session import stage
from .ids import BROADCAST_ROWS, dense_id


def fetch_firsts(rows: DataFrame, firsts: DataFrame, name: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` whose ``first`` is one of ``firsts`` (a row for each entity), with the columns of both, staged.

    ``firsts`` is written before the join, so that its number of rows is known: up to ``most`` it is broadcast, and
    the far larger ``rows`` are read where they lie, without a shuffle."""
    firsts = stage(firsts, f"{name}_firsts")
    return stage(rows.join(F.broadcast(firsts) if firsts.count() <= most else firsts, "first"), f"{name}_rows")


def first_seen_ids(occurrences: DataFrame, key: str, out: str, attrs: list[str], *, name: str) -> DataFrame:
    """Number distinct ``key`` values 0.. by their first occurrence.

    ``occurrences`` has ``key``, the ``attrs`` and ``first`` (a bigint, unique
    per row: the position of the occurrence). The attributes of the first
    occurrence are kept: a hash aggregate finds it, and its row is fetched by
    its position, which no other row shares. Map-side partial aggregation makes
    a key that occurs in a third of all rows no harder than any other. The
    count of rows per key comes along for hot-key detection in later joins.
    """
    firsts = occurrences.groupBy(key).agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("occurrences"))
    winners = fetch_firsts(occurrences.select(key, *attrs, "first"), firsts.select("first", "occurrences"), name)
    numbered = dense_id(winners, "first", out, name=name)
    return numbered.select(out, key, *attrs, "occurrences")


AUTHOR_COLUMNS = ["author_id", "openalex_author_id", "name", "orcid"]
SOURCE_COLUMNS = ["source_id", "openalex_source_id", "display_name", "issn_l", "type"]


def author_table(authorships: DataFrame, *, with_occurrences: bool = False) -> DataFrame:
    """``(author_id, openalex_author_id, name, orcid)``, ids by first appearance."""
    t = first_seen_ids(authorships, "oa_author_id", "author_id", ["name", "orcid"], name="authors")
    t = t.withColumnRenamed("oa_author_id", "openalex_author_id")
    return t.select(*AUTHOR_COLUMNS, *(["occurrences"] if with_occurrences else []))


def source_table(occurrences: DataFrame, *, with_occurrences: bool = False) -> DataFrame:
    """``(source_id, openalex_source_id, display_name, issn_l, type)`` by first appearance."""
    t = first_seen_ids(
        occurrences, "oa_source_id", "source_id", ["display_name", "issn_l", "type"], name="sources"
    )
    t = t.withColumnRenamed("oa_source_id", "openalex_source_id")
    return t.select(*SOURCE_COLUMNS, *(["occurrences"] if with_occurrences else []))


def hot_from_counts(table: DataFrame, key: str, as_name: str, min_rows: int | None = None) -> DataFrame | None:
    """Hot keys from a table that already counts its rows per key (``occurrences``)."""
    from .skew import hot_key_rows, stage_nonempty

    threshold = hot_key_rows(table.sparkSession, min_rows)
    if (table.agg(F.max("occurrences")).first()[0] or 0) < threshold:
        return None
    found = table.filter(F.col("occurrences") >= threshold)
    return stage_nonempty(found.select(F.col(key).alias(as_name), F.col("occurrences").alias("rows")), "hot_keys")


def paper_author_net(authorships: DataFrame, authors: DataFrame, *, hot: DataFrame | None | str = "auto") -> DataFrame:
    """Distinct ``(paper_id, author_id)`` pairs (an author on a large share of
    all papers is a hot key: see ``operators.skew``)."""
    from .skew import skew_join

    amap = authors.select(F.col("openalex_author_id").alias("__oa"), "author_id")
    pairs = skew_join(authorships.select("paper_id", "oa_author_id"), amap, "oa_author_id", "__oa", "inner", hot=hot)
    return pairs.select("paper_id", "author_id").distinct()


def category_table(topics: DataFrame) -> DataFrame:
    """Mains (fields) get class ids 0..F-1 by field id, subs F.. by subfield id.

    Only non-negative ids are listed. A name comes from the first topic row
    carrying the id.
    """
    def listed(kind: int, key: str, name: str) -> DataFrame:
        firsts = topics.filter(F.col(key) >= 0).groupBy(key).agg(F.min("first").alias("first"))
        return fetch_firsts(topics.select(F.col(name).alias("title"), "first"), firsts, "categories").select(
            F.lit(kind).alias("__kind"), F.col(key).alias("openalex_id"), "title"
        )

    both = listed(0, "field_id", "field_name").unionByName(listed(1, "subfield_id", "subfield_name"))
    numbered = dense_id(both, ["__kind", "openalex_id"], "class_id", name="categories")
    return numbered.select(
        "class_id",
        F.when(F.col("__kind") == 0, F.lit(schemas.MAIN_TYPE)).otherwise(F.lit(schemas.SUB_TYPE)).alias("type"),
        F.col("title").cast("string").alias("title"),
        "openalex_id",
    )


def paper_category_table(topics: DataFrame, categories: DataFrame) -> DataFrame:
    """``(paper_id, main_class_id, sub_class_id, sequence)``.

    Topics whose field has no main class drop out; a subfield without a class
    gives -1. The category maps hold one row per taxonomy entry and are
    broadcast after a size check; beyond it, popular fields (a field can
    carry a third of all topics) are split off as hot keys.
    """
    from .skew import skew_join

    def lookup(left: DataFrame, cmap: DataFrame, key: str, how: str) -> DataFrame:
        if cmap.count() <= BROADCAST_ROWS:
            return left.join(F.broadcast(cmap), left[key] == cmap["__cid"], how)
        return skew_join(left, cmap, key, "__cid", how)

    mains = categories.filter(F.col("type") == schemas.MAIN_TYPE).select(
        F.col("openalex_id").alias("__cid"), F.col("class_id").alias("main_class_id")
    )
    subs = categories.filter(F.col("type") == schemas.SUB_TYPE).select(
        F.col("openalex_id").alias("__cid"), F.col("class_id").alias("sub_class_id")
    )
    rows = lookup(topics.select("paper_id", "field_id", "subfield_id", "sequence"), mains, "field_id", "inner")
    rows = lookup(rows.drop("__cid"), subs, "subfield_id", "left")
    return rows.select(
        "paper_id",
        F.col("main_class_id").cast("bigint").alias("main_class_id"),
        F.coalesce("sub_class_id", F.lit(-1)).cast("bigint").alias("sub_class_id"),
        F.col("sequence").cast("bigint").alias("sequence"),
    )


def paper_table(metadata: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """Metadata plus ``is_connected`` (0 for papers without a flag).

    ``flags`` ``(paper_id, is_connected)`` is joined on paper_id; without it,
    ``metadata`` must already carry the flag column.
    """
    if flags is not None:
        metadata = metadata.join(flags, "paper_id", "left")
    return metadata.select(
        *schemas.PAPER_METADATA.fieldNames(),
        F.coalesce("is_connected", F.lit(0)).cast("int").alias("is_connected"),
    )
