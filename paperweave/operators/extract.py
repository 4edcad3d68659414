"""Row-level extraction from raw work records: filters, projections, explodes.

Input frames carry the raw record fields (see ``schemas.WORK``) plus
``order_no`` (position in the snapshot) and, after indexing, ``oa_id`` and
``paper_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import frac_year
from ..functions.ids import is_bad_id, parse_oa_id, valid_id
from ..functions.nulls import blank_to_null
from ..functions.rows import with_computed
from ..functions.text import abstract_text, index_entries, index_postings
from ..session import stage
from .ids import PaperIndex, dedupe_latest
from .skew import skew_join


def type_filter(works: DataFrame, keep_types=schemas.KEEP_TYPES) -> DataFrame:
    """Works of the kept types (a null type is not kept)."""
    return works.filter(F.col("type").isin(list(keep_types)))


def clean_works(works: DataFrame, *, on_bad: str = "null", keep_types=schemas.KEEP_TYPES) -> DataFrame:
    """Kept works with a parsed ``oa_id``, one record per ``oa_id``.

    Drops records without a valid id or of another type, then keeps the
    latest record (greatest ``order_no``) of an id that appears more than
    once, so ids stay unique and contiguous after indexing.
    """
    w = with_computed(works, "oa_id", parse_oa_id("id", on_bad=on_bad))
    w = type_filter(w.filter(valid_id("oa_id")), keep_types)
    return dedupe_latest(w, "oa_id", "order_no")


def build_paper_index(clean: DataFrame, *, num_partitions: int | None = None) -> PaperIndex:
    """paper_id = position of oa_id in ascending order (0-based), from the key column alone."""
    return PaperIndex(clean.select("oa_id"), "oa_id", "paper_id", num_partitions=num_partitions)


def index_works(clean: DataFrame, index: PaperIndex) -> DataFrame:
    """Records with their ``paper_id``.

    While the index can be broadcast this is a lazy lookup inside the scan: every consumer selects a few
    columns, column pruning reaches the scan, and no record is shuffled. Else the records meet the
    index once and are staged, and every consumer reads its columns from there.
    """
    out = index.attach(clean, "oa_id", "paper_id")
    return stage(out, "indexed_works") if index.shuffles else out


def explode_references(indexed: DataFrame, *, on_bad: str = "null") -> DataFrame:
    """``(paper_id, ref_oa_id)`` for every parsable, non-negative reference."""
    refs = indexed.select("paper_id", F.explode("referenced_works").alias("ref_url"))
    return with_computed(refs, "ref_oa_id", parse_oa_id("ref_url", on_bad)).select("paper_id", "ref_oa_id").filter(valid_id("ref_oa_id"))


def _place(pos: str) -> Column:
    """Position in the snapshot of a place inside a record: one bigint, unique per place."""
    too_many = F.raise_error(F.lit(f"a record holds more than {1 << schemas.PLACE_BITS} entries")).cast("bigint")
    return F.when(F.col(pos) < (1 << schemas.PLACE_BITS), F.col("order_no") + F.col(pos)).otherwise(too_many)


def explode_authorships(indexed: DataFrame, *, on_bad: str = "null") -> DataFrame:
    """One row per authorship with an author id, in array order.

    Columns: paper_id, oa_author_id, name, orcid, first (order key of the
    occurrence: record position, then position in the array).
    """
    a = indexed.select("paper_id", "order_no", F.posexplode("authorships").alias("pos", "au"))
    return with_computed(a, "oa_author_id", parse_oa_id(F.col("au.author.id"), on_bad)).select(
        "paper_id",
        "oa_author_id",
        blank_to_null(F.col("au.author.display_name")).alias("name"),
        blank_to_null(F.col("au.author.orcid")).alias("orcid"),
        _place("pos").alias("first"),
    ).filter(valid_id("oa_author_id"))


def explode_topics(indexed: DataFrame, *, on_bad: str = "null") -> DataFrame:
    """Topic rows with a field; ``sequence`` is the index in the topic array,
    numbered before field-less topics are skipped.

    Columns: paper_id, field_id, field_name, subfield_id, subfield_name,
    sequence, first. A missing subfield, or one whose id is no number, gives id -1
    (its name is kept); the topic stays because its field is valid.
    """
    t = indexed.select("paper_id", "order_no", F.posexplode("topics").alias("sequence", "tp"))
    field = F.col("tp.field")
    sub = F.col("tp.subfield")
    has_field = field.isNotNull() & (field["id"].isNotNull() | field["display_name"].isNotNull())
    has_sub = sub.isNotNull() & (sub["id"].isNotNull() | sub["display_name"].isNotNull())
    return with_computed(t.filter(has_field), "field_id", parse_oa_id(field["id"], on_bad)).select(
        "paper_id",
        "field_id",
        field["display_name"].alias("field_name"),
        F.coalesce(F.when(has_sub, parse_oa_id(sub["id"], on_bad)), F.lit(-1).cast("bigint")).alias("subfield_id"),
        F.when(has_sub, sub["display_name"]).otherwise(F.lit("")).alias("subfield_name"),
        F.col("sequence").cast("bigint").alias("sequence"),
        _place("sequence").alias("first"),
    ).filter(F.col("field_id").isNotNull())


def source_occurrences(indexed: DataFrame, *, on_bad: str = "null") -> DataFrame:
    """``(oa_source_id, display_name, issn_l, type, first)`` per work with a source."""
    s = F.col("primary_location.source")
    return with_computed(indexed, "oa_source_id", parse_oa_id(s["id"], on_bad)).select(
        "oa_source_id",
        blank_to_null(s["display_name"]).alias("display_name"),
        blank_to_null(s["issn_l"]).alias("issn_l"),
        blank_to_null(s["type"]).alias("type"),
        F.col("order_no").alias("first"),
    ).filter(valid_id("oa_source_id"))


def bad_id_counts(works: DataFrame, clean: DataFrame, keep_types=schemas.KEEP_TYPES) -> DataFrame:
    """One row: ids that are present but no number, by kind. Work ids are counted over the records
    of kept types, all others over the kept works."""
    def inside(array: str, id_of):
        bad = F.size(F.filter(array, lambda x: F.coalesce(is_bad_id(id_of(x)), F.lit(False))))
        return F.coalesce(F.sum(F.when(F.col(array).isNotNull(), bad)), F.lit(0)).cast("bigint")

    work = type_filter(works, keep_types).agg(F.count(F.when(is_bad_id("id"), 1)))
    return clean.agg(
        inside("referenced_works", lambda x: x).alias("n_bad_references"),
        inside("authorships", lambda x: x["author"]["id"]).alias("n_bad_authors"),
        inside("topics", lambda x: x["field"]["id"]).alias("n_bad_fields"),
        inside("topics", lambda x: x["subfield"]["id"]).alias("n_bad_subfields"),
        F.count(F.when(is_bad_id("primary_location.source.id"), 1)).alias("n_bad_sources"),
    ).withColumn("n_bad_works", work.scalar())


def paper_metadata(indexed: DataFrame, source_map: DataFrame, *, broadcast_map: bool = False,
                   hot: DataFrame | None | str = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The 11 metadata columns of a paper; ``source_id`` -1 without a known source.

    ``source_map`` holds ``(oa_source_id, source_id)``. Broadcast it when its
    size is known to be small; otherwise ``hot`` names venues holding a large
    share of all papers, which are joined apart (``operators.skew``).
    ``carry`` names extra columns of ``indexed`` to keep (appended).
    """
    src_id = F.col("__src_id")
    meta = with_computed(indexed, "__src_id", parse_oa_id(F.col("primary_location.source.id"))).select(
        "paper_id",
        F.col("oa_id").alias("openalex_id"),
        blank_to_null("title").alias("title"),
        F.col("publication_year").cast("int").alias("year"),
        blank_to_null("doi").alias("doi"),
        F.col("type"),
        blank_to_null("publication_date").alias("publication_date"),
        frac_year("publication_date", "publication_year").alias("frac_year"),
        F.col("cited_by_count").cast("bigint").alias("cited_by_count"),
        blank_to_null("language").alias("language"),
        F.when(valid_id(src_id), src_id).alias("__src"),
        *carry,
    )
    sm = source_map.select(F.col("oa_source_id").alias("__smap"), F.col("source_id").alias("__sid"))
    if broadcast_map:
        sm, hot = F.broadcast(sm), None
    return skew_join(meta, sm, "__src", "__smap", "left", hot=hot).select(
        *[c for c in schemas.PAPER_METADATA.fieldNames() if c != "source_id"],
        F.coalesce("__sid", F.lit(-1).cast("bigint")).alias("source_id"),
        *carry,
    )


def abstracts(indexed: DataFrame) -> DataFrame:
    """``(paper_id, abstract)`` for works whose rebuilt abstract is not empty, rebuilt where the record is scanned.

    A text of two or more slots always holds a space, so only single-slot
    indexes need the rebuilt text to decide; the filter never rebuilds the
    text of the others (Catalyst would otherwise evaluate it twice).
    """
    m = F.col("abstract_inverted_index")
    max_pos = F.array_max(F.flatten(F.transform(index_entries(m), lambda e: e["v"])))
    nonempty = F.when(max_pos >= 1, F.lit(True)).otherwise(F.length(abstract_text(m)) > 0)
    return (
        indexed.select("paper_id", "abstract_inverted_index")
        .filter(m.isNotNull() & (F.size(m) > 0))
        .filter(nonempty)
        .select("paper_id", abstract_text(m).alias("abstract"))
    )


def inverted_index_postings(indexed: DataFrame) -> DataFrame:
    """``(paper_id, word, position)`` for every posting of every abstract index."""
    return index_postings(indexed, "paper_id", "abstract_inverted_index")
