"""Registered queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the test tables of ``sf_dir``, derives work records from
them (``sources.fixture``) and runs the library's operators on those. The
derived records and the staged intermediate tables are shared between the
queries of one session through a small context cache.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle, schemas
from ..functions.ids import parse_oa_id
from ..functions.text import abstract_text, index_extent, inverted_index
from ..operators import extract, graph, validate
from ..operators.ids import dense_id, lookup_ids
from ..session import SORTED_GROUPS_CONF, stage, staging_path, switched_on
from ..sources import tables as io
from ..sources.fixture import works_fixture
from ..sources.works import order_number, require_nonempty, scan_works, write_works
from .build import LccBuild, UnfilteredBuild
from .job import build_lcc, build_unfiltered, read_unfiltered

JOB_SYNC_DATE = "2024-05-01"


class FixtureContext:
    """Works derived from one table directory, and the builds over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        with switched_on(spark, SORTED_GROUPS_CONF):
            self.works = stage(works_fixture(spark, sf_dir), "works_fixture", compression="zstd")
        self.build = UnfilteredBuild(self.works, component_rule="exact")
        self._lcc: LccBuild | None = None
        self._snapshot: str | None = None
        self._scanned: UnfilteredBuild | None = None
        self._written: str | None = None
        self.written_build: UnfilteredBuild | None = None  # what ``written`` wrote, with its staged tables

    @property
    def from_snapshot(self) -> UnfilteredBuild:
        """The same build, fed by scanning the written snapshot (file order keys)."""
        if self._scanned is None:
            root = self.snapshot()
            self._scanned = UnfilteredBuild(stage(scan_works(self.spark, root), "works_scanned", compression="zstd"))
        return self._scanned

    @property
    def lcc(self) -> LccBuild:
        if self._lcc is None:
            self._lcc = LccBuild(self.build.outputs(), kept=self.build.connected)
        return self._lcc

    def written(self) -> str:
        """Both datasets written once by the job's own functions; returns the component dataset's folder."""
        if self._written is None:
            out = staging_path(self.spark, "job") + "/dataset"
            b = self.written_build = build_unfiltered(self.works, out, sync_date=JOB_SYNC_DATE, typed=True)
            build_lcc(self.spark, out, sync_date=JOB_SYNC_DATE, kept=b.connected, tables=b.outputs())
            self._written = out
        return self._written

    def snapshot(self) -> str:
        """The works written once as a gzip JSON-lines snapshot; returns its root."""
        if self._snapshot is None:
            root = staging_path(self.spark, "snapshot")
            write_works(self.works, root, rows_per_file=oracle.SCAN_ROWS_PER_FILE)
            self._snapshot = root
        return self._snapshot


_CONTEXTS: dict[tuple[str, str], FixtureContext] = {}


def context(spark: SparkSession, sf_dir: str) -> FixtureContext:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CONTEXTS:
        _CONTEXTS[key] = FixtureContext(spark, sf_dir)
    return _CONTEXTS[key]


def _roundtrip(spark: SparkSession, df: DataFrame, name: str, fmt: str, compression: str | None = None) -> DataFrame:
    path = staging_path(spark, f"roundtrip_{name}")
    io.write_table(df, path, fmt, compression=compression)
    return io.read_table(spark, path, name, fmt)


def _with_place(df: DataFrame) -> DataFrame:
    """The rows of a written table with ``place``: their position over its files, in file order."""
    columns = df.columns
    placed = df.select(*columns, F.col("_metadata.file_name").alias("__f"), F.monotonically_increasing_id().alias("__i"))
    return dense_id(stage(placed, "written_rows"), ["__f", "__i"], "place", name="written_place").select(*columns, "place")


# -- scans ---------------------------------------------------------------------


def q_scan_works(spark, sf):
    root = context(spark, sf).snapshot()
    w = require_nonempty(scan_works(spark, root), root)
    return w.select("id", "type", "title", F.col("updated_date").cast("string").alias("updated_date"))


def q_scan_partitions(spark, sf):
    root = context(spark, sf).snapshot()
    w = scan_works(spark, root, partitions=["updated_date=2024-01-01", "updated_date=2024-03-01", "updated_date=1999-01-01"])
    return w.select("id", "type", F.col("updated_date").cast("string").alias("updated_date"))


def q_scan_file_cap(spark, sf):
    root = context(spark, sf).snapshot()
    w = scan_works(spark, root, files_per_partition=1)
    return w.select("id", F.col("updated_date").cast("string").alias("updated_date"))


def q_empty_guard(spark, sf):
    """Every partition of the snapshot, and two that are not there: usable works, and whether the guard stops the job."""
    root = context(spark, sf).snapshot()
    dates = [r[0] for r in scan_works(spark, root).select(F.col("updated_date").cast("string")).distinct().collect()]
    rows = None
    for date in [*sorted(dates), "1999-01-01", "2999-12-31"]:
        works = scan_works(spark, root, partitions=[f"updated_date={date}"])
        try:
            guarded = require_nonempty(extract.type_filter(works), root).agg(F.count(F.lit(1)).alias("n_works"), F.lit(False).alias("stopped"))
        except RuntimeError:
            guarded = spark.range(1).select(F.lit(0).cast("bigint").alias("n_works"), F.lit(True).alias("stopped"))
        guarded = guarded.select(F.lit(date).alias("updated_date"), "n_works", "stopped")
        rows = guarded if rows is None else rows.unionByName(guarded)
    return rows


def q_standalone_lcc_papers(spark, sf):
    """The component's papers as a second application finds them: from the published dataset's typed copies."""
    return LccBuild(read_unfiltered(spark, context(spark, sf).written())).papers


def q_standalone_lcc_author_table(spark, sf):
    return LccBuild(read_unfiltered(spark, context(spark, sf).written())).author_table


def q_snapshot_author_table(spark, sf):
    return context(spark, sf).from_snapshot.author_table


def q_snapshot_source_table(spark, sf):
    return context(spark, sf).from_snapshot.source_table


def q_snapshot_paper_table(spark, sf):
    return context(spark, sf).from_snapshot.paper_table


def q_dedupe_works(spark, sf):
    """Orders with key % 11 = 0 reappear in a later partition with a revised
    title (and, for key % 22 = 0, a dropped type): the latest kept-type record
    of every id must win."""
    w = context(spark, sf).works
    k = ((parse_oa_id("id") - 1000) / 3).cast("bigint")
    later = F.lit(oracle.DEDUPE_DATE).cast("date")
    again = (
        w.filter(k % 11 == 0)
        .withColumn("type", F.when(k % 22 == 0, F.lit("dataset")).otherwise(F.col("type")))
        .withColumn("title", F.concat(F.lit("Revised "), F.col("title")))
        .withColumn("updated_date", later)
        .withColumn("order_key", F.struct(later.alias("updated_date"), F.lit("").alias("file"),
                                          F.lit(0).cast("bigint").alias("block"), k.alias("line")))
        .withColumn("order_no", order_number(F.lit(3), k))
    )
    clean = extract.clean_works(w.unionByName(again))
    return clean.select("oa_id", "title", F.col("updated_date").cast("string").alias("updated_date"))


# -- functions and extraction ----------------------------------------------------


def q_type_filter(spark, sf):
    return context(spark, sf).build.clean.select("oa_id", "type")


def q_parse_oa_id(spark, sf):
    w = context(spark, sf).works
    urls = (
        w.select(F.col("id").alias("url"))
        .unionByName(w.select(F.explode("referenced_works").alias("url")))
        .unionByName(w.select(F.explode("authorships.author.id").alias("url")))
        .unionByName(w.select(F.col("primary_location.source.id").alias("url")))
        .unionByName(w.select(F.explode("topics.field.id").alias("url")))
        .unionByName(w.select(F.explode("topics.subfield.id").alias("url")))
    )
    return urls.filter(F.col("url").isNotNull()).distinct().select("url", parse_oa_id("url").alias("oa_id"))


def q_frac_year(spark, sf):
    m = context(spark, sf).build.metadata
    return m.select(F.col("openalex_id").alias("oa_id"), "publication_date", "year", "frac_year")


def q_paper_index(spark, sf):
    return context(spark, sf).build.index


def q_paper_metadata(spark, sf):
    return context(spark, sf).build.metadata


def q_explode_references(spark, sf):
    return context(spark, sf).build.references


def q_explode_authorships(spark, sf):
    a = context(spark, sf).build.authorships
    place = F.col("first").bitwiseAND(F.lit((1 << schemas.PLACE_BITS) - 1)).cast("int")
    return a.select("paper_id", place.alias("position"), "oa_author_id", "name", "orcid")


def q_explode_topics(spark, sf):
    t = context(spark, sf).build.topics
    return t.select("paper_id", "field_id", "field_name", "subfield_id", "subfield_name", "sequence")


def q_inverted_index_postings(spark, sf):
    return extract.inverted_index_postings(context(spark, sf).build.indexed)


def q_reconstruct_abstract(spark, sf):
    docs = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return docs.select("doc_id", abstract_text(inverted_index("text")).alias("abstract"))


def q_abstracts(spark, sf):
    return context(spark, sf).build.abstracts


def q_abstract_length(spark, sf):
    w = context(spark, sf).build.indexed.select("paper_id", "abstract_inverted_index")
    w = w.filter(F.col("abstract_inverted_index").isNotNull() & (F.size("abstract_inverted_index") > 0))
    return index_extent(w).select("paper_id", "max_position", "n_positions")


# -- citations and graph ---------------------------------------------------------


def q_resolve_citations(spark, sf):
    b = context(spark, sf).build
    refs = b.references.select(F.col("paper_id").alias("src"), "ref_oa_id")
    return b.paper_index.attach(refs, "ref_oa_id", "dst").select("src", "dst")


def q_lookup_ids(spark, sf):
    b = context(spark, sf).build
    return lookup_ids(b.references, b.index, "ref_oa_id", out="dst", keep_missing=True).select(
        "paper_id", "ref_oa_id", "dst"
    )


def q_citation_net(spark, sf):
    return context(spark, sf).build.citation_net


def q_graph_shape(spark, sf):
    b = context(spark, sf).build
    return graph.graph_shape(b.citation_net, b.n_papers, b.n_papers)


def q_symmetrize(spark, sf):
    return graph.symmetrize(context(spark, sf).build.citation_net)


def q_undirected_degree(spark, sf):
    return context(spark, sf).build.degrees


def q_adjacency(spark, sf):
    b = context(spark, sf).build
    return graph.adjacency_offsets(b.vertices, b.citation_net)


def q_connected_components(spark, sf):
    return context(spark, sf).build.labels


def q_component_sizes(spark, sf):
    labels = context(spark, sf).build.labels
    return labels.groupBy("component").agg(F.count(F.lit(1)).cast("bigint").alias("size"))


def q_component_seeds(spark, sf):
    return context(spark, sf).build.component_summary


def _members(labels: DataFrame, chosen: DataFrame) -> DataFrame:
    return labels.join(F.broadcast(chosen.select("component")), "component", "left_semi").select("paper_id")


def q_lcc_exact(spark, sf):
    b = context(spark, sf).build
    return _members(b.labels, b.lcc_exact)


def q_lcc_seeded(spark, sf):
    b = context(spark, sf).build
    return _members(b.labels, b.lcc_seeded)


def q_expand_from_seed(spark, sf):
    b = context(spark, sf).build
    seed = b.component_summary.orderBy(F.desc("max_degree"), F.asc("seed")).limit(1)
    return graph.reachable(b.labels, seed.select(F.col("seed").alias("paper_id")))


def q_expand_bfs(spark, sf):
    b = context(spark, sf).build
    seed = b.component_summary.orderBy(F.desc("max_degree"), F.asc("seed")).limit(1)
    return graph.expand(b.citation_net, seed.select(F.col("seed").alias("paper_id")))


# -- entity tables -----------------------------------------------------------------


def q_source_table(spark, sf):
    return context(spark, sf).build.source_table


def q_source_first_seen(spark, sf):
    return context(spark, sf).build.source_table.select("source_id", "openalex_source_id")


def q_author_table(spark, sf):
    return context(spark, sf).build.author_table


def q_author_first_seen(spark, sf):
    return context(spark, sf).build.author_table.select("author_id", "openalex_author_id")


def q_paper_author_net(spark, sf):
    return context(spark, sf).build.paper_author_net


def q_category_table(spark, sf):
    return context(spark, sf).build.category_table


def q_paper_category_table(spark, sf):
    return context(spark, sf).build.paper_category_table


def q_paper_table(spark, sf):
    return context(spark, sf).build.paper_table


def q_paper_table_seeded(spark, sf):
    """Paper table flagged by the seeded (reference search) component rule."""
    from ..operators import tables

    b = context(spark, sf).build
    return tables.paper_table(b.metadata, graph.flag_members(b.labels, b.lcc_seeded))


def q_venue_top_cited(spark, sf):
    b = context(spark, sf).build
    return validate.venue_top_cited(b.paper_table, b.source_table).select("paper_id", "cited_by_count")


def q_venue_validation(spark, sf):
    return context(spark, sf).build.venue_validation()


def q_completeness(spark, sf):
    return context(spark, sf).build.completeness()


def q_registry_papers(spark, sf):
    return context(spark, sf).build.registry_papers()


def q_registry_authors(spark, sf):
    return context(spark, sf).build.registry_authors()


def q_registry_meta(spark, sf):
    return context(spark, sf).build.registry_meta()


def q_dataset_counts(spark, sf):
    return context(spark, sf).build.counters()


# -- sinks (write, read back) ------------------------------------------------------


def q_csv_roundtrip(spark, sf):
    return _roundtrip(spark, context(spark, sf).build.paper_table, "paper_table", "csv")


def q_csv_gz_roundtrip(spark, sf):
    return _roundtrip(spark, context(spark, sf).build.author_table, "author_table", "csv", "gzip")


def q_parquet_roundtrip(spark, sf):
    return _roundtrip(spark, context(spark, sf).build.paper_category_table, "paper_category_table", "parquet")


def q_abstracts_sink(spark, sf):
    path = staging_path(spark, "abstracts_sink")
    io.write_abstracts(context(spark, sf).build.abstracts, path)
    return io.read_table(spark, path, "abstracts", "parquet")


def q_abstract_lookup(spark, sf):
    """The abstracts of the 1000 most cited papers, by a point lookup in the written files."""
    path = io.table_path(context(spark, sf).written() + "_unfiltered", "abstracts", "parquet")
    # the build that wrote the files: another one would search the components of the same graph again
    top = context(spark, sf).written_build.paper_table.orderBy(F.desc_nulls_last("cited_by_count"), "paper_id").limit(1000)
    return io.lookup_abstracts(spark, path, top.select("paper_id"))


# -- component-restricted dataset ----------------------------------------------------


def q_lcc_papers(spark, sf):
    return context(spark, sf).lcc.papers


def q_lcc_citation_net(spark, sf):
    return context(spark, sf).lcc.citation_net


def q_lcc_paper_author_net(spark, sf):
    return context(spark, sf).lcc.paper_author_net


def q_lcc_author_table(spark, sf):
    return context(spark, sf).lcc.author_table


def q_lcc_paper_category(spark, sf):
    return context(spark, sf).lcc.paper_category_table


def q_lcc_category_table(spark, sf):
    return context(spark, sf).lcc.category_table


def q_lcc_abstracts(spark, sf):
    path = staging_path(spark, "lcc_abstracts")
    io.write_abstracts(context(spark, sf).lcc.abstracts, path, global_sort=True)
    return io.read_table(spark, path, "abstracts", "parquet")


def q_lcc_source_table(spark, sf):
    return context(spark, sf).lcc.source_table


def q_lcc_registry_papers(spark, sf):
    return context(spark, sf).lcc.registry_papers()


def q_lcc_registry_authors(spark, sf):
    return context(spark, sf).lcc.registry_authors()


def q_lcc_registry_meta(spark, sf):
    return context(spark, sf).lcc.registry_meta()


# -- the datasets as the job writes them (place = position in the written files) --------


def q_written_paper_table(spark, sf):
    return _with_place(io.read_table(spark, context(spark, sf).written() + "_unfiltered/paper_table.csv", "paper_table"))


def q_written_author_table(spark, sf):
    return _with_place(io.read_table(spark, context(spark, sf).written() + "_unfiltered/author_table.csv", "author_table"))


def q_written_paper_category(spark, sf):
    path = context(spark, sf).written() + "_unfiltered/paper_category_table.csv"
    return _with_place(io.read_table(spark, path, "paper_category_table"))


def q_written_registry_papers(spark, sf):
    return _with_place(spark.read.parquet(context(spark, sf).written() + "_unfiltered/registry/papers"))


def q_written_lcc_papers(spark, sf):
    return _with_place(io.read_table(spark, context(spark, sf).written() + "/paper_table.csv", schema=schemas.PAPER_METADATA))


def q_written_lcc_category_table(spark, sf):
    return _with_place(io.read_table(spark, context(spark, sf).written() + "/category_table.csv", "category_table"))


def q_written_lcc_source_table(spark, sf):
    return _with_place(io.read_table(spark, context(spark, sf).written() + "/source_table.csv", "source_table"))


def q_written_lcc_citation_net(spark, sf):
    return io.read_graph(spark, context(spark, sf).written() + "/citation_net")[0]


def q_written_lcc_shapes(spark, sf):
    out = context(spark, sf).written()
    shapes = [io.read_graph(spark, f"{out}/{g}")[1].withColumn("graph", F.lit(g)) for g in ("citation_net", "paper_author_net")]
    return shapes[0].unionByName(shapes[1])


def q_written_lcc_registry_meta(spark, sf):
    return spark.read.parquet(context(spark, sf).written() + "/registry/meta")


def q_adjacency_entries(spark, sf):
    return graph.adjacency_entries(context(spark, sf).build.citation_net)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

assert set(QUERIES) == set(oracle.oracle_sql()), sorted(set(QUERIES) ^ set(oracle.oracle_sql()))
