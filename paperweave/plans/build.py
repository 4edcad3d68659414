"""The unfiltered and the component-restricted datasets as lazily built plans.

``UnfilteredBuild`` turns raw work records into the nine unfiltered outputs;
``LccBuild`` restricts them to the flagged component. Intermediate results
that feed several outputs (the paper index, the citation graph, component
labels, entity tables, id maps) are staged once in the shared checkpoint
folder and read back with pruned columns. Everything else stays a lazy
DataFrame, so each output is one optimised plan; the works meet their
``paper_id`` through a join that each consumer prunes to its own columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import extract, graph, lcc, tables, validate
from ..operators.ids import PaperIndex
from ..operators.rank import RankBitmap, rank_lookup
from ..session import stage


class UnfilteredBuild:
    """All unfiltered tables of one works input.

    ``component_rule`` is ``"exact"`` (true largest component) or
    ``"seeded"`` (largest of the first ``n_repeats`` components met by the
    degree-ordered search).
    """

    def __init__(
        self,
        works: DataFrame,
        *,
        component_rule: str = "exact",
        n_repeats: int = schemas.SEEDED_REPEATS,
        sync_date: str | None = None,
        on_bad: str = "null",
        num_partitions: int | None = None,
    ):
        if component_rule not in ("exact", "seeded"):
            raise ValueError("component_rule must be 'exact' or 'seeded'")
        self.works = works
        self.spark = works.sparkSession
        self.component_rule = component_rule
        self.n_repeats = n_repeats
        self.sync_date = sync_date
        self.on_bad = on_bad
        self.num_partitions = num_partitions

    # -- records ---------------------------------------------------------
    @cached_property
    def clean(self) -> DataFrame:
        return extract.clean_works(self.works, on_bad=self.on_bad)

    @cached_property
    def paper_index(self) -> PaperIndex:
        return extract.build_paper_index(self.clean, num_partitions=self.num_partitions)

    @property
    def n_papers(self) -> int:
        return self.paper_index.n

    @property
    def index(self) -> DataFrame:
        """``(oa_id, paper_id)`` for the kept works, staged."""
        return self.paper_index.table

    @cached_property
    def indexed(self) -> DataFrame:
        """Kept works with ``paper_id``; consumers prune the columns, none shuffles the records."""
        return extract.index_works(self.clean, self.paper_index)

    @cached_property
    def references(self) -> DataFrame:
        return extract.explode_references(self.indexed, on_bad=self.on_bad)

    @cached_property
    def authorships(self) -> DataFrame:
        """Staged: read by the author table (twice) and the paper-author links."""
        return stage(extract.explode_authorships(self.indexed, on_bad=self.on_bad), "authorships", compression="zstd")

    @cached_property
    def topics(self) -> DataFrame:
        """Staged: read by the categories (twice each) and the paper categories."""
        return stage(extract.explode_topics(self.indexed, on_bad=self.on_bad), "topics", compression="zstd")

    # -- entity tables ---------------------------------------------------
    @cached_property
    def _sources(self) -> DataFrame:
        t = tables.source_table(extract.source_occurrences(self.indexed, on_bad=self.on_bad), with_occurrences=True)
        return stage(t, "source_table")

    @cached_property
    def source_table(self) -> DataFrame:
        return self._sources.select(*tables.SOURCE_COLUMNS)

    def _metadata(self, indexed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
        smap = self.source_table.select(F.col("openalex_source_id").alias("oa_source_id"), "source_id")
        if smap.count() <= tables.BROADCAST_ROWS:
            return extract.paper_metadata(indexed, smap, broadcast_map=True, carry=carry)
        hot = tables.hot_from_counts(self._sources, "openalex_source_id", "__src")
        return extract.paper_metadata(indexed, smap, hot=hot, carry=carry)

    @cached_property
    def metadata(self) -> DataFrame:
        return self._metadata(self.indexed)

    @cached_property
    def _authors(self) -> DataFrame:
        return stage(tables.author_table(self.authorships, with_occurrences=True), "author_table")

    @cached_property
    def author_table(self) -> DataFrame:
        return self._authors.select(*tables.AUTHOR_COLUMNS)

    @cached_property
    def paper_author_net(self) -> DataFrame:
        hot = tables.hot_from_counts(self._authors, "openalex_author_id", "oa_author_id")
        return stage(tables.paper_author_net(self.authorships, self.author_table, hot=hot), "paper_author_net")

    @cached_property
    def category_table(self) -> DataFrame:
        return stage(tables.category_table(self.topics), "category_table")

    @cached_property
    def paper_category_table(self) -> DataFrame:
        return stage(tables.paper_category_table(self.topics, self.category_table), "paper_category")

    @cached_property
    def abstracts(self) -> DataFrame:
        return extract.abstracts(self.indexed)

    # -- graph -----------------------------------------------------------
    @cached_property
    def resolved(self) -> DataFrame:
        """``(src, dst, n)``: every resolved reference pair with its multiplicity, staged."""
        return stage(graph.resolved_references(self.references, self.paper_index), "resolved_references")

    @cached_property
    def citation_net(self) -> DataFrame:
        return graph.citation_net(self.resolved)

    @property
    def vertices(self) -> DataFrame:
        """Every paper: ids are dense, so nothing is read."""
        return self.spark.range(self.n_papers).withColumnRenamed("id", "paper_id")

    @cached_property
    def labels(self) -> DataFrame:
        """``(paper_id, component)`` for every paper, staged."""
        return stage(graph.connected_components(self.vertices, self.citation_net), "components")

    @cached_property
    def degrees(self) -> DataFrame:
        return graph.undirected_degree(self.vertices, self.citation_net)

    @cached_property
    def component_summary(self) -> DataFrame:
        return stage(graph.component_summary(self.labels, self.degrees), "component_summary")

    @cached_property
    def lcc_exact(self) -> DataFrame:
        return graph.largest_component_exact(self.labels)

    @cached_property
    def lcc_seeded(self) -> DataFrame:
        return graph.largest_component_seeded(self.component_summary, self.n_repeats)

    @cached_property
    def chosen_component(self) -> DataFrame:
        return self.lcc_exact if self.component_rule == "exact" else self.lcc_seeded

    @cached_property
    def flags(self) -> DataFrame:
        return graph.flag_members(self.labels, self.chosen_component)

    @cached_property
    def connected(self) -> RankBitmap:
        """The papers of the chosen component: the flag of the paper table, and the component dataset's paper ids."""
        return lcc.kept_papers(self.flags)

    def paper_table_plan(self) -> DataFrame:
        """Metadata plus ``is_connected``, a bit of the component's bitmap: the records meet no table of flags."""
        return tables.paper_table(lcc.flagged(self.metadata, self.connected))

    @cached_property
    def paper_table(self) -> DataFrame:
        """``paper_table_plan``, staged: it is written, checked and handed to the component dataset."""
        return stage(self.paper_table_plan(), "paper_table")

    # -- checks and registry --------------------------------------------
    def venue_validation(self) -> DataFrame:
        return validate.venue_validation(self.paper_table, self.source_table)

    def completeness(self) -> DataFrame:
        return validate.completeness(self.metadata, self.index)

    def registry_papers(self) -> DataFrame:
        return lcc.registry_papers(self.index.withColumnRenamed("oa_id", "openalex_id"))

    def registry_authors(self) -> DataFrame:
        return lcc.registry_authors(self.author_table)

    def registry_meta(self) -> DataFrame:
        return lcc.registry_meta(self.spark, self.n_papers, self.author_table.count(), self.sync_date)

    def counters(self) -> DataFrame:
        """Job counters: kept papers, resolved citation links, authorship links,
        authors, sources, topic rows, abstracts, and the ids that were dropped
        because they are no number. Links and sizes are counted from what the outputs are made of, so that
        nothing is resolved, exploded or (once the texts are written) rebuilt again."""
        counts = validate.dataset_counts(
            {
                "n_papers": self.n_papers,
                "n_authorship_links": self.authorships,
                "n_authors": self.author_table,
                "n_sources": self.source_table,
                "n_topics": self.topics,
                "n_abstracts": self.abstracts,
                "n_citation_edges": self.citation_net,
                "n_paper_author_edges": self.paper_author_net,
            }
        )
        links = self.resolved.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).scalar()
        bad = extract.bad_id_counts(self.works, self.clean)
        return bad.select(
            *[counts.select(c).scalar().alias(c) for c in counts.columns], links.alias("n_citation_links"), *bad.columns)

    def outputs(self) -> dict[str, DataFrame]:
        """The unfiltered dataset: table name -> DataFrame."""
        return {
            "paper_table": self.paper_table,
            "citation_net": self.citation_net,
            "author_table": self.author_table,
            "paper_author_net": self.paper_author_net,
            "category_table": self.category_table,
            "paper_category_table": self.paper_category_table,
            "abstracts": self.abstracts,
            "source_table": self.source_table,
            "registry_papers": self.registry_papers(),
            "registry_authors": self.registry_authors(),
            "registry_meta": self.registry_meta(),
        }


class LccBuild:
    """Restriction of unfiltered tables to papers with ``is_connected = 1``."""

    def __init__(self, t: dict[str, DataFrame], *, sync_date: str | None = None, keep_flag: bool = False,
                 renumber_categories: bool = False, flags: DataFrame | None = None, kept: RankBitmap | None = None):
        """``keep_flag`` keeps ``is_connected`` on the papers; ``renumber_categories``
        makes class ids contiguous (the reference code keeps the old ids).
        ``kept`` (the kept papers) or ``flags`` ``(paper_id, is_connected)``, when the
        unfiltered build is at hand, spares reading the flag back from the written paper table."""
        self.t = t
        self.sync_date = sync_date
        self.keep_flag = keep_flag
        self.renumber_categories = renumber_categories
        self.flags = flags
        self.kept = kept

    @cached_property
    def kept_papers(self) -> RankBitmap:
        if self.kept is not None:
            return self.kept
        return lcc.kept_papers(self.flags if self.flags is not None else self.t["paper_table"])

    @cached_property
    def paper_map(self) -> DataFrame:
        """``(old_id, new_id)`` of the kept papers."""
        return self.kept_papers.members()

    @cached_property
    def papers(self) -> DataFrame:
        return lcc.lcc_papers(self.t["paper_table"], self.kept_papers, keep_flag=self.keep_flag)

    @cached_property
    def citation_net(self) -> DataFrame:
        return lcc.lcc_citation_net(self.t["citation_net"], self.kept_papers)

    @cached_property
    def _pa_old_authors(self) -> DataFrame:
        return lcc.lcc_paper_author_net(self.t["paper_author_net"], self.kept_papers)

    @cached_property
    def kept_authors(self) -> RankBitmap:
        return lcc.kept_authors(self._pa_old_authors)

    @cached_property
    def author_map(self) -> DataFrame:
        """``(old_id, new_id)`` of the kept authors."""
        return self.kept_authors.members()

    @cached_property
    def paper_author_net(self) -> DataFrame:
        return rank_lookup(self._pa_old_authors, self.kept_authors, "author_id")

    @cached_property
    def author_table(self) -> DataFrame:
        return lcc.lcc_author_table(self.t["author_table"], self.kept_authors)

    @cached_property
    def _pcat_old_classes(self) -> DataFrame:
        return lcc.lcc_paper_category(self.t["paper_category_table"], self.kept_papers)

    @cached_property
    def _categories_old_ids(self) -> DataFrame:
        return lcc.lcc_category_table(self.t["category_table"], self._pcat_old_classes)

    @cached_property
    def _renumbered(self) -> tuple[DataFrame, DataFrame]:
        cmap = lcc.category_map(self._categories_old_ids)
        return lcc.renumber_categories(self._categories_old_ids, self._pcat_old_classes, cmap)

    @cached_property
    def paper_category_table(self) -> DataFrame:
        return self._renumbered[1] if self.renumber_categories else self._pcat_old_classes

    @cached_property
    def category_table(self) -> DataFrame:
        return self._renumbered[0] if self.renumber_categories else self._categories_old_ids

    @cached_property
    def abstracts(self) -> DataFrame:
        return lcc.lcc_abstracts(self.t["abstracts"], self.kept_papers)

    @cached_property
    def source_table(self) -> DataFrame:
        return lcc.lcc_source_table(self.t["source_table"], self.papers)

    def registry_papers(self) -> DataFrame:
        return lcc.registry_papers(self.papers)

    def registry_authors(self) -> DataFrame:
        return lcc.registry_authors(self.author_table)

    def registry_meta(self) -> DataFrame:
        return lcc.registry_meta(self.papers.sparkSession, self.kept_papers.n, self.kept_authors.n, self.sync_date)

    def outputs(self) -> dict[str, DataFrame]:
        return {
            "paper_table": self.papers,
            "citation_net": self.citation_net,
            "author_table": self.author_table,
            "paper_author_net": self.paper_author_net,
            "category_table": self.category_table,
            "paper_category_table": self.paper_category_table,
            "abstracts": self.abstracts,
            "source_table": self.source_table,
            "registry_papers": self.registry_papers(),
            "registry_authors": self.registry_authors(),
            "registry_meta": self.registry_meta(),
        }
