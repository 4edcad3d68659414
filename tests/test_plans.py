"""Physical plans: column pruning reaches the scans, and the id machinery has
no unpartitioned window (a single task over all rows)."""

import re

from pyspark.sql import functions as F

from paperweave.operators import extract, tables
from paperweave.plans.catalog import context


def _plan(df):
    # a fresh projection: an executed adaptive plan would print its initial
    # plan a second time, after the final one
    fresh = df.select(*df.columns)
    return fresh._jdf.queryExecution().executedPlan().toString()


def _scans(plan):
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_derived_tables_read_only_their_columns(spark, sf_small):
    b = context(spark, sf_small).build
    assert "id,type,abstract_inverted_index" in _scans(_plan(b.abstracts))
    assert "id,type,authorships" in _scans(_plan(extract.explode_authorships(b.indexed).select("paper_id", "oa_author_id")))
    assert "id,type,referenced_works" in _scans(_plan(extract.explode_references(b.indexed)))
    # the paper index is read as its two numbers only
    assert _scans(_plan(b.index)) == ["oa_id,paper_id"]


def _shuffles(plan):
    return [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line and "ReusedExchange" not in line]


def test_no_exchange_of_works(spark, sf_small):
    """Works meet their paper_id in the scan: no record is shuffled for references, authorships, topics, metadata, abstracts."""
    b = context(spark, sf_small).build
    for df in (extract.explode_references(b.indexed), extract.explode_authorships(b.indexed), extract.explode_topics(b.indexed),
               b.metadata, b.abstracts, b.paper_table_plan()):
        assert not _shuffles(_plan(df)), _plan(df)


def test_works_are_staged_where_the_index_is_too_large(spark, sf_small):
    """Beyond the byte limit of the broadcast, the works meet the index once; what is derived reads the staged records."""
    from paperweave.operators.rank import BROADCAST_BYTES_CONF
    from paperweave.plans.build import UnfilteredBuild

    small = context(spark, sf_small).build
    spark.conf.set(BROADCAST_BYTES_CONF, "0")
    try:
        b = UnfilteredBuild(context(spark, sf_small).works)
        assert "paper_id,referenced_works" in ",".join(sorted(_scans(_plan(b.references))[0].split(",")))
        for df in (b.references, explode_a := extract.explode_authorships(b.indexed), extract.explode_topics(b.indexed), b.abstracts):
            assert not _shuffles(_plan(df))
        assert b.citation_net.exceptAll(small.citation_net).isEmpty() and b.citation_net.count() == small.citation_net.count()
        assert explode_a.exceptAll(extract.explode_authorships(small.indexed)).isEmpty()
        assert b.paper_table.exceptAll(small.paper_table).isEmpty()
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)


def test_component_tables_meet_no_map(spark, sf_small):
    """Filter and renumbering are a lookup: no sort-merge join in the component's tables, no map sorted."""
    lb = context(spark, sf_small).lcc
    for df in (lb.papers, lb.citation_net, lb.paper_author_net, lb.author_table, lb.paper_category_table, lb.abstracts):
        assert "SortMergeJoin" not in _plan(df) and not _shuffles(_plan(df)), _plan(df)


def test_counters_need_no_nested_loop(spark, sf_small):
    b = context(spark, sf_small).build
    plan = _plan(b.counters())
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "referenced_works" not in _plan(b.citation_net)


def test_sorted_sinks_need_no_sampling(spark, sf_small):
    """Dense ids give the range bounds: the written order comes from one exchange by id, not from a sampled range."""
    from paperweave.sources.tables import by_dense_id

    b = context(spark, sf_small).build
    plan = _plan(by_dense_id(b.paper_table, "paper_id", b.n_papers).sortWithinPartitions("paper_id"))
    assert "rangepartitioning" not in plan and len(_shuffles(plan)) == 1


def test_no_single_task_window(spark, sf_small):
    b = context(spark, sf_small).build
    for df in (b.index, b.author_table, b.paper_author_net, b.citation_net, b.abstracts, b.metadata):
        plan = _plan(df)
        for line in plan.splitlines():
            if "Window [" in line:
                assert "partitionBy" in line or "PARTITION BY" in line.upper() or re.search(r"\], \[\w", line), line


def test_paper_table_reads_wide_records_once(spark, sf_small):
    b = context(spark, sf_small).build
    scans = _scans(_plan(b.paper_table_plan()))
    wide = [s for s in scans if s.startswith("id,type,title")]
    assert len(wide) == 1, scans


def test_first_occurrences_need_no_sort_aggregate(spark, sf_small):
    b = context(spark, sf_small).build
    occurrences = b.authorships.groupBy("oa_author_id").agg(F.min("first"))
    assert "SortAggregate" not in _plan(occurrences)
    assert "SortAggregate" not in _plan(tables.category_table(b.topics))
    assert dict(b.authorships.dtypes)["first"] == dict(b.topics.dtypes)["first"] == "bigint"


def test_staged_folders_are_discarded_unless_read(spark):
    import os

    from paperweave.session import discard, stage, staged_paths

    with staged_paths() as paths:
        a, b = stage(spark.range(5), "spent"), stage(spark.range(7), "read")
        result = b.filter("id > 1")
    stage(spark.range(3), "outside")
    assert len(paths) == 2 and a.count() == 5
    discard(spark, paths, result)
    local = [p.removeprefix("file:") for p in paths]
    assert [os.path.exists(p) for p in local] == [False, True] and result.count() == 5


def test_staging_and_sinks_leave_no_shuffle_files(spark, tmp_path):
    import time

    from paperweave.session import SPENT_SHUFFLES_CONF, stage
    from paperweave.sources.tables import write_table

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    before, rows = shuffles(), spark.range(1000).repartition(3, "id")
    stage(rows, "spent")
    write_table(rows, str(tmp_path / "t"), "csv", sort_by=["id"])
    for _ in range(50):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(SPENT_SHUFFLES_CONF) == "false"


def test_orders_and_lines_travel_with_plain_columns(spark, sf_small):
    from paperweave.session import SORTED_GROUPS_CONF, switched_on
    from paperweave.sources.fixture import works_fixture

    with switched_on(spark, SORTED_GROUPS_CONF):
        plan = _plan(works_fixture(spark, sf_small))
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    # the lines of an order are grouped as they come, once
    assert plan.count("collect_list(line") == 1 and "ObjectHashAggregate(keys=[k" not in plan
    # the texts of an order are made above the joins with its text and lines
    assert plan.count("Work, ") == 1 and plan.index("Work, ") < plan.index("Join [k")


def test_first_rows_are_fetched_without_a_shuffle_while_they_are_few(spark):
    from paperweave.operators.tables import fetch_firsts

    rows = spark.range(1000).select(F.col("id").alias("first"), (F.col("id") % 7).alias("key"))
    firsts = rows.groupBy("key").agg(F.min("first").alias("first")).select("first")
    expected = {(i, i) for i in range(7)}
    for most in (7, 6):
        assert {(r["first"], r["key"]) for r in fetch_firsts(rows, firsts, "few", most).collect()} == expected


def test_abstract_lookup_searches_the_components_once(spark, sf_small):
    from paperweave.plans.catalog import QUERIES
    from paperweave.session import staged_paths

    with staged_paths() as paths:
        found = QUERIES["abstract_lookup"](spark, f"{sf_small}/../sf0.001")  # a context of its own
    assert sum("/components-" in p for p in paths) == 1 and sum("/paper_table-" in p for p in paths) == 1
    assert found.columns == ["paper_id", "abstract"]
