"""Whole jobs on the works derived from sf0.001, written as a snapshot and scanned back."""

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperweave import oracle, schemas
from paperweave.plans.job import build_lcc, build_unfiltered, read_unfiltered
from paperweave.session import staging_path
from paperweave.sources.fixture import works_fixture
from paperweave.sources.works import scan_works, write_works
from paperweave.sources import tables as io

from .test_oracle import TABLES


def _oracle_counts(sf_dir, *names):
    """Row counts by the independent SQL."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return [len(con.execute(oracle.oracle_sql()[n]).fetchall()) for n in names]


def test_snapshot_job_properties(spark, sf_small):
    n_papers, n_lcc, n_edges, n_lcc_authors = _oracle_counts(sf_small, "paper_table", "lcc_papers", "citation_net", "lcc_author_table")
    raw = staging_path(spark, "test_raw")
    write_works(works_fixture(spark, sf_small), raw)
    out = staging_path(spark, "test_out") + "/ds"
    b = build_unfiltered(scan_works(spark, raw), out, sync_date="2024-05-01")
    assert b.index.count() == n_papers
    lb = build_lcc(spark, out, sync_date="2024-05-01")

    u = read_unfiltered(spark, out)
    papers = u["paper_table"]
    assert papers.count() == n_papers
    assert papers.agg(F.sum("is_connected")).first()[0] == n_lcc
    ids = [r[0] for r in papers.select("paper_id").orderBy("paper_id").collect()]
    assert ids == list(range(n_papers))
    oa = [r[0] for r in papers.orderBy("paper_id").select("openalex_id").collect()]
    assert oa == sorted(oa)
    e = u["citation_net"]
    assert e.count() == n_edges
    assert e.filter("src = dst").count() == 0
    assert e.distinct().count() == e.count()

    lp = io.read_table(spark, f"{out}/paper_table.csv", fmt="csv", schema=schemas.PAPER_METADATA)
    assert lp.count() == n_lcc
    le = io.read_graph(spark, f"{out}/citation_net")[0]
    assert le.filter((F.col("src") >= n_lcc) | (F.col("dst") >= n_lcc)).count() == 0
    la = io.read_table(spark, f"{out}/author_table.csv", "author_table", "csv")
    assert la.count() == n_lcc_authors
    assert [r[0] for r in la.orderBy("author_id").select("author_id").collect()] == list(range(n_lcc_authors))
    meta = spark.read.parquet(f"{out}/registry/meta").first()
    assert (meta["n_papers"], meta["n_authors"], meta["sync_date"]) == (n_lcc, n_lcc_authors, "2024-05-01")
    shape = spark.read.parquet(f"{out}/citation_net/shape").first()
    assert (shape["n_rows"], shape["n_cols"]) == (n_lcc, n_lcc)
    labs = spark.read.parquet(f"{out}/abstracts.parquet")
    assert [r[0] for r in labs.collect()] == sorted(r[0] for r in labs.collect())
    # the written files, in file order, hold their rows in table order
    def written(path, fmt, *keys):
        name = path.rsplit("/", 1)[1].removesuffix(".csv")
        # the filtered papers carry no flag column
        schema = schemas.PAPER_METADATA if path == f"{out}/paper_table.csv" else schemas.TABLES.get(name)
        df = io.read_table(spark, path, fmt=fmt, schema=schema) if fmt == "csv" else spark.read.parquet(path)
        rows = df.select(F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i"), *keys).collect()
        return [tuple(r[2:]) for r in sorted(rows, key=lambda r: (r[0], r[1]))]

    for base in (out, out + "_unfiltered"):
        for name, keys in (("paper_table", ["paper_id"]), ("author_table", ["author_id"]), ("category_table", ["class_id"]),
                           ("paper_category_table", ["paper_id", "sequence"]), ("source_table", ["source_id"])):
            got = written(f"{base}/{name}.csv", "csv", *keys)
            assert got == sorted(got), (base, name)
        for name, keys in (("papers", ["openalex_id"]), ("authors", ["author_id"])):
            got = written(f"{base}/registry/{name}", "parquet", *keys)
            assert got == sorted(got), (base, name)
    # the paper map from the staged flags equals the one read back from the CSV
    from paperweave.plans.build import LccBuild

    via_flags = LccBuild(read_unfiltered(spark, out), flags=b.flags).paper_map
    assert sorted(tuple(r) for r in via_flags.collect()) == sorted(tuple(r) for r in lb.paper_map.collect())


def test_csv_fails_on_a_cell_that_does_not_fit(spark, tmp_path):
    (tmp_path / "t.csv").write_text("paper_id,title\nseven,x\n")
    with pytest.raises(Exception):
        io.read_table(spark, str(tmp_path / "t.csv"), fmt="csv", schema=T.StructType.fromDDL("paper_id bigint, title string")).collect()


def test_csv_keeps_quotes_commas_newlines_and_white_space(spark):
    edge = [(3, " a ", "trail "), (4, "\tq\t", "   "), (5, " a, b ", "x")]
    df = spark.createDataFrame([(1, 'a, "b"\nc', None), (2, "", "x"), *edge], "paper_id bigint, title string, doi string")
    path = staging_path(spark, "test_csv")
    io.write_table(df, path, "csv")
    back = io.read_table(spark, path, fmt="csv", schema=T.StructType.fromDDL("paper_id bigint, title string, doi string"))
    rows = sorted(tuple(r) for r in back.collect())
    assert rows == [(1, 'a, "b"\nc', None), (2, None, "x"), *edge]


def _scanned_rows(df):
    """Rows that the scans of an executed frame handed on."""
    df.collect()
    total, queue = 0, [df._jdf.queryExecution().executedPlan()]
    while queue:
        node = queue.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            queue.append(node.executedPlan())
            continue
        if "FileSourceScan" in node.getClass().getSimpleName():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return total


def test_abstract_lookup_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "abstracts")
    texts = spark.range(40_000).select((F.col("id") * 3).alias("paper_id"), F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 512)).alias("abstract"))
    io.write_abstracts(texts.repartition(5), path, global_sort=True, n_papers=120_000, row_group_bytes=64 << 10)
    wanted = [3, 4, 5, 30_000, 119_997, 119_998, 500_000, None]
    ids = spark.createDataFrame([(i,) for i in wanted + wanted], "p bigint")
    found = io.lookup_abstracts(spark, path, ids)
    assert sorted(r["paper_id"] for r in found.collect()) == [3, 30_000, 119_997]
    assert 0 < _scanned_rows(found) < 20_000
    joined = io.lookup_abstracts(spark, path, ids, point_ids=2)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, found.collect()))
    assert io.lookup_abstracts(spark, path, ids.limit(0)).count() == 0


def test_dense_ranges_follow_the_ids(spark, monkeypatch):
    monkeypatch.setattr(io, "LEAST_ROWS", 10)
    df = spark.range(1000).select((999 - F.col("id")).alias("paper_id")).filter("paper_id % 3 <> 0").repartition(7)
    parts = io.by_dense_id(df, "paper_id", 1000).sortWithinPartitions("paper_id").select("paper_id", F.spark_partition_id().alias("p")).collect()
    rows = [r["paper_id"] for r in sorted(parts, key=lambda r: r["p"])]
    assert rows == sorted(rows) and len(rows) == 666 and len({r["p"] for r in parts}) > 1
    assert io.by_dense_id(df.limit(0), "paper_id", 0).count() == 0


def _published(spark, out):
    from paperweave.sources import publish

    return publish.published(spark, out)


def test_failed_run_leaves_the_old_dataset(spark, tmp_path, monkeypatch):
    """A run that fails while it writes, or between the renames, leaves the old dataset whole and readable."""
    from paperweave.plans import job
    from paperweave.sources import publish

    out = str(tmp_path / "ds")
    frames = {
        "paper_table": "paper_id bigint, title string", "author_table": "author_id bigint, name string",
        "category_table": "class_id bigint, title string", "paper_category_table": "paper_id bigint, sequence bigint",
        "source_table": "source_id bigint, type string", "citation_net": "src bigint, dst bigint",
        "paper_author_net": "paper_id bigint, author_id bigint", "abstracts": "paper_id bigint, abstract string",
        "registry_papers": "paper_id bigint, openalex_id bigint", "registry_authors": "author_id bigint, openalex_author_id bigint",
        "registry_meta": "n_papers bigint",
    }

    def outputs(value):
        return {n: spark.createDataFrame([tuple(0 if "bigint" in c else value for c in s.split(", "))], s) for n, s in frames.items()}

    def titles():
        return [r[0] for r in spark.read.option("header", "true").csv(f"{out}/paper_table.csv").select("title").collect()]

    with pytest.raises(RuntimeError, match="no published dataset"):
        _published(spark, out)
    job.write_dataset(spark, outputs("old"), out, 1, 1, global_abstract_sort=True)
    assert titles() == ["old"] and len(_published(spark, out)["tables"]) == len(job.TABLES)

    broken = outputs("new")
    broken["abstracts"] = broken["abstracts"].withColumn("abstract", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        job.write_dataset(spark, broken, out, 1, 1, global_abstract_sort=True)
    assert titles() == ["old"] and _published(spark, out)

    plain, calls = publish._rename, []

    def failing(spark_, old, new):
        calls.append(old)
        if len(calls) == 2:
            raise OSError("the driver went away")
        plain(spark_, old, new)

    monkeypatch.setattr(publish, "_rename", failing)
    with pytest.raises(OSError, match="went away"):
        job.write_dataset(spark, outputs("new"), out, 1, 1, global_abstract_sort=True)
    monkeypatch.setattr(publish, "_rename", plain)
    assert _published(spark, out) and titles() == ["old"]  # put back by the reader
    job.write_dataset(spark, outputs("new"), out, 1, 1, global_abstract_sort=True)
    assert titles() == ["new"] and not list(tmp_path.glob("ds.replaced-*"))

    (tmp_path / "ds" / "registry" / "meta").rename(tmp_path / "meta")
    with pytest.raises(RuntimeError, match="lacks registry/meta"):
        _published(spark, out)


def test_typed_copies_are_used_while_they_agree(spark, sf_small):
    out = staging_path(spark, "test_typed") + "/ds"
    b = build_unfiltered(works_fixture(spark, sf_small), out, sync_date="2024-05-01", typed=True)
    tables = read_unfiltered(spark, out)
    csv = {n: io.read_table(spark, f"{out}_unfiltered/{n}.csv", n) for n in ("paper_table", "author_table", "source_table")}
    for name, expected in csv.items():
        plan = tables[name]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "csv" not in plan.lower().replace(".csv", "")
        assert tables[name].exceptAll(expected).isEmpty() and expected.exceptAll(tables[name]).isEmpty()
    assert b.paper_table.count() == csv["paper_table"].count()
    # a CSV that somebody changed afterwards is read itself
    io.write_table(csv["author_table"].limit(3), f"{out}_unfiltered/author_table.csv", "csv")
    assert read_unfiltered(spark, out)["author_table"].count() == 3
