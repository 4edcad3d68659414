"""Structural properties of the built datasets and dense ids."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperweave.operators.ids import dense_id
from paperweave.plans.catalog import context


def _ids(df, col):
    return [r[0] for r in df.select(col).orderBy(col).collect()]


def test_unfiltered_properties(spark, sf_small):
    b = context(spark, sf_small).build
    n = b.index.count()
    assert _ids(b.index, "paper_id") == list(range(n))
    oa = [r[0] for r in b.index.orderBy("paper_id").select("oa_id").collect()]
    assert oa == sorted(oa) and len(set(oa)) == n
    e = b.citation_net
    assert e.filter((F.col("src") == F.col("dst")) | (F.col("src") >= n) | (F.col("dst") >= n)).count() == 0
    assert e.distinct().count() == e.count()
    # component labels are constant along every edge
    lab = b.labels
    s = e.join(lab.withColumnRenamed("paper_id", "src").withColumnRenamed("component", "cs"), "src")
    s = s.join(lab.withColumnRenamed("paper_id", "dst").withColumnRenamed("component", "cd"), "dst")
    assert s.filter(F.col("cs") != F.col("cd")).count() == 0
    # a label is the smallest member of its component
    assert lab.groupBy("component").agg(F.min("paper_id").alias("m")).filter("m != component").count() == 0
    m = b.author_table.count()
    assert _ids(b.author_table, "author_id") == list(range(m))
    pa = b.paper_author_net
    assert pa.filter((F.col("author_id") >= m) | (F.col("paper_id") >= n)).count() == 0


def test_lcc_tables_closed(spark, sf_small):
    lb = context(spark, sf_small).lcc
    n = lb.papers.count()
    assert _ids(lb.papers, "paper_id") == list(range(n))
    e = lb.citation_net
    assert e.filter((F.col("src") >= n) | (F.col("dst") >= n)).count() == 0
    m = lb.author_table.count()
    assert _ids(lb.author_table, "author_id") == list(range(m))
    assert lb.paper_author_net.join(lb.author_table, "author_id", "left_anti").count() == 0
    assert lb.author_table.join(lb.paper_author_net, "author_id", "left_anti").count() == 0
    used = lb.paper_category_table.select(F.col("main_class_id").alias("class_id")).unionByName(
        lb.paper_category_table.select(F.col("sub_class_id").alias("class_id"))
    ).filter("class_id != -1")
    assert used.join(lb.category_table, "class_id", "left_anti").count() == 0
    srcs = lb.papers.select("source_id").filter("source_id != -1")
    assert srcs.join(lb.source_table, "source_id", "left_anti").count() == 0
    assert lb.abstracts.filter(F.col("paper_id") >= n).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=0, max_size=300, unique=True),
       st.integers(min_value=1, max_value=9))
def test_dense_id_is_rank(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r["k"]: r["rid"] for r in dense_id(df, "k", "rid", num_partitions=parts).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_lcc_options_keep_flag_and_renumber(spark, sf_small):
    from paperweave.plans.build import LccBuild

    ctx = context(spark, sf_small)
    plain = ctx.lcc
    lb = LccBuild(ctx.build.outputs(), keep_flag=True, renumber_categories=True)
    assert "is_connected" in lb.papers.columns
    assert lb.papers.filter("is_connected != 1").count() == 0
    n = lb.category_table.count()
    assert n == plain.category_table.count()
    assert _ids(lb.category_table, "class_id") == list(range(n))
    # same assignments, expressed in the new ids: map old -> new by openalex_id and type
    old = {(r["type"], r["openalex_id"]): r["class_id"] for r in plain.category_table.collect()}
    new = {(r["type"], r["openalex_id"]): r["class_id"] for r in lb.category_table.collect()}
    o2n = {old[k]: new[k] for k in old}
    o2n[-1] = -1
    want = sorted((r[0], o2n[r[1]], o2n[r[2]], r[3]) for r in plain.paper_category_table.collect())
    got = sorted(tuple(r) for r in lb.paper_category_table.collect())
    assert got == want
