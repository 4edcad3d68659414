"""dense_id, dedupe_latest and lookup_ids."""

from pyspark.sql import functions as F

from paperweave.operators.ids import dedupe_latest, dense_id, lookup_ids


def test_dense_id_contiguous_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"), F.lit("x").alias("payload"))
    out = dense_id(df, "k", "rid", num_partitions=7).collect()
    pairs = sorted((r["k"], r["rid"]) for r in out)
    assert [p[1] for p in pairs] == list(range(5000))
    assert all(r["payload"] == "x" for r in out)


def test_dense_id_composite_key(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (2, "a"), (1, "a")], "a int, b string")
    out = sorted((r["rid"], r["a"], r["b"]) for r in dense_id(df, ["a", "b"], "rid", num_partitions=3).collect())
    assert out == [(0, 1, "a"), (1, 1, "z"), (2, 2, "a"), (3, 2, "b")]


def test_dense_id_empty(spark):
    df = spark.createDataFrame([], "k bigint")
    assert dense_id(df, "k", "rid").count() == 0


def test_dedupe_latest(spark):
    df = spark.createDataFrame([(1, 10, "old"), (1, 20, "new"), (2, 5, "only"), (1, 15, "mid")], "k int, o int, v string")
    got = sorted(tuple(r) for r in dedupe_latest(df, "k", "o").collect())
    assert got == [(1, 20, "new"), (2, 5, "only")]
    clean = spark.createDataFrame([(1, 1), (2, 2)], "k int, o int")
    assert dedupe_latest(clean, "k", "o") is clean


def test_lookup_ids(spark):
    idx = spark.createDataFrame([(100, 0), (200, 1)], "oa_id bigint, paper_id bigint")
    refs = spark.createDataFrame([(7, 200), (7, 999)], "src bigint, ref bigint")
    inner = [tuple(r) for r in lookup_ids(refs, idx, "ref", out="dst").collect()]
    assert inner == [(7, 200, 1)]
    left = sorted(tuple(r) for r in lookup_ids(refs, idx, "ref", out="dst", keep_missing=True).collect())
    assert left == [(7, 200, 1), (7, 999, -1)]


def test_dedupe_latest_hot_key(spark):
    spark.conf.set("spark.paperweave.hotKeyRows", "5")
    try:
        rows = [(7, i, f"v{i}") for i in range(40)] + [(8, 1, "x"), (9, 3, "a"), (9, 4, "b")]
        df = spark.createDataFrame(rows, "k int, o int, v string")
        got = sorted(tuple(r) for r in dedupe_latest(df, "k", "o").collect())
        assert got == [(7, 39, "v39"), (8, 1, "x"), (9, 4, "b")]
    finally:
        spark.conf.unset("spark.paperweave.hotKeyRows")
