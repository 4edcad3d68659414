"""Merkle audit, registered queries, the pipeline as a whole."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperweave.llm import merkle_audit as ma
from paperweave.llm import oracle, quality_rules
from paperweave.llm.queries import QUERIES

from paperweave.session import stage

from ..test_oracle import _digest


def _records(spark, rows):
    return spark.createDataFrame(rows, "file string, ordinal long, begin long, finish long, record_id long, payload string")


def _archive(n, files=("a", "b"), change=None, drop=(), extra=()):
    rows = []
    for f in files:
        at = 0
        for i in range(n):
            text = f"record {f} {i}"
            if (f, i) not in drop:
                rows.append((f, i, at, at + len(text), i, (change or {}).get((f, i), text)))
            at += len(text)
        rows += [(f, n + k, at, at + 1, None, "x") for ff, k in extra if ff == f]
    return rows


@pytest.mark.parametrize("n", [1, 16, 17, 300])
def test_audit_finds_exactly_the_damage(spark, n):
    change = {("a", n - 1): "spoiled", ("b", n // 2): None}
    first = _records(spark, _archive(n, files=("a", "b", "gone")))
    second = _records(spark, _archive(n, change=change, drop={("a", 0)} if n > 1 else (), extra=[("b", 0)]))
    height = ma.tree_height(first, second)
    got = {(r["file"], r["ordinal"]): r["status"] for r in ma.audit(ma.build_tree(first, height), ma.build_tree(second, height)).collect()}
    want = {("a", n - 1): "corrupt", ("b", n // 2): "corrupt", ("b", n): "extra", **{("gone", i): "missing" for i in range(n)}}
    if n > 1:
        want[("a", 0)] = "missing"
    assert got == want


def test_audit_reads_only_differing_branches(spark):
    first = _records(spark, _archive(300))
    second = _records(spark, _archive(300, change={("a", 5): "spoiled"}))
    trees = [ma.build_tree(x, ma.tree_height(first)) for x in (first, second)]
    roots = ma._differing(trees[0][-1], trees[1][-1]).collect()
    assert [(r["file"], r["node"]) for r in roots] == [("a", 0)]
    assert ma.audit(*trees).count() == 1
    assert ma.audit(trees[0], trees[0]).count() == 0


def test_records_of_odd_pages(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", "x"), (1, "http://a/", "x"), (None, None, None), (2, "http://é/", "ü" * 100_000)], "page_id long, url string, html string"
    ).withColumn("node", F.lit("clash"))
    rows = ma.warc_records(pages).orderBy("file", "ordinal").collect()
    assert [(r["file"], r["ordinal"]) for r in rows] == [("pages-0.warc", 0), ("pages-0.warc", 1), ("pages-0.warc", 2), ("pages-none.warc", 0)]
    assert all(r["finish"] - r["begin"] == len(r["payload"].encode()) for r in rows)
    empty = ma.warc_records(pages.limit(0))
    tree = ma.build_tree(empty, ma.tree_height(empty))
    assert ma.audit(tree, tree).count() == 0


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = QUERIES[name](spark, sf_small)
    res = con.execute(oracle.oracle_sql()[name])
    columns, expected = [d[0] for d in res.description], res.fetchall()
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(expected)
    assert _digest(rows, df.columns) == _digest(expected, columns)


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def _stage_inputs(spark, sf_dir, docs):
    """Every stage applied, with what went in and what came out."""
    out = []
    for name, step in corpus_pipeline.STAGES:
        result = stage(step(spark, docs, sf_dir), name)  # written and read again, as run() does
        out.append((name, docs, result))
        docs = result
    return out


def test_pipeline_stages(spark, sf_small):
    docs = stage(spark.read.parquet(f"{sf_small}/documents.parquet").limit(100), "docs")
    runs = {n: (a, b) for n, a, b in _stage_inputs(spark, sf_small, docs)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_jaccard", "mixing", "packing"]
    for name in list(runs)[:-1]:
        assert runs[name][1].columns == docs.columns, name
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    before, after = runs["quality_rules"]
    kept = {r["doc_id"] for r in quality_rules.quality_verdicts(before).filter("kept").collect()}
    assert ids(after) == Counter(kept)
    before, after = runs["exact_dedup"]
    first = {}
    for r in sorted(before.collect(), key=lambda r: (-len(r["text"]), r["doc_id"])):
        first.setdefault(re.sub("[\x20\x09-\x0D]", "", r["text"]), r["doc_id"])
    assert ids(after) == Counter(first.values())
    before, after = runs["ngram_jaccard"]
    from .test_text_ops import _join_model, _target_model

    model = _join_model([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == Counter(i for i, _, c in model if i == c)
    before, after = runs["mixing"]
    words = lambda r: len(re.findall("[^\x20\x09-\x0D]+", r["text"]))
    sizes, taken = Counter(), Counter()
    for r in before.collect():
        sizes[r["source"]] += words(r)
    for r in after.collect():
        taken[r["source"]] += words(r)
    for s, t in _target_model(sizes).items():
        assert abs(taken[s] - t) <= max(words(r) for r in before.collect() if r["source"] == s), s
    assert max(ids(after).values()) <= 3
    before, after = runs["packing"]
    assert Counter({r["doc_id"]: r["sum(length)"] // r["max(doc_tokens)"] for r in after.groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")).collect()}) == ids(before)


def test_pipeline_on_odd_tables(spark, documents, clashing):
    """Nulls, repeated rows and identifiers, clashing names and an empty table through all stages."""
    prose = " ".join(f"word{i} and other{i % 7} things" for i in range(60))
    rows = [(1, prose), (1, prose), (1, prose + " more"), (None, prose + " else"), (2, None), (3, ""), (None, None), (4, "short"),
            (5, " ".join(f"only{i} one{i % 11} here" for i in range(80)), None, None), (6, "x " * 50_000)]
    names = (*clashing, "__row", "__sha", "__chars", "__r", "__copies", "copies", "id", "c", "path", "_metadata")
    for table in (rows, []):
        docs = documents(table, names)
        columns = docs.columns
        for name, step in corpus_pipeline.STAGES:
            out = stage(step(spark, docs, ""), name)
            found = out.collect()
            if name != "packing":
                assert out.columns == columns, name
                assert all(r[c] == "clash" for r in found for c in names), name
            if name == "ngram_jaccard":
                assert len({r["doc_id"] for r in found}) == len(found) == (2 if table else 0), found
            docs = out
        assert bool(found) == bool(table)


def test_rows_are_numbered_by_their_place(spark, documents):
    from paperweave.llm.common import ROW, numbered

    table = stage(documents([(i, f"text {i}") for i in range(40)]).repartition(5), "docs")
    one, two = ({r["doc_id"]: r[ROW] for r in numbered(d).collect()} for d in (table, table.select("doc_id", "text")))
    assert one == two and len(set(one.values())) == 40
    assert numbered(documents([(1, "a")])).columns[-1] == ROW


def test_subpackage_is_optional():
    """Nothing outside the subpackage and its entry guard imports it."""
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for top, _, files in os.walk(os.path.join(root, "paperweave")):
        if os.path.basename(top) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(top, f)) as source:
                    assert not re.search(r"\bllm\b", source.read()), f


