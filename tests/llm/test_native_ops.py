"""Quality rules, streaming dedup, host reputation."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paperweave.llm import host_reputation as hr
from paperweave.llm import quality_rules as qr
from paperweave.llm import stream_dedup as sd

WORD = re.compile("[^\x20\x09-\x0D]+")


def _stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h i j", "a b c d e a b c d e a b c d e", "x\nx\n \nx\ny", "é # * naïve\u00a0word $%&|<>\n" * 4,
    " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i % 37}" for i in range(3000)), "same " * 20_000,
]


def test_base_counts(documents, clashing):
    rows = list(enumerate(TEXTS)) + [(None, "p q r"), (3, "one"), (3, "one")]
    got = qr.quality_verdicts(documents(rows, clashing)).collect()
    assert len(got) == len(rows)
    expected = Counter((i, *_stats(t)) for i, t in rows)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in columns) for r in got) == expected
    # too few rows for an estimate: the base rule alone decides
    assert all(r["kept"] == (not r["base_failed"]) and r["distance2"] is None for r in got)


def test_outliers_are_rejected_per_group(documents):
    def clean(i, step):
        return " ".join(f"w{(i * step + 7 * j) % 9973:x}bcdef"[: 4 + (i + j) % 5] for j in range(40 + (i * step) % 160))

    rows = [(i, clean(i, 31), "en", "a") for i in range(150)] + [(1000 + i, clean(i, 17), None, None) for i in range(120)]
    odd = [(2000, re.sub(" ", "### ", clean(3, 31)), "en", "a"), (2001, re.sub(" ", "$$$ ", clean(5, 17)), None, None)]
    got = {r["doc_id"]: r for r in qr.quality_verdicts(documents(rows + odd)).collect()}
    assert not got[2000]["kept"] and not got[2001]["kept"]
    assert all(got[i]["kept"] for i, *_ in rows)
    again = {r["doc_id"]: r["distance2"] for r in qr.quality_verdicts(documents(rows + odd).repartition(7)).collect()}
    assert again == {i: r["distance2"] for i, r in got.items()}  # exact sums: any partitioning, same bits


def test_bulk_outliers_are_rejected(documents):
    def clean(i):
        return " ".join(f"w{(i * 31 + 7 * j) % 9973:x}bcdef"[: 4 + (i + j) % 5] for j in range(40 + (i * 31) % 160))

    rows = [(i, clean(i), "en", "a") for i in range(160)]
    junk = re.sub(" ", " ### ", clean(3))
    rows += [(1000 + i, junk, "en", "a") for i in range(80)]  # a third of the group, one text
    rows.append((2000, re.sub(" ", " #### ", clean(5)), "en", "a"))  # alone in the same direction
    got = {r["doc_id"]: r["kept"] for r in qr.quality_verdicts(documents(rows)).collect()}
    assert not any(got[i] for i in got if i >= 1000)
    assert sum(got[i] for i in range(160)) >= 158


def test_every_statistic_can_reach_the_cutoff():
    most = {"x_symbols": math.log1p(100), "x_dup_lines": math.log1p(100), "x_repeats": math.log1p(qr.MAX_REPEAT_PERCENT)}
    floors = dict(qr.FEATURES)
    for name, value in most.items():
        assert (value / floors[name]) ** 2 > qr.cutoff(qr.Mcd()), name


def test_chi_square():
    # table values
    assert abs(qr.chi2_quantile(0.95, 1) - 3.8415) < 1e-3
    assert abs(qr.chi2_quantile(0.99, 7) - 18.4753) < 1e-3


def test_keep_good_returns_the_documents(documents, clashing):
    df = documents([(1, TEXTS[8], "en", "a"), (2, "short"), (3, None)], clashing)
    out = qr.keep_good(df)
    assert out.columns == df.columns and [r["doc_id"] for r in out.collect()] == [1]


def test_empty_tables(documents):
    empty = documents([])
    assert qr.quality_verdicts(empty).count() == 0
    assert sd.dedup_verdicts(empty).count() == 0


def _dedup_model(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for norm, members in groups.items():
        keep = min(members)[3]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        first = True
        for m in sorted(members):
            out[(m[3], keep, len(members), first, sha)] += 1
            first = False
    return out


DEDUP_ROWS = [
    (5, "a b"), (2, "ab"), (9, "a  b "), (7, "a  b "), (1, None), (3, ""), (4, " \n"), (8, "x" * 200_000), (6, "x" * 200_000 + "\t"),
    (None, "lone"), (10, "twice"), (10, "twice"), (None, "ab"), (11, "é"), (12, "e\u0301"),
]


@pytest.mark.parametrize("files", [None, 1])
def test_dedup_against_model(documents, clashing, files):
    got = sd.dedup_verdicts(documents(DEDUP_ROWS, clashing).repartition(3), files_per_trigger=files)
    assert Counter(tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == _dedup_model(DEDUP_ROWS)


def test_dedup_checks_bytes_when_digests_collide(documents):
    # a digest of one bit: nearly everything collides
    weak = lambda norm: F.substring(F.sha2(norm, 256), 1, 1) > "7"
    got = sd.dedup_verdicts(documents(DEDUP_ROWS), digest=lambda n: weak(n).cast("string"))
    assert Counter(tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == _dedup_model(DEDUP_ROWS)


def test_drop_copies_keeps_one_row_each(documents, clashing):
    df = documents(DEDUP_ROWS, clashing)
    out = sd.drop_copies(df)
    assert out.columns == df.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect())
    kept = [(k[0] is None, k[0] or 0) for k, n in _dedup_model(DEDUP_ROWS).items() if k[3] for _ in range(n)]
    assert got == sorted(kept)


def test_repeated_rows_keep_the_first_of_the_scan(spark, documents, tmp_path):
    rows = [(7, "same text here"), (7, "same text here"), (None, "no id"), (None, "no id"), (7, "sametexthere"), (8, "own")] + [(9, "hot row")] * 40
    df = documents(rows).coalesce(1).withColumn("at", F.monotonically_increasing_id())
    df.write.parquet(str(tmp_path / "rows"))
    scan = spark.read.parquet(str(tmp_path / "rows"))
    spark.conf.set("spark.paperweave.hotKeyRows", "5")
    try:
        out = sd.drop_copies(scan)
        got = sorted((r["at"], r["doc_id"], r["text"]) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.paperweave.hotKeyRows")
    assert got == [(0, 7, "same text here"), (2, None, "no id"), (5, 8, "own"), (6, 9, "hot row")]
    assert "Window" not in plan and out.columns == df.columns


def test_hot_group_is_salted(spark, documents):
    spark.conf.set("spark.paperweave.hotKeyRows", "5")
    try:
        rows = [(i, "hot text") for i in range(40)] + [(100 + i, f"own {i}") for i in range(10)]
        got = sd.dedup_verdicts(documents(rows)).collect()
    finally:
        spark.conf.unset("spark.paperweave.hotKeyRows")
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == Counter(
        (i, 0 if i < 40 else i, 40 if i < 40 else 1, i == 0 or i >= 40) for i, _ in rows)


URLS = [
    (1, "https://WWW.Example.org/es/x?q#f", "www.example.org", "/es/x", "example.org/es/", "block"),
    (2, "http://example.org/en/1234", "example.org", "/en/1234", "example.org/en/1", "block"),
    (3, "http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "http://org", "org", "", None, "allow"),
    (5, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (6, "ftp://a.b.com/de/", "a.b.com", "/de/", "com/de/", "block"),
    (7, "mailto:x", "", "", None, "allow"),
    (8, None, "", "", None, "allow"),
    (9, "x://y://z/fr/", "y:", "//z/fr/", None, "allow"),
    (None, "https://a.com?de/", "a.com", "", None, "allow"),
]


def test_hosts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u, *_ in URLS], "page_id long, url string, html string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:5] for r in hr.judge_pages(pages, labels).collect()}
    assert got == {u[0]: u[2:] for u in URLS}


def test_reputation_shrinks_and_blocks(spark):
    rows, labels, n = [], [], 0
    for host, pages, bad in (("bad.spam.net", 60, 58), ("new.spam.net", 3, 0), ("one.fine.net", 1, 1), ("www.fine.net", 80, 2), ("a.other.net", 50, 3)):
        for i in range(pages):
            rows.append((n, f"http://{host}/p/{i}"))
            labels.append((n, int(i >= bad), 0))
            n += 1
    rows += [(n, "http://unseen.spam.net/"), (n + 1, "http://unseen.fine.net/")]
    labels += [(None, 0, 1), (0, 0, None), (0, 1, 0)]  # null ids are ignored, repeated rows count once
    out = hr.judge_pages(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    by_host = {r["host"]: r for r in out.collect()}
    assert by_host["bad.spam.net"]["verdict"] == "block"
    assert by_host["one.fine.net"]["verdict"] == "allow"  # one bad page of one: shrunk to its domain
    assert by_host["www.fine.net"]["verdict"] == by_host["unseen.fine.net"]["verdict"] == "allow"
    rate = {h: r["bad_rate"] for h, r in by_host.items()}
    assert rate["unseen.spam.net"] > 0.5 > rate["unseen.fine.net"]
    assert rate["www.fine.net"] < rate["one.fine.net"] < 1


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.z", "z", "", "u@h.example.org:8080"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [tuple(r) for r in df.select(hr.domain_of(F.col("h"), ("co.uk",)), hr.suffix_of(F.col("h"), ("co.uk",))).collect()]
    assert got[0] == ("b.co.uk", "co.uk") and got[1] == ("b.co.uk", "co.uk") and got[2] == ("co.uk", "co.uk")
    assert got[3] == ("y.z", "z") and got[4] == ("z", "z") and got[5] == ("", "")
