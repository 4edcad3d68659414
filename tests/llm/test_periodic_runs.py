"""Periodic runs against the definition, word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from paperweave.llm import periodic_runs as pr


def _runs_model(w):
    """Every run straight from the definition: all lags, all stretches, smallest period by trial."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            start, length = i, j - i + q
            stretch = w[start:start + length]
            smallest = not any(stretch[d:] == stretch[:-d] for d in range(1, q))
            if smallest and length >= max(6, 4 * q):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _plant_model(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def _report_model(doc_id, text):
    w = _plant_model(doc_id, re.findall("[^\x20\x09-\x0D]+", text or ""))
    runs = _runs_model(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None,) * 4
    for s, length, q in runs:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q, 1000 * length // q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def _random_words(rnd):
    kind = rnd.randrange(6)
    if kind == 0:
        return [rnd.choice("ab") for _ in range(rnd.randint(0, 80))]
    if kind == 1:
        return [rnd.choice("abc") for _ in range(rnd.randint(0, 120))]
    if kind == 2:  # powers of powers
        w = [rnd.choice("ab") for _ in range(rnd.randint(1, 4))]
        for _ in range(3):
            w = w * rnd.randint(1, 5) + [rnd.choice("abc")] * rnd.randint(0, 2)
        return w[:400]
    if kind == 3:  # a cycle inside prose
        w = [f"w{rnd.randrange(50)}" for _ in range(rnd.randint(0, 100))]
        c = [f"c{rnd.randrange(8)}" for _ in range(rnd.randint(1, 12))]
        return w + (c * rnd.randint(2, 7))[:rnd.randint(1, 80)] + w[:20]
    if kind == 4:
        return ["a"] * rnd.randint(0, 60) + ["b"] * rnd.randint(0, 8) + ["a"] * rnd.randint(0, 8)
    a, b = ["a"], ["a", "b"]
    for _ in range(rnd.randint(1, 7)):
        a, b = b, b + a
    return b * rnd.randint(1, 6)


@pytest.mark.parametrize("seed", range(4))
def test_runs_follow_the_definition(seed):
    rnd = random.Random(seed)
    for _ in range(500):
        w = _random_words(rnd)
        assert pr.text_runs([x.encode() for x in w]) == _runs_model(w)


def test_small_steps_find_the_same(monkeypatch):
    monkeypatch.setattr(pr, "PAIRS", 7)
    rnd = random.Random(9)
    for _ in range(200):
        w = _random_words(rnd)
        assert pr.text_runs([x.encode() for x in w]) == _runs_model(w)


def test_equal_hashes_of_different_words_are_no_run(monkeypatch):
    monkeypatch.setattr(pr, "_powers", lambda n: np.ones(n, np.uint64))  # the hash no longer sees the order
    rnd = random.Random(10)
    for _ in range(200):
        w = _random_words(rnd)
        assert pr.text_runs([x.encode() for x in w]) == _runs_model(w)


def test_splitting_leaves_no_rare_word():
    rnd = random.Random(3)
    for _ in range(200):
        w = np.array([rnd.randrange(12) for _ in range(rnd.randint(1, 200))])
        for b, e in pr.segments(w, np.bincount(w, minlength=12)):
            assert e - b >= 6 and min(np.unique(w[b:e], return_counts=True)[1]) >= 4


def test_long_texts_stay_cheap():
    w = [b"a"] * 200_000
    assert pr.text_runs(w) == [(0, 200_000, 1)]
    cycle = [b"%d" % i for i in range(40_000)]
    assert pr.text_runs(cycle * 5) == [(0, 200_000, 40_000)]
    rnd = random.Random(4)
    two = [rnd.choice((b"a", b"b")) for _ in range(100_000)]
    assert all(n >= max(6, 4 * q) for _, n, q in pr.text_runs(two))


def _rows():
    rnd = random.Random(8)
    rows = [(i, " ".join(_random_words(rnd))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "a"), (None, "x y " * 9), (1004, "a a " * 7), (1004, "a a " * 7),
             (1005, "é ü\x1c " * 3000), (1006, "ha " * 40 + "end"), (-7, "go on " * 20)]
    return rows


def test_report_against_model(documents, clashing):
    got = pr.run_report(pr.planted(documents(_rows(), clashing).repartition(3))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    assert sorted(map(tuple, got), key=key) == sorted((_report_model(*r) for r in _rows()), key=key)


def test_find_runs_keeps_columns_and_texts(documents):
    out = pr.find_runs(documents([(1, "so so so so so so it is"), (2, None)], ("runs", "n_runs")))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_runs", "runs", "collapsed"]
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"], r["n_runs"]) for r in out.collect()}
    assert got == {1: ([(0, 6, 1)], "so it is", "clash"), 2: ([], "", "clash")}
    assert pr.run_report(documents([])).count() == 0
