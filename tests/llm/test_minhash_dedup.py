"""MinHash near duplicates against brute-force Jaccard components."""

import random
from collections import Counter

import numpy as np
import pytest

from paperweave.llm import minhash_dedup as md


def _shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 3 else [tuple(w[j:j + 3]) for j in range(len(w) - 2)])


def _model(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None]
        least = (min(known) if known else None) if sets[i] else doc_id
        out[(doc_id, len(sets[i]), least, doc_id == least)] += 1
    return out


def _words(rnd, n):
    return ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 6))) for _ in range(n)]


def _edited(rnd, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rnd.randrange(len(out))] = _words(rnd, 1)[0]
    return out


def _family_rows(seed):
    rnd = random.Random(seed)
    texts = []
    for n in (8, 9, 12, 30, 60, 100, 200):  # originals with copies around the threshold
        base = _words(rnd, n)
        texts += [base] + [_edited(rnd, base, c) for c in (0, 1, 1, 2, 3, 4, 5, 6)]
    chain = _words(rnd, 120)
    for _ in range(25):  # neighbours link, the ends do not
        chain = _edited(rnd, chain, 2)
        texts.append(chain)
    base = _words(rnd, 100)  # a family whose first member is far from all others: the star fails, the rest links
    texts.append(_edited(rnd, base, 9))
    texts += [_edited(rnd, base, 2) for _ in range(40)]
    other = _words(rnd, 100)  # near the threshold from one another
    texts += [_edited(rnd, other, 3) for _ in range(60)]
    passage = _words(rnd, 60)
    texts += [_words(rnd, k) + passage + _words(rnd, k) for k in (3, 6, 12, 30) for _ in range(12)]
    rows = [(5 * i % 1009, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(2000, None), (2001, ""), (2002, "\n"), (2003, "a"), (2004, "A"), (2005, "a b"), (2006, "a b c"), (None, "a b"), (None, "x y z w"),
             rows[3], (2007, "z " * 4000), (2008, "z " * 4001), (2009, "é a b c d e f g h"), (2010, "É a b c d e f g h")]
    return rows


@pytest.mark.parametrize("seed,small", [(1, md.SMALL_CELL), (2, 2)])
def test_components_against_all_pairs(documents, clashing, monkeypatch, seed, small):
    monkeypatch.setattr(md, "SMALL_CELL", small)
    rows = _family_rows(seed)
    got = md.near_duplicates(documents(rows, clashing + ("c", "x", "sig", "bands", "cell")).repartition(3)).collect()
    assert Counter(map(tuple, got)) == _model(rows)


def test_hot_buckets_are_salted(spark, documents):
    spark.conf.set("spark.paperweave.hotKeyRows", "10")
    try:
        rows = _family_rows(3)[40:160]
        got = md.near_duplicates(documents(rows)).collect()
    finally:
        spark.conf.unset("spark.paperweave.hotKeyRows")
    assert Counter(map(tuple, got)) == _model(rows)


def test_empty_table(documents):
    assert md.near_duplicates(documents([])).collect() == []
    assert [tuple(r) for r in md.near_duplicates(documents([(1, None), (None, "one two")])).orderBy("n_shingles").collect()] == [
        (1, 0, 1, True), (None, 1, None, True)]


def test_bins_agree_as_often_as_sets_are_similar():
    rnd = np.random.default_rng(5)
    for size in (6, 20, 100, 1000):
        agree = []
        for _ in range(300):
            common = rnd.integers(0, 2**64, size * 17 // 20 + 1, np.uint64)
            own = [rnd.integers(0, 2**64, max(1, size - len(common)), np.uint64) for _ in range(2)]
            a, b = (np.unique(np.concatenate([common, o])) for o in own)
            similar = len(common) / (len(common) + len(own[0]) + len(own[1]))
            agree.append((md.bin_values(a) == md.bin_values(b)).mean() - similar)
        assert abs(np.mean(agree)) < 0.02


def test_one_token_fills_all_bins():
    token = np.array([12345], np.uint64)
    assert (md.bin_values(token) == token[0]).all()


def test_differences():
    x, c = (np.sort(np.array(v, np.uint64)) for v in ([1, 2, 3, 4, 5, 6, 7, 8, 20], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]))
    linked, apart = md.differences(x, c)
    assert not linked and sorted(apart.tolist()) == [9, 10, 20]
    assert md.differences(x, x)[0] and len(md.differences(x, x)[1]) == 0
