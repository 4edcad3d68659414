"""Whitening against exact rational covariances."""

from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from paperweave.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int"


def _grid(rows):
    return [[floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in rows]


def _covariance(x):
    n = len(x)
    mean = [Fraction(sum(c), n) for c in zip(*x)]
    centred = [[Fraction(v) - m for v, m in zip(row, mean)] for row in x]
    d = len(mean)
    return mean, [[sum(r[i] * r[j] for r in centred) / n for j in range(d)] for i in range(d)]


def _vectors(n, d, seed, spread=1.0):
    rnd = np.random.default_rng(seed)
    return (rnd.normal(size=(n, d)) @ rnd.normal(size=(d, d)) * spread + rnd.normal(size=d)).astype(np.float32).tolist()


def _check(got, ids, rows, components=32):
    x = _grid(rows)
    n, d = len(x), len(x[0])
    mean, cov = _covariance(x)
    v = np.array([[float(c) for c in row] for row in cov])
    values = np.linalg.eigvalsh(v)[::-1]
    m = min(components, d)
    assert len(got) == n * m
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    sums = [sum(c) for c in zip(*x)]
    white = []
    for i, row in zip(ids, x):
        mine = by_row[i, sum((n * c - s) ** 2 for c, s in zip(row, sums))]
        assert sorted(mine) == list(range(1, m + 1)) and all(r["n"] == n for r in mine.values())
        white.append([mine[k]["whitened"] for k in range(1, m + 1)])
    explained = [mine[k]["explained"] for k in range(1, m + 1)]
    np.testing.assert_allclose(explained, values[:m] / np.trace(v), rtol=1e-9)
    white = np.array(white)
    assert np.abs(white.T @ white / n - np.eye(m)).max() < 1e-9
    assert {r["identity_error"] for r in got} and max(r["identity_error"] for r in got) < 1e-9
    # projecting back: whitened * sqrt(e) are the coordinates along unit eigenvectors of V
    centred = np.array([[float(c - mu) for c, mu in zip(row, mean)] for row in x])
    axes = np.linalg.lstsq(white * np.sqrt(values[:m]), centred, rcond=None)[0].T
    np.testing.assert_allclose(v @ axes, axes * values[:m], atol=1e-7 * values[0])


@pytest.mark.parametrize("n,d,spread", [(40, 5, 1.0), (300, 40, 0.2), (90, 3, 5000.0)])
def test_against_exact_covariance(spark, n, d, spread):
    rows = _vectors(n, d, n, spread)
    bad = [(-1, None, 0), (-2, [None] * d, 0), (-3, [nan] + [0.0] * (d - 1), 0), (-4, [inf] * d, 0), (-5, [-inf] + [1.0] * (d - 1), 0),
           (-6, [], 0), (-7, [1.0] * (d + 1), 0), (-8, [0.5] * (d - 1) + [None], 0)]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)] + bad, SCHEMA)
    for name in ("id", "v", "d", "n", "component", "z"):
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    got = wh.whiten(df.repartition(4)).collect()
    assert [f for f in got[0].asDict()] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    _check(got, range(n), rows)


def test_popcounts_give_exact_products(monkeypatch):
    rnd = np.random.default_rng(2)
    for n in (1, 63, 64, 65, 200):
        for bits in ([3, 1, 0, 12], [40, 2]):
            y = np.array([[rnd.integers(0, 1 << b) if b else 0 for b in bits] for _ in range(n)], np.int64)
            sums, products = wh.cross_products(wh.popcounts(wh.bit_planes(y, bits)), bits)
            exact = [[int(v) for v in row] for row in y]
            assert sums == [sum(c) for c in zip(*exact)]
            for d in range(len(bits)):
                for e in range(d, len(bits)):
                    assert products[d][e - d] == sum(r[d] * r[e] for r in exact)


def test_blocks_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK_ROWS", 7)
    rows = _vectors(50, 4, 3)
    rows += rows[:10]
    ids = [None] + [i // 2 for i in range(1, 60)]
    got = wh.whiten(spark.createDataFrame([(i, v, 0) for i, v in zip(ids, rows)], SCHEMA).repartition(3)).collect()
    assert len(got) == 240 and sum(r["vec_id"] is None for r in got) == 4 and {r["n"] for r in got} == {60}
    assert max(r["identity_error"] for r in got) < 1e-9


def test_flat_tables(spark):
    make = lambda rows: spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], SCHEMA)
    assert wh.whiten(make([])).collect() == [] and wh.whiten(make([None])).collect() == []
    assert wh.whiten(make([[0.5, 1.0]])).collect() == []  # a single row has no spread
    assert wh.whiten(make([[0.5, 1.0]] * 4)).collect() == []
    line = wh.whiten(make([[float(i), 2.0 * i, 7.0] for i in range(9)])).collect()  # rank one
    assert len(line) == 9 and {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-9
    with pytest.raises(ArithmeticError):
        wh.whiten(make([[1e30, 0.0], [0.0, 1.0]]))
