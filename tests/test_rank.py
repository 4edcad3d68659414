"""Rank bitmap: membership and positions against a sorted list; hot rows, null and negative ids, both join ways."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paperweave.operators.rank import BROADCAST_BYTES_CONF, rank_bitmap, rank_lookup


def _lookup(spark, members, ids, missing=None, **conf):
    bm = rank_bitmap(spark.createDataFrame([(i,) for i in members], "id bigint"), "id")
    df = spark.createDataFrame([(i, f"r{k}") for k, i in enumerate(ids)], "id bigint, tag string")
    got = {r["tag"]: r["id"] for r in rank_lookup(df, bm, "id", missing=missing).collect()}
    return bm, got


def _model(members, ids, missing=None):
    at = {v: k for k, v in enumerate(sorted({m for m in members if m is not None}))}
    return {f"r{k}": at.get(i, missing) for k, i in enumerate(ids) if i in at or missing is not None}


MEMBERS = [0, 1, 63, 64, 65, 32767, 32768, 32769, 100_000, 100_000, 5_000_000_000, 5_000_000_063, None]
IDS = MEMBERS + [2, 62, 66, 32766, 99_999, 100_001, 4_999_999_999, 10**12, -1, -64, -(1 << 40)]


@pytest.mark.parametrize("missing", [None, -1])
@pytest.mark.parametrize("limit", ["100000000", "0"])
def test_lookup_both_ways(spark, missing, limit):
    spark.conf.set(BROADCAST_BYTES_CONF, limit)
    try:
        bm, got = _lookup(spark, MEMBERS, IDS, missing)
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)
    assert bm.n == 11 and bm.blocks == 4
    assert got == _model(MEMBERS, IDS, missing)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 70_000), max_size=60), st.lists(st.integers(0, 70_000), max_size=60))
def test_random_sets(spark, members, ids):
    assert _lookup(spark, members, ids + members)[1] == _model(members, ids + members)


def test_empty_set_and_members(spark):
    bm, got = _lookup(spark, [], [1, None], -1)
    assert bm.n == 0 and got == {"r0": -1, "r1": -1}
    rnd = random.Random(3)
    ids = sorted(rnd.sample(range(200_000), 5000))
    bm = rank_bitmap(spark.createDataFrame([(i,) for i in ids], "id bigint"), "id")
    assert sorted(tuple(r) for r in bm.members().collect()) == [(v, k) for k, v in enumerate(ids)]


def test_hot_row_is_salted(spark):
    """A third of all rows ask for one id; beyond the byte limit the join is salted, with equal results."""
    spark.conf.set(BROADCAST_BYTES_CONF, "0")
    spark.conf.set("spark.paperweave.hotKeyRows", "50")
    try:
        ids = [7] * 300 + [random.Random(i).randrange(90_000) for i in range(600)]
        members = [7, *range(0, 90_000, 3)]
        assert _lookup(spark, members, ids)[1] == _model(members, ids)
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)
        spark.conf.unset("spark.paperweave.hotKeyRows")


def test_negative_members_fail(spark):
    with pytest.raises(Exception, match="no negative ids"):
        rank_bitmap(spark.createDataFrame([(-3,)], "id bigint"), "id")
