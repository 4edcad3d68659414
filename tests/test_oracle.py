"""Every registered query against its DuckDB oracle on sf0.001."""

import hashlib
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from paperweave import oracle
from paperweave.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keys).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert all(entry.oracle_sql()[name] == sql for name, sql in oracle.oracle_sql().items())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    sdf = catalog.QUERIES[name](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(oracle.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, sdf.columns) == _digest(drows, dcols)


def test_entry_survives_without_the_training_subpackage(tmp_path):
    """A library that only the training-data operators need is missing: their queries go, all others stay."""
    code = (
        "import sys\n"
        "sys.modules['zstandard'] = None\n"
        "import __spark_entry__ as e\n"
        "from paperweave.plans import catalog\n"
        "assert set(e.queries()) == set(catalog.QUERIES) == set(e.oracle_sql())\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "is_connected" in df.columns
