"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from boxstar.plans.registered import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((0, "") if x is None else (1, repr(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:6] == ["season", "role", "role_rank", "player", "tier", "historical_percentile"]
    df.collect()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = _sorted([tuple(_norm(r[c]) for c in cols) for r in sdf.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = _sorted([tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()])
    assert len(srows) == len(drows)
    assert srows == drows
