"""Every registered query against its DuckDB statement on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from eventstar import oracle, registry
from tests.conftest import SF_SMALL

SKIP = {"stream_increment"}  # covered by test_stream.py


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SKIP))
def test_query_matches_oracle(spark, con, name):
    sdf = registry.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=key)
    rel = con.execute(oracle.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=key)
    assert srows == drows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "event_count", "avg_magnitude", "max_magnitude",
                          "min_magnitude", "tsunami_events"]
    assert df.count() > 0
