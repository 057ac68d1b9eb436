"""Every registered query with an SQL twin gives the same rows as DuckDB."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from tickforge import registry


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return None if isinstance(v, float) and math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, sf_dir, con, name):
    df = registry.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    r = con.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    want = [tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall()]
    assert len(got) == len(want)
    # Rows are paired by their exact columns first, then by rounded numbers.
    key = lambda row: ([repr(v) for v in row if not isinstance(v, float)], [f"{v:.5g}" for v in row if isinstance(v, float)], repr(row))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        for x, y in zip(a, b):
            # Integers must be equal; a fraction may differ in the last digits.
            close = (isinstance(x, float) or isinstance(y, float)) and None not in (x, y) and abs(x - y) <= 2e-6 * max(1, abs(x), abs(y))
            assert x == y or close, (name, a, b)


def test_every_twin_has_a_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
