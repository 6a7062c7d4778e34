"""Every registered query with an oracle agrees with DuckDB on sf0.001."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        return ("~nan",) if math.isnan(v) else ("n", round(v, 6))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", float(v))
    return ("s", str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _keys():
    import __spark_entry__ as E

    return sorted(E.oracle_sql())


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[key])
    exp = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_every_query_has_a_callable_and_entry_runs(spark):
    import __spark_entry__ as E

    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    out = E.entry(spark)
    assert out.count() > 0
