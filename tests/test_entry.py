import math

import duckdb

import __spark_entry__ as E
from keyledger.plans.oracle import ORACLE_SQL
from keyledger.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "events", "documents"]


def _norm(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "otherId", "username", "verifiedPhone"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _key(row):
    return tuple((x is None, "" if x is None else type(x).__name__, 0 if x is None else x) for x in row)


def test_every_query_matches_duckdb_on_sf0001(spark):
    con = duckdb.connect()
    for t in ["customer", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, SF)
        got = sorted((tuple(map(_norm, r)) for r in df.collect()), key=_key)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(df.columns), name
        idx = [cols.index(c) for c in df.columns]
        want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
        assert got == want, name
        assert len(got) > 0, name
