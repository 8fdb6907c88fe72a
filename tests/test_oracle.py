"""Every registered query equals its DuckDB oracle on the smallest tables."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from jobsift.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


_DUCK_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP",
              "date": "DATE", "double": "DOUBLE", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}


def test_every_query_of_the_library_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: _DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel = duck.sql(E.oracle_sql()[name])
    assert stypes == dict(zip(rel.columns, map(str, rel.types)))
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["time_when_scraped", "link"]
    rows = df.collect()
    assert len(rows) > 0
    ts = [r["time_when_scraped"] for r in rows]
    assert ts == sorted(ts, reverse=True)


@pytest.mark.parametrize("name", ["jobs_per_day", "jobs_per_week", "recency_filter", "result_set_file_name",
                                  "first_file_wins", "ingest_outcome"])
def test_time_queries_ignore_the_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(E.oracle_sql()[name])
    assert _digest(df.columns, rows) == _digest([d[0] for d in res.description], res.fetchall())
