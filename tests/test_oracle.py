"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from memberscope.plans import catalog, oracle  # noqa: E402
from conftest import SF_SMALL, query_frame
from memberscope.sources.tables import TABLES

QUERIES = dict(catalog.QUERIES)  # the llm package has its own tests
SQL = oracle.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)  # exact: no rounding
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return str(v)


def _bag(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck, key):
    df = query_frame(spark, key)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[key])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


DUCK_TO_SPARK = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int",
                 "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_types_match_oracle(spark, duck, key):
    """Same column types in both engines (counts BIGINT, money DECIMAL(p,s))."""
    s = {f.name: f.dataType.simpleString() for f in query_frame(spark, key).schema.fields}
    rel = duck.sql(SQL[key])
    d = {n: DUCK_TO_SPARK.get(str(t), str(t).lower()) for n, t in zip(rel.columns, rel.types)}
    assert s == d


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["day", "regCount", "memberCount", "orderCount", "gmv"]
    assert df.count() >= 0


JOIN_HEAVY = ["member_tags", "member_tags_parity", "tag_order_behavior", "tag_order_features",
              "tag_charge_money", "audience_select", "growth_daily", "growth_rollup",
              "tag_member_base"]


@pytest.mark.parametrize("key", JOIN_HEAVY)
def test_join_heavy_queries_without_broadcast(spark, duck, key):
    """The plans of large tables (every join sort-merge) give the same
    answer as the oracle."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = QUERIES[key](spark, SF_SMALL)
        s_rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    cur = duck.execute(SQL[key])
    d_cols = [c[0] for c in cur.description]
    assert _bag(df.columns, s_rows) == _bag(d_cols, cur.fetchall())
