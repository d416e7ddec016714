"""Removal of frequent lines: limits that do not rise with the host, and the
registered SQL on a table where lines are removed."""

import duckdb

import corpus_pipeline
from memberscope.llm import line_quality, queries

LONG = " ".join(f"licence{k}" for k in range(60))


def body(i):
    return f"body {i} " + " ".join(f"u{i}w{k}" for k in range(70))


def test_pipeline_limits_do_not_rise_with_the_host(spark):
    rows = [(i, ("A Shared footer line\n" if i < 21 else "") + body(i), "big") for i in range(1200)]
    rows += [(2000 + i, f"{LONG}\n{body(2000 + i)}", "small") for i in range(5)]
    rows += [(3000 + i, f"{LONG}\n{body(3000 + i)}", "four") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.quality(spark, docs, "").collect()}
    assert len(got) == len(rows)
    assert sorted(i for i, t in got.items() if "footer" in t) == [0]
    assert sorted(i for i, t in got.items() if "licence0" in t) == [2000, 3000, 3001, 3002, 3003]


def test_sql_agrees_where_lines_are_removed(spark, tmp_path):
    rows = [(i, "a shared footer line of many words here\n" + (body(i) if i % 3 else f"few words {i} a b c d"),
             "s" if i % 2 else None) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(queries.ORACLE_SQL["op7_line_frequency"])
    got = line_quality.line_quality(docs).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    assert line_quality.frequent_lines(docs).count() == 2
    # 30 of 90 are few words; document 0, one of them, is the first holder of its host
    assert sum(not r.kept and not r.base_failed for r in got) == 29
