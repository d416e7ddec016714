"""Refreshes through the file ledger: the stored table equals a rebuild after
new files, late rows, rewritten and removed files."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from memberscope.operators import growth
from memberscope.plans import catalog, refresh
from memberscope.sources.ledger import Ledger
from memberscope.sources.tables import Domain, LoadedTables, purchases, registrations


def events(ids, day0, days, seed):
    r = random.Random(seed)
    for i in ids:
        day = datetime.datetime(2024, 1, day0) + datetime.timedelta(days=r.randrange(days), hours=r.randrange(24))
        yield (i, day, r.randrange(40), r.choice(("signup", "purchase", "view")), float(r.randrange(1000)), '{"k": %d}' % (i % 7))


SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_growth_line_follows_files(spark, tmp_path):
    def write(name, rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "ev" / name))

    def state(*names):
        return spark.read.schema(SCHEMA).parquet(*[str(tmp_path / "ev" / n) for n in names])

    book, path = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "rollup")

    def refreshed(t):
        out = refresh.refresh_growth(registrations(t), purchases(t), book, path, {"events": (t, "ts")})
        rebuilt = growth.daily_rollup(registrations(t), purchases(t))
        key = lambda df: sorted(tuple(r) for r in df.select(rebuilt.columns).collect())
        assert key(out) == key(rebuilt)
        line = lambda df: [tuple(r) for r in growth.growth_from_rollup(df, "2024-01-28", 27).collect()]
        assert line(out) == line(rebuilt)
        return out

    write("a", events(range(300), 1, 10, 1))
    write("b", events(range(300, 500), 8, 10, 2))
    refreshed(state("a", "b"))
    write("late", events(range(500, 520), 2, 2, 3))       # late rows of old days
    write("only", [(900, datetime.datetime(2024, 1, 25, 3), 1, "signup", 1.0, "{}")])
    refreshed(state("a", "b", "late", "only"))
    stored = {p.name for p in (tmp_path / "rollup").iterdir() if p.name.startswith("d=")}
    before = {n: max(f.stat().st_mtime_ns for f in (tmp_path / "rollup" / n).iterdir()) for n in stored}
    out = refreshed(state("a", "b", "late"))              # a day loses all its rows
    assert out.where("d = '2024-01-25'").count() == 0
    after = {n: max(f.stat().st_mtime_ns for f in (tmp_path / "rollup" / n).iterdir()) for n in stored}
    assert {n for n in stored if after[n] != before[n]} == {"d=2024-01-25"}  # nothing else was written
    write("b", events(range(300, 450), 12, 6, 4))         # a file rewritten
    refreshed(state("a", "b", "late"))
    assert not any(k.count() for k in book.changes({"events": (state("a", "b", "late"), F.col("ts"))}).keys.values())


def test_a_refresh_that_dies_is_found_again(spark, tmp_path):
    t = spark.createDataFrame(list(events(range(50), 1, 5, 1)), SCHEMA)
    t.write.parquet(str(tmp_path / "ev"))
    table = spark.read.schema(SCHEMA).parquet(str(tmp_path / "ev"))
    book = Ledger(spark, str(tmp_path / "ledger"))
    first = book.changes({"events": (table, F.col("user_id"))})   # never committed
    again = book.changes({"events": (table, F.col("user_id"))})
    key = lambda c: sorted(r.key for r in c.keys["events"].collect())
    assert key(first) == key(again) == sorted({str(r.user_id) for r in t.collect()})
    book.commit(again)
    assert book.changes({"events": (table, F.col("user_id"))}).keys["events"].count() == 0


@pytest.fixture(scope="module")
def staged(spark):
    return catalog._Staged(spark, "/root/testdata/sf0.001", {
        "customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id",
        "part": "p_partkey"})


def test_tag_table_follows_files(spark, staged, tmp_path):
    book, path = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "tags")

    def refreshed(tables):
        d = Domain(spark, tables=LoadedTables(**tables))
        out = refresh.refresh_tags(d, book, path, {
            n: (tables[n], key, what) for n, (key, what) in catalog.TAG_SOURCES.items()}, buckets=8)
        whole = refresh.tag_table(d)
        key = lambda df: sorted(map(repr, df.select(whole.columns).collect()))
        assert key(out) == key(whole)
        return out.where("memberId < 0").count()

    assert refreshed(staged.first) > 0 == refreshed(staged.second)  # withdrawn members are gone
    third = dict(staged.second, orders=staged.first["orders"])
    refreshed(third)


def test_only_touched_members_are_rebuilt(spark, staged, tmp_path):
    tables = dict(staged.second)
    extra = str(tmp_path / "more")
    tables["events"].where("user_id = 7").limit(3).withColumn("event_id", F.col("event_id") + 10**6).write.parquet(extra)
    book, path = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "tags")
    sources = lambda t: {n: (t[n], key, what) for n, (key, what) in catalog.TAG_SOURCES.items()}
    refresh.refresh_tags(Domain(spark, tables=LoadedTables(**tables)), book, path, sources(tables), buckets=8)
    files = {str(f) for f in (tmp_path / "tags").rglob("part-*")}
    base = staged.base + "/events/"
    more = dict(tables, events=spark.read.schema(tables["events"].schema).parquet(base + "early", base + "late", extra))
    d = Domain(spark, tables=LoadedTables(**more))
    changed = book.changes({n: (t, F.col(k)) for n, (t, k, _) in sources(more).items()})
    touched = refresh.touched_members(d, changed.keys, {n: what for n, (_, what) in catalog.TAG_SOURCES.items()})
    assert [r.m for r in touched.collect()] == [7]
    refresh.refresh_tags(d, book, path, sources(more), buckets=8)
    kept = {str(f) for f in (tmp_path / "tags").rglob("part-*")} & files
    assert 0 < len(files - kept) <= 1 and len(kept) >= 6  # one bucket was written


def test_keys_travel_without_their_files_paths(spark, tmp_path, monkeypatch):
    spark.createDataFrame(list(events(range(60), 1, 5, 1)), SCHEMA).repartition(3).write.parquet(str(tmp_path / "ev"))
    table = spark.read.schema(SCHEMA).parquet(str(tmp_path / "ev"))
    book, seen = Ledger(spark, str(tmp_path / "ledger")), {}
    plain = Ledger._scratch
    monkeypatch.setattr(Ledger, "_scratch", lambda self, df, name: seen.setdefault(name, df) and plain(self, df, name))
    changes = book.changes({"events": (table, F.col("user_id"))})
    assert seen["keys"].columns == ["source", "no", "key"]
    book.commit(changes)
    kept = spark.read.parquet(str(tmp_path / "ledger" / "keys"))
    want = {(r.f, str(r.user_id)) for r in table.select(F.col("_metadata.file_path").alias("f"), "user_id").collect()}
    assert {(r.file, r.key) for r in kept.collect()} == want and kept.count() == len(want)
