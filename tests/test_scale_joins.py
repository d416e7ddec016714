"""Bucketed tables, hot keys, day ranges and the document index."""

import datetime
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from memberscope.operators import hot_keys, range_members, tags
from memberscope.plans import catalog
from memberscope.sources import document_index as di
from memberscope.sources.bucketed import MemberCatalog
from memberscope.sources.tables import Domain


def test_tag_join_has_no_exchange(spark):
    d = Domain(spark, SF_SMALL)
    tables = MemberCatalog(spark, prefix="plan_test_").write(d, buckets=4)
    try:
        out = tables.member_tags(catalog.FREE_COUPON_ID)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
        assert plan.count("Join") >= 8
        key = lambda df: sorted(map(repr, df.collect()))
        assert key(out) == key(catalog._tag_table(spark, SF_SMALL).select(out.columns))
        some = tables.purchases("2024-01-05", "2024-01-08")
        text = some._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in text
        assert some.count() == d.purchase.where(
            "create_time >= '2024-01-05' and create_time < '2024-01-08'").count() > 0
    finally:
        tables.drop()


def facts(spark, n=20_000):
    """A third of the rows hold one key."""
    return spark.range(n).select(
        F.col("id").alias("m"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997 + 100).alias("k"))


def test_hot_keys_are_found(spark):
    assert hot_keys.hot_keys(facts(spark), "k", 0.01) == [7]
    assert hot_keys.hot_keys(facts(spark).limit(0), "k") == []
    with pytest.raises(ValueError):
        hot_keys.hot_keys(facts(spark), "k", 0.00001)


def test_isolated_join_splits_the_hot_key_without_adaptive_plans(spark):
    f = facts(spark).unionByName(spark.createDataFrame([(-1, None), (-2, 5)], "m long, k long"))
    dim = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("price")).where("k <> 5")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("false", "-1", "16")):
            spark.conf.set(k, v)
        joined = hot_keys.isolated_join(f, dim, "k", "m", share=0.01)
        most = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert most(joined) < 3500 < 6667 <= most(f.join(dim, "k", "left"))
        key = lambda df: sorted(map(repr, df.select("m", "k", "price").collect()))
        assert key(joined) == key(f.join(dim, "k", "left"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_charge_money_with_a_hot_coupon(spark):
    held = facts(spark, 6000).select(F.col("m").alias("member_id"), F.col("k").alias("coupon_id"),
                                     F.lit(2).alias("coupon_channel"))
    coupon = spark.range(1200).select("id", (F.col("id") / 4).alias("coupon_price"))
    plain = tags.tag_charge_money(held, coupon)
    apart = tags.tag_charge_money(held, coupon, hot_share=0.01)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, apart.collect()))


def test_cover_is_the_range(spark):
    rows = [(a, a + n) for a in (-9, 0, 3, 19737, 20000) for n in (0, 1, 2, 7, 30, 400)]
    for levels in (0, 3, 9):
        df = spark.createDataFrame(rows, "a int, b int")
        for r in df.select("a", "b", range_members.cover(F.col("a"), F.col("b"), levels).alias("c")).collect():
            days = sorted(d for lv, n in r.c for d in range(n << lv, (n + 1) << lv))
            assert days == list(range(r.a, r.b))
            assert levels < 9 or len(r.c) <= 2 * levels + 1


def test_active_members_match_plain_counts(spark, tmp_path):
    r = random.Random(4)
    rows = [(r.choice((r.randrange(300), 10**12 + r.randrange(50), -5, None)),
             r.choice((None, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=r.randrange(60 * 24 * 50)))))
            for _ in range(4000)]
    events = spark.createDataFrame(rows, "u long, ts timestamp_ntz")
    asked = [(i, datetime.date(2023, 12, 28) + datetime.timedelta(r.randrange(60)), r.randrange(-2, 45)) for i in range(30)]
    asked = [(i, a, a + datetime.timedelta(n)) for i, a, n in asked] + [(0, asked[0][1], asked[0][1])]
    ranges = spark.createDataFrame(asked, "rangeId long, start date, end date")
    tree = range_members.build(events, "u", "ts", str(tmp_path / "tree"))
    got = {(x.rangeId, x.start, x.end): x.members for x in range_members.active_members(tree, ranges, salt=3).collect()}
    for i, a, b in asked:
        assert got[i, a, b] == len({u for u, t in rows if u is not None and t is not None and a <= t.date() < b})
    empty = range_members.build(events.limit(0), "u", "ts", str(tmp_path / "empty"))
    assert {x.members for x in range_members.active_members(empty, ranges).collect()} == {0}


SCHEMA = "memberId long, name string, tags array<string>, money decimal(10,2)"


def test_index_replaces_keeps_and_removes(spark, tmp_path):
    path = str(tmp_path / "index")
    frame = lambda rows: spark.createDataFrame(rows, "memberId long, name string, tags array<string>, money string"
                                               ).withColumn("money", F.col("money").cast("decimal(10,2)")).repartition(3)
    read = lambda: {r.memberId: (r.name, r.tags, str(r.money)) for r in di.read_index(spark, path, SCHEMA).collect()}
    first = frame([(i, f"n{i}", ["a", None], "1.50") for i in range(20)] + [(None, "nobody", [], "0")])
    with pytest.raises(Exception, match="no index"):
        di.write_index(first, path)          # nothing is created on its own
    di.create_index(path)
    assert read() == {}
    di.write_index(first, path)
    di.write_index(first, path)              # repeated
    assert read() == {i: (f"n{i}", ["a", None], "1.50") for i in range(20)}
    di.write_index(frame([(3, "new", [], "2.00"), (50, "more", ["é"], "3.00")]), path, mode="append")
    assert read()[3] == ("new", [], "2.00") and read()[50] == ("more", ["é"], "3.00") and len(read()) == 21
    di.write_index(frame([(3, "last", [], "2.00")]), path)   # vanished members go
    assert read() == {3: ("last", [], "2.00")}
    with pytest.raises(ValueError):
        di.write_index(frame([(1, "a", [], "1"), (1, "b", [], "1")]), path)


def test_a_failed_write_leaves_the_index(spark, tmp_path):
    path = str(tmp_path / "index")
    di.create_index(path)
    good = spark.range(10).select(F.col("id").alias("memberId"), F.lit("ok").alias("name"))
    di.write_index(good, path)
    before = open(os.path.join(path, di.SETTINGS)).read()
    fails = F.when(F.col("memberId") == 7, F.raise_error(F.lit("boom"))).otherwise(F.lit("bad"))
    bad = spark.range(0, 10, 1, 5).select(F.col("id").alias("memberId")).withColumn("name", fails.cast("string"))
    writer = di.IndexWriter(path, "memberId", True)
    with pytest.raises(Exception):
        spark.dataSource.register(di.DocumentIndex)
        bad.write.format(di.FORMAT).mode("overwrite").option("path", path).save()
    assert open(os.path.join(path, di.SETTINGS)).read() == before
    assert di.read_index(spark, path, "memberId long, name string").where("name = 'ok'").count() == 10
    live = {s["name"] for s in json.loads(before)["segments"]}
    left = {f for f in os.listdir(path) if f.endswith(".jsonl")}
    assert live <= left and not [f for f in left if f.startswith(".")]
    message = writer.write(iter([good.first()]))
    writer.abort([message, None])            # what a task wrote is taken away
    assert not os.path.exists(os.path.join(path, message.name))


def test_ranges_of_the_same_days_share_one_count(spark, tmp_path, monkeypatch):
    day = datetime.date(2024, 1, 1)
    events = spark.createDataFrame([(u, datetime.datetime(2024, 1, 1 + u % 5, 3)) for u in range(50)], "u long, ts timestamp_ntz")
    tree = range_members.build(events, "u", "ts", str(tmp_path / "tree"))
    at = lambda n: day + datetime.timedelta(days=n)
    # all days, and more than all: one set of members; no days; unknown days
    rows = [(i, at(-i % 7), at(5 + i % 9)) for i in range(40)] + [(None, at(1), at(3)), (90, at(3), at(3)), (91, at(8), at(9)),
                                                               (92, None, at(2)), (93, at(1), None)]
    covered = []
    plain = range_members.cover
    monkeypatch.setattr(range_members, "cover", lambda *a: covered.append(a) or plain(*a))
    out = range_members.active_members(tree, spark.createDataFrame(rows, "rangeId long, start date, end date"), salt=2)
    want = {r: sum(1 for u in range(50) if r[1] and r[2] and r[1] <= at(u % 5) < r[2]) for r in rows}
    assert {(r.rangeId, r.start, r.end): r.members for r in out.collect()} == want
    assert len(covered) == 1 and "_low" in str(covered[0][0])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_low" in plan and "_id" not in plan
