"""The bitmap index against the scan form of selections and facets."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from memberscope.functions import bitmaps
from memberscope.functions.rules import Rule, compile_rules
from memberscope.operators import audience, bitmap_index

SCHEMA = ("memberId long, phone string, sex string, channel int, subOpenId string, address int, regTime string, "
          "orderCount long, orderTime string, orderMoney decimal(38,2), favGoods array<long>, freeCouponTime string, "
          "couponTimes array<string>, chargeMoney decimal(38,3), overTime long, feedBack int")


def tag_rows(n=700, seed=3):
    r = random.Random(seed)
    day = lambda: (datetime.date(2024, 1, 1) + datetime.timedelta(r.randrange(60))).isoformat()
    maybe = lambda x: None if r.random() < 0.2 else x
    for i in range(n):
        yield (r.choice((i, i * 7 - 900, i * 10**9)), f"p{i}", maybe(r.choice("abc")), maybe(r.randrange(4)),
               maybe(r.choice(("null", "x"))), maybe(r.randrange(-1, 3)), maybe(day()), maybe(r.randrange(9)), maybe(day()),
               maybe(r.randrange(100_000) / 100), maybe([r.randrange(12) for _ in range(r.randrange(4))]), maybe(day()),
               maybe([maybe(day()) for _ in range(r.randrange(3))]), maybe(r.randrange(10_000) / 1000),
               maybe(r.randrange(-500, 5000)), maybe(r.randrange(1, 5)))


@pytest.fixture(scope="module")
def tag_table(spark):
    import decimal
    rows = {r[0]: r for r in tag_rows()}
    fixed = [tuple(decimal.Decimal(str(v)) if isinstance(v, float) else v for v in r) for r in rows.values()]
    return spark.createDataFrame(fixed, SCHEMA).cache()


@pytest.fixture(scope="module")
def index(tag_table, tmp_path_factory):
    return bitmap_index.build(tag_table, str(tmp_path_factory.mktemp("index")), bins=8)


RULES = [
    Rule("a", "sex", "a", "match"), Rule("b", "sex", "b", "match"), Rule("no", "subOpenId", "null", "notMatch"),
    Rule("goods", "favGoods", "3", "match"), Rule("not goods", "favGoods", "4", "notMatch"),
    Rule("typed", "channel", "02", "match"), Rule("bad value", "channel", "x", "match"),
    Rule("none", "sex", "zzz", "match"), Rule("registered", "regTime", "", "exists"),
    Rule("has goods", "favGoods", "", "exists"), Rule("since", "regTime", "2024-01-31", "rangeGte"),
    Rule("early", "regTime", "2000-01-01", "rangeGte"), Rule("late", "regTime", "2030-01-01", "rangeGte"),
    Rule("again", "orderCount", "2", "rangeGte"), Rule("money", "orderMoney", "100-500.5", "rangeBoth"),
    Rule("one value", "orderCount", "3-3", "rangeBoth"), Rule("empty", "orderCount", "5-3", "rangeBoth"),
    Rule("negative", "overTime", "-100-900", "rangeBoth"), Rule("charge", "chargeMoney", "0.5", "rangeGte"),
    Rule("days", "orderTime", "2024-01-10-2024-01-20", "rangeBoth"),
    Rule("coupon day", "couponTimes", "2024-01-15", "match"), Rule("coupons", "couponTimes", "2024-02-01", "rangeGte"),
    Rule("goods range", "favGoods", "3-6", "rangeBoth"), Rule("feedback", "feedBack", "2", "match"),
]


@pytest.mark.parametrize("keep_null", [True, False])
def test_facets_equal_the_scan(index, tag_table, keep_null):
    key = lambda r: (r.label, r.name, r.value, r.type, r.members)
    got = [key(r) for r in index.facets(RULES, keep_null).collect()]
    want = [key(r) for r in audience.tag_facets(tag_table, RULES, keep_null).collect()]
    assert got == want
    assert sum(0 < r[4] < tag_table.count() for r in got) >= 18


@pytest.mark.parametrize("keep_null", [True, False])
def test_selections_equal_the_scan(index, tag_table, keep_null):
    rng = random.Random(8)
    picks = [*(rng.sample(RULES, rng.randrange(2, 6)) for _ in range(6)), []]
    told = tag_table.select("memberId", *[compile_rules(rules, tag_table.schema, keep_null).alias(f"p{i}")
                                          for i, rules in enumerate(picks)]).collect()
    for i, rules in enumerate(picks):
        got = sorted(r.memberId for r in index.select(rules, keep_null).collect())
        assert got == sorted(r.memberId for r in told if r[f"p{i}"]), rules
    assert index.count(RULES[:4], keep_null).first().members == audience.audience_select(
        tag_table, RULES[:4], keep_null).count()


def test_bad_rules_are_refused(index):
    with pytest.raises(ValueError):
        index.select([Rule("x", "phone", "1", "match")])
    with pytest.raises(ValueError):
        index.facets([Rule("x", "orderMoney", "many", "rangeGte")])


def test_members_round_trip(spark):
    ids = [0, 1, 63, 64, -1, -64, -65, 2**62, -2**62, 12345678901]
    df = spark.createDataFrame([(i,) for i in ids], "memberId long")
    words = df.groupBy(bitmaps.word_of(F.col("memberId")).alias("word")).agg(
        F.bit_or(bitmaps.bit_of(F.col("memberId"))).alias("bits"))
    assert sorted(r.memberId for r in bitmaps.members(words).collect()) == sorted(ids)


def test_selection_reads_only_its_bitmaps(index):
    plan = index.select([RULES[0], RULES[13]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan
    assert "phone" not in plan and "CartesianProduct" not in plan


def test_empty_table(spark, tag_table, tmp_path):
    empty = bitmap_index.build(tag_table.limit(0), str(tmp_path / "i"))
    assert empty.select([RULES[0]]).count() == 0 and empty.select([]).count() == 0
    assert {r.members for r in empty.facets(RULES).collect()} == {0}


def test_words_are_written_where_their_members_meet(spark, tag_table, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        bitmap_index.build(tag_table, str(tmp_path / "i"), bins=8)
    finally:
        spark.conf.set(key, before)
    words = spark.read.parquet(str(tmp_path / "i" / "words")).select("*", F.input_file_name().alias("file"))
    rows = words.select("tag", (F.col("kind") == "ge").alias("above"), "word", "file").distinct().collect()
    assert len({r.file for r in rows}) > 15
    # all values of a tag have a word in one file: no second exchange dealt them out
    assert len(rows) == len({r[:3] for r in rows})
