"""Hand-made frames for the semantic traps of each product."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from memberscope.operators import distributions, funnel, growth, hotwords, tags

T = dt.datetime


# ---------------------------------------------------------------- fixtures

@pytest.fixture(scope="module")
def member(spark):
    return spark.createDataFrame(
        [(1, "p1", 1, 1, "o1", 5), (2, "null", 2, 2, "null", -1),
         (3, "p3", 1, 3, None, 7), (4, None, -1, 1, "o4", 8)],
        "id long, phone string, sex int, member_channel int, mp_open_id string, "
        "address_default_id int")


@pytest.fixture(scope="module")
def order(spark):
    # member 1: one done order with three lines; member 2: two done orders;
    # member 3: one open and one cancelled order.
    return spark.createDataFrame(
        [(10, 1, "F", 100.0, 100.0, T(2024, 1, 5)),
         (20, 2, "F", 10.25, 10.25, T(2024, 1, 6)),
         (21, 2, "F", 5.5, 5.5, T(2024, 1, 9)),
         (30, 3, "O", 7.0, 7.0, T(2024, 1, 7)),
         (31, 3, "P", 8.0, 8.0, T(2024, 1, 8))],
        "order_id long, member_id long, order_status string, origin_price double, "
        "pay_price double, create_time timestamp")


@pytest.fixture(scope="module")
def order_item(spark):
    return spark.createDataFrame(
        [(10, 1), (10, 2), (10, 2), (20, 3), (21, 3)],
        "order_id long, commodity_id long")


@pytest.fixture(scope="module")
def coupon_member(spark):
    # member 1 holds the free coupon twice; member 2 bought coupon 5.
    return spark.createDataFrame(
        [(1, 1, 2, T(2024, 1, 3, 10)), (1, 1, 2, T(2024, 1, 4, 9)),
         (1, 7, 2, T(2024, 1, 4, 12)), (1, 7, 2, T(2024, 1, 4, 13)),
         (2, 5, 1, T(2024, 1, 2)), (2, 6, 2, T(2024, 1, 2))],
        "member_id long, coupon_id int, coupon_channel int, create_time timestamp")


@pytest.fixture(scope="module")
def coupon(spark):
    return spark.createDataFrame([(5, 20.0), (6, 3.0), (7, 1.01)],
                                 "id int, coupon_price double")


# ---------------------------------------------------------------- A1–A5

def test_distributions_and_sentinel(member):
    assert sorted(rows(distributions.member_sex(member))) == [(-1, 1), (1, 2), (2, 1)]
    assert sorted(rows(distributions.member_channel(member))) == [(1, 2), (2, 1), (3, 1)]
    # trap 3: a real NULL is in neither bucket
    assert rows(distributions.sentinel_counts(member, "mp_open_id")) == [(2, 1)]


def test_heat_counts_exactly_one_order_of_any_status(member, order, coupon_member):
    # trap 4: member 1 has one order; members 2 and 3 have two (3's are not done)
    r = distributions.member_heat(member, order, coupon_member)
    assert r.columns == ["reg", "complete", "order", "orderAgain", "coupon"]
    assert rows(r) == [(1, 2, 1, 2, 2)]


def test_overview_nests_the_parts(member, order, coupon_member):
    r = distributions.member_overview(member, order, coupon_member).collect()[0]
    assert [tuple(x) for x in r["memberSexes"]] == [(-1, 1), (1, 2), (2, 1)]
    assert [tuple(x) for x in r["memberMpSubs"]] == [(2, 1)]
    assert tuple(r["memberHeat"]) == (1, 2, 1, 2, 2)


# ---------------------------------------------------------------- A6

def test_funnel_counts_completed_orders_only(order, coupon_member):
    # trap 4: funnel order = at least one completed order
    r = funnel.conversion_funnel(order, coupon_member)
    assert rows(r) == [(1000, 800, 600, 2, 1, 1)]


def test_funnel_from_behaviour(spark, order, coupon_member):
    ev = spark.createDataFrame([(1, "view"), (1, "view"), (2, "view"), (2, "click")],
                               "user_id long, event_type string")
    r = funnel.conversion_funnel(order, coupon_member, behaviour=ev)
    assert rows(r) == [(2, 1, None, 2, 1, 1)]


# ---------------------------------------------------------------- A7–A10

@pytest.fixture(scope="module")
def reg_events(spark):
    # as_of 2024-01-10; window from 2024-01-03 (8 calendar days).
    data = [(1, T(2023, 12, 30)), (2, T(2024, 1, 2, 23, 59)), (3, T(2024, 1, 3)),
            (4, T(2024, 1, 3, 8)), (5, T(2024, 1, 5)), (6, T(2024, 1, 10, 1))]
    return spark.createDataFrame(data, "id long, create_time timestamp")


@pytest.fixture(scope="module")
def buy_events(spark):
    data = [(100, 1.10, T(2024, 1, 1)), (101, 2.20, T(2024, 1, 3)),
            (102, 3.30, T(2024, 1, 4)),  # a day with orders but no registration
            (103, 4.40, T(2024, 1, 5)), (104, 5.50, T(2024, 1, 10))]
    return spark.createDataFrame(data, "order_id long, origin_price double, "
                                       "create_time timestamp")


def test_growth_accumulates_before_the_day_join(reg_events, buy_events):
    r = rows(growth.growth_daily(reg_events, buy_events, "2024-01-10"))
    assert r == [
        ("2024-01-03", 2, 4, 2, Decimal("3.30")),
        ("2024-01-05", 1, 5, 4, Decimal("11.00")),   # 01-04's 3.30 kept (trap 7)
        ("2024-01-10", 1, 6, 5, Decimal("16.50")),   # as_of itself is in (trap 5)
    ]


def test_growth_parity_uses_max_id_and_loses_unmatched_days(reg_events, buy_events):
    r = rows(growth.growth_daily(reg_events, buy_events, "2024-01-10", parity=True))
    assert r == [
        ("2024-01-03", 2, 4, 101, Decimal("3.30")),
        ("2024-01-05", 1, 5, 103, Decimal("7.70")),
        ("2024-01-10", 1, 6, 104, Decimal("13.20")),
    ]


def test_growth_without_earlier_orders(spark, reg_events):
    # trap 9: nothing before the window gives 0, not a failure
    o = spark.createDataFrame([(1, 2.5, T(2024, 1, 5))],
                              "order_id long, origin_price double, create_time timestamp")
    r = rows(growth.growth_daily(reg_events, o, "2024-01-10", parity=True))
    assert r == [("2024-01-05", 1, 5, 1, Decimal("2.50"))]


def test_two_week_window_is_half_open(reg_events):
    r = rows(growth.last_weeks_counts(reg_events, "create_time", "id", "2024-01-10",
                                      2, "regCount"))
    assert sorted(r) == [("2023-12-30", 1), ("2024-01-02", 1), ("2024-01-03", 2),
                         ("2024-01-05", 1)]  # 2024-01-10 excluded


def test_week_on_week_pairs_same_weekday(reg_events):
    r = rows(growth.week_on_week(reg_events, "create_time", "id", "2024-01-10"))
    assert len(r) == 7
    by_day = {x[0]: x for x in r}
    assert by_day["2024-01-03"] == ("2024-01-03", 2, "2023-12-27", 0, None)
    assert by_day["2024-01-06"] == ("2024-01-06", 0, "2023-12-30", 1, -1.0)
    assert by_day["2024-01-09"][1] == 0


# ---------------------------------------------------------------- A11

def test_hot_words_ties_tabs_and_empty_lines(spark):
    lines = ["b\tx", "a\tx", "c", "\t\t", "", "a", "b", "d\t"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    r = rows(hotwords.hot_words(df, k=3))
    # "" twice (tabs only, empty line), a twice, b twice: ties broken by word
    assert r == [("", 2), ("a", 2), ("b", 2)]
    assert rows(hotwords.hot_words(df, field=1, k=10)) == [("", 2), ("x", 2)]


def test_hot_words_reads_every_line_of_a_text(spark):
    from memberscope.sources.text import text_lines
    docs = spark.createDataFrame([("w1 a\nw2 b\r\nw1 c\n",), ("w2\rw1",)], "text string")
    assert rows(hotwords.hot_words(text_lines(docs), sep=" ")) == [("w1", 3), ("w2", 2)]


# ---------------------------------------------------------------- A12–A19

def test_order_behavior_counts_orders_not_lines(order, order_item):
    r = {x[0]: x for x in rows(tags.tag_order_behavior(order, order_item))}
    assert r[1] == (1, 1, "2024-01-05", Decimal("100.00"), [1, 2])
    assert r[2] == (2, 2, "2024-01-09", Decimal("15.75"), [3])
    assert r[3] == (3, 2, "2024-01-08", Decimal("15.00"), [])
    # trap 1: the reference's row-level form multiplies by the lines
    p = {x[0]: x for x in rows(tags.tag_order_behavior(order, order_item, parity=True))}
    assert p[1][1:4] == (3, "2024-01-05", Decimal("300.00"))


def test_free_coupon_one_row_per_member(coupon_member):
    assert rows(tags.tag_free_coupon(coupon_member)) == [(1, "2024-01-03")]
    # trap 2: ungrouped form fans out
    assert len(rows(tags.tag_free_coupon(coupon_member, parity=True))) == 2


def test_coupon_times_distinct_days(coupon_member):
    r = dict(rows(tags.tag_coupon_times(coupon_member)))
    assert r == {1: ["2024-01-04"], 2: ["2024-01-02"]}


def test_charge_money_halves_non_bought_coupons(coupon_member, coupon):
    r = dict(rows(tags.tag_charge_money(coupon_member, coupon)))
    # member 1: free coupon has no price row (left join), 2 x 1.01 / 2;
    # member 2: coupon 5 was bought (channel 1) so only coupon 6 counts
    assert r == {1: Decimal("1.010"), 2: Decimal("1.500")}


def test_over_time_max_minus_max_and_per_delivery(spark):
    d = spark.createDataFrame(
        [(1, T(2024, 1, 1), T(2024, 1, 1, 0, 30)), (1, T(2024, 1, 2), T(2024, 1, 2, 0, 10))],
        "member_id long, pick_time timestamp, arrive_time timestamp")
    assert rows(tags.tag_over_time(d)) == [(1, 600)]
    assert rows(tags.tag_over_time(d, per_delivery=True)) == [(1, 1800)]


def test_feedback_latest_by_id(spark):
    fb = spark.createDataFrame([(1, 7, 3), (2, 7, 1), (3, 8, 4)],
                               "id long, member_id long, feedback_type int")
    r = tags.tag_feedback_latest(fb)
    assert r.columns == ["memberId", "feedBack"]  # trap 20
    assert sorted(rows(r)) == [(7, 1), (8, 4)]


def test_member_tags_one_row_per_member(spark, member, order, order_item,
                                        coupon_member, coupon):
    m = member.withColumn("create_time", F.lit(T(2024, 1, 1)))
    d = spark.createDataFrame([(1, T(2024, 1, 1), T(2024, 1, 2))],
                              "member_id long, pick_time timestamp, arrive_time timestamp")
    fb = spark.createDataFrame([(1, 2, 3)], "id long, member_id long, feedback_type int")
    t = tags.member_tags(m, order, order_item, coupon_member, coupon, d, fb)
    assert tuple(t.columns) == tags.TAG_COLUMNS
    assert t.count() == 4
    r = {x["memberId"]: x for x in t.collect()}
    assert r[1]["freeCouponTime"] == "2024-01-03" and r[1]["overTime"] == 86400
    assert r[2]["feedBack"] == 3 and r[4]["orderCount"] is None
    tp = tags.member_tags(m, order, order_item, coupon_member, coupon, d, fb, parity=True)
    assert tp.count() == 5


def test_coupon_features_one_pass_equals_separate_features(coupon_member, coupon):
    one = tags.tag_coupon_features(coupon_member, coupon)
    sep = (tags.tag_free_coupon(coupon_member)
           .join(tags.tag_coupon_times(coupon_member), "memberId", "full")
           .join(tags.tag_charge_money(coupon_member, coupon), "memberId", "full"))
    cols = ["memberId", "freeCouponTime", "couponTimes", "chargeMoney"]
    assert sorted(rows(one, *cols)) == sorted(rows(sep, *cols))


def test_order_features_one_pass_equals_separate_tags(spark):
    o = spark.createDataFrame(
        [(1, 7, 10.0, T(2024, 1, 1)), (2, 7, 20.0, T(2024, 1, 5)),   # 2 has no lines
         (3, 8, 5.0, T(2024, 1, 2)), (4, 9, 1.0, T(2024, 1, 3))],
        "order_id long, member_id long, pay_price double, create_time timestamp")
    lines = spark.createDataFrame(
        [(1, 100, T(2024, 1, 3)), (1, 100, T(2024, 1, 4)), (1, None, T(2024, 1, 2)),
         (3, 200, None), (4, None, T(2024, 1, 6))],
        "order_id long, commodity_id long, arrive_time timestamp")
    one = tags.tag_order_features(o, lines)
    items = lines.select("order_id", "commodity_id")
    deliv = (lines.join(o, "order_id")
             .select("member_id", F.col("create_time").alias("pick_time"), "arrive_time"))
    sep = tags.tag_order_behavior(o, items).join(tags.tag_over_time(deliv), "memberId", "left")
    cols = ["memberId", "orderCount", "orderTime", "orderMoney", "favGoods", "overTime"]
    got = sorted(rows(one, *cols))
    assert got == sorted(rows(sep, *cols))
    # member 7: two orders, latest pick with lines is 01-01, last arrival 01-04
    assert got[0] == (7, 2, "2024-01-05", Decimal("30.00"), [100], 3 * 86400)
    assert got[1][4:] == ([200], None) and got[2][4:] == ([], 3 * 86400)


def test_coupon_features_keep_grants_without_time(spark, coupon):
    cm = spark.createDataFrame(
        [(5, 6, 2, None), (5, 6, 2, None), (6, 7, 2, T(2024, 1, 1)), (6, 1, 2, None)],
        "member_id long, coupon_id int, coupon_channel int, create_time timestamp")
    one = tags.tag_coupon_features(cm, coupon)
    sep = (tags.tag_free_coupon(cm)
           .join(tags.tag_coupon_times(cm), "memberId", "full")
           .join(tags.tag_charge_money(cm, coupon), "memberId", "full"))
    cols = ["memberId", "freeCouponTime", "couponTimes", "chargeMoney"]
    got = sorted(rows(one, *cols))
    assert got == sorted(rows(sep, *cols), key=lambda r: r[0])
    assert got[0] == (5, None, [], Decimal("3.000"))


def test_growth_from_a_persisted_incremental_rollup(spark, reg_events, buy_events, tmp_path):
    # The rollup built in two parts (history, then new days) and written to a
    # table gives the same growth line as the one-shot product.
    p = str(tmp_path / "rollup")
    growth.daily_rollup(reg_events, buy_events, until="2024-01-04").write.parquet(p)
    growth.daily_rollup(reg_events, buy_events, since="2024-01-04").write.mode("append").parquet(p)
    from_table = growth.growth_from_rollup(spark.read.parquet(p), "2024-01-10")
    assert rows(from_table) == rows(growth.growth_daily(reg_events, buy_events, "2024-01-10"))
