"""Calendar jobs (D1–D4), audience rules (E1–E7), audience products
(A20–A23) and sinks."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from memberscope.functions import calendar as cal
from memberscope.functions.rules import (Rule, compile_rules, coupon_day_rule,
                                         recent_rule, standard_rules)
from memberscope.operators import audience, calendar_jobs, tags
from memberscope.sources import sinks

T = dt.datetime


# ---------------------------------------------------------------- D1–D4

def test_normalize_dates_is_strict(spark):
    texts = ["2019-11-30", "2019-11", "11-30", "2019/11/30 10:05", "2019年11月30日",
             "10:05:06", "2019-02-30", "2019-1-5", "junk", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    r = rows(calendar_jobs.normalize_dates(df, "s"), "s", "s_style", "s_valid")
    got = {x[0]: (x[1], x[2]) for x in r}
    assert got["2019-11-30"] == ("yyyy-MM-dd", True)   # trap 16: not yyyy-MM
    assert got["2019-11"] == ("yyyy-MM", True)
    assert got["11-30"] == ("MM-dd", True)
    assert got["2019/11/30 10:05"] == ("yyyy/MM/dd HH:mm", True)
    assert got["2019年11月30日"] == ("yyyy年MM月dd日", True)
    assert got["10:05:06"] == ("HH:mm:ss", True)
    for bad in ("2019-02-30", "2019-1-5", "junk", None):
        assert got[bad] == (None, False)


def test_pattern_shape():
    assert cal.pattern_shape("yyyy/MM/dd HH:mm") == r"^\d{4}/\d{2}/\d{2}\ \d{2}:\d{2}$"


def test_calendar_features_one_based_month_and_weekday(spark):
    df = spark.createDataFrame([(T(2019, 11, 30, 13, 4, 5),), (None,)], "ts timestamp")
    r = rows(calendar_jobs.calendar_features(df, "ts").drop("ts"))
    assert r[0] == (2019, 11, 30, 13, 4, 5, "2019-11-30", "13:04:05", 6,
                    "星期六", "Saturday", "Sat.")
    assert r[1] == (None,) * 12  # trap 14: NULL in, NULL out


def test_shift_dates_clamps_month_ends_step_by_step(spark):
    df = spark.createDataFrame([(T(2000, 2, 29, 0, 0),), (T(2019, 1, 31, 23, 0),)],
                               "ts timestamp")
    out = calendar_jobs.shift_dates(df, "ts", [("YEAR", 1), ("MONTH", 1), ("HOUR", 2)], "x")
    assert [r[0] for r in rows(out, "x")] == [T(2001, 3, 28, 2, 0), T(2020, 3, 1, 1, 0)]


def test_interval_days_beyond_25_days(spark):
    # trap 15: no int overflow; whole days, absolute
    df = spark.createDataFrame([(T(2019, 1, 1, 23), T(2019, 3, 1, 1))], "a timestamp, b timestamp")
    assert rows(calendar_jobs.interval_days(df, "b", "a"), "days") == [(59,)]
    assert rows(calendar_jobs.interval_days(df, "a", "b"), "days") == [(59,)]


# ---------------------------------------------------------------- E1–E7, A20, A21

@pytest.fixture(scope="module")
def tags_df(spark):
    return spark.createDataFrame(
        [(1, 1, "o1", "2024-01-29", 1, Decimal("60.00"), [1, 5], "2024-01-21", ["2024-01-19"], Decimal("20.000"), 1000, 2),
         (2, 2, "null", "2024-01-20", 3, Decimal("700.00"), [2], None, [], Decimal("120.500"), 4000, 1),
         (3, 2, None, None, None, None, None, "2024-01-15", None, None, None, None)],
        "memberId long, sex int, subOpenId string, regTime string, orderCount long, "
        "orderMoney decimal(38,2), favGoods array<long>, freeCouponTime string, "
        "couponTimes array<string>, chargeMoney decimal(38,3), overTime long, feedBack int")


def _ids(df):
    return sorted(r[0] for r in rows(df, "memberId"))


def test_rule_types(tags_df):
    sel = lambda rs: _ids(audience.audience_select(tags_df, rs))
    assert sel([Rule("", "sex", "2", "match")]) == [2, 3]
    assert sel([Rule("", "favGoods", "5", "match")]) == [1]
    assert sel([Rule("", "subOpenId", "null", "notMatch")]) == [1, 3]  # keeps NULL
    assert _ids(audience.audience_select(
        tags_df, [Rule("", "subOpenId", "null", "notMatch")], keep_null=False)) == [1]
    assert sel([Rule("", "freeCouponTime", "", "exists")]) == [1, 3]
    assert sel([Rule("", "couponTimes", "", "exists")]) == [1]  # empty list is absent
    assert sel([Rule("", "orderCount", "2", "rangeGte")]) == [2]
    assert sel([Rule("", "regTime", "2024-01-23", "rangeGte")]) == [1]
    assert sel([Rule("", "chargeMoney", "10-50", "rangeBoth")]) == [1]
    assert sel([Rule("", "orderMoney", "50-100", "rangeBoth")]) == [1]
    assert sel([Rule("", "overTime", "3600", "rangeGte")]) == [2]


def test_range_bounds(tags_df):
    def sel(name, value, kind="rangeBoth"):
        return _ids(audience.audience_select(tags_df, [Rule("", name, value, kind)]))
    assert sel("regTime", "2024-01-20-2024-01-28") == [2]
    assert sel("overTime", "-5-1000") == [1] and sel("overTime", "-10--5") == []
    assert sel("orderMoney", "59.99 - 60.00") == [1]
    for name, value, kind in (("orderCount", "two", "rangeGte"), ("orderMoney", "a-b", "rangeBoth"),
                              ("overTime", "5", "rangeBoth"), ("overTime", "1-2-3", "rangeBoth"),
                              ("orderCount", "1.5", "rangeGte")):
        with pytest.raises(ValueError):
            sel(name, value, kind)


def test_coupon_expiry_from_grants(spark):
    grants = spark.createDataFrame(
        [(1, 2, "2024-01-21 23:59:59"), (1, 3, "2024-01-21 00:00:00"), (2, 2, "2024-01-21 10:00:00"),
         (2, 1, "2024-01-19 10:00:00"), (3, 2, "2024-01-19 10:00:00"), (3, 2, "2024-01-22 00:00:00"),
         (None, 2, "2024-01-15 00:00:00"), (4, None, "2024-01-15 00:00:00"), (4, 2, None),
         (5, 2, "2024-01-27 08:00:00")],
        "member_id long, coupon_id long, create_time string").withColumn(
        "create_time", F.col("create_time").cast("timestamp_ntz"))
    times = tags.tag_coupon_times(grants, 1)
    for expiring in (False, True):
        got = rows(audience.coupon_expiry_from_grants(grants, "2024-01-30", 1, expiring=expiring))
        assert got == rows(audience.coupon_expiry(times, "2024-01-30", expiring=expiring))
    assert [r[3] for r in rows(audience.coupon_expiry_from_grants(grants, "2024-01-30"))] == [2, 1, 0, 0]
    assert rows(audience.coupon_expiry_from_grants(grants, "2024-01-30", expiring=True))[2] == (
        5, "2024-01-27", -5, 1)


def test_rules_or_within_field_and_between_fields(tags_df):
    rs = [Rule("", "sex", "1", "match"), Rule("", "sex", "2", "match"),
          Rule("", "feedBack", "1", "match")]
    assert _ids(audience.audience_select(tags_df, rs)) == [2]
    assert _ids(tags_df.where(compile_rules([], tags_df.schema))) == [1, 2, 3]


def test_relative_day_rules():
    assert recent_rule("regTime", 1, "2019-11-30").value == "2019-11-29"
    assert recent_rule("regTime", 7, "2019-11-30").value == "2019-11-23"
    assert coupon_day_rule("freeCouponTime", 1, "2019-11-30").value == "2019-11-21"
    assert coupon_day_rule("couponTimes", 7, "2019-11-30").value == "2019-11-15"
    rs = standard_rules("2019-11-30")
    assert len({(r.name, r.value, r.type) for r in rs}) == len(rs)
    assert sum(r.name == "favGoods" for r in rs) == 19


def test_tag_facets_one_row_per_rule(tags_df):
    rs = [Rule("a", "sex", "2", "match"), Rule("b", "favGoods", "2", "match"),
          Rule("c", "overTime", "900", "rangeGte")]
    r = rows(audience.tag_facets(tags_df, rs))
    assert r == [("a", "sex", "2", "match", 2), ("b", "favGoods", "2", "match", 1),
                 ("c", "overTime", "900", "rangeGte", 2)]


def test_coupon_buckets(tags_df):
    # as_of 2024-01-30, valid 8 days: k=1 is 2024-01-21, k=7 is 2024-01-15
    r = rows(audience.free_coupon_reminder(tags_df.select("memberId", "freeCouponTime"),
                                           "2024-01-30"))
    assert r[0] == (1, "2024-01-21", 1, 1) and r[6] == (7, "2024-01-15", 7, 1)
    assert [x[3] for x in r[1:6]] == [0] * 5
    e = rows(audience.coupon_expiry(tags_df.select("memberId", "couponTimes"), "2024-01-30"))
    assert e == [(1, "2024-01-21", 1, 0), (3, "2024-01-19", 3, 1), (5, "2024-01-17", 5, 0),
                 (7, "2024-01-15", 7, 0)]
    # the other reading: coupons that expire k days after as_of (trap 23)
    x = rows(audience.coupon_expiry(tags_df.select("memberId", "couponTimes"), "2024-01-24",
                                    expiring=True))
    assert x[2] == (5, "2024-01-21", -5, 0) and x[0] == (1, "2024-01-17", -1, 0)
    y = rows(audience.free_coupon_reminder(tags_df.select("memberId", "freeCouponTime"),
                                           "2024-01-20", expiring=True))
    assert (y[0][0], y[0][1], y[0][3]) == (1, "2024-01-13", 0) and y[6][1:] == ("2024-01-19", -7, 0)


# ---------------------------------------------------------------- sinks

def test_sinks_round_trip(spark, tags_df, tmp_path):
    p = str(tmp_path / "tags")
    sinks.write_table(tags_df, p)
    sinks.write_table(tags_df, p)  # overwrite: a re-run does not duplicate
    back = spark.read.parquet(p)
    assert back.count() == 3 and back.columns == tags_df.columns
    t = str(tmp_path / "member.txt")
    sinks.write_member_text(audience.audience_select(tags_df, [Rule("", "sex", "2", "match")]), t)
    assert sorted(r[0] for r in spark.read.text(t).collect()) == ["2", "3"]
    js = sinks.json_rows(tags_df.select("memberId", "favGoods")).collect()
    assert js[0][0] == '{"memberId":1,"favGoods":[1,5]}'


def test_pattern_layouts_are_distinct_and_fallback_agrees(spark):
    assert cal.signatures_unique(cal.DATE_PATTERNS)
    assert cal.pattern_signature("yyyy年MM月dd日 HH:mm") == "9999年99月99日 99:99"
    # an overlapping list uses the ordered fallback: first pattern that parses
    pats = ("yyyy-MM-dd", "yyyy-dd-MM")
    assert not cal.signatures_unique(pats)
    df = spark.createDataFrame([("2019-11-30",), ("2019-30-11",)], "s string")
    r = rows(df.select(cal.date_style("s", pats)))
    assert r == [("yyyy-MM-dd",), ("yyyy-dd-MM",)]


def test_shift_text_keeps_the_pattern(spark):
    df = spark.createDataFrame([("2019-11-30",), ("2019/11/30 10:05",), ("2019年01月31日",),
                                ("junk",), (None,)], "s string")
    got = [r[0] for r in rows(df.select(cal.shift_text("s", "DAY", 1)))]
    assert got == ["2019-12-01", "2019/12/01 10:05", "2019年02月01日", None, None]
    got = [r[0] for r in rows(df.select(cal.shift_text("s", "MONTH", 1)))]
    assert got[2] == "2019年02月28日"  # month end clamps


def test_not_match_with_a_value_the_column_cannot_hold(tags_df):
    # "sex is not 'abc'" holds for every member (the value is no sex code)
    assert _ids(audience.audience_select(tags_df, [Rule("", "sex", "abc", "notMatch")])) == [1, 2, 3]
    assert _ids(audience.audience_select(tags_df, [Rule("", "sex", "abc", "match")])) == []


def test_parse_is_wall_clock_and_rejects_impossible_values(spark):
    texts = ["2019-11-30 24:00", "2019-11-30 10:05:60", "2019-02-29", "2020-02-29",
             "02-29", "12-31 23:59:59", "2019/13/01", "00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = calendar_jobs.normalize_dates(df, "s")
    assert out.schema["s_ts"].dataType.typeName() == "timestamp_ntz"
    got = {r[0]: r[1] for r in rows(out, "s", "s_ts")}
    assert got["2019-11-30 24:00"] is None and got["2019-11-30 10:05:60"] is None
    assert got["2019-02-29"] is None and got["2020-02-29"] == T(2020, 2, 29)
    assert got["02-29"] is None                      # year defaults to 1970
    assert got["12-31 23:59:59"] == T(1970, 12, 31, 23, 59, 59)
    assert got["2019/13/01"] is None and got["00:00"] == T(1970, 1, 1)


def test_reformat_any_known_pattern(spark):
    df = spark.createDataFrame([("2019/11/30 10:05",), ("11月30日",), ("bad",)], "s string")
    got = [r[0] for r in rows(df.select(cal.reformat("s", "yyyy-MM-dd HH:mm:ss")))]
    assert got == ["2019-11-30 10:05:00", "1970-11-30 00:00:00", None]


def test_rules_from_a_page_selection(tags_df):
    from memberscope.functions.rules import rules_from_json
    body = ('{"selectedTags": [{"effect": "dark", "label": "x", "name": "sex", "value": "2", '
            '"type": "match"}, {"effect": "dark", "label": "y", "name": "orderCount", '
            '"value": "2", "type": "rangeGte"}]}')
    rules = rules_from_json(body)
    assert [r.type for r in rules] == ["match", "rangeGte"]
    assert _ids(audience.audience_select(tags_df, rules)) == [2]
    assert rules_from_json("[]") == []
