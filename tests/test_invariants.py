"""Consistency relations of the products on the shared tables (the
reference's published results obey the same relations)."""

import json

import pytest

import __spark_entry__ as entry
from conftest import SF_MID

Q = entry.queries()


@pytest.fixture(scope="module")
def members(spark):
    return spark.read.parquet(f"{SF_MID}/customer.parquet").count()


def _rows(spark, key):
    return [r.asDict() for r in Q[key](spark, SF_MID).collect()]


def test_distributions_sum_to_members(spark, members):
    assert sum(r["sexCount"] for r in _rows(spark, "member_sex")) == members
    assert sum(r["channelCount"] for r in _rows(spark, "member_channel")) == members


def test_sentinel_split_covers_every_member(spark, members):
    r = _rows(spark, "member_subscription")[0]
    assert r["subCount"] + r["unSubCount"] == members  # no real NULLs there
    overview = json.loads(_rows(spark, "member_overview_json")[0]["value"])
    assert overview["memberMpSubs"] == [r]


def test_heat_partitions_members(spark, members):
    r = _rows(spark, "member_heat")[0]
    assert r["reg"] + r["complete"] == members
    assert r["order"] + r["orderAgain"] <= members


def test_funnel_tail_is_non_increasing(spark):
    r = _rows(spark, "conversion_funnel")[0]
    assert r["order"] >= r["orderAgain"] >= r["chargeCoupon"]


def test_growth_increments_equal_daily_counts(spark):
    g = sorted(_rows(spark, "growth_daily"), key=lambda r: r["day"])
    assert len(g) == 8  # as_of - 7 … as_of
    for a, b in zip(g, g[1:]):
        assert b["memberCount"] - a["memberCount"] == b["regCount"]
        assert b["orderCount"] >= a["orderCount"] and b["gmv"] >= a["gmv"]
    daily = {r["day"]: r["orderCount"] for r in _rows(spark, "order_two_weeks")}
    for a, b in zip(g, g[1:]):
        if b["day"] in daily:
            assert b["orderCount"] - a["orderCount"] == daily[b["day"]]


def test_week_on_week_matches_two_week_counts(spark):
    daily = {r["day"]: r["regCount"] for r in _rows(spark, "reg_two_weeks")}
    for r in _rows(spark, "week_on_week"):
        assert r["count"] == daily.get(r["day"], 0)
        assert r["prevCount"] == daily.get(r["prevDay"], 0)


def test_hot_words_descend(spark):
    c = [r["count"] for r in _rows(spark, "hot_words")]
    assert len(c) == 10 and c == sorted(c, reverse=True)


def test_tag_table_one_row_per_member(spark, members):
    t = Q["member_tags"](spark, SF_MID)
    assert t.count() == members == t.select("memberId").distinct().count()
    assert Q["member_tags_parity"](spark, SF_MID).count() > members  # trap 2


def test_facets_agree_with_selection(spark):
    f = {(r["name"], r["value"]): r["members"] for r in _rows(spark, "tag_facets")}
    sel = _rows(spark, "audience_select")
    assert len(sel) <= f[("sex", "BUILDING")] + f[("sex", "FURNITURE")]
    assert len(sel) <= f[("freeCouponTime", "")]
