"""Plan guard rails: the design rules hold in every registered query's
physical plan (checked on the smallest tables; the rules do not depend on
size)."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from memberscope.plans import catalog, oracle  # noqa: E402
from conftest import SF_SMALL, query_frame

QUERIES = dict(catalog.QUERIES)  # the llm package has its own tests


def _plan(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_and_no_pair_joins(spark, key):
    plan = _plan(query_frame(spark, key))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["hot_words"](spark, SF_SMALL))


@pytest.mark.parametrize("key", ["reg_two_weeks", "order_two_weeks", "reg_two_weeks_sql",
                                 "week_on_week"])
def test_time_window_reaches_the_scan(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL), "formatted")
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln]
    assert any("GreaterThanOrEqual(ts" in ln and "LessThan(ts" in ln for ln in pushed)


@pytest.mark.parametrize("key,wanted", [
    ("coupon_expiry", "GreaterThanOrEqual(ts"), ("coupon_expiring", "GreaterThanOrEqual(ts"),
    ("conversion_funnel_constants", "EqualTo(event_type,purchase)"),
    ("tag_charge_money", "EqualTo(event_type,purchase)")])
def test_coupon_filters_reach_the_scan(spark, key, wanted):
    plan = _plan(QUERIES[key](spark, SF_SMALL), "formatted")
    assert any(wanted in ln for ln in plan.splitlines() if "PushedFilters" in ln)


@pytest.mark.parametrize("key,columns", [
    ("member_sex", {"c_custkey", "c_mktsegment"}),
    ("member_subscription", {"c_name", "c_acctbal"}),
    ("hot_words", {"text"}),
    ("reg_two_weeks", {"event_id", "ts", "event_type"}),
])
def test_scans_read_only_used_columns(spark, key, columns):
    plan = _plan(QUERIES[key](spark, SF_SMALL), "formatted")
    schemas = [ln.split("ReadSchema:")[1].strip() for ln in plan.splitlines()
               if "ReadSchema:" in ln]
    read = {f.split(":")[0] for s in schemas
            for f in s.removeprefix("struct<").removesuffix(">").split(",")}
    assert read == columns


def test_tag_chain_has_no_redundant_shuffle(spark):
    """With every join forced to sort-merge and AQE off (the plan of large
    tables), the tag table needs exactly one exchange per aggregation or
    dimension join, and the member-keyed left-join chain adds none."""
    from memberscope.plans import catalog
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = _plan(catalog._tag_table(spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # customer, first signup, per-order lines, orders, per-member order tags,
    # per-(member, coupon) holdings, by coupon for pricing, coupons,
    # per-member coupon tags, per-member feedback
    assert plan.count("Exchange hashpartitioning") == 10
    assert plan.count("SortMergeJoin") == 6
