"""Stored audiences against the compiled rules, one audience at a time."""

import random
from decimal import Decimal

import pyarrow as pa
import pytest

from memberscope.functions.rules import Rule, compile_rules
from memberscope.operators import member_parts, membership
from tests.test_bitmap_index import RULES, SCHEMA, tag_rows


@pytest.fixture(scope="module")
def tag_table(spark):
    import decimal
    rows = {r[0]: r for r in tag_rows(260, seed=9)}
    return spark.createDataFrame([tuple(decimal.Decimal(str(v)) if isinstance(v, float) else v for v in r)
                                  for r in rows.values()], SCHEMA).cache()


def test_every_audience_equals_its_compiled_rules(spark, tag_table):
    rng = random.Random(2)
    good = [*RULES, Rule("not a", "sex", "a", "notMatch"), Rule("not b", "sex", "b", "notMatch")]
    audiences = {i: [good[i]] for i in range(len(good))}
    audiences.update({100 + i: rng.sample(good, rng.randrange(2, 6)) for i in range(40)})
    audiences[200] = [Rule("", "sex", "a", "notMatch"), Rule("", "sex", "b", "notMatch")]
    audiences[201] = [Rule("", "sex", "a", "notMatch"), Rule("", "sex", "a", "match")]
    rows = [(a, r.name, r.value, r.type) for a, rules in audiences.items() for r in rules]
    rows += [(300, "orderMoney", "many", "rangeGte"), (301, "nothing", "1", "match"), (302, "sex", "a", "match"),
             (302, "orderMoney", "x-y", "rangeBoth"), (303, "orderMoney", "many", "rangeGte"), (303, "orderMoney", "100", "rangeGte")]
    audiences[303] = [Rule("", "orderMoney", "100", "rangeGte")]
    table = spark.createDataFrame(rows + rows[:5], "audienceId long, name string, value string, type string")
    got = {}
    for r in membership.membership(tag_table, table, bins=6, salt=3).collect():
        got.setdefault(r.audienceId, []).append(r.memberId)
    told = tag_table.select("memberId", *[
        compile_rules(rules, tag_table.schema).alias(f"a{a}") for a, rules in audiences.items()]).collect()
    for a, rules in audiences.items():
        want = sorted(r.memberId for r in told if r[f"a{a}"])
        assert sorted(got.get(a, [])) == want, (a, rules)
    assert not {300, 301, 302} & set(got)
    bad = {(r.audienceId, r.name) for r in membership.invalid_rules(table, tag_table).collect()}
    assert bad == {(300, "orderMoney"), (301, "nothing"), (302, "orderMoney"), (303, "orderMoney")}


def test_no_cross_join(spark, tag_table):
    table = spark.createDataFrame([(1, "sex", "a", "match"), (1, "orderMoney", "10-90", "rangeBoth")],
                                  "audienceId long, name string, value string, type string")
    plan = membership.membership(tag_table, table)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rules_are_not_broadcast(spark, tag_table):
    # dealt rules are many times their stored size: a broadcast of them fills the driver
    table = spark.createDataFrame([(1, "sex", "a", "match"), (1, "orderMoney", "10-90", "rangeBoth"), (2, "sex", "b", "notMatch")],
                                  "audienceId long, name string, value string, type string")
    plan = membership.membership(tag_table, table)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_members_with_several_rows_have_the_tags_of_all(spark):
    tags = spark.createDataFrame([(1, "a", [1, 2], 5), (1, "b", [2], None), (2, "a", None, 9), (None, "a", [1], 5)],
                                 "memberId long, sex string, favGoods array<long>, orderCount long")
    table = spark.createDataFrame(
        [(1, "sex", "a", "match"), (1, "favGoods", "2", "match"), (2, "sex", "b", "match"), (2, "sex", "a", "match"),
         (3, "sex", "a", "notMatch"), (4, "orderCount", "1-9", "rangeBoth"), (4, "sex", "b", "match"),
         (5, "favGoods", "1-2", "rangeBoth"), (None, "sex", "a", "match")],
        "audienceId long, name string, value string, type string")
    got = sorted(tuple(r) for r in membership.membership(tags, table, bins=4, salt=2).collect())
    assert got == [(1, 1), (2, 1), (2, 2), (4, 1), (5, 1)]


def test_long_lists_meet_parts_of_the_members(spark, tag_table):
    # everyone's lists are read once a part, not once an audience
    rows = [(a, "sex", "ab"[a % 2], "match") for a in range(40)]
    rows += [(a, "orderMoney", f"{a % 7}-{60 + a % 3}", "rangeBoth") for a in range(40) if a % 4]
    rows += [(a, "channel", "1", "match") for a in range(40) if a % 5 == 0]
    rows += [(a, "channel", "2", "match") for a in range(40) if a % 10 == 0] + [(40, "sex", "a", "notMatch")]
    table = spark.createDataFrame(rows, "audienceId long, name string, value string, type string")
    apart = membership.membership(tag_table, table, bins=6, salt=3, short=0)
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan
    joined = membership.membership(tag_table, table.where("audienceId < 40"), bins=6, salt=3, short=10**6)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "MapInArrow" not in plan and "salt" not in plan
    got = sorted(tuple(r) for r in apart.collect())
    assert [r for r in got if r[0] < 40] == sorted(tuple(r) for r in joined.collect())
    assert {r[0] for r in got} > {0, 1, 40} and len(set(got)) == len(got)


def test_values_of_a_part():
    numbers = [[Decimal("1.5"), None], [Decimal("-3")], None, [], [Decimal("1.500001"), Decimal("1.5")], [Decimal(10) ** 31]]
    held = member_parts._Values(pa.array(numbers, pa.list_(pa.decimal128(38, 6))))
    at = lambda low, high: sorted(set(held.between(low, high).tolist()))
    assert at(1_500_000, 1_500_000) == [0, 4] and at(-10**40, None) == [0, 1, 4, 5] and at(5, 1) == []
    assert at(1_500_001, 10**37) == [4, 5] and member_parts._unscaled("-0.000001") == -1
    small = member_parts._Values(pa.array(numbers[:-1], pa.list_(pa.decimal128(38, 6))).slice(1))
    assert sorted(set(small.between(-10**40, 10**40).tolist())) == [0, 3]
    texts = member_parts._Values(pa.array([["～"], ["\U0001f600", "b"], ["a", None], None]))
    assert texts.between("b", None).tolist() == [1, 0, 1] and texts.equal("c").tolist() == []
