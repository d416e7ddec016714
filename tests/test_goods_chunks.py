"""Chunks of a hot member's goods against plain Python."""

import random

from memberscope.functions.rules import Rule
from memberscope.operators import goods_chunks as goods


def lines(spark, n_hot=4000):
    """One member with half of all lines, an order with many, nulls."""
    r = random.Random(1)
    orders = [(i, 1 if i < 300 else r.randrange(2, 60)) for i in range(600)] + [(600, None), (None, 7), (5, 1)]
    items = [(r.randrange(300) if k < n_hot else r.randrange(603), r.randrange(700)) for k in range(2 * n_hot)]
    items += [(3, g) for g in range(900)] + [(None, 4), (9, None), (10**6, 3)]
    return (spark.createDataFrame(orders, "order_id long, member_id long"),
            spark.createDataFrame(items, "order_id long, commodity_id long"), orders, items)


def test_chunks_hold_all_goods_in_order(spark):
    order, item, orders, items = lines(spark)
    want = {}
    member = {}
    for o, m in orders:
        member.setdefault(o, set()).add(m)
    for o, g in items:
        if o is not None and g is not None:
            for m in member.get(o, ()):
                want.setdefault(m, set()).add(g)
    got = {}
    chunks = goods.goods_chunks(goods.member_goods(order, item), chunk=16).collect()
    for r in sorted(chunks, key=lambda r: (r.memberId is not None, r.memberId or 0, r.chunk)):
        assert 0 < len(r.goods) <= 16
        assert r.chunk == len(got.get(r.memberId, [])) // 16  # all but the last are full
        got.setdefault(r.memberId, []).extend(r.goods)
    assert got == {m: sorted(g) for m, g in want.items()}
    assert len(got[1]) > 800


def test_rules_over_chunks(spark):
    order, item, _, _ = lines(spark)
    pairs = goods.member_goods(order, item)
    chunks = goods.goods_chunks(pairs, chunk=16).cache()
    held = {}
    for r in pairs.collect():
        held.setdefault(r.memberId, set()).add(r.good)
    members = spark.createDataFrame([(m,) for m in [*range(70), None]], "memberId long")
    for rules, test in [
            ([Rule("", "favGoods", "3", "match")], lambda g: 3 in g),
            ([Rule("", "favGoods", "3", "notMatch")], lambda g: 3 not in g),
            ([Rule("", "favGoods", "", "exists")], bool),
            ([Rule("", "favGoods", "10-12", "rangeBoth"), Rule("", "favGoods", "890", "rangeGte")],
             lambda g: any(10 <= x <= 12 or x >= 890 for x in g))]:
        got = {r.memberId for r in goods.select_by_goods(members, chunks, rules).collect() if r.memberId is not None}
        assert got == {m for m in range(70) if test(held.get(m, set()))}, rules
