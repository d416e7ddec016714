"""Property tests on random small inputs.

- With NULLs, duplicates, orders without lines, lines of unknown orders and
  grants without a time, the one-pass tag computations equal the
  feature-by-feature forms.
- An audience selection equals a direct evaluation of the rules on each row.
- The growth line and the week comparison equal a direct count over the
  events.
- Heat and funnel counts (with NULL members and NULL order ids) equal a
  direct count.
- Hot words over random texts (every kind of line break, trailing breaks,
  empty and separator-only lines) and date parsing over random texts
  (including impossible dates) equal a direct Python computation.
"""

import datetime as dt
import re as _re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from memberscope.functions.rules import Rule
from memberscope.operators import (audience, calendar_jobs, distributions, funnel,
                                   growth, hotwords, tags)
from memberscope.sources.text import text_lines

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=list(HealthCheck))

day = st.one_of(st.none(), st.integers(0, 40).map(
    lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=d % 5)))
member = st.one_of(st.none(), st.integers(0, 4))
price = st.one_of(st.none(), st.integers(0, 10000).map(lambda c: c / 100))


@st.composite
def orders_and_lines(draw):
    n = draw(st.integers(1, 8))
    orders = [(i, draw(member), draw(price), draw(day)) for i in range(n)]
    lines = draw(st.lists(st.tuples(st.integers(0, n + 1),
                                    st.one_of(st.none(), st.integers(0, 5)), day),
                          max_size=20))
    return orders, lines


@st.composite
def holdings(draw):
    return draw(st.lists(st.tuples(member, st.one_of(st.none(), st.integers(0, 4)),
                                   st.sampled_from([1, 2]), day), max_size=25))


def _non_null(df, cols):
    return sorted((r for r in rows(df, *cols) if r[0] is not None), key=repr)


@SETTINGS
@given(data=orders_and_lines())
def test_order_features_equal_separate_tags(spark, data):
    orders, lines = data
    o = spark.createDataFrame(orders, "order_id long, member_id long, pay_price double, "
                                      "create_time timestamp")
    li = spark.createDataFrame(lines, "order_id long, commodity_id long, arrive_time timestamp")
    one = tags.tag_order_features(o, li)
    deliv = li.join(o, "order_id").select(
        "member_id", F.col("create_time").alias("pick_time"), "arrive_time")
    sep = (tags.tag_order_behavior(o, li.select("order_id", "commodity_id"))
           .join(tags.tag_over_time(deliv), "memberId", "left"))
    cols = ["memberId", "orderCount", "orderTime", "orderMoney", "favGoods", "overTime"]
    assert _non_null(one, cols) == _non_null(sep, cols)


@SETTINGS
@given(hold=holdings())
def test_coupon_features_equal_separate_tags(spark, hold):
    cm = spark.createDataFrame(hold, "member_id long, coupon_id int, coupon_channel int, "
                                     "create_time timestamp")
    coupon = spark.createDataFrame([(0, 1.5), (1, 2.25), (2, 10.0), (3, None)],
                                   "id int, coupon_price double")
    one = tags.tag_coupon_features(cm, coupon)
    sep = (tags.tag_free_coupon(cm)
           .join(tags.tag_coupon_times(cm), "memberId", "full")
           .join(tags.tag_charge_money(cm, coupon), "memberId", "full"))
    cols = ["memberId", "freeCouponTime", "couponTimes", "chargeMoney"]
    assert _non_null(one, cols) == _non_null(sep, cols)


# ---------------------------------------------------------------- rules

TAG_SCHEMA = ("memberId long, sex int, subOpenId string, orderCount long, "
              "orderMoney decimal(38,2), favGoods array<long>, regTime string")

tag_row = st.tuples(
    st.one_of(st.none(), st.sampled_from([-1, 1, 2])),
    st.one_of(st.none(), st.sampled_from(["null", "o1", "o2"])),
    st.one_of(st.none(), st.integers(0, 4)),
    st.one_of(st.none(), st.integers(0, 30000).map(lambda c: Decimal(c) / 100)),
    st.one_of(st.none(), st.lists(st.integers(1, 6), max_size=3, unique=True)),
    st.one_of(st.none(), st.sampled_from(["2024-01-01", "2024-01-15", "2024-01-29"])))

rule = st.one_of(
    st.builds(lambda v: Rule("", "sex", str(v), "match"), st.sampled_from([-1, 1, 2, 7])),
    st.builds(lambda v: Rule("", "subOpenId", v, "notMatch"), st.sampled_from(["null", "o1"])),
    st.builds(lambda v: Rule("", "subOpenId", v, "match"), st.sampled_from(["null", "o2"])),
    st.builds(lambda v: Rule("", "orderCount", str(v), "rangeGte"), st.integers(0, 4)),
    st.builds(lambda v: Rule("", "orderCount", str(v), "match"), st.integers(0, 4)),
    st.builds(lambda a, b: Rule("", "orderMoney", f"{a}-{a + b}", "rangeBoth"),
              st.integers(0, 200), st.integers(0, 100)),
    st.builds(lambda v: Rule("", "favGoods", str(v), "match"), st.integers(1, 6)),
    st.just(Rule("", "favGoods", "", "exists")),
    st.just(Rule("", "regTime", "", "exists")),
    st.builds(lambda v: Rule("", "regTime", v, "rangeGte"),
              st.sampled_from(["2024-01-10", "2024-01-20"])))

COLS = ["sex", "subOpenId", "orderCount", "orderMoney", "favGoods", "regTime"]


def _holds(r, row, keep_null):
    v = row[COLS.index(r.name)]
    if r.type == "exists":
        return v is not None and (not isinstance(v, list) or len(v) > 0)
    if r.type == "rangeBoth":
        lo, hi = (Decimal(x) for x in r.value.split("-"))
        return v is not None and lo <= v <= hi
    if isinstance(v, list):
        hit = int(r.value) in v
    elif v is None:
        hit = None
    else:
        hit = v == type(v)(r.value)
    if r.type == "match":
        return bool(hit)
    if r.type == "notMatch":
        return (not hit) if v is not None else keep_null
    return v is not None and v >= type(v)(r.value)  # rangeGte


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(tag_rows=st.lists(tag_row, max_size=12), rules=st.lists(rule, max_size=4),
       keep_null=st.booleans())
def test_rule_selection_equals_direct_evaluation(spark, tag_rows, rules, keep_null):
    data = [(i, *r) for i, r in enumerate(tag_rows)]
    df = spark.createDataFrame(data, TAG_SCHEMA)
    got = sorted(r[0] for r in audience.audience_select(df, rules, keep_null)
                 .select("memberId").collect())
    by_field = {}
    for r in rules:
        by_field.setdefault(r.name, []).append(r)
    want = sorted(i for i, *row in data
                  if all(any(_holds(r, row, keep_null) for r in rs) for rs in by_field.values()))
    assert got == want


# ---------------------------------------------------------------- growth

event_time = st.integers(0, 24 * 30 - 1).map(
    lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=h % 60))


@SETTINGS
@given(regs=st.lists(st.one_of(st.none(), event_time), max_size=30),
       buys=st.lists(st.tuples(st.one_of(st.none(), event_time),
                               st.integers(0, 99999).map(lambda c: c / 100)), max_size=30))
def test_growth_equals_python_model(spark, regs, buys):
    as_of = dt.date(2024, 1, 20)
    start = dt.datetime(2024, 1, 13)
    m = spark.createDataFrame([(i, t) for i, t in enumerate(regs)],
                              "id long, create_time timestamp")
    o = spark.createDataFrame([(i, p, t) for i, (t, p) in enumerate(buys)],
                              "order_id long, origin_price double, create_time timestamp")
    got = rows(growth.growth_daily(m, o, as_of))
    reg_days = sorted({t.date() for t in regs if t and t >= start})
    buy_days = {t.date() for t, _ in buys if t and t >= start}
    want = []
    for d in reg_days:
        if d not in buy_days:
            continue
        new = sum(1 for t in regs if t and t.date() == d)
        members = sum(1 for t in regs if t and t.date() <= d)
        orders = sum(1 for t, _ in buys if t and t.date() <= d)
        gmv = sum(Decimal(str(p)).quantize(Decimal("0.01")) for t, p in buys if t and t.date() <= d)
        want.append((d.isoformat(), new, members, orders, gmv))
    assert got == want
    wow = {r[0]: r for r in rows(growth.week_on_week(m, "create_time", "id", as_of))}
    assert len(wow) == 7
    for day, cnt, prev_day, prev, g in wow.values():
        d = dt.date.fromisoformat(day)
        assert cnt == sum(1 for t in regs if t and t.date() == d)
        assert prev == sum(1 for t in regs if t and t.date() == d - dt.timedelta(days=7))
        assert g == ((cnt - prev) / prev if prev else None)


# ---------------------------------------------------------------- counts


@SETTINGS
@given(members=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["null", "p"]))),
                        max_size=10),
       orders=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), member,
                                 st.sampled_from(["F", "O", "P"])), max_size=20),
       hold=holdings())
def test_heat_and_funnel_equal_python_model(spark, members, orders, hold):
    m = spark.createDataFrame([(i, ph) for i, (ph,) in enumerate(members)], "id long, phone string")
    o = spark.createDataFrame(orders, "order_id long, member_id long, order_status string")
    cm = spark.createDataFrame(hold, "member_id long, coupon_id int, coupon_channel int, "
                                     "create_time timestamp")
    heat = rows(distributions.member_heat(m, o, cm))[0]
    per = {}
    for oid, mid, _ in orders:
        per[mid] = per.get(mid, 0) + (oid is not None)
    want_heat = (sum(ph == "null" for (ph,) in members), sum(ph == "p" for (ph,) in members),
                 sum(n == 1 for n in per.values()), sum(n >= 2 for n in per.values()),
                 len({h[0] for h in hold if h[0] is not None}))
    assert heat == want_heat
    f = rows(funnel.conversion_funnel(o, cm))[0]
    done, done_rows = {}, set()
    for oid, mid, st_ in orders:
        if st_ == "F":
            done_rows.add(mid)
            done[mid] = done.get(mid, 0) + (oid is not None)
    again = {k for k, n in done.items() if n > 1}
    buyers = {h[0] for h in hold if h[2] == 1 and h[0] is not None}
    assert f == (1000, 800, 600, len(done_rows), len(again), len(again & buyers))


# ---------------------------------------------------------------- text

token = st.sampled_from(["a", "b", "ab", "", " ", "\t"])
text = st.lists(st.tuples(st.lists(token, max_size=4).map("".join),
                          st.sampled_from(["\n", "\r\n", "\r"])), max_size=6).map(
    lambda parts: "".join(w + br for w, br in parts)) | st.text("ab \t\n\r", max_size=20)


def _model_lines(t):
    body = _re.sub(r"(\r\n|\n|\r)\Z", "", t)
    return _re.split(r"\r\n|\n|\r", body)


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), text), max_size=5),
       sep=st.sampled_from([" ", "\t"]), field=st.sampled_from([0, 1]))
def test_hot_words_equal_python_model(spark, texts, sep, field):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = rows(hotwords.hot_words(text_lines(df), sep=sep, field=field, k=1000))
    counts = {}
    for t in texts:
        if t is None:
            continue
        for line in _model_lines(t):
            parts = line.split(sep)
            if field < len(parts):
                counts[parts[field]] = counts.get(parts[field], 0) + 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0].encode()))
    assert got == want


layout = st.sampled_from(["%Y-%m-%d", "%Y/%m/%d %H:%M", "%m-%d", "%H:%M:%S", "%Y年%m月%d日"])


@SETTINGS
@given(items=st.lists(st.tuples(layout, st.integers(1999, 2001), st.integers(0, 13),
                                st.integers(0, 32), st.integers(0, 24), st.integers(0, 60),
                                st.integers(0, 60)), max_size=15))
def test_date_parsing_equals_python_model(spark, items):
    texts = []
    for fmt, y, mo, d, h, mi, s in items:
        texts.append(fmt.replace("%Y", f"{y:04d}").replace("%m", f"{mo:02d}")
                     .replace("%d", f"{d:02d}").replace("%H", f"{h:02d}")
                     .replace("%M", f"{mi:02d}").replace("%S", f"{s:02d}"))
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = {r[0]: r[1] for r in rows(calendar_jobs.normalize_dates(df, "s"), "s", "s_ts")}
    for (fmt, *_), t in zip(items, texts):
        try:  # a text without a year is read in 1970, as Spark does
            want = (dt.datetime.strptime(t, fmt) if "%Y" in fmt
                    else dt.datetime.strptime("1970|" + t, "%Y|" + fmt))
        except ValueError:
            want = None
        assert got[t] == want, t
