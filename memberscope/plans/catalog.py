"""Registered queries: every data product over the shared tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables of that folder. So that two engines can be compared value by
value, whichever way the values are fetched, arrays leave as sorted
comma-joined text and money as DOUBLE converted from the exact DECIMAL sum
(the products themselves return DECIMAL); everything else keeps its type.

Parameters that the reference hard-coded (its "today", the free-coupon id,
the text sentinel) are the constants below, chosen for the shared tables:
their events cover 2024-01-01 … 2024-01-30.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.functions.calendar import (DATE_PATTERNS, day_start, reformat, shift_text,
                                            wall_clock_text)
from memberscope.functions.rules import Rule, standard_rules
from memberscope.operators import (audience, bitmap_index, calendar_jobs, distributions,
                                   funnel, growth, hotwords, membership, range_members, tags)
from memberscope.operators import goods_chunks as goods
from memberscope.plans import refresh, sql
from memberscope.session import scratch_path, stored_table
from memberscope.sources import document_index, sinks
from memberscope.sources.bucketed import MemberCatalog
from memberscope.sources.ledger import Ledger
from memberscope.sources.tables import Domain, LoadedTables, Tables, read_table
from memberscope.sources.text import read_lines, text_lines
from memberscope.sources.views import register_views

AS_OF = "2024-01-30"
FREE_COUPON_ID = 1
PHONE_SENTINEL = "null"
# The shared tables' codes for the tag catalogue (sex = market segment,
# channel = nation key).
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
NATIONS = tuple(range(25))

# (BUILDING or FURNITURE) and two or more orders and a coupon spend of
# at least 1000 and a free coupon granted.
AUDIENCE_RULES = (
    Rule("building", "sex", "BUILDING", "match"),
    Rule("furniture", "sex", "FURNITURE", "match"),
    Rule("ordered again", "orderCount", "2", "rangeGte"),
    Rule("spend 1000+", "chargeMoney", "1000", "rangeGte"),
    Rule("free coupon granted", "freeCouponTime", "", "exists"),
)

# A20, second selection: two or more orders, goods 1 or 2 bought, and
# subscribed (the notMatch rule also keeps members without the tag).
AUDIENCE_GOODS_RULES = (
    Rule("ordered again", "orderCount", "2", "rangeGte"),
    Rule("coffee 1", "favGoods", "1", "match"),
    Rule("coffee 2", "favGoods", "2", "match"),
    Rule("subscribed", "subOpenId", "null", "notMatch"),
)

AUDIENCE_INDEX_RULES = (
    Rule("ordered often", "orderCount", "9", "rangeGte"),
    Rule("spent", "orderMoney", "1500000-2600000", "rangeBoth"),
    Rule("lately", "orderTime", "2001-03-01", "rangeGte"),
    Rule("subscribed", "subOpenId", "null", "notMatch"),
)

CHUNK_RULES = (
    Rule("good 1", "favGoods", "1", "match"),
    Rule("good 2", "favGoods", "2", "match"),
    Rule("goods 10 to 12", "favGoods", "10-12", "rangeBoth"),
)


def _ints_text(c: str):
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")


def _text_arrays(df: DataFrame) -> DataFrame:
    """Array columns as comma-joined text (elements already sorted), money
    (DECIMAL) as DOUBLE."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "array":
            out.append(_ints_text(f.name).alias(f.name))
        elif f.dataType.typeName() == "decimal":
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _tag_table(spark: SparkSession, sf: str, parity: bool = False) -> DataFrame:
    d = Domain(spark, sf)
    return tags.member_tags(d.member, d.order, d.order_item, d.coupon_member,
                            d.coupon, d.delivery, d.feedback,
                            free_id=FREE_COUPON_ID, parity=parity,
                            order_line=d.order_line)


def tag_rules() -> list[Rule]:
    """The tag-page catalogue for the shared tables' codes."""
    return standard_rules(AS_OF, sex_codes=[(s, s.lower()) for s in SEGMENTS],
                          channel_codes=[(n, f"nation {n}") for n in NATIONS],
                          sub_sentinel=PHONE_SENTINEL)


def fitted_rules() -> list[Rule]:
    """The same catalogue with days and ranges of the shared tables' own:
    their registrations fill January 2024, their orders end in August 2001."""
    return standard_rules(
        AS_OF, sex_codes=[(s, s.lower()) for s in SEGMENTS],
        channel_codes=[(n, f"nation {n}") for n in NATIONS], sub_sentinel=PHONE_SENTINEL,
        reg_as_of="2024-01-09", order_as_of="2001-08-01", incomplete="3",
        charge_ranges=("10000-20000", "20000-22500", "22500-24000", "24000-26500", "26500-40000"),
        order_ranges=("10000-1500000", "1500000-2000000", "2000000-2500000", "2500000-3000000", "3000000-9000000"),
        thresholds=(0, 9_000_000, 18_000_000, 36_000_000))


# ---------------------------------------------------------------- A1–A6

def member_sex(spark, sf):
    return distributions.member_sex(Domain(spark, sf).member_plain)


def member_channel(spark, sf):
    return distributions.member_channel(Domain(spark, sf).member_plain)


def member_subscription(spark, sf):
    return distributions.sentinel_counts(Domain(spark, sf).member_plain, "mp_open_id")


def member_heat(spark, sf):
    d = Domain(spark, sf)
    return distributions.member_heat(d.member_plain, d.order, d.coupon_member,
                                     sentinel=PHONE_SENTINEL)


def member_overview(spark, sf):
    d = Domain(spark, sf)
    return distributions.member_overview(d.member_plain, d.order,
                                         d.coupon_member, sentinel=PHONE_SENTINEL)


def member_overview_json(spark, sf):
    """A5 exported as one JSON document (B7), as the overview is handed on."""
    return sinks.json_rows(member_overview(spark, sf), ignore_nulls=False)


def conversion_funnel(spark, sf):
    d = Domain(spark, sf)
    # coupons are bought by purchase events: one scan of the events
    return funnel.conversion_funnel(d.order, None, behaviour=d.t.events, buy_event="purchase")


def conversion_funnel_constants(spark, sf):
    """A6 as the reference reports it: no behaviour table, so the first three
    stages are its constants; the last three are computed."""
    d = Domain(spark, sf)
    return funnel.conversion_funnel(d.order, d.coupon_bought)


# ---------------------------------------------------------------- A7–A10

def growth_daily(spark, sf):
    d = Domain(spark, sf)
    return _text_arrays(growth.growth_daily(d.registration, d.purchase, AS_OF))


def growth_daily_parity(spark, sf):
    d = Domain(spark, sf)
    return _text_arrays(growth.growth_daily(d.registration, d.purchase, AS_OF, parity=True))


def growth_rollup(spark, sf):
    """The per-day rollup behind the growth line (what the growth job keeps
    as a day-partitioned table)."""
    d = Domain(spark, sf)
    return _text_arrays(growth.daily_rollup(d.registration, d.purchase))


def reg_two_weeks(spark, sf):
    return growth.last_weeks_counts(Domain(spark, sf).registration,
                                    "create_time", "id", AS_OF, 2, "regCount")


def order_two_weeks(spark, sf):
    return growth.last_weeks_counts(Domain(spark, sf).purchase, "create_time",
                                    "order_id", AS_OF, 2, "orderCount")


def week_on_week(spark, sf):
    return growth.week_on_week(Domain(spark, sf).registration, "create_time",
                               "id", AS_OF)


def week_on_week_orders(spark, sf):
    return growth.week_on_week(Domain(spark, sf).purchase, "create_time",
                               "order_id", AS_OF)


# ---------------------------------------------------------------- A11

def hot_words(spark, sf):
    lines = text_lines(Tables(spark, sf).documents, "text")
    return hotwords.hot_words(lines, sep=" ", field=0, k=10)


# ---------------------------------------------------------------- A12–A19

def tag_member_base(spark, sf):
    return tags.tag_member_base(Domain(spark, sf).member)


def tag_order_behavior(spark, sf):
    d = Domain(spark, sf)
    return _text_arrays(tags.tag_order_behavior(d.order, d.order_item))


def tag_order_behavior_parity(spark, sf):
    d = Domain(spark, sf)
    return _text_arrays(tags.tag_order_behavior(d.order, d.order_item, parity=True))


def tag_order_features(spark, sf):
    d = Domain(spark, sf)
    return _text_arrays(tags.tag_order_features(d.order, d.order_line))


def tag_free_coupon(spark, sf):
    return tags.tag_free_coupon(Domain(spark, sf).coupon_member, FREE_COUPON_ID)


def tag_free_coupon_parity(spark, sf):
    return tags.tag_free_coupon(Domain(spark, sf).coupon_member, FREE_COUPON_ID,
                                parity=True)


def tag_coupon_times(spark, sf):
    return _text_arrays(tags.tag_coupon_times(Domain(spark, sf).coupon_member,
                                              FREE_COUPON_ID))


def tag_charge_money(spark, sf):
    d = Domain(spark, sf)
    return _text_arrays(tags.tag_charge_money(d.coupon_granted, d.coupon))


def tag_over_time(spark, sf):
    return tags.tag_over_time(Domain(spark, sf).delivery)


def tag_over_time_per_delivery(spark, sf):
    return tags.tag_over_time(Domain(spark, sf).delivery, per_delivery=True)


def tag_feedback_latest(spark, sf):
    return tags.tag_feedback_latest(Domain(spark, sf).feedback)


def member_tags(spark, sf):
    return _text_arrays(_tag_table(spark, sf))


def member_tags_parity(spark, sf):
    return _text_arrays(_tag_table(spark, sf, parity=True))


# ---------------------------------------------------------------- A20–A23

def audience_select(spark, sf):
    return _text_arrays(audience.audience_select(_tag_table(spark, sf),
                                                 AUDIENCE_RULES))


def audience_select_goods(spark, sf):
    return _text_arrays(audience.audience_select(_tag_table(spark, sf),
                                                 AUDIENCE_GOODS_RULES))


def tag_facets(spark, sf):
    return audience.tag_facets(_tag_table(spark, sf), tag_rules())


def _tag_index(spark, sf) -> bitmap_index.TagIndex:
    """The tag table's bitmap index, built below the checkpoint folder."""
    path = scratch_path(spark, f"tag-index-{uuid.uuid4().hex}")
    sinks.write_table(_tag_table(spark, sf), f"{path}-tags")
    return bitmap_index.build(spark.read.parquet(f"{path}-tags"), path)


def audience_index_select(spark, sf):
    """A20 from the bitmap index: members of the first audience."""
    return _tag_index(spark, sf).select(AUDIENCE_RULES)


def audience_index_goods(spark, sf):
    """A20 from the bitmap index: members of the second audience who also
    spent between two bounds and ordered lately."""
    return _tag_index(spark, sf).select(AUDIENCE_INDEX_RULES)


def tag_index_facets(spark, sf):
    """A21 from the bitmap index, over the fitted catalogue."""
    return _tag_index(spark, sf).facets(fitted_rules())


def audience_rules(spark, sf) -> DataFrame:
    """A rule table in the schema of ``operators.membership``: an audience per
    part (its buyers, narrowed by sex, orders or money), per supplier
    (members of its nation by coupons) and per region (nearly everyone)."""
    t = Tables(spark, sf)
    k, text = F.col("k"), lambda c: c.cast("string")
    segment = lambda i: F.get(F.array(*map(F.lit, SEGMENTS)), (i % len(SEGMENTS)).cast("int"))

    def rule(when, name, kind, value):
        return F.when(when, F.struct(F.lit(name).alias("name"), value.alias("value"), F.lit(kind).alias("type")))

    every = F.lit(True)
    number = lambda low, step, by: text(low + step * (k % by))
    parts = t.part.select(F.col("p_partkey").alias("k")).select(k.alias("audienceId"), F.explode(F.array(
        rule(every, "favGoods", "match", text(k)), rule(k % 5 == 0, "favGoods", "match", text(k + 1)),
        rule(k % 4 == 0, "sex", "match", segment(k)), rule(k % 4 == 0, "sex", "match", segment(k + 2)),
        rule(k % 4 == 1, "orderCount", "rangeGte", number(6, 1, 8)),
        rule(k % 4 == 2, "orderMoney", "rangeBoth", F.concat(
            number(1_000_000, 200_000, 7), F.lit("-"), number(2_600_000, 300_000, 5))),
        rule(k % 4 == 3, "orderTime", "rangeGte", F.concat(F.lit("2001-0"), number(1, 1, 7), F.lit("-01"))),
        rule(k % 3 == 0, "subOpenId", "notMatch", F.lit(PHONE_SENTINEL)))).alias("r"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("k"), "s_nationkey").select(
        (-k).alias("audienceId"), F.explode(F.array(
            rule(every, "channel", "match", text(F.col("s_nationkey"))),
            rule(every, "chargeMoney", "rangeBoth", F.concat(
                number(16_000, 1_000, 9), F.lit("-"), number(24_000, 1_500, 6))),
            rule(k % 2 == 0, "regTime", "exists", F.lit("")),
            rule(k % 3 == 0, "couponTimes", "match", F.concat(F.lit("2024-01-1"), number(0, 1, 10))),
            rule(k % 7 == 0, "freeCouponTime", "rangeBoth", F.lit("2024-01-05-2024-01-20")))).alias("r"))
    regions = t.region.select(F.col("r_regionkey").cast("bigint").alias("k")).select(
        (k + 1_000_000_000_000).alias("audienceId"), F.explode(F.array(
            rule(every, "subOpenId", "notMatch", F.lit(PHONE_SENTINEL)), rule(every, "sex", "notMatch", segment(k)),
            rule(k == 4, "sex", "notMatch", segment(k + 1)))).alias("r"))
    rules = parts.unionByName(suppliers).unionByName(regions)
    return rules.where("r is not null").select("audienceId", "r.*")


def audience_membership(spark, sf):
    """A20 for all stored audiences at once."""
    table = scratch_path(spark, f"tags-{uuid.uuid4().hex}")
    sinks.write_table(_tag_table(spark, sf).drop("phone"), table)
    return membership.membership(spark.read.parquet(table), audience_rules(spark, sf))


def goods_chunks(spark, sf):
    """Distinct goods per member in ordered chunks of eight."""
    d = Domain(spark, sf)
    return _text_arrays(goods.goods_chunks(goods.member_goods(d.order, d.order_item), chunk=8))


def audience_goods_chunks(spark, sf):
    """A20 by rules over chunks: members who bought good 1 or 2, or a good
    from 10 to 12."""
    d = Domain(spark, sf)
    chunks = goods.goods_chunks(goods.member_goods(d.order, d.order_item), chunk=8)
    return goods.select_by_goods(d.member_plain.select(F.col("id").alias("memberId")), chunks, CHUNK_RULES)


class _Staged:
    """The shared tables as sets of files that change: ``first`` holds most
    rows and some that will be withdrawn, ``second`` the same files without
    those, and files of late rows."""

    def __init__(self, spark, sf, names):
        self.spark, self.base = spark, scratch_path(spark, f"staged-{uuid.uuid4().hex}")
        self.first, self.second = {}, {}
        for name, key in names.items():
            t = read_table(spark, sf, name)
            late = F.coalesce(F.pmod(F.xxhash64(key, F.lit("late")), F.lit(9)) == 0, F.lit(False))
            wrong = t.where(F.pmod(F.xxhash64(key, F.lit("wrong")), F.lit(40)) == 0)
            wrong = wrong.withColumns({c: F.col(c) - F.expr("INTERVAL 400 DAYS") for c, ty in wrong.dtypes
                                       if ty.startswith("timestamp")})
            if name == "customer":
                wrong = wrong.withColumn(key, -F.col(key))
            for part, rows in (("early", t.where(~late)), ("late", t.where(late)), ("wrong", wrong)):
                rows.write.parquet(f"{self.base}/{name}/{part}")
            at = lambda *parts, n=name: spark.read.schema(t.schema).parquet(
                *[f"{self.base}/{n}/{p}" for p in parts])
            self.first[name], self.second[name] = at("early", "wrong"), at("early", "late")


def growth_daily_ledger(spark, sf):
    """A7 from a stored rollup that was refreshed through the file ledger
    after late rows came in and wrong ones were withdrawn."""
    staged = _Staged(spark, sf, {"events": "event_id"})
    path = scratch_path(spark, f"rollup-{uuid.uuid4().hex}")
    book = Ledger(spark, f"{path}-ledger")
    for tables in (staged.first, staged.second):
        d = Domain(spark, tables=LoadedTables(**tables))
        rollup = refresh.refresh_growth(d.registration, d.purchase, book, path, {
            "events": (tables["events"], "ts")})
    return _text_arrays(growth.growth_from_rollup(rollup, AS_OF, days=20))


def member_tags_bucketed(spark, sf):
    """A19 from catalog tables bucketed by member: six joins, no exchange."""
    tables = MemberCatalog(spark, prefix=f"member_{uuid.uuid4().hex}_").write(Domain(spark, sf))
    return _text_arrays(tables.member_tags(FREE_COUPON_ID))


def tag_charge_money_isolated(spark, sf):
    """A16 with hot coupons found by a sketch and joined apart."""
    d = Domain(spark, sf)
    return _text_arrays(tags.tag_charge_money(d.coupon_granted, d.coupon, hot_share=0.005))


def day_ranges(spark, sf) -> DataFrame:
    """A range of days per supplier, in the schema of ``range_members``."""
    k = F.col("s_suppkey")
    first = F.date_add(F.lit("2023-12-28").cast("date"), (k % 31).cast("int"))
    return Tables(spark, sf).supplier.select(
        k.alias("rangeId"), first.alias("start"), F.date_add(first, (k % 23).cast("int")).alias("end"))


def active_members_range(spark, sf):
    """Distinct active members of many ranges of days, from the dyadic
    tree of day bitmaps."""
    events = Tables(spark, sf).events
    tree = range_members.build(events, "user_id", "ts", scratch_path(spark, f"day-tree-{uuid.uuid4().hex}"))
    out = range_members.active_members(tree, day_ranges(spark, sf))
    return out.select("rangeId", F.date_format("start", "yyyy-MM-dd").alias("start"),
                      F.date_format("end", "yyyy-MM-dd").alias("end"), "members")


def tag_index_documents(spark, sf):
    """The tag table written to a document index (once in part, then
    whole, then the same again) and read back, as its documents."""
    path = scratch_path(spark, f"tag-documents-{uuid.uuid4().hex}")
    table = stored_table(spark, _text_arrays(_tag_table(spark, sf)), "tag-documents-source")
    document_index.create_index(path)
    wrong = table.where("memberId % 3 = 0").withColumn("phone", F.lit("old")).withColumn("memberId", F.col("memberId") + F.when(
        F.col("memberId") % 2 == 0, 10**9).otherwise(0))
    document_index.write_index(wrong, path, mode="append")
    for _ in range(2):
        document_index.write_index(table, path)
    return document_index.read_index(spark, path, table.schema)


#: What the ledger notes of each shared table, and what that key is.
TAG_SOURCES = {"customer": ("c_custkey", "member"), "orders": ("o_custkey", "member"),
               "lineitem": ("l_orderkey", "order"), "events": ("user_id", "member"),
               "part": ("p_partkey", "coupon")}


def member_tags_incremental(spark, sf):
    """A19 refreshed through the file ledger: built over the first state of
    the tables, then brought to the second by the touched members alone."""
    staged = _Staged(spark, sf, {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey",
                                 "events": "event_id", "part": "p_partkey"})
    path = scratch_path(spark, f"member-tags-{uuid.uuid4().hex}")
    book = Ledger(spark, f"{path}-ledger")
    for tables in (staged.first, staged.second):
        d = Domain(spark, tables=LoadedTables(**tables))
        out = refresh.refresh_tags(d, book, path, {
            n: (tables[n], key, what) for n, (key, what) in TAG_SOURCES.items()}, FREE_COUPON_ID)
    return _text_arrays(out)


def free_coupon_reminder(spark, sf):
    free = tags.tag_free_coupon(Domain(spark, sf).coupon_member, FREE_COUPON_ID)
    return audience.free_coupon_reminder(free, AS_OF)


def _stored_tags(spark, sf) -> DataFrame:
    return stored_table(spark, _tag_table(spark, sf), "member-tags")


def free_coupon_reminder_stored(spark, sf):
    """A22 from the stored tag table."""
    return audience.stored_free_coupon_reminder(_stored_tags(spark, sf), AS_OF)


def audience_text_export(spark, sf):
    """The second index audience written as text, one member a line, and
    read back."""
    path = scratch_path(spark, f"member-{uuid.uuid4().hex}.txt")
    sinks.write_member_text(audience.audience_select(_stored_tags(spark, sf), AUDIENCE_INDEX_RULES), path)
    return read_lines(spark, path).select(F.col("line").cast("bigint").alias("memberId"))


def hot_words_files(spark, sf):
    """A11 over text files (B2): the documents' lines written as a log, one
    record a line, and counted from there."""
    path = scratch_path(spark, f"log-{uuid.uuid4().hex}")
    text_lines(Tables(spark, sf).documents, "text").select(F.col("line").alias("value")).write.text(path)
    return hotwords.hot_words(read_lines(spark, path), sep=" ", field=0, k=10)


def free_coupon_expiring(spark, sf):
    """A22, the other reading: free coupons that expire in k days."""
    free = tags.tag_free_coupon(Domain(spark, sf).coupon_member, FREE_COUPON_ID)
    return audience.free_coupon_reminder(free, AS_OF, expiring=True)


def coupon_expiry(spark, sf):
    return audience.coupon_expiry_from_grants(Domain(spark, sf).coupon_member, AS_OF,
                                              FREE_COUPON_ID)


def coupon_expiring(spark, sf):
    """A23, the other reading: grants that expire in k days."""
    return audience.coupon_expiry_from_grants(Domain(spark, sf).coupon_member, AS_OF,
                                              FREE_COUPON_ID, expiring=True)


# ---------------------------------------------------------------- D1–D4

def mixed_date_text(orders: DataFrame) -> DataFrame:
    """Order days written four ways (three date formats and one non-date),
    chosen by the order key – the input of the date normaliser."""
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    d = F.col("o_orderdate")
    txt = (F.when(k == 0, wall_clock_text(d, "yyyy-MM-dd"))
           .when(k == 1, wall_clock_text(d, "yyyy/MM/dd HH:mm"))
           .when(k == 2, wall_clock_text(d, "yyyy年MM月dd日"))
           .otherwise(F.concat(F.lit("#"), F.col("o_orderkey").cast("string"))))
    return orders.select("o_orderkey", txt.alias("txt"))


def normalize_dates(spark, sf):
    mixed = mixed_date_text(Tables(spark, sf).orders)
    out = calendar_jobs.normalize_dates(mixed, "txt", prefix="d")
    return out.select("o_orderkey", "txt", "d_style", "d_valid",
                      wall_clock_text("d_ts", "yyyy-MM-dd HH:mm:ss").alias("d_text"))


def calendar_features(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return calendar_jobs.calendar_features(o, "o_orderdate").drop("o_orderdate")


def any_date_text(orders: DataFrame) -> DataFrame:
    """Each order's time written in one of all date patterns, by its key;
    every 24th is no date."""
    k = F.pmod(F.col("o_orderkey"), F.lit(len(DATE_PATTERNS) + 1))
    moment = F.timestamp_add("SECOND", (F.col("o_orderkey") * 7919 % 86_400).cast("int"), F.col("o_orderdate"))
    text = F.concat(F.lit("#"), F.col("o_orderkey").cast("string"))
    for i, p in enumerate(DATE_PATTERNS):
        text = F.when(k == i, wall_clock_text(moment, p)).otherwise(text)
    return orders.select("o_orderkey", text.alias("txt"))


def normalize_all_dates(spark, sf):
    """D1 over all patterns, and the text overloads: each text parsed, named
    by its pattern and rendered anew."""
    texts = stored_table(spark, any_date_text(Tables(spark, sf).orders), "date-texts")
    out = calendar_jobs.normalize_dates(texts, "txt", prefix="d")
    return out.select("o_orderkey", "txt", "d_style", "d_valid",
                      reformat("txt", "yyyy/MM/dd HH:mm:ss").alias("d_text"))


#: One shift per unit, forward and back.
TEXT_SHIFTS = (("YEAR", -3), ("MONTH", 13), ("DAY", -40), ("HOUR", 30), ("MINUTE", -95), ("SECOND", 4000))


def shift_date_texts(spark, sf):
    """D3 on texts: every unit, forward and back, in the text's own pattern."""
    texts = stored_table(spark, any_date_text(Tables(spark, sf).orders), "date-texts")
    return texts.select("o_orderkey", *[
        shift_text("txt", unit, n).alias(unit.lower()) for unit, n in TEXT_SHIFTS])


def shift_dates(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    out = calendar_jobs.shift_dates(
        o, "o_orderdate", [("YEAR", 1), ("MONTH", 1), ("DAY", 3), ("HOUR", 5)],
        "shifted")
    return out.select("o_orderkey",
                      wall_clock_text("shifted", "yyyy-MM-dd HH:mm:ss").alias("shifted"))


def interval_days(spark, sf):
    o = Tables(spark, sf).orders
    span = o.groupBy(F.col("o_custkey").alias("memberId")).agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return calendar_jobs.interval_days(span, "last", "first", "days") \
        .select("memberId", "days")


# ---------------------------------------------------------------- SQL surface

def member_sex_sql(spark, sf):
    register_views(spark, sf)
    return sql.distribution(spark, "sex")


def member_heat_orders_sql(spark, sf):
    register_views(spark, sf)
    return sql.heat_orders(spark)


def reg_two_weeks_sql(spark, sf):
    register_views(spark, sf)
    return sql.daily_counts(spark, "t_registration", "id", "regCount",
                            day_start(AS_OF, -14), AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "member_sex": member_sex,
    "member_channel": member_channel,
    "member_subscription": member_subscription,
    "member_heat": member_heat,
    "member_overview_json": member_overview_json,
    "conversion_funnel": conversion_funnel,
    "conversion_funnel_constants": conversion_funnel_constants,
    "growth_daily": growth_daily,
    "growth_daily_parity": growth_daily_parity,
    "growth_rollup": growth_rollup,
    "reg_two_weeks": reg_two_weeks,
    "order_two_weeks": order_two_weeks,
    "week_on_week": week_on_week,
    "week_on_week_orders": week_on_week_orders,
    "hot_words": hot_words,
    "tag_member_base": tag_member_base,
    "tag_order_behavior": tag_order_behavior,
    "tag_order_behavior_parity": tag_order_behavior_parity,
    "tag_order_features": tag_order_features,
    "tag_free_coupon": tag_free_coupon,
    "tag_free_coupon_parity": tag_free_coupon_parity,
    "tag_coupon_times": tag_coupon_times,
    "tag_charge_money": tag_charge_money,
    "tag_over_time": tag_over_time,
    "tag_over_time_per_delivery": tag_over_time_per_delivery,
    "tag_feedback_latest": tag_feedback_latest,
    "member_tags": member_tags,
    "member_tags_parity": member_tags_parity,
    "audience_select": audience_select,
    "audience_select_goods": audience_select_goods,
    "tag_facets": tag_facets,
    "audience_index_select": audience_index_select,
    "audience_index_goods": audience_index_goods,
    "tag_index_facets": tag_index_facets,
    "audience_membership": audience_membership,
    "goods_chunks": goods_chunks,
    "audience_goods_chunks": audience_goods_chunks,
    "growth_daily_ledger": growth_daily_ledger,
    "member_tags_incremental": member_tags_incremental,
    "member_tags_bucketed": member_tags_bucketed,
    "tag_charge_money_isolated": tag_charge_money_isolated,
    "active_members_range": active_members_range,
    "tag_index_documents": tag_index_documents,
    "free_coupon_reminder_stored": free_coupon_reminder_stored,
    "audience_text_export": audience_text_export,
    "hot_words_files": hot_words_files,
    "normalize_all_dates": normalize_all_dates,
    "shift_date_texts": shift_date_texts,
    "free_coupon_reminder": free_coupon_reminder,
    "free_coupon_expiring": free_coupon_expiring,
    "coupon_expiry": coupon_expiry,
    "coupon_expiring": coupon_expiring,
    "normalize_dates": normalize_dates,
    "calendar_features": calendar_features,
    "shift_dates": shift_dates,
    "interval_days": interval_days,
    "member_sex_sql": member_sex_sql,
    "member_heat_orders_sql": member_heat_orders_sql,
    "reg_two_weeks_sql": reg_two_weeks_sql,
}
