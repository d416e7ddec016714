"""Audience products over the tag table: selection (A20), tag facets (A21),
free-coupon reminder buckets (A22) and coupon-expiry buckets (A23).

All of them are one pass over the tag table (or over one feature of it): a
filter, or one aggregation with a conditional count per rule. The rule list is
a handful of expressions, not data, so nothing grows with it but the width of
one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberscope.functions.calendar import (as_date, day_key, day_start, sorted_days,
                                            ts_literal)
from memberscope.functions.rules import (COUPON_EXPIRY_DAYS, COUPON_VALID_DAYS,
                                         RECENT_DAYS, as_rule, compile_rule,
                                         compile_rules)


def audience_select(tags: DataFrame, rules, keep_null: bool = True) -> DataFrame:
    """The members (all tag columns) that satisfy the rule selection."""
    return tags.where(compile_rules(rules, tags.schema, keep_null))


def tag_facets(tags: DataFrame, rules, keep_null: bool = True) -> DataFrame:
    """Members carrying each rule's tag: ``label, name, value, type,
    members``. One aggregation of conditional counts, then ``stack`` turns
    the one wide row into one row per rule."""
    rules = [as_rule(r) for r in rules]
    schema = tags.schema
    counts = tags.agg(*[
        F.count_if(compile_rule(r, schema, keep_null)).alias(f"c{i}")
        for i, r in enumerate(rules)])
    args = [a for i, r in enumerate(rules)
            for a in (F.lit(r.label), F.lit(r.name), F.lit(r.value), F.lit(r.type),
                      F.col(f"c{i}"))]
    return counts.select(F.stack(F.lit(len(rules)), *args)
                         .alias("label", "name", "value", "type", "members"))


def coupon_day_buckets(df: DataFrame, member_col: str, day_col: str, as_of,
                       valid_days: int = COUPON_VALID_DAYS,
                       ks=RECENT_DAYS, unique_member_days: bool = False,
                       expiring: bool = False) -> DataFrame:
    """Distinct members per bucket ``k`` of coupon grants.

    A coupon granted on day g expires on g + ``valid_days``. Bucket k holds
    the grants that expired k days before ``as_of`` (granted on
    ``as_of - valid_days - k``), or with ``expiring=True`` the grants that
    expire k days after it (granted on ``as_of - valid_days + k``): the two
    readings of the coupon-reminder pages, in one place.

    ``day_col`` is a day (DATE or yyyy-MM-dd text). Columns: ``k``, ``day``
    (the grant day of the bucket), ``days_from_expiry`` (``as_of`` minus the
    expiry day: k, or -k when expiring), ``members``. Every k in ``ks`` is
    present.

    A bucket is one day, so when the input has at most one row per (member,
    day) – ``unique_member_days=True`` – a plain count is the distinct count
    and the extra shuffle of a distinct aggregation is skipped.
    """
    ks = list(ks)
    as_of = as_date(as_of)
    sign = -1 if expiring else 1
    since_expiry = F.datediff(F.lit(as_of), F.to_date(F.col(day_col))) - F.lit(valid_days)
    k = since_expiry * F.lit(sign)
    counted = (df.select(k.alias("k"), F.col(member_col).alias("m"))
               .where(F.col("k").isin(ks) & F.col("m").isNotNull())
               .groupBy("k").agg((F.count("m") if unique_member_days
                                  else F.countDistinct("m")).alias("members")))
    spine = df.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(x) for x in ks])).alias("k"))
    offset = F.col("k") * F.lit(sign)
    # Both sides have at most len(ks) rows: the broadcast is bounded.
    return sorted_days(
        spine.join(F.broadcast(counted), "k", "left")
        .select(F.col("k").cast("int").alias("k"),
                F.date_format(F.date_sub(F.lit(as_of), offset + F.lit(valid_days)),
                              "yyyy-MM-dd").alias("day"),
                offset.cast("int").alias("days_from_expiry"),
                F.coalesce("members", F.lit(0)).cast("bigint").alias("members")), "k")


def free_coupon_reminder(free_coupon: DataFrame, as_of,
                         valid_days: int = COUPON_VALID_DAYS,
                         ks=RECENT_DAYS, expiring: bool = False) -> DataFrame:
    """A22 over the ``freeCouponTime`` tag (one row per member)."""
    return coupon_day_buckets(free_coupon, "memberId", "freeCouponTime", as_of,
                              valid_days, ks, unique_member_days=True,
                              expiring=expiring)


def stored_free_coupon_reminder(stored: DataFrame, as_of, valid_days: int = COUPON_VALID_DAYS,
                                ks=RECENT_DAYS, expiring: bool = False) -> DataFrame:
    """A22 from the stored tag table: only its day column is read, and the
    buckets' days reach the scan as plain values."""
    sign = 1 if expiring else -1
    days = [day_start(as_of, -valid_days + sign * k).date().isoformat() for k in ks]
    wanted = stored.select("memberId", "freeCouponTime").where(F.col("freeCouponTime").isin(days))
    return free_coupon_reminder(wanted, as_of, valid_days, ks, expiring)


def coupon_expiry(coupon_times: DataFrame, as_of,
                  valid_days: int = COUPON_VALID_DAYS,
                  ks=COUPON_EXPIRY_DAYS, expiring: bool = False) -> DataFrame:
    """The same buckets over every day of the ``couponTimes`` tag (one
    row per member, each day listed once)."""
    days = coupon_times.select("memberId",
                               F.explode("couponTimes").alias("couponDay"))
    return coupon_day_buckets(days, "memberId", "couponDay", as_of,
                              valid_days, ks, unique_member_days=True,
                              expiring=expiring)


def coupon_expiry_from_grants(coupon_member: DataFrame, as_of, free_id: int = 1,
                              valid_days: int = COUPON_VALID_DAYS,
                              ks=COUPON_EXPIRY_DAYS, expiring: bool = False) -> DataFrame:
    """A23 straight from the holdings, for use without a written tag table.

    Only the buckets' grant days are read: their half-open ranges are plain
    comparisons on ``create_time``, which reach the scan, so the work is that
    of ``len(ks)`` days however long the history is. The days of a member are
    not gathered; (member, day) is reduced map-side before the shuffle.
    """
    sign = 1 if expiring else -1
    ts = F.col("create_time")
    wanted = F.lit(False)
    for k in ks:
        start = day_start(as_of, -valid_days + sign * k)
        lo = ts_literal(coupon_member, "create_time", start)
        hi = ts_literal(coupon_member, "create_time", day_start(start, 1))
        wanted = wanted | ((ts >= lo) & (ts < hi))
    grants = coupon_member.where(wanted & (F.col("coupon_id") != F.lit(free_id))).select(
        "member_id", day_key("create_time").alias("couponDay")).distinct()
    return coupon_day_buckets(grants, "member_id", "couponDay", as_of, valid_days, ks,
                              unique_member_days=True, expiring=expiring)
