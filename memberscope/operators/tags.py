"""Member tag table (A12–A19): one wide row per member.

Every feature is an aggregation keyed by member, so its output is already
hash-partitioned on the member key. The final assembly (A19) is a chain of
left joins on that one key: with equal partition counts no feature side is
shuffled again; only the member base is. Features are reduced to one row per
member before they meet, so no join can fan out.

Arrays (``favGoods``, ``couponTimes``) are ``collect_set`` aggregations with
partial aggregation: every task sends, per member, the set of distinct values
it saw, and the final merge keeps each value once. A member owning a third of
all rows therefore costs at most one set per task in the shuffle, and its
final list is bounded by the number of distinct values (goods, days), never
by its row count.
"""

from __future__ import annotations

import decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberscope.functions.calendar import day_text
from memberscope.functions.money import MONEY_TOTAL, money
from memberscope.operators.hot_keys import isolated_join
from memberscope.operators.joins import lookup_join

TAG_COLUMNS = ("memberId", "phone", "sex", "channel", "subOpenId", "address",
               "regTime", "orderCount", "orderTime", "orderMoney", "favGoods",
               "freeCouponTime", "couponTimes", "chargeMoney", "overTime",
               "feedBack")

CHARGE_MONEY = "decimal(38,3)"


def _collect_distinct_sorted(pairs: DataFrame, key: str, value: str,
                             alias: str) -> DataFrame:
    """Sorted array of the distinct ``value`` per ``key`` (see the module
    note)."""
    return pairs.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(alias))


# ---------------------------------------------------------------- A12

def tag_member_base(member: DataFrame) -> DataFrame:
    """Identity tags: ``memberId, phone, sex, channel, subOpenId, address,
    regTime`` (registration day as yyyy-MM-dd)."""
    return member.select(
        F.col("id").alias("memberId"), "phone", "sex",
        F.col("member_channel").alias("channel"),
        F.col("mp_open_id").alias("subOpenId"),
        F.col("address_default_id").alias("address"),
        day_text("create_time").alias("regTime"))


# ---------------------------------------------------------------- A13

def tag_order_behavior(order: DataFrame, order_item: DataFrame,
                       parity: bool = False) -> DataFrame:
    """``memberId, orderCount, orderTime, orderMoney, favGoods``.

    Default: orders are counted and summed on their own, and the distinct
    goods are found separately, so an order with several lines counts once.

    ``parity=True`` keeps the reference's row-level form: orders are
    left-joined to their lines before counting, so count and money are
    multiplied by the number of lines of each order. The lines are counted
    per order first, so no raw line meets an order and an order with a third
    of all lines stays one row of the join.
    """
    if parity:
        counted = order_item.groupBy("order_id").agg(
            F.collect_set("commodity_id").alias("goods"), F.count(F.lit(1)).alias("n"))
        # an order without lines is one row of the left join
        n = F.coalesce("n", F.lit(1))
        flat = order.join(counted, "order_id", "left").select(
            "member_id", "order_id", "create_time", n.alias("n"),
            (money("pay_price") * n.cast("decimal(18,0)")).alias("amount"),
            F.posexplode_outer("goods").alias("pos", "good"))
        first = F.col("pos").isNull() | (F.col("pos") == 0)   # one row per order
        times = F.sum(F.when(first & F.col("order_id").isNotNull(), F.col("n")))
        return (flat.groupBy(F.col("member_id").alias("memberId"))
                .agg(F.coalesce(times, F.lit(0)).alias("orderCount"),
                     day_text(F.max("create_time")).alias("orderTime"),
                     F.sum(F.when(first, F.col("amount"))).cast(MONEY_TOTAL).alias("orderMoney"),
                     F.sort_array(F.collect_set("good")).alias("favGoods")))

    # one scan of orders and one of lines, each order meeting its goods once
    lines = order_item.where(F.col("commodity_id").isNotNull()).select(
        "order_id", "commodity_id", F.lit(None).cast("timestamp_ntz").alias("arrive_time"))
    return tag_order_features(order, lines).drop("overTime")


# ---------------------------------------------------------------- A13 + A17 in one pass

def tag_order_features(order: DataFrame, order_line: DataFrame) -> DataFrame:
    """``memberId, orderCount, orderTime, orderMoney, favGoods, overTime``:
    A13 (default form) and A17 together, for deliveries made of order lines
    (pick = order time, arrive = the line's arrival).

    One scan of each table instead of two (lines) and three (orders):

    1. lines → one row per order: distinct goods, last arrival, line count
       (partial aggregation map-side, so an order with a third of all lines
       sends one partial row per task);
    2. orders ⟕ that, one row per order on each side (a 1:1 join);
    3. one aggregation per member. Goods are exploded from the per-order sets
       and gathered with ``collect_set``, bounded by the distinct goods.
    """
    per_order = (order_line.groupBy("order_id")
                 .agg(F.collect_set("commodity_id").alias("goods"),
                      F.max("arrive_time").alias("arrive"),
                      F.count(F.lit(1)).alias("lines")))
    o = order.select("order_id", "member_id", "pay_price", "create_time")
    j = o.join(per_order, "order_id", "left")
    has_lines = F.col("lines").isNotNull()
    flat = j.select("order_id", "member_id", "pay_price", "create_time", "arrive",
                    has_lines.alias("has_lines"),
                    F.posexplode_outer("goods").alias("pos", "good"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)   # one row per order
    agg = flat.groupBy(F.col("member_id").alias("memberId")).agg(
        F.count(F.when(first, F.col("order_id"))).alias("orderCount"),
        day_text(F.max("create_time")).alias("orderTime"),
        F.sum(F.when(first, money("pay_price"))).cast(MONEY_TOTAL).alias("orderMoney"),
        F.sort_array(F.collect_set("good")).alias("favGoods"),
        F.max("arrive").alias("last_arrive"),
        F.max(F.when(F.col("has_lines"), F.col("create_time"))).alias("last_pick"))
    return agg.select(
        "memberId", "orderCount", "orderTime", "orderMoney", "favGoods",
        (F.unix_timestamp("last_arrive") - F.unix_timestamp("last_pick")).alias("overTime"))


# ---------------------------------------------------------------- A14, A15

def tag_free_coupon(coupon_member: DataFrame, free_id: int = 1,
                    parity: bool = False) -> DataFrame:
    """``memberId, freeCouponTime``: day the first-order-free coupon was
    granted. Default: the earliest grant, one row per member; ``parity=True``
    gives one row per grant (the reference's form, which fans out the tag
    table for members granted it twice)."""
    free = coupon_member.where(F.col("coupon_id") == F.lit(free_id))
    if parity:
        return free.select(F.col("member_id").alias("memberId"),
                           day_text("create_time").alias("freeCouponTime"))
    return (free.groupBy(F.col("member_id").alias("memberId"))
            .agg(day_text(F.min("create_time")).alias("freeCouponTime")))


def tag_coupon_times(coupon_member: DataFrame, free_id: int = 1) -> DataFrame:
    """``memberId, couponTimes``: the days other coupons were granted.

    Each day appears once, sorted. The list is therefore bounded by the
    number of calendar days, never by the number of grants of one member.
    """
    other = (coupon_member.where(F.col("coupon_id") != F.lit(free_id))
             .select(F.col("member_id").alias("memberId"),
                     day_text("create_time").alias("d")))
    return _collect_distinct_sorted(other, "memberId", "d", "couponTimes")


# ---------------------------------------------------------------- A16

def tag_charge_money(coupon_member: DataFrame, coupon: DataFrame,
                     channel_pred: Column | None = None,
                     share: float = 0.5, salt_buckets: int = 0,
                     hot_share: float | None = None) -> DataFrame:
    """``memberId, chargeMoney``: sum of ``coupon_price * share`` over the
    member's coupons with ``coupon_channel != 1`` (default predicate).

    Holdings are first reduced to (member, coupon, count), map-side, so the
    join with the coupon dimension sees one row per distinct holding. The
    coupon side is a dimension: AQE broadcasts it when its measured size is
    under the broadcast threshold and keeps a sort-merge join (with skewed
    partitions split) when it is not; ``salt_buckets`` salts the join
    instead (``operators.joins.lookup_join``) for a coupon held by very many
    members; ``hot_share`` salts only the coupons that more than this share of
    the distinct holdings have (``operators.hot_keys``).
    """
    pred = channel_pred if channel_pred is not None else (F.col("coupon_channel") != 1)
    held = (coupon_member.where(pred)
            .groupBy("member_id", "coupon_id").agg(F.count(F.lit(1)).alias("n")))
    prices = coupon.select(F.col("id").alias("coupon_id"), money("coupon_price").alias("price"))
    if hot_share is not None:
        priced = isolated_join(held, prices, "coupon_id", "member_id", share=hot_share)
    else:
        priced = lookup_join(held, prices, "coupon_id", salt_by="member_id", salt_buckets=salt_buckets)
    amount = ((F.col("price") * F.col("n")).cast(MONEY_TOTAL)
              * F.lit(decimal.Decimal(str(share))))
    return (priced.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.sum(amount).cast(CHARGE_MONEY).alias("chargeMoney")))


# ---------------------------------------------------------------- A14–A16 in one pass

def tag_coupon_features(coupon_member: DataFrame, coupon: DataFrame,
                        free_id: int = 1, channel_pred: Column | None = None,
                        share: float = 0.5, salt_buckets: int = 0) -> DataFrame:
    """``memberId, freeCouponTime, couponTimes, chargeMoney`` from **one**
    scan of the holdings – the same values as A14, A15 and A16 (default
    forms), which would each read and parse the holdings table again.

    1. Holdings are reduced to one row per (member, coupon): first grant,
       set of grant days, number of holdings the charge predicate keeps
       (partial aggregation map-side: a member with a third of all grants
       sends at most one row per coupon per task).
    2. That frame is priced against the coupon dimension (salted with
       ``salt_buckets``, see ``tag_charge_money``).
    3. The day sets are exploded and folded per member with ``collect_set``,
       which de-duplicates as it goes, so a member's buffer never exceeds the
       number of distinct days; money is taken once per coupon (position 0,
       or the single row of a coupon whose grants have no time).
    """
    pred = channel_pred if channel_pred is not None else (F.col("coupon_channel") != 1)
    per_coupon = (coupon_member
                  .groupBy(F.col("member_id").alias("memberId"), "coupon_id")
                  .agg(F.min("create_time").alias("first_time"),
                       F.collect_set(day_text("create_time")).alias("days"),
                       F.count_if(pred).alias("n")))
    priced = lookup_join(per_coupon, coupon.select(F.col("id").alias("coupon_id"),
                                                   money("coupon_price").alias("price")),
                         "coupon_id", salt_by="memberId", salt_buckets=salt_buckets)
    flat = priced.select("memberId", "coupon_id", "first_time", "price", "n",
                         F.posexplode_outer("days").alias("pos", "day"))
    is_free = F.col("coupon_id") == F.lit(free_id)
    first = F.col("pos").isNull() | (F.col("pos") == 0)  # one row per coupon
    amount = F.when(first & (F.col("n") > 0),
                    (F.col("price") * F.col("n")).cast(MONEY_TOTAL)
                    * F.lit(decimal.Decimal(str(share))))
    folded = flat.groupBy("memberId").agg(
        day_text(F.min(F.when(is_free, F.col("first_time")))).alias("freeCouponTime"),
        F.sort_array(F.collect_set(F.when(~is_free, F.col("day")))).alias("days"),
        F.max(F.when(is_free, F.lit(True))).alias("has_free"),
        F.max(F.when(~is_free, F.lit(True))).alias("has_other"),
        F.max(F.when(F.col("n") > 0, F.lit(True))).alias("has_charge"),
        F.sum(amount).cast(CHARGE_MONEY).alias("chargeMoney"))
    # A member appears when it has a holding of one of the three kinds (as in
    # the three separate tags); couponTimes exists, possibly empty, exactly
    # for members holding another coupon.
    return (folded.where(F.col("has_free") | F.col("has_other") | F.col("has_charge"))
            .select("memberId", "freeCouponTime",
                    F.when(F.col("has_other"), F.col("days")).alias("couponTimes"),
                    "chargeMoney"))


# ---------------------------------------------------------------- A17

def tag_over_time(delivery: DataFrame, per_delivery: bool = False) -> DataFrame:
    """``memberId, overTime`` in seconds.

    Default (reference): latest arrival minus latest pick-up, which may pair
    two different deliveries. ``per_delivery=True``: the longest single
    delivery.
    """
    g = delivery.groupBy(F.col("member_id").alias("memberId"))
    if per_delivery:
        return g.agg(F.max(F.unix_timestamp("arrive_time") -
                           F.unix_timestamp("pick_time")).alias("overTime"))
    return g.agg((F.unix_timestamp(F.max("arrive_time")) -
                  F.unix_timestamp(F.max("pick_time"))).alias("overTime"))


# ---------------------------------------------------------------- A18

def tag_feedback_latest(feedback: DataFrame) -> DataFrame:
    """``memberId, feedBack``: type of the member's latest feedback (greatest
    id). One aggregation with ``max_by``; no self join."""
    return (feedback.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.max_by("feedback_type", "id").alias("feedBack")))


# ---------------------------------------------------------------- A19

def member_tags(member: DataFrame, order: DataFrame, order_item: DataFrame,
                coupon_member: DataFrame, coupon: DataFrame,
                delivery: DataFrame, feedback: DataFrame, free_id: int = 1,
                parity: bool = False, order_line: DataFrame | None = None,
                salt_buckets: int = 0) -> DataFrame:
    """The 16-column tag table (``TAG_COLUMNS``).

    Default: one row per member. ``parity=True`` uses the reference's
    row-level order form and ungrouped free coupons (members granted the free
    coupon twice appear twice).

    ``order_line`` (``order_id, commodity_id, arrive_time``): when deliveries
    are the order lines themselves, pass them here and the order and delivery
    tags come from one pass (``tag_order_features``); ``order_item`` and
    ``delivery`` are then not read. ``salt_buckets`` salts the coupon
    pricing join (see ``tag_charge_money``).
    """
    base = tag_member_base(member)
    if order_line is not None and not parity:
        order_parts = [tag_order_features(order, order_line)]
    else:
        order_parts = [tag_order_behavior(order, order_item, parity=parity),
                       tag_over_time(delivery)]
    if parity:
        coupon_parts = [
            tag_free_coupon(coupon_member, free_id, parity=True),
            tag_coupon_times(coupon_member, free_id),
            tag_charge_money(coupon_member, coupon, salt_buckets=salt_buckets),
        ]
    else:
        coupon_parts = [tag_coupon_features(coupon_member, coupon, free_id,
                                            salt_buckets=salt_buckets)]
    features = [*order_parts, *coupon_parts, tag_feedback_latest(feedback)]
    out = base
    for f in features:
        out = out.join(f, "memberId", "left")
    return out.select(*TAG_COLUMNS)
