"""Member distributions (A1, A2), sentinel split (A3), heat (A4) and the
nested overview record (A5).

All of them are aggregations whose result has one row per category (or one
row). Each input is scanned once; partial aggregation inside the scan stage
means a category holding a third of all rows still sends one row per task to
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_counts(df: DataFrame, key: str, id_col: str, key_alias: str,
                    count_alias: str) -> DataFrame:
    """``count(id)`` per value of ``key`` (NULL ids are not counted; a NULL
    key forms its own group, as in SQL)."""
    return (df.groupBy(F.col(key).alias(key_alias))
            .agg(F.count(id_col).alias(count_alias)))


def member_sex(member: DataFrame, sex: str = "sex", id_col: str = "id") -> DataFrame:
    """A1: ``memberSex, sexCount``."""
    return category_counts(member, sex, id_col, "memberSex", "sexCount")


def member_channel(member: DataFrame, channel: str = "member_channel",
                   id_col: str = "id") -> DataFrame:
    """A2: ``memberChannel, channelCount``."""
    return category_counts(member, channel, id_col, "memberChannel", "channelCount")


def sentinel_counts(df: DataFrame, col: str, sentinel: str = "null",
                    present: str = "subCount", missing: str = "unSubCount") -> DataFrame:
    """A3: one row, rows whose ``col`` differs from / equals the text sentinel.

    A real NULL is in neither count (the comparison is unknown).
    """
    c = F.col(col)
    return df.agg(F.count_if(c != F.lit(sentinel)).alias(present),
                  F.count_if(c == F.lit(sentinel)).alias(missing))


def member_heat(member: DataFrame, order: DataFrame, coupon_member: DataFrame,
                phone: str = "phone", sentinel: str = "null",
                member_id: str = "member_id", order_id: str = "order_id") -> DataFrame:
    """A4: one row ``reg, complete, order, orderAgain, coupon``.

    - reg / complete: members whose phone is / is not the sentinel text;
    - order: members with exactly one order (any status);
    - orderAgain: members with two or more orders;
    - coupon: distinct members holding any coupon.

    One aggregation over the members; the order and coupon parts are scalar
    subqueries (each a one-row aggregate, computed once and used as a value,
    so no join is needed to put them side by side).
    """
    p = F.col(phone)
    reg_complete = member.agg(F.count_if(p == F.lit(sentinel)).alias("reg"),
                              F.count_if(p != F.lit(sentinel)).alias("complete"))
    oa = _order_again(order, member_id, order_id).scalar()
    coupon = _coupon_holders(coupon_member, member_id).scalar()
    return reg_complete.select("reg", "complete", oa["order"].alias("order"),
                               oa["orderAgain"].alias("orderAgain"),
                               coupon.alias("coupon"))


def _order_again(order: DataFrame, member_id: str, order_id: str) -> DataFrame:
    """One row, one struct: members with exactly one order, with two or more."""
    per_member = order.groupBy(member_id).agg(F.count(order_id).alias("n"))
    return per_member.select(F.struct(
        F.count_if(F.col("n") == 1).alias("order"),
        F.count_if(F.col("n") >= 2).alias("orderAgain")).alias("oa"))


def _coupon_holders(coupon_member: DataFrame, member_id: str) -> DataFrame:
    """One row: distinct members holding any coupon."""
    return coupon_member.agg(F.countDistinct(member_id).alias("coupon"))


def member_overview(member: DataFrame, order: DataFrame,
                    coupon_member: DataFrame, sub_col: str = "mp_open_id",
                    sub_sentinel: str = "null", sex: str = "sex",
                    channel: str = "member_channel", id_col: str = "id",
                    phone: str = "phone", sentinel: str = "null",
                    member_id: str = "member_id",
                    order_id: str = "order_id") -> DataFrame:
    """A5: A1–A4 in one nested row.

    ``memberSexes`` and ``memberChannels`` are arrays of (code, count)
    structs, one per category (bounded by the number of codes, not by the
    number of members), sorted by code; ``memberMpSubs`` is a one-element
    array and ``memberHeat`` a struct.

    The member table is read once: one aggregation over the grouping sets
    (sex), (channel) and () gives the per-sex and per-channel counts and the
    whole-table sentinel counts together (``grouping_id`` tells the sets
    apart: 1 = by sex, 2 = by channel, 3 = all). Orders and coupon holdings
    add their one-row parts.
    """
    s, c = F.col(sex), F.col(channel)
    by_sets = member.groupingSets([[s], [c], []], s, c).agg(
        F.grouping_id().alias("gid"),
        F.count(id_col).alias("n"),
        F.count_if(F.col(sub_col) != F.lit(sub_sentinel)).alias("subCount"),
        F.count_if(F.col(sub_col) == F.lit(sub_sentinel)).alias("unSubCount"),
        F.count_if(F.col(phone) == F.lit(sentinel)).alias("reg"),
        F.count_if(F.col(phone) != F.lit(sentinel)).alias("complete"))
    gid = F.col("gid")
    totals = by_sets.agg(
        F.sort_array(F.collect_list(F.when(gid == 1, F.struct(
            F.col(sex).alias("memberSex"), F.col("n").alias("sexCount")))))
        .alias("memberSexes"),
        F.sort_array(F.collect_list(F.when(gid == 2, F.struct(
            F.col(channel).alias("memberChannel"), F.col("n").alias("channelCount")))))
        .alias("memberChannels"),
        F.collect_list(F.when(gid == 3, F.struct("subCount", "unSubCount")))
        .alias("memberMpSubs"),
        F.max(F.when(gid == 3, F.col("reg"))).alias("reg"),
        F.max(F.when(gid == 3, F.col("complete"))).alias("complete"))
    oa = _order_again(order, member_id, order_id).scalar()
    coupon = _coupon_holders(coupon_member, member_id).scalar()
    return totals.select(
        "memberSexes", "memberChannels", "memberMpSubs",
        F.struct("reg", "complete", oa["order"].alias("order"),
                 oa["orderAgain"].alias("orderAgain"),
                 coupon.alias("coupon")).alias("memberHeat"))
