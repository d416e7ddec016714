"""Growth products: daily growth line (A7), daily counts in a window
and week-on-week comparison (A10).

The growth line is built from a per-day rollup (``daily_rollup``): one row per
day with activity. Computed on the fly it costs one scan of each input; kept
as a table and refreshed day by day, it removes even that scan of the raw
history (``growth_from_rollup`` reads only the rollup).

Plan shape, at any scale: one scan of each input, a partial aggregation per
day inside the scan stage, one small shuffle of (day, partial counts), then a
window over the per-day rows. The per-day frame has one row per calendar day,
so the un-partitioned window and the day join work on a few hundred rows at
most, however many members and orders there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from memberscope.functions.calendar import (as_date, day_key, day_start,
                                            day_text, sorted_days, ts_literal)
from memberscope.functions.money import MONEY_TOTAL, money


def _running():
    """Running frame over the per-day rows (a few hundred at most)."""
    return Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)


def growth_daily(member: DataFrame, order: DataFrame, as_of, days: int = 7,
                 id_col: str = "id", member_ts: str = "create_time",
                 order_id: str = "order_id", order_ts: str = "create_time",
                 price: str = "origin_price", parity: bool = False) -> DataFrame:
    """Per day from ``as_of - days`` on: new members, members to date, orders
    to date, GMV to date.

    Columns: ``day`` (yyyy-MM-dd), ``regCount``, ``memberCount``,
    ``orderCount``, ``gmv`` (DECIMAL(38,2)). Days present on both sides only
    (inner join on day), like the reference.

    Default meaning: the to-date numbers are cumulative counts and sums over
    the whole history, accumulated *before* the day join, so a day with no
    registration still adds its GMV to later days.

    ``parity=True`` reproduces the reference literally: members and orders "to
    date" are the greatest id of the day (right only for gap-free ascending
    ids) and the GMV is accumulated after the inner join, so days missing on
    one side lose their GMV.
    """
    start = day_start(as_of, -days)
    m = member.where(F.col(member_ts).isNotNull())
    o = order.where(F.col(order_ts).isNotNull())
    if parity:
        # The reference filters both sides to the window and keeps the
        # greatest id of each day.
        m_daily = (m.where(F.col(member_ts) >= ts_literal(m, member_ts, start))
                   .groupBy(day_key(member_ts).alias("d"))
                   .agg(F.count(id_col).alias("regCount"),
                        F.max(id_col).cast("bigint").alias("memberCount")))
        o_daily = (o.where(F.col(order_ts) >= ts_literal(o, order_ts, start))
                   .groupBy(day_key(order_ts).alias("d"))
                   .agg(F.max(order_id).cast("bigint").alias("orderCount"),
                        F.sum(money(price)).alias("day_gmv")))
        # GMV before the window: a one-row aggregate used as a scalar value.
        pre = (o.where(F.col(order_ts) < ts_literal(o, order_ts, start))
               .agg(F.coalesce(F.sum(money(price)), F.lit(0)).alias("pre_gmv"))
               .scalar())
        joined = m_daily.join(o_daily, "d", "inner")
        return sorted_days(joined.select(
            day_text("d").alias("day"), "regCount", "memberCount", "orderCount",
            (pre + F.sum("day_gmv").over(_running()))
            .cast(MONEY_TOTAL).alias("gmv")), "day")

    rollup = daily_rollup(member, order, id_col=id_col, member_ts=member_ts,
                          order_id=order_id, order_ts=order_ts, price=price)
    return growth_from_rollup(rollup, as_of, days)


def daily_rollup(member: DataFrame, order: DataFrame, id_col: str = "id",
                 member_ts: str = "create_time", order_id: str = "order_id",
                 order_ts: str = "create_time", price: str = "origin_price",
                 since=None, until=None) -> DataFrame:
    """One row per calendar day with registrations or orders: ``d`` (DATE),
    ``reg_rows``, ``regCount``, ``order_rows``, ``orders``, ``gmv_day``.

    This is all the growth line needs from the history, a few thousand rows
    for ten years. At scale, keep it as a table partitioned by day and
    refresh only new days (``since``/``until`` bound the time columns and are
    pushed into the scans); ``growth_from_rollup`` then never rereads the raw
    history. Each input is one aggregation by day (partial aggregation
    map-side, so a busy day sends one row per task).
    """
    def bounded(df: DataFrame, ts: str) -> DataFrame:
        df = df.where(F.col(ts).isNotNull())
        if since is not None:
            df = df.where(F.col(ts) >= ts_literal(df, ts, day_start(since)))
        if until is not None:
            df = df.where(F.col(ts) < ts_literal(df, ts, day_start(until)))
        return df

    m = (bounded(member, member_ts).groupBy(day_key(member_ts).alias("d"))
         .agg(F.count(F.lit(1)).alias("reg_rows"), F.count(id_col).alias("regCount")))
    o = (bounded(order, order_ts).groupBy(day_key(order_ts).alias("d"))
         .agg(F.count(F.lit(1)).alias("order_rows"), F.count(order_id).alias("orders"),
              F.sum(money(price)).alias("gmv_day")))
    zero = F.lit(0).cast("bigint")
    return m.join(o, "d", "full").select(
        "d",
        F.coalesce("reg_rows", zero).alias("reg_rows"),
        F.coalesce("regCount", zero).alias("regCount"),
        F.coalesce("order_rows", zero).alias("order_rows"),
        F.coalesce("orders", zero).alias("orders"),
        "gmv_day")


def growth_from_rollup(rollup: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The growth line (see ``growth_daily``) from a per-day rollup.

    Running sums over all days up to each day give the to-date numbers; the
    days shown are those from ``as_of - days`` with both registrations and
    orders (the day join of the two sides). Works on the rollup's day rows
    only, so its cost does not grow with the raw history.
    """
    start_day = day_start(as_of, -days).date()
    run = rollup.select(
        "d", "regCount", "reg_rows", "order_rows",
        F.sum("regCount").over(_running()).cast("bigint").alias("memberCount"),
        F.sum("orders").over(_running()).cast("bigint").alias("orderCount"),
        F.sum("gmv_day").over(_running()).cast(MONEY_TOTAL).alias("gmv"))
    last_day = day_start(as_of).date()
    shown = run.where((F.col("d") >= F.lit(start_day)) & (F.col("d") <= F.lit(last_day)) &
                      (F.col("reg_rows") > 0) & (F.col("order_rows") > 0))
    return sorted_days(shown.select(day_text("d").alias("day"), "regCount",
                                    "memberCount", "orderCount", "gmv"), "day")


def daily_counts(df: DataFrame, ts: str, id_col: str, start, end,
                 count_name: str = "count") -> DataFrame:
    """Rows per day with ``start <= ts < end`` (A8 registrations, A9 orders).

    The range test is on the bare column, so it is pushed into the scan.
    Columns: ``day`` (yyyy-MM-dd), ``count_name`` (bigint, ``count(id)``).
    """
    lo, hi = day_start(start), day_start(end)
    return (df.where((F.col(ts) >= ts_literal(df, ts, lo)) &
                     (F.col(ts) < ts_literal(df, ts, hi)))
            .groupBy(day_key(ts).alias("d"))
            .agg(F.count(id_col).alias(count_name))
            .select(day_text("d").alias("day"), count_name))


def last_weeks_counts(df: DataFrame, ts: str, id_col: str, as_of,
                      weeks: int = 2, count_name: str = "count") -> DataFrame:
    """Daily counts over the ``weeks`` weeks before ``as_of`` (as_of excluded)."""
    return daily_counts(df, ts, id_col, day_start(as_of, -7 * weeks),
                        day_start(as_of), count_name)


def week_on_week(df: DataFrame, ts: str, id_col: str, as_of,
                 period_days: int = 7) -> DataFrame:
    """Each day of the last period next to the same weekday one period before.

    Columns: ``day``, ``count``, ``prevDay``, ``prevCount``, ``growth``
    (``(count - prevCount) / prevCount``; NULL when ``prevCount`` is 0).

    One pass and no self join: every row of the two periods is keyed by the
    day of the current period it compares with (``day`` or ``day + period``),
    and two conditional counts split current from previous. A spine of the
    ``period_days`` days makes empty days show as 0.
    """
    as_of = as_date(as_of)
    cur_start = day_start(as_of, -period_days)
    prev_start = day_start(as_of, -2 * period_days)
    end = day_start(as_of)
    d = day_key(ts)
    in_cur = F.col(ts) >= ts_literal(df, ts, cur_start)
    counted = (df.where((F.col(ts) >= ts_literal(df, ts, prev_start)) &
                        (F.col(ts) < ts_literal(df, ts, end)) &
                        F.col(id_col).isNotNull())
               .groupBy(F.when(in_cur, d).otherwise(F.date_add(d, period_days))
                        .alias("d"))
               .agg(F.count_if(in_cur).alias("count"),
                    F.count_if(~in_cur).alias("prevCount")))
    spark = df.sparkSession
    spine = spark.range(0, period_days, 1, 1).select(
        F.date_add(F.lit(cur_start.date()), F.col("id").cast("int")).alias("d"))
    # Both sides have at most ``period_days`` rows: a broadcast is bounded.
    joined = spine.join(F.broadcast(counted), "d", "left")
    cnt = F.coalesce(F.col("count"), F.lit(0)).cast("bigint")
    prev = F.coalesce(F.col("prevCount"), F.lit(0)).cast("bigint")
    return sorted_days(joined.select(
        day_text("d").alias("day"), cnt.alias("count"),
        day_text(F.date_sub("d", period_days)).alias("prevDay"),
        prev.alias("prevCount"),
        F.when(prev > 0, (cnt - prev) / prev).alias("growth")), "day")
