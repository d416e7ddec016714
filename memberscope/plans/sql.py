"""Products as Spark SQL text over the domain views.

Bounds are passed as named parameters (``:start``), never formatted into the
text, so a value cannot change the statement and the plan is the same for
every run. The casts of the parameters are folded into literals of the
column's type, so the range filter still reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from memberscope.functions.calendar import day_start

DISTRIBUTION_SQL = {
    "sex": """
        SELECT sex AS memberSex, count(id) AS sexCount
        FROM t_member GROUP BY sex""",
    "channel": """
        SELECT member_channel AS memberChannel, count(id) AS channelCount
        FROM t_member GROUP BY member_channel""",
}

# Two-level aggregation through a subquery in FROM.
HEAT_ORDERS_SQL = """
    SELECT count_if(t.orderCount = 1) AS `order`,
           count_if(t.orderCount >= 2) AS orderAgain
    FROM (SELECT member_id, count(order_id) AS orderCount
          FROM t_order GROUP BY member_id) AS t"""

DAILY_SQL = """
    SELECT date_format(create_time, 'yyyy-MM-dd') AS day, count(IDENTIFIER(:id)) AS n
    FROM IDENTIFIER(:view)
    WHERE create_time >= CAST(:start AS TIMESTAMP_NTZ)
      AND create_time < CAST(:end AS TIMESTAMP_NTZ)
    GROUP BY date_format(create_time, 'yyyy-MM-dd')"""


def distribution(spark: SparkSession, which: str) -> DataFrame:
    return spark.sql(DISTRIBUTION_SQL[which])


def heat_orders(spark: SparkSession) -> DataFrame:
    return spark.sql(HEAT_ORDERS_SQL)


def daily_counts(spark: SparkSession, view: str, id_col: str, name: str,
                 start, end) -> DataFrame:
    """A8/A9 as SQL: rows per day with ``start <= create_time < end``."""
    if view not in ("t_registration", "t_purchase", "t_member", "t_order"):
        raise ValueError(f"unknown view {view!r}")
    args = {"view": view, "id": id_col, "start": day_start(start).isoformat(sep=" "),
            "end": day_start(end).isoformat(sep=" ")}
    return spark.sql(DAILY_SQL, args=args).withColumnRenamed("n", name)
