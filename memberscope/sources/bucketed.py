"""Member tables in the catalog, bucketed by member.

``write_member_tables`` stores the tables behind the tag table with the same
number of buckets on the member, sorted by it, and their statistics. Every
feature of a member is then an aggregation inside a bucket, and the joins of
the feature frames pair bucket with bucket: the tag table is computed without
an exchange (only the coupon dimension may be broadcast, if its size allows).
Order lines carry their order's member and time, which they get once, at
writing. Purchases are partitioned by day, so that a window of days reads
those partitions alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.functions.calendar import day_key, day_text
from memberscope.functions.money import MONEY_TOTAL, money
from memberscope.operators import tags

BUCKETS = 16


class MemberCatalog:
    """The tables of one database under a common prefix."""

    def __init__(self, spark: SparkSession, database: str = "default", prefix: str = "member_"):
        self.spark, self.database, self.prefix = spark, database, prefix

    def name(self, table: str) -> str:
        return f"{self.database}.{self.prefix}{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def _bucketed(self, df: DataFrame, table: str, member: str, buckets: int) -> None:
        # rows arrive by bucket, so each bucket is one sorted file
        (df.repartition(buckets, member).write.mode("overwrite").bucketBy(buckets, member).sortBy(member)
         .saveAsTable(self.name(table)))
        self.spark.sql(f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS FOR ALL COLUMNS")

    def write(self, domain, buckets: int = BUCKETS) -> "MemberCatalog":
        """Store the views of ``domain``. Lines meet their orders once here;
        a line without order has no member and is left out, as in the tags."""
        order = domain.order
        lines = domain.order_line.join(order.select(
            "order_id", "member_id", F.col("create_time").alias("pick_time")), "order_id")
        coupons = domain.coupon_member.select("member_id", "coupon_id", "coupon_channel", "create_time")
        for name, df, member in (("member", domain.member, "id"), ("order", order, "member_id"),
                                 ("order_line", lines, "member_id"), ("coupon_member", coupons, "member_id"),
                                 ("feedback", domain.feedback, "member_id")):
            self._bucketed(df, name, member, buckets)
        domain.coupon.write.mode("overwrite").saveAsTable(self.name("coupon"))
        self.spark.sql(f"ANALYZE TABLE {self.name('coupon')} COMPUTE STATISTICS")
        (domain.purchase.withColumn("day", day_key("create_time")).repartition("day").write.mode("overwrite")
         .partitionBy("day").saveAsTable(self.name("purchase")))
        return self

    def member_tags(self, free_id: int = 1) -> DataFrame:
        """A19 from the bucketed tables: six joins on the member, all inside
        buckets."""
        order, line = self.table("order"), self.table("order_line")
        member = F.col("member_id").alias("memberId")
        orders = order.groupBy(member).agg(
            F.count("order_id").alias("orderCount"), day_text(F.max("create_time")).alias("orderTime"),
            F.sum(money("pay_price")).cast(MONEY_TOTAL).alias("orderMoney"))
        goods = line.groupBy(member).agg(F.sort_array(F.collect_set("commodity_id")).alias("goods"))
        over = line.groupBy(member).agg(
            (F.unix_timestamp(F.max("arrive_time")) - F.unix_timestamp(F.max("pick_time"))).alias("overTime"))
        held = self.table("coupon_member")
        days = tags.tag_free_coupon(held, free_id)
        others = tags.tag_coupon_times(held, free_id)
        charge = tags.tag_charge_money(held, self.table("coupon"))
        out = tags.tag_member_base(self.table("member"))
        for feature in (orders, goods, over, days, others, charge, tags.tag_feedback_latest(self.table("feedback"))):
            out = out.join(feature, "memberId", "left")
        empty = F.array().cast(goods.schema["goods"].dataType)
        return out.withColumn("favGoods", F.when(F.col("orderCount").isNotNull(), F.coalesce("goods", empty))).select(
            *tags.TAG_COLUMNS)

    def purchases(self, start, end) -> DataFrame:
        """Purchases of the days [start, end): only those partitions."""
        return self.table("purchase").where((F.col("day") >= F.lit(start).cast("date")) & (
            F.col("day") < F.lit(end).cast("date"))).drop("day")

    def drop(self) -> None:
        for t in ("member", "order", "order_line", "coupon_member", "feedback", "coupon", "purchase"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(t)}")
