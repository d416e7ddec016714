"""Favourite goods of members of any size, in ordered chunks.

``favGoods`` as one array holds all distinct goods of a member in one value.
Here a member's goods are numbered in order and cut into chunks of at most
``chunk`` goods, one row each, so no value grows with a member:

1. distinct (member, good) pairs, by partial aggregation: a member with a
   third of all lines sends each good once per task; orders and lines meet as
   one row per (order, good);
2. the pairs are range-partitioned by (member, good), so a hot member's goods
   spread over tasks in order;
3. each pair's number is its place inside its part (a window per member and
   part) plus the sizes of the member's earlier parts (a window over one row
   per member and part);
4. a chunk gathers at most ``chunk`` goods.

Rules over chunks (``match``, ``notMatch``, ``exists``, ranges) test each
chunk and unite the chunks' answers per member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberscope.functions.rules import as_rule, compile_rule
from memberscope.session import stored_table

CHUNK = 256


def member_goods(order: DataFrame, order_item: DataFrame) -> DataFrame:
    """Distinct (``memberId``, ``good``) pairs. Lines are reduced to one row
    per (order, good) before they meet the orders, and orders to (order,
    member); an order's goods join by the order, never all lines."""
    lines = order_item.where(F.col("order_id").isNotNull() & F.col("commodity_id").isNotNull()).select(
        "order_id", F.col("commodity_id").alias("good")).distinct()
    orders = order.select("order_id", F.col("member_id").alias("memberId")).distinct()
    return lines.join(orders, "order_id").select("memberId", "good").distinct()


def numbered(pairs: DataFrame, group: str = "memberId", value: str = "good") -> DataFrame:
    """pairs with ``number`` (from 0), the place of the value within its
    group, in order."""
    spark = pairs.sparkSession
    # written once: the part numbers must be those of the rows counted
    ordered = stored_table(spark, pairs.repartitionByRange(group, value).withColumn(
        "part", F.spark_partition_id()), "numbered")
    sizes = ordered.groupBy(group, "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("g"), F.col("part").alias("p"),
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(group, "part").orderBy(value)
    placed = ordered.withColumn("inside", F.row_number().over(inside) - 1)
    return placed.join(starts, placed[group].eqNullSafe(F.col("g")) & (placed.part == F.col("p"))).select(
        group, value, (F.col("before") + F.col("inside")).alias("number"))


def goods_chunks(pairs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``memberId, chunk, goods``: sorted arrays of at most ``chunk`` goods,
    ascending over the chunks of a member. ``pairs`` are distinct."""
    placed = numbered(pairs).withColumn("chunk", F.floor(F.col("number") / chunk).cast("long"))
    return placed.groupBy("memberId", "chunk").agg(F.sort_array(F.collect_list("good")).alias("goods"))


def chunk_rule(rule, chunks: DataFrame) -> tuple[Column, bool]:
    """(condition on one chunk, whether a member is selected by the chunks
    that meet it or by the lack of them)."""
    r = as_rule(rule)
    schema = T.StructType([T.StructField(r.name, chunks.schema["goods"].dataType)])
    if r.type == "notMatch":
        return compile_rule((r.label, r.name, r.value, "match"), schema), False
    return compile_rule(r, schema), True


def select_by_goods(members: DataFrame, chunks: DataFrame, rules, name: str = "favGoods") -> DataFrame:
    """Rows of ``members`` (one per memberId) that satisfy any of the rules
    on ``name`` (rules of one tag are alternatives). Chunks are tested one by
    one and united per member, one row per member and task."""
    rules = [as_rule(r) for r in rules]
    if any(r.name != name for r in rules):
        raise ValueError(f"only rules on {name}")
    held = chunks.withColumnRenamed("goods", name)
    tests = [chunk_rule(r, chunks) for r in rules]
    found = held.groupBy("memberId").agg(*[
        F.coalesce(F.bool_or(c), F.lit(False)).alias(f"r{i}") for i, (c, _) in enumerate(tests)])
    joined = members.join(found, "memberId", "left")
    keep = F.lit(not tests)
    for i, (_, wanted) in enumerate(tests):
        hit = F.coalesce(F.col(f"r{i}"), F.lit(False))
        keep = keep | (hit if wanted else ~hit)
    return joined.where(keep).select(*[members[c] for c in members.columns])
