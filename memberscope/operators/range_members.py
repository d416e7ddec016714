"""Distinct members over any range of days (A4, A6, B31), exactly.

Distinct counts of days cannot be added, but sets of members can be united.
``build`` keeps member bitmaps (``functions.bitmaps``) not only per day but in
a dyadic tree over the days: node n of level l holds the members of days
n 2^l … (n + 1) 2^l - 1. Any range of days is the disjoint union of at most two
nodes per level, so a count reads O(log days) bitmaps instead of all days and
none of the events.

Level 0 is one aggregation of the events by (day, word); each further level
unites the words of the one below, which has at most as many. A day's
arrival touches one node per level (``build`` of a part of the days writes
only those nodes' parts, by level).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberscope.functions import bitmaps as B
from memberscope.functions.calendar import day_key
from memberscope.session import stored_table

SALT = 8


def build(events: DataFrame, member: str, ts: str, path: str) -> DataFrame:
    """Write the tree of ``events`` below ``path`` (partitioned by level) and
    return it: level, node, word, bits. Rows without member or time are left
    out."""
    spark = events.sparkSession
    day = F.unix_date(day_key(ts))
    leaves = events.where(F.col(member).isNotNull() & F.col(ts).isNotNull()).select(
        day.alias("node"), B.word_of(F.col(member)).alias("word"), B.bit_of(F.col(member)).alias("bit")).groupBy(
        "node", "word").agg(F.bit_or("bit").alias("bits"))
    nodes = stored_table(spark, leaves, "day-members")
    span = nodes.agg(F.min("node").alias("a"), F.max("node").alias("b")).first()
    levels = 0 if span.a is None else (span.b - span.a).bit_length()
    tree = nodes.select(F.lit(0).alias("level"), "node", "word", "bits")
    for level in range(1, levels + 1):
        nodes = stored_table(spark, nodes.groupBy(F.shiftright("node", 1).alias("node"), "word").agg(
            F.bit_or("bits").alias("bits")), "day-members")
        tree = tree.unionByName(nodes.select(F.lit(level).alias("level"), "node", "word", "bits"))
    (tree.repartitionByRange("level", "node", "word").sortWithinPartitions("level", "node", "word")
     .write.mode("overwrite").partitionBy("level").parquet(path))
    return spark.read.schema("node int, word long, bits long, level int").parquet(path)


def cover(start: Column, end: Column, levels: int) -> Column:
    """Array of (level, node): the nodes whose days are exactly those of
    [start, end), as day numbers. On each level at most the first node, if it
    is a right child, and the last, if it is a left one; above ``levels`` the
    remaining middle is taken whole."""
    def at(level):
        size = F.call_function("shiftleft", F.lit(1), level)
        low = F.ceil(start / size).cast("int")
        high = F.floor(end / size).cast("int")
        node = lambda n: F.struct(level.alias("level"), n.alias("node"))
        none = F.array().cast("array<struct<level:int,node:int>>")
        rest = F.when(low < high, F.transform(F.sequence(low, F.greatest(low, high - 1)), node)).otherwise(none)
        edges = F.filter(F.array(F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), node(low)),
                                 F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), node(high - 1))),
                         lambda x: x.isNotNull())
        return F.when(level == levels, rest).otherwise(F.array_distinct(edges))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def active_members(tree: DataFrame, ranges: DataFrame, levels: int | None = None, salt: int = SALT) -> DataFrame:
    """``ranges`` (rangeId, start, end: days, the end not included) with
    ``members``, the distinct members of each. Nodes join by (level, node) in
    ``salt`` parts of the words, so a large node is split."""
    if levels is None:
        levels = tree.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0]
    # ranges of the same days of the tree share one count, so the work follows
    # the days and the members however many ranges ask for them
    span = tree.where("level = 0").agg(F.min("node").alias("a"), F.max("node").alias("b")).first()
    first, last = (0, 0) if span.a is None else (span.a, span.b + 1)
    some = F.col("start") < F.col("end")
    asked = ranges.distinct().withColumns({
        "_low": F.when(some, F.greatest(F.unix_date("start"), F.lit(first))),
        "_high": F.when(some, F.least(F.unix_date("end"), F.lit(last)))})
    asked = stored_table(ranges.sparkSession, asked, "day-ranges")
    days = asked.where("_low < _high").select("_low", "_high").distinct()
    wanted = days.select("_low", "_high", F.explode(cover(F.col("_low"), F.col("_high"), levels)).alias("n")).select(
        "_low", "_high", "n.*", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("salt"))
    parts = tree.withColumn("salt", F.pmod("word", F.lit(salt)).cast("int"))
    words = parts.join(wanted, ["level", "node", "salt"]).groupBy("_low", "_high", "word").agg(F.bit_or("bits").alias("bits"))
    counts = words.groupBy("_low", "_high").agg(F.sum(B.size(F.col("bits"))).alias("members"))
    return asked.join(counts, ["_low", "_high"], "left").select(
        *ranges.columns, F.coalesce("members", F.lit(0)).alias("members"))
