"""Bitmap index of the tag table: selections (A20) and facets (A21) without
reading the tag table.

Two written tables, both partitioned by tag:

``words`` (tag, kind, value, word, bits)
    bitmaps (``functions.bitmaps``) of the members with ``eq`` value, with any
    value (``set``), with a non-empty array (``has``), and, for range tags,
    with a value in or above a bin (``ge``, range-encoded: a lower bound reads
    one bitmap however many values lie above it).
``edges`` (tag, bin, member, value)
    every member's bin of a range tag, sorted by bin. A bound inside a bin
    reads that bin's members and compares their values, so ranges are exact.

Bins are cut at quantiles of each range tag (``cuts``, at most ``BINS`` values
kept in a third small table with the column types). A selection reads the
bitmaps its rules name, or-s and and-s them word by word in one aggregation
by word, and turns set bits into members. A facet needs no set operation: its
count is a sum and difference of bitmap sizes.

Members are told by an integer ``memberId``; a row without one is no member.
A member with several rows has the tags of all of them.
"""

from __future__ import annotations

import bisect
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberscope.functions import bitmaps as B
from memberscope.functions.rules import as_rule, check_bound, range_bounds

BINS = 32
EQUAL_TAGS = ("sex", "channel", "subOpenId", "address", "orderCount", "favGoods",
              "freeCouponTime", "couponTimes", "feedBack")
RANGE_TAGS = ("regTime", "orderCount", "orderTime", "orderMoney", "chargeMoney", "overTime")
EVERYONE = "*"
#: Tags of quantiles: days are placed by their number.
DAY = "yyyy-MM-dd"


def _is_array(dt: T.DataType) -> bool:
    return isinstance(dt, T.ArrayType)


def _cuts(tags: DataFrame, name: str, bins: int) -> Column:
    """Array of the quantiles of one column, in its own type."""
    dt, c = tags.schema[name].dataType, F.col(name)
    shares = [k / bins for k in range(1, bins)]
    if isinstance(dt, T.StringType):
        days = F.unix_date(F.try_to_timestamp(c, F.lit(DAY)).cast("date"))
        return F.transform(F.percentile_approx(days, shares, 10_000),
                           lambda d: F.date_format(F.date_from_unix_date(d), DAY))
    return F.percentile_approx(c, shares, 10_000)


def _bin(c: Column, cuts: Column) -> Column:
    """How many cuts lie at or below the value."""
    return F.size(F.filter(cuts, lambda x: x <= c))


def build(tags: DataFrame, path: str, equal=EQUAL_TAGS, ranges=RANGE_TAGS, bins: int = BINS) -> "TagIndex":
    """Write the index of ``tags`` (one row per member) below ``path``."""
    spark, schema = tags.sparkSession, tags.schema
    for name in ranges:
        if _is_array(schema[name].dataType):
            raise ValueError(f"{name}: ranges of arrays use the bitmaps of their values")
    tags = tags.where(F.col("memberId").isNotNull())
    cut_row = tags.agg(*[F.array_sort(F.array_distinct(_cuts(tags, n, bins))).alias(n) for n in ranges])
    cut_row = cut_row.first()  # at most ``bins`` values per range tag
    cuts = {n: list(cut_row[n] or []) for n in ranges}
    types = [(n, schema[n].dataType.simpleString(), [str(x) for x in cuts.get(n, [])])
             for n in dict.fromkeys((*equal, *ranges, "memberId"))]
    spark.createDataFrame(types, "name string, type string, cuts array<string>").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/columns")

    def fact(tag: str, kind: str, value: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    def values_of(tag: str):
        return lambda x: fact(tag, "eq", x)

    single, lists, bins_of = [fact(EVERYONE, "set", F.lit(""))], [], []
    bin_of = {n: _bin(F.col(n), F.lit(cuts[n]).cast(T.ArrayType(schema[n].dataType)) if cuts[n]
                      else F.array().cast(T.ArrayType(schema[n].dataType))) for n in ranges}
    for n in dict.fromkeys((*equal, *ranges)):
        known = F.col(n).isNotNull()
        single.append(F.when(known, fact(n, "set", F.lit(""))))
        if _is_array(schema[n].dataType):
            single.append(F.when(F.size(n) > 0, fact(n, "has", F.lit(""))))
            lists.append(F.when(known, F.transform(F.filter(n, lambda x: x.isNotNull()), values_of(n))))
        elif n in equal:
            single.append(F.when(known, fact(n, "eq", F.col(n))))
        if n in ranges:
            bins_of.append(F.when(known, fact(n, "bin", bin_of[n])))
    none = F.array().cast("array<struct<tag:string,kind:string,value:string>>")
    facts = F.concat(F.filter(F.array(*single), lambda x: x.isNotNull()), *[F.coalesce(x, none) for x in lists])
    bins_of = F.filter(F.array(*bins_of), lambda x: x.isNotNull()) if bins_of else none
    member = F.col("memberId")
    # members meet by word before their facts are spread out: a fact is
    # gathered, sorted and written where it arises
    placed = tags.withColumns({"_word": B.word_of(member), "_bit": B.bit_of(member)}).repartition("_word")

    def gathered(of: Column) -> DataFrame:
        spread = placed.select(F.col("_word").alias("word"), F.col("_bit").alias("bit"), F.explode(of).alias("f"))
        return spread.select("word", "bit", "f.*").groupBy("tag", "kind", "value", "word").agg(F.bit_or("bit").alias("bits"))

    # a bin's members become those of the bin and all above: at most ``bins``
    # words of one place meet
    binned = gathered(bins_of).groupBy("tag", "word").agg(
        F.collect_list(F.struct(F.col("value").cast("int").alias("bin"), "bits")).alias("b"))
    above = binned.select("tag", "word", "b", F.explode(F.array_distinct(F.flatten(F.transform(
        "b", lambda x: F.sequence(F.lit(0), x.bin))))).alias("low"))
    above = above.select("tag", F.lit("ge").alias("kind"), F.col("low").cast("string").alias("value"), "word",
                         F.aggregate(F.filter("b", lambda x: x.bin >= F.col("low")), F.lit(0).cast("long"),
                                     lambda a, x: a.bitwiseOR(x.bits)).alias("bits"))
    # every file is sorted, so a scan reads a value's place in each alone
    (gathered(facts).unionByName(above).sortWithinPartitions("tag", "kind", "value", "word")
     .write.mode("overwrite").partitionBy("tag").parquet(f"{path}/words"))
    entries = [F.when(F.col(n).isNotNull(), F.struct(
        F.lit(n).alias("tag"), bin_of[n].alias("bin"), F.col(n).cast("string").alias("value"))) for n in ranges]
    edges = tags.select(member.alias("member"), F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())
                                                          if entries else F.array()).alias("e")).select("member", "e.*")
    (edges.repartitionByRange("tag", "bin", "member").sortWithinPartitions("tag", "bin", "member")
     .write.mode("overwrite").partitionBy("tag").parquet(f"{path}/edges"))
    return TagIndex(spark, path)


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Leaf:
    """Rows of one table that stand for one set of members. Conditions are
    SQL text: a catalogue has hundreds of them, and one parsed expression is
    much cheaper to make than its parts."""

    def __init__(self, table: str, tag: str, condition: str):
        self.table, self.tag, self.condition = table, tag, f"(tag = {text(tag)} AND {condition})"


class _Set:
    """A rule's members: ``plus`` (united) without ``minus``. ``nested`` says
    that counting needs no union: the parts of ``plus`` are disjoint, and
    contain those of ``minus``."""

    def __init__(self, plus: list[_Leaf], minus: list[_Leaf] = (), nested: bool = True):
        self.plus, self.minus, self.nested = list(plus), list(minus), nested


NONE = "CAST(NULL AS BIGINT)"
SCHEMAS = {"words": "kind string, value string, word long, bits long, tag string",
           "edges": "member long, bin int, value string, tag string"}
#: Word and bits of a row of each table.
MEMBERS = {"words": ("word", "bits"),
           "edges": (f"shiftright(member, {B.WORD_BITS})",
                     f"shiftleft(1L, CAST(member & {(1 << B.WORD_BITS) - 1} AS INT))")}


class TagIndex:
    """A written index, opened for selections and facets."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.types, self.cuts = {}, {}
        for r in spark.read.parquet(f"{path}/columns").collect():  # one row per tag
            dt = T._parse_datatype_string(r.type)
            self.types[r.name] = dt
            self.cuts[r.name] = [self._value(x, dt) for x in r.cuts]
        self.schema = T.StructType([T.StructField(n, t) for n, t in self.types.items()])

    @staticmethod
    def _value(value: str, dt: T.DataType):
        """A cut or bound as a Python value that compares like the column's."""
        if isinstance(dt, T.IntegralType):
            return int(value)
        if isinstance(dt, T.NumericType):
            return Decimal(value)
        return value

    @staticmethod
    def _typed(value: str, dt: T.DataType) -> str:
        return text(value) if isinstance(dt, T.StringType) else f"TRY_CAST({text(value)} AS {dt.simpleString()})"

    def _words(self, tag: str, kind: str, condition: str = "true") -> _Leaf:
        return _Leaf("words", tag, f"kind = '{kind}' AND {condition}")

    def _from(self, tag: str, bound: str, strict: bool) -> list[_Leaf]:
        """Members with a value above (``strict``) or from the bound on."""
        dt = self.types[tag]
        check_bound(bound, dt)
        at = bisect.bisect_right(self.cuts[tag], self._value(bound, dt))
        stored = "value" if isinstance(dt, T.StringType) else f"TRY_CAST(value AS {dt.simpleString()})"
        inside = f"{stored} {'>' if strict else '>='} {self._typed(bound, dt)}"
        return [self._words(tag, "ge", f"value = '{at + 1}'"), _Leaf("edges", tag, f"bin = {at} AND {inside}")]

    def _rule(self, rule, keep_null: bool) -> _Set:
        r = as_rule(rule)
        dt = self.types.get(r.name)
        if dt is None:
            raise ValueError(f"{r.name} is not indexed")
        array = _is_array(dt)
        elem = dt.elementType if array else dt
        if r.type == "exists":
            return _Set([self._words(r.name, "has" if array else "set")])
        if r.type in ("match", "notMatch"):
            hit = self._words(r.name, "eq", f"value = CAST({self._typed(r.value, elem)} AS STRING)")
            if r.type == "match":
                return _Set([hit])
            every = self._words(EVERYONE if keep_null else r.name, "set")
            return _Set([every], [hit])
        bounds = (r.value.strip(),) if r.type == "rangeGte" else range_bounds(r.value)
        if array:
            for b in bounds:
                check_bound(b, elem)
            value = "value" if isinstance(elem, T.StringType) else f"TRY_CAST(value AS {elem.simpleString()})"
            inside = f"{value} >= {self._typed(bounds[0], elem)}"
            if len(bounds) > 1:
                inside += f" AND {value} <= {self._typed(bounds[1], elem)}"
            return _Set([self._words(r.name, "eq", inside)], nested=False)
        if len(bounds) == 1:
            return _Set(self._from(r.name, bounds[0], False))
        if self._value(bounds[0], elem) > self._value(bounds[1], elem):
            return _Set([])
        return _Set(self._from(r.name, bounds[0], False), self._from(r.name, bounds[1], True))

    def _sources(self, leaves: list[_Leaf]):
        """(frame, leaf numbers, word, bits) per table that the leaves read:
        tags prune partitions, kinds, values and bins reach the scan."""
        for table, (word, bits) in MEMBERS.items():
            here = [i for i, x in enumerate(leaves) if x.table == table]
            if here:
                tags = ", ".join(sorted({text(leaves[i].tag) for i in here}))
                wanted = " OR ".join(dict.fromkeys(leaves[i].condition for i in here))
                yield (self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.path}/{table}").where(f"tag IN ({tags})").where(wanted),
                       here, word, bits)

    def _by_word(self, sets: list[_Set]) -> tuple[DataFrame, list[Column]]:
        """One row per word with a column per leaf, and each set's bits."""
        leaves = [x for s in sets for x in (*s.plus, *s.minus)]
        frames = None
        for frame, numbers, word, bits in self._sources(leaves):
            part = frame.selectExpr(f"{word} AS word", *[
                f"CASE WHEN {x.condition} THEN {bits} END AS l{i}" if i in numbers else f"{NONE} AS l{i}"
                for i, x in enumerate(leaves)])
            frames = part if frames is None else frames.unionByName(part)
        if frames is None:
            frames = self.spark.createDataFrame([], "word long")
        none = F.lit(0).cast("long")
        joined = frames.groupBy("word").agg(F.lit(1).alias("_"), *[
            F.expr(f"coalesce(bit_or(l{i}), 0L) AS l{i}") for i in range(len(leaves))])
        out, at = [], 0
        for s in sets:
            bits = none
            for _ in s.plus:
                bits, at = B.either(bits, F.col(f"l{at}")), at + 1
            for _ in s.minus:
                bits, at = B.without(bits, F.col(f"l{at}")), at + 1
            out.append(bits)
        return joined, out

    def words(self, rules, keep_null: bool = True) -> DataFrame:
        """(word, bits) of the members that satisfy the selection: OR inside
        a tag, AND between tags; without rules, everyone."""
        rules = [as_rule(r) for r in rules]
        sets = [self._rule(r, keep_null) for r in rules] or [_Set([self._words(EVERYONE, "set")])]
        joined, bits = self._by_word(sets)
        by_tag: dict[str, Column] = {}
        for name, b in zip([r.name for r in rules] or [EVERYONE], bits):
            by_tag[name] = B.either(by_tag[name], b) if name in by_tag else b
        chosen = None
        for b in by_tag.values():
            chosen = b if chosen is None else B.both(chosen, b)
        return joined.select("word", chosen.alias("bits")).where("bits <> 0")

    def select(self, rules, keep_null: bool = True) -> DataFrame:
        """``memberId`` of the members that satisfy the selection."""
        return B.members(self.words(rules, keep_null), "memberId", self.types["memberId"].simpleString())

    def count(self, rules, keep_null: bool = True) -> DataFrame:
        """One row: ``members`` of the selection."""
        return self.words(rules, keep_null).agg(F.coalesce(F.sum(B.size(F.col("bits"))), F.lit(0)).alias("members"))

    def facets(self, rules, keep_null: bool = True) -> DataFrame:
        """``label, name, value, type, members`` per rule. Sums of bitmap
        sizes; only ranges over arrays unite bitmaps first."""
        rules = [as_rule(r) for r in rules]
        sets = [self._rule(r, keep_null) for r in rules]
        simple = [i for i, s in enumerate(sets) if s.nested]
        others = [i for i, s in enumerate(sets) if not s.nested]
        leaves = [x for i in simple for x in (*sets[i].plus, *sets[i].minus)]
        names = [*(f"s{k}" for k in range(len(leaves))), *(f"u{i}" for i in others)]
        sums = self.spark.range(0, 1, 1, 1).selectExpr(*[f"{NONE} AS {c}" for c in names] or ["id"])

        def add(part: DataFrame) -> DataFrame:  # one row each
            return sums.unionByName(part.selectExpr(*[c if c in part.columns else f"{NONE} AS {c}" for c in names]))

        for frame, numbers, _, bits in self._sources(leaves):
            sums = add(frame.selectExpr(*[
                f"sum(CASE WHEN {leaves[k].condition} THEN bit_count({bits}) END) AS s{k}" for k in numbers]))
        if others:
            joined, bits = self._by_word([sets[i] for i in others])
            sums = add(joined.agg(*[F.sum(B.size(b)).alias(f"u{i}") for i, b in zip(others, bits)]))
        counts, at = {i: f"coalesce(max(u{i}), 0L)" for i in others}, 0
        for i in simple:
            terms = []
            for sign, part in (("+", sets[i].plus), ("-", sets[i].minus)):
                for _ in part:
                    terms.append(f"{sign} coalesce(max(s{at}), 0L)")
                    at += 1
            counts[i] = "0L " + " ".join(terms)
        rows = ", ".join(f"{text(r.label)}, {text(r.name)}, {text(r.value)}, {text(r.type)}, n{i}"
                         for i, r in enumerate(rules))
        counted = sums.selectExpr(*[f"{counts[i]} AS n{i}" for i in range(len(rules))])
        return counted.selectExpr(f"stack({len(rules)}, {rows}) AS (label, name, value, type, members)")
