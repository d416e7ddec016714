"""Audience membership: thousands of stored rule sets at once.

``rules`` is a table (``audienceId, name, value, type``) instead of a list:
rules of one audience are united per tag and intersected between tags, with
the meaning of ``functions.rules``. The result is one row per (audience,
member). No rule set meets a member that cannot belong to it:

1. *Facts.* Members are listed by (tag, value) where rules ask for values,
   and by (tag, bin) with their value for tags that rules give ranges of; bins
   are cut at quantiles.
2. *Access.* Every audience enters by its most selective tag, by the sizes of
   the lists its rules there would read. Equality rules join lists by (tag,
   value), ranges are spread over the bins they touch and join by (tag, bin),
   the value being compared inside.
3. *Check.* The lists of a tag carry the members' values of the other tags
   that audiences entering by it name, the rules those tags' rules, so a pair
   is told where it arises and only true pairs leave the join. A pair can
   arise twice only for audiences that enter by several rules or by ranges;
   theirs alone are made distinct.
4. *Parts.* Pairs of audiences with long lists, or lists that many audiences
   share, grow with the product of both tables. Those audiences meet parts of
   the members instead (``member_parts``): in a part every clause is a bit per
   member, an audience the conjunction of its clauses, and audiences of equal
   rules share it. So do audiences of ``exists`` and ``notMatch`` rules alone,
   which nearly everyone belongs to.

Joined lists are short and asked by few, so no key is hot, and rules are not
multiplied for the join; parts of members and blocks of audiences have a
bounded size. Rules and lists grow with the tables, so these joins are merge
joins: nothing of theirs is broadcast through the driver.

A bound that the tag's type cannot hold selects nobody (``functions.rules``
refuses it; here one bad row must not stop thousands of audiences), and
``invalid_rules`` lists such rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberscope.functions.rules import RULE_TYPES
from memberscope.operators import member_parts
from memberscope.operators.bitmap_index import RANGE_TAGS
from memberscope.session import stored_table

BINS = 32
#: Parts of the members at least.
SALT = 16
#: Members that a list may hold for each part; audiences with longer ones meet
#: the parts.
SHORT = 20
#: Audiences that may ask for a list; with more they meet the parts.
ASKED = 4096
NUMBER = "decimal(38,6)"
DAY = "yyyy-MM-dd"
NUMBERS_TO = r"^\s*(-?\d+(?:\.\d+)?)\s*-\s*(-?\d+(?:\.\d+)?)\s*$"
DAYS_TO = r"^\s*(\d{4}-\d\d-\d\d)\s*-\s*(\d{4}-\d\d-\d\d)\s*$"
TEXTS_TO = r"^\s*([^-]*[^-\s])\s*-\s*([^-]*[^-\s])\s*$"
#: Bin of a value that has no place among the cuts; every range reads it.
NO_BIN = -1


def _elem(schema: T.StructType, name: str) -> T.DataType:
    dt = schema[name].dataType
    return dt.elementType if isinstance(dt, T.ArrayType) else dt


def _by_tag(schema: T.StructType, names, make) -> Column:
    out = F.lit(None)
    for n in names:
        out = F.when(F.col("name") == n, make(_elem(schema, n))).otherwise(out)
    return out


def _place(c: Column, dt: T.DataType) -> Column:
    """A number that sorts like the value: itself, or a day's number."""
    if isinstance(dt, T.NumericType):
        return c.try_cast("double")
    return F.unix_date(F.try_to_timestamp(c, F.lit(DAY)).cast("date")).cast("double")


def _typed_rules(rules: DataFrame, schema: T.StructType, tags) -> DataFrame:
    """rule (number), audienceId, name, type, text (canonical value), lo, hi,
    plo, phi (places of the bounds), valid."""
    value = F.coalesce("value", F.lit(""))
    pattern = F.when(value.rlike(NUMBERS_TO), F.lit(NUMBERS_TO)).when(value.rlike(DAYS_TO), F.lit(DAYS_TO))
    side = lambda k: F.coalesce(*[F.when(pattern == p, F.regexp_extract(value, p, k)) for p in (
        NUMBERS_TO, DAYS_TO)], F.nullif(F.regexp_extract(value, TEXTS_TO, k), F.lit("")))
    both = F.col("type") == "rangeBoth"
    ranged = F.col("type").isin("rangeGte", "rangeBoth")
    out = rules.distinct().select(
        F.monotonically_increasing_id().alias("rule"), "audienceId", "name", "type",
        value.alias("value"), F.when(both, side(1)).when(ranged, F.trim(value)).alias("lo"),
        F.when(both, side(2)).alias("hi"))
    known = F.col("name").isin(*tags) & F.col("type").isin(*RULE_TYPES)

    def canonical(dt):
        return F.col("value").try_cast(dt).cast("string")

    def fits(dt):
        bound = lambda c: F.col(c).try_cast(dt).isNotNull() if not isinstance(
            dt, T.IntegralType) else F.col(c).rlike(r"^\s*[+-]?\d+\s*$") & F.col(c).try_cast(dt).isNotNull()
        return F.when(ranged, bound("lo") & (~both | bound("hi"))).otherwise(F.lit(True))

    return out.withColumns({
        "text": _by_tag(schema, tags, canonical), "plo": _by_tag(schema, tags, lambda dt: _place(F.col("lo"), dt)),
        "phi": _by_tag(schema, tags, lambda dt: _place(F.col("hi"), dt)),
        "valid": known & F.coalesce(_by_tag(schema, tags, fits), F.lit(False))})


def invalid_rules(rules: DataFrame, tags: DataFrame) -> DataFrame:
    """The rules that select nobody because their tag, type or bound is none."""
    names = _tags(tags)
    return _typed_rules(rules, tags.schema, names).where(~F.col("valid")).select(
        "audienceId", "name", "value", "type")


def _tags(tags: DataFrame) -> list[str]:
    return [c for c in tags.columns if c != "memberId"]


def _within(value: Column, lo: Column, hi: Column) -> Column:
    """Whether a value lies between a rule's bounds (no upper one: null)."""
    return (value >= lo) & (hi.isNull() | (value <= hi))


def _is_number(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


class _People:
    """The typed rules, and one row per member with its values of the tags
    that rules name: ``v_<tag>`` as text, ``d_<tag>`` as numbers where ranges
    compare numbers, ``h_<tag>`` whether there is any."""

    def __init__(self, tags: DataFrame, rules: DataFrame, bins: int):
        self.schema = tags.schema
        self.spark = spark = tags.sparkSession
        kind = F.when(F.col("type").isin("rangeGte", "rangeBoth"), "range").when(
            F.col("type") == "exists", "set").otherwise("eq")
        typed = _typed_rules(rules, tags.schema, _tags(tags)).where("audienceId is not null").withColumns({
            "kind": kind, "dlo": F.col("lo").try_cast(NUMBER), "dhi": F.col("hi").try_cast(NUMBER)})
        # each of these is read several times: written tables end the lineage
        self.named = stored_table(spark, typed, "audience-rules")
        self.rules = self.named.where("valid")
        self.kinds = {(r.name, r.kind) for r in self.rules.select("name", "kind").distinct().collect()}  # three a tag
        self.names = [n for n in _tags(tags) if any(k[0] == n for k in self.kinds)]
        # cuts of the tags that can have ranges: at most ``bins`` numbers each
        self.arrays = [n for n in self.names if isinstance(tags.schema[n].dataType, T.ArrayType)]
        shares = [k / bins for k in range(1, bins)]
        ranged = [n for n in self.names if n not in self.arrays and n in RANGE_TAGS]
        row = tags.agg(*[F.percentile_approx(_place(F.col(n), tags.schema[n].dataType), shares, 10_000).alias(n)
                         for n in ranged]).first() if ranged else {}
        self.cuts = {n: sorted(set(row[n] or [])) for n in ranged}
        # a member with several rows has the values of all of them
        rows = tags.where("memberId is not null").groupBy("memberId").agg(F.collect_list(
            F.struct(*map(self._texts, self.names)) if self.names else F.struct(F.lit(0).alias("_"))).alias("rows"))
        none = F.array(F.lit(None).cast("string"))
        people = rows.select("memberId", *[F.array_except(self._held(n), none).alias(f"v_{n}") for n in self.names],
                             *[self._any(n).alias(f"h_{n}") for n in self.names])
        people = people.withColumns({f"d_{n}": F.transform(f"v_{n}", lambda x: x.try_cast(NUMBER))
                                     for n in self.names if (n, "range") in self.kinds and self._numeric(n)})
        self.people = stored_table(spark, people, "member-values")
        self.audiences = stored_table(spark, self._audiences(), "audiences")

    def _numeric(self, n: str) -> bool:
        return _is_number(_elem(self.schema, n))

    def _texts(self, n: str) -> Column:
        if n not in self.arrays:
            return F.col(n).cast("string").alias(n)
        return F.coalesce(F.col(n).cast("array<string>"), F.array().cast("array<string>")).alias(n)

    def _held(self, n: str) -> Column:
        """The texts of a member's rows, with nulls."""
        return F.flatten(F.col(f"rows.{n}")) if n in self.arrays else F.col(f"rows.{n}")

    def _any(self, n: str) -> Column:
        """Whether there is any (a null in a list is one)."""
        return F.size(self._held(n) if n in self.arrays else F.array_compact(self._held(n))) > 0

    def _audiences(self) -> DataFrame:
        """audienceId and the rules of each tag, ``c_<tag>`` (null: not
        named). An invalid rule is lost only where the tag has another one; an
        audience with a tag of invalid rules alone selects nobody."""
        rule = F.struct("type", "kind", "text", "lo", "hi", "dlo", "dhi", "plo", "phi")
        per_tag = self.named.groupBy("audienceId", "name").agg(
            F.max("valid").alias("valid"), F.sort_array(F.collect_list(F.when(F.col("valid"), rule))).alias("c"))
        return per_tag.groupBy("audienceId").agg(F.bool_and("valid").alias("valid"), *[
            F.any_value(F.when(F.col("name") == n, F.col("c")), ignoreNulls=F.lit(True)).alias(f"c_{n}")
            for n in self.names]).where("valid").drop("valid")

    def _bin(self, n: str, place: Column) -> Column:
        cuts = self.cuts.get(n)
        if not cuts:
            return F.lit(NO_BIN)
        return F.when(place.isNull(), NO_BIN).otherwise(F.size(F.filter(
            F.lit(cuts).cast("array<double>"), lambda x: x <= place)))

    def facts(self, kinds, carry: list[Column]) -> DataFrame:
        """memberId, ``carry``, and the member's facts of ``kinds``: name,
        kind, fact, number, bin."""
        out = []
        for n, kind in sorted(k for k in kinds if k[1] != "set"):
            fact, ranged = F.col("fact"), kind == "range"
            bin_ = F.lit(None) if not ranged else F.lit(NO_BIN) if n in self.arrays else self._bin(
                n, _place(fact, _elem(self.schema, n)))
            number = fact.try_cast(NUMBER) if ranged and self._numeric(n) else F.lit(None).cast(NUMBER)
            out.append(self.people.select("memberId", *carry, F.explode(f"v_{n}").alias("fact")).select(
                "*", F.lit(n).alias("name"), F.lit(kind).alias("kind"),
                number.alias("number"), bin_.cast("int").alias("bin")))
        return reduce(DataFrame.unionByName, out)

    def _ends(self) -> tuple[Column, Column]:
        """The first and the last bin that a range rule touches."""
        low, high = F.lit(0), F.lit(0)
        for n, cuts in self.cuts.items():
            here = F.col("name") == n
            low = F.when(here, F.when(F.col("plo").isNull(), 0).otherwise(self._bin(n, F.col("plo")))).otherwise(low)
            high = F.when(here, F.when(F.col("phi").isNull(), len(cuts)).otherwise(
                self._bin(n, F.col("phi")))).otherwise(high)
        return F.greatest(low, F.lit(0)), F.greatest(high, F.lit(0))

    def ranges(self, rules: DataFrame) -> DataFrame:
        """Range rules, one row per ``bin`` they touch."""
        low, high = self._ends()
        touched = F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))
        return rules.where("kind = 'range'").withColumn("bin", F.explode(F.concat(F.array(F.lit(NO_BIN)), touched)))

    def priced_ranges(self, listed) -> DataFrame:
        """Range rules with ``n``, the members in the bins they touch, and
        ``asked``, the range rules of their tag."""
        rules = self.rules.where("kind = 'range'")
        held = {(r["name"], r["bin"]): r["count"] for r in self.facts(listed, []).groupBy("name", "bin").count().collect()}
        asked = {r["name"]: r["count"] for r in rules.groupBy("name").count().collect()}  # one a tag
        low, high = self._ends()
        n, most = F.lit(0), F.lit(0)
        for name in sorted(asked):
            # how many members the bins before each one hold: ``bins`` numbers a tag
            before = [sum(held.get((name, b), 0) for b in range(k)) for k in range(len(self.cuts.get(name, ())) + 2)]
            before = F.lit(before).cast("array<bigint>")
            inside = F.get(before, F.greatest(low, high) + 1) - F.get(before, low)
            here = F.col("name") == name
            n = F.when(here, F.when(low <= high, inside).otherwise(0) + held.get((name, NO_BIN), 0)).otherwise(n)
            most = F.when(here, asked[name]).otherwise(most)
        return rules.withColumns({"n": n.cast("long"), "asked": most.cast("long")})

    def needs(self, names) -> list[str]:
        """The columns that the rules of the given tags read."""
        made = {"eq": "v", "set": "h"}
        return sorted({f"{made.get(k) or ('d' if self._numeric(n) else 'v')}_{n}" for n, k in self.kinds if n in names})

    def carried(self, needs: list[str]) -> list[Column]:
        """The columns ``needs`` for the lists: one value of tags that are no
        arrays, and ``many``, all of theirs for members that have several."""
        plain = [c for c in needs if c[0] != "h" and c[2:] not in self.arrays]
        several = reduce(Column.__or__, [F.size(c) > 1 for c in plain], F.lit(False))
        many = [F.when(several, F.struct(*plain)).alias("many")] if plain else []
        return [F.get(c, F.lit(0)).alias(c) if c in plain else F.col(c) for c in needs] + many

    def _any_value(self, c: str, test) -> Column:
        """Whether a carried value passes."""
        if c[2:] in self.arrays:
            return F.exists(c, test)
        return F.when(F.col("many").isNull(), test(F.col(c))).otherwise(F.exists(f"many.{c}", test))

    def _meets(self, n: str):
        kinds = {k for m, k in self.kinds if m == n}

        def meets(r: Column) -> Column:
            ok = F.lit(False)
            if "range" in kinds:
                lo, hi, v = ("dlo", "dhi", f"d_{n}") if self._numeric(n) else ("lo", "hi", f"v_{n}")
                ok = F.when(r.kind == "range", self._any_value(v, lambda x: _within(x, r[lo], r[hi]))).otherwise(ok)
            if "set" in kinds:
                ok = F.when(r.kind == "set", F.col(f"h_{n}")).otherwise(ok)
            if "eq" in kinds:
                hit = F.coalesce(self._any_value(f"v_{n}", lambda x: x == r.text), F.lit(False))
                ok = F.when(r.kind == "eq", hit != (r.type == "notMatch")).otherwise(ok)
            return F.coalesce(ok, F.lit(False))
        return meets

    def satisfied(self, names) -> Column:
        """Whether the member of a list satisfies one rule of every given
        tag's ``c_<tag>``; ``notMatch`` counts until it is hit."""
        out = F.lit(True)
        for n in names:
            c, meets = F.col(f"c_{n}"), self._meets(n)
            # most tags have one rule
            out = out & (c.isNull() | meets(F.get(c, F.lit(0))) | ((F.size(c) > 1) & F.exists(c, meets)))
        return out


def _entries(p: _People) -> DataFrame:
    """The audiences with their ``entry``: the tag whose rules read the
    shortest lists (null: every tag can be had by a member without any hit),
    ``cost``, the members in those, and ``asked``, the most audiences that
    read one of them; ``ways``: how many rules the entry has."""
    wide = F.col("type").isin("exists", "notMatch")
    cost = ["audienceId", "name", wide.alias("wide")]
    none = F.lit(None).cast("long")
    read = p.rules.where(wide).select(*cost, none.alias("n"), none.alias("asked"))
    exact, near = ({k for k in p.kinds if k[1] == kind} for kind in ("eq", "range"))
    if exact:
        # lists are only counted here: a number for their key will do
        at = lambda key: F.xxhash64("name", key).alias("key")
        lists = p.facts(exact, []).select(at("fact")).groupBy("key").agg(F.count("*").alias("n"))
        rules = p.rules.where((F.col("kind") == "eq") & ~wide).select(*cost, at("text"))
        asked = rules.groupBy("key").agg(F.count("*").alias("asked"))
        lists = lists.join(asked.hint("merge"), "key")
        read = read.unionByName(rules.join(lists.hint("merge"), "key", "left").drop("key"))
    if near:
        read = read.unionByName(p.priced_ranges(near).select(*cost, "n", "asked"))
    clause = read.repartition("audienceId").groupBy("audienceId", "name").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("cost"), F.coalesce(F.max("asked"), F.lit(0)).alias("asked"),
        F.bool_or("wide").alias("wide"))
    best = clause.where("not wide").groupBy("audienceId").agg(F.min(F.struct("cost", "name", "asked")).alias("x"))
    best = best.select("audienceId", F.col("x.name").alias("entry"), "x.cost", "x.asked")
    out = p.audiences.join(best.hint("merge"), "audienceId", "left")
    ways = reduce(lambda w, n: F.when(F.col("entry") == n, F.size(f"c_{n}")).otherwise(w), p.names, F.lit(0))
    return stored_table(p.spark, out.withColumn("ways", ways), "audience-entries")


def _joined(p: _People, entering: DataFrame, n: str, others: list[str], ways: int) -> DataFrame:
    """The pairs of audiences that enter by tag ``n``, by ``ways`` of its rules
    at most: its lists tell the tag's own rules, the members' values those of
    the ``others``."""
    pair = ["audienceId", "memberId"]
    carry = p.carried(p.needs(others))
    rule_side = ["audienceId", "ways", *[f"c_{m}" for m in others]]
    rules = entering.select(*rule_side, F.lit(n).alias("name"), F.inline(f"c_{n}"))
    out, again = [], []
    if (n, "eq") in p.kinds:
        asked = rules.where("kind = 'eq'").select(*rule_side, F.col("text").alias("fact"))
        met = p.facts({(n, "eq")}, carry).drop("name", "kind", "number", "bin").join(
            asked.hint("merge"), "fact").where(p.satisfied(others)).select(*pair, "ways")
        if ways > 1:
            met = stored_table(p.spark, met, f"audience-pairs-{n}")
            again.append(met.where("ways > 1").select(*pair))
        # one rule of one value meets a member once
        out.append(met.where("ways = 1").select(*pair))
    if (n, "range") in p.kinds:
        inside = _within(F.col("number"), F.col("dlo"), F.col("dhi")) if p._numeric(n) else _within(
            F.col("fact"), F.col("lo"), F.col("hi"))
        # written, as Spark 4.1 prunes columns wrongly where one explode reads another
        rules = stored_table(p.spark, rules.where("kind = 'range'"), f"audience-ranges-{n}")
        spread = p.ranges(rules).select(*rule_side, "bin", "lo", "hi", "dlo", "dhi")
        near = p.facts({(n, "range")}, carry).drop("name", "kind")
        again.append(near.join(spread.hint("merge"), "bin").where(inside).where(p.satisfied(others)).select(*pair))
    if again:
        out.append(reduce(DataFrame.unionByName, again).distinct())
    return reduce(DataFrame.unionByName, out)


def membership(tags: DataFrame, rules: DataFrame, bins: int = BINS, salt: int = SALT, short: int = SHORT) -> DataFrame:
    """``audienceId, memberId`` of every audience's members. ``tags`` holds
    one row per member; columns that no rule names need not be there."""
    p = _People(tags, rules, bins)
    parts = max(salt, -(-p.people.count() // member_parts.MEMBERS))
    apart = F.col("entry").isNull() | (F.col("cost") > short * parts) | (F.col("asked") > ASKED)
    audiences = _entries(p).withColumn("apart", apart)
    there = audiences.groupBy("entry", "apart").agg(F.count("*").alias("n"), F.max("ways").alias("ways"), *[
        F.count(f"c_{n}").alias(f"c_{n}") for n in p.names]).collect()  # two a tag
    out = [_joined(p, audiences.where((F.col("entry") == r.entry) & ~F.col("apart")), r.entry,
                   [n for n in p.names if n != r.entry and r[f"c_{n}"]], r.ways)
           for r in sorted((r for r in there if not r.apart), key=lambda r: r.entry)]
    far = [r for r in there if r.apart]
    if far:
        names = [n for n in p.names if any(r[f"c_{n}"] for r in far)]
        out.append(member_parts.pairs(
            p.people, audiences.where("apart"), names, {n: p._numeric(n) for n in names},
            p.needs(names), parts, sum(r.n for r in far)))
    if not out:
        return audiences.limit(0).select("audienceId", F.lit(None).cast(tags.schema["memberId"].dataType).alias("memberId"))
    return reduce(DataFrame.unionByName, out)
