"""Conversation structure repair (operator 11): generalised LR repair.

Role initials of a conversation must form ``(s?(ua)+)?``. The grammar's LR
automaton runs over the turns with several stacks at once. Every stack may
read a turn as it is (keep), as user or assistant (rerole), skip it (delete),
or read an empty turn that is not there (insert). Stacks share their lower
parts, and stacks with equal tops merge into the one of least (cost, audit),
so a turn costs a constant number of stack operations. The audit holds the
edits' initials (K, R, D, I) in order; it fixes the repaired conversation.

That the merge is exact: what may follow a top does not depend on what lies
under it in this grammar, and of two audits with equal costs over the same
turns neither begins the other (the longer one would hold more inserts).

Conversations of up to ``long_rows`` turns and ``long_bytes`` of text are
repaired each in one piece, streamed from sorted partitions. Longer ones
(a hot conversation may hold a third of all rows) are cut into segments of
``SEGMENT`` turns: segments are repaired in parallel from every top they may
start with, and their results chained; first occurrences of a (role, text)
pair are found by a partially aggregated count; only the digest of the
repaired text, which is sequential by nature, reads one conversation's rows
in order, a batch at a time.

Edge cases: nulls in conv_id and turn read as one space where they are shown
and keep their own group and place (first); a null role or text is one space;
rows of equal turn are ordered by role and text; repeated rows are
duplicates; other columns are ignored; a conversation without turns has
zeros, an empty audit and the digest of the empty string; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from memberscope.llm.common import scratch_table, ship

LONG_ROWS, LONG_BYTES = 4_000, 16 << 20
SEGMENT_BITS = 10
SEGMENT = 1 << SEGMENT_BITS
BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

#: The role grammar: conversation, pairs, turn pair.
GRAMMAR = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "PT"), ("P", "T"), ("T", "ua"))


class Automaton:
    """LR(0) automaton of GRAMMAR: ``go[state][symbol]``, ``done[state]`` the
    production that a state without other moves reduces by, ``accepts`` the
    states in which the input may end."""

    def __init__(self, grammar=GRAMMAR):
        heads = {h for h, _ in grammar}

        def closure(items):
            items = set(items)
            while True:
                more = {(k, 0) for p, dot in items for k, (h, _) in enumerate(grammar)
                        if grammar[p][1][dot:dot + 1] == h and h in heads}
                if more <= items:
                    return frozenset(items)
                items |= more

        start = closure({(k, 0) for k, (h, _) in enumerate(grammar) if h == grammar[0][0]})
        states, self.go = [start], []
        for items in states:  # grows while it is read
            moves = {}
            for symbol in sorted({grammar[p][1][d] for p, d in items if d < len(grammar[p][1])}):
                after = closure({(p, d + 1) for p, d in items if grammar[p][1][d:d + 1] == symbol})
                if after not in states:
                    states.append(after)
                moves[symbol] = states.index(after)
            self.go.append(moves)
        ends = [[p for p, d in items if d == len(grammar[p][1])] for items in states]
        top = grammar[0][0]
        self.accepts = {k for k, e in enumerate(ends) if any(grammar[p][0] == top for p in e)}
        self.done = [grammar[e[0]] if e and not self.go[k] and k not in self.accepts else None
                     for k, e in enumerate(ends)]


LR = Automaton()


class Stack(NamedTuple):
    """One node of the graph-structured stack: a state over a shared rest."""

    state: int
    below: Stack | None

    def push(self, symbol: str) -> Stack | None:
        """The stack after reading ``symbol`` and all reductions it ends."""
        state = LR.go[self.state].get(symbol)
        if state is None:
            return None
        node = Stack(state, self)
        while (rule := LR.done[node.state]) is not None:
            for _ in rule[1]:
                node = node.below
            node = Stack(LR.go[node.state][rule[0]], node)
        return node


BOTTOM = Stack(0, None)


@lru_cache(maxsize=4096)
def _moves(stack: Stack) -> dict[str, Stack]:
    return {x: s for x in "sua" if (s := stack.push(x)) is not None}


class Best(NamedTuple):
    cost: int
    audit: str
    stack: Stack


Layer = dict[int, Best]


def _offer(layer: Layer, cost: int, audit: str, stack: Stack) -> bool:
    """Merge into the equal top, which keeps the least (cost, audit)."""
    old = layer.get(stack.state)
    if old is not None and (old.cost, old.audit) <= (cost, audit):
        return False
    layer[stack.state] = Best(cost, audit, stack)
    return True


def _with_inserts(layer: Layer) -> Layer:
    todo = list(layer.values())
    while todo:
        b = todo.pop()
        for symbol, after in _moves(b.stack).items():
            if symbol in ROLES and _offer(layer, b.cost + INSERT, b.audit + "I", after):
                todo.append(layer[after.state])
    return layer


def read_turn(layer: Layer, code: str) -> Layer:
    """The stacks after one turn. ``code``: ``d`` must be deleted, else the
    role's initial (``x`` for any other), upper case if truncated."""
    out: Layer = {}
    initial = code.lower()
    stays = TRUNCATED if code != initial else 0
    for b in layer.values():
        _offer(out, b.cost + DELETE, b.audit + "D", b.stack)
        if code != "d":
            for symbol, after in _moves(b.stack).items():
                if symbol == initial:
                    _offer(out, b.cost + stays, b.audit + "K", after)
                elif symbol in ROLES:
                    _offer(out, b.cost + stays + REROLE, b.audit + "R", after)
    return _with_inserts(out)


def start_layer(stack: Stack = BOTTOM) -> Layer:
    return _with_inserts({stack.state: Best(0, "", stack)})


def repair_codes(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; ties go to the least audit."""
    layer = start_layer()
    for code in codes:
        layer = read_turn(layer, code)
    return min((b.cost, b.audit) for s, b in layer.items() if s in LR.accepts)


@lru_cache(maxsize=50_000)
def _short_repair(codes: str) -> tuple[int, str]:
    return repair_codes(codes)


def code_of(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


def apply_edits(rows, audit: str, expected: str = "u"):
    """(role, text) of the repaired turns. ``expected`` is the initial that
    an inserted or reroled turn takes next."""
    rows = iter(rows)
    for edit in audit:
        if edit == "I":
            role, text = ROLES[expected], ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                role = ROLES[expected]
        expected = "a" if role[:1] == "u" else "u"
        yield role, text


# ---------------------------------------------------------------- columns

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the contract's damage, by crc32 of
    ``conv_id:turn`` modulo 20; a dropped row stays as a mark with null role,
    so that its conversation is not forgotten."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).cast("int")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                shown("role").alias("role"), shown("text").alias("text"),
                                kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    here = F.col("kind") != 0
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(here, role).alias("role"),
                       F.when(here, text).alias("text"), F.explode(copies).alias("_")).drop("_")


def clean_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls read as one space."""
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *[
        F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def _long_conversations(turns: DataFrame, long_rows: int, long_bytes: int) -> DataFrame:
    return scratch_table(turns.sparkSession, turns.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).where(
        (F.col("n") > long_rows) | (F.col("size") > long_bytes)).select("conv_id"),
        "long-conversations")


def _stream(rows: DataFrame, visit, schema: str, conv_type: T.DataType) -> DataFrame:
    """``visit(conv_id, rows)`` for each conversation of partitions that hold
    whole conversations in order; rows are (turn, role, text)."""
    out_schema = T.StructType([T.StructField("conv_id", conv_type)] + T._parse_datatype_string(schema).fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out_schema.fields])

    def run(batches):
        out, conv, rows_, size = [], None, None, 0

        def flush():
            batch = pa.RecordBatch.from_pydict(
                {f.name: [r[k] for r in out] for k, f in enumerate(arrow)}, schema=arrow)
            out.clear()
            return batch

        for batch in batches:
            for c, turn, role, text in zip(*[col.to_pylist() for col in batch.columns]):
                if rows_ is None or c != conv:
                    if rows_ is not None:
                        for r in visit(rows_):
                            out.append((conv, *r))
                            size += len(r[-1])
                        if len(out) >= 1000 or size > 4 << 20:
                            yield flush()
                            size = 0
                    conv, rows_ = c, []
                if role is not None:
                    rows_.append((turn, role, text))
        if rows_ is not None:
            out += [(conv, *r) for r in visit(rows_)]
        if out:
            yield flush()

    ordered = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, out_schema)


def conversation_faults(rows) -> list[str]:
    """The first fault of each (turn, role, text), '' for none."""
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.rstrip(BLANKS)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _repaired(rows):
    faults = conversation_faults(rows)
    codes = "".join(code_of(r[1], f) for r, f in zip(rows, faults))
    cost, audit = _short_repair(codes) if len(codes) <= 64 else repair_codes(codes)
    return faults, cost, audit, apply_edits([r[1:] for r in rows], audit)


def _summary(rows):
    faults, cost, audit, repaired = _repaired(rows)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{role}:{t}" for role, t in repaired)
    yield (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
           faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
           hashlib.sha256(text.encode()).hexdigest())


def _turns(rows):
    for k, (role, text) in enumerate(_repaired(rows)[3]):
        yield k, role, text


SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
TURNS = "position long, role string, text string"


# ------------------------------------------------- long conversations

def _long_rows(rows: DataFrame) -> DataFrame:
    """The rows of long conversations as a written table with their place:
    ``pos`` rises within a conversation, ``seg`` numbers segments."""
    placed = (rows.where("role is not null")
              .withColumn("_head", F.substring("text", 1, 64))
              .repartitionByRange("conv_id", "turn", "role", "_head").drop("_head")
              .sortWithinPartitions("conv_id", "turn", "role", "text")
              .withColumn("pos", F.monotonically_increasing_id()))
    placed = scratch_table(rows.sparkSession, placed, "long-turns")
    first = placed.groupBy("conv_id", F.sha2(F.concat("role", F.lit("\0"), "text"), 256)).agg(
        F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    shown = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    fault = F.when(shown == "", "blank").when(F.col("first").isNull(), "duplicate").when(
        ~shown.isin(".", "!", "?"), "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    code = F.when(fault.isin("blank", "duplicate"), "d").otherwise(F.when(
        fault == "truncated", F.upper(F.when(initial.isin("s", "u", "a"), initial).otherwise("x"))).otherwise(
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x")))
    out = placed.join(first, "pos", "left").select(
        "conv_id", "pos", F.shiftright("pos", SEGMENT_BITS).alias("seg"), "turn", "role", "text",
        initial.alias("initial"), fault.alias("fault"), code.alias("code"))
    return scratch_table(rows.sparkSession, out, "long-codes")


#: Tops with which a segment may start, each over a stack that leads there.
def _entries() -> dict[int, Stack]:
    found = [BOTTOM]
    for stack in found:  # grows while it is read; the stacks are few
        found += [s for s in _moves(stack).values() if s not in found]
    return {s.state: s for s in reversed(found)}


ENTRIES = _entries()


def _segment_paths(codes: str) -> list[dict]:
    out = []
    for entry, stack in ENTRIES.items():
        layer = {entry: Best(0, "", stack)} if entry else start_layer()
        for code in codes:
            layer = read_turn(layer, code)
        out += [{"entry": entry, "exit": s, "cost": b.cost, "audit": b.audit} for s, b in layer.items()]
    return out


class Chain:
    """The cheapest repair of a conversation from its segments' results, given
    in order. Audits are compared past what all tops have in common."""

    def __init__(self):
        self.best = {0: (0, "", ())}

    def add(self, seg: int, paths: list[dict]) -> None:
        after = {}
        for p in paths:
            if p["entry"] in self.best:
                cost, audit, way = self.best[p["entry"]]
                new = (cost + p["cost"], audit + p["audit"], (way, seg, p["entry"], p["audit"]))
                if p["exit"] not in after or new[:2] < after[p["exit"]][:2]:
                    after[p["exit"]] = new
        shared = len(commonprefix([audit for _, audit, _ in after.values()]))
        self.best = {s: (cost, audit[shared:], way) for s, (cost, audit, way) in after.items()}

    def result(self) -> tuple[int, list[tuple[int, int, str]]]:
        """Total cost, and (seg, entry, audit) of each segment."""
        cost, _, way = min((b for s, b in self.best.items() if s in LR.accepts), key=lambda b: b[:2])
        steps = []
        while way:
            way, *step = way
            steps.append(tuple(step))
        return cost, steps[::-1]


def _long_plan(rows: DataFrame, conv_type: T.DataType) -> DataFrame:
    """conv_id, seg (null: the whole conversation), entry, audit, cost of the
    cheapest repairs. Chaining streams a conversation's segments in order and
    keeps one audit per stack top, no more than a few times the result."""
    codes = rows.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("x")
                                               ).select("conv_id", "seg", F.array_join("x.code", "").alias("codes"))
    path = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                               ("audit", pa.string())]))
    conv = T.StructField("conv_id", conv_type)

    def segments(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([_segment_paths(c) for c in part.column(2).to_pylist()], path)],
                    names=["conv_id", "seg", "paths"])

    paths = codes.mapInArrow(segments, T.StructType([conv] + T._parse_datatype_string(
        "seg long, paths array<struct<entry:int,exit:int,cost:long,audit:string>>").fields))
    schema = T.StructType([conv] + T._parse_datatype_string(
        "seg long, entry int, cost long, audit string").fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def chain(batches):
        def of(conv_id, held):
            cost, steps = held.result()
            rows_ = [(conv_id, None, 0, cost, "".join(a for _, _, a in steps))]
            rows_ += [(conv_id, s, e, cost, a) for s, e, a in steps]
            return pa.RecordBatch.from_pydict(
                {f.name: [r[k] for r in rows_] for k, f in enumerate(arrow)}, schema=arrow)

        conv_id, held = None, None
        for batch in batches:
            for c, seg, p in zip(*[col.to_pylist() for col in batch.columns]):
                if held is None or c != conv_id:
                    if held is not None:
                        yield of(conv_id, held)
                    conv_id, held = c, Chain()
                held.add(seg, p)
        if held is not None:
            yield of(conv_id, held)

    out = paths.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(chain, schema)
    return scratch_table(rows.sparkSession, out, "long-repairs")


def _long_turns(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """conv_id, pos, n, role, text: repaired turns of long conversations; a
    row's inserts carry its ``pos`` and are numbered by ``n``. Each row gets
    its own edits, so no segment's texts are gathered."""
    steps = plan.where("seg is not null").select("conv_id", "seg", "entry", "audit")
    # edits of row k of a segment: its own (K, R, D), with the inserts before
    # it; inserts after the last row go with it
    places = rows.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list("pos")).alias("places"),
                                                F.sort_array(F.collect_list(F.struct("pos", "initial"))).alias("i"))
    joined = places.join(steps, places.conv_id.eqNullSafe(steps.conv_id) & (places.seg == steps.seg)).select(
        places.conv_id, "places", F.col("i.initial").alias("initials"), "entry", "audit")
    edit = pa.list_(pa.struct([("n", pa.int32()), ("role", pa.string())]))

    def spread(batches):
        for batch in batches:
            pos, edits = [], []
            for _, places_, initials, entry, audit in zip(*[c.to_pylist() for c in batch.columns]):
                expected = "a" if "a" in LR.go[entry] else "u"
                k, made, n = 0, [], 0
                for e in audit:
                    if e == "I":
                        made.append({"n": n, "role": ROLES[expected]})
                        expected = "a" if expected == "u" else "u"
                        n += 1
                        continue
                    if k:  # the edits before this row's own belong to the row before
                        pos.append(places_[k - 1])
                        edits.append(made)
                        made, n = [], 0
                    if e == "K":
                        made.append({"n": n, "role": None})
                        expected = "a" if initials[k] == "u" else "u"
                        n += 1
                    elif e == "R":
                        made.append({"n": n, "role": "=" + ROLES[expected]})
                        expected = "a" if expected == "u" else "u"
                        n += 1
                    k += 1
                pos.append(places_[k - 1])
                edits.append(made)
            yield pa.RecordBatch.from_arrays([pa.array(pos, pa.int64()), pa.array(edits, edit)],
                                             names=["pos", "edits"])

    by_row = joined.mapInArrow(spread, "pos long, edits array<struct<n:int,role:string>>")
    each = rows.join(by_row, "pos").select("conv_id", "pos", "role", "text", F.explode("edits").alias("e"))
    made = F.col("e.role")
    return each.select("conv_id", "pos", F.col("e.n").alias("n"),
                       F.when(made.isNull(), F.col("role")).otherwise(F.ltrim(made, F.lit("="))).alias("role"),
                       F.when(made.isNull() | made.startswith("="), F.col("text")).otherwise("").alias("text"))


def _long_summary(rows: DataFrame, conv_type: T.DataType) -> DataFrame:
    plan = _long_plan(rows, conv_type)
    seg = rows.groupBy("conv_id", "seg").agg(
        F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_distinct("turn").alias("turns"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.sort_array(F.collect_list(F.struct("pos", "initial"))).alias("i"))
    # neighbours across segments: one row per segment, in order
    seg = seg.select("conv_id", "seg", "lo", "hi", "turns", "blank", "duplicate", "truncated",
                     F.col("i.initial").alias("i"))
    pairs = F.aggregate(F.sequence(F.lit(1), F.size("i") - 1), F.lit(0).cast("long"), lambda n, k: n + F.when(
        F.concat(F.get("i", k - 1), F.get("i", k)).isin("su", "ua", "au"), 0).otherwise(1))
    seg = seg.withColumn("illegal", F.when(F.size("i") > 1, pairs).otherwise(0)).select(
        "*", F.get("i", F.lit(0)).alias("head"), F.element_at("i", -1).alias("tail")).drop("i")
    order = Window.partitionBy("conv_id").orderBy("seg")
    seg = seg.withColumn("was", F.lag("tail").over(order)).withColumn("was_hi", F.max("hi").over(
        order.rowsBetween(Window.unboundedPreceding, -1)))
    total = seg.groupBy("conv_id").agg(
        F.coalesce(F.max("hi") - F.min("lo") + 1 - F.sum(
            F.col("turns") - F.when(F.col("was_hi") == F.col("lo"), 1).otherwise(0)), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.count_if(F.col("was").isNotNull() & ~F.concat("was", "head").isin(
            "su", "ua", "au"))).alias("illegal"))

    digest_schema = T.StructType([T.StructField("conv_id", conv_type), T.StructField("digest", T.StringType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in digest_schema.fields])

    def digest(batches):
        conv_id, h = None, None
        for batch in batches:
            for c, role, text in zip(*[col.to_pylist() for col in batch.columns]):
                if h is not None and c != conv_id:
                    yield pa.RecordBatch.from_pydict({"conv_id": [conv_id], "digest": [h.hexdigest()]}, schema=arrow)
                    h = None
                if h is None:
                    conv_id, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
        if h is not None:
            yield pa.RecordBatch.from_pydict({"conv_id": [conv_id], "digest": [h.hexdigest()]}, schema=arrow)

    digests = (_long_turns(rows, plan).repartition("conv_id")
               .sortWithinPartitions("conv_id", "pos", "n").select("conv_id", "role", "text")
               .mapInArrow(digest, digest_schema))
    whole = plan.where("seg is null").select(F.col("conv_id").alias("c1"), "cost", "audit")
    digests = digests.select(F.col("conv_id").alias("c2"), "digest")
    return (total.join(whole, F.col("conv_id").eqNullSafe(F.col("c1")))
            .join(digests, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                    F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def _split(turns: DataFrame, long_rows: int, long_bytes: int):
    """(rows of short conversations, rows of long ones or None)."""
    long = _long_conversations(turns, long_rows, long_bytes)
    if long.isEmpty():
        return turns, None
    same = turns.conv_id.eqNullSafe(long.conv_id)
    return turns.join(long, same, "left_anti"), turns.join(long, same, "left_semi")


def repair_summary(turns: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost and
    audit of the cheapest repair, digest of the repaired text. ``turns`` has
    conv_id, turn, role, text; a row with null role only names its
    conversation (see ``clean_turns`` and ``damage``)."""
    ship(turns.sparkSession)
    conv_type = turns.schema["conv_id"].dataType
    short, long = _split(turns, long_rows, long_bytes)
    out = _stream(short, _summary, SUMMARY, conv_type)
    if long is None:
        return out
    rows = _long_rows(long)
    known = _long_summary(rows, conv_type)
    dropped = long.groupBy("conv_id").agg(F.count("role").alias("n")).where("n = 0").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in (
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
    return out.unionByName(known).unionByName(dropped)


def repaired_turns(turns: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """conv_id, position, role, text of the repaired conversations; positions
    rise in order (gapless for short conversations)."""
    ship(turns.sparkSession)
    conv_type = turns.schema["conv_id"].dataType
    short, long = _split(turns, long_rows, long_bytes)
    out = _stream(short, _turns, TURNS, conv_type)
    if long is None:
        return out
    rows = _long_rows(long)
    more = _long_turns(rows, _long_plan(rows, conv_type))
    # a row has at most three places: a cheapest repair has no two inserts together
    place = F.col("pos") * 4 + F.col("n")
    return out.unionByName(more.select("conv_id", place.alias("position"), "role", "text"))
