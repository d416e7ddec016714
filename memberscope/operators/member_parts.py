"""Audiences against parts of the members.

Members are dealt into parts of about ``MEMBERS``, audiences into blocks of
about ``AUDIENCES``; a task holds one part and reads one block. In a part a
tag's values are sorted once, so a clause (the rules of one tag) is a slice of
its members, kept as one bit each, and an audience the conjunction of its
clauses; audiences of a block with equal rules share it. A task returns member
lists and audience lists, whose products are the pairs: they are made row by
row, never held.

The clauses mean what ``functions.rules`` says; numbers are compared as
decimals of six places, texts by code point, as the lists compare them.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_left, bisect_right
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberscope.session import stored_table

MEMBERS = 65_536
AUDIENCES = 100_000
#: Clauses kept as bits, and ids returned at once.
KEPT, IDS = 512, 1_000_000


def _unscaled(number: str) -> int:
    return int(number.replace(".", ""))


class _Values:
    """The values of one column of lists: members by value, values in order."""

    def __init__(self, lists: pa.Array):
        self.owners = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        flat = lists.flatten()
        if flat.null_count:
            self.owners, flat = self.owners[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
        if pa.types.is_decimal(flat.type):
            codes = self._numbers(flat)
        else:
            found = flat.dictionary_encode()
            texts = found.dictionary.to_pylist()
            order = sorted(range(len(texts)), key=texts.__getitem__)
            place = np.empty(len(texts), np.int64)
            place[order] = np.arange(len(texts))
            self.values, codes = [texts[i] for i in order], place[found.indices.to_numpy()]
        self.owners = self.owners[np.argsort(codes, kind="stable")]
        self.starts = np.searchsorted(np.sort(codes), np.arange(len(self.values) + 1))

    def _numbers(self, flat: pa.Array) -> np.ndarray:
        words = np.frombuffer(flat.buffers()[1], np.int64)[2 * flat.offset:2 * (flat.offset + len(flat))] if len(
            flat) else np.empty(0, np.int64)
        low, high = words[0::2], words[1::2]
        if not np.array_equal(high, low >> 63):  # more than 64 bits
            low = np.array([(int(h) << 64) + (int(w) & (1 << 64) - 1) for w, h in zip(low, high)], object)
        values, codes = np.unique(low, return_inverse=True)
        self.values = values.tolist()
        return codes

    def between(self, low, high) -> np.ndarray:
        """The members with a value from ``low`` to ``high`` (None: no end)."""
        first = bisect_left(self.values, low)
        last = len(self.values) if high is None else bisect_right(self.values, high)
        return self.owners[self.starts[first]:self.starts[max(first, last)]]

    def equal(self, value) -> np.ndarray:
        return self.between(value, value)


class _Part:
    """The members of one part and the clauses that were asked lately."""

    def __init__(self, members: pa.Table, numeric: dict[str, bool]):
        self.ids = members["memberId"].combine_chunks()
        self.members, self.numeric = members, numeric
        self.columns, self.clauses = {}, OrderedDict()

    def _values(self, column: str) -> _Values:
        if column not in self.columns:
            self.columns[column] = _Values(self.members[column].combine_chunks())
        return self.columns[column]

    def _rule(self, n: str, rule: dict) -> np.ndarray:
        bits = np.zeros(len(self.ids), bool)
        if rule["kind"] == "set":
            return self.members[f"h_{n}"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        if rule["kind"] == "eq":
            if "text" in rule:
                bits[self._values(f"v_{n}").equal(rule["text"])] = True
            return ~bits if rule["type"] == "notMatch" else bits
        numeric = self.numeric[n]
        low, high = (rule.get(k) for k in (("dlo", "dhi") if numeric else ("lo", "hi")))
        if low is not None:
            to = _unscaled if numeric else str
            bits[self._values(f"d_{n}" if numeric else f"v_{n}").between(
                to(low), None if high is None else to(high))] = True
        return bits

    def _clause(self, n: str, text: str) -> np.ndarray:
        bits = self.clauses.get((n, text))
        if bits is None:
            bits = np.zeros(len(self.ids), bool)
            for rule in json.loads(text):
                bits |= self._rule(n, rule)
            if len(self.clauses) >= KEPT:
                self.clauses.popitem(last=False)
            self.clauses[n, text] = bits
        else:
            self.clauses.move_to_end((n, text))
        return bits

    def meet(self, told: dict[str, str | None]) -> np.ndarray:
        """The places of the members that satisfy every clause."""
        bits = np.ones(len(self.ids), bool)
        for n, text in told.items():
            if text is not None:
                bits &= self._clause(n, text)
        return np.flatnonzero(bits)


def _lists(ids: list[pa.Array]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(ids))


def pairs(people: DataFrame, audiences: DataFrame, names: list[str], numeric: dict[str, bool], needs: list[str],
          parts: int, count: int) -> DataFrame:
    """``audienceId, memberId`` of the audiences (``c_<tag>``: the rules of
    each of ``names``; ``count`` of them) and the people (``needs``: the
    columns that those rules read), who are dealt into ``parts``."""
    # Python workers need not have this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    blocks = -(-count // AUDIENCES)
    member, audience = people.schema["memberId"].dataType, audiences.schema["audienceId"].dataType

    def rule(x):
        return x.withField("dlo", x.dlo.cast("string")).withField("dhi", x.dhi.cast("string")).dropFields("plo", "phi")

    clauses = [f"c_{n}" for n in names]
    told = [F.to_json(F.transform(c, rule), {"ignoreNullFields": "true"}).alias(c) for c in clauses]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of_members = people.select("memberId", *needs, every(blocks).alias("block"), F.pmod(
        F.xxhash64("memberId"), F.lit(parts)).cast("int").alias("part"))
    block = F.pmod(F.xxhash64("audienceId"), F.lit(blocks)).cast("int").alias("block")
    equal = audiences.select("audienceId", *told, block).groupBy("block", *clauses).agg(
        F.collect_list("audienceId").alias("audienceIds"))
    equal = stored_table(people.sparkSession, equal, "audience-clauses")  # every part reads it
    dealt = of_members.unionByName(equal.withColumn("part", every(parts)), allowMissingColumns=True).withColumn(
        "task", F.col("part") * blocks + F.col("block")).repartitionById(parts * blocks, "task")
    # a part's members first
    dealt = dealt.withColumn("last", F.col("audienceIds").isNotNull()).sortWithinPartitions("last").drop(
        "part", "block", "task")

    def run(batches):
        part, members = None, []
        for batch in batches:
            first = batch.num_rows - (batch["last"].true_count or 0)
            if first:
                members.append(batch.slice(0, first).select(["memberId", *needs]))
            if first == batch.num_rows or not members:
                continue
            if part is None:
                part = _Part(pa.Table.from_batches(members), numeric)
            asked = batch.slice(first)
            texts = [asked[c].to_pylist() for c in clauses]
            rows, met, held = [], [], 0
            for i in range(len(asked)):
                places = part.meet({n: t[i] for n, t in zip(names, texts)})
                if len(places):
                    rows.append(i)
                    met.append(part.ids.take(pa.array(places)))
                    held += len(places)
                if held >= IDS or (held and i == len(asked) - 1):
                    yield pa.RecordBatch.from_arrays(
                        [asked["audienceIds"].take(pa.array(rows)), _lists(met)], ["audienceIds", "memberIds"])
                    rows, met, held = [], [], 0

    lists = dealt.mapInArrow(run, T.StructType([
        T.StructField("audienceIds", T.ArrayType(audience)), T.StructField("memberIds", T.ArrayType(member))]))
    return lists.select("memberIds", F.explode("audienceIds").alias("audienceId")).select(
        "audienceId", F.explode("memberIds").alias("memberId"))
