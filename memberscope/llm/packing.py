"""Packing (operator 1): first-fit decreasing in randomised groups.

A document's ids (end id appended) are cut into pieces of exactly
``capacity`` ids and one remainder. Full pieces fill a sequence by
themselves. Remainders are packed by first-fit decreasing: each, longest
first, goes to the first open sequence with room, found in O(log n) by a
tournament tree whose nodes hold the largest free capacity below them.
Documents are dealt to groups of about ``group_docs`` by a seeded hash of
their id, content and row number, so a group is a bounded random sample: its
lengths pack well, groups run independently, and no source, copy group or set
of equal rows meets in one. Only ids, lengths and checksums are shuffled, never texts.

Edge cases: a null or empty text is the end id alone; null doc ids are
allowed; repeated rows are packed each, spread over groups; ties
in length are ordered by doc_id, then content; an empty table gives no rows;
only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import zlib

import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberscope.llm import token_ids
from memberscope.llm.common import ship, text_or_empty

CAPACITY = 1024
GROUP_DOCS = 2048
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Tournament:
    """Free room of sequences in a complete binary tree; each inner node
    holds the larger of its children, so the first sequence with room for a
    piece is found by walking down once."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_with(self, length: int) -> int:
        node, room = 1, self.room
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        return node - self.leaves

    def take(self, bin_no: int, length: int) -> int:
        """Uses ``length`` of the room; returns what was free before."""
        room, node = self.room, bin_no + self.leaves
        before = room[node]
        room[node] = before - length
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return before


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; ``lengths`` come longest first."""
    tree = Tournament(len(lengths), capacity)
    placed = []
    for n in lengths:
        b = tree.first_with(n)
        placed.append((b, capacity - tree.take(b, n)))
    return placed


def document_pieces(docs: DataFrame, capacity: int = CAPACITY, vocab: str | None = None,
                    end: int = 0) -> DataFrame:
    """doc_id, doc_tokens, doc_crc and the crc32 of each ``capacity``-sized
    piece of the document's ids (unsigned, of little-endian 32-bit ids)."""
    ship(docs.sparkSession)

    def run(batches):
        path = vocab or public_tokenizers.path("byte_bpe_50k.json")  # where the worker has it
        encode, dtype = token_ids.encoder(path), token_ids.id_dtype(path)
        for batch in batches:
            n, whole, crcs = [], [], []
            for text in batch.column(1).to_pylist():
                ids = token_ids.with_end(encode(text), dtype, end).astype("<u4")
                n.append(len(ids))
                crcs.append([zlib.crc32(ids[i:i + capacity]) for i in range(0, len(ids), capacity)])
                whole.append(crcs[-1][0] if len(crcs[-1]) == 1 else zlib.crc32(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(whole, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64()))],
                names=["doc_id", "doc_tokens", "doc_crc", "crcs"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, doc_tokens long, doc_crc long, crcs array<long>")


def pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one group's documents with their sequence and offset."""
    group = group.assign(rest=group.doc_tokens % capacity).sort_values(
        ["rest", "doc_id", "doc_crc", "doc_tokens"], ascending=[False, True, True, True])
    tails = group[group.rest > 0]
    placed = first_fit_decreasing(tails.rest.tolist(), capacity)
    sequences = 1 + max((b for b, _ in placed), default=-1)
    rows = [(doc, n - rest, rest, crcs[-1], n, b, offset)
            for doc, n, rest, crcs, (b, offset) in zip(
                tails.doc_id, tails.doc_tokens, tails.rest, tails.crcs, placed)]
    for doc, n, crcs in zip(group.doc_id, group.doc_tokens, group.crcs):
        for k in range(n // capacity):
            rows.append((doc, k * capacity, capacity, crcs[k], n, sequences, 0))
            sequences += 1
    out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                      "sequence_id", "offset"])
    out["sequence_id"] += int(group.group.iloc[0]) << 32 if len(group) else 0
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS,
         seed: int = 1, vocab: str | None = None) -> DataFrame:
    """One row per piece: which ids of which document lie where."""
    groups = max(1, math.ceil(docs.count() / group_docs))
    pieces = document_pieces(docs, capacity, vocab).withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "doc_crc", "doc_tokens", F.monotonically_increasing_id(),
                                   F.lit(seed)), F.lit(groups)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        # ids keep their type when some are null
        group["doc_id"] = group["doc_id"].astype("Int64")
        return pack_group(group, capacity)

    return pieces.groupBy("group").applyInPandas(run, PIECES)


def packed_sequences(docs: DataFrame, layout: DataFrame, capacity: int = CAPACITY,
                     vocab: str | None = None, end: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids (little-endian
    32-bit, unpadded), doc_ids in order. ``doc_id`` must be unique here. A
    sequence gathers at most ``capacity`` ids."""
    ship(docs.sparkSession)

    def run(batches):
        path = vocab or public_tokenizers.path("byte_bpe_50k.json")  # where the worker has it
        encode, dtype = token_ids.encoder(path), token_ids.id_dtype(path)
        for batch in batches:
            docs_, starts, ids_ = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = token_ids.with_end(encode(text), dtype, end).astype("<u4")
                for i in range(0, len(ids), capacity):
                    docs_.append(doc)
                    starts.append(i)
                    ids_.append(ids[i:i + capacity].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(ids_, pa.binary())], names=["doc_id", "start", "piece"])

    pieces = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, start long, piece binary")
    place = layout.select("doc_id", "start", "sequence_id", "offset", "length")
    ordered = F.sort_array(F.collect_list(F.struct("offset", "piece", "doc_id")))
    return (pieces.join(place, pieces.doc_id.eqNullSafe(place.doc_id)
                        & (pieces.start == place.start))
            .select("sequence_id", place["offset"], place["length"], pieces["doc_id"], "piece")
            .groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("p"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("p.piece", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
                    F.col("p.doc_id").alias("doc_ids")))


def padded(n_tokens: int, capacity: int = CAPACITY) -> int:
    """Length after padding: ``capacity``, except at a power of two."""
    return n_tokens if n_tokens & (n_tokens - 1) == 0 else capacity


