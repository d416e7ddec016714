"""Ranked lexical search (operator 12): bit-sliced Bloom signatures.

Two passes over the documents per block of queries. The first counts, for the
block's terms, the documents that hold them, and all documents and terms.
The second cuts every partition into blocks of documents of similar size
and gives each block a signature: a bit matrix with one row per hash value
and one column per document, in which every term of a document sets
``HASHES`` rows, once for each of the ``LEVELS`` of its count that it
reaches. The rows of a query term, and-ed, hold all documents that reach a
level (and a few that do not), so

    sum over levels of gain(level, document) * sum of the weights of the
    query's terms whose slice has the document

is an upper bound of the document's score. Documents whose bound lies below
the k-th best exact score found so far are provably excluded; all others are
scored exactly from their term counts. The k-th best scores among
``SEED_DOCS`` documents are the first such limits (any documents give valid
ones), so tasks exclude from their first block on. A task returns at most k
documents per query; a window over those picks the final k.

Signature sizes follow the documents (``BITS`` bits per entry, so about one
slice bit in a thousand is wrong for any length), blocks hold at most
``BLOCK_CELLS`` cells, and queries come in blocks of at most ``query_block``
and ``query_bytes``: memory is bounded whatever the tables. Each block's hits
are a written table, so the driver holds one block of queries at a time.

Scores are integers (see ``weight_of`` and ``score_of``); equal scores go to
the smaller doc_id.

Edge cases: null and empty texts, or texts without a term, have no score and
are no documents for N and L; queries without a term return nothing; queries
that repeat as whole rows count once, an id with several texts is a query per
text; repeated documents are ranked each; a null doc_id comes before others
of the same score; an empty table gives no rows; only the named columns are
read, so others cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberscope.llm.common import Memo, scratch_table, ship, text_or_empty

K = 50
QUERY_BLOCK, QUERY_BYTES = 1_024, 4 << 20
#: Counts from which a term enters a level, and hash rows per entry.
LEVELS = (1, 2, 4)
HASHES = 5
BITS = 16
BLOCK_DOCS = 1_024
BLOCK_CELLS = 1 << 23
#: Queries whose bounds are worked out together, and terms per product.
TOGETHER, TERMS = 64, 2_048
#: Documents scored first, for the limits that tasks start from.
SEED_DOCS, SEED_PARTS = 4_096, 8
#: A-Z become a-z; other ASCII but digits and a-z become blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
NO_ID = -(1 << 63)


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of digits, letters a-z and characters beyond ASCII."""
    return text.encode().translate(FOLD).split()


def weight_of(docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holders + 1)))


def length_norm(n: int, docs: int, total: int) -> int:
    return 100 - 50 + (50 * n * docs) // total


def gain_of(tf, norm):
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norm)


@dataclass
class Queries:
    """One block of queries: ids of their terms, and the terms' weights."""

    terms: dict[bytes, int]
    items: list[list[int]]
    docs: int = 0
    total: int = 0
    weights: np.ndarray | None = None


def _text_schema(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))


def count_terms(docs: DataFrame, queries: Queries) -> Queries:
    """Fills in the document counts and weights of the block's terms: one
    partial count per task and term, summed by Spark."""
    vocabulary = queries.terms

    def run(batches):
        held = np.zeros(len(vocabulary) + 2, np.int64)
        known = frozenset(vocabulary)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                if words:
                    held[-2] += 1
                    held[-1] += len(words)
                    for t in known.intersection(words):
                        held[vocabulary[t]] += 1
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(held[found])], names=["term", "n"])

    sums = np.zeros(len(vocabulary) + 2, np.int64)
    for r in _text_schema(docs).mapInArrow(run, "term long, n long").groupBy("term").agg(
            F.sum("n").alias("n")).toLocalIterator():  # one row per term of the block
        sums[r.term] = r.n
    queries.docs, queries.total = int(sums[-2]), int(sums[-1])
    queries.weights = np.array([weight_of(queries.docs, int(n)) for n in sums[:-2]], np.int64)
    return queries


def _hash(entry: tuple[bytes, int]) -> int:
    return xxhash.xxh64_intdigest(entry[0], entry[1])


def _rows(hashes: np.ndarray, bits: int):
    """The signature rows of entries, one array per hash."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((hashes + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64)


class Block:
    """Documents of similar size with their signature."""

    def __init__(self, bits: int):
        self.bits, self.cells = bits, 0
        self.ids, self.lengths, self.peaks = [], [], []
        self.hashes, self.columns = [], []
        self.terms, self.counts, self.places = [], [], []  # query terms: number, count, document

    def add(self, doc_id: int, length: int, peak: int, counts: dict[int, int], hashes: list[int]) -> None:
        """``counts`` of the query terms, by number; ``hashes`` of all entries."""
        self.columns.append(len(hashes))
        self.hashes.append(np.array(hashes, np.uint64))
        self.terms.extend(counts)
        self.counts.extend(counts.values())
        self.places.append(len(counts))
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.peaks.append(peak)
        self.cells += self.bits

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.cells >= BLOCK_CELLS

    def signature(self) -> np.ndarray:
        """bits x documents, packed eight documents to a byte."""
        matrix = np.zeros((self.bits, len(self.ids)), bool)
        column = np.repeat(np.arange(len(self.ids)), self.columns)
        for rows in _rows(np.concatenate(self.hashes), self.bits):
            matrix[rows, column] = True
        return np.packbits(matrix, axis=1)


def slices(signature: np.ndarray, hashes: np.ndarray, docs: int) -> np.ndarray:
    """One row of document bits per entry hash (0/1 bytes)."""
    out = None
    for rows in _rows(hashes, len(signature)):
        out = signature[rows] if out is None else out & signature[rows]
    return np.unpackbits(out, axis=1, count=docs)


class Search:
    """The best ``k`` documents of each query among the blocks seen."""

    def __init__(self, queries: Queries, k: int, floors: list[int] | None = None):
        self.q, self.k, self.floors = queries, k, floors or [0] * len(queries.items)
        names = list(queries.terms)
        self.entry = [np.array([_hash((t, level)) for t in names], np.uint64) for level in LEVELS]
        self.names = names
        self.best: list[list[tuple[int, int]]] = [[] for _ in queries.items]  # (-score, id), ascending
        self.groups = []
        for at in range(0, len(queries.items), TOGETHER):
            members = range(at, min(at + TOGETHER, len(queries.items)))
            used = sorted({t for i in members for t in queries.items[i]})
            column = {t: c for c, t in enumerate(used)}
            weights = np.zeros((len(members), len(used)))
            for row, i in enumerate(members):
                for t in queries.items[i]:
                    weights[row, column[t]] = queries.weights[t]
            self.groups.append((members, np.array(used, np.int64), weights))
        self.excluded = self.scored = 0

    def bounds(self, block: Block, signature: np.ndarray, used: np.ndarray, weights: np.ndarray,
               gains: list[np.ndarray]) -> np.ndarray:
        """Upper bounds of the scores, queries x documents."""
        total = np.zeros((len(weights), len(block.ids)))
        for entry, gain in zip(self.entry, gains):
            level = np.zeros_like(total)
            for at in range(0, len(used), TERMS):
                part = used[at:at + TERMS]
                level += weights[:, at:at + TERMS] @ slices(signature, entry[part], len(block.ids)).astype(float)
            total += level * gain
        return total * (1 + 1e-12)

    def scores(self, rows: dict[int, np.ndarray], item: int, columns: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Exact scores of the documents in ``columns``; ``rows`` holds the
        counts per term (one number per document)."""
        total = np.zeros(len(columns), np.int64)
        for t in self.q.items[item]:
            if t in rows:
                total += int(self.q.weights[t]) * gain_of(rows[t][columns], norm[columns])
        return total

    def floor(self, item: int) -> int:
        """The score a document must reach (0: it must lie above)."""
        best = self.best[item]
        return max(self.floors[item], -best[-1][0] if len(best) == self.k else 0)

    def take(self, item: int, block: Block, columns: np.ndarray, rows, norm) -> None:
        self.scored += len(columns)
        limit = max(self.floor(item), 1)
        found = [(-s, block.ids[c]) for s, c in zip(
            self.scores(rows, item, columns, norm).tolist(), columns.tolist()) if s >= limit]
        if found:
            self.best[item] = sorted(self.best[item] + found)[:self.k]

    def scan(self, block: Block) -> None:
        if not block.ids:
            return
        signature = block.signature()
        norms = [length_norm(n, self.q.docs, self.q.total) for n in block.lengths]
        norm, peak = np.array(norms, np.int64), np.array(block.peaks, np.int64)
        # a count at level l is below the next level's, and at most the peak
        tops = [np.minimum(peak, after - 1) for after in LEVELS[1:]] + [peak]
        reach = [gain_of(top, norm).astype(float) for top in tops]
        gains = [reach[0]] + [np.maximum(b - a, 0) for a, b in zip(reach, reach[1:])]
        # counts by term: a row per term that some document of the block has
        term, count = np.array(block.terms, np.int64), np.array(block.counts, np.int64)
        place = np.repeat(np.arange(len(block.ids)), block.places)
        order = np.argsort(term, kind="stable")
        starts = np.flatnonzero(np.diff(term[order], prepend=-1))
        spans = {int(term[order[a]]): order[a:b] for a, b in zip(starts, [*starts[1:], len(order)])}
        rows = _Rows(spans, place, count, len(block.ids))
        for members, used, weights in self.groups:
            if not len(used):
                continue
            bound = self.bounds(block, signature, used, weights, gains)
            for row, item in enumerate(members):
                line = bound[row]
                left = np.flatnonzero(line >= max(self.floor(item), 1e-9))
                if len(left) > self.k:  # the most promising first
                    ranked = left[np.argpartition(-line[left], self.k - 1)]
                    self.take(item, block, ranked[:self.k], rows, norm)
                    rest = ranked[self.k:]
                    left = rest[line[rest] >= max(self.floor(item), 1e-9)]
                self.take(item, block, left, rows, norm)
                self.excluded += len(line)
            rows.clear()


class _Rows(dict):
    """Counts per document of one term, made when asked for."""

    def __init__(self, spans, place, count, docs):
        super().__init__()
        self.spans, self.place, self.count, self.docs = spans, place, count, docs

    def __contains__(self, term):
        return term in self.spans

    def __missing__(self, term):
        out = np.zeros(self.docs, np.int64)
        at = self.spans[term]
        out[self.place[at]] = self.count[at]
        if len(self) < TERMS:
            self[term] = out
        return out


def _bits_for(entries: int) -> int:
    return 1 << max(7, (entries * BITS - 1).bit_length())


def search_block(docs: DataFrame, queries: Queries, k: int = K, floors: list[int] | None = None) -> DataFrame:
    """query, doc_id, score: at most k rows per query and task, none below
    the query's ``floors``."""

    def run(batches):
        search, open_blocks, hashed = Search(queries, k, floors), {}, Memo(_hash, 200_000)
        numbers = queries.terms
        known = frozenset(numbers)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                counts = Counter(words)
                entries = [hashed[t, level] for level in LEVELS
                           for t, tf in counts.items() if tf >= level]
                bits = _bits_for(len(entries))
                block = open_blocks.setdefault(bits, Block(bits))
                block.add(NO_ID if doc_id is None else doc_id, len(words), max(counts.values()),
                          {numbers[t]: counts[t] for t in known.intersection(counts)}, entries)
                if block.full():
                    search.scan(block)
                    open_blocks[bits] = Block(bits)
        for block in open_blocks.values():
            search.scan(block)
        rows = [(i, None if d == NO_ID else d, -s) for i, best in enumerate(search.best) for s, d in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["query", "doc_id", "score"])

    return _text_schema(docs).mapInArrow(run, "query long, doc_id long, score long")


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, query_block: int = QUERY_BLOCK,
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item.
    ``docs`` has doc_id and text, ``items`` item_id and text."""
    spark = docs.sparkSession
    ship(spark)
    id_type = items.schema["item_id"].dataType
    single = scratch_table(spark, items.where("text is not null").select(
        "item_id", F.col("text").cast("string").alias("text")).distinct(), "search-items")
    size = single.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size.n // query_block), -(-(size.bytes or 0) // query_bytes))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    schema = T.StructType([T.StructField("item_id", id_type)] + T._parse_datatype_string(
        "rank int, doc_id long, score long").fields)
    out = None
    for b in range(blocks):
        rows = single.where(block_of == b).collect()  # about query_block items
        terms: dict[bytes, int] = {}
        wanted = [sorted({terms.setdefault(t, len(terms)) for t in terms_of(r.text)}) for r in rows]
        queries = count_terms(docs, Queries(terms, wanted)) if terms else None
        if queries is None or not queries.docs:
            continue
        floors = [0] * len(rows)
        seeds = docs.select("doc_id", "text").limit(SEED_DOCS).repartition(SEED_PARTS)
        for r in _best(search_block(seeds, queries, k), k).where(F.col("rank") == k).collect():
            floors[r["query"]] = r["score"]  # one row per query of the block
        top = _best(search_block(docs, queries, k, floors), k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], T.StructType(
            [T.StructField("query", T.LongType()), T.StructField("item_id", id_type)]))
        hits = scratch_table(spark, top.join(names, "query").select(
            "item_id", "rank", "doc_id", "score"), "search-hits")
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else spark.createDataFrame([], schema)
