"""Exact top-k inner products (operator 2): norm-sorted search with
SVD-rotated partial sums and Cauchy-Schwarz residual bounds.

Components are turned into integers floor(scale * x). One distributed pass
sums the d x d Gram matrix of all vectors; its eigenvectors (the right
singular vectors of the table) rotate vectors so that the first coordinates
carry most of the length. Queries are worked through in bounded blocks: a
block (about ``query_block`` vectors) is sent to the tasks and
every task scans its own candidates by descending length, in slices:

* a query whose own length times the slice's greatest length lies below its
  k-th best score is finished in this task (Cauchy-Schwarz; all later
  candidates are shorter);
* for the others the rotated leading coordinates give a partial sum, and
  partial + |query rest| * |candidate rest| bounds the score; only candidates
  that reach the k-th best are scored, in exact integer arithmetic.

Thresholds start from the longest vectors of the table (``seed_rows``, a
bound), which Spark scores first, so tasks prune from their first slice. Each
task returns at most k rows per query, and a window over those picks the
final k. A block's hits are a written table, so the driver holds one block of
queries at a time. Bounds are widened by a rounding allowance; every score is
exact, so results do not depend on the pruning.

Edge cases: null vectors, vectors with a null or non-finite component, and
rows without vec_id take no part; an empty vector scores 0 with every other;
vectors of other lengths are compared over the longest dimension, missing
components counting 0; rows that repeat a vec_id are queries and candidates
of their own (also for each other); equal scores go to the smaller vec_id;
with fewer than k candidates all are returned; an empty table gives no rows.
Integer sums must fit 63 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from memberscope.llm.common import scratch_table, ship

HITS = "query long, query_id long, vec_id long, score long"
QUERY_BLOCK = 16_384
SEED_ROWS = 2_048
SEED_PARTS = 8
SLICE = 2_048
#: Sums of products below this are exact in double arithmetic.
EXACT = float(1 << 53)


def integer_vectors(table: DataFrame, scale: int = 256, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of integers), row (a number of its own), sq (squared
    length) of usable rows."""
    x = F.col("x")
    usable = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall(
        "x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vec_col).cast("array<double>").alias("x"))
            .where(usable)
            .select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("sq", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)))


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as int64, padded to ``dim``."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def gram(vectors: DataFrame, dim: int) -> np.ndarray:
    """Sum of outer products over all vectors: one d x d matrix per task,
    added up by Spark row by row of the matrix."""

    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            m = _matrix(batch.column(0), dim).astype(float)
            total += m.T @ m
        for i in range(dim):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * dim), pa.array(range(dim)), pa.array(total[i])],
                names=["i", "j", "x"])

    sums = vectors.select("v").mapInArrow(run, "i long, j long, x double").groupBy("i", "j").agg(
        F.sum("x").alias("x")).collect()  # d * d rows
    out = np.zeros((dim, dim))
    for r in sums:
        out[r.i, r.j] = r.x
    return out


def rotation(g: np.ndarray) -> tuple[np.ndarray, int]:
    """Eigenvectors by falling eigenvalue, and how many leading coordinates
    hold 80 per cent of the squared lengths (at least an eighth of them)."""
    values, vectors = np.linalg.eigh(g)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    head = int(np.searchsorted(share, 0.8)) + 1
    return np.ascontiguousarray(vectors), min(max(head, len(g) // 8, 1), len(g))


class BlockSearch:
    """Best k of the candidates seen so far for each query of one block."""

    def __init__(self, block, rotated, head, floor, k):
        self.rows, self.ids, queries = block
        self.q, self.head, self.k = queries, head, k
        self.rq = queries.astype(float) @ rotated
        self.rotated = rotated
        self.norm = np.sqrt((self.rq ** 2).sum(1))
        self.rest = np.sqrt((self.rq[:, head:] ** 2).sum(1))
        self.score = np.full((len(self.ids), k), np.iinfo(np.int64).min)
        self.who = np.full((len(self.ids), k), np.iinfo(np.int64).max)
        self.floor = floor

    def threshold(self) -> np.ndarray:
        worst = self.score[:, -1]
        return np.where(worst > np.iinfo(np.int64).min, np.maximum(worst, self.floor), self.floor)

    def exact(self, rows: np.ndarray, cands: np.ndarray) -> np.ndarray:
        """Integer scores of queries x candidates."""
        q = self.q[rows]
        peak = float(np.abs(q).max(initial=0)) * float(np.abs(cands).max(initial=0)) * q.shape[1]
        if peak < EXACT:
            return (q.astype(float) @ cands.T.astype(float)).astype(np.int64)
        return q @ cands.T

    def scan(self, numbers: np.ndarray, vec_ids: np.ndarray, cands: np.ndarray, norms: np.ndarray) -> None:
        """One slice of candidates, longest first."""
        limit = self.threshold()
        active = np.flatnonzero(self.norm * norms[0] * (1 + 1e-9) + 1e-6 >= limit)
        if not len(active):
            return
        rc = cands.astype(float) @ self.rotated
        rest = np.sqrt((rc[:, self.head:] ** 2).sum(1))
        for at in range(0, len(active), 1024):
            rows = active[at:at + 1024]
            bound = self.rq[rows, :self.head] @ rc[:, :self.head].T
            bound += np.outer(self.rest[rows], rest)
            slack = self.norm[rows, None] * norms[0] * 1e-9 + 1e-6
            reach = bound + slack >= limit[rows, None]
            cols = np.flatnonzero(reach.any(0))
            if len(cols):
                self._merge(rows, numbers[cols], vec_ids[cols], self.exact(rows, cands[cols]), reach[:, cols])

    def _merge(self, rows, numbers, vec_ids, scores, reach) -> None:
        low = np.iinfo(np.int64).min
        own = self.rows[rows][:, None] == numbers[None, :]
        scores = np.where(reach & ~own, scores, low)
        hit = np.flatnonzero((scores >= self.threshold()[rows][:, None]).any(1))
        if not len(hit):
            return
        rows = rows[hit]
        s = np.concatenate([self.score[rows], scores[hit]], 1)
        w = np.concatenate([self.who[rows], np.broadcast_to(vec_ids, (len(hit), len(vec_ids)))], 1)
        w = np.where(s == low, np.iinfo(np.int64).max, w)
        order = np.lexsort((w, -s.astype(float)), axis=1)[:, :self.k] if np.abs(s[s > low]).max(
            initial=0) < EXACT else np.array([sorted(range(s.shape[1]), key=lambda c: (
                -int(s[i, c]), int(w[i, c])))[:self.k] for i in range(len(rows))])
        self.score[rows] = np.take_along_axis(s, order, 1)
        self.who[rows] = np.take_along_axis(w, order, 1)

    def hits(self):
        i, c = np.nonzero((self.score > np.iinfo(np.int64).min)
                          & (self.score >= self.floor[:, None]))
        return self.rows[i], self.ids[i], self.who[i, c], self.score[i, c]


def _search_block(vectors: DataFrame, block, rotated, head, floor, k, dim) -> DataFrame:
    def run(batches):
        search = BlockSearch(block, rotated, head, floor, k)
        for batch in batches:  # in falling order of length within the partition
            m, row, vec = _matrix(batch.column(2), dim), batch.column(0).to_numpy(), batch.column(1).to_numpy()
            norms = np.sqrt(batch.column(3).to_numpy())
            for at in range(0, len(vec), SLICE):
                part = slice(at, at + SLICE)
                search.scan(row[part], vec[part], m[part], norms[part])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in search.hits()],
                                         names=["query", "query_id", "vec_id", "score"])

    return vectors.select("row", "vec_id", "v", "sq").mapInArrow(run, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def topk_inner_products(table: DataFrame, k: int = 5, every: int = 50, scale: int = 256,
                        query_block: int = QUERY_BLOCK, id_col: str = "vec_id",
                        vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by
    ``every``, against every other row."""
    spark = table.sparkSession
    ship(spark)
    vectors = scratch_table(spark, integer_vectors(table, scale, id_col, vec_col)
                            .sortWithinPartitions(F.desc("sq")), "topk-vectors")
    is_query = F.col("vec_id") % every == 0
    found = vectors.agg(F.max(F.size("v")).alias("d"), F.count_if(is_query).alias("n")).first()
    if not found.n or found.d is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(found.d, 1)
    rotated, head = rotation(gram(vectors, dim))
    seeds = scratch_table(spark, vectors.orderBy(F.desc("sq"), "row").limit(SEED_ROWS), "topk-seeds")
    seeds = seeds.repartition(SEED_PARTS, "row").sortWithinPartitions(F.desc("sq"))
    blocks = -(-found.n // query_block)
    block_of = F.pmod(F.xxhash64("row"), F.lit(blocks))
    # scans read files of sorted rows; sorting again keeps the order whatever
    # way the reader splits or joins files
    candidates = vectors.sortWithinPartitions(F.desc("sq"))
    hits = None
    for b in range(blocks):
        rows = vectors.where(is_query & (block_of == b)).select("row", "vec_id", "v").collect()
        if not rows:
            continue
        queries = np.zeros((len(rows), dim), np.int64)
        for i, r in enumerate(rows):
            queries[i, :len(r.v)] = r.v
        block = np.array([r.row for r in rows]), np.array([r.vec_id for r in rows]), queries
        place = {r.row: i for i, r in enumerate(rows)}
        del rows
        floor = np.full(len(queries), float(np.iinfo(np.int64).min))
        first = _search_block(seeds, block, rotated, head, floor, k, dim)
        for r in _best(first, k).where(F.col("rank") == k).select("query", "score").collect():
            # one row per query of the block; doubles round, so a step below
            floor[place[r.query]] = np.nextafter(float(r.score), -np.inf)
        part = scratch_table(spark, _best(_search_block(
            candidates, block, rotated, head, floor, k, dim), k), "topk-hits")
        hits = part if hits is None else hits.unionByName(part)
    return hits.select("query_id", "rank", "vec_id", "score")
