"""Token counts (operator 3): heap-and-linked-list byte-pair merging.

The count of a piece is its number of byte symbols minus the merges made by
repeatedly popping the lowest-ranked adjacent pair; no identifier is ever
looked up. Counts of distinct chunks are cached per worker (bounded), and a
document costs one dictionary lookup per chunk. One narrow pass: no shuffle.

Edge cases: a null or empty text has 0 bytes and 0 tokens; a special string
of the vocabulary inside a text counts as one token (the library's default);
rows are independent, so repeated rows, null ids and any order give one row
each; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from memberscope.llm import bpe
from memberscope.llm.common import ship, text_or_empty

LIMIT = 512


@cache
def counter(path: str) -> bpe.ChunkedPieces:
    vocab = bpe.vocabulary(path)

    def count(piece: str) -> int:
        start = list(bpe.symbols(piece))
        return len(start) - bpe.merge_by_heap(start, vocab.ranks)[1]

    return bpe.ChunkedPieces(vocab, count, sum, lambda s: 1)


def token_counts(docs: DataFrame, limit: int = LIMIT, vocab: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) per row."""
    ship(docs.sparkSession)

    def run(batches):
        count = counter(vocab or public_tokenizers.path("byte_bpe_50k.json"))  # where the worker has it
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
