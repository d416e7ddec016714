"""Token ids of whole texts by the ``tokenizers`` library, chunk by chunk.

The library's model encodes each distinct piece while it is in the worker's
cache; a document's ids are the concatenation of its chunks' packed ids (two
bytes each where the vocabulary allows), which keeps caches and files small.
"""

from __future__ import annotations

from array import array
from functools import cache

import numpy as np
from tokenizers import Tokenizer

from memberscope.llm import bpe


def id_dtype(path: str) -> str:
    vocab = bpe.vocabulary(path)
    top = max([*vocab.ids.values(), *vocab.specials.values()])
    return "<u2" if top < 1 << 16 else "<u4"


@cache
def encoder(path: str):
    """``text -> packed ids (bytes)`` for this worker."""
    vocab, library = bpe.vocabulary(path), Tokenizer.from_file(path).model
    code = "H" if id_dtype(path) == "<u2" else "I"

    def ids_of(piece: str) -> bytes:
        return array(code, [t.id for t in library.tokenize(bpe.symbols(piece))]).tobytes()

    return bpe.ChunkedPieces(vocab, ids_of, b"".join,
                             lambda s: array(code, [vocab.specials[s]]).tobytes())


def with_end(packed: bytes, dtype: str, end: int) -> np.ndarray:
    """Ids of one document with the end id appended."""
    return np.append(np.frombuffer(packed, dtype), np.array([end], dtype))
