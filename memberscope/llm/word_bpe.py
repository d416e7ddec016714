"""BPE encoding and decoding (operator 8): forced-boundary splitting.

A pair of adjacent bytes that occurs inside no vocabulary token can never be
merged over, so every such pair marks a certain cut. A word is cut there, the
fragments are encoded independently (heap merging; words are cached per worker), and
their ids are concatenated; only the last fragment carries the end-of-word
suffix. Before that, as the vocabulary file prescribes: special strings are
taken out of the raw text, the rest is put in NFC, white space separates
words, words are lower-cased character by character and split by the file's
pattern; chunks with characters on which Unicode versions differ go through
the library's own normaliser and splitter. The file has no decoder, so
decoding joins token strings by a space.

Edge cases: a null or empty text has no tokens (hashes of zero bytes); a text
of white space only likewise; special strings inside texts become their ids;
repeated rows and null ids give one row each; an empty table gives no rows;
only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import struct
from functools import cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from memberscope.llm import bpe
from memberscope.llm.common import Memo, ship, text_or_empty

#: The word pattern of the vocabulary file (fixed value).
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
SPACES = regex.compile(r"\p{White_Space}+")
#: ``str.split`` also cuts at these, which are no white space in the pattern.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class WordBpe:
    """Encoder and decoder of one vocabulary; values are pairs (ids as
    little-endian 32-bit integers, token strings joined by a space)."""

    def __init__(self, path: str, limit: int = 400_000):
        self.vocab = bpe.vocabulary(path)
        self.strings = {i: t for t, i in self.vocab.ids.items()}
        self.strings |= {i: s for s, i in self.vocab.specials.items()}
        self.inside = self._pairs_inside_tokens()
        self.words = Memo(self._word, limit)
        self.library = bpe.library(path)
        self.chunks = Memo(self._chunk, limit)

    def _pairs_inside_tokens(self) -> set[str]:
        suffix = self.vocab.suffix
        bare = (t.removesuffix(suffix) for t in self.vocab.ids)
        return {t[i:i + 2] for t in bare for i in range(len(t) - 1)}

    def cut(self, word: str) -> list[str]:
        """The word's byte symbols, cut between bytes that no token holds
        side by side."""
        inside, start, out = self.inside, 0, []
        for i in range(len(word) - 1):
            if word[i:i + 2] not in inside:
                out.append(word[start:i + 1])
                start = i + 1
        out.append(word[start:])
        return out

    def _fragment(self, fragment: str, last: bool) -> list[int]:
        parts = list(fragment)
        if last:
            parts[-1] += self.vocab.suffix
        merged, _ = bpe.merge_by_heap(parts, self.vocab.ranks)
        return [self.vocab.ids[s] for s in merged]

    def _word(self, word: str) -> list[int]:
        return self._symbols(bpe.symbols(word))

    def _symbols(self, word: str) -> list[int]:
        *head, tail = self.cut(word)
        ids = [i for f in head for i in self._fragment(f, False)]
        return ids + self._fragment(tail, True)

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        if not chunk.isascii() and not bpe.PLAIN.fullmatch(chunk):  # Unicode versions differ: the library's counts
            shown = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
            return self._value([i for w, _ in shown for i in self._symbols(w)])
        low = chunk.lower()
        if low.isalpha():  # one word
            return self._value(self.words[low])
        return self._value([i for w in WORDS.findall(low) for i in self.words[w]])

    def _value(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), " ".join([self.strings[i] for i in ids])

    def __call__(self, text: str) -> tuple[bytes, str]:
        values = []
        for k, part in enumerate(self.vocab.segments(text)):
            if k % 2:
                values.append(self._value([self.vocab.specials[part]]))
            elif any(s in part for s in SEPARATORS):
                values += [self.chunks[c] for c in SPACES.split(part) if c]
            else:
                values += map(self.chunks.__getitem__, part.split())
        return b"".join([v[0] for v in values]), " ".join([v[1] for v in values])

    def decode(self, ids) -> str:
        return " ".join([self.strings[int(i)] for i in ids])


@cache
def codec(path: str) -> WordBpe:
    return WordBpe(path)


def _path(vocab: str | None) -> str:
    return vocab or public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """doc_id, ids (binary, little-endian 32-bit), decoded text per row."""
    ship(docs.sparkSession)

    def run(batches):
        code = codec(_path(vocab))
        for batch in batches:
            pairs = [code(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p[0] for p in pairs], pa.binary()),
                 pa.array([p[1] for p in pairs], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, ids binary, decoded string")


def encode_digest(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row. The hashes are
    taken in the workers, so ids and decoded texts do not travel back."""
    ship(docs.sparkSession)

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches):
        code = codec(_path(vocab))
        for batch in batches:
            n, ids, decoded = [], [], []
            for t in batch.column(1).to_pylist():
                packed, text = code(t)
                n.append(len(packed) // 4)
                ids.append(sha(packed))
                decoded.append(sha(text.encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
