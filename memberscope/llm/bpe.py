"""Byte-level BPE vocabularies (``tokenizers`` JSON files) and the splitting
of texts into cached chunks.

A text's pieces never span the start of a single space between two
non-space characters, so a text is cut there and every distinct chunk is
worked out once per worker. Texts with any other spacing (runs of white
space next to a space, a leading or trailing space) take the plain pattern.
"""

from __future__ import annotations

import heapq
import json
from functools import cache

import public_tokenizers
import regex
from tokenizers import Tokenizer

from memberscope.llm.common import Memo


class Vocabulary:
    """Ranks, ids and special strings of one vocabulary file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")"
        ) if self.specials else None

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings; odd positions are the specials."""
        if self.special_split is None or not any(s in text for s in self.specials):
            return [text]
        return self.special_split.split(text)


@cache
def vocabulary(path: str) -> Vocabulary:
    """One copy per worker process."""
    return Vocabulary(path)


@cache
def library(path: str) -> Tokenizer:
    """The library's tokenizer of the file, one per worker process."""
    return Tokenizer.from_file(path)


@cache
def byte_symbols() -> tuple[str, ...]:
    """The printable character that stands for each byte: printable Latin-1
    bytes stand for themselves, the others are numbered from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return tuple(chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256))


@cache
def _translation() -> dict[int, str]:
    return dict(enumerate(byte_symbols()))


def symbols(piece: str) -> str:
    """The piece's UTF-8 bytes as one symbol character each."""
    return piece.encode("utf-8").decode("latin-1").translate(_translation())


def merge_by_heap(parts: list[str], ranks: dict[tuple[str, str], int]) -> tuple[list[str], int]:
    """Byte-pair merging with a heap of adjacent pairs over a doubly linked
    list: pop the lowest rank (leftmost on ties), merge, push the two new
    neighbours. Stale heap entries are recognised by their rank. Returns the
    final symbols and the number of merges."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive: list[str | None] = list(parts)
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        left, j = alive[i], after[i]
        if left is None or j >= n or ranks.get((left, alive[j])) != rank:
            continue
        joined = left + alive[j]
        alive[i], alive[j] = joined, None
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((joined, alive[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((alive[h], joined))) is not None:
            heapq.heappush(heap, (r, h))
    return [s for s in alive if s is not None], merges


#: The pattern of the byte-level vocabularies, with white space spelled out.
PIECES = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
                       .replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


#: Letters, digits and marks on whose class every Unicode version agrees:
#: ASCII, Latin, Cyrillic, kana, ideographs and Hangul syllables. A text with
#: any other character is split by the library itself.
AGREED = r"\x21-\x7E\xA1-\xAC\xAE-\u01BA\u0400-\u045F\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3"
PLAIN = regex.compile(f"[{AGREED}]*+")
PLAIN_TEXT = regex.compile(rf"[{AGREED}\x20\t\n\r]*+")


class _Spacing(Exception):
    """A chunk with white space at an end: the cut at spaces is not valid."""


class ChunkedPieces:
    """Values of a text's chunks, ``combine``d from ``of_piece`` of their
    pieces, in order. ``special(string)`` gives the value of a special
    string."""

    def __init__(self, vocab: Vocabulary, of_piece, combine, special, limit: int = 250_000):
        self.vocab, self.combine, self.special = vocab, combine, special
        self.pieces = Memo(of_piece, limit)
        self.chunks = Memo(self._chunk, limit)

    def _chunk(self, chunk: str):
        if not chunk.isascii() and not PLAIN.fullmatch(chunk):
            if chunk[0].isspace() or chunk[-1].isspace():
                raise _Spacing
            return self._plain(" " + chunk)
        word = chunk.rstrip(",.;:!?")
        if word.isalpha():  # the pattern's commonest case: a word, then marks
            if len(word) == len(chunk):
                return self.pieces[" " + chunk]
            return self.combine((self.pieces[" " + word], self.pieces[chunk[len(word):]]))
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Spacing
        return self.combine(map(self.pieces.__getitem__, PIECES.findall(" " + chunk)))

    def _plain(self, text: str):
        if not text.isascii() and not PLAIN_TEXT.fullmatch(text):
            found = library(self.vocab.path).pre_tokenizer.pre_tokenize_str(text)
            return self.combine([self.pieces[text[a:b]] for _, (a, b) in found])
        return self.combine(map(self.pieces.__getitem__, PIECES.findall(text)))

    def _segment(self, text: str):
        first, *rest = text.split(" ")
        try:
            if rest and (not first or first[-1].isspace()):
                raise _Spacing
            return self.combine([self._plain(first), *map(self.chunks.__getitem__, rest)])
        except _Spacing:
            return self._plain(text)

    def __call__(self, text: str):
        segments = self.vocab.segments(text)
        if len(segments) == 1:
            return self._segment(text)
        return self.combine([self.special(s) if k % 2 else self._segment(s)
                             for k, s in enumerate(segments) if s])
