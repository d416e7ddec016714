"""PII (operator 13): a semi-Markov conditional random field over spans.

*Base.* Four patterns (e-mail, IP, card, phone) mark spans that always stay.

*Candidates.* Around digits, and around written-out e-mail addresses, a text
has regions of atoms (words, digit groups, marks). Every run of at most
``MAX_ATOMS`` atoms in a region that may be an entity at all is a candidate
segment; base spans are fixed segments, and no candidate overlaps one.

*Model.* A labelling of a region is a sequence of segments: an entity of one
of the four kinds, or a single atom outside. Its score is the sum of its
segments' weights, over features of the whole span (digit count, group
shape, separators, check digit, neighbours, cue words) and of the step from
the segment before. Training maximises the conditional likelihood of whole
segmentations (forward-backward over bounded segments, Adam); decoding takes
the best segmentation by dynamic programming, which chooses boundaries and
kinds jointly. Both cost atoms x MAX_ATOMS x kinds, whatever the region.

The default training rows come from templates (``labelled_texts``: at most
``TRAIN_ROWS``, seeded); users pass a table of their own (text, spans), of
which at most ``TRAIN_ROWS`` are read. A number that would have to be a card
but fails its check digit is never a candidate for one, which is knowledge
about cards, not a threshold.

Edge cases: null and empty texts have no spans; repeated rows and null ids
give a row each; a text may be of any length (regions are decoded one after
the other); an empty table gives no rows; only ``doc_id`` and ``text`` are
read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberscope.llm.common import ship, text_or_empty

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 32
MAX_CHARS = 64
TRAIN_ROWS = 2_000
NEAR = 32

# ---------------------------------------------------------------- base

#: The base patterns. A number starts where no digit stands before it, and
#: its digits are taken whole, which finds the same matches in linear time.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, in KINDS order."""
    out = _emails(text)
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40 and 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---------------------------------------------------------------- regions

ATOMS = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.S)
#: Digit groups with marks between, at least seven digits or marks long.
NUMBERS = re.compile(r"(?<![A-Za-z0-9_])[+(]{0,2}[0-9](?:[\x20\xa0().+/_:-]{0,3}[0-9])*+(?![A-Za-z0-9_])")
AT = r"(?:\s?[\[({]\s?at\s?[\])}]\s?|\sat\s|\s?@\s?)"
DOT = r"(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\.)"
PART = r"[A-Za-z0-9_%+-]{1,40}"
WRITTEN = re.compile(rf"(?i)(?<![A-Za-z0-9_%+-])(?:{PART}{DOT}){{0,3}}+{PART}{AT}{PART}(?:{DOT}{PART}){{1,4}}")
HAS_AT = re.compile(r"(?i)[\[({]\s?at\s?[\])}]|\sat\s.{1,100}[\s\[({]dot[\s\])}]|\s@|@\s|[\[({]\s?dot\s?[\])}]", re.S)

ENDINGS = frozenset(("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu", "co", "us"))
#: Words around a span that speak for or against a kind (fixed values).
CUES = {
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp", "telefon", "tél", "dial"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "tarjeta", "carte"),
    "ip": ("ip", "host", "server", "address", "ping", "subnet", "gateway"),
    "email": ("mail", "email", "contact", "write", "reach", "correo"),
    "other": ("order", "invoice", "isbn", "version", "ref", "id", "date", "on", "page", "price", "total", "no",
              "number", "serial", "article", "chapter", "section", "sku", "ticket", "score"),
}
CUE_OF = {w: k for k, words in CUES.items() for w in words}
WORD = re.compile(r"[^\W\d_]+")
DATE = re.compile(r"\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2(?:\d{4}|\d{2})")


class Segment(NamedTuple):
    """Atoms [first, last) of a region as one entity; ``kinds`` it may have."""

    first: int
    last: int
    kinds: tuple[int, ...]
    features: tuple[str, ...]


class Region(NamedTuple):
    start: int
    cuts: tuple[int, ...]  # character offsets of the atoms, and the end
    segments: tuple[Segment, ...]


def _cues(before: str, after: str) -> list[str]:
    near = [CUE_OF.get(w.lower()) for w in WORD.findall(before)[-3:]]
    out = [f"cue:{c}" for c in dict.fromkeys(near) if c]
    out += [f"cue after:{c}" for w in WORD.findall(after)[:1] if (c := CUE_OF.get(w.lower()))]
    return out or ["no cue"]


def _bucket(n: int) -> str:
    return str(n) if n <= 12 else "13-15" if n <= 15 else "16-19" if n <= 19 else "20+"


def _number_features(s: str, left: str, right: str, cues: list[str]) -> list[str]:
    groups = re.findall("[0-9]+", s)
    digits = "".join(groups)
    marks = "".join(sorted({c for c in s if not "0" <= c <= "9"}))
    shape = "-".join(str(len(g)) for g in groups)
    known = shape in ("3-3-4", "1-3-3-4", "3-4", "2-2-2-2-2", "4-4-4-4", "4-6-5", "4-4-4-4-3")
    out = [f"digits {_bucket(len(digits))}", f"marks {marks or 'none'}", "shape " + (
        shape if known else "one" if len(groups) == 1 else "many"), *cues,
        *(f"{c}, {len(groups) > 1}" for c in cues)]
    if s[0] == "+":
        out.append("plus")
    elif s[0] == "0":
        out.append("zero")
    if s.count("(") != s.count(")"):
        out.append("open bracket")
    elif "(" in s:
        out.append("brackets")
    if len(digits) >= 13:
        out.append(f"luhn {luhn(digits)}")
        out.append(f"first {digits[0]}")
    if len(groups) == 4 and re.fullmatch(r"[0-9.]+", s):
        out.append(f"octets {all(int(g) < 256 for g in groups if len(g) < 4) and max(map(len, groups)) < 4}")
    if DATE.fullmatch(s):
        out.append("date")
    if re.fullmatch(r"[0-9]+\.[0-9]+", s):
        out.append("decimal")
    out += ["more left"] * bool(re.search(r"[0-9)][\x20\xa0().+/_:-]{0,3}$", left))
    out += ["more right"] * bool(re.match(r"[\x20\xa0().+/_:-]{0,3}[0-9]", right))
    out += ["opened left"] * (left[-1:] in "(+" and bool(left))
    return out


def _written_features(s: str, left: str, right: str, cues: list[str]) -> list[str]:
    at = re.search(rf"(?i){AT}", s)
    local, domain = s[:at.start()], s[at.end():]
    parts = re.split(rf"(?i){DOT}", domain)
    word = at.group().strip(" ")
    out = ["at " + ("bracket" if word[0] in "[({" else "word" if word.isalpha() else "sign"), *cues,
           f"written dots {bool(re.search('(?i)dot', domain))}", f"parts {min(len(parts), 4)}",
           f"known ending {parts[-1].lower() in ENDINGS}", f"letters {parts[-1].isalpha()}"]
    out += ["more left"] * bool(re.search(rf"(?i){PART}{DOT}$", left))
    out += ["more right"] * bool(re.match(rf"(?i){DOT}{PART}", right))
    out += ["short local"] * (len(local) < 3)
    return out


def _region(text: str, start: int, end: int, written: bool, fixed: list[Span]) -> Region:
    """The region's atoms and candidate segments."""
    cuts = [m.start() for m in ATOMS.finditer(text, start, end)] + [end]
    n = len(cuts) - 1
    segments = []
    for i in range(n):
        first = text[cuts[i]]
        if not (first.isalnum() or first in "+("):
            continue
        for j in range(i + 1, min(n, i + MAX_ATOMS) + 1):
            a, b = cuts[i], cuts[j]
            if b - a > MAX_CHARS:
                break
            if not text[b - 1].isalnum() or any(s < b and a < e for _, s, e in fixed):
                continue
            s = text[a:b]
            left, right = text[max(start, a - NEAR, 0):a], text[b:b + NEAR]
            if written:
                if not WRITTEN.fullmatch(s):
                    continue
                kinds = (0,)
                found = _written_features(s, left, right, _cues(text[max(0, a - NEAR):a], right))
            else:
                count = sum("0" <= c <= "9" for c in s)
                if not 7 <= count <= 19 or not text[b - 1].isdigit():
                    continue
                # a card has a valid check digit, an address four octets
                digits = digits_of(s)
                kinds = ((1,) if re.fullmatch(r"[0-9]{1,3}(?:[.\x20]{1,3}[0-9]{1,3}){3}", s) else ()) + (
                    (2,) if count >= 13 and luhn(digits) else ()) + ((3,) if count <= 15 else ())
                if not kinds:
                    continue
                found = _number_features(s, left, right, _cues(text[max(0, a - NEAR):a], right))
            segments.append(Segment(i, j, kinds, tuple(found)))
    return Region(start, tuple(cuts), tuple(segments))


def regions(text: str, fixed: list[Span]) -> list[Region]:
    out = []
    for m in NUMBERS.finditer(text):
        if m.end() - m.start() >= 7:
            out.append(_region(text, *m.span(), False, fixed))
    if HAS_AT.search(text):
        out += [_region(text, *m.span(), True, fixed) for m in WRITTEN.finditer(text)]
    return [r for r in out if r.segments]


# ---------------------------------------------------------------- model

#: Steps: the segment before this entity was outside, or an entity; the
#: entity opens the region.
STEPS = 3
OUTSIDE, ENTITY, OPENS = range(STEPS)


class Model(NamedTuple):
    """Weight per (feature, kind), and per step."""

    names: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def scores(self, segment: Segment) -> list[tuple[int, float]]:
        rows = [self.names[f] for f in segment.features if f in self.names]
        return [(k, float(self.weights[rows, k].sum())) for k in segment.kinds]


def best_segmentation(n: int, scored: list[tuple[int, int, int, float]], steps) -> list[tuple[int, int, int]]:
    """The entities (first, last, kind) of the best segmentation of ``n``
    atoms; ``scored`` holds (first, last, kind, score)."""
    by_end: list[list] = [[] for _ in range(n + 1)]
    for first, last, kind, score in scored:
        by_end[last].append((first, kind, score))
    low = -math.inf
    # best score at each cut when the last segment is outside or an entity
    best = [[low, low] for _ in range(n + 1)]
    back: list[list] = [[None, None] for _ in range(n + 1)]
    best[0] = [0.0, low]
    for j in range(1, n + 1):
        was = best[j - 1]
        came = 0 if was[0] >= was[1] else 1
        best[j][0], back[j][0] = was[came], (j - 1, came, None)
        for first, kind, score in by_end[j]:
            for came in (0, 1):
                step = steps[ENTITY if came else OPENS if first == 0 else OUTSIDE]
                total = best[first][came] + score + step
                if total > best[j][1]:
                    best[j][1], back[j][1] = total, (first, came, kind)
    out, j, at = [], n, 0 if best[n][0] >= best[n][1] else 1
    while j:
        first, came, kind = back[j][at]
        if kind is not None:
            out.append((first, j, kind))
        j, at = first, came
    return out[::-1]


def added_spans(text: str, fixed: list[Span], model: Model) -> list[Span]:
    """What the field finds beside the base spans."""
    out: list[Span] = []
    for r in regions(text, fixed):
        scored = [(s.first, s.last, k, score) for s in r.segments for k, score in model.scores(s)]
        for first, last, kind in best_segmentation(len(r.cuts) - 1, scored, model.steps):
            a, b = r.cuts[first], r.cuts[last]
            if not any(s < b and a < e for _, s, e in out):  # regions of two sorts may meet
                out.append((KINDS[kind], a, b))
    return out


def _log_sum(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def segment_marginals(n: int, scored, steps) -> tuple[float, list[float], list[float]]:
    """log Z, each scored segment's probability, and expected step counts, by
    forward-backward over cuts (states: last segment outside, entity)."""
    low = -math.inf
    ahead = [[low, low] for _ in range(n + 1)]
    behind = [[low, low] for _ in range(n + 1)]
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for x, (first, last, _, _) in enumerate(scored):
        by_end[last].append(x)
        by_start[first].append(x)
    ahead[0][0] = 0.0
    opens = lambda first, came: steps[ENTITY if came else OPENS if first == 0 else OUTSIDE]
    for j in range(1, n + 1):
        ahead[j][0] = _log_sum(*ahead[j - 1])
        for x in by_end[j]:
            first, _, _, score = scored[x]
            for came in (0, 1):
                ahead[j][1] = _log_sum(ahead[j][1], ahead[first][came] + score + opens(first, came))
    behind[n] = [0.0, 0.0]
    for i in range(n - 1, -1, -1):
        for came in (0, 1):
            total = behind[i + 1][0]
            for x in by_start[i]:
                total = _log_sum(total, scored[x][3] + opens(i, came) + behind[scored[x][1]][1])
            behind[i][came] = total
    z = behind[0][0]
    chance, used = [], [0.0] * STEPS
    for first, last, _, score in scored:
        p = 0.0
        for came in (0, 1):
            part = math.exp(min(0.0, ahead[first][came] + score + opens(first, came) + behind[last][1] - z))
            used[ENTITY if came else OPENS if first == 0 else OUTSIDE] += part
            p += part
        chance.append(p)
    return z, chance, used


def fit(rows: list[tuple[str, list[Span]]], rounds: int = 40, rate: float = 0.25, l2: float = 0.02) -> Model:
    """Conditional maximum likelihood over the rows' regions. Spans that are
    base spans anyway are no targets."""
    names: dict[str, int] = {}
    cases, entries = [], []  # regions as (n, [(entry, first, last, kind)], gold entries, gold steps)
    for text, spans in rows:
        fixed = base_spans(text)
        wanted = {(a, b): KINDS.index(k) for k, a, b in spans if (k, a, b) not in fixed}
        for r in regions(text, fixed):
            scored, gold = [], []
            for s in r.segments:
                ids = [names.setdefault(f, len(names)) for f in s.features]
                for k in s.kinds:
                    if wanted.get((r.cuts[s.first], r.cuts[s.last])) == k:
                        gold.append((s.first, s.last, len(entries)))
                    scored.append((len(entries), s.first, s.last, k))
                    entries.append((ids, k))
            gold.sort()
            ends = {last for _, last, _ in gold}
            steps = [0.0] * STEPS
            for first, _, _ in gold:
                steps[ENTITY if first in ends else OPENS if first == 0 else OUTSIDE] += 1
            cases.append((len(r.cuts) - 1, scored, [x for _, _, x in gold], steps))
    size = len(names) * len(KINDS)
    row = np.repeat(np.arange(len(entries)), [len(ids) for ids, _ in entries])
    col = np.array([f * len(KINDS) + k for ids, k in entries for f in ids], np.int64)
    w, mean, spread = (np.zeros(size + STEPS) for _ in range(3))
    for t in range(1, rounds + 1):
        values = np.bincount(row, weights=w[col], minlength=len(entries)).astype(float).tolist()
        error, grad = np.zeros(len(entries)), l2 * w
        steps = w[size:].tolist()
        for n, scored, gold, used in cases:
            _, chance, expected = segment_marginals(n, [(a, b, k, values[x]) for x, a, b, k in scored], steps)
            for (x, _, _, _), p in zip(scored, chance):
                error[x] += p
            for x in gold:
                error[x] -= 1
            grad[size:] += np.array(expected) - used
        grad[:size] += np.bincount(col, weights=error[row], minlength=size).astype(float)
        mean, spread = 0.9 * mean + 0.1 * grad, 0.999 * spread + 0.001 * grad * grad
        w = w - rate * (mean / (1 - 0.9 ** t)) / (np.sqrt(spread / (1 - 0.999 ** t)) + 1e-8)
    return Model(names, w[:size].reshape(len(names), len(KINDS)), w[size:])


# ---------------------------------------------------------------- training rows

#: Templates: ``{...}`` is a span of the kind named, ``<...>`` a lookalike.
LIKE = (
    "call me on {phone} today", "tel {phone}", "phone: {phone}.", "my mobile is {phone}, ok", "fax {phone} or {phone}",
    "{phone}", "the {phone} and", "card {card} exp", "pay with visa {card}", "credit card: {card}, thanks", "{card}",
    "from {card} it", "server at {ip} is down", "ip {ip}", "ping {ip} now", "write to {email} please", "mail {email}",
    "contact: {email}.", "{email}", "reach {email} or call {phone}", "visa {card} tel {phone}",
)
UNLIKE = (
    "order <id> was sent", "invoice no <id>", "the <id> of", "<id>", "on <date> we", "date: <date>", "<date>",
    "price <amount> each", "total <amount>", "isbn <isbn> page", "version <version> is", "section <version>",
    "score <score> and", "at <date> <time>", "<numbers>", "lines <numbers> here", "ref <badcard> of", "<badcard>",
    "the <badcard> and", "he was at home. Then we", "look at the dot. com and", "meet at noon dot", "ticket <id>, <date>",
    "card <badcard> fails", "call on <date>", "a <range> b",
)
WORDS = ("the", "and", "ere", "thing", "other", "la", "der", "casa", "nous", "with", "ing", "of", "one")


class Texts:
    """Seeded training texts with their spans."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def phone(self) -> str:
        a, b, c = self.digits(3), self.digits(3), self.digits(4)
        return self.r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}){b}-{c}",
                              f"1-{a}-{b}-{c}", f"0{self.digits(1)} " + " ".join(self.digits(2) for _ in range(4)),
                              f"0{self.digits(3)}/{self.digits(6)}", f"00{self.digits(2)} {a} {b}{c}", f"1 ({a}) {b}-{c}"))

    def _card_digits(self, n: int, valid: bool) -> str:
        body = self.r.choice("3456") + self.digits(n - 2)
        check = next(d for d in "0123456789" if luhn(body + d))
        return body + (check if valid else str((int(check) + self.r.randrange(1, 10)) % 10))

    def card(self) -> str:
        n = self.r.choice((16, 16, 15, 14, 13))
        d = self._card_digits(n, True)
        if n == 15:
            return self.r.choice((d, f"{d[:4]} {d[4:10]} {d[10:]}", f"{d[:4]}-{d[4:10]}-{d[10:]}"))
        if n < 15:
            return d
        parts = [d[i:i + 4] for i in range(0, 16, 4)]
        return self.r.choice((".", "/", "_", "\xa0", "  ")).join(parts)

    def badcard(self) -> str:
        d = self._card_digits(16, False)
        return self.r.choice((d, " ".join(d[i:i + 4] for i in range(0, 16, 4)), d[:15]))

    def ip(self) -> str:
        return self.r.choice((" . ", ". ", " ")).join(str(self.r.randrange(256)) for _ in range(4))

    def email(self) -> str:
        at = self.r.choice((" at ", " [at] ", "(at)", " (at) ", "[at]", " @ "))
        dot = " dot " if at == " at " else self.r.choice((" dot ", "[dot]", ".", " (dot) ", "."))
        name = self.r.choice(("ann", "bob.li", "carol_k", "info", "d.ferro", "ines42", "jo-ann")).replace(
            ".", self.r.choice((".", dot)))
        host = self.r.choice(("example", "mail", "shop3", "uni-koeln", "acme"))
        middle = self.r.choice(("", "", f"{dot}mail", f"{dot}co"))
        return f"{name}{at}{host}{middle}{dot}{self.r.choice(sorted(ENDINGS))}"

    def id(self) -> str:
        return self.r.choice((self.digits(8), self.digits(10), self.digits(12), self.digits(7), self.digits(9),
                              f"{self.digits(4)}-{self.digits(5)}", f"{self.digits(6)}/{self.digits(4)}"))

    def date(self) -> str:
        y, m, d = str(self.r.randrange(1950, 2030)), f"{self.r.randrange(1, 13):02}", f"{self.r.randrange(1, 29):02}"
        return self.r.choice((f"{y}-{m}-{d}", f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{y}/{m}/{d}"))

    def time(self) -> str:
        return f"{self.r.randrange(24):02}:{self.r.randrange(60):02}:{self.r.randrange(60):02}"

    def amount(self) -> str:
        return f"{self.digits(6)}.{self.digits(2)}"

    def isbn(self) -> str:
        return f"978-{self.digits(1)}-{self.digits(4)}-{self.digits(4)}-{self.digits(1)}"

    def version(self) -> str:
        return ".".join(self.digits(self.r.randrange(2, 4)) for _ in range(3))

    def score(self) -> str:
        return f"{self.digits(4)}:{self.digits(4)}"

    def range(self) -> str:
        return f"{self.digits(4)}-{self.digits(4)}"

    def numbers(self) -> str:
        return " ".join(self.digits(self.r.randrange(1, 4)) for _ in range(self.r.randrange(5, 12)))

    def row(self) -> tuple[str, list[Span]]:
        template = self.r.choice(LIKE if self.r.random() < 0.55 else UNLIKE)
        text, spans = " ".join(self.r.choices(WORDS, k=self.r.randrange(3))), []
        text += " " if text else ""
        for part in re.split(r"([{<]\w+[}>])", template):
            if part[:1] in ("{", "<"):
                made = getattr(self, part[1:-1])()
                if part[0] == "{":
                    spans.append((part[1:-1], len(text), len(text) + len(made)))
                part = made
            text += part
        return text, spans


def labelled_texts(n: int = TRAIN_ROWS, seed: int = 1) -> list[tuple[str, list[Span]]]:
    """``n`` training texts and their spans, seeded."""
    made = Texts(seed)
    return [made.row() for _ in range(n)]


@lru_cache(maxsize=4)
def default_model(n: int = TRAIN_ROWS, seed: int = 1) -> Model:
    return fit(labelled_texts(n, seed))


def parse_spans(spans: str) -> list[Span]:
    return [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in spans.split(",") if x)]


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` rows (text, spans as ``kind:start:end``,
    comma-joined), chosen by a hash of the text."""
    sample = labelled.where("text is not null and spans is not null").orderBy(
        F.xxhash64("text"), "text").limit(rows).select("text", "spans").collect()
    return fit([(r.text, parse_spans(r.spans)) for r in sample])


# ---------------------------------------------------------------- columns

def shown(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join([f"{k}:{a}:{b}" for k, a, b in order])


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256,
    spans (all), n_added per row of docs."""
    ship(docs.sparkSession)
    model = model or default_model()

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                added = added_spans(text, base, model)
                base_text = shown(base)
                rows.append((*(sum(k == kind for k, _, _ in base) for kind in KINDS),
                             hashlib.sha256(base_text.encode()).hexdigest(),
                             shown(base + added) if added else base_text, len(added)))
            columns = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]],
                 pa.array(columns[4], pa.string()), pa.array(columns[5], pa.string()),
                 pa.array(columns[6], pa.int64())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
             "spans string, n_added long")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All rows and columns, every span in ``text`` replaced by ``[KIND]``
    (overlapping spans as one, by the first's kind)."""
    ship(docs.sparkSession)
    model = model or default_model()
    at = docs.columns.index("text")

    def masked(text):
        if not text:
            return text
        base = base_spans(text)
        out, end = [], 0
        for kind, a, b in sorted(base + added_spans(text, base, model), key=lambda s: (s[1], -s[2])):
            if a >= end:
                out += [text[end:a], f"[{kind.upper()}]"]
            end = max(end, b)
        return "".join(out) + text[end:]

    def run(batches):
        for batch in batches:
            texts = pa.array([masked(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [texts if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
