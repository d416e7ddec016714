"""Toxicity (operator 6): weak supervision and a linear classifier.

1. *Stems.* The first four to eight letters of each word are its stems (they
   reach inflected forms never seen before). Stems that mark toxic texts
   are mined from a bounded sample of labelled training rows
   (``sample_rows``), of which copies (equal stem sets, by a digest of the
   whole set) count once.
2. *Voters.* Three fixed lexicons, ``MINED_VOTERS`` mined lexicons, and
   patterns (several hits, density, second person, exclamation) vote on every
   document in one pass over the whole texts; known training labels are one
   more voter, with an accuracy to be estimated like the others'.
3. *Label model.* Documents are counted by vote pattern (at most 2**voters *
   3 rows). A generative model, P(y) * P(annotator | y) * a tree of P(vote |
   parent vote, y), is fitted by EM; the tree (maximum spanning tree of
   conditional mutual information) carries the voters' correlations.
4. *Classifier.* Logistic regression on stems and patterns is trained on the
   model's posteriors, over a bounded sample of rows outside the held-out
   fifth, and scores every document.

Labels are read only for rows with crc32(doc_id as text) mod 5 <> 0; labels,
lang, source and doc_id are never inputs of a score. The text pass writes one
short row per document (its hits), so texts are read once for mining (only
sampled rows leave the scan) and once for voting, and are never shuffled.

Edge cases: null and empty texts have no hits and get the classifier's base
score; a null doc_id counts as held out; repeated rows are scored each;
repeated labels of an id count as toxic if any is; without labels (or without
both kinds) the fixed lexicons alone vote; an empty table gives no rows; only
``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberscope.llm.common import Memo, scratch_table, ship, text_or_empty

#: Fixed lexicons (parameters): insults for persons, words of contempt, words
#: of disgust and dehumanisation. Matched by whole words, lower-cased.
LEXICONS = (
    ("idiot", "idiots", "moron", "morons", "loser", "losers", "clown", "clowns", "fool", "fools",
     "imbecile", "dumbass", "jerk", "creep", "freak", "coward", "bastard", "bitch", "asshole"),
    ("worthless", "pathetic", "stupid", "useless", "dumb", "retarded", "ridiculous", "brainless",
     "hopeless", "ugly", "inferior"),
    ("disgusting", "trash", "scum", "filth", "filthy", "garbage", "vermin", "vile", "subhuman",
     "parasite", "parasites", "rats", "rotten"),
)
SECOND_PERSON = frozenset(("you", "your", "you're", "yourself", "You", "Your", "You're"))
SAMPLE_ROWS = 20_000
STEMS = 4_096
VOTING_STEMS = 128
MINED_VOTERS = 6
PATTERNS = 4
VOTERS = len(LEXICONS) + MINED_VOTERS + PATTERNS
#: A mined stem occurs in this share of the sample's toxic texts at least, and
#: is e**EVIDENCE times as common there as in clean ones.
SUPPORT, EVIDENCE = 0.01, 3.0
#: Annotators are taken to be right at least this often.
ANNOTATOR = 0.97
FOLDS = 5
LETTERS = regex.compile(r"\p{L}+(?:'\p{L}+)?")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def stems_of(chunk: str) -> list[str]:
    out = []
    for w in LETTERS.findall(chunk.lower()):
        out += [w[:n] for n in range(min(4, len(w)), min(8, len(w)) + 1)]
    return out


def _text_stems(text: str, memo: Memo) -> set[str]:
    return set().union(*map(memo.__getitem__, set(text.split())))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic (0/1) of at most ``sample_rows`` labelled training
    rows, copies left out: one row per label and digest of the stem set."""
    train = labels.where(~held_out() & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    sample = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def signatures(batches):
        memo = Memo(stems_of, 40_000)
        for batch in batches:
            digests = [blake2b("\n".join(sorted(_text_stems(t, memo))).encode(), digest_size=16).digest()
                       for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())],
                                             names=["row", "text", "toxic", "digest"])

    # the sample's ids have a fixed bound, so they can be broadcast
    texts = docs.join(F.broadcast(sample), "doc_id").select(
        F.monotonically_increasing_id().alias("row"), "text",
        F.when(F.col("toxic") == 1, 1).otherwise(0).cast("int").alias("toxic"))
    signed = scratch_table(docs.sparkSession, texts.mapInArrow(
        signatures, "row long, text string, toxic int, digest binary"), "toxicity-sample")
    # an id may repeat with other texts, so the rows are bounded again
    single = signed.groupBy("digest", "toxic").agg(F.min("row").alias("row")).orderBy(
        "digest", "toxic").limit(sample_rows)
    return signed.join(F.broadcast(single.select("row")), "row").select("text", "toxic")


def mine_stems(sample: DataFrame, size: int = STEMS) -> list[str]:
    """Stems most indicative of toxic texts, best first (at most ``size``)."""

    def run(batches):
        memo = Memo(stems_of, 40_000)
        for batch in batches:
            seen: dict[str, list[int]] = {"": [0, 0]}  # the texts themselves
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[""][toxic] += 1
                for s in _text_stems(text, memo):
                    seen.setdefault(s, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                 pa.array([v[1] for v in seen.values()], pa.int64())], names=["stem", "clean", "toxic"])

    counted = sample.mapInArrow(run, "stem string, clean long, toxic long").groupBy("stem").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 0")
    counted = scratch_table(sample.sparkSession, counted, "toxicity-stems")
    n = counted.where("stem = ''").first()
    if n is None or not n.clean:
        return []
    found = counted.where((F.col("stem") != "") & (F.col("toxic") >= max(3, SUPPORT * n.toxic)))
    p, q = (F.col("toxic") + 0.5) / (n.toxic + 1.0), (F.col("clean") + 0.5) / (n.clean + 1.0)
    # weight of evidence times how many toxic texts it explains
    strength = F.log(p / q) * F.col("toxic")
    best = found.where(F.log(p / q) > EVIDENCE).orderBy(F.desc(strength), "stem").limit(size)
    return [r.stem for r in best.select("stem").collect()]


def group_stems(sample: DataFrame, stems: list[str]) -> list[int]:
    """The voter (0 to MINED_VOTERS - 1) of each of the first VOTING_STEMS
    stems, -1 for the others. Stems that occur in the same toxic texts share
    a voter, so that a voter speaks for one vocabulary (or language) and the
    silence of the others says little."""
    top = stems[:VOTING_STEMS]
    toxic = votes(sample.where("toxic = 1").select(F.lit(0).cast("long").alias("doc_id"), "text"), top,
                  [-1] * len(top)).select("hits").collect()  # of the bounded sample
    seen = np.zeros((max(len(toxic), 1), max(len(top), 1)))
    for i, r in enumerate(toxic):
        seen[i, [h for h in r.hits if h < len(top)]] = 1
    size = np.sqrt(np.maximum(seen.sum(0), 1e-9))
    alike = (seen / size).T @ (seen / size)
    seeds: list[int] = []
    for _ in range(min(MINED_VOTERS, len(top))):
        apart = 1 - alike[:, seeds].max(1) if seeds else np.ones(len(top))
        seeds.append(int(np.argmax(size ** 2 * np.maximum(apart, 0) ** 2)))
    voter = np.argmax(alike[:, seeds], 1).tolist() if seeds else []
    return voter + [-1] * (len(stems) - len(top))


class Voting:
    """Hits and votes of single texts. Features: the mined stems, then the
    fixed words, then the patterns."""

    def __init__(self, stems: list[str], mined: list[int]):
        fixed = [w for words in LEXICONS for w in words]
        self.stem_no = {s: i for i, s in enumerate(stems)}
        self.word_no = {w: len(stems) + i for i, w in enumerate(fixed)}
        self.voter = [len(LEXICONS) + g if g >= 0 else -1 for g in mined]
        self.voter += [k for k, words in enumerate(LEXICONS) for _ in words]
        self.size = len(self.voter) + PATTERNS
        self.memo = Memo(self._features)

    def _features(self, chunk: str) -> tuple[int, ...]:
        found = [self.stem_no[s] for s in stems_of(chunk) if s in self.stem_no]
        return tuple(found + [self.word_no[w] for w in LETTERS.findall(chunk.lower())
                              if w in self.word_no])

    def __call__(self, text: str) -> tuple[list[int], int]:
        words = text.split()
        chunks = set(words)
        found = set().union(*map(self.memo.__getitem__, chunks))
        bits, strong = 0, 0
        for f in found:
            if self.voter[f] >= 0:
                bits |= 1 << self.voter[f]
                strong += 1
        for k, fires in enumerate((strong >= 2, strong * 100 > len(words),
                                   not SECOND_PERSON.isdisjoint(chunks),
                                   text.count("!!") * 50 > len(words))):
            if fires:
                bits |= 1 << (VOTERS - PATTERNS + k)
                found.add(len(self.voter) + k)
        return sorted(found), bits


def votes(docs: DataFrame, stems: list[str], mined: list[int]) -> DataFrame:
    """doc_id, hits (feature numbers), pattern (bits of the voters) per row."""
    ship(docs.sparkSession)

    def run(batches):
        vote = Voting(stems, mined)
        for batch in batches:
            pairs = [vote(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                 pa.array([p[1] for p in pairs], pa.int32())], names=["doc_id", "hits", "pattern"])

    return docs.mapInArrow(run, "doc_id long, hits array<int>, pattern int")


class LabelModel:
    """Tree-structured generative model of binary votes and an annotator.

    ``votes`` (patterns x voters, 0/1), ``annotator`` (-1 abstains, 0, 1) and
    ``counts`` describe all documents; ``posterior`` is P(toxic) per row."""

    def __init__(self, votes: np.ndarray, annotator: np.ndarray, counts: np.ndarray,
                 rounds: int = 40):
        self.v, self.a, self.n = votes.astype(int), annotator, counts.astype(float)
        lexical = self.v[:, :-PATTERNS].any(1)
        self.posterior = np.where(annotator == 1, 0.95, np.where(
            annotator == 0, 0.02, np.where(lexical, 0.5, 0.02)))
        self.parent = [-1] * votes.shape[1]
        for step in range(rounds):
            if step % 10 == 2:
                self.parent = self._tree()
            before = self.posterior
            self._fit()
            self.posterior = self._expect()
            if step > 25 and np.abs(before - self.posterior).max() < 1e-6:
                break

    def _weights(self) -> np.ndarray:
        return np.stack([self.n * (1 - self.posterior), self.n * self.posterior])

    def _joint(self, i: int, j: int, w: np.ndarray) -> np.ndarray:
        """P(vote i, vote j | y) as a 2 x 2 table, smoothed."""
        cell = np.bincount(self.v[:, i] * 2 + self.v[:, j], weights=w, minlength=4) + 0.5
        return (cell / cell.sum()).reshape(2, 2)

    def _tree(self) -> list[int]:
        """Parents in the maximum spanning tree of the voters' mutual
        information given y (Prim's algorithm from voter 0)."""
        m, w = self.v.shape[1], self._weights()
        share = w.sum(1) / max(w.sum(), 1e-9)
        info = np.zeros((m, m))
        for i in range(m):
            for j in range(i):
                for y in (0, 1):
                    t = self._joint(i, j, w[y])
                    info[i, j] += share[y] * (t * np.log(t / np.outer(t.sum(1), t.sum(0)))).sum()
                info[j, i] = info[i, j]
        parent, inside = [-1] * m, [0]
        while len(inside) < m:
            i, j = max(((i, j) for i in inside for j in range(m) if j not in inside),
                       key=lambda e: (info[e], -e[1]))
            parent[j] = i
            inside.append(j)
        return parent

    def _fit(self) -> None:
        w = self._weights()
        self.prior = (w.sum(1) + 1) / (w.sum() + 2)
        self.table = np.zeros((2, self.v.shape[1], 2))  # P(vote = 1 | y, parent's vote)
        for j, p in enumerate(self.parent):
            up = self.v[:, p] if p >= 0 else np.zeros(len(self.v), int)
            for y in (0, 1):
                for b in (0, 1):
                    rows = up == b
                    self.table[y, j, b] = ((w[y] * rows * self.v[:, j]).sum() + 0.1) / (
                        (w[y] * rows).sum() + 0.2)
        self.label = np.empty((2, 2))  # P(annotator = k | y)
        for y in (0, 1):
            known = [(w[y] * (self.a == k)).sum() for k in (0, 1)]
            right = max((known[y] + 2.0) / (sum(known) + 2.04), ANNOTATOR)
            self.label[y, y], self.label[y, 1 - y] = right, 1 - right

    def _expect(self) -> np.ndarray:
        logs = np.log(self.prior)[:, None] + np.zeros((2, len(self.v)))
        for j, p in enumerate(self.parent):
            up = self.v[:, p] if p >= 0 else np.zeros(len(self.v), int)
            for y in (0, 1):
                on = self.table[y, j][up]
                logs[y] += np.log(np.where(self.v[:, j] == 1, on, 1 - on))
        for k in (0, 1):
            logs[:, self.a == k] += np.log(self.label[:, k])[:, None]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def fit_linear(hits: list[list[int]], target: np.ndarray, size: int, rounds: int = 400,
               l2: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on binary features
    with soft targets (full-batch Adam)."""
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    cols = np.fromiter((f for h in hits for f in h), np.int64, len(rows))
    w, b = np.zeros(size + 1), 0.0
    m1, m2, n = np.zeros(size + 1), np.zeros(size + 1), max(len(hits), 1)
    b = np.log((target.sum() + 0.5) / (n - target.sum() + 0.5))
    w[size] = b
    for step in range(1, rounds + 1):
        # a count of nothing is of integers even with weights
        z = np.bincount(rows, weights=w[cols], minlength=len(hits)).astype(float) + w[size]
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - target
        grad = np.bincount(cols, weights=error[rows], minlength=size + 1).astype(float)
        grad[:size] += l2 * w[:size]
        grad[size] = error.sum()
        grad /= n
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        w -= 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return w[:size], float(w[size])


@dataclass(frozen=True)
class Classifier:
    """What scoring needs: the mined stems, their voters, the weights."""

    stems: list[str]
    mined: list[int]
    weights: np.ndarray
    base: float

    def scores(self, hits: pa.ListArray) -> np.ndarray:
        sizes = np.diff(hits.offsets.to_numpy())
        rows = np.repeat(np.arange(len(sizes)), sizes)
        z = np.bincount(rows, weights=self.weights[hits.flatten().to_numpy()],
                        minlength=len(sizes)) + self.base
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Classifier, DataFrame]:
    """The classifier, and the votes of every row of docs (a written table)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    labels = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").alias("toxic"))
    sample = labelled_sample(docs, labels, sample_rows)
    stems = mine_stems(sample)
    mined = group_stems(sample, stems)
    voted = scratch_table(spark, votes(docs, stems, mined), "toxicity-votes")
    known = labels.where(~held_out()).select("doc_id", F.col("toxic").cast("int").alias("annotator"))
    marked = voted.join(known, "doc_id", "left").withColumn(
        "annotator", F.coalesce("annotator", F.lit(-1)))
    patterns = marked.groupBy("pattern", "annotator").count().collect()  # at most 3 * 2**VOTERS rows
    size = Voting(stems, mined).size
    if not patterns:
        return Classifier(stems, mined, np.zeros(size), 0.0), voted
    keys = [(r.pattern, r.annotator) for r in patterns]
    bits = np.array([[p >> j & 1 for j in range(VOTERS)] for p, _ in keys])
    model = LabelModel(bits, np.array([a for _, a in keys]), np.array([r["count"] for r in patterns]))
    posterior = dict(zip(keys, model.posterior))
    # labelled rows first, then others, up to the bound
    rows = marked.where(~held_out()).orderBy(
        F.desc(F.col("annotator") >= 0), F.xxhash64("doc_id"), "doc_id", "pattern").limit(
        sample_rows).select("hits", "pattern", "annotator").collect()
    weights, base = fit_linear([r.hits for r in rows], np.array(
        [posterior[r.pattern, r.annotator] for r in rows]), size)
    return Classifier(stems, mined, weights, base), voted


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted per row of docs."""
    model, voted = train(docs, labels, sample_rows)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(batch.column(1)))], names=["doc_id", "score"])

    scored = voted.select("doc_id", "hits").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that are not predicted toxic, all their columns. Rows
    are judged by their own text, so null or repeated ids need no join."""
    model, _ = train(docs, labels, sample_rows)
    schema = docs.schema
    text_at = docs.columns.index("text")

    def run(batches):
        vote = Voting(model.stems, model.mined)
        for batch in batches:
            hits = pa.array([vote(t or "")[0] for t in batch.column(text_at).to_pylist()],
                            pa.list_(pa.int32()))
            yield batch.filter(pa.array(model.scores(hits) < 0.5))

    return docs.mapInArrow(run, schema)
