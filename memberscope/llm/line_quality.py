"""Quality rules (operator 7): cross-document line frequency, native Spark.

Lines are normalised (white space trimmed, lower case) and hashed; the
documents that hold a line are counted per host (``source``), each document
once. A line held by more than max(``min_docs``, ``share`` of the host's
documents) is removed from all of them but the first (smallest doc_id), so
the words of a shared line stay in the corpus once. With ``long_docs`` the
limits are absolute and do not rise with the host: a line goes above
``min_docs`` documents, one of more than 50 words above ``long_docs``. A document is depleted
and rejected where removal takes more than half of its words, or leaves fewer
than ten. Base rules come first: fewer than ten words, or more than a fifth
of the words inside five-word windows that repeat within the text.

Counting shuffles one partial row per task, host and line, so a hot line or
host is summed before the shuffle; the frequent lines are a written table,
which the planner broadcasts only if its size allows; the removal join is
followed by a sum per document that starts in the same task.

Edge cases: a null text has no words and no lines and fails the base rules; a
null source is the host ''; null doc ids are documents of their own and
count; a null id is never the first holder; repeated rows are separate
documents (the first id keeps its lines in each of its rows); lines without a
word are never counted nor removed; an empty table gives no rows; the
operators read ``doc_id``, ``text`` and ``source`` by name, and working
columns live in one struct, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberscope.llm.common import scratch_table

MIN_DOCS, SHARE = 20, 0.02
LONG_WORDS, LONG_DOCS = 50, 4
DEPLETED = 0.5
MIN_WORDS = 10
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def normalised(line: Column) -> Column:
    return F.lower(F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def base_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds struct ``base`` (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed). Each step is a projection of its own, so
    the arrays are made once per row."""
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("_w", words_of(t)).withColumn("_l", lines_with_words(t))
    n = F.size("_w")
    hashes = F.when(n > WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)])))
    step = step.withColumn("_h", hashes)
    # only texts in which some window repeats are sorted
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    step = step.withColumn("_s", F.when(repeats, F.sort_array(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(F.get(F.col("_s"), k).getField("h") == x.h, F.lit(False))
    step = step.withColumn("_p", F.when(F.col("_s").isNotNull(), F.sort_array(F.transform(
        F.filter("_s", lambda x, k: same(x, k + 1) | ((k > 0) & same(x, k - 1))),
        lambda x: x.i))))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("_p"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    step = step.withColumn("_r", F.coalesce(covered, F.lit(0)).cast("long"))
    n = n.cast("long")
    return step.withColumn("base", F.struct(
        n.alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.col("_r").alias("n_repeat_words"),
        ((n < MIN_WORDS) | (100 * F.col("_r") > 20 * n)).alias("base_failed"),
    )).drop("_w", "_l", "_h", "_s", "_p", "_r")


def host(source: str = "source") -> Column:
    return F.coalesce(F.col(source).cast("string"), F.lit(""))


def absolute_lines(docs: DataFrame, min_docs: int, long_docs: int) -> DataFrame:
    """host, line, first: lines held by more than ``min_docs`` documents of
    the host, long ones by more than ``long_docs``, whatever its size."""
    lines = docs.select("doc_id", host().alias("host"), F.explode(F.array_distinct(F.transform(
        lines_with_words(F.col("text")), lambda line: F.struct(
            line_hash(line).alias("line"), (F.size(words_of(line)) > LONG_WORDS).alias("long"))))).alias("x"))
    limit = F.when(F.col("long"), long_docs).otherwise(min_docs)
    return lines.select("doc_id", "host", "x.*").groupBy("host", "line", "long").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first")).where(F.col("n") > limit)


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE,
                   long_docs: int | None = None) -> DataFrame:
    """host, line, first: lines above their host's limit and the smallest
    doc_id that holds each. A written table."""
    if long_docs is not None:
        found = absolute_lines(docs, min_docs, long_docs).select("host", "line", "first")
        return scratch_table(docs.sparkSession, found, "frequent-lines")
    lines = docs.select("doc_id", host().alias("host"), F.explode(F.array_distinct(F.transform(
        lines_with_words(F.col("text")), line_hash))).alias("line"))
    counted = lines.groupBy("host", "line").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first")).where(F.col("n") > min_docs)
    hosts = docs.groupBy(host().alias("host")).agg(F.count("*").alias("docs"))
    above = counted.join(hosts, "host").where(F.col("n") > share * F.col("docs"))
    return scratch_table(docs.sparkSession, above.select("host", "line", "first"), "frequent-lines")


def _removal(docs: DataFrame, keep: Column, min_docs: int, share: float,
             long_docs: int | None = None) -> DataFrame:
    """keep (a struct of what the caller needs) and removed (words, lines)
    per row of docs."""
    frequent = frequent_lines(docs, min_docs, share, long_docs)
    lines = F.transform(lines_with_words(F.coalesce(F.col("text"), F.lit(""))), lambda line: F.struct(
        line_hash(line).alias("line"), F.size(words_of(line)).alias("words")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       host().alias("host"), keep.alias("keep"), lines.alias("lines"))
    # the kept columns travel with the first line only
    each = rows.select("row", "doc_id", "host", "keep", F.posexplode_outer("lines").alias("k", "x"))
    first = F.coalesce(F.col("k"), F.lit(0)) == 0
    each = each.select("row", "doc_id", "host", F.when(first, F.col("keep")).alias("keep"),
                       F.col("x.line").alias("line"), F.col("x.words").alias("words"))
    gone = F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first"))
    joined = each.join(frequent, ["host", "line"], "left")
    return joined.groupBy("row").agg(
        F.any_value("keep", True).alias("keep"),  # maps have no order
        F.coalesce(F.sum(F.when(gone, F.col("words"))), F.lit(0)).alias("words"),
        F.collect_set(F.when(gone, F.col("line"))).alias("lines"))


def kept(base: Column, removed: Column, depleted: float = DEPLETED) -> Column:
    left = base.n_words - removed
    exhausted = (removed > 0) & ((removed > depleted * base.n_words) | (left < MIN_WORDS))
    return ~base.base_failed & ~exhausted


def line_quality(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """doc_id, the base features, base_failed, kept per row."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", "source")
    keep = F.struct("doc_id", "base")
    out = _removal(base_features(docs), keep, min_docs, share)
    base = F.col("keep.base")
    return out.select("keep.doc_id", "keep.base.*", kept(base, F.col("words")).alias("kept"))


def clean_documents(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE,
                    long_docs: int | None = None) -> DataFrame:
    """The documents that stay, all their columns, with frequent lines taken
    out of ``text`` (and ``n_chars`` following it where there is one)."""
    columns = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    inner = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"),
                        F.col("source").alias("source"), whole.alias("_doc"))
    keep = F.struct("base", "_doc")
    out = _removal(base_features(inner), keep, min_docs, share, long_docs).where(
        kept(F.col("keep.base"), F.col("words")))
    text = F.when(F.size("lines") == 0, F.col("keep._doc.text")).otherwise(F.array_join(F.filter(
        F.split("keep._doc.text", "\n"),
        lambda line: ~(line.rlike(WORD) & F.array_contains("lines", line_hash(line)))), "\n"))
    shown = out.select("keep._doc", text.alias("_text"))
    return shown.select(*[
        F.col("_text").alias("text") if c == "text" else
        F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col(f"_doc.`{c}`").alias(c) for c in columns])
