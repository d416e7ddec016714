"""Secret scans (operator 10): candidates judged by a random forest, native
Spark (SQL functions and the JVM forest of ``pyspark.ml``).

A candidate is a run of at least 16 key characters (letters, digits, + / _ -)
with a digit in it, or, as a value after a credential word (``FOR_WORDS``) and
an assignment or after "bearer", any run of at least six. '=' belongs to a
candidate as trailing padding only, so ``name=value`` gives the value, with
the name before it. Splitting the text at the candidates gives their
positions and neighbouring words at once. The forest sees the candidate's
length and character mix, transitions between character classes, common
letter pairs, coverage by dictionary words, whether it lies on a path, and
words around it; it is trained on labelled findings (a table of before,
candidate, after, label) and removes false positives: digests, identifiers,
paths, placeholders.

``labelled_findings`` makes the default training table from templates with
Spark expressions: ``n`` texts, a documented bound, seeded, scanned by
``candidates`` like any other. Users pass their own.

Scanning is one narrow pass; a document without candidates costs one regular
expression. Redaction groups the findings of a document again by a row
number; documents without candidates are passed through untouched.

Edge cases: null and empty texts have no findings; several equal candidates
are separate findings (numbered by position); repeated rows and null ids
give their own findings; very long candidates are cut into features by length
only; an empty table gives no rows; ``doc_id`` and ``text`` are read by name
and other columns are carried in a struct, so names cannot clash.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.llm.common import scratch_table

NEAR = 48
THRESHOLD = 0.5
MASK = "[SECRET]"
FINDINGS = 4_000

#: Words that speak for a secret or against one in the neighbourhood, and
#: dictionary words (fixed values, parameters of the features).
FOR_WORDS = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "auth",
             "bearer", "credential", "access_key", "private", "login")
AGAINST_WORDS = ("commit", "sha", "md5", "checksum", "digest", "hash", "uuid", "guid", "revision",
                 "version", "example", "sample", "dummy", "order", "number", "file", "page")
DICTIONARY = ("access", "account", "action", "admin", "build", "cache", "change", "class", "client",
              "common", "config", "control", "count", "create", "data", "date", "default", "delete",
              "document", "driver", "error", "event", "example", "field", "file", "final", "first",
              "group", "handler", "here", "index", "info", "input", "item", "java", "large", "list",
              "local", "main", "manager", "max", "message", "min", "model", "module", "name", "number",
              "object", "option", "order", "output", "page", "password", "path", "process", "public",
              "query", "release", "report", "request", "resource", "result", "search", "second",
              "secret", "server", "service", "session", "size", "source", "state", "status", "string",
              "system", "table", "test", "text", "time", "timeout", "token", "type", "update", "user",
              "value", "version", "view", "word", "your")
#: Key characters; what stands between a name and its value; values of
#: credential words (the cheap look behind comes first).
KEY = "[A-Za-z0-9+/_-]"
ASSIGN = r"[\"']?\s{0,3}[:=]{1,2}>?\s{0,3}[\"']?"
CREDENTIAL = (rf"(?<=[:=>\s\"'])(?={KEY}{{6}})(?<=(?i:{'|'.join(FOR_WORDS)})[A-Za-z0-9_-]{{0,16}}{ASSIGN}"
              rf"|(?i:bearer|authorization{ASSIGN}[a-z]{{5,8}})\s{{1,3}})"
              rf"(?!(?i:bearer|basic|digest)\s){KEY}{{6,}}+")
LONG_RUN, PADDING = rf"(?=[A-Za-z+/_-]*+[0-9]){KEY}{{16,}}+", rf"(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"
CANDIDATE = rf"(?<!{KEY})(?:{LONG_RUN}|{CREDENTIAL}){PADDING}"
#: The same where a text names no credential: long runs alone.
RUN_ONLY = rf"(?<!{KEY}){LONG_RUN}{PADDING}"
COMMON_PAIRS = ("th", "he", "in", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of",
                "ed", "is", "it", "al", "ar", "st", "to", "nt", "ng", "se", "ha", "as", "ou", "io", "le")


def names_credential(text: Column) -> Column:
    """Whether any credential word occurs: only then the dear look-behinds of
    CANDIDATE can match."""
    low, out = F.lower(text), F.lit(False)
    for word in FOR_WORDS:
        out = out | F.contains(low, F.lit(word))
    return out


def by_credential(text: Column, make) -> Column:
    """``make(pattern)`` with the pattern that the text needs."""
    return F.when(names_credential(text), make(CANDIDATE)).otherwise(make(RUN_ONLY))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with array ``found`` of (k, start, candidate, before, after);
    ``start`` counts characters from 0."""
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("_m", by_credential(t, lambda p: F.regexp_extract_all(t, F.lit(p), F.lit(0))))
    # without a candidate nothing else is worked out
    step = step.withColumn("_p", F.when(F.size("_m") > 0, by_credential(t, lambda p: F.split(t, p, -1))))
    lengths = F.transform("_m", lambda m, k: F.length(m) + F.length(F.get(F.col("_p"), k)))
    step = step.withColumn("_n", F.when(F.size("_m") > 0, lengths))
    # running sums: the end of each candidate
    ends = F.aggregate("_n", F.array().cast("array<long>"),
                       lambda a, n: F.array_append(a, F.coalesce(F.element_at(
                           F.when(F.size(a) > 0, a), -1), F.lit(0)) + n))
    step = step.withColumn("_e", ends)
    piece = lambda k: F.get(F.col("_p"), k)
    # a name that is a candidate itself still stands before its value
    before = lambda k: F.when((k > 0) & piece(k).rlike(f"^{ASSIGN}$"), F.concat(
        F.get(F.col("_m"), k - 1), piece(k))).otherwise(piece(k))
    found = F.transform("_m", lambda m, k: F.struct(
        k.alias("k"), (F.get(F.col("_e"), k) - F.length(m)).cast("long").alias("start"),
        m.alias("candidate"), F.right(before(k), F.lit(NEAR)).alias("before"),
        F.left(F.get(F.col("_p"), k + 1), F.lit(NEAR)).alias("after")))
    return step.withColumn("found", F.when(F.size("_m") > 0, found)).drop("_m", "_p", "_n", "_e")


def _any(words: tuple[str, ...]) -> str:
    return "(?i)(" + "|".join(words) + ")"


def features(candidate: Column, before: Column, after: Column) -> dict[str, Column]:
    n = F.length(candidate)
    count = lambda pattern: F.regexp_count(candidate, F.lit(pattern))
    share = lambda pattern: count(pattern) / n
    letters = F.greatest(count("[A-Za-z]"), F.lit(1))
    near = lambda words: F.regexp_count(before, F.lit(_any(words))) + F.regexp_count(
        after, F.lit(_any(words)))
    distinct = F.size(F.array_distinct(F.split(candidate, "")))
    return {
        "length": n,
        "digits": share("[0-9]"), "upper": share("[A-Z]"), "lower": share("[a-z]"),
        "marks": share("[+/_=-]"), "distinct": distinct / F.least(n, F.lit(64)),
        "to_digit": share("[A-Za-z](?=[0-9])"), "from_digit": share("[0-9](?=[A-Za-z])"),
        "case_changes": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "same": share(r"(.)(?=\1)"),
        "pairs": F.regexp_count(candidate, F.lit("(?i)(?=" + "|".join(COMMON_PAIRS) + ")")) / letters,
        "dictionary": F.lit(1) - F.length(F.regexp_replace(
            F.lower(candidate), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / n,
        "hex": candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "uuid": candidate.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"),
        "placeholder": candidate.rlike(r"(?i)x{6}|your|here|0{6}|1234567|changeme"),
        "slashes": count("/"),
        "path_before": before.rlike(r"(https?:|[A-Za-z0-9]\.?/|\.)$"),
        "path_after": after.rlike(r"^(\.[A-Za-z]{1,5}\b|[/?:]|\()"),
        "assigned": before.rlike("[:=]\\s{0,3}[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
        "words_for": near(FOR_WORDS), "words_against": near(AGAINST_WORDS),
        "word_before": before.rlike(_any(FOR_WORDS)[:-1] + ")[A-Za-z_]*[\"']?\\s{0,3}[:=]?\\s{0,3}[\"']?$"),
    }


FEATURES = (
    "length", "digits", "upper", "lower", "marks", "distinct", "to_digit", "from_digit", "case_changes",
    "same", "pairs", "dictionary", "hex", "uuid", "placeholder", "slashes", "path_before", "path_after",
    "assigned", "quoted", "words_for", "words_against", "word_before")


def with_features(found: DataFrame) -> DataFrame:
    """Adds one DOUBLE column f_<name> per feature."""
    made = features(F.col("candidate"), F.col("before"), F.col("after"))
    return found.withColumns({f"f_{c}": made[c].cast("double") for c in FEATURES})


def labelled_findings(spark: SparkSession, n: int = FINDINGS, seed: int = 1) -> DataFrame:
    """before, candidate, after, label: the findings of ``n`` texts made from
    templates, as ``candidates`` yields them."""
    key = F.concat_ws("-", F.col("id"), F.lit(seed))
    hexes = F.sha2(key, 256)
    mixed = F.translate(F.base64(F.unhex(F.sha2(F.concat(key, F.lit("m")), 256))), "+/=", "xY7")
    b64 = F.translate(F.base64(F.unhex(F.sha2(F.concat(key, F.lit("b")), 256))), "=", "")
    word = lambda k: F.get(F.array(*map(F.lit, DICTIONARY)), F.pmod(
        F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(len(DICTIONARY))).cast("int"))
    letters = F.translate(mixed, "0123456789", "QwErTyUiOp")
    number = lambda size: F.substring(F.lpad(F.abs(F.xxhash64("id")).cast("string"), 20, "7"), 1, size)
    cut = lambda c, size: F.substring(c, 1, size)
    uuid = F.concat_ws("-", cut(hexes, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4),
                       F.substring(hexes, 17, 4), F.substring(hexes, 21, 12))
    true = [
        ('token = "', cut(hexes, 40), '"'), ('TOKEN = "', F.upper(cut(hexes, 40)), '"!! '),
        ("token: ", cut(mixed, 40), " "), ("api_key: ", cut(mixed, 32), ""),
        ("apikey=", cut(hexes, 32), "&"), ("password=", cut(mixed, 18), " "),
        ("secret_key = '", cut(b64, 40), "'"), ('client_secret": "', cut(hexes, 32), '"'),
        ("aws_access_key_id = ", F.concat(F.lit("AKIA"), F.upper(cut(hexes, 16))), ""),
        ("Authorization: Bearer ", mixed, ""), ("export AUTH_TOKEN=", F.concat(F.lit("ghp_"), cut(mixed, 36)), ""),
        ("private access ", cut(b64, 43), " "), ('key "', cut(mixed, 28), '"'),
        ("login with ", cut(mixed, 20), " now"),
        ('password = "', cut(mixed, 11), '"'), ("passwd: ", cut(mixed, 9), " "),
        ('secret = "', cut(letters, 24), '"'), ("token=", cut(letters, 20), "&"),
        ("export DB_PASSWORD=", cut(mixed, 14), " "), ("Authorization: Bearer ", cut(letters, 30), ""),
        ("pwd=", F.concat(F.initcap(word(1)), number(3)), " "), ("api_key=", F.concat(cut(b64, 42), F.lit("==")), " "),
    ]
    false = [
        ("commit ", cut(hexes, 40), " by"), ("sha256:", hexes, " "), ("md5 ", cut(hexes, 32), ""),
        ("checksum = ", cut(hexes, 40), ""), ("revision ", cut(hexes, 40), ""), ("uuid ", uuid, ""),
        ('"id": "', uuid, '"'), ("order number ", number(18), " was"), ("call ", number(16), "."),
        ("https://host.example/", F.concat_ws("-", word(1), word(2), number(4), word(3)), "/page"),
        ('token = "', F.concat(F.repeat(F.lit("x"), 20), number(1)), '"'),
        ("password: ", F.concat(F.lit("your_password_here_"), number(2)), ""),
        ("file src", F.concat(F.lit("/main/"), word(1), number(1), F.lit("/"), word(2), F.lit("_"), word(3)), ".py"),
        ("the ", F.concat(word(1), word(2), word(3), number(4)), " of"),
        ("set ", F.concat_ws("_", F.upper(word(1)), F.upper(word(2)), F.upper(word(3)), number(2)), " = 5"),
        ("version ", F.concat(word(1), F.lit("-2024-01-"), number(2), F.lit("-final")), ""),
        ("line ", F.concat(F.repeat(F.lit("-"), 18), number(1)), ""),
        ("link to ", F.concat(F.lit("/images/"), cut(hexes, 24)), ".png"),
        ("password: ", word(1), " "), ("token = ", F.concat_ws("_", word(1), word(2)), ""),
        ("secret = ", F.concat(word(1), F.initcap(word(2))), "()"), ("auth: ", F.concat_ws("/", word(1), word(2)), " "),
        ('password = "', F.repeat(F.lit("x"), 10), '"'), ('token: "', F.lit("changeme"), '"'),
    ]
    as_struct = lambda rows, label: [F.struct(
        F.concat(word(7), F.lit(" "), word(8), F.lit(" " + b)).alias("before"),
        c.alias("value"), F.concat(F.lit(a + " "), word(9)).alias("after"),
        F.lit(label).alias("label")) for b, c, a in rows]
    pick = lambda rows: F.get(F.array(*rows), F.pmod(
        F.xxhash64("id", F.lit("t")), F.lit(len(rows))).cast("int"))
    chosen = F.when(F.col("id") % 2 == 0, pick(as_struct(true, 1.0))).otherwise(pick(as_struct(false, 0.0)))
    # written, so that the templates' expressions are not repeated per use
    made = scratch_table(spark, spark.range(0, n, 1, 2).select(chosen.alias("x")), "secret-templates")
    texts = made.select(
        F.concat("x.before", "x.value", "x.after").alias("text"), F.length("x.before").alias("start"),
        F.length("x.value").alias("length"), "x.label")
    # what a scan finds where the template's value stands
    found = candidates(texts).select("start", "length", "label", F.explode("found").alias("x"))
    return scratch_table(spark, found.where((F.col("x.start") < F.col("start") + F.col("length")) & (
        F.col("x.start") + F.length("x.candidate") > F.col("start"))).select(
        "x.before", "x.candidate", "x.after", "label"), "secret-findings")


def train(labelled: DataFrame, trees: int = 40, depth: int = 8, seed: int = 1) -> PipelineModel:
    """Feature assembler and forest as one model."""
    assembler = VectorAssembler(inputCols=[f"f_{c}" for c in FEATURES], outputCol="f_vector")
    forest = RandomForestClassifier(
        featuresCol="f_vector", labelCol="label", probabilityCol="f_probability",
        rawPredictionCol="f_raw", predictionCol="f_class", numTrees=trees, maxDepth=depth,
        subsamplingRate=0.8, seed=seed)
    rows = assembler.transform(with_features(labelled))
    return PipelineModel([assembler, forest.fit(rows)])


def score(found: DataFrame, model: PipelineModel) -> DataFrame:
    """found (with candidate, before, after) plus ``score``."""
    out = model.transform(with_features(found)).withColumn(
        "score", vector_to_array("f_probability")[1])
    return out.select(*found.columns, "score")


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start, length, secret_sha256, score, is_secret per finding."""
    spark = docs.sparkSession
    model = train(labelled if labelled is not None else labelled_findings(spark))
    found = candidates(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).select(
        "doc_id", F.explode("found").alias("x")).select("doc_id", "x.*")
    return score(found, model).select(
        "doc_id", "start", F.length("candidate").cast("long").alias("length"),
        F.sha2("candidate", 256).alias("secret_sha256"), "score",
        (F.col("score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD,
           mask: str = MASK) -> DataFrame:
    """All documents and columns, secrets in ``text`` replaced by ``mask``
    (and ``n_chars`` following where there is one)."""
    spark = docs.sparkSession
    columns = docs.columns
    model = train(labelled if labelled is not None else labelled_findings(spark))
    shown = F.coalesce(F.col("text"), F.lit(""))
    has = by_credential(shown, lambda p: F.regexp_like(shown, F.lit(p)))
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    rows = candidates(docs.where(has).select(
        F.monotonically_increasing_id().alias("row"), F.col("text").alias("text"), whole.alias("doc")))
    each = rows.select("row", "doc", F.explode("found").alias("x")).select(
        "row", F.when(F.col("x.k") == 0, F.col("doc")).alias("doc"), "x.*")
    judged = score(each, model).groupBy("row").agg(
        F.any_value("doc", True).alias("doc"), F.sort_array(F.collect_list(F.struct(
            "k", (F.col("score") >= threshold).alias("secret"), "candidate"))).alias("f"))
    judged = judged.withColumn("_p", by_credential(F.col("doc.text"), lambda p: F.split("doc.text", p, -1)))
    text = F.concat(F.get(F.col("_p"), 0), F.array_join(F.transform("f", lambda x, k: F.concat(
        F.when(x.secret, F.lit(mask)).otherwise(x.candidate), F.get(F.col("_p"), k + 1))), ""))
    judged = judged.select("doc", text.alias("_text"))
    changed = judged.select(*[
        F.col("_text").alias("text") if c == "text" else
        F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col(f"doc.`{c}`").alias(c) for c in columns])
    return docs.where(~has).unionByName(changed)
