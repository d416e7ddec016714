"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.llm import (conversation_repair, jaccard_join, lexical_search, line_quality, packing,
                             pii, secret_scan, token_counts, token_files, topk_search, toxicity,
                             url_reputation, word_bpe)
from memberscope.llm.common import read
from memberscope.llm.oracle_sql import REPAIR_SQL, SEARCH_SQL


def op1_pack_ffd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout of all documents in sequences of at most 1024 ids."""
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_topk_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every fiftieth vector."""
    return topk_search.topk_inner_products(read(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all texts."""
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts written as token records and read back."""
    return token_files.token_files(read(spark, sf_dir, "documents"))


def page_key():
    """The document that a page shows: the last number of its url's path."""
    number = F.regexp_extract(url_reputation.path_of(F.col("url")), r"/([0-9]{1,18})[^/0-9]*/?$", 1)
    return F.when(number != "", number).cast("long")


def page_outcomes(labels: DataFrame) -> DataFrame:
    """A labelled document is a bad outcome for the pages that show it when
    it is toxic or of low quality."""
    return labels.select(F.col("doc_id").alias("key"), F.when(
        (F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0).alias("bad"))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, else by its host's reputation."""
    return url_reputation.judge_urls(read(spark, sf_dir, "pages"),
                                     page_outcomes(read(spark, sf_dir, "labels")), page_key())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all texts."""
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and line frequency of all documents."""
    return line_quality.line_quality(read(spark, sf_dir, "documents"))


def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts encoded and decoded, as digests."""
    return word_bpe.encode_digest(read(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return jaccard_join.component_ids(read(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in all texts, with the forest's judgement."""
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged as the contract says and repaired."""
    turns = conversation_repair.damage(read(spark, sf_dir, "conversations"))
    return conversation_repair.repair_summary(turns)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all texts: the base patterns' and the field's spans."""
    return pii.find(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_pack_ffd, op2_topk_inner, op3_token_counts, op4_token_files, op5_url_reputation,
    op6_toxicity, op7_line_frequency, op8_word_bpe, op9_jaccard_join, op10_secret_scan,
    op11_conversation_repair, op12_lexical_search, op13_pii)}

#: DuckDB SQL of the operators that SQL expresses.
URL_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages),
h AS (
  SELECT page_id,
         translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM p),
k AS (
  SELECT *, list_reverse(string_split(host, '.')) AS parts,
         TRY_CAST(nullif(regexp_extract(path, '/([0-9]{1,18})[^/0-9]*/?$', 1), '') AS BIGINT) AS doc
  FROM h),
l AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, any_value(parts) AS parts, count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM k LEFT JOIN l ON k.doc = l.doc_id GROUP BY host),
named AS (
  SELECT host, n, bad, two IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') AS long_suffix,
         CASE WHEN long_suffix AND len(parts) > 2 THEN parts[3] || '.' || two ELSE two END AS domain,
         CASE WHEN long_suffix THEN two ELSE parts[1] END AS suffix
  FROM (SELECT *, CASE WHEN len(parts) > 1 THEN parts[2] || '.' || parts[1] ELSE parts[1] END AS two
        FROM hosts)),
s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad,
         (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM named) AS mean
  FROM named GROUP BY suffix),
sm AS (
  SELECT CASE WHEN sum(n * (n - 1)) = 0 THEN 999.0 ELSE 1 / least(greatest(
    (sum((bad - n * mean) * (bad - n * mean) / (mean * (1 - mean))) - sum(n)) / sum(n * (n - 1)),
    0.001), 0.5) - 1 END AS m FROM s0),
s1 AS (SELECT suffix, (bad + m * mean) / (n + m) AS post FROM s0, sm),
d0 AS (
  SELECT d.*, s1.post AS mean FROM (
    SELECT domain, min(suffix) AS suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY domain) d
  JOIN s1 USING (suffix)),
dm AS (
  SELECT CASE WHEN sum(n * (n - 1)) = 0 THEN 999.0 ELSE 1 / least(greatest(
    (sum((bad - n * mean) * (bad - n * mean) / (mean * (1 - mean))) - sum(n)) / sum(n * (n - 1)),
    0.001), 0.5) - 1 END AS m FROM d0),
d1 AS (SELECT domain, (bad + m * mean) / (n + m) AS post FROM d0, dm),
h0 AS (SELECT named.*, d1.post AS mean FROM named JOIN d1 USING (domain)),
hm AS (
  SELECT CASE WHEN sum(n * (n - 1)) = 0 THEN 999.0 ELSE 1 / least(greatest(
    (sum((bad - n * mean) * (bad - n * mean) / (mean * (1 - mean))) - sum(n)) / sum(n * (n - 1)),
    0.001), 0.5) - 1 END AS m FROM h0),
h1 AS (SELECT host, n + m AS size, (bad + m * mean) / (n + m) AS post FROM h0, hm),
judged AS (
  SELECT k.page_id, k.host, k.path,
         CASE WHEN (k.host = 'example.net' OR ends_with(k.host, '.example.net'))
                   AND starts_with(k.path, '/en/') THEN 'example.net/en/'
              WHEN (k.host = 'example.com' OR ends_with(k.host, '.example.com'))
                   AND starts_with(k.path, '/de/') THEN 'example.com/de/'
              WHEN (k.host = 'org' OR ends_with(k.host, '.org'))
                   AND starts_with(k.path, '/fr/') THEN 'org/fr/'
              WHEN (k.host = 'net' OR ends_with(k.host, '.net'))
                   AND starts_with(k.path, '/') THEN 'net/' END AS rule,
         post - 1.2816 * sqrt(post * (1 - post) / (size + 1)) > 0.3 AND (SELECT sum(n) FROM named) > 0 AS blocked
  FROM k JOIN h1 USING (host))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v),
           lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.rid <> q.rid)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS r FROM s)
WHERE r <= 5
"""

LINES_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host
  FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
pos AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS (
  SELECT rid, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
                  lead(word, 4) OVER o] AS five, lead(i, 4) OVER o AS last
  FROM pos WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (
  SELECT rid, five FROM win WHERE last IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
rep AS (
  SELECT rid, count(DISTINCT j) AS n FROM (
    SELECT rid, unnest(range(i, i + 5)) AS j FROM win JOIN twice USING (rid, five)
    WHERE last IS NOT NULL)
  GROUP BY rid),
ln AS (SELECT rid, doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (
  SELECT rid, doc_id, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS norm
  FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY rid),
hosts AS (SELECT host, count(*) AS docs FROM d GROUP BY host),
freq AS (
  SELECT host, norm, first FROM (
    SELECT host, norm, count(DISTINCT rid) AS n, min(doc_id) AS first FROM lw GROUP BY host, norm)
  JOIN hosts USING (host) WHERE n > 20 AND n > 0.02 * docs),
gone AS (
  SELECT rid, sum(words) AS n FROM lw JOIN freq USING (host, norm)
  WHERE doc_id IS DISTINCT FROM first GROUP BY rid),
base AS (
  SELECT d.rid, d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(gone.n, 0) AS gone
  FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)
  LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND NOT (gone > 0 AND (gone > 0.5 * n_words OR n_words - gone < 10)) AS kept
FROM base
"""

ORACLE_SQL = {"op2_topk_inner": TOPK_SQL, "op5_url_reputation": URL_SQL,
              "op7_line_frequency": LINES_SQL, "op11_conversation_repair": REPAIR_SQL,
              "op12_lexical_search": SEARCH_SQL}
