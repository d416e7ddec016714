"""URL filter (operator 5): empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are counted per host. A host's bad rate
is shrunk through beta-binomial priors along host -> registered domain ->
suffix -> all: each level's prior mean is the level above's posterior mean,
and its strength is estimated from all groups of the level by the method of
moments (over-dispersion of a beta-binomial). A host is blocked where the
lower bound of its posterior bad rate (mean - z * deviation) exceeds
``limit``. Explicit rules come first; the longest that fits wins.

Pages are reduced to one row per host (and labelled document) before any
join, so a host with a third of all pages sends one partial count per task;
the verdict comes back in a page-to-host join whose page side may be split.

Edge cases: a null url, or one without ``://``, has empty host and path, fits
no rule and gets the verdict of the overall rate; hosts without outcomes get
their domain's; repeated pages are judged each and count each; null page ids
are kept; an empty pages table gives no rows, an empty outcome table blocks
by rules alone; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberscope.llm.common import scratch_table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))
#: Public suffixes of more than one label that are told apart (parameter).
LONG_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")
LIMIT, Z = 0.3, 1.2816
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 999.0


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule's text, else NULL."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def strength(groups: DataFrame) -> float:
    """Prior strength from rows (n, bad, mean): n groups' spread around their
    prior means beyond binomial noise."""
    n, bad, mean = F.col("n"), F.col("bad"), F.col("mean")
    s = groups.agg(
        F.sum((bad - n * mean) * (bad - n * mean) / (mean * (1 - mean))).alias("s"),
        F.sum("n").alias("n"), F.sum(n * (n - 1)).alias("q")).first()
    if not s.q:
        return STRONGEST
    rho = min(max((s.s - s.n) / s.q, 1 / (STRONGEST + 1)), 1 / (WEAKEST + 1))
    return 1 / rho - 1


def host_reputation(hosts: DataFrame, limit: float = LIMIT, z: float = Z) -> DataFrame:
    """hosts (host, n, bad) -> host, mean, lower, blocked."""
    hosts = hosts.select("host", "n", "bad", domain_of(F.col("host")).alias("domain"),
                         suffix_of(F.col("host")).alias("suffix"))
    hosts = scratch_table(hosts.sparkSession, hosts, "host-outcomes")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                      F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    level = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    level = level.withColumn("mean", F.lit((total.bad + 1) / (total.n + 2)))

    def shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
        m = strength(groups)
        return groups.withColumn("post", (F.col("bad") + m * F.col("mean")) / (F.col("n") + m)), m

    suffixes, _ = shrunk(level)
    domains = hosts.groupBy("domain").agg(F.min("suffix").alias("suffix"), F.sum("n").alias("n"),
                                          F.sum("bad").alias("bad"))
    domains, _ = shrunk(domains.join(suffixes.select("suffix", F.col("post").alias("mean")), "suffix"))
    hosts, m = shrunk(hosts.join(domains.select("domain", F.col("post").alias("mean")), "domain"))
    mean, size = F.col("post"), F.col("n") + m
    lower = mean - z * F.sqrt(mean * (1 - mean) / (size + 1))
    return hosts.select("host", mean.alias("mean"), lower.alias("lower"),
                        ((lower > limit) & F.lit(total.n > 0)).alias("blocked"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, key: Column, rules=RULES,
               limit: float = LIMIT, z: float = Z) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    ``outcomes`` (key, bad 0/1) labels pages through the page expression
    ``key``; repeated keys count once (bad if any is)."""
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    # one row per host and key before the labels come in
    keyed = pages.select(host_of(url).alias("host"), key.alias("key")).groupBy("host", "key").agg(
        F.count("*").alias("pages"))
    labels = outcomes.where("key is not null and bad is not null").groupBy("key").agg(
        F.max("bad").alias("bad"))
    hosts = (keyed.join(labels, "key", "left").groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("bad") * F.col("pages")), F.lit(0)).alias("bad")))
    reputation = host_reputation(hosts, limit, z).select("host", "blocked")
    verdicts = dict((rule, verdict) for verdict, rule in rules)
    rule = F.col("rule")
    by_rule = F.lit(None).cast("string")
    for text, verdict in verdicts.items():
        by_rule = F.when(rule == text, F.lit(verdict)).otherwise(by_rule)
    return (judged.join(reputation, "host", "left")
            .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
            .select("page_id", "host", "path", "rule",
                    F.coalesce(by_rule, F.when(F.col("blocked"), "block").otherwise("allow"))
                    .alias("verdict")))
