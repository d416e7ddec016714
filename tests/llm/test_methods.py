"""Operators whose method SQL does not express, or the given tables do not
exercise, against direct computations."""

import itertools
import math
import random

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from memberscope.llm import queries, secret_scan, toxicity
from memberscope.llm.common import read


# ---------------------------------------------------------------- toxicity

def model(seed=3, rows=40):
    r = np.random.default_rng(seed)
    votes = (r.random((rows, toxicity.VOTERS)) < 0.3).astype(int)
    votes[:, 4] = votes[:, 3] | votes[:, 4]  # two voters that agree often
    return toxicity.LabelModel(votes, r.integers(-1, 2, rows), r.integers(1, 50, rows)), votes


def test_posteriors_are_those_of_the_tree_model():
    m, votes = model()
    for row in range(len(votes)):
        joint = []
        for y in (0, 1):
            p = m.prior[y]
            for j, up in enumerate(m.parent):
                on = m.table[y, j, votes[row, up] if up >= 0 else 0]
                p *= on if votes[row, j] else 1 - on
            if m.a[row] >= 0:
                p *= m.label[y, m.a[row]]
            joint.append(p)
        assert math.isclose(joint[1] / sum(joint), m._expect()[row], rel_tol=1e-9)


def test_the_tree_spans_with_greatest_information():
    m, votes = model()
    w = m._weights()
    share = w.sum(1) / w.sum()

    def information(i, j):
        total = 0.0
        for y in (0, 1):
            cells = {(a, b): 0.5 for a in (0, 1) for b in (0, 1)}
            for row in range(len(votes)):
                cells[votes[row, i], votes[row, j]] += w[y][row]
            n = sum(cells.values())
            for (a, b), c in cells.items():
                pa = sum(cells[a, x] for x in (0, 1)) / n
                pb = sum(cells[x, b] for x in (0, 1)) / n
                total += share[y] * c / n * math.log(c / n / (pa * pb))
        return total

    size = votes.shape[1]
    weight = {(i, j): information(i, j) for i, j in itertools.combinations(range(size), 2)}
    root = list(range(size))

    def find(x):
        return x if root[x] == x else find(root[x])

    best = 0.0
    for (i, j), v in sorted(weight.items(), key=lambda e: -e[1]):  # Kruskal's way
        if find(i) != find(j):
            root[find(i)] = find(j)
            best += v
    tree = m._tree()
    assert math.isclose(sum(weight[tuple(sorted((j, p)))] for j, p in enumerate(tree) if p >= 0), best, rel_tol=1e-9)


def test_first_step_of_em_counts_directly():
    m, votes = model()
    m.posterior = np.linspace(0.1, 0.9, len(votes))
    m.parent = [-1] * votes.shape[1]
    m._fit()
    for j in range(votes.shape[1]):
        for y in (0, 1):
            weight = [n * (p if y else 1 - p) for n, p in zip(m.n, m.posterior)]
            on = sum(x for x, v in zip(weight, votes[:, j]) if v)
            assert math.isclose(m.table[y, j, 0], (on + 0.1) / (sum(weight) + 0.2), rel_tol=1e-9)


# ---------------------------------------------------------------- secrets

ODD = ['password = "Tr0ub4dor3"', "apikey=0123456789abcdef0123", "token: x", "Authorization: Bearer abcdefghijklmnop",
       "secret=abc secret = defghijk1234567890== end", "a" * 40 + "1", "pwd=hunter2!", "é token='ñ' key_1234567890123456",
       "path /usr/lib/x1234567890abcdef/y.so", "", None, "AUTH_TOKEN=ghp_abcDEF123456789012345 next", "=" * 30 + "1" * 20]


def test_candidates_match_plain_python(spark):
    texts = ODD + [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pattern = regex.compile(secret_scan.CANDIDATE)
    assign = regex.compile(f"^{secret_scan.ASSIGN}$")
    for r in secret_scan.candidates(df).collect():
        t, want, end = r.text or "", [], 0
        matches = list(pattern.finditer(t))
        for k, m in enumerate(matches):
            before = t[end:m.start()]
            if k and assign.match(before):
                before = matches[k - 1].group() + before
            after = t[m.end():matches[k + 1].start() if k + 1 < len(matches) else len(t)]
            want.append((k, m.start(), m.group(), before[-secret_scan.NEAR:], after[:secret_scan.NEAR]))
            end = m.end()
        got = [(x.k, x.start, x.candidate, x.before, x.after) for x in r.found or []]
        assert got == want, t[:80]


def plain_features(c, before, after):
    n, low = len(c), c.lower()
    count = lambda p: sum(1 for _ in regex.finditer(p, c))
    near = lambda words: sum(len(regex.findall("(?i)" + "|".join(words), s)) for s in (before, after))
    pairs = sum(low[i:i + 2] in secret_scan.COMMON_PAIRS for i in range(n))
    left = regex.sub("|".join(sorted(secret_scan.DICTIONARY, key=len, reverse=True)), "", low)
    classes = [sum(map(test, c)) / n for test in (
        lambda x: "0" <= x <= "9", lambda x: "A" <= x <= "Z", lambda x: "a" <= x <= "z", lambda x: x in "+/_=-")]
    return {
        "length": n, "digits": classes[0], "upper": classes[1], "lower": classes[2], "marks": classes[3],
        "distinct": len(set(c)) / min(n, 64), "to_digit": count("[A-Za-z](?=[0-9])") / n,
        "from_digit": count("[0-9](?=[A-Za-z])") / n, "same": sum(a == b for a, b in zip(c, c[1:])) / n,
        "pairs": pairs / max(1, sum(x.isascii() and x.isalpha() for x in c)), "dictionary": 1 - len(left) / n,
        "hex": all(x in "0123456789abcdef" for x in c) or all(x in "0123456789ABCDEF" for x in c),
        "slashes": c.count("/"), "words_for": near(secret_scan.FOR_WORDS),
        "words_against": near(secret_scan.AGAINST_WORDS)}


def test_features_match_plain_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    found = secret_scan.candidates(df).select(F.explode("found").alias("x")).select("x.*")
    rows = secret_scan.with_features(found).collect()
    assert len(rows) > 8
    for r in rows:
        for name, want in plain_features(r.candidate, r.before, r.after).items():
            assert math.isclose(r[f"f_{name}"], float(want), abs_tol=1e-12), (name, r.candidate)


# ---------------------------------------------------------------- urls

@pytest.fixture(scope="module")
def url_tables(spark, tmp_path_factory):
    """Hosts with real effects: each level of the shrinkage decides somewhere."""
    rng, pages, labels = random.Random(6), [], []

    def host(name, n, rate, labelled=True):
        for _ in range(n):
            doc = len(pages)
            pages.append((doc, f"https://{name}/x/{doc}.html", b""))
            if labelled:
                labels.append((doc, 1, int(rng.random() < rate)))

    for i in range(12):
        host(f"good{i}.ok.com", 60, 0.02)
        host(f"bad{i}.spam.biz", 40, 0.9)
        host(f"mixed{i}.site{i}.info", 30, 0.1 + 0.07 * i)
        host(f"w{i}.farm{i}.top", 25, 0.85)
    host("new.spam.biz", 5, 0, labelled=False)     # judged by its domain
    host("new.ok.com", 5, 0, labelled=False)
    host("fresh.unseen.top", 5, 0, labelled=False)  # judged by its suffix
    host("tie.com", 10, 0.3)
    pages += [(None, None, None), (10**6, "no scheme", None), (10**6, "no scheme", None), (7, "http://bad0.spam.biz/x/7", None)]
    at = tmp_path_factory.mktemp("urls")
    spark.createDataFrame(pages, "page_id long, url string, html binary").write.parquet(str(at / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    return str(at)


def test_reputation_decides_as_the_sql_does(spark, url_tables):
    got = sorted((tuple(r) for r in queries.op5_url_reputation(spark, url_tables).select(
        "page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{url_tables}/{t}.parquet/*.parquet'")
    want = sorted((tuple(r) for r in con.sql(
        f"SELECT page_id, host, path, rule, verdict FROM ({queries.URL_SQL})").fetchall()), key=repr)
    assert got == want
    verdicts = {r[1]: r[4] for r in got}
    assert verdicts["bad3.spam.biz"] == verdicts["new.spam.biz"] == verdicts["fresh.unseen.top"] == "block"
    assert verdicts["good3.ok.com"] == verdicts["new.ok.com"] == verdicts["mixed0.site0.info"] == "allow"
