"""Lexical search against DuckDB, and its bounds against exact scores."""

import random

import duckdb
import numpy as np

from memberscope.llm import lexical_search as ls
from memberscope.llm.common import read
from memberscope.llm.oracle_sql import SEARCH_SQL


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def oracle(docs, items, k=50):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    return sorted((tuple(r) for r in con.sql(SEARCH_SQL.replace("r <= 50", f"r <= {k}")).fetchall()), key=repr)


def table(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "É9", "x_y", "漢字", "A"]
    pick = lambda: rng.choice(vocabulary[: 1 + int(rng.random() ** 3 * len(vocabulary))])
    return [(i, " ".join(pick() for _ in range(rng.randrange(words)))) for i in range(n)]


def test_terms():
    assert ls.terms_of("It's 3.5 ÄB-c_d\x7fe f\x00G") == [
        b"it", b"s", b"3", b"5", "Äb".encode(), b"c", b"d", "e f".encode(), b"g"]


def test_matches_sql_on_odd_tables(spark):
    docs = table(1, 400, 60)
    docs += [(None, "w1 w2 ärger w3"), (None, "w1 w2 ärger w3"), (3, docs[3][1]), (900, None), (901, ""),
             (902, " .,; "), (903, "w1 w2 " * 30_000), (904, "w50"), (905, "w50 w50 w50 w50 w50")]
    docs += [(1000 + i, "w7 w8 Ärger w59") for i in range(120)]  # more ties than places
    items = [(i, t) for i, t in table(2, 30, 25)] + [
        (5, "w50"), (5, "w50"), (None, "w7 w7"), (40, None), (41, ""), (42, "unseen words"), (43, "w0 W0 w1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS query", "map(1, 2) AS terms")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 AS rank", "3 AS score")
    want = oracle(docs, items)
    assert rows_of(ls.search(d.repartition(3), q)) == want
    assert rows_of(ls.search(d, q, query_block=7)) == want
    assert rows_of(ls.search(d, q, k=3)) == oracle(docs, items, 3)
    assert ls.search(d.limit(0), q).count() == 0 and ls.search(d, q.limit(0)).count() == 0


def test_matches_sql_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    want = oracle([tuple(r) for r in docs.select("doc_id", "text").collect()],
                  [tuple(r) for r in items.select("item_id", "text").collect()])
    assert rows_of(ls.search(docs, items)) == want


def test_bounds_hold_and_exclude():
    """No bound lies below the exact score, and most documents are never
    scored."""
    from collections import Counter
    docs = [(i, ls.terms_of(t)) for i, t in table(3, 3000, 80) if t]
    items = [ls.terms_of(t) for _, t in table(4, 20, 12)]
    terms = {}
    wanted = [sorted({terms.setdefault(t, len(terms)) for t in words}) for words in items]
    n, total = len(docs), sum(len(w) for _, w in docs)
    holders = Counter(t for _, w in docs for t in set(w))
    q = ls.Queries(terms, wanted, n, total, np.array([ls.weight_of(n, holders[t]) for t in terms]))
    search = ls.Search(q, 5)
    block, pairs = ls.Block(4096), 0
    for i, words in docs[:1000]:
        counts = Counter(words)
        block.add(i, len(words), max(counts.values()), {terms[t]: c for t, c in counts.items() if t in terms},
                  [ls._hash((t, lv)) for lv in ls.LEVELS for t, c in counts.items() if c >= lv])
    held = [Counter(words) for _, words in docs[:1000]]
    names = {i: t for t, i in terms.items()}
    norms = [ls.length_norm(x, n, total) for x in block.lengths]
    reach = [np.array([ls.gain_of(min(p, after - 1), m) for p, m in zip(block.peaks, norms)], float)
             for after in (2, 4, 1 << 40)]
    gains = [reach[0], reach[1] - reach[0], reach[2] - reach[1]]
    for members, used, weights in search.groups:
        bound = search.bounds(block, block.signature(), used, weights, gains)
        for row, item in enumerate(members):
            for c in range(len(block.ids)):
                exact = sum(int(q.weights[t]) * ls.gain_of(held[c][names[t]], norms[c])
                            for t in wanted[item] if held[c][names[t]])
                assert bound[row, c] >= exact
                pairs += 1
    search.scan(block)
    assert search.scored < pairs / 4
