"""The training-data operators against the libraries, brute force and DuckDB."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from memberscope.llm import (bpe, jaccard_join, line_quality, packing, queries, secret_scan,
                             token_counts, token_files, token_ids, topk_search, toxicity, word_bpe)
from memberscope.llm.common import read

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels")
ODD = ["", None, " ", "a", "  two  spaces ", "x\n\ny\t z", "<|endoftext|> in <|startoftext|>text",
       "Straße ΣΑΣ İx é", "it's 'LL we're 123 !!!", "\x1c\x1f odd\x85", "漢字😀 " * 40]


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Null ids, repeated rows, odd texts and clashing extra columns."""
    rows = [(i, t, "en", "s", 1, 7, 8) for i, t in enumerate(ODD)]
    rows += [(None, "null id text", None, None, None, 7, 8), (3, "a", "en", "s", 1, 7, 8),
             (50, "long words " * 20_000, "en", "s", 1, 7, 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long, start long, row long")


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def test_heap_merge_counts_merges():
    ranks = {("a", "b"): 0, ("ab", "c"): 1, ("b", "c"): 2}
    assert bpe.merge_by_heap(list("abcab"), ranks) == (["abc", "ab"], 3)
    assert bpe.merge_by_heap([], ranks) == ([], 0)


def test_token_counts_match_the_library(spark, odd_docs, byte_tokenizer):
    for docs in (odd_docs, read(spark, SF, "documents")):
        got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                     for r in token_counts.token_counts(docs).collect())
        want = []
        for d, t in texts(docs):
            n = len(byte_tokenizer.encode(t, add_special_tokens=False).ids)
            want.append((d is None, d, len(t.encode()), n, n > 512))
        assert got == sorted(want)


def test_word_bpe_matches_the_library(spark, odd_docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    code = word_bpe.codec(public_tokenizers.path("word_bpe_49k.json"))
    for docs in (odd_docs, read(spark, SF, "documents")):
        for _, t in texts(docs):
            ids = library.encode(t, add_special_tokens=False).ids
            packed, decoded = code(t)
            assert np.frombuffer(packed, "<u4").tolist() == ids
            assert decoded == library.decode(ids, skip_special_tokens=False) == code.decode(ids)
    assert word_bpe.encode_digest(odd_docs).count() == odd_docs.count()


def ids_with_end(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")


def test_token_files_round_trip(spark, odd_docs, byte_tokenizer, tmp_path):
    docs = read(spark, SF, "documents")
    got = token_files.token_files(docs, str(tmp_path / "t")).orderBy("doc_id").collect()
    start = 0
    for r, (d, t) in zip(got, sorted(texts(docs)), strict=True):
        ids = ids_with_end(byte_tokenizer, t)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids), zlib.crc32(ids))
        start += len(ids)
    index = spark.read.parquet(str(tmp_path / "t" / "index"))
    assert token_files.shuffled(index, 1).count() == len(got)
    assert token_files.token_files(odd_docs, str(tmp_path / "o")).count() == odd_docs.count()
    assert token_files.token_files(odd_docs.limit(0), str(tmp_path / "e")).count() == 0


def test_damaged_records_are_refused():
    data = token_files.frame(7, b"\x01\x00\x02\x00") + token_files.frame(None, b"")
    assert [(d, bytes(p)) for _, _, d, p in token_files.unframe(memoryview(data))] == [
        (7, b"\x01\x00\x02\x00"), (None, b"")]
    for at in (0, 9, 14, 23, len(data) - 3):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(token_files.unframe(memoryview(bytes(bad))))
    with pytest.raises(ValueError):
        list(token_files.unframe(memoryview(data[:-4])))


def test_packing_covers_every_id_once(spark, odd_docs, byte_tokenizer):
    for docs in (odd_docs, read(spark, SF, "documents")):
        rows = packing.pack(docs).collect()
        by_doc = {}
        for r in rows:
            by_doc.setdefault(r.doc_id, []).append(r)
        for d, t in texts(docs):
            ids = ids_with_end(byte_tokenizer, t)
            for r in by_doc[d]:
                if r.doc_tokens == len(ids):
                    assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length])
        total = sum(len(ids_with_end(byte_tokenizer, t)) for _, t in texts(docs))
        assert sum(r.length for r in rows) == total
        sequences = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= packing.CAPACITY
    layout = packing.pack(docs)
    assert packing.packed_sequences(docs, layout).agg({"n_tokens": "sum"}).first()[0] == total


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(1)
    lengths = sorted(rng.integers(1, 100, 300).tolist(), reverse=True)
    rooms, want = [], []
    for n in lengths:
        b = next((i for i, room in enumerate(rooms) if room >= n), len(rooms))
        if b == len(rooms):
            rooms.append(100)
        want.append((b, 100 - rooms[b]))
        rooms[b] -= n
    assert packing.first_fit_decreasing(lengths, 100) == want


def test_topk_matches_brute_force_on_odd_vectors(spark):
    rng = np.random.default_rng(2)
    vecs = {i: rng.normal(0, 1 + i % 7, 6).tolist() for i in range(400)}
    vecs.update({i: vecs[400 % 399] for i in range(400, 500)})  # a third alike: ties
    rows = [(i, v) for i, v in vecs.items()] + [(0, vecs[0]), (900, None), (950, [1.0, None]),
                                                (951, [float("nan")] * 6), (None, vecs[1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.topk_inner_products(
        table, query_block=4).collect())
    # the repeated row is a query and a candidate of its own
    usable = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows[:-4]]
    want = []
    for k, (q, x) in enumerate(usable):
        if q % 50 == 0:
            best = sorted((-int(x @ v), i) for j, (i, v) in enumerate(usable) if j != k)[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want) and len(got) == 55
    assert topk_search.topk_inner_products(table.limit(0)).count() == 0


def brute_components(rows, size=4, percent=85):
    sets = {}
    for d, t in rows:
        w = t.encode().lower().split()
        sets[d] = ({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size
                   else ({tuple(w)} if w else set()))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_jaccard_components_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 400, 60)]
    rows = [(d, t) for d, t in texts(read(spark, SF, "documents"))][:120]
    for i in range(120):  # a chain of near copies around the threshold
        words = list(base)
        for at in rng.integers(0, 60, rng.integers(0, 3)):
            words[at] = f"x{rng.integers(0, 9)}"
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000, ""), (2001, "one"), (2002, "ONE"), (2003, "one two"), (2004, "\x0b \t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.component_ids(docs).collect()}
    assert got == brute_components(rows)


def test_jaccard_edge_rows(spark, odd_docs):
    out = jaccard_join.component_ids(odd_docs)
    assert out.count() == odd_docs.count()
    assert out.where("doc_id is null and component_id is not null").count() == 0
    assert jaccard_join.component_ids(odd_docs.limit(0)).count() == 0
    assert jaccard_join.one_per_component(odd_docs).columns == odd_docs.columns


def test_divide_skip_counts_exactly():
    rng = np.random.default_rng(4)
    query = np.unique(rng.integers(0, 300, 150).astype(np.uint64))
    sets = [np.unique(rng.integers(0, 300, 200).astype(np.uint64)) for _ in range(80)]
    for t in (1, 40, 70, 90):
        want = [i for i, s in enumerate(sets) if len(np.intersect1d(query, s)) >= t]
        assert jaccard_join.divide_skip(query, sets, [t] * len(sets)) == want


def test_line_quality_keeps_first_holder_and_columns(spark, odd_docs):
    body = [(i, f"a shared footer line of many words here\nbody {i} " + " ".join(
        f"u{i}w{k}" for k in range(30)), "s") for i in range(100)]
    body += [(i, "a shared footer line of many words here\ntwo words", "s") for i in range(100, 105)]
    docs = spark.createDataFrame(body, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in line_quality.line_quality(docs).collect()}
    assert all(kept[i] for i in range(100)) and not any(kept[i] for i in range(100, 105))
    clean = {r.doc_id: r.text for r in line_quality.clean_documents(docs).collect()}
    assert sorted(clean) == list(range(100)) and "footer" in clean[0] and "footer" not in clean[7]
    assert line_quality.line_quality(odd_docs).count() == odd_docs.count()
    assert line_quality.clean_documents(odd_docs).columns == odd_docs.columns
    assert line_quality.line_quality(odd_docs.limit(0)).count() == 0


def test_secrets_found_and_masked(spark, odd_docs):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = [(1, f'set token = "{key}" now'), (2, f"commit {key} by someone"), (3, "no secrets at all"),
            (4, f'{key} first, token = "{key}" and again token = "{key}"'), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_scan.scan(docs).collect()
    for r in found:
        text = dict(rows)[r.doc_id]
        assert text[r.start:r.start + r.length] == key
    assert {r.doc_id: r.is_secret for r in found if r.doc_id < 3} == {1: True, 2: False}
    masked = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert masked[1] == 'set token = "[SECRET]" now' and masked[2] == rows[1][1]
    assert masked[4].count("[SECRET]") >= 2 and masked[5] is None
    assert secret_scan.redact(odd_docs).columns == odd_docs.columns
    assert secret_scan.scan(odd_docs.limit(0)).count() == 0


def test_secrets_in_assignments(spark):
    key, mixed = "04dbebab91ab85687d33eeaaf9ac699e", "aB3xK9mQ2vL7pR4tY8wN6zC1sD5fG0hJ7kE2"
    cases = [('password = "{}"', "Tr0ub4dor3x"), ('secret = "{}"', "abcdefghijKLMNOPqrstuvwx"),
             ("see apikey={}&x=1", key), ("password={} ", mixed[:18]),
             ("export AUTH_TOKEN={}", "ghp_" + mixed), ("AUTH_TOKEN_PROD_EU_1={}", "ghp_" + mixed),
             ("api_key={}", mixed + "q=="), ("Authorization: Bearer {} ", "QwErabcXyZtyUiKlMnopRsTvWx")]
    rows = [(i, t.format(v)) for i, (t, v) in enumerate(cases)]
    rows += [(100, "password: please enter it again"), (101, f"commit={key}{key[:8]} by someone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_scan.scan(docs).collect()
    for i, (t, v) in enumerate(cases):
        at = [(r.start, r.length, r.is_secret) for r in found if r.doc_id == i and r.is_secret]
        assert at == [(t.index("{"), len(v), True)], (t, at)
    assert not any(r.is_secret for r in found if r.doc_id >= 100)
    assert any(r.doc_id == 101 and r.start == 7 for r in found)
    masked = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert masked == dict(rows) | {i: t.format("[SECRET]") for i, (t, _) in enumerate(cases)}


def test_toxicity_held_out_accuracy(spark, odd_docs):
    sf = "/root/testdata/sf0.1"
    labels = read(spark, sf, "labels")
    out = toxicity.toxicity(read(spark, sf, "documents"), labels)
    judged = out.join(labels, "doc_id").where("held_out").select("predicted", "toxic").toPandas()
    assert ((judged.predicted == 1) & (judged.toxic == 1)).sum() >= 0.9 * judged.toxic.sum()
    assert ((judged.predicted == 1) & (judged.toxic == 0)).sum() <= 0.06 * (judged.toxic == 0).sum()
    none = labels.limit(0)
    assert toxicity.toxicity(odd_docs, none).count() == odd_docs.count()
    assert toxicity.clean_documents(odd_docs, none).columns == odd_docs.columns
    assert toxicity.toxicity(odd_docs.limit(0), none).count() == 0


def test_toxicity_sample_drops_only_copies(spark):
    rows = [(i, f"shared opening words {chr(97 + i // 26) * 6}{chr(97 + i % 26) * 3} own") for i in range(200)]
    rows += [(1000 + i, t + " own shared") for i, t in rows]  # the same stem sets
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    kept = sorted((r.toxic, frozenset(r.text.split())) for r in toxicity.labelled_sample(
        docs, labels).collect())
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    want = {(i % 2, frozenset(t.split())) for i, t in train}
    assert len(kept) == len(want) and set(kept) == want
    assert toxicity.labelled_sample(docs, labels, 50).count() <= 50


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_urls_without_hosts(spark):
    pages = spark.createDataFrame(
        [(1, None, "h"), (2, "no scheme/en/", "h"), (None, "http://A.Example.NET/en/1?x", "h"),
         (4, "https://x.net", "h"), (5, "https://x.net/", "h"), (5, "https://x.net/", "h")],
        "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    from memberscope.llm import url_reputation
    rows = url_reputation.judge_urls(pages, queries.page_outcomes(labels), queries.page_key()).collect()
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in rows)
    assert got == [("1", "", "", "None", "allow"), ("2", "", "", "None", "allow"),
                   ("4", "x.net", "", "None", "allow"), ("5", "x.net", "/", "net/", "block"),
                   ("5", "x.net", "/", "net/", "block"),
                   ("None", "a.example.net", "/en/1", "example.net/en/", "allow")]


def test_pipeline_runs_and_keeps_columns(spark):
    import corpus_pipeline
    docs = read(spark, SF, "documents")
    columns, seen = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        assert 0.5 * seen < docs.count() <= seen
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert token_ids.id_dtype(public_tokenizers.path("byte_bpe_50k.json")) == "<u2"
    assert isinstance(docs.schema["doc_id"].dataType, T.LongType)
