"""Cases in which rows or characters were once lost, and tables on which an
operator used to stop."""

import random
import unicodedata
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from memberscope.llm import (bpe, jaccard_join, line_quality, packing, queries, secret_scan, token_counts,
                             token_files, token_ids, topk_search, toxicity, word_bpe)

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
def _tested(c: int) -> bool:
    """Every character that some Unicode version assigns, of the large uniform
    blocks (ideographs, Hangul, private use) the ends; a part of the rest."""
    if 0xD800 <= c <= 0xDFFF:
        return False
    if c % 199 == 0 or any(abs(c - end) < 3 for end in BLOCK_ENDS):
        return True
    uniform = 0x3400 <= c <= 0x9FFF or 0xAC00 <= c <= 0xD7A3 or 0xE000 <= c <= 0xF8FF or c >= 0x17000
    return (not uniform or 0x1AFF0 <= c <= 0x1FFFF) and (
        unicodedata.category(chr(c)) != "Cn" or not regex.match(r"\p{Cn}", chr(c)))


BLOCK_ENDS = (0x3400, 0x4DB5, 0x4E00, 0x9FA5, 0x9FFF, 0xAC00, 0xD7A3, 0xE000, 0xF8FF, 0x17000, 0x187F7, 0x18D80,
              0x18DF2, 0x20000, 0x2A6DF, 0x31350, 0xE0100, 0x10FFFF)
POINTS = [c for c in range(0x110000) if _tested(c)]


def compare(texts, count_too=True):
    byte, word = bpe.library(BYTE), bpe.library(WORD)
    encode, count, code = token_ids.encoder(BYTE), token_counts.counter(BYTE), word_bpe.codec(WORD)
    for text, b, w in zip(texts, byte.encode_batch(texts, add_special_tokens=False),
                          word.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encode(text), "<u2").tolist() == b.ids, repr(text)
        assert not count_too or count(text) == len(b.ids), repr(text)
        packed, decoded = code(text)
        assert np.frombuffer(packed, "<u4").tolist() == w.ids, repr(text)
        assert decoded == word.decode(w.ids, skip_special_tokens=False)


def test_every_code_point_as_the_library():
    """Alone before a contraction, between letters and before a digit."""
    for at in range(0, len(POINTS), 64):
        compare(["".join(f"{c}'re a{c}B {c}1\n" for c in map(chr, POINTS[at:at + 64]))], False)


def test_mixed_marks_and_spaces_as_the_library():
    rng = random.Random(9)
    odd = [chr(c) for c in (0x345, 0x8CB, 0x300, 0x327, 0x5B0, 0x209E, 0x58C, 0x1C89, 0x558, 0xA7CB, 0x130, 0x3A3,
                            0x85, 0xA0, 0x2028, 0x180E, 0x200B, 0x1C, 0x1F, 0x10D50, 0x1100, 0x1161, 0xFEFF, 0x1F600)]
    plain = ["a", "É", "ж", "漢", " ", " ", "\n", "'re", "'", "1", "!", "한"]
    compare(["".join(rng.choice(odd if rng.random() < 0.35 else plain) for _ in range(rng.randrange(1, 14)))
             for _ in range(6_000)])


def test_toxicity_without_hits_labels_or_texts(spark):
    plain = [(i, f"plain text number {i} about gardens") for i in range(30)]
    schema = "doc_id long, text string"
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels = lambda kind: spark.createDataFrame([(i, 1, kind) for i in range(30)],
                                                "doc_id long, quality int, toxic int")
    tables = [(spark.createDataFrame(plain, schema), labels(0)), (spark.createDataFrame(plain, schema), no_labels),
              (spark.createDataFrame([(i, None) for i in range(5)], schema), labels(1)),
              (spark.createDataFrame([], schema), labels(0))]
    for docs, marks in tables:
        rows = toxicity.toxicity(docs, marks).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.clean_documents(*tables[0]).count() == 30


def test_stages_with_a_map_column(spark):
    secret = 'password = "Tr0ub4dor3xYz99"'
    rows = [(i, f"shared line of the host\nown words " + " ".join(f"w{i}x{k}" for k in range(14)) + " " + secret,
             "en", "s", 9) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                                 ).withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    cleaned = line_quality.clean_documents(docs, min_docs=20, long_docs=4)
    assert cleaned.columns == docs.columns and cleaned.count() == 30
    assert {r.extra["k"] for r in cleaned.collect()} == set(range(30))
    masked = secret_scan.redact(docs)
    assert masked.where("text like '%[SECRET]%'").count() == 30
    assert {r.extra["k"] for r in masked.collect()} == set(range(30))


def test_one_row_per_component(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " w60"
    rows = [(5, text), (5, text), (3, near), (3, near), (3, text), (9, near), (None, text), (None, text),
            (None, "other"), (1, "alone words"), (1, "alone words"), (2, ""), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "m", F.create_map(F.lit("a"), F.lit(1)))
    got = sorted(((r.doc_id, r.text) for r in jaccard_join.one_per_component(docs, 5, 80).collect()), key=repr)
    kept = [g for g in got if g[0] is not None]
    assert [g[0] for g in kept] == [1, 2, 3] and kept[2][1] in (text, near)
    assert sorted(g[1] for g in got if g[0] is None) == ["other", text]


@pytest.mark.parametrize("block", [16_384, 3])
def test_topk_keeps_every_row(spark, block):
    rng = random.Random(4)
    rows = [(0, [1, 2]), (0, [5, 5]), (1, []), (2, [3, 1]), (50, [-1, 1]), (50, []), (None, [9, 9]), (7, None),
            (8, [1.0, None]), (9, [float("nan"), 1.0]), (100, [5, 5]), (100, [5, 5])]
    rows = [(i, v if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    rows += [(rng.randrange(200), [rng.uniform(-2, 2), rng.uniform(-2, 2)]) for _ in range(150)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk_search.topk_inner_products(table, query_block=block).select(
        "query_id", "rank", "vec_id", "score").collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert got == sorted(tuple(r) for r in con.sql(queries.TOPK_SQL).fetchall())


def test_packing_spreads_equal_rows(spark):
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    groups = packing.pack(docs, group_docs=500).groupBy(F.expr("shiftright(sequence_id, 32)").alias("g")).count()
    sizes = [r["count"] for r in groups.collect()]
    assert len(sizes) == 40 and max(sizes) < 700 and sum(sizes) == 20_000


def test_files_are_ordered_by_number_and_read_by_offset(spark, tmp_path):
    index = spark.createDataFrame(
        [("part-99999-x", 99_999, 0, 0, 1, 1, 0, 5, 1), ("part-100000-x", 100_000, 0, 0, 1, 2, 0, 7, 2),
         ("part-00001-x", 1, 0, 0, 1, 0, 0, 3, 3), ("part-4096-x", 4096, 0, 0, 1, 0, 0, 2, 4)], token_files.RECORDS)
    assert [(r.doc_id, r.start) for r in token_files.with_starts(index).orderBy("start").collect()] == [
        (0, 0), (0, 3), (1, 5), (2, 10)]
    name = token_files.part_number(F.col("f"))
    assert [r[0] for r in spark.createDataFrame([("part-100000-1b.txt",), ("part-00007-c000.txt",)], "f string")
            .select(name).collect()] == [100_000, 7]


def test_equal_rows_spread_over_files_and_records_are_cut_out(spark, tmp_path):
    text = "some words of a text that repeats " * 30
    rows = [(4, text)] * 300 + [(None, "no id"), (1, None), (2, "é <|endoftext|>"), (9, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "records")
    token_files.write_records(docs, path, file_text_bytes=32 << 10)
    index = token_files.build_index(spark, path, str(tmp_path / "index"))
    files = [r["count"] for r in index.groupBy("file").count().collect()]
    assert len(files) >= 8 and max(files) < 100
    byte = bpe.library(BYTE)
    picks = token_files.shuffled(index, 3).where("pmod(place, 3) = 0")
    cut = {(r.file, r.offset): r for r in token_files.records_at(spark, path, picks).collect()}
    wanted = {(d, zlib.crc32(np.array(byte.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))) for d, t in rows}
    assert len(cut) == picks.count() > 50
    for r in picks.collect():
        found = cut[r.file, r.offset]
        crc = zlib.crc32(np.array(found.ids, "<u4"))
        assert (found.doc_id, crc) == (r.doc_id, r.ids_crc32) and (found.doc_id, crc) in wanted
    starts = token_files.with_starts(index).orderBy("start").collect()
    assert [r.doc_id for r in starts] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(starts, starts[1:]))
