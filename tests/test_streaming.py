"""The streaming daily counts agree with the batch product on the same
records."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from memberscope.operators import growth
from memberscope.sources.tables import read_table, registrations
from memberscope.streaming.daily import (read_stream, start_daily_counts,
                                         stream_daily_counts)


def test_stream_daily_counts_match_batch(spark):
    events = read_table(spark, SF_SMALL, "events")
    stream = read_stream(spark, SF_SMALL, events.schema, file_glob="events.parquet")
    counts = stream_daily_counts(registrations(stream), "create_time", "id", "regCount",
                                 lateness="1 day")
    # A fresh name per run: a query name is also its checkpoint, which a
    # restarted query resumes from.
    name = f"reg_daily_{uuid.uuid4().hex[:8]}"
    q = start_daily_counts(counts, name, sink="memory")
    try:
        q.processAllAvailable()
        got = sorted(rows(spark.table(name)))
    finally:
        q.stop()
    want = sorted(rows(growth.daily_counts(registrations(events), "create_time", "id",
                                           "2023-12-01", "2024-03-01", "regCount")))
    assert got == want and len(got) == 30


def test_stream_checkpoint_is_under_shared_folder(spark):
    events = read_table(spark, SF_SMALL, "events")
    stream = read_stream(spark, SF_SMALL, events.schema, file_glob="events.parquet")
    counts = stream_daily_counts(stream.where(F.col("event_type") == "purchase"),
                                 "ts", "event_id", "orderCount", lateness="1 day")
    name = f"order_daily_{uuid.uuid4().hex[:8]}"
    q = start_daily_counts(counts, name, sink="memory")
    try:
        q.processAllAvailable()
        ckpt = spark.conf.get("spark.checkpoint.dir")
        assert q.lastProgress is not None
        n = spark.table(name).agg(F.sum("orderCount")).first()[0]
    finally:
        q.stop()
    assert n == events.where(F.col("event_type") == "purchase").count()
    assert ckpt


def test_stream_hot_words_match_batch(spark, tmp_path):
    from memberscope.operators.hotwords import hot_words
    from memberscope.sources.text import read_lines
    from memberscope.streaming.hotwords import read_line_stream, start_hot_words
    d = tmp_path / "log"
    d.mkdir()
    (d / "a.txt").write_text("apple\tx\npear\tq\napple\n\t\t\n", encoding="utf-8")
    (d / "b.txt").write_text("kiwi\tz\napple\tz\npear\n", encoding="utf-8")
    name = f"hot_{uuid.uuid4().hex[:8]}"
    q = start_hot_words(read_line_stream(spark, str(d), max_files_per_trigger=1), name, k=3)
    try:
        q.processAllAvailable()
        got = rows(spark.table(name))
    finally:
        q.stop()
    want = rows(hot_words(read_lines(spark, str(d)), k=3))
    assert got == want == [("apple", 3), ("pear", 2), ("", 1)]


def test_date_normalisation_on_a_stream(spark, tmp_path):
    from memberscope.operators.calendar_jobs import normalize_dates
    from memberscope.streaming.hotwords import read_line_stream
    d = tmp_path / "dates"
    d.mkdir()
    (d / "a.txt").write_text("2019-11-30\n2019/11/30 10:05\nnope\n", encoding="utf-8")
    name = f"dates_{uuid.uuid4().hex[:8]}"
    out = normalize_dates(read_line_stream(spark, str(d)), "line", prefix="d")
    q = (out.writeStream.format("memory").queryName(name).outputMode("append").start())
    try:
        q.processAllAvailable()
        got = sorted(rows(spark.table(name), "line", "d_style"), key=repr)
    finally:
        q.stop()
    assert got == sorted([("2019-11-30", "yyyy-MM-dd"), ("2019/11/30 10:05", "yyyy/MM/dd HH:mm"),
                          ("nope", None)], key=repr)
