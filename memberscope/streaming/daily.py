"""Daily counts (A8, A9) over a stream of records.

The batch products answer "how many registrations / orders per day" for a
fixed window. Over an event stream the same product is a 1-day event-time
window with a watermark: late records within the allowed lateness still land
in their day, older ones are dropped, and the state of closed days is freed.
The checkpoint (offsets and state) lives in the shared folder named by
``spark.checkpoint.dir``, so a restarted or re-scheduled query resumes where
it stopped after a lost executor or driver.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from memberscope.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType,
                fmt: str = "parquet", file_glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream (new files under ``path`` become new records)."""
    r = spark.readStream.format(fmt).schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_daily_counts(records: DataFrame, ts: str, id_col: str,
                        count_name: str = "count", *,
                        lateness: str) -> DataFrame:
    """Streaming ``day, count_name``: ``count(id)`` per calendar day of
    ``ts``. ``lateness`` (as ``"2 days"``; no default, because later records
    are dropped and then missing against the batch count) bounds how late a
    record may arrive and how long a day's state is kept; the query's progress
    reports the dropped rows (``numRowsDroppedByWatermark``)."""
    # Event time must be TIMESTAMP for a watermark. A wall-clock
    # TIMESTAMP_NTZ is taken as UTC (whatever the session zone), windows are
    # UTC days, and each is labelled with its UTC date: the same days as the
    # batch products.
    if records.schema[ts].dataType.typeName() == "timestamp_ntz":
        zone = records.sparkSession.conf.get("spark.sql.session.timeZone")
        records = records.withColumn(
            ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    w = F.window(F.col(ts), "1 day")
    day = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.col("w.start")),
                        "yyyy-MM-dd")
    return (records.withWatermark(ts, lateness)
            .groupBy(w.alias("w"))
            .agg(F.count(id_col).alias(count_name))
            .select(day.alias("day"), count_name))


def start_daily_counts(counts: DataFrame, name: str, sink: str = "memory",
                       path: str | None = None, mode: str | None = None,
                       available_now: bool = False) -> StreamingQuery:
    """Start the query. ``sink='memory'`` keeps a queryable table ``name``
    (complete mode, for small results and tests); a file format such as
    ``parquet`` writes each closed day once (append mode) to ``path``."""
    spark = counts.sparkSession
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    mode = mode or ("complete" if sink == "memory" else "append")
    w = (counts.writeStream.outputMode(mode).format(sink)
         .option("checkpointLocation", ckpt))
    if sink == "memory":
        w = w.queryName(name)
    elif path:
        w = w.option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
