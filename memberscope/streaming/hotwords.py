"""Hot words (A11) over a stream of text lines, e.g. a search log whose files
keep arriving.

The batch operator is reused unchanged: a word count is a streaming
aggregation, and sorting with a limit is allowed on it in complete output
mode. The state is one count per distinct word (bounded by the vocabulary,
not by the lines), kept in the checkpoint under ``spark.checkpoint.dir`` so a
restarted query continues the counts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from memberscope.operators.hotwords import hot_words
from memberscope.session import checkpoint_dir


def read_line_stream(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files under ``path`` as a stream of rows ``line``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withColumnRenamed("value", "line")


def start_hot_words(lines: DataFrame, name: str, sep: str = "\t", field: int = 0,
                    k: int = 10, available_now: bool = False) -> StreamingQuery:
    """Keep the top ``k`` words of the stream in the in-memory table ``name``
    (complete mode: the table always holds the current top k)."""
    spark = lines.sparkSession
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    w = (hot_words(lines, sep=sep, field=field, k=k).writeStream
         .outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", ckpt))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
