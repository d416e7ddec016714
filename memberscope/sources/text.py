"""Text-line sources for the hot-word product.

A line source is a DataFrame with one string column ``line``. It comes either
from text files (``spark.read.text``, splittable, one row per line) or from a
text column of a table, split into its lines on the executors. Whole texts are
always used: every line of every document becomes a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# A line ends at \r\n, \n or \r, as in Hadoop's line reader.
LINE_BREAK = r"\r\n|\n|\r"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files (local, HDFS, object store) as one row per line."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def split_lines(text: Column) -> Column:
    """Array of the lines of ``text``.

    A line break at the very end closes the last line and does not open an
    empty one, like a text file that ends with a newline.
    """
    body = F.regexp_replace(text, r"(\r\n|\n|\r)\z", "")
    return F.split(body, LINE_BREAK, -1)


def text_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Every line of every text in ``df`` as a row ``line``.

    ``explode`` keeps the lines of a document in the task that read it, so a
    long document costs one task's CPU but never a shuffle of its lines.
    """
    texts = df.select(text_col).where(F.col(text_col).isNotNull())
    return texts.select(F.explode(split_lines(F.col(text_col))).alias("line"))
