"""Hot words (A11): one field of each delimited line, counted, top k.

Plan: scan → split/explode inside the scan stage → partial count per word
(map-side combine, so a word on a third of all lines sends one row per task)
→ one shuffle on word → final count → ``TakeOrderedAndProject`` (each task
keeps its own top k, the driver merges k rows per task). No global sort.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_of(line_col: str, sep: str, field: int):
    """Field ``field`` (0-based) of the line split on the literal ``sep``.

    Empty fields are kept, so a line of separators only gives the empty word
    and an empty line gives the empty word. A line with fewer fields gives
    NULL (not counted). The split stops after the wanted field (the rest of
    the line stays one piece), so long lines are not cut up needlessly.
    """
    parts = F.split(F.col(line_col), re.escape(sep), field + 2)
    return F.get(parts, F.lit(field))


def word_counts(lines: DataFrame, sep: str = "\t", field: int = 0,
                line_col: str = "line") -> DataFrame:
    """``word, count`` for every distinct word."""
    w = field_of(line_col, sep, field)
    # Lines without the field form one NULL group, dropped after counting.
    return (lines.select(w.alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("word").isNotNull()))


def hot_words(lines: DataFrame, sep: str = "\t", field: int = 0, k: int = 10,
              line_col: str = "line") -> DataFrame:
    """The ``k`` most frequent words: ``word, count``; ties broken by word."""
    return (word_counts(lines, sep, field, line_col)
            .orderBy(F.col("count").desc(), F.col("word").asc())
            .limit(k))
