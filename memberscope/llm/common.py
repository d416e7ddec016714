"""Helpers shared by the operators: table reading, shipping this package to
the Python workers, bounded per-worker caches and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.session import scratch_path

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Spark's own default, which a session that was never told otherwise shows.
ARROW_DEFAULT = "10000"
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of the folder, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as
    ``--py-files`` would, so that Python workers can import it wherever they
    start; and keep Arrow batches of long texts small, unless the cluster's
    configuration or the session sizes them (results do not depend on it)."""
    sc = spark.sparkContext
    if not sc.getConf().contains(ARROW_ROWS) and spark.conf.get(ARROW_ROWS) == ARROW_DEFAULT:
        spark.conf.set(ARROW_ROWS, "1000")
    if getattr(sc, "_memberscope_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="memberscope-py-"), "memberscope_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(PACKAGE_ROOT):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(PACKAGE_ROOT)))
    sc.addPyFile(path)
    sc._memberscope_shipped = True


def scratch_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage
    ends at a table that every executor can reach, and the planner knows its
    size."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: Keys longer than this are worked out each time: they rarely come back.
LONG_KEY = 128


class Memo(dict):
    """A bounded cache of ``compute(key)``: two generations of at most
    ``limit`` entries each, and of keys of at most ``LONG_KEY`` characters. A
    full generation becomes the old one, from which entries still in use move
    over, so frequent keys stay cached and memory never exceeds two
    generations of short entries."""

    def __init__(self, compute: Callable, limit: int = 100_000):
        super().__init__()
        self._compute, self._limit, self._old = compute, limit, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
            if len(key) > LONG_KEY:
                return value
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value
