"""A ledger of source files: which keys (days, members, orders) each file of a
table holds, so that a refresh finds the keys whose rows changed without
reading the unchanged files.

Two tables of appended versions below one folder:

``keys/version=N``   (source, file, stamp, key) of the files added by version N
``files/version=N``  (source, file, stamp, added) of the files added or removed

A file is told by its path and its stamp (modification time and size), both
from Spark's file metadata; a rewritten file counts as removed and added. The
keys of a removed file come from the ledger, those of a new one from a scan of
that file alone. A version counts once its ``files`` part is complete, and that is
written last (``commit``), after the refresh has stored its own results: a
refresh that dies is found again by the next one, which starts from the same
differences.

Keys are kept as text. A row whose key is null belongs to no key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.session import stored_table

FILES = "source string, file string, stamp string, added boolean, version int"
KEYS = "source string, file string, stamp string, key string, version int"


def file_columns() -> list[Column]:
    meta = F.col("_metadata")
    return [meta.file_path.alias("file"), meta.file_modification_time.alias("modified"), meta.file_size.alias("bytes")]


def stamp() -> Column:
    """Text is made once per file, not per row."""
    return F.concat_ws("/", F.col("modified").cast("string"), F.col("bytes").cast("string")).alias("stamp")


@dataclass
class Changes:
    """What a refresh has to look at: per source the changed ``keys``, and
    what ``commit`` will record."""

    keys: dict[str, DataFrame]
    version: int
    files: DataFrame
    new_keys: DataFrame


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return self.spark.createDataFrame([], schema)
            raise

    def files(self) -> DataFrame:
        """source, file, stamp of the files the ledger knows."""
        last = self._read("files", FILES).groupBy("source", "file", "stamp").agg(
            F.max_by("added", "version").alias("added"))
        return last.where("added").drop("added")

    def _scratch(self, df: DataFrame, name: str) -> DataFrame:
        return stored_table(self.spark, df, f"ledger-{name}")

    def changes(self, sources: dict[str, tuple[DataFrame, Column]]) -> Changes:
        """Differences between the ledger and the tables of ``sources`` (name
        -> table read from files, key of a row)."""
        known = self.files()
        version = (self._read("files", FILES).agg(F.max("version")).first()[0] or 0) + 1
        current = None
        for name, (table, _) in sources.items():
            # only file metadata: no column is read
            part = table.select(*file_columns()).distinct().select(
                F.lit(name).alias("source"), "file", stamp(), "modified", "bytes")
            current = part if current is None else current.unionByName(part)
        known = known.where(F.col("source").isin(*sources))
        on = ["source", "file", "stamp"]
        files = current.withColumn("now", F.lit(True)).join(
            known.withColumn("was", F.lit(True)), on, "full").where("now is null or was is null").select(
            *on, F.col("now").isNotNull().alias("added"), "modified", "bytes")
        # a file's number stands for its path and stamp until the keys are
        # recorded: they would outweigh the keys in every exchange
        numbered = self._scratch(files.withColumn("no", F.monotonically_increasing_id()), "files")
        files = numbered.select(*on, "added")
        added = numbered.where("added")
        new_keys = None
        for name, (table, key) in sources.items():
            of_file = [c.alias(n) for c, n in zip(file_columns(), ("f", "m", "b"))]
            rows = table.select(*of_file, key.cast("string").alias("key"))
            mine = added.where(F.col("source") == name).select("file", "modified", "bytes", "no")
            found = self._of_files(rows, mine).where("key is not null").select(
                F.lit(name).alias("source"), "no", "key").distinct()
            new_keys = found if new_keys is None else new_keys.unionByName(found)
        new_keys = self._scratch(new_keys, "keys")
        gone = self._read("keys", KEYS).drop("version").join(
            files.where("not added").drop("added"), on, "left_semi")
        touched = new_keys.select("source", "key").unionByName(gone.select("source", "key")).distinct()
        touched = self._scratch(touched, "touched")
        keys = {name: touched.where(F.col("source") == name).select("key") for name in sources}
        named = new_keys.join(added.select("no", "file", "stamp").hint("broadcast"), "no").select(*on, "key")
        return Changes(keys, version, files, named)

    def _of_files(self, rows: DataFrame, files: DataFrame) -> DataFrame:
        """The rows of the given files, with their numbers. Up to ``MAX_NAMED`` files are named in
        the filter, so that the scan opens no other."""
        names = [r.file for r in files.select("file").limit(MAX_NAMED + 1).collect()]
        if len(names) <= MAX_NAMED:
            rows = rows.where(F.col("f").isin(names))
        # one row per file: no row meets two
        return rows.join(files, (F.col("f") == files.file) & (F.col("m") == files.modified) & (F.col("b") == files.bytes))

    def commit(self, changes: Changes) -> None:
        """Record the differences, after the results that follow from them
        are stored. Writing a version again gives the same version."""
        at = f"version={changes.version}"
        changes.new_keys.write.mode("overwrite").parquet(f"{self.path}/keys/{at}")
        changes.files.write.mode("overwrite").parquet(f"{self.path}/files/{at}")


#: New files named one by one in a scan's filter.
MAX_NAMED = 2_000
