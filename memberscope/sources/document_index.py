"""Document index of the tag table (B6): a Spark data source that writes one
document per member into a file-backed index, no server.

An index is a folder on storage that every executor mounts:

``index.json``      settings (the id field) and the live segments, by generation
``segment-*.jsonl`` documents, one JSON object a line, never changed once named

A write is a generation. Every task writes a segment under a temporary name
and renames it when it is whole; only segments of committed tasks reach the
driver, which then replaces ``index.json`` in one step (``commit``). Repeated
attempts, lost executors and failed writes leave files that no index names,
and ``abort`` removes what it is told of. So a repeated or failed write leaves
exactly one document per member:

* ``mode("append")`` replaces the documents of the ids it brings (the newest
  generation of an id counts) and keeps the others;
* ``mode("overwrite")`` makes the index hold exactly the documents written:
  members that vanished from the tag table vanish from the index.

Nothing creates an index on its own: writing to a folder without ``index.json``
fails, as with auto-create off; ``create_index`` makes one.
"""

from __future__ import annotations

import datetime
import decimal
import json
import os
import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

FORMAT = "memberscope_index"
SETTINGS = "index.json"


def _local(path: str) -> str:
    return path.removeprefix("file://").replace("file:", "", 1) if path.startswith("file:") else path


def _settings(path: str) -> dict:
    name = os.path.join(_local(path), SETTINGS)
    if not os.path.exists(name):
        raise FileNotFoundError(f"no index at {path}: create_index makes one")
    with open(name, encoding="utf-8") as f:
        return json.load(f)


def _replace_settings(path: str, settings: dict) -> None:
    folder = _local(path)
    temporary = os.path.join(folder, f".{SETTINGS}-{uuid.uuid4().hex}")
    with open(temporary, "w", encoding="utf-8") as f:
        json.dump(settings, f)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, os.path.join(folder, SETTINGS))


def create_index(path: str, id_field: str = "memberId") -> None:
    """An empty index; an existing one is left as it is."""
    os.makedirs(_local(path), exist_ok=True)
    if not os.path.exists(os.path.join(_local(path), SETTINGS)):
        _replace_settings(path, {"id_field": id_field, "generation": 0, "segments": []})


def _plain(value):
    """A value as JSON holds it: exact decimals and times as text."""
    if isinstance(value, (decimal.Decimal, datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, Row):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    return value


@dataclass
class Segment(WriterCommitMessage):
    name: str
    documents: int


class IndexWriter(DataSourceWriter):
    def __init__(self, path: str, id_field: str, overwrite: bool):
        self.path, self.id_field, self.overwrite = path, id_field, overwrite

    def write(self, iterator) -> Segment:
        """One task: its documents under a temporary name, then renamed. The
        document's id is ``_id``; a document without one is an error."""
        folder, name = _local(self.path), f"segment-{uuid.uuid4().hex}.jsonl"
        temporary, count = os.path.join(folder, f".{name}"), 0
        try:
            with open(temporary, "w", encoding="utf-8") as f:
                for row in iterator:
                    doc = {k: _plain(v) for k, v in row.asDict().items()}
                    if doc.get(self.id_field) is None:
                        raise ValueError(f"a document without {self.id_field}")
                    f.write(json.dumps({"_id": str(doc[self.id_field]), "doc": doc}, ensure_ascii=False) + "\n")
                    count += 1
                f.flush()
                os.fsync(f.fileno())
            os.replace(temporary, os.path.join(folder, name))
        except BaseException:
            if os.path.exists(temporary):
                os.remove(temporary)
            raise
        return Segment(name, count)

    def commit(self, messages) -> None:
        settings = _settings(self.path)
        generation = settings["generation"] + 1
        new = [{"name": m.name, "generation": generation} for m in messages if m is not None and m.documents]
        old = [] if self.overwrite else settings["segments"]
        _replace_settings(self.path, {**settings, "generation": generation, "segments": old + new})

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None:
                name = os.path.join(_local(self.path), m.name)
                if os.path.exists(name):
                    os.remove(name)


class DocumentIndex(DataSource):
    """``df.write.format("memberscope_index").option("path", …)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        path = self.options.get("path")
        if not path:
            raise ValueError("option path is missing")
        id_field = _settings(path)["id_field"]
        if id_field not in schema.fieldNames():
            raise ValueError(f"documents have no field {id_field}")
        return IndexWriter(path, id_field, overwrite)


def write_index(tags: DataFrame, path: str, mode: str = "overwrite", id_field: str = "memberId") -> None:
    """Write one document per member. Rows that share an id would be one
    document, so they are refused; rows without an id are no members."""
    spark = tags.sparkSession
    _settings(path)  # no index, no write
    # executors get the source with the plan, wherever this package is
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(DocumentIndex)
    members = tags.where(F.col(id_field).isNotNull())
    twice = members.groupBy(id_field).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{id_field} {twice[0][0]} has several rows")
    members.write.format(FORMAT).mode(mode).option("path", path).save()


def read_index(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The live documents: of each id the newest generation's."""
    live = _settings(path)["segments"]
    at = {s["name"]: s["generation"] for s in live}
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if not at:
        return spark.createDataFrame([], fields)
    names = [os.path.join(path, n) for n in at]
    record = StructType().add("_id", "string").add("doc", fields)
    raw = spark.read.schema(record).json(names).withColumn(
        "segment", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    generation = F.element_at(F.create_map(*[F.lit(x) for kv in at.items() for x in kv]), F.col("segment"))
    newest = raw.groupBy("_id").agg(F.max_by("doc", generation).alias("doc"))
    return newest.select("doc.*")
