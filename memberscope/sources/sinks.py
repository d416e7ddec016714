"""Sinks: the tag table write (B6), JSON rows (B7) and the audience text
export (B10).

All writes are parallel (one file per task) and idempotent (``overwrite``),
so a re-run after a lost executor or a failed job replaces the output rather
than appending a second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str | None = None, fmt: str = "parquet",
                mode: str = "overwrite", table: str | None = None,
                partition_by: list[str] | None = None,
                **options) -> None:
    """Write a product.

    ``fmt`` is any DataFrameWriter format available on the cluster: parquet
    and json by default, or a search-index connector (options such as the
    resource name and the id field go through ``options``). With ``table``
    the result is saved in the catalog instead of a path.
    """
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.saveAsTable(table)
    else:
        w.save(path)


def write_tag_index(tags: DataFrame, resource: str, fmt: str,
                    id_field: str = "memberId", **options) -> None:
    """B6 against a document index: one document per member, keyed by
    ``id_field`` so a re-run overwrites instead of adding documents."""
    opts = {"es.resource": resource, "es.mapping.id": id_field,
            "es.write.operation": "upsert", **options}
    tags.write.format(fmt).mode("append").options(**opts).save()


def json_rows(df: DataFrame, ignore_nulls: bool = True) -> DataFrame:
    """Each row as one JSON text ``value`` (for export; keep columns
    everywhere else). NULL fields are left out unless ``ignore_nulls`` is
    false, then they are written as ``null``."""
    opts = {"ignoreNullFields": "true" if ignore_nulls else "false"}
    return df.select(F.to_json(F.struct(*df.columns), opts).alias("value"))


def write_member_text(selected: DataFrame, path: str, col: str = "memberId") -> None:
    """The selected audience as text, one member id per line."""
    (selected.select(F.col(col).cast("string").alias("value"))
     .write.mode("overwrite").text(path))
