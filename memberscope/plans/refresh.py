"""Refreshes of stored products that follow their source files: the per-day
growth rollup (A7, B42) and the member tag table (A19). Both ask a ledger
(``sources.ledger``) which keys changed, recompute those alone, replace them in
the stored table and then commit the ledger, so a refresh that fails halfway
is simply run again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.functions.calendar import day_key, day_start, ts_literal
from memberscope.operators import growth, tags
from memberscope.session import stored_table
from memberscope.sources.ledger import Ledger

TAG_BUCKETS = 64


# ---------------------------------------------------------------- growth

def _on_days(df: DataFrame, ts: str, days: list) -> DataFrame:
    """Rows of the given days; runs of days become one comparison each, which
    the scan can use."""
    wanted, at = F.lit(False), 0
    while at < len(days):
        end = at
        while end + 1 < len(days) and (days[end + 1] - days[end]).days == 1:
            end += 1
        lo = ts_literal(df, ts, day_start(days[at]))
        hi = ts_literal(df, ts, day_start(days[end], 1))
        wanted, at = wanted | ((F.col(ts) >= lo) & (F.col(ts) < hi)), end + 1
    return df.where(wanted)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The stored rollup: days with rows (a day that lost all is kept as an
    empty mark)."""
    return spark.read.parquet(path).where("reg_rows > 0 or order_rows > 0")


def refresh_growth(member: DataFrame, order: DataFrame, ledger: Ledger, path: str,
                   sources: dict[str, tuple[DataFrame, Column]], **cols) -> DataFrame:
    """Bring the rollup below ``path`` up to date and return it.

    ``sources`` are the file tables behind ``member`` and ``order``, each
    with the time column whose day a row counts for. Only days that some new,
    rewritten or removed file holds are recomputed, however old; days without
    rows vanish."""
    spark = member.sparkSession
    changes = ledger.changes({n: (t, F.date_format(day_key(c), "yyyy-MM-dd")) for n, (t, c) in sources.items()})
    touched = None
    for keys in changes.keys.values():
        touched = keys if touched is None else touched.unionByName(keys)
    # one row per calendar day
    days = sorted(r.d for r in touched.select(F.col("key").cast("date").alias("d")).distinct().collect())
    if days:
        member_ts, order_ts = cols.get("member_ts", "create_time"), cols.get("order_ts", "create_time")
        fresh = growth.daily_rollup(_on_days(member, member_ts, days), _on_days(order, order_ts, days), **cols)
        every = spark.createDataFrame([(d,) for d in days], "d date")
        zero = F.lit(0).cast("bigint")
        part = every.join(fresh, "d", "left").select("d", *[
            F.coalesce(c, zero).alias(c) for c in ("reg_rows", "regCount", "order_rows", "orders")], "gmv_day")
        (part.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("d").parquet(path))
    ledger.commit(changes)
    return read_rollup(spark, path)


# ---------------------------------------------------------------- tags

class Touched:
    """The views of ``domain`` narrowed to the given members: what the tag
    table needs to rebuild their rows."""

    def __init__(self, domain, members: DataFrame):
        self.d, self.m = domain, members

    def _of(self, df: DataFrame, column: str) -> DataFrame:
        return df.join(self.m, df[column] == self.m.m, "left_semi")

    @property
    def member(self) -> DataFrame:
        return self._of(self.d.member, "id")

    @property
    def order(self) -> DataFrame:
        return self._of(self.d.order, "member_id")

    def _of_order(self, df: DataFrame) -> DataFrame:
        mine = self.order.select(F.col("order_id").alias("o")).distinct()
        return df.join(mine, df.order_id == mine.o, "left_semi")

    @property
    def order_item(self) -> DataFrame:
        return self._of_order(self.d.order_item)

    @property
    def order_line(self) -> DataFrame | None:
        lines = self.d.order_line
        return None if lines is None else self._of_order(lines)

    @property
    def coupon_member(self) -> DataFrame:
        return self._of(self.d.coupon_member, "member_id")

    @property
    def coupon(self) -> DataFrame:
        return self.d.coupon

    @property
    def delivery(self) -> DataFrame:
        return self._of(self.d.delivery, "member_id")

    @property
    def feedback(self) -> DataFrame:
        return self._of(self.d.feedback, "member_id")


def tag_table(d, free_id: int = 1) -> DataFrame:
    return tags.member_tags(d.member, d.order, d.order_item, d.coupon_member, d.coupon, d.delivery,
                            d.feedback, free_id=free_id, order_line=d.order_line)


def bucket_of(member: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(member.cast("long")), F.lit(buckets)).cast("int")


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """The stored tag table, one row per member."""
    return spark.read.parquet(path).where("memberId is not null").drop("bucket")


def touched_members(domain, changed: dict[str, DataFrame], by: dict[str, str]) -> DataFrame:
    """``m``: members whose tags may differ. ``by`` says for each source what
    its keys are: ``member``, ``order`` or ``coupon``."""
    found = None
    for name, keys in changed.items():
        key = keys.select(F.col("key").cast("long").alias("k"))
        if by[name] == "member":
            part = key.select(F.col("k").alias("m"))
        elif by[name] == "order":
            order = domain.order
            part = order.join(key, order.order_id == key.k, "left_semi").select(F.col("member_id").alias("m"))
        else:
            held = domain.coupon_member
            part = held.join(key, held.coupon_id == key.k, "left_semi").select(F.col("member_id").alias("m"))
        part = part.where("m is not null").distinct()
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def refresh_tags(domain, ledger: Ledger, path: str, sources: dict[str, tuple[DataFrame, str, str]],
                 free_id: int = 1, buckets: int = TAG_BUCKETS) -> DataFrame:
    """Bring the tag table below ``path`` up to date and return it.

    ``sources``: file table -> (table, key column, what the key is). Members
    found through new, rewritten and removed files are rebuilt from their own
    rows; their old rows are replaced, or removed where the member is gone.
    The table is partitioned by a hash of the member into ``buckets`` (to be
    kept for the table's life); only buckets of touched members are written."""
    spark = next(iter(sources.values()))[0].sparkSession
    changes = ledger.changes({n: (t, F.col(c)) for n, (t, c, _) in sources.items()})
    touched = stored_table(spark, touched_members(domain, changes.keys, {n: k for n, (_, _, k) in sources.items()}),
                      "touched-members")
    if not touched.isEmpty():
        fresh = tag_table(Touched(domain, touched), free_id)
        fresh = fresh.where("memberId is not null").withColumn("bucket", bucket_of(F.col("memberId"), buckets))
        hit = touched.select(bucket_of(F.col("m"), buckets).alias("bucket")).distinct()
        hit_list = [r.bucket for r in hit.collect()]  # at most ``buckets`` numbers
        parts = fresh
        if table_exists(spark, path):
            old = spark.read.schema(fresh.schema).parquet(path).where(
                F.col("bucket").isin(hit_list) & F.col("memberId").isNotNull())
            kept = old.join(touched, old.memberId == touched.m, "left_anti")
            parts = parts.unionByName(kept)
        # a mark per bucket, so that a bucket without members is replaced too
        marks = spark.createDataFrame([(b,) for b in hit_list], "bucket int").select(*[
            F.col("bucket") if f.name == "bucket" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fresh.schema.fields])
        merged = stored_table(spark, parts.unionByName(marks), "merged-tags")
        (merged.repartition("bucket").sortWithinPartitions("bucket", "memberId").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))
    ledger.commit(changes)
    return read_tags(spark, path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written below ``path``."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)
