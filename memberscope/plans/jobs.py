"""Batch jobs: each runs a group of products over one data folder and writes
the results (the counterparts of the six analytics mains).

    python -m memberscope.plans.jobs <job> --sf-dir DIR --out DIR [--as-of DAY]

Jobs: ``member`` (A1–A5), ``conversion`` (A6), ``growth`` (A7),
``wow`` (A8–A10), ``hotword`` (A11), ``usertag`` (A12–A23).

Every output is written with ``overwrite`` so a re-run replaces it. The tag
job first publishes the tag table, then builds the audience outputs from the
*written* table: their lineage starts at those files, so a lost executor
costs a re-read, not a rebuild of the whole tag table.
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberscope.functions.calendar import day_start
from memberscope.functions.rules import Rule, standard_rules
from memberscope.operators import (audience, distributions, funnel, growth,
                                   hotwords, tags)
from memberscope.plans import catalog as C
from memberscope.plans import refresh
from memberscope.session import build_session, scratch_path
from memberscope.sources import document_index, sinks
from memberscope.sources.ledger import Ledger
from memberscope.sources.tables import Domain, MemberTables, Tables
from memberscope.sources.text import read_lines, text_lines


def _write(df: DataFrame, out: str, name: str, fmt: str = "json") -> str:
    path = os.path.join(out, name)
    sinks.write_table(df, path, fmt=fmt)
    return path


def views(spark: SparkSession, source: str, tables: str = "shared", kind: str = "folder"):
    """The views a job reads: over the shared tables of a folder, or, with
    ``tables="member"``, over the ``t_*`` tables of a folder or (with
    ``kind="catalog"``) of a catalog database."""
    if tables == "member":
        return MemberTables(spark, source, kind)
    if tables != "shared" or kind != "folder":
        raise ValueError(f"no views over tables={tables!r}, kind={kind!r}")
    return Domain(spark, source)


def member_job(spark: SparkSession, sf: str, out: str, tables: str = "shared",
               kind: str = "folder", **_) -> list[str]:
    d = views(spark, sf, tables, kind)
    overview = distributions.member_overview(d.member_plain, d.order,
                                             d.coupon_member, sentinel=C.PHONE_SENTINEL)
    return [_write(overview, out, "member_overview")]


def conversion_job(spark: SparkSession, sf: str, out: str, tables: str = "shared",
                   kind: str = "folder", **_) -> list[str]:
    d = views(spark, sf, tables, kind)
    f = funnel.conversion_funnel(d.order, d.coupon_bought, behaviour=d.behaviour,
                                 done_status=d.done_status)
    return [_write(f, out, "conversion_funnel")]


def refresh_rollup(spark: SparkSession, member: DataFrame, order: DataFrame,
                   path: str, since=None, **cols) -> DataFrame:
    """Keep the per-day growth rollup as a table partitioned by day.

    Days from ``since`` on are recomputed from the raw tables (their scans
    are bounded by ``since``) and replace their own partitions only (dynamic
    partition overwrite); older days are kept. Where the stored table ends
    before ``since`` (missed runs), the refresh starts at its last day, so no
    day is skipped. Without ``since``, or when the table does not exist yet,
    every day is computed. Re-running a refresh gives the same table. Returns
    the stored rollup."""
    last = _last_day(spark, path)
    if last is None:
        since = None
    elif since is not None:
        since = min(str(since), str(last))
    part = growth.daily_rollup(member, order, since=since, **cols)
    (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("d").parquet(path))
    return spark.read.parquet(path)


def _last_day(spark: SparkSession, path: str):
    """The last stored day, None where no table is there yet (any other
    failure to read is an error)."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return stored.agg(F.max("d")).first()[0]


def growth_job(spark: SparkSession, sf: str, out: str, as_of: str = C.AS_OF,
               rollup_path: str | None = None, days: int = 7, tables: str = "shared",
               kind: str = "folder", by_files: bool = False, **_) -> list[str]:
    """The growth line. With ``rollup_path`` the per-day rollup is kept
    there: only the days of the window are recomputed, and the line is read
    from the stored rollup instead of the raw history. ``by_files`` recomputes
    the days of new, rewritten and removed files instead, however old (a
    rollup is kept one way or the other for its whole life)."""
    d = views(spark, sf, tables, kind)
    if rollup_path and by_files:
        book = Ledger(spark, f"{rollup_path.rstrip('/')}-ledger")
        rollup = refresh.refresh_growth(d.registration, d.purchase, book, rollup_path, d.growth_sources)
        line = growth.growth_from_rollup(rollup, as_of, days)
        return [rollup_path, _write(line, out, "growth_daily")]
    if rollup_path:
        since = day_start(as_of, -days).date()
        rollup = refresh_rollup(spark, d.registration, d.purchase, rollup_path, since)
        line = growth.growth_from_rollup(rollup, as_of, days)
        return [rollup_path, _write(line, out, "growth_daily")]
    return [_write(growth.growth_daily(d.registration, d.purchase, as_of), out,
                   "growth_daily")]


def wow_job(spark: SparkSession, sf: str, out: str, as_of: str = C.AS_OF,
            tables: str = "shared", kind: str = "folder", **_) -> list[str]:
    d = views(spark, sf, tables, kind)
    reg, buy = d.registration, d.purchase
    return [
        _write(growth.last_weeks_counts(reg, "create_time", "id", as_of, 2,
                                        "regCount"), out, "reg_two_weeks"),
        _write(growth.last_weeks_counts(buy, "create_time", "order_id", as_of, 2,
                                        "orderCount"), out, "order_two_weeks"),
        _write(growth.week_on_week(reg, "create_time", "id", as_of), out,
               "reg_week_on_week"),
        _write(growth.week_on_week(buy, "create_time", "order_id", as_of), out,
               "order_week_on_week"),
    ]


def hotword_job(spark: SparkSession, sf: str, out: str, lines_path: str | None = None,
                sep: str | None = None, **_) -> list[str]:
    """Hot words of text files (tab-separated, field 0) when ``lines_path``
    is given, else of the lines of ``documents.text`` (space-separated)."""
    if lines_path:
        lines, sep = read_lines(spark, lines_path), sep or "\t"
    else:
        lines, sep = text_lines(Tables(spark, sf).documents), sep or " "
    return [_write(hotwords.hot_words(lines, sep=sep), out, "hot_words")]


def usertag_job(spark: SparkSession, sf: str, out: str, as_of: str = C.AS_OF,
                tag_path: str | None = None, tag_format: str = "parquet",
                tables: str = "shared", kind: str = "folder", rules: list | None = None,
                index_path: str | None = None, **_) -> list[str]:
    """Publish the tag table (B6), then the audience products built on it.
    ``rules`` is the audience selection (default: a sample one). With
    ``index_path`` the document index there, which must exist, holds one
    document per member afterwards."""
    d = views(spark, sf, tables, kind)
    if tables == "member":
        rules = rules or [Rule("ordered again", "orderCount", "2", "rangeGte")]
        facets = standard_rules(as_of)
    else:
        rules, facets = rules or C.AUDIENCE_RULES, C.tag_rules()
    t = tags.member_tags(d.member, d.order, d.order_item, d.coupon_member,
                         d.coupon, d.delivery, d.feedback, free_id=C.FREE_COUPON_ID,
                         order_line=d.order_line)
    tag_path = tag_path or scratch_path(spark, f"member_tags-{uuid.uuid4().hex}")
    sinks.write_table(t, tag_path, fmt=tag_format)
    published = spark.read.schema(t.schema).format(tag_format).load(tag_path)
    if index_path:
        document_index.write_index(published, index_path)
    selected = audience.audience_select(published, rules)
    member_txt = os.path.join(out, "member_txt")
    sinks.write_member_text(selected, member_txt)
    return [
        tag_path, member_txt,
        _write(audience.tag_facets(published, facets), out, "tag_facets"),
        _write(audience.free_coupon_reminder(
            published.select("memberId", "freeCouponTime"), as_of), out,
            "free_coupon_reminder"),
        _write(audience.coupon_expiry(
            published.select("memberId", F.coalesce("couponTimes", F.array())
                             .alias("couponTimes")), as_of), out, "coupon_expiry"),
        _write(audience.free_coupon_reminder(
            published.select("memberId", "freeCouponTime"), as_of, expiring=True), out,
            "free_coupon_expiring"),
        _write(audience.coupon_expiry(
            published.select("memberId", F.coalesce("couponTimes", F.array())
                             .alias("couponTimes")), as_of, expiring=True), out,
            "coupon_expiring"),
    ]


JOBS = {
    "member": member_job,
    "conversion": conversion_job,
    "growth": growth_job,
    "wow": wow_job,
    "hotword": hotword_job,
    "usertag": usertag_job,
}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="memberscope.plans.jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--sf-dir", required=True,
                   help="folder of <table>.parquet files, or (--kind catalog) a database")
    p.add_argument("--tables", choices=("shared", "member"), default="shared",
                   help="the shared tables, or member-analytics tables (t_member, …)")
    p.add_argument("--kind", choices=("folder", "catalog"), default="folder",
                   help="where member-analytics tables are")
    p.add_argument("--hive", action="store_true", help="use the Hive metastore as catalog")
    p.add_argument("--out", required=True, help="folder for the outputs (overwritten)")
    p.add_argument("--as-of", default=C.AS_OF, help="the report day, yyyy-MM-dd")
    p.add_argument("--lines-path", help="hotword: text files of tab-separated lines")
    p.add_argument("--tag-path", help="usertag: where to publish the tag table "
                   "(default: below spark.checkpoint.dir)")
    p.add_argument("--rollup-path",
                   help="growth: keep the per-day rollup there, refreshed by day")
    p.add_argument("--by-files", action="store_true",
                   help="growth: refresh the days of changed files, however old")
    p.add_argument("--index-path",
                   help="usertag: an existing document index to bring up to date")
    p.add_argument("--master")
    p.add_argument("--show", action="store_true",
                   help="print the first rows of every output (B9)")
    a = p.parse_args(argv)
    spark = build_session(a.master, extra={
        "spark.sql.catalogImplementation": "hive"} if a.hive else None)
    for path in JOBS[a.job](spark, a.sf_dir, a.out, as_of=a.as_of,
                            lines_path=a.lines_path, tag_path=a.tag_path,
                            rollup_path=a.rollup_path, tables=a.tables, kind=a.kind,
                            by_files=a.by_files, index_path=a.index_path):
        print(path)
        if a.show:
            _show(spark, path)


#: Formats of a job's outputs by the suffix of their files.
FORMATS = {"parquet": "parquet", "json": "json", "txt": "text"}


def _show(spark: SparkSession, path: str, n: int = 20) -> None:
    """Print the first rows of a written output, in the format that its files
    are named after."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(path).select("path").limit(1).collect()
    if not files:
        print("(no rows)")
        return
    fmt = FORMATS.get(files[0].path.rsplit(".", 1)[-1])
    if fmt is None:
        raise ValueError(f"no known format: {files[0].path}")
    spark.read.format(fmt).load(path).show(n, truncate=False)


if __name__ == "__main__":
    main()
