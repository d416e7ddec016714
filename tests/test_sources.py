"""Sources: text files (B2), domain views for SQL (B1, B4), parameterized SQL
(B5)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from memberscope.operators import distributions, growth, hotwords
from memberscope.plans import jobs, sql
from memberscope.sources.tables import Domain
from memberscope.sources.text import read_lines
from memberscope.sources.views import VIEWS, register_views


def test_hot_words_from_text_files(spark, tmp_path):
    d = tmp_path / "log"
    d.mkdir()
    (d / "a.txt").write_text("apple\tx\tq1\npear\ty\napple\n\t\t\n", encoding="utf-8")
    (d / "b.txt").write_text("pear\tz\napple\tz\n", encoding="utf-8")
    lines = read_lines(spark, str(d))
    assert lines.count() == 6
    assert rows(hotwords.hot_words(lines, k=2)) == [("apple", 3), ("pear", 2)]


def test_views_and_sql_match_the_dataframe_products(spark):
    assert sorted(register_views(spark, SF_SMALL)) == sorted(VIEWS)
    d = Domain(spark, SF_SMALL)
    assert sorted(rows(sql.distribution(spark, "sex"))) == \
        sorted(rows(distributions.member_sex(d.member_plain)))
    assert sorted(rows(sql.distribution(spark, "channel"))) == \
        sorted(rows(distributions.member_channel(d.member_plain)))
    heat = distributions.member_heat(d.member_plain, d.order, d.coupon_member)
    assert rows(sql.heat_orders(spark)) == rows(heat, "order", "orderAgain")
    a = sql.daily_counts(spark, "t_purchase", "order_id", "orderCount",
                         "2024-01-10", "2024-01-20")
    b = growth.daily_counts(d.purchase, "create_time", "order_id",
                            "2024-01-10", "2024-01-20", "orderCount")
    assert sorted(rows(a)) == sorted(rows(b)) and len(rows(a)) == 10


def test_jobs_write_every_product(spark, tmp_path):
    from memberscope.plans import catalog, jobs
    out = str(tmp_path / "out")
    written = []
    for name, job in jobs.JOBS.items():
        written += job(spark, SF_SMALL, out, tag_path=str(tmp_path / "tags"))
    assert len(written) == 15
    tags_back = spark.read.parquet(str(tmp_path / "tags"))
    assert tags_back.count() == 150
    ov = spark.read.json(f"{out}/member_overview").collect()
    heat = ov[0]["memberHeat"]
    assert len(ov) == 1 and heat["reg"] > 0 and heat["reg"] + heat["complete"] == 150
    assert spark.read.json(f"{out}/growth_daily").count() == 8
    assert spark.read.json(f"{out}/hot_words").count() == 10
    assert spark.read.json(f"{out}/tag_facets").count() == len(catalog.tag_rules())
    assert spark.read.json(f"{out}/coupon_expiry").count() == 4


def test_tables_from_the_catalog(spark):
    from memberscope.sources.tables import read_table
    # a folder or a catalog database name: both give the same table
    db = "memberscope_test_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {db}.customer AS SELECT * FROM parquet.`{SF_SMALL}/customer.parquet`")
        a = read_table(spark, db, "customer", kind="catalog")
        b = read_table(spark, SF_SMALL, "customer")
        assert sorted(rows(a)) == sorted(rows(b))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_checkpoint_dir_comes_from_the_session(spark):
    from memberscope.session import checkpoint_dir, scratch_path
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_growth_job_keeps_a_rollup_refreshed_by_day(spark, tmp_path):
    from memberscope.plans import jobs
    from memberscope.sources.tables import Domain
    d = Domain(spark, SF_SMALL)
    path = str(tmp_path / "rollup")
    # history up to 2024-01-20 first, then refresh from 2024-01-15 twice
    jobs.refresh_rollup(spark, d.registration.where("create_time < '2024-01-20'"),
                        d.purchase.where("create_time < '2024-01-20'"), path)
    jobs.refresh_rollup(spark, d.registration, d.purchase, path, since="2024-01-15")
    stored = jobs.refresh_rollup(spark, d.registration, d.purchase, path, since="2024-01-15")
    full = growth.daily_rollup(d.registration, d.purchase)
    cols = ["d", "reg_rows", "regCount", "order_rows", "orders", "gmv_day"]
    assert sorted(rows(stored, *cols)) == sorted(rows(full, *cols))
    out = jobs.growth_job(spark, SF_SMALL, str(tmp_path / "out"),
                          rollup_path=str(tmp_path / "rollup2"))
    got = sorted(tuple(r) for r in spark.read.json(out[1]).select(
        "day", "regCount", "memberCount", "orderCount").collect())
    want = sorted(rows(growth.growth_daily(d.registration, d.purchase, "2024-01-30"),
                       "day", "regCount", "memberCount", "orderCount"))
    assert got == want


def test_rollup_refresh_after_a_gap_skips_no_day(spark, tmp_path):
    from memberscope.plans import jobs
    from memberscope.sources.tables import Domain
    d = Domain(spark, SF_SMALL)
    path = str(tmp_path / "rollup")
    jobs.refresh_rollup(spark, d.registration.where("create_time < '2024-01-05'"),
                        d.purchase.where("create_time < '2024-01-05'"), path)
    stored = jobs.refresh_rollup(spark, d.registration, d.purchase, path, since="2024-01-23")
    full = growth.daily_rollup(d.registration, d.purchase)
    cols = ["d", "reg_rows", "regCount", "order_rows", "orders", "gmv_day"]
    assert sorted(rows(stored, *cols)) == sorted(rows(full, *cols))


def test_growth_line_stops_at_as_of(spark):
    from memberscope.sources.tables import Domain
    d = Domain(spark, SF_SMALL)
    line = rows(growth.growth_daily(d.registration, d.purchase, "2024-01-15"), "day")
    assert line and max(line)[0] <= "2024-01-15"


def test_appended_files_are_read(spark, tmp_path):
    from memberscope.sources.tables import read_table
    path = str(tmp_path / "t.parquet")
    spark.range(10).write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 10
    spark.range(10).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 20


def test_write_table_to_catalog_and_partitioned(spark, tmp_path):
    from memberscope.sources import sinks
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")],
                               "memberId long, d string")
    name = "memberscope_sink_test"
    try:
        sinks.write_table(df, table=name)
        sinks.write_table(df, table=name)  # overwrite, not append
        assert spark.table(name).count() == 3
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    p = str(tmp_path / "by_day")
    sinks.write_table(df, p, partition_by=["d"])
    back = spark.read.parquet(p)  # partition values are read back as dates
    assert back.count() == 3
    assert sorted(str(r[0]) for r in back.select("d").distinct().collect()) == \
        ["2024-01-01", "2024-01-02"]


def test_jobs_over_member_tables(spark, tmp_path):
    """Every job runs on t_* tables, with deliveries a table of their own."""
    def table(name, rows, schema, *times):
        df = spark.createDataFrame(rows, schema)
        for c in times:
            df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))

    table("t_member", [(1, "p1", 1, 1, "o1", -1, "2024-01-25 08:00:00"),
                       (2, "null", 2, 5, "null", 3, "2024-01-29 09:00:00")],
          "id long, phone string, sex int, member_channel int, mp_open_id string, "
          "address_default_id int, create_time string", "create_time")
    table("t_order", [(10, 1, 2, 5.0, 4.0, "2024-01-25 10:00:00"), (11, 1, 2, 6.0, 6.0, "2024-01-29 10:00:00"),
                      (12, 2, 1, 7.0, 7.0, "2024-01-29 11:00:00")],
          "order_id long, member_id long, order_status int, origin_price double, pay_price double, "
          "create_time string", "create_time")
    table("t_order_commodity", [(10, 3), (10, 4), (11, 3)], "order_id long, commodity_id int")
    table("t_coupon_member", [(1, 1, 2, "2024-01-21 00:00:00"), (1, 2, 1, "2024-01-21 00:00:00"),
                              (2, 2, 2, "2024-01-23 00:00:00")],
          "member_id long, coupon_id int, coupon_channel int, create_time string", "create_time")
    table("t_coupon", [(1, 10.0), (2, 20.0)], "id int, coupon_price double")
    table("t_delivery", [(1, "2024-01-25 10:00:00", "2024-01-25 10:30:00")],
          "member_id long, pick_time string, arrive_time string", "pick_time", "arrive_time")
    table("t_feedback", [(1, 2, 4)], "id long, member_id long, feedback_type int")

    source, out = str(tmp_path), str(tmp_path / "out")
    args = {"as_of": "2024-01-30", "tables": "member", "kind": "folder"}
    for name in ("member", "conversion", "growth", "wow"):
        for path in jobs.JOBS[name](spark, source, out, **args):
            spark.read.json(path).count()
    funnel = spark.read.json(out + "/conversion_funnel").first()
    assert (funnel.present, funnel.order, funnel.orderAgain, funnel.chargeCoupon) == (1000, 1, 1, 1)
    line = {r.day: (r.memberCount, r.orderCount) for r in spark.read.json(out + "/growth_daily").collect()}
    assert line == {"2024-01-25": (1, 1), "2024-01-29": (2, 3)}
    for fmt in ("parquet", "json"):
        paths = jobs.JOBS["usertag"](spark, source, out, tag_path=str(tmp_path / fmt), tag_format=fmt, **args)
        tag = {r.memberId: r for r in spark.read.format(fmt).load(paths[0]).collect()}
        assert (tag[1].orderCount, tag[1].overTime, tag[1].favGoods) == (2, 1800, [3, 4])
        assert tag[2].feedBack == 4 and spark.read.text(paths[1]).count() == 1
        soon = {r.k: r.members for r in spark.read.json(out + "/coupon_expiring").collect()}
        assert soon == {1: 1, 3: 0, 5: 0, 7: 0}
    with pytest.raises(ValueError):
        jobs.views(spark, source, kind="catalog")
