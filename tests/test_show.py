"""Outputs are shown in the format they were written in."""

import pytest

from conftest import SF_SMALL
from memberscope.plans import jobs
from memberscope.sources import document_index


def test_show_reads_each_format(spark, tmp_path, capsys):
    df = spark.createDataFrame([("seven",)], "value string")
    for fmt in ("parquet", "json", "text"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        jobs._show(spark, str(tmp_path / fmt))
        assert "seven" in capsys.readouterr().out
    df.write.option("header", "true").csv(str(tmp_path / "csv"))
    with pytest.raises(ValueError):
        jobs._show(spark, str(tmp_path / "csv"))


def test_jobs_write_the_index_and_follow_files(spark, tmp_path):
    index = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        jobs.usertag_job(spark, SF_SMALL, str(tmp_path / "out"), index_path=index)
    document_index.create_index(index)
    paths = jobs.usertag_job(spark, SF_SMALL, str(tmp_path / "out"), index_path=index)
    stored = spark.read.parquet(paths[0])
    back = document_index.read_index(spark, index, "memberId long, sex string, orderCount long")
    assert sorted(map(tuple, back.collect())) == sorted(
        map(tuple, stored.select("memberId", "sex", "orderCount").collect()))
    plain = jobs.growth_job(spark, SF_SMALL, str(tmp_path / "a"))
    for _ in range(2):
        kept = jobs.growth_job(spark, SF_SMALL, str(tmp_path / "b"), rollup_path=str(tmp_path / "r"), by_files=True)
    read = lambda p: sorted(map(repr, spark.read.json(p).collect()))
    assert read(kept[1]) == read(plain[0])
