"""Money columns: scale as a parameter, and values that do not fit."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from memberscope.functions.money import money, money_sum


def test_scale_and_strictness(spark):
    df = spark.createDataFrame([(0.1,), (2.25,), (None,), (-7.0,)], "v double")
    assert [r[0] for r in df.select(money("v")).collect()] == [Decimal("0.10"), Decimal("2.25"), None, Decimal("-7.00")]
    assert [r[0] for r in df.select(money("v", strict=True)).collect()] == [
        Decimal("0.10"), Decimal("2.25"), None, Decimal("-7.00")]
    assert df.select(money_sum("v", 4, True)).first()[0] == Decimal("-4.6500")
    fine = spark.createDataFrame([(1.2345,)], "v double")
    assert fine.select(money("v")).first()[0] == Decimal("1.23")
    assert fine.select(money("v", 4, True)).first()[0] == Decimal("1.2345")
    with pytest.raises(Exception, match="does not fit"):
        fine.select(money("v", strict=True)).collect()
    with pytest.raises(Exception, match="does not fit"):
        spark.createDataFrame([(1e20,)], "v double").select(money(F.col("v"), strict=True)).collect()
