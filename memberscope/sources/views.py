"""The domain views as named tables for SQL users.

``register_views`` publishes each domain view under the member-analytics
table name (``t_member``, ``t_order`` …) as a temporary view, so analytics
written as SQL text runs unchanged over the shared tables; Catalyst plans it
exactly like the DataFrame products (same pushdown and pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from memberscope.sources.tables import Domain

VIEWS = ("t_member", "t_registration", "t_order", "t_purchase",
         "t_order_commodity", "t_coupon_member", "t_coupon", "t_delivery",
         "t_feedback")


def domain_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    d = Domain(spark, sf_dir)
    return {
        "t_member": d.member,
        "t_registration": d.registration,
        "t_order": d.order,
        "t_purchase": d.purchase,
        "t_order_commodity": d.order_item,
        "t_coupon_member": d.coupon_member,
        "t_coupon": d.coupon,
        "t_delivery": d.delivery,
        "t_feedback": d.feedback,
    }


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Create (or replace) the temporary views; returns their names."""
    views = domain_views(spark, sf_dir)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
