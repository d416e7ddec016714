"""Hot keys found and isolated before a join.

``hot_keys`` summarises a key column with Spark's mergeable frequent-items
sketch (``approx_top_k``: one small summary per task, merged on the way up) and
returns the keys that hold more than a given share of the rows. The sketch
counts a key too high by at most 3.5 / ``TRACKED`` of the rows, and never too
low beyond that, so no key above the share is missed; at most 1 / share keys
can pass.

``isolated_join`` splits a fact-to-dimension join by that list: rows of hot
keys are spread over salted parts and meet copies of the few hot dimension
rows; all other rows join plainly, without copies or salt. The result does not
depend on which keys are called hot, nor on adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberscope.operators.joins import lookup_join

TRACKED = 10_000
SHARE = 0.01
PARTS = 64


def hot_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys of more than ``share`` of the rows of ``df`` (nulls aside)."""
    if not 4 / TRACKED <= share < 1:
        raise ValueError(f"share must lie between {4 / TRACKED} and 1")
    most = int(1 / share) + 1
    row = df.where(F.col(key).isNotNull()).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top")).first()
    return [t["item"] for t in row.top or [] if t["count"] > share * row.n]


def isolated_join(facts: DataFrame, dim: DataFrame, key: str, salt_by: str, hot: list | None = None,
                  parts: int = PARTS, share: float = SHARE, how: str = "left") -> DataFrame:
    """``facts`` joined to ``dim`` (unique per key) on ``key``; ``hot`` is
    found in ``facts`` unless given."""
    if hot is None:
        hot = hot_keys(facts, key, share)
    if not hot:
        return facts.join(dim, key, how)
    is_hot = F.col(key).isin(hot)
    cold = facts.where(~F.coalesce(is_hot, F.lit(False))).join(dim, key, how)
    spread = lookup_join(facts.where(is_hot), dim.where(is_hot), key, salt_by, parts, how)
    return cold.unionByName(spread.select(*cold.columns))
