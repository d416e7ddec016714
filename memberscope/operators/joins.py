"""Joins against a dimension (one row per key) that stay balanced when one
key is hot.

A fact table can hold a third of its rows under one key (one coupon held by a
third of all members). A sort-merge join then sends all of them to one task.
AQE splits such a partition at runtime when skew-join handling is on; where it
is off, or to be independent of it, ``lookup_join`` salts the join: each fact
row goes to one of ``salt_buckets`` sub-keys, chosen by a hash of a fact
column (so a retried task picks the same sub-key), and the dimension row of
each key is repeated for every sub-key. The hot key is then spread over
``salt_buckets`` tasks, at the cost of ``salt_buckets`` copies of the
dimension, which has one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, salt_by: str,
                salt_buckets: int = 0, how: str = "left") -> DataFrame:
    """``facts`` joined to ``dim`` on ``key`` (``dim`` unique per key).

    ``salt_buckets`` of 0 or 1 is a plain join (the planner and AQE choose
    broadcast or sort-merge and split skew). More buckets salt the join by
    ``hash(salt_by)`` as described in the module note; the result is the same.
    """
    if salt_buckets <= 1:
        return facts.join(dim, key, how)
    salt = F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt_buckets)).cast("int")
    salted_facts = facts.withColumn(_SALT, salt)
    spread_dim = dim.withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return salted_facts.join(spread_dim, [key, _SALT], how).drop(_SALT)
