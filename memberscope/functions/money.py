"""Money columns.

Money is summed as DECIMAL, never as DOUBLE: a double sum depends on the order
the partial sums meet in, so two runs (or two engines) would disagree in the
last digits. Inputs are cast to DECIMAL(18,2) before any sum; totals are
widened to DECIMAL(38,2) so a 100 TB history cannot overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"


def money(c: Column | str, scale: int = 2, strict: bool = False) -> Column:
    """A money column as DECIMAL(18, scale). A value with more places is
    rounded (half up), as the sources hold cents; with ``strict`` a value that
    does not fit the type exactly is an error instead."""
    c = F.col(c) if isinstance(c, str) else c
    kept = c.cast(f"decimal(18,{scale})")
    if not strict:
        return kept
    # compared in the value's own terms: 0.1 as a double is the decimal 0.1
    fits = c.isNull() | (c.try_cast("double") == c.try_cast(f"decimal(18,{scale})").cast("double"))
    return F.when(fits, c.try_cast(f"decimal(18,{scale})")).otherwise(F.raise_error(F.concat(
        F.lit(f"money does not fit decimal(18,{scale}): "), F.coalesce(c.cast("string"), F.lit("null")))
    ).cast(f"decimal(18,{scale})"))


def money_sum(c: Column | str, scale: int = 2, strict: bool = False) -> Column:
    return F.sum(money(c, scale, strict)).cast(f"decimal(38,{scale})")
