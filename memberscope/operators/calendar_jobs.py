"""Calendar table jobs (D1–D4): the date helpers as DataFrame → DataFrame
functions. Each adds columns computed by native date functions; they are
narrow (no shuffle) and fuse into the scan stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberscope.functions import calendar as cal


def normalize_dates(df: DataFrame, col: str, patterns=cal.DATE_PATTERNS,
                    prefix: str | None = None) -> DataFrame:
    """Text in mixed formats → ``<p>_ts`` (timestamp), ``<p>_style`` (the
    pattern that parsed it) and ``<p>_valid``. Parsing is strict: the whole
    text must fit the pattern. A projection: no exchange."""
    p = prefix or col
    out = df.withColumn(f"{p}_ts", cal.parse_any(col, patterns))
    if cal.signatures_unique(tuple(patterns)):
        # The style is the layout's pattern wherever the parse succeeded:
        # no second round of parsing.
        style = F.when(F.col(f"{p}_ts").isNotNull(), cal.candidate_pattern(col, patterns))
    else:
        style = cal.date_style(col, patterns)
    return (out.withColumn(f"{p}_style", style)
               .withColumn(f"{p}_valid", F.col(f"{p}_ts").isNotNull()))


def calendar_features(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Year, month (1-based), day, hour, minute, second, date, time,
    weekday (1 = Monday) and the weekday's Chinese, English and short
    names."""
    c = F.col(ts)
    return df.select(
        "*",
        F.year(c).alias(f"{prefix}year"),
        F.month(c).alias(f"{prefix}month"),
        F.dayofmonth(c).alias(f"{prefix}day"),
        F.hour(c).alias(f"{prefix}hour"),
        F.minute(c).alias(f"{prefix}minute"),
        F.second(c).alias(f"{prefix}second"),
        cal.wall_clock_text(c, "yyyy-MM-dd").alias(f"{prefix}date"),
        cal.wall_clock_text(c, "HH:mm:ss").alias(f"{prefix}time"),
        cal.weekday_number(c).alias(f"{prefix}weekday"),
        cal.weekday_cn(c).alias(f"{prefix}weekday_cn"),
        cal.weekday_en(c).alias(f"{prefix}weekday_en"),
        cal.weekday_short(c).alias(f"{prefix}weekday_short"),
    )


def shift_dates(df: DataFrame, ts: str, shifts, out: str) -> DataFrame:
    """D3: apply ``shifts`` – a sequence of (unit, amount) – one after the
    other (a year, then a month, …), as chained calendar additions do."""
    c = F.col(ts)
    for unit, n in shifts:
        c = cal.shift(c, unit, n)
    return df.withColumn(out, c)


def interval_days(df: DataFrame, a: str, b: str, out: str = "days") -> DataFrame:
    """Absolute whole-day difference of two date/timestamp columns."""
    return df.withColumn(out, cal.interval_days(a, b))
