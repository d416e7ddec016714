"""Calendar column functions.

Everything here returns a ``Column`` built from Spark's own date functions, so
it runs inside whole-stage codegen; no Python runs per row. Day boundaries are
cut in the session time zone (UTC, see ``memberscope.session``).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"

# The date patterns the normaliser recognises, in their natural
# order (month-day, year-month, full dates and times; dash, slash and Chinese
# separators; then time only).
DATE_PATTERNS = (
    "MM-dd",
    "yyyy-MM",
    "yyyy-MM-dd",
    "MM-dd HH:mm",
    "MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd",
    "yyyy/MM",
    "yyyy/MM/dd",
    "MM/dd HH:mm",
    "MM/dd HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "yyyy/MM/dd HH:mm:ss",
    "MM月dd日",
    "yyyy年MM月",
    "yyyy年MM月dd日",
    "MM月dd日 HH:mm",
    "MM月dd日 HH:mm:ss",
    "yyyy年MM月dd日 HH:mm",
    "yyyy年MM月dd日 HH:mm:ss",
    "HH:mm",
    "HH:mm:ss",
)

# Weekdays as (Chinese name, English name, short name, number),
# Monday first.
WEEKDAYS = (
    ("星期一", "Monday", "Mon.", 1),
    ("星期二", "Tuesday", "Tues.", 2),
    ("星期三", "Wednesday", "Wed.", 3),
    ("星期四", "Thursday", "Thur.", 4),
    ("星期五", "Friday", "Fri.", 5),
    ("星期六", "Saturday", "Sat.", 6),
    ("星期日", "Sunday", "Sun.", 7),
)

UNITS = ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- as-of bounds

def as_date(value: str | _dt.date | _dt.datetime) -> _dt.date:
    """A day given as ``yyyy-MM-dd`` text, a date or a datetime."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def day_start(as_of, offset_days: int = 0) -> _dt.datetime:
    """Midnight of ``as_of + offset_days``."""
    d = as_date(as_of) + _dt.timedelta(days=offset_days)
    return _dt.datetime(d.year, d.month, d.day)


def ts_literal(df: DataFrame, col: str, value: _dt.datetime) -> Column:
    """``value`` as a literal of the column's own type.

    Comparing the bare column with a literal of the same type keeps the filter
    a plain comparison that Catalyst pushes into the Parquet scan (row-group
    and page skipping); wrapping the column in a function would not.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(df.schema[col].dataType)


def sorted_days(df: DataFrame, *cols: str) -> DataFrame:
    """Order a result that has one row per day (or per bucket): a handful of
    rows, so they are gathered into one partition (a narrow step) and sorted
    there, instead of a range shuffle for a global sort."""
    return df.coalesce(1).sortWithinPartitions(*cols)


def day_key(ts: Column | str) -> Column:
    """The calendar day of a timestamp, as DATE (cheap to group and sort)."""
    return F.to_date(_col(ts))


def day_text(c: Column | str) -> Column:
    """A date or wall-clock timestamp rendered as ``yyyy-MM-dd`` text, from
    its fields (no session time zone involved, see ``wall_clock_text``)."""
    return wall_clock_text(c, DAY_FORMAT)


# ---------------------------------------------------------------- D1 parsing

_FIELD_WIDTHS = (("yyyy", 4), ("MM", 2), ("dd", 2), ("HH", 2), ("mm", 2), ("ss", 2))


def _layout(pattern: str) -> list[tuple[str, int | None]]:
    """The pattern as (token, width) pieces: fields with their digit count,
    every other character as a literal (width None)."""
    out, i = [], 0
    while i < len(pattern):
        for field, width in _FIELD_WIDTHS:
            if pattern.startswith(field, i):
                out.append((field, width))
                i += len(field)
                break
        else:
            out.append((pattern[i], None))
            i += 1
    return out


def pattern_shape(pattern: str) -> str:
    """A regular expression for the texts ``pattern`` can parse: each field
    becomes its digits, every other character stands for itself."""
    return "^" + "".join(r"\d{%d}" % w if w else re.escape(t)
                         for t, w in _layout(pattern)) + "$"


def pattern_signature(pattern: str) -> str:
    """The digit layout of the texts ``pattern`` can parse: every digit
    written as 9 (``yyyy-MM-dd`` → ``9999-99-99``)."""
    return "".join("9" * w if w else t for t, w in _layout(pattern))


def text_signature(c: Column | str) -> Column:
    """The digit layout of a text (every ASCII digit written as 9)."""
    return F.translate(_col(c), "0123456789", "9999999999")


def signatures_unique(patterns) -> bool:
    sigs = [pattern_signature(p) for p in patterns]
    return len(set(sigs)) == len(sigs) and not any(
        ch.isdigit() and ch != "9" for s in sigs for ch in s)


def _fixed_width(pattern: str) -> bool:
    """True when every letter of the pattern belongs to a known field, so
    the pattern is a fixed-width digit layout."""
    return all(w or not t.isascii() or not t.isalpha() for t, w in _layout(pattern))


def _from_fields(c: Column, pattern: str) -> Column:
    """The wall-clock value of a text laid out as ``pattern``, read field by
    field at its fixed positions: a TIMESTAMP_NTZ, so the result does not
    depend on the session time zone. Impossible values (month 13, Feb 30,
    hour 24, second 60) give NULL. Missing fields default like a date parser:
    year 1970, month and day 1, time 00:00:00."""
    fields, pos = {}, 1
    for tok, width in _layout(pattern):
        if width:
            fields[tok] = F.substring(c, pos, width).cast("int")
            pos += width
        else:
            pos += 1
    y, mo, d = (fields.get("yyyy", F.lit(1970)), fields.get("MM", F.lit(1)),
                fields.get("dd", F.lit(1)))
    h, mi, sec = (fields.get("HH", F.lit(0)), fields.get("mm", F.lit(0)),
                  fields.get("ss", F.lit(0)))
    ok = (h < 24) & (mi < 60) & (sec < 60)
    return F.when(ok, F.try_make_timestamp_ntz(y, mo, d, h, mi, sec))


def _parse_fitting(c: Column, pattern: str) -> Column:
    """Parse a text already known to have the pattern's layout."""
    if _fixed_width(pattern):
        return _from_fields(c, pattern)
    # other pattern letters: the formatter, read in the session zone
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


_FIELD_GETTERS = {"yyyy": F.year, "MM": F.month, "dd": F.dayofmonth,
                  "HH": F.hour, "mm": F.minute, "ss": F.second}


def wall_clock_text(c: Column | str, pattern: str) -> Column:
    """A wall-clock timestamp rendered with ``pattern`` without passing
    through the session time zone (``date_format`` does, and shows a time in
    a daylight-saving gap, such as midnight on a day the clocks jump at
    midnight, an hour off). Fixed-width patterns are built from the fields;
    others fall back to ``date_format``."""
    c = _col(c)
    if not _fixed_width(pattern):
        return F.date_format(c, pattern)
    parts = []
    for tok, width in _layout(pattern):
        if width:
            parts.append(F.lpad(_FIELD_GETTERS[tok](c).cast("string"), width, "0"))
        else:
            parts.append(F.lit(tok))
    return F.concat(*parts)


def parse_with(c: Column | str, pattern: str) -> Column:
    """Strict parse with one pattern; NULL when the text does not fit.

    The text's shape is tested with a regular expression first; a fitting
    text is then read at its fixed positions (no exception per mismatch, no
    dependence on the session time zone)."""
    c = _col(c)
    return F.when(c.rlike(pattern_shape(pattern)), _parse_fitting(c, pattern))


def candidate_pattern(c: Column | str, patterns) -> Column:
    """The one pattern whose digit layout equals the text's (NULL if none)."""
    sig = text_signature(c)
    out = None
    for p in patterns:
        hit = sig == F.lit(pattern_signature(p))
        out = F.when(hit, F.lit(p)) if out is None else out.when(hit, F.lit(p))
    return out


def parse_any(c: Column | str, patterns=DATE_PATTERNS) -> Column:
    """Wall-clock timestamp (TIMESTAMP_NTZ) from the first pattern that
    parses the whole text.

    When the patterns have distinct digit layouts (true of
    ``DATE_PATTERNS``), at most one pattern can fit a text: the text's layout
    selects it and its fields are read once. Otherwise every pattern is tried
    in order.
    """
    patterns = tuple(patterns)
    if not signatures_unique(patterns):
        return F.coalesce(*[parse_with(c, p) for p in patterns])
    sig = text_signature(c)
    out = None
    for p in patterns:
        hit = sig == F.lit(pattern_signature(p))
        val = _parse_fitting(_col(c), p)
        out = F.when(hit, val) if out is None else out.when(hit, val)
    return out


def date_style(c: Column | str, patterns=DATE_PATTERNS) -> Column:
    """The first pattern that parses the whole text, or NULL."""
    patterns = tuple(patterns)
    if not signatures_unique(patterns):
        return F.coalesce(*[F.when(parse_with(c, p).isNotNull(), F.lit(p))
                            for p in patterns])
    return F.when(parse_any(c, patterns).isNotNull(), candidate_pattern(c, patterns))


def is_date(c: Column | str, patterns=DATE_PATTERNS) -> Column:
    return parse_any(c, patterns).isNotNull()


def reformat(c: Column | str, new_pattern: str, patterns=DATE_PATTERNS) -> Column:
    """Text in any known pattern re-rendered with ``new_pattern`` (each
    layout branch renders its own parse, keeping the expression small)."""
    patterns = tuple(patterns)
    c = _col(c)
    if not signatures_unique(patterns):
        return wall_clock_text(parse_any(c, patterns), new_pattern)
    sig = text_signature(c)
    out = None
    for p in patterns:
        hit = sig == F.lit(pattern_signature(p))
        val = wall_clock_text(_parse_fitting(c, p), new_pattern)
        out = F.when(hit, val) if out is None else out.when(hit, val)
    return out


# ---------------------------------------------------------------- D2 getters

def weekday_number(c: Column | str) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(_col(c)) + 1


def _weekday_name(c: Column | str, field: int) -> Column:
    names = F.array(*[F.lit(w[field]) for w in WEEKDAYS])
    n = weekday_number(c)
    # element_at with a NULL index does not give NULL: guard it.
    return F.when(n.isNotNull(), F.element_at(names, n))


def weekday_cn(c: Column | str) -> Column:
    return _weekday_name(c, 0)


def weekday_en(c: Column | str) -> Column:
    return _weekday_name(c, 1)


def weekday_short(c: Column | str) -> Column:
    return _weekday_name(c, 2)


# ---------------------------------------------------------------- D3 / D4

def shift(c: Column | str, unit: str, amount: int | Column) -> Column:
    """Add ``amount`` units to a timestamp; month ends are clamped
    (Jan 31 + 1 month = Feb 28/29), as a calendar does."""
    unit = unit.upper()
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    n = amount if isinstance(amount, Column) else F.lit(int(amount))
    return F.timestamp_add(unit, n, _col(c))


def shift_text(c: Column | str, unit: str, amount: int,
               patterns=DATE_PATTERNS) -> Column:
    """A date written as text, shifted by ``amount`` units and written back
    in its own pattern (``2019-11-30`` + 1 day → ``2019-12-01``;
    ``2019/11/30 10:00`` stays slash-and-minutes). NULL if the text is not a
    date.

    With distinct layouts, the text's layout picks one branch, and that
    branch reads, shifts and renders its own fields only; the expression
    stays small however many patterns there are."""
    patterns = tuple(patterns)
    c = _col(c)
    if signatures_unique(patterns):
        sig = text_signature(c)
        out = None
        for p in patterns:
            hit = sig == F.lit(pattern_signature(p))
            val = wall_clock_text(shift(_parse_fitting(c, p), unit, amount), p)
            out = F.when(hit, val) if out is None else out.when(hit, val)
        return out
    moved = shift(parse_any(c, patterns), unit, amount)
    style = date_style(c, patterns)
    out = None
    for p in patterns:
        hit = style == F.lit(p)
        val = wall_clock_text(moved, p)
        out = F.when(hit, val) if out is None else out.when(hit, val)
    return out


def interval_days(a: Column | str, b: Column | str) -> Column:
    """Whole days between the calendar days of ``a`` and ``b`` (absolute).
    For dates written as text, pass ``parse_any(text)`` columns."""
    return F.abs(F.datediff(F.to_date(_col(a)), F.to_date(_col(b))))
