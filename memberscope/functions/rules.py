"""Audience rules (E1–E7): tag rules compiled to one Spark ``Column``.

A rule is ``(label, name, value, type)``: ``name`` is a tag column and
``type`` one of ``match``, ``notMatch``, ``exists``, ``rangeGte``,
``rangeBoth``. A selection combines rules with OR inside one tag column and
AND between tag columns (two sexes can only mean "either").

The compiled predicate is an ordinary expression: it runs inside whole-stage
codegen and, over a Parquet tag table, its comparisons are pushed into the
scan.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from collections import OrderedDict
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DateType, IntegralType, NumericType, StringType,
                               StructType, TimestampNTZType, TimestampType)

from memberscope.functions.calendar import as_date

RULE_TYPES = ("match", "notMatch", "exists", "rangeGte", "rangeBoth")

# Fixed values of the tag page: coupon validity in days, the "last k days"
# choices, the coupon-expiry choices, money ranges, delivery-time thresholds
# in seconds, the goods ids by group, feedback types, sex and channel codes.
COUPON_VALID_DAYS = 8
RECENT_DAYS = (1, 2, 3, 4, 5, 6, 7)
COUPON_EXPIRY_DAYS = (1, 3, 5, 7)
MONEY_RANGES = ("10-50", "50-100", "100-200", "200-500", "500-1000")
OVERTIME_THRESHOLDS = (900, 1800, 2700, 3600)
GOODS_GROUPS = (
    ("coffee", (1, 2, 3, 4)),
    ("juice", (5, 6, 7, 8, 9)),
    ("snacks", (10, 11, 12, 13, 14)),
    ("around", (15, 16, 17, 18, 19)),
)
FEEDBACK_TYPES = (
    (1, "damaged or spilled"),
    (2, "out of stock"),
    (3, "wrong item"),
    (4, "complaint"),
)
SEX_CODES = ((1, "male"), (2, "female"), (-1, "unknown"))
CHANNEL_CODES = ((1, "iOS"), (2, "Android"), (3, "mini program"),
                 (4, "official account"), (5, "H5"))


@dataclass(frozen=True)
class Rule:
    label: str
    name: str
    value: str
    type: str

    def __post_init__(self):
        if self.type not in RULE_TYPES:
            raise ValueError(f"unknown rule type {self.type!r}")


def as_rule(r) -> Rule:
    if isinstance(r, Rule):
        return r
    if isinstance(r, dict):
        return Rule(r.get("label", ""), r["name"], str(r.get("value", "")), r["type"])
    return Rule(*r)


def rules_from_json(text: str) -> list[Rule]:
    """Rules from a tag page selection: ``{"selectedTags": [{"label": …,
    "name": …, "value": …, "type": …}, …]}`` or a bare list of such objects
    (other keys, such as display state, are ignored)."""
    doc = json.loads(text)
    items = doc.get("selectedTags", []) if isinstance(doc, dict) else doc
    return [as_rule(item) for item in items]


NUMBER_RANGE = re.compile(r"\s*(-?\d+(?:\.\d+)?)\s*-\s*(-?\d+(?:\.\d+)?)\s*")
DAY_RANGE = re.compile(r"\s*(\d{4}-\d\d-\d\d)\s*-\s*(\d{4}-\d\d-\d\d)\s*")


def range_bounds(value: str) -> tuple[str, str]:
    """The two bounds of ``lo-hi``: numbers (either may be negative), days
    (yyyy-MM-dd), or texts without a hyphen."""
    m = NUMBER_RANGE.fullmatch(value) or DAY_RANGE.fullmatch(value)
    if m:
        return m.group(1), m.group(2)
    parts = [p.strip() for p in value.split("-")]
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"not a range: {value!r}")
    return parts[0], parts[1]


def check_bound(value: str, dt: DataType) -> None:
    """A bound that the column's type cannot hold would select nobody without
    a word, so it is an error."""
    try:
        if isinstance(dt, IntegralType):
            int(value)
        elif isinstance(dt, NumericType):
            if not Decimal(value).is_finite():
                raise ValueError
        elif isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
            _dt.datetime.fromisoformat(value)
    except (ValueError, InvalidOperation):
        raise ValueError(f"{value!r} is no bound for a {dt.simpleString()} column") from None


def _bound(value: str, dt: DataType) -> Column:
    """A checked range bound as a literal."""
    check_bound(value, dt)
    return typed_literal(value, dt)


def typed_literal(value: str, dt: DataType) -> Column:
    """``value`` as a literal of the column's type (NULL if it cannot be)."""
    if isinstance(dt, StringType):
        return F.lit(value)
    return F.lit(value).try_cast(dt)


def compile_rule(rule, schema: StructType, keep_null: bool = True) -> Column:
    """One rule as a predicate over a frame with ``schema``.

    ``keep_null``: whether ``notMatch`` keeps rows where the tag is missing
    (a search index "must not" does keep them).

    A missing tag makes ``match`` / ``rangeGte`` / ``rangeBoth`` NULL, which a
    filter and ``count_if`` treat as false; rules are only combined with AND
    and OR, so that is the same as false throughout. The leaves stay plain
    comparisons, which Parquet scans of a written tag table can use to skip
    row groups. Only ``notMatch`` negates, so it settles NULL explicitly.
    """
    r = as_rule(rule)
    c = F.col(r.name)
    dt = schema[r.name].dataType
    is_array = isinstance(dt, ArrayType)
    elem = dt.elementType if is_array else dt
    if r.type == "exists":
        return (c.isNotNull() & (F.size(c) > 0)) if is_array else c.isNotNull()
    if r.type in ("match", "notMatch"):
        v = typed_literal(r.value, elem)
        hit = F.array_contains(c, v) if is_array else (c == v)
        if r.type == "match":
            return hit
        # not-equal, with an unknown comparison (missing tag, or a value the
        # column type cannot hold) counted as "does not match"
        miss = ~F.coalesce(hit, F.lit(False))
        return miss if keep_null else (miss & c.isNotNull())
    if r.type == "rangeGte":
        v = _bound(r.value.strip(), elem)
        if is_array:
            return F.exists(c, lambda x: x >= v)
        return c >= v
    vlo, vhi = (_bound(v, elem) for v in range_bounds(r.value))
    if is_array:
        return F.exists(c, lambda x: (x >= vlo) & (x <= vhi))
    return (c >= vlo) & (c <= vhi)


def compile_rules(rules, schema: StructType, keep_null: bool = True) -> Column:
    """All rules: OR inside a tag column, AND between tag columns."""
    by_field: OrderedDict[str, list[Column]] = OrderedDict()
    for r in map(as_rule, rules):
        by_field.setdefault(r.name, []).append(compile_rule(r, schema, keep_null))
    if not by_field:
        return F.lit(True)
    pred = None
    for preds in by_field.values():
        any_of = preds[0]
        for p in preds[1:]:
            any_of = any_of | p
        pred = any_of if pred is None else (pred & any_of)
    return pred


# ---------------------------------------------------------------- E7 relative days

def day_before(as_of, days: int) -> str:
    return (as_date(as_of) - _dt.timedelta(days=days)).isoformat()


def recent_rule(name: str, k: int, as_of) -> Rule:
    """"Last k days": the tag day is on or after ``as_of - k``."""
    return Rule(f"last {k} days", name, day_before(as_of, k), "rangeGte")


def coupon_day_rule(name: str, k: int, as_of,
                    valid_days: int = COUPON_VALID_DAYS) -> Rule:
    """Coupon "k-th day": granted exactly ``valid_days + k`` days before
    ``as_of``."""
    return Rule(f"day {k}", name, day_before(as_of, valid_days + k), "match")


def standard_rules(as_of, sex_codes=SEX_CODES, channel_codes=CHANNEL_CODES,
                   sub_sentinel: str = "null", reg_as_of=None, order_as_of=None,
                   incomplete: str = "-1", charge_ranges=MONEY_RANGES,
                   order_ranges=MONEY_RANGES, thresholds=OVERTIME_THRESHOLDS) -> list[Rule]:
    """Every rule of the tag page, with relative days computed from ``as_of``
    (registrations and orders from days of their own where given).

    ``sex_codes`` / ``channel_codes`` are (value, label) pairs, so a table
    with other codes can reuse the catalogue; so are the code of an
    incomplete profile, the money ranges and the delivery thresholds.
    """
    rules = [Rule(lbl, "sex", str(v), "match") for v, lbl in sex_codes]
    rules += [Rule(lbl, "channel", str(v), "match") for v, lbl in channel_codes]
    rules += [
        Rule("registered", "regTime", "", "exists"),
        Rule("profile incomplete", "address", incomplete, "match"),
        Rule("free coupon granted", "freeCouponTime", "", "exists"),
        Rule("ordered once", "orderCount", "1", "match"),
        Rule("ordered again", "orderCount", "2", "rangeGte"),
        Rule("subscribed", "subOpenId", sub_sentinel, "notMatch"),
        Rule("not subscribed", "subOpenId", sub_sentinel, "match"),
    ]
    rules += [recent_rule("regTime", k, reg_as_of or as_of) for k in RECENT_DAYS]
    rules += [recent_rule("orderTime", k, order_as_of or as_of) for k in RECENT_DAYS]
    rules += [coupon_day_rule("freeCouponTime", k, as_of) for k in RECENT_DAYS]
    rules += [coupon_day_rule("couponTimes", k, as_of) for k in COUPON_EXPIRY_DAYS]
    rules += [Rule(v, "chargeMoney", v, "rangeBoth") for v in charge_ranges]
    rules += [Rule(v, "orderMoney", v, "rangeBoth") for v in order_ranges]
    rules += [Rule(f"{grp} {g}", "favGoods", str(g), "match")
              for grp, ids in GOODS_GROUPS for g in ids]
    rules += [Rule(f">= {t}s", "overTime", str(t), "rangeGte")
              for t in thresholds]
    rules += [Rule(lbl, "feedBack", str(v), "match") for v, lbl in FEEDBACK_TYPES]
    return rules
