"""Member bitmaps as rows of 64-bit words.

A set of members is a frame of (``word``, ``bits``): word w holds members
64 w … 64 w + 63, one bit each; words without members have no row. Union,
intersection and difference are ``bit_or`` aggregations and bitwise operators
on words, counting is ``bit_count``, all inside code generation. A dense set
costs 1/64 row per member; a sparse one never more rows than a list would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 6


def word_of(member: Column) -> Column:
    return F.shiftright(member.cast("long"), WORD_BITS)


def bit_of(member: Column) -> Column:
    place = member.cast("long").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def both(a: Column, b: Column) -> Column:
    return a.bitwiseAND(b)


def either(a: Column, b: Column) -> Column:
    return a.bitwiseOR(b)


def without(a: Column, b: Column) -> Column:
    return a.bitwiseAND(F.bitwise_not(b))


def size(bits: Column) -> Column:
    """Members of one word."""
    return F.bit_count(bits).cast("long")


def members(words: DataFrame, name: str = "memberId", member_type: str = "bigint") -> DataFrame:
    """One row per member of (word, bits)."""
    base = F.call_function("shiftleft", F.col("word"), F.lit(WORD_BITS))
    places = F.filter(F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1)),
                      lambda k: F.getbit(F.col("bits"), k) == 1)
    return words.select("word", "bits", F.explode(places).alias("place")).select(
        (base + F.col("place")).cast(member_type).alias(name))
