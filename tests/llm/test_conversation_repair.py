"""Conversation repair against DuckDB and an exhaustive search."""

import hashlib
import itertools
import re
import zlib

import duckdb
import pytest

from memberscope.llm import conversation_repair as repair
from memberscope.llm.common import read
from memberscope.llm.oracle_sql import REPAIR_SQL

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256")


def by_search(codes):
    """Every edit sequence with at most one insert per gap (two at the ends
    of nothing): the least (cost, audit) with a legal result."""
    best = None
    gaps = [["", "u", "a", "ua"]] * (len(codes) + 1)
    for inserts in itertools.product(*gaps):
        per_row = [["D"] if c == "d" else ["K", "Ru", "Ra", "D"] for c in codes]
        for edits in itertools.product(*per_row):
            roles, audit, cost = inserts[0], "I" * len(inserts[0]), 5 * sum(map(len, inserts))
            for c, e, ins in zip(codes, edits, inserts[1:]):
                audit += e[0] + "I" * len(ins)
                if e == "D":
                    cost += 2
                else:
                    cost += (1 if e[0] == "R" else 0) + (5 if c.isupper() else 0)
                    roles += c.lower() if e == "K" else e[1]
                roles += ins
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_cheapest_repair_by_exhaustive_search():
    for n in range(4):
        for codes in itertools.product("dsuaxSUAX", repeat=n):
            if n == 3 and zlib.crc32("".join(codes).encode()) % 4:
                continue
            assert repair.repair_codes("".join(codes)) == by_search("".join(codes)), codes


def test_stacks_stay_few():
    layer = repair.start_layer()
    for code in "suaxuadUASa" * 30:
        layer = repair.read_turn(layer, code)
        assert len(layer) <= len(repair.ENTRIES)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()), key=repr)


def oracle(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted((tuple(r) for r in con.sql(
        "SELECT " + ", ".join(COLUMNS) + f" FROM ({REPAIR_SQL})").fetchall()), key=repr)


def many_rows():
    """Nulls, ties, repeated rows, odd roles, blanks, one conversation with a
    third of all rows."""
    words = ["Yes.", "No", "Why?", "", " \n", "So it is!", None, "x ", "end. \t", "Yes."]
    roles = ["user", "assistant", "system", "User", None, "", "tool", "assistant", "user"]
    out = []
    for c in [None, *range(60)]:
        for k in range(zlib.crc32(f"n{c}".encode()) % 9):
            h = zlib.crc32(f"{c}/{k}".encode())
            out.append((c, None if h % 11 == 0 else k + h % 3, roles[h // 7 % 9], words[h // 5 % 10]))
    out += [(7, 100 + k // 2, roles[k * 7 % 9], f"{words[k * 5 % 10]}{k % 40}") for k in range(150)]
    return out + out[:20]


@pytest.mark.parametrize("long_rows", [3, 4000])
def test_matches_sql_whole_and_in_segments(spark, monkeypatch, long_rows):
    monkeypatch.setattr(repair, "SEGMENT_BITS", 3)
    rows = many_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS kind", "2 AS pos", "map('a', 1) AS m")
    got = rows_of(repair.repair_summary(repair.damage(df), long_rows=long_rows))
    assert got == oracle(rows)
    assert len(got) == len({r[0] for r in rows})


@pytest.mark.parametrize("long_rows", [3, 4000])
def test_repaired_turns_give_the_digest(spark, monkeypatch, long_rows):
    monkeypatch.setattr(repair, "SEGMENT_BITS", 3)
    df = spark.createDataFrame(many_rows(), "conv_id long, turn long, role string, text string")
    turns = repair.damage(df)
    out = {}
    for r in repair.repaired_turns(turns, long_rows=long_rows).orderBy("conv_id", "position").collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    for r in repair.repair_summary(turns).collect():
        rows = out.get(r.conv_id, [])
        text = "\n".join(f"{role}:{t}" for role, t in rows)
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in rows))


def test_given_table_and_empty_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "conversations")
    got = rows_of(repair.repair_summary(repair.damage(docs)))
    assert got == oracle([tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()])
    assert repair.repair_summary(repair.damage(docs.limit(0))).count() == 0


def test_undamaged_turns_and_very_long_texts(spark):
    df = spark.createDataFrame([("a", 1, "user", "Hi? " * 300_000), ("a", 2, "assistant", "Yes."),
                                ("b", 1, None, None)], "conv_id string, turn int, role string, text string")
    got = {r.conv_id: r for r in repair.repair_summary(repair.clean_turns(df)).collect()}
    assert (got["a"].cost, got["a"].audit) == (0, "KK")
    assert (got["b"].blank, got["b"].cost, got["b"].audit) == (1, 2, "D")
