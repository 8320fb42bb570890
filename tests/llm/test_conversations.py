"""Conversation repair against a plain dynamic program that holds every
audit, on random conversations cut into blocks of several sizes."""

import hashlib
import random
import re

import brute
import pytest
from cohortkit.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, rid long, h string, ops string"
COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
ROLES = ["user", "assistant", "system", "tool", None, "", "sys", "User"]
TEXTS = ["Hi.", "ok", "", "  \n", "What? ", "Yes!", "a.b", None, "x.\t", "é。", " "]


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 7, "h", "D") for r in rows], SCHEMA).repartition(parts)


def told(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


def report(got):
    rows = got.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLS) for r in rows}
    assert len(out) == len(rows)
    return out


def some_rows(seed, n=300):
    r = random.Random(seed)
    return [(r.choice([1, 2, 3, 3, 3, 3, 4, None]), r.choice([None, *range(40)]), r.choice(ROLES[:2] if r.random() < 0.7 else ROLES), r.choice(TEXTS)) for _ in range(n)]


@pytest.mark.parametrize("block_rows,fan", [(4096, 4096), (7, 3), (2, 2)])
def test_random_conversations(spark, block_rows, fan):
    rows = some_rows(block_rows)
    got = report(C.repair_report(table(spark, rows), spark.createDataFrame([(9,), (1,), (1,)], "conv_id long").union(table(spark, rows).select("conv_id")), block_rows, fan))
    assert got == brute.conversation_rows(told(rows), [9])
    assert got[9] == (0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")


def test_one_long_conversation_of_equal_and_other_rows(spark):
    rows = [(5, 1, "user", "same words.")] * 400 + [(5, i, ROLES[i % 3], f"row {i}.") for i in range(300)] + [(6, None, "user", "Hi?"), (6, None, "assistant", "Yes.")]
    assert report(C.repair_report(table(spark, rows), None, 16, 4)) == brute.conversation_rows(told(rows), [])


def test_whole_table_after_damage(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()] + [(None, None, None, None), (None, 3, "user", "q?"), (70, None, "assistant", None)]
    d = table(spark, rows)
    assert report(C.repair_report(C.damaged(d), d.select("conv_id"))) == brute.conversation_rows(brute.damaged_turns(rows), [r[0] for r in rows])


def test_repaired_rows_read_as_they_should(spark):
    rows = some_rows(8)
    got = {}
    for r in C.repaired_rows(table(spark, rows), 5, 3).collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    want = brute.conversation_rows(told(rows), [])
    for c, lines in got.items():
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest() == want[c][-1]


def test_empty_table(spark):
    none = table(spark, [(1, 1, "user", "x")]).where("false")
    assert C.repair_report(none, none.select("conv_id")).count() == 0
    assert C.repaired_rows(none).count() == 0


def test_vectors_meet_where_the_least_audit_crosses():
    r = random.Random(4)
    for _ in range(300):
        kinds = [r.randrange(16) for _ in range(r.randrange(1, 12))]
        ops, cost = C.operations(kinds, None, None)
        audit = "".join(ops).translate(str.maketrans("uaUA", "IIRR"))
        rows = [("xsua"[k % 4], "t", ["", "truncated", "blank", "duplicate"][k // 4]) for k in kinds]
        assert (cost, audit) == brute.cheapest_repair(rows)[:2]
