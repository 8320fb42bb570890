"""Conversation structure repair by divide and conquer.

A conversation's role initials should read ``(s?(ua)+)?``.  Its cheapest repair keeps,
reroles or deletes each row and inserts empty ones; of equally cheap repairs the one whose
audit (the edits' initials: Delete, Insert, Keep, Rerole) comes first in ASCII is taken.

Four states say what has been read: nothing, ``s``, ``..u`` and ``..a``.  A vector of four
costs goes forward from the first row and one backward from the last until they meet in the
middle; the crossing with the least sum is on a cheapest path, and the halves are solved in the
same way, so only vectors are held and no table of all rows.  Beside its cost the
forward vector carries the order of the states' least audits.  Audits that have read
equally many rows end with a row's edit, so none begins another and their order decides
between whole audits.

Rows are put in order once, without their texts, and cut into blocks of bounded size.
A conversation in one block is solved by itself.  One in several is first crossed
block by block, each block being a step with four by four costs, by the same
recursion; its blocks are then solved in any tasks, between known states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

BLOCK_ROWS = 4096           # rows of a block
FAN = 4096                  # blocks that are crossed together
WHITE = " \t\n\x0b\x0c\r"

NEVER = 1 << 60             # the cost of what cannot be
NEXT = (2, 2, 3, 2)         # the state after a user or assistant that is inserted or reroled
KEEPS = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}     # (state, initial) -> state
END = (0, 4, 2, 0)          # cost of the rows to insert at the end
END_OPS = ("", "ua", "a", "")
FAULTS = ("none", "truncated", "blank", "duplicate")

Step = tuple[tuple[tuple[int, object], ...], ...]       # [from state][to state] -> (cost, order key)


def _edits(initial: int, fault: int) -> tuple[tuple[tuple[int, str, str], ...], ...]:
    """For one row, [from state][to state] -> (cost, audit, operations) of the
    cheapest edits, inserts before the row included.  Operations: ``u``/``a``
    inserts, ``K`` keeps, ``U``/``A`` reroles, ``D`` deletes."""
    table = []
    for start in range(4):
        best = [(NEVER, "", "")] * 4
        at, cost, ops = start, 0, ""
        for _ in range(3):                              # a third insert comes back to a state
            found = [(at, cost + 3, "D", "D")]
            if fault < 2:
                found.append((NEXT[at], cost + 2 + fault, "R", "ua"[NEXT[at] - 2].upper()))
                if (at, initial) in KEEPS:
                    found.append((KEEPS[at, initial], cost + fault, "K", "K"))
            for to, c, audit, op in found:
                best[to] = min(best[to], (c, "I" * len(ops) + audit, ops + op))
            at, cost, ops = NEXT[at], cost + 2, ops + "ua"[NEXT[at] - 2]
        table.append(tuple(best))
    return tuple(table)


#: [initial + 4 * fault], the initial 1 to 3 for s, u, a and 0 for any other.
EDITS = tuple(_edits(kind % 4, kind // 4) for kind in range(16))
STEPS: tuple[Step, ...] = tuple(tuple(tuple((c, audit) for c, audit, _ in row) for row in e) for e in EDITS)


def forward(steps: Sequence[Step], lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Costs of the four states after steps lo to hi, and the order of their
    least audits."""
    cost, order = [NEVER] * 4, [0] * 4
    cost[start] = 0
    for i in range(lo, hi):
        step, got = steps[i], []
        for to in range(4):
            got.append(min((cost[s] + step[s][to][0], order[s], s) for s in range(4)))
        keys = [(g[1], step[g[2]][to][1], to) if g[0] < NEVER else (4, "", to) for to, g in enumerate(got)]
        live = sorted(k for k in keys if k[0] < 4)
        order = [4] * 4
        for n, k in enumerate(live):
            order[k[2]] = n
        cost = [min(g[0], NEVER) for g in got]
    return cost, order


def backward(steps: Sequence[Step], lo: int, hi: int, end: Sequence[int]) -> list[int]:
    """Costs from the four states before steps lo to hi, given those after."""
    cost = list(end)
    for i in range(hi - 1, lo - 1, -1):
        step = steps[i]
        cost = [min(NEVER, min(step[s][to][0] + cost[to] for to in range(4))) for s in range(4)]
    return cost


def meet(steps: Sequence[Step], lo: int, hi: int, start: int, stop: int) -> list[int]:
    """The state after each of the steps lo to hi on the cheapest way from
    ``start`` to ``stop`` whose audit is least."""
    if hi - lo <= 1:
        return [stop] * (hi - lo)
    mid = (lo + hi) // 2
    cost, order = forward(steps, lo, mid, start)
    rest = backward(steps, mid, hi, [0 if s == stop else NEVER for s in range(4)])
    cross = min(range(4), key=lambda s: (min(NEVER, cost[s] + rest[s]), order[s]))
    return meet(steps, lo, mid, start, cross) + meet(steps, mid, hi, cross, stop)


def last_state(steps: Sequence[Step]) -> int:
    """The state after all steps of a whole conversation, before the inserts
    at its end."""
    cost, order = forward(steps, 0, len(steps), 0)
    return min(range(4), key=lambda s: (min(NEVER, cost[s] + END[s]), order[s]))


def summary(steps: Sequence[Step]) -> Step:
    """Some steps as one step."""
    return tuple(tuple(zip(*forward(steps, 0, len(steps), s))) for s in range(4))


def operations(kinds: Sequence[int], start: int | None, stop: int | None) -> tuple[list[str], int]:
    """Each row's operations and their cost; ``start`` is None for a whole
    conversation.  ``stop`` is None where the conversation ends here."""
    steps = [STEPS[k] for k in kinds]
    ends = start is None
    start = 0 if ends else start
    stop = last_state(steps) if ends else stop
    ops, cost, at = [], 0, start
    for kind, to in zip(kinds, meet(steps, 0, len(steps), start, stop)):
        c, _, op = EDITS[kind][at][to]
        ops.append(op)
        cost, at = cost + c, to
    if ends:
        ops[-1] += END_OPS[stop]
        cost += END[stop]
    return ops, cost


# --- Spark -----------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage told by the crc32 of
    ``conv_id:turn`` modulo 20 (0 drops a row, 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 makes it the user's).  Nulls in the key, the role and the text
    count as one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    d = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    got = rows.select(d.alias("d"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"), text.alias("text"))
    return got.where("d <> 0").select(
        "conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _told(rows: DataFrame) -> DataFrame:
    """``rows`` with nulls read as one space and the digest ``h`` of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.unhex(F.sha2(text, 256)).alias("h"), text.alias("text"))


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows without texts in the order of their conversations, numbered:
    (conv_id, turn, role, h, initial, blank, truncated, rid), in a stored table."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    code = F.expr("CASE substring(role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END")
    light = rows.select("conv_id", "turn", "role", "h", code.alias("initial"), (trimmed == "").alias("blank"),
                        ((trimmed != "") & ~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"))
    # equal rows are dealt by their place in the input, so that they fill no single task
    order = ["conv_id", "turn", "role", "h", "__place"]
    light = light.withColumn("__place", F.monotonically_increasing_id())
    light = light.repartitionByRange(*order).sortWithinPartitions(*order).drop("__place")
    return stored(light.withColumn("rid", F.monotonically_increasing_id()), "turns")


_BLOCK = ("conv_id long, rid long, rids array<long>, kinds binary, blank long, duplicate long, truncated long, illegal long, head int, tail int")


def _blocks(light: DataFrame, block_rows: int) -> DataFrame:
    """Runs of at most ``block_rows`` rows of a conversation, in order, with
    each row's kind, the rows of each fault, and the illegal neighbours inside."""
    firsts = light.where(~F.col("blank")).groupBy("conv_id", "role", "h").agg(F.min("rid").alias("rid")).select("rid", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 2).when(F.col("first").isNull(), 3).when(F.col("truncated"), 1).otherwise(0)
    rows = light.join(firsts, "rid", "left").select("rid", "conv_id", (F.col("initial") + 4 * fault).cast("int").alias("kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.strip().split()[0] for f in _BLOCK.split(",")]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), *[pa.int64()] * 4, pa.int32(), pa.int32()]
        conv, rids, kinds, out = None, [], bytearray(), []

        def cut():
            first = [k % 4 for k in kinds]
            n = [sum(k // 4 == f for k in kinds) for f in range(4)]
            illegal = sum(p not in ((1, 2), (2, 3), (3, 2)) for p in zip(first, first[1:]))
            out.append((conv, rids[0], rids, bytes(kinds), n[2], n[3], n[1], illegal, first[0], first[-1]))

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], fields)

        for b in batches:
            for r, c, k in zip(*(x.to_pylist() for x in b.columns)):
                if rids and (c != conv or len(rids) >= block_rows):
                    cut()
                    rids, kinds = [], bytearray()
                conv = c
                rids.append(r)
                kinds.append(k)
            if sum(len(x[2]) for x in out) >= block_rows:
                yield batch()
                out.clear()
        if rids:
            cut()
        if out:
            yield batch()

    return stored(rows.repartitionByRange("rid").sortWithinPartitions("rid").mapInArrow(run, _BLOCK), "turn-blocks")


_STEP = "costs array<long>, orders array<long>"


def _as_step(costs, orders) -> Step:
    return tuple(tuple((int(costs[4 * s + t]), int(orders[4 * s + t])) for t in range(4)) for s in range(4))


def _flat(step: Step) -> tuple[list[int], list[int]]:
    return [c for row in step for c, _ in row], [o for row in step for _, o in row]


def _crossed(steps: DataFrame, fan: int) -> DataFrame:
    """(conv_id, no, start, stop, last) for ``steps`` (conv_id, no, costs,
    orders), the steps of each conversation numbered from 0.  Conversations of
    more than ``fan`` steps are first crossed in runs of so many."""
    schema = "conv_id long, no long, start int, stop int"
    if steps.where(F.col("no") >= fan).isEmpty():
        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("no")
            s = [_as_step(c, o) for c, o in zip(pdf["costs"], pdf["orders"])]
            states = meet(s, 0, len(s), 0, last_state(s))
            return pd.DataFrame({"conv_id": pdf["conv_id"].astype("Int64"), "no": pdf["no"], "start": [0, *states[:-1]], "stop": states})
        return steps.groupBy("conv_id").applyInPandas(whole, schema)

    runs = steps.withColumn("run", F.floor(F.col("no") / fan).cast("long"))

    def folded(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        c, o = _flat(summary([_as_step(c, o) for c, o in zip(pdf["costs"], pdf["orders"])]))
        return pd.DataFrame({"conv_id": pdf["conv_id"].astype("Int64").iloc[:1], "no": pdf["run"].iloc[:1], "costs": [c], "orders": [o]})

    above = _crossed(stored(runs.groupBy("conv_id", "run").applyInPandas(folded, f"conv_id long, no long, {_STEP}"), "turn-runs"), fan)

    def inside(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a = a.sort_values("no")
        s = [_as_step(c, o) for c, o in zip(a["costs"], a["orders"])]
        states = meet(s, 0, len(s), int(b["start"].iloc[0]), int(b["stop"].iloc[0]))
        return pd.DataFrame({"conv_id": a["conv_id"].astype("Int64"), "no": a["no"], "start": [int(b["start"].iloc[0]), *states[:-1]], "stop": states})

    return runs.groupBy("conv_id", "run").cogroup(above.withColumnRenamed("no", "run").groupBy("conv_id", "run")).applyInPandas(inside, schema)


def _solved(light: DataFrame, block_rows: int, fan: int) -> DataFrame:
    """The blocks with their rows' operations (``ops``) and ``cost``; illegal
    neighbours at a block's beginning count as its own."""
    blocks = _blocks(light, block_rows)
    several = blocks.groupBy("conv_id").agg(F.count("*").alias("blocks")).where("blocks > 1")
    w = Window.partitionBy("conv_id").orderBy("rid")
    many = blocks.join(several.withColumnRenamed("conv_id", "__c"), F.col("conv_id").eqNullSafe(F.col("__c"))).select(
        "conv_id", "rid", "kinds", "head", F.lag("tail").over(w).alias("before"), (F.row_number().over(w) - 1).cast("long").alias("no"), "blocks")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_flat(summary([STEPS[k] for k in kinds])) for kinds in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.list_(pa.int64())) for i in (0, 1)] + b.columns[1:], ["costs", "orders", *b.schema.names[1:]])

    legal = F.struct("before", "head").isin(*[F.struct(F.lit(a), F.lit(b)) for a, b in ((1, 2), (2, 3), (3, 2))])
    torn = (F.col("before").isNotNull() & ~F.coalesce(legal, F.lit(False))).cast("long")
    steps = stored(many.select("kinds", "conv_id", "rid", "no", torn.alias("torn"), (F.col("no") == F.col("blocks") - 1).alias("last")).mapInArrow(
        fold, f"{_STEP}, conv_id long, rid long, no long, torn long, last boolean"), "turn-steps")
    crossed = _crossed(steps.select("conv_id", "no", "costs", "orders"), fan)
    known = steps.select(F.col("conv_id").alias("__c"), "no", "rid", "torn", "last").join(
        crossed, F.col("__c").eqNullSafe(F.col("conv_id")) & (steps["no"] == crossed["no"])).select("rid", "torn", "last", "start", "stop")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, start, stop, last = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("kinds", "start", "stop", "last"))
            ops, cost = [], []
            for k, s, t, z in zip(kinds, start, stop, last):
                o, c = operations(k, s, t)
                if z:
                    o[-1] += END_OPS[t]
                    c += END[t]
                ops.append(o)
                cost.append(c)
            keep = [c for c in b.schema.names if c not in ("kinds", "start", "stop", "last")]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep] + [pa.array(ops, pa.list_(pa.string())), pa.array(cost, pa.int64())], [*keep, "ops", "cost"])

    torn = F.coalesce("torn", F.lit(0).cast("long"))
    rows = blocks.join(known, "rid", "left").select("conv_id", "rid", "rids", "blank", "duplicate", "truncated", (F.col("illegal") + torn).alias("illegal"), "kinds", "start", "stop", "last")
    small_batches(rows.sparkSession)
    return stored(rows.mapInArrow(solve, "conv_id long, rid long, rids array<long>, blank long, duplicate long, truncated long, illegal long, ops array<string>, cost long"), "turn-edits")


_LINE = "conv_id long, role string, text string"


def _lines(rows: DataFrame, light: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired rows, each conversation within one partition and in order.
    A text is shuffled once and no conversation is held: the rows come in order,
    each text just before the edits of the rows that have it."""
    edits = solved.select(F.explode(F.arrays_zip("rids", "ops")).alias("e")).select(F.col("e.rids").alias("rid"), F.col("e.ops").alias("op")).where("op <> 'D'")
    cols = ["conv_id", "turn", "role", "h"]
    edits = light.select(*cols, "rid").join(edits, "rid").select(*cols, "rid", "op", F.lit(None).cast("string").alias("text"))
    texts = rows.select(*cols, F.lit(None).cast("long").alias("rid"), F.lit(None).cast("string").alias("op"), "text")
    dealt = texts.union(edits).repartition("conv_id").sortWithinPartitions(*cols, "rid").select("conv_id", "role", "op", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = ""
        for b in batches:
            out = []
            for conv, role, op, text in zip(*(c.to_pylist() for c in b.columns)):
                if op is None:
                    now = text
                    continue
                for x in op:
                    if x != "D":
                        out.append((conv, role if x == "K" else "user" if x in "uU" else "assistant", now if x in "KUA" else ""))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string()))], ["conv_id", "role", "text"])

    small_batches(rows.sparkSession)
    return dealt.mapInArrow(run, _LINE)


def _digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of rows that come conversation by conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, h = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([h.hexdigest()])], ["conv_id", "repaired_sha256"])
        for b in batches:
            for c, role, text in zip(*(x.to_pylist() for x in b.columns)):
                if h is None or c != conv:
                    if h is not None:
                        yield out()
                    conv, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
        if h is not None:
            yield out()
    return lines.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repaired_rows(rows: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """(conv_id, role, text) of ``rows`` (conv_id, turn, role, text) after the
    cheapest repair, each conversation within one partition and in order; see
    ``repair_report`` for the order and the nulls."""
    told = _told(rows)
    light = _in_order(told)
    return _lines(told, light, _solved(light, block_rows, fan))


def repair_report(rows: DataFrame, every: DataFrame | None = None, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """One row a conversation of ``rows`` (conv_id, turn, role, text): gaps,
    blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.  ``every``
    (conv_id) adds conversations without rows: zeros, an empty audit, the empty hash.

    Rows are ordered by turn, nulls first; rows of equal turn by role, then by the
    SHA-256 of the text.  Null roles and texts count as one space; rows without conv_id are
    one conversation.  A role whose initial is not s, u or a (an empty one too) is never legal.
    Further columns are not looked at; an empty table gives no rows but those of ``every``."""
    told = _told(rows)
    light = _in_order(told)
    solved = _solved(light, block_rows, fan)
    turns = light.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.try_subtract(F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), F.lit(1)), F.count("*")).alias("gaps"))
    piece = F.struct("rid", F.translate(F.array_join("ops", ""), "uaUA", "IIRR").alias("a"))
    report = solved.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["a"]), "").alias("audit"))
    digests = _digests(_lines(told, light, solved))
    ids = light.select("conv_id") if every is None else every.select(F.col("conv_id").cast("long").alias("conv_id"))
    got = ids.distinct()
    for part in (turns, report, digests):
        got = got.unionByName(part, allowMissingColumns=True)
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    got = got.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in [*longs, "audit", "repaired_sha256"]])
    return got.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in longs], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
