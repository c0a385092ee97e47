"""Conversation structure repair by a run-length dynamic program over min-plus matrices.

Every row of a conversation is a symbol: its role's initial, and whether it must go
(blank, duplicate) or ends too early (truncated). Spark orders the rows over range
partitions, so one conversation can span many tasks, and each task hands on only the runs
of equal symbols. A run of n rows advances the cheapest cost by the n-th min-plus power of
its symbol's transition, made from cached binary powers; the choices are then unrolled
from the front, a run being halved along the same powers, into the audit. A second pass
streams the texts that stay through one digest a conversation.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import store, table

#: states: nothing yet, after the system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
#: the state that a kept or inserted initial leads to, by state; None where the structure forbids it
NEXT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
REROLE, DELETE, INSERT, LATE = 2, 3, 2, 1
INF = 1 << 40
#: symbol 0 must be deleted; the others are an initial and whether the row is truncated
OTHER = "o"
SYMBOLS = [None] + [(c, late) for c in ("s", "u", "a", OTHER) for late in (False, True)]
#: runs that a task holds before it hands them on, and runs between two costs that are kept
RUNS, BLOCK = 1 << 16, 1 << 12


def _forward(state: int) -> tuple[int, str] | None:
    """The user or assistant turn that the structure takes next in a state, as (state, initial)."""
    return (ASSISTANT, "a") if state == USER else (USER, "u")


def _times(x: tuple, y: tuple) -> tuple:
    """Min-plus product of two 4 x 4 matrices."""
    return tuple(tuple(min(x[i][k] + y[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _apply(x: tuple, v: tuple) -> tuple:
    """Min-plus product of a matrix and a column."""
    return tuple(min(x[i][k] + v[k] for k in range(4)) for i in range(4))


def _inserts() -> tuple:
    """Least cost of inserted turns from state to state."""
    out = [[0 if i == j else INF for j in range(4)] for i in range(4)]
    for i in range(4):
        state, cost = i, 0
        for _ in range(3):
            state, cost = _forward(state)[0], cost + INSERT
            out[i][state] = min(out[i][state], cost)
    return tuple(map(tuple, out))


INSERTS = _inserts()
#: cost to end in each state: inserts up to a state where the structure may end
END = _apply(INSERTS, (0, INF, INF, 0))


def _row(symbol: int) -> tuple:
    """Least cost of one row of a symbol from state to state, without inserts."""
    out = [[INF] * 4 for _ in range(4)]
    for i in range(4):
        out[i][i] = DELETE
        if SYMBOLS[symbol]:
            initial, late = SYMBOLS[symbol]
            to = _forward(i)[0]
            out[i][to] = min(out[i][to], REROLE + LATE * late)
            kept = NEXT[initial][i] if initial in NEXT else None
            if kept is not None:
                out[i][kept] = min(out[i][kept], LATE * late)
    return tuple(map(tuple, out))


@lru_cache(maxsize=1024)
def _power(symbol: int, k: int) -> tuple:
    """The transition of 2**k rows of a symbol, inserts before each row included."""
    if k == 0:
        return _times(INSERTS, _row(symbol))
    half = _power(symbol, k - 1)
    return _times(half, half)


def _advance(symbol: int, n: int, after: tuple) -> tuple:
    """Cost to go before a run of n rows, from the cost to go after it."""
    k = 0
    while n:
        if n & 1:
            after = _apply(_power(symbol, k), after)
        n, k = n >> 1, k + 1
    return after


def _choose(symbol: int, state: int, after: tuple) -> tuple[str, int]:
    """The cheapest edits for one row (inserts before it included), ASCII-least of equals, and the state they lead to."""
    before = _apply(_power(symbol, 0), after)
    edits = ""
    while True:
        if before[state] == DELETE + after[state]:
            return edits + "D", state
        to = _forward(state)[0]
        if before[state] == INSERT + before[to]:
            edits, state = edits + "I", to
            continue
        initial, late = SYMBOLS[symbol]
        kept = NEXT[initial][state] if initial in NEXT else None
        if kept is not None and before[state] == LATE * late + after[kept]:
            return edits + "K", kept
        return edits + "R", to


@lru_cache(maxsize=1 << 14)
def _unroll_from(symbol: int, state: int, n: int, after: tuple) -> tuple[str, int]:
    if n == 1:
        return _choose(symbol, state, after)
    k = (n - 1).bit_length() - 1
    first, state = _unroll_from(symbol, state, n - (1 << k), _level(_apply(_power(symbol, k), after)))
    rest, state = _unroll_from(symbol, state, 1 << k, after)
    return first + rest, state


def _level(v: tuple) -> tuple:
    """A column less its smallest entry: choices depend on differences only, so few columns are met."""
    low = min(v)
    return tuple(x - low for x in v)


def repair(symbols: bytes | bytearray, lengths) -> tuple[int, str, str]:
    """(least cost, audit, plan) of a conversation given as runs of equal symbols.

    The costs to go are kept for every :data:`BLOCK`-th run and made again for the runs between.
    The plan is the audit without the rows that must go, with the initial that a rerole or an
    insert gives: ``k``, ``d``, ``=u``, ``+a``.
    """
    n, after, marks = len(symbols), END, []
    for k in range(n - 1, -1, -1):
        if (k + 1) % BLOCK == 0 or k == n - 1:
            marks.append(after)
        after = _advance(symbols[k], lengths[k], after)
    cost, state, audit, plan = after[START], START, [], []
    for low in range(0, n, BLOCK):
        high, after = min(low + BLOCK, n), [marks.pop()]
        for k in range(high - 1, low, -1):
            after.append(_advance(symbols[k], lengths[k], after[-1]))
        for k in range(low, high):
            edits, end = _unroll_from(symbols[k], state, lengths[k], _level(after[high - 1 - k]))
            audit.append(edits)
            plan.append(_steps(symbols[k], state, edits))
            state = end
    while state not in (START, ASSISTANT):
        state, initial = _forward(state)
        audit.append("I")
        plan.append("+" + initial)
    return cost, "".join(audit), "".join(plan)


@lru_cache(maxsize=1 << 14)
def _steps(symbol: int, state: int, edits: str) -> str:
    """What the edits of one run mean, from a state on."""
    if symbol == 0 and "I" not in edits:
        return ""
    out = []
    for e in edits:
        if e in "IR":
            state, initial = _forward(state)
            out.append(("+" if e == "I" else "=") + initial)
        elif e == "K":
            state = NEXT[SYMBOLS[symbol][0]][state]
            out.append("k")
        elif symbol:
            out.append("d")
    return "".join(out)


# ---------------------------------------------------------------------------
# the rows

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of a conversation table after the damage of the query's contract; nulls in role and text become one space.

    What happens to a row is read off crc32(``conv_id:turn``) % 20, a null part counting as
    one space: 0 drops it, 1 empties the text, 2 takes out its ``.!?``, 3 repeats it, 4 sets
    the role to user.
    """
    def part(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"),
                                (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).alias("__tm_d"))
    d = F.col("__tm_d")
    text = (F.when(d == 1, F.lit("")).when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return (rows.filter(d != 0)
            .select("conv_id", "turn", F.when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("col"))


def _key(c: str) -> Column:
    """A non-null text that tells conversation ids apart, the null id included."""
    return F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c).cast("string")))


def _symbols(rows: DataFrame) -> DataFrame:
    """(key, digest, turn, role, blank, late, n, text, first): equal rows of one turn once, with their number.

    They are neighbours in the order, so only their number matters; first tells that no
    earlier turn of the conversation has the same role and text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    end = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    base = rows.select(_key("conv_id").alias("key"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    same = (base.select("*", F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("digest"))
            .groupBy("key", "digest", "turn").agg(F.first("role").alias("role"), F.first("text").alias("text"),
                                                  F.count(F.lit(1)).alias("n")))
    same = store(same.select("key", "digest", "turn", "role", "text", "n", (end == "").alias("blank"),
                             (~end.isin(".", "!", "?")).alias("late")), "turns")
    first = same.groupBy("key", "digest").agg(F.max(F.col("turn").isNull()).alias("null"), F.min("turn").alias("low"))
    here = F.when(F.col("null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("low"))
    return store(same.join(first, ["key", "digest"]).withColumn("first", here).drop("null", "low"), "turn_symbols")


_PART = pa.schema([("key", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("symbols", pa.binary()), ("lengths", pa.binary()),
                   ("head", pa.string()), ("tail", pa.string()), ("illegal", pa.int64())])
_PART_DDL = "key string, part int, seq long, symbols binary, lengths binary, head string, tail string, illegal long"
LEGAL = frozenset(("su", "ua", "au"))


def _runs_task():
    """Sorted (key, role, blank, late, n, first) rows -> the runs of each conversation in this partition."""
    number = {s: k for k, s in enumerate(SYMBOLS)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, key = TaskContext.get().partitionId(), 0, None
        runs: list[list[int]] = []
        head = tail = None
        illegal = 0
        done: list[dict] = []

        def flush():
            done.append({"key": key, "part": part, "seq": seq, "symbols": bytes(s for s, _ in runs),
                         "lengths": np.array([n for _, n in runs], dtype="<i8").tobytes(),
                         "head": head, "tail": tail, "illegal": illegal})

        def add(symbol, n):
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += n
            else:
                runs.append([symbol, n])

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                    for c in ("key", "role", "blank", "late", "n", "first")]
            for k, role, blank, late, n, first in zip(*cols, strict=True):
                if k != key or len(runs) >= RUNS:
                    if runs:
                        flush()
                        seq += 1
                    # what is flushed in the middle goes on without a head of its own
                    head, runs, illegal = None, [], 0
                    if k != key:
                        key, tail = k, None
                initial = role[:1]
                if tail is None:
                    head = initial
                else:
                    illegal += tail + initial not in LEGAL
                illegal += (n - 1) * (initial + initial not in LEGAL)
                tail = initial
                if blank or not first:
                    add(0, n)
                else:
                    add(number[initial if initial in NEXT else OTHER, late], 1)
                    if n > 1:
                        add(0, n - 1)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_PART)
                done = []
        if runs:
            flush()
            yield pa.RecordBatch.from_pylist(done, schema=_PART)
    return task


_AUDIT = pa.schema([("key", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("plan", pa.string())])
_AUDIT_DDL = "key string, illegal long, cost long, audit string, plan string"


def _audit_task():
    """Parts sorted by (key, part, seq) -> one row a conversation; it holds that conversation's runs only."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, symbols, lengths, tail, illegal = None, bytearray(), array("q"), None, 0

        def row():
            cost, audit, plan = repair(symbols, lengths)
            return {"key": key, "illegal": illegal, "cost": cost, "audit": audit, "plan": plan}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["key"] != key:
                    if symbols:
                        out.append(row())
                    key, symbols, lengths, tail, illegal = r["key"], bytearray(), array("q"), None, 0
                illegal += r["illegal"]
                if tail is not None and r["head"] is not None:
                    illegal += tail + r["head"] not in LEGAL
                tail = r["tail"]
                more = np.frombuffer(r["lengths"], dtype="<i8").tolist()
                joined = int(bool(symbols) and symbols[-1] == r["symbols"][0])
                if joined:
                    lengths[-1] += more[0]
                symbols += r["symbols"][joined:]
                lengths.extend(more[joined:])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_AUDIT)
        if symbols:
            yield pa.RecordBatch.from_pylist([row()], schema=_AUDIT)
    return task


ROLES = {"u": "user", "a": "assistant"}


def _digest_task(with_turns: bool):
    """Sorted by key, a conversation's plan before its rows -> the digest of the repaired conversation."""
    schema = pa.schema([("key", pa.string()), ("repaired_sha256", pa.string()), ("repaired", pa.list_(pa.string()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, plan, at, digest, turns, lines = None, "", 0, None, [], 0

        def put(line: str):
            nonlocal lines
            digest.update(("\n" + line if lines else line).encode())
            lines += 1
            if with_turns:
                turns.append(line)

        def inserts():
            nonlocal at
            while plan[at:at + 1] == "+":
                put(ROLES[plan[at + 1]] + ":")
                at += 2

        def row():
            inserts()
            return {"key": key, "repaired_sha256": digest.hexdigest(), "repaired": turns if with_turns else None}

        for batch in batches:
            out = []
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("key", "plan", "role", "text")]
            for k in range(batch.num_rows):
                own, now, role, text = (c[k].as_py() for c in cols)
                if now is not None:
                    if key is not None:
                        out.append(row())
                    key, plan, at, digest, turns, lines = own, now, 0, hashlib.sha256(), [], 0
                    continue
                inserts()
                edit = plan[at]
                at += 1
                if edit == "=":
                    role, at = ROLES[plan[at]], at + 1
                if edit != "d":
                    put(f"{role}:{text}")
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist([row()], schema=schema)
    return task


def repair_conversations(rows: DataFrame, with_turns: bool = True) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text) with its faults and cheapest repair.

    A conversation's rows are taken by turn, nulls first; rows of one turn by the digest of
    role and text. A row is blank (no other character than U+0020 and U+0009 to U+000D),
    else duplicate (role and text seen earlier), else truncated (the last other character
    is none of ``.!?``). Keeping a row costs 0, another role 2, deleting it 3 (required for
    blank and duplicate rows), inserting an empty user or assistant turn 2; a truncated row
    that stays adds 1. The repair is the cheapest list of edits after which the roles'
    initials read ``(s?(ua)+)?``.

    Returns conv_id, gaps (turns missing between the first and the last), blank, duplicate,
    truncated, illegal (neighbours whose initials are not su, ua or au), cost, audit (the
    edits' initials K, R, D, I in order, the ASCII-least of the cheapest), repaired_sha256
    (``role:text`` lines joined by newlines) and, with ``with_turns``, these lines as
    repaired. A null role or text counts as one space; a null conv_id is a conversation of
    its own; an empty table gives an empty result. Other columns are ignored.

    A conversation's rows may fill many partitions; a task holds only its runs, which the
    audit bounds. Only the digest (and ``repaired``) of a conversation passes one task, as a
    stream, since SHA-256 has to read it in order.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    same = _symbols(rows)
    order = ["key", "turn", "digest"]  # ascending puts null turns first
    runs = (same.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .select("key", "role", "blank", "late", "n", "first").mapInArrow(_runs_task(), _PART_DDL))
    audits = store(runs.repartition(parts, "key").sortWithinPartitions("key", "part", "seq")
                   .mapInArrow(_audit_task(), _AUDIT_DDL), "audits")
    n, bad = F.col("n"), F.col("blank")
    late = ~bad & F.col("first") & F.col("late")
    # counts of distinct turns first: a conversation may hold a third of all rows
    turns = same.groupBy("key", "turn").agg(
        F.sum(F.when(bad, n).otherwise(0)).alias("blank"),
        F.sum(F.when(bad, 0).when(F.col("first"), n - 1).otherwise(n)).alias("duplicate"),
        F.sum(F.when(late, 1).otherwise(0)).alias("truncated"))
    counts = turns.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])
    none = F.lit(None).cast("string")
    stay = (same.filter(~bad & F.col("first"))
            .select("key", F.lit(1).alias("kind"), "turn", "digest", none.alias("plan"), "role", "text"))
    plans = audits.select("key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), none.alias("digest"), "plan",
                          none.alias("role"), none.alias("text"))
    digests = (stay.unionByName(plans).repartition(parts, "key").sortWithinPartitions("key", "kind", "turn", "digest")
               .select("key", "plan", "role", "text")
               .mapInArrow(_digest_task(with_turns), "key string, repaired_sha256 string, repaired array<string>"))
    ids = rows.select(_key("conv_id").alias("key"), "conv_id").groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    out = ids.join(counts, "key").join(audits.drop("plan"), "key").join(digests, "key")
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return out.select(*cols, *["repaired"] * with_turns)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the damaged conversations, one row for every original conv_id."""
    conversations = table(spark, sf_dir, "conversations")
    out = repair_conversations(damaged(conversations), with_turns=False)
    found = out.withColumn("key", _key("conv_id")).drop("conv_id")
    ids = conversations.select(_key("conv_id").alias("key"), "conv_id").groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    zero = {c: F.lit(0) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    zero |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return ids.join(found, "key", "left").select("conv_id", *[F.coalesce(c, v).alias(c) for c, v in zero.items()])
