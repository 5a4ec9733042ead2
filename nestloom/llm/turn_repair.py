"""Repair of conversation structure by dynamic programming over runs (operator 12).

Wanted is a sequence of roles ``(s?(ua)+)?`` by the cheapest edits: keep a turn, give it another role, delete it, insert
an empty turn. Four states (nothing yet, after s, after u, after a) describe a prefix, so a turn acts as a
4 by 4 min-plus matrix that depends only on its role and fault. Equal consecutive symbols are collapsed to
runs; a run advances by cached binary powers of its matrix. Costs-to-go then tell, edit by edit, which
choices stay cheapest, and the least letter among them gives the least audit string.

Matrices can be combined in any grouping, so no conversation has to be in one task: turns are numbered over
range partitions and cut into pieces of at most ``PIECE`` turns. Each piece gives its matrix, one small row;
only these rows are streamed per conversation, backward for the costs at the end of each piece and forward
for the state it starts in. Pieces are unrolled independently. Only the digest of a conversation, which is
sequential by nature, streams its texts in order through one task, one turn in memory at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from nestloom.llm.common import materialize, partitions

RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; the last for every truncated turn that stays
PIECE_BITS = 12
PIECE = 1 << PIECE_BITS
FAR = 1 << 50
SPACE = " \t\n\u000b\f\r"

NONE, S, U, A = range(4)  # states: nothing yet, after s, u, a
_FORCED = (U, U, A, U)  # state after a turn whose role can be chosen
_KEPT = {(NONE, "s"): S, (NONE, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
_ROLES = {U: "user", A: "assistant"}
AT_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)  # cost of inserting what is missing

DROP = 0  # symbol of turns that have to go; others: 1 + 2 * role + truncated, roles s u a and others
_INITIALS = "sua"


def symbol(initial: Column, gone: Column, truncated: Column) -> Column:
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.when(gone, DROP).otherwise(1 + 2 * role + truncated.cast("int")).cast("int")


def _facts(sym: int) -> tuple[str, int]:
    """Initial of the role ('' for others) and the cost of keeping the turn."""
    role = (sym - 1) // 2
    return _INITIALS[role] if role < 3 else "", TRUNCATED * ((sym - 1) % 2)


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix with a matrix or a vector."""
    if y.ndim == 1:
        return (x + y).min(1)
    return (x[:, :, None] + y[None]).min(1)


@cache
def _inserts() -> np.ndarray:
    """Cost from state to state by inserted turns alone."""
    cost = np.full((4, 4), FAR, np.int64)
    for q in range(4):
        cost[q, q] = 0
        cost[q, _FORCED[q]] = min(cost[q, _FORCED[q]], INSERT)
    return times(cost, times(cost, cost))


@cache
def power(sym: int, bit: int) -> np.ndarray:
    """Matrix of ``2 ** bit`` turns of one symbol, insertions before each of them included."""
    if bit:
        half = power(sym, bit - 1)
        return np.minimum(times(half, half), FAR)
    turn = np.full((4, 4), FAR, np.int64)
    for q in range(4):
        turn[q, q] = DELETE
        if sym != DROP:
            initial, extra = _facts(sym)
            turn[q, _FORCED[q]] = min(turn[q, _FORCED[q]], RETAG + extra)
            kept = _KEPT.get((q, initial))
            if kept is not None:
                turn[q, kept] = min(turn[q, kept], extra)
    return times(_inserts(), turn)


def advance(sym: int, count: int, value: np.ndarray) -> np.ndarray:
    """Matrix or costs-to-go ``value`` seen from ``count`` turns of ``sym`` earlier."""
    bit = 0
    while count >> bit:
        if count >> bit & 1:
            value = np.minimum(times(power(sym, bit), value), FAR)
        bit += 1
    return value


def runs_of(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """Collapse equal consecutive symbols."""
    starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1]))) if len(symbols) else np.empty(0, np.int64)
    return symbols[starts].tolist(), np.diff(np.concatenate((starts, [len(symbols)]))).tolist()


def unroll(symbols: list[int], counts: list[int], end: np.ndarray, state: int) -> tuple[list[tuple[str, list[str]]], int]:
    """Edits of each turn (insertions before it, then its own) with their new roles, and the state after all.

    ``end``: costs-to-go after the last turn. Of the cheapest choices the one with the least letter is taken
    each time, so the whole string is the least.
    """
    if not symbols:
        return [], state
    after = [end]
    for sym, count in zip(symbols[:0:-1], counts[:0:-1], strict=True):
        after.append(advance(sym, count, after[-1]))
    out = []
    for sym, count, value in zip(symbols, counts, reversed(after), strict=True):
        togo = [value]
        for _ in range(count):
            togo.append(np.minimum(times(power(sym, 0), togo[-1]), FAR))
        initial, extra = _facts(sym) if sym != DROP else ("", 0)
        for left in range(count, 0, -1):
            here, then = togo[left].tolist(), togo[left - 1].tolist()
            letters, roles = "", []
            while True:
                following = _FORCED[state]
                if DELETE + then[state] == here[state]:
                    letters, roles = letters + "D", [*roles, ""]
                    break
                if INSERT + here[following] == here[state]:
                    letters, roles, state = letters + "I", [*roles, _ROLES[following]], following
                    continue
                kept = _KEPT.get((state, initial)) if sym != DROP else None
                if kept is not None and extra + then[kept] == here[state]:
                    letters, roles, state = letters + "K", [*roles, ""], kept
                else:
                    letters, roles, state = letters + "R", [*roles, _ROLES[following]], following
                break
            out.append((letters, roles))
    return out, state


def closing(state: int) -> tuple[str, list[str]]:
    """Insertions after the last turn."""
    letters, roles = "", []
    while AT_END[state]:
        state = _FORCED[state]
        letters, roles = letters + "I", [*roles, _ROLES[state]]
    return letters, roles


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32`` of ``conv_id:turn``, as the query's contract says; nulls are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")), F.lit(20))
    text = F.when(fate == 1, "").when(fate == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    said = rows.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), fate.alias("_fate"))
    return said.where("_fate <> 0").withColumn("_copy", F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_fate", "_copy")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces: runs and matrix of the turns of one conversation with one ``pos >> PIECE_BITS``."""
    held: list[tuple[int, object, int]] = []

    def piece() -> pa.RecordBatch:
        symbols, counts = runs_of(np.array([s for _, _, s in held]))
        matrix = np.where(np.eye(4, dtype=bool), 0, FAR)
        for sym, count in zip(reversed(symbols), reversed(counts), strict=True):
            matrix = advance(sym, count, matrix)
        return pa.RecordBatch.from_pylist(
            [{"conv_id": held[0][1], "pos": held[0][0], "symbols": symbols, "counts": counts, "matrix": matrix.ravel().tolist()}], schema=schema
        )

    schema = None
    for batch in batches:
        schema = schema or pa.schema([("conv_id", batch.schema.field(1).type), ("pos", pa.int64()), ("symbols", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("matrix", pa.list_(pa.int64()))])
        ready = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (row[0] >> PIECE_BITS != held[0][0] >> PIECE_BITS or row[1] != held[0][1]):
                ready.append(piece())
                held = []
            held.append(row)
        if ready:
            yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
    if held:
        yield piece()


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs-to-go at the end of each piece, last pieces first; whether it is the last one."""
    value, conv, begun = AT_END, None, False
    for batch in batches:
        found, last = [], []
        for key, matrix in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if not begun or key != conv:
                value, conv, begun = AT_END, key, True
                last.append(True)
            else:
                last.append(False)
            found.append(value.tolist())
            value = np.minimum(times(np.array(matrix).reshape(4, 4), value), FAR)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int64())), pa.array(last)], ["pos", "togo", "last"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State after each piece for every state before it."""
    for batch in batches:
        found = []
        for symbols, counts, togo in zip(*(batch.column(k).to_pylist() for k in ("symbols", "counts", "togo")), strict=True):
            found.append([unroll(symbols, counts, np.array(togo), q)[1] for q in range(4)])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("pos"), pa.array(found, pa.list_(pa.int32()))], ["conv_id", "pos", "exits"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State before each piece, in order."""
    state, conv, begun = NONE, None, False
    for batch in batches:
        found = []
        for key, exits in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if not begun or key != conv:
                state, conv, begun = NONE, key, True
            found.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.int32())], ["pos", "state"])


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and new roles of every turn; those after the last turn of a conversation go with that turn."""
    for batch in batches:
        where, edits, roles = [], [], []
        names = ("pos", "symbols", "counts", "togo", "last", "state")
        for pos, symbols, counts, togo, last, state in zip(*(batch.column(k).to_pylist() for k in names), strict=True):
            turns, state = unroll(symbols, counts, np.array(togo), state)
            if last:
                letters, more = closing(state)
                turns[-1] = (turns[-1][0] + letters, turns[-1][1] + more)
            where.extend(range(pos, pos + len(turns)))
            edits.extend(t[0] for t in turns)
            roles.extend(t[1] for t in turns)
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(edits, pa.string()), pa.array(roles, pa.list_(pa.string()))], ["pos", "edits", "roles"])


def repair(rows: DataFrame) -> DataFrame:
    """Every row of ``rows(conv_id, turn, role, text)`` with ``pos``, ``fault``, ``edits`` and ``roles``.

    Rows go by turn, nulls first; equal turns by role, then by a digest of the text. ``fault``: '' or blank,
    duplicate (role and text were there before), truncated. ``edits``: letters of the insertions (I) before
    the row, of its own edit (K keep, R other role, D delete) and, with a conversation's last row, of the
    insertions behind; ``roles``: the new role of each of them, '' where there is none. Null roles and texts
    read as one space, so the latter are blank. A row with an empty role has no initial and is never kept as it is. Rows without conv_id are one conversation. Empty table: no rows.
    """
    spark = rows.sparkSession
    given = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    # the row number parts equal rows, which a range split could not
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.sha2("text", 256).alias("_d"), F.monotonically_increasing_id().alias("_n")]
    keyed = given.select("text", *order)
    laid = keyed.repartitionByRange(partitions(spark), "conv_id", "turn", "role", "_d", "_n").sortWithinPartitions("conv_id", "turn", "role", "_d", "_n")
    placed = materialize(laid.select(F.monotonically_increasing_id().alias("pos"), "conv_id", "turn", "role", "text", "_d"), "turns")

    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    facts = placed.select("pos", "conv_id", "role", "_d", initial.alias("initial"), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    first = facts.where("NOT blank").groupBy("conv_id", "role", "_d").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    judged = facts.join(first, "pos", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    judged = materialize(judged.select("pos", "conv_id", "initial", fault.alias("fault")), "faults")

    gone = F.col("fault").isin("blank", "duplicate")
    chunk = F.shiftright("pos", PIECE_BITS)
    signs = judged.select("pos", "conv_id", symbol(F.col("initial"), gone, F.col("fault") == "truncated").alias("s"))
    kind = dict(judged.dtypes)["conv_id"]
    cut = signs.repartition(partitions(spark), chunk).sortWithinPartitions("pos")
    pieces = materialize(cut.mapInArrow(_runs, f"conv_id {kind}, pos bigint, symbols array<int>, counts array<int>, matrix array<bigint>"), "pieces")

    def streamed(df: DataFrame, visit: Callable, schema: str, *by: Column) -> DataFrame:
        return materialize(df.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", *by).mapInArrow(visit, schema), "streamed")

    ends = streamed(pieces.select("conv_id", "pos", "matrix"), _backward, "pos bigint, togo array<bigint>, last boolean", F.desc("pos"))
    whole = pieces.drop("matrix").join(ends, "pos")
    starts = streamed(whole.mapInArrow(_exits, f"conv_id {kind}, pos bigint, exits array<int>"), _forward, "pos bigint, state int", F.asc("pos"))
    chosen = whole.join(starts, "pos").mapInArrow(_choices, "pos bigint, edits string, roles array<string>")
    return placed.drop("_d").join(judged.select("pos", "fault"), "pos").join(chosen, "pos")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id``, ``pos`` and ``step`` for their order, ``role``, ``text``, ``edit``."""
    steps = F.posexplode(F.arrays_zip(F.split("edits", ""), "roles")).alias("step", "e")
    done = rows.select("conv_id", "pos", "role", "text", steps).select("conv_id", "pos", "step", F.col("e.0").alias("edit"), F.col("e.roles").alias("new"), "role", "text")
    return done.where("edit <> 'D'").select(
        "conv_id", "pos", "step", F.when(F.col("new") == "", F.col("role")).otherwise(F.col("new")).alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit"
    )


_SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_COST = {"D": DELETE, "I": INSERT, "K": 0, "R": RETAG}


class _Digest:
    """Running figures of one conversation."""

    def __init__(self, key):
        self.key, self.sums, self.audit, self.hash = key, dict.fromkeys(_SUMS, 0), [], hashlib.sha256()
        self.turns, self.least, self.last, self.before, self.begun = 0, None, None, None, False

    def add(self, turn: int | None, role: str, text: str, fault: str, edits: str, roles: list[str]) -> None:
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        if fault:
            self.sums[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.sums["illegal"] += 1
        self.before = role[:1]
        self.audit.append(edits)
        for letter, new in zip(edits, roles, strict=True):
            self.sums["cost"] += _COST[letter] + (TRUNCATED if letter in "KR" and fault == "truncated" else 0)
            if letter != "D":
                line = f"{new or role}:{'' if letter == 'I' else text}"
                self.hash.update((("\n" if self.begun else "") + line).encode("utf-8", "surrogatepass"))
                self.begun = True

    def row(self) -> dict:
        if self.turns:
            self.sums["gaps"] = self.last - self.least + 1 - self.turns
        return {"conv_id": self.key, **self.sums, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("turn", "role", "text", "fault", "edits", "roles")
    now, schema = None, None
    for batch in batches:
        schema = schema or pa.schema([batch.schema.field("conv_id"), *[(k, pa.int64()) for k in _SUMS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
        ready = []
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = zip(part.column("conv_id").to_pylist(), zip(*(part.column(k).to_pylist() for k in names), strict=True), strict=True)
            for key, group in groupby(rows, key=lambda r: r[0]):
                if now is None or key != now.key:
                    if now is not None:
                        ready.append(now.row())
                    now = _Digest(key)
                for _, row in group:
                    now.add(*row)
        yield pa.RecordBatch.from_pylist(ready, schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=schema)


def digests(rows: DataFrame, original: DataFrame) -> DataFrame:
    """One row of figures for each conv_id of ``original``; zeros and empty strings for those without rows."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["conv_id"]
    found = (
        rows.select("conv_id", "pos", F.col("turn").cast("bigint").alias("turn"), "role", "text", "fault", "edits", "roles")
        .repartition(partitions(spark), "conv_id")
        .sortWithinPartitions("conv_id", "pos")
        .mapInArrow(_digests, f"conv_id {kind}, {', '.join(f'{k} bigint' for k in _SUMS)}, audit string, repaired_sha256 string")
    )
    ids = original.select(F.col("conv_id").alias("_id")).distinct()
    filled = [F.coalesce(k, F.lit(0)).alias(k) for k in _SUMS]
    joined = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("_id").alias("conv_id"), *filled, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
