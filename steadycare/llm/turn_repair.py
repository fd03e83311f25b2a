"""Repair of the order of roles in conversations by weighted interval parsing.

A sound conversation has the role initials `(s?(ua)+)?`. Its grammar in Chomsky normal form has a symbol [p q] for every
pair of states of that pattern: [p q] derives what leads from p to q, by [p q] -> [p r] [r q], or [p q] -> row with an
edit. Edits cost: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and duplicate rows), Insert an
empty user or assistant turn 5; a truncated row that stays adds 5. A cell of a span holds for every symbol the minimum of
(cost, audit), the audit being the edits' initials in order; inserts enter by their closure, before each row and at the
end. Spans are combined bottom-up by length. Since [p q] takes any r, all splits of a span give the same cell, so one
split, at half its length, is enough: n - 1 combinations for n rows. Of two audits with equal cost over the same rows none
begins the other (the rest would be inserts, which cost), so minima of parts make the minimum of the whole.

Rows are parsed without their texts (a SHA-256 stands for each), equal rows of a turn as one row with a count, in blocks of at most
`BLOCK` rows of a range partitioning, so a conversation may span many tasks. A block leaves eleven cells; the blocks of a
conversation are combined in the same way, with audits shared instead of copied. A third pass puts the edits on the texts.
It is one stream for each conversation, in order, that holds one text at a time: the digest of a whole conversation
is sequential, so its texts do pass one task, whatever their number.

Defined cases: a null role or text, and in the damage a null id or turn, is one space; rows of one turn are ordered by role, then by the
text's SHA-256, so equal rows are neighbours; a null conv_id is one conversation; a conversation without rows is sound and
empty; an empty table gives no rows; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

BLOCK = 1024  # rows that are parsed together; what is longer is combined from blocks

#: White space, what ends a sentence, the costs of the edits.
SPACE = " \t\n\v\f\r"
SENTENCE_ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# --- the grammar ----------------------------------------------------------------------------

#: Initial -> {state before: state after}. 0: nothing yet, 1: after system, 2: after user, 3: after assistant.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
GOALS = (0, 3)
NEEDED = {"u": "user", "a": "assistant"}

Cell = tuple[int, str] | None  # cost and audit; None: the symbol does not derive the span

_forward = {p: {p} for p in range(4)}
for _ in range(4):
    for _p, _reached in _forward.items():
        _reached |= {after for step in STEPS.values() for before, after in step.items() if before in _reached}
SYMBOLS = [(p, q) for p in range(4) for q in sorted(_forward[p])]
_AT = {symbol: i for i, symbol in enumerate(SYMBOLS)}
RULES = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, r in SYMBOLS for q in sorted(_forward[r])]


def _put(cells: list[Cell], symbol: tuple[int, int], cost: int, audit: str) -> None:
    i = _AT[symbol]
    if cells[i] is None or (cost, audit) < cells[i]:
        cells[i] = (cost, audit)


def combine(left: list[Cell], right: list[Cell]) -> list[Cell]:
    """Cells of a span from those of its two parts."""
    out: list[Cell] = [None] * len(SYMBOLS)
    for i, a, b in RULES:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            best = out[i]
            cost = x[0] + y[0]
            if best is None or cost < best[0]:
                out[i] = (cost, x[1] + y[1])
            elif cost == best[0] and (audit := x[1] + y[1]) < best[1]:
                out[i] = (cost, audit)
    return out


def _insert_closure() -> list[Cell]:
    """Cells of the empty span: nothing, or any number of inserts."""
    cells: list[Cell] = [None] * len(SYMBOLS)
    for p in range(4):
        _put(cells, (p, p), 0, "")
    for initial in NEEDED:
        for p, q in STEPS[initial].items():
            _put(cells, (p, q), INSERT, "I")
    while (more := combine(cells, cells)) != cells:
        cells = more
    return cells


INSERTS = _insert_closure()


@cache
def row_cells(initial: str, go: bool, truncated: bool) -> list[Cell]:
    """Cells of one row and the inserts before it. `go`: the row has to be deleted."""
    cells: list[Cell] = [None] * len(SYMBOLS)
    for p in range(4):
        _put(cells, (p, p), DELETE, "D")
    if not go:
        left = TRUNCATED * truncated
        for p, q in STEPS.get(initial, {}).items():
            _put(cells, (p, q), left, "K")
        for wanted in NEEDED:
            if wanted != initial:
                for p, q in STEPS[wanted].items():
                    _put(cells, (p, q), left + REROLE, "R")
    return combine(INSERTS, cells)


def _deleted(n: int) -> list[Cell]:
    """Cells of n rows that have to be deleted. Inserts between them never come first: `D` is before `I`."""
    cells: list[Cell] = [None] * len(SYMBOLS)
    for p in range(4):
        _put(cells, (p, p), DELETE * n, "D" * n)
    return cells


def parse(leaves: list[list[Cell]]) -> list[Cell]:
    """Cells of the whole span, combined bottom-up: spans of 2 rows, of 4, of 8, and so on."""
    spans = leaves or [INSERTS]
    while len(spans) > 1:
        joined = [combine(a, b) for a, b in zip(spans[::2], spans[1::2])]
        spans = joined + spans[len(joined) * 2 :]
    return spans[0]


def illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


# --- shared audits, for conversations of several blocks ----------------------------------------

# A shared cell is (cost, audit, None, None) of a block or (cost, None, left, right).


def _audits(cell) -> Iterator[str]:
    """The audits of the blocks below a cell, in order."""
    open_ = [cell]
    while open_:
        _, audit, left, right = open_.pop()
        if audit is None:
            open_ += [right, left]
        else:
            yield audit


def _before(a, b) -> bool:
    """Whether (cost, audit) of a is less than that of b; audits are compared a part at a time."""
    if a[0] != b[0]:
        return a[0] < b[0]
    xs, ys, x, y = filter(None, _audits(a)), filter(None, _audits(b)), "", ""
    while True:
        x, y = x or next(xs, ""), y or next(ys, "")
        if not (x and y):
            return bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def _combine_shared(left: list, right: list) -> list:
    out: list = [None] * len(SYMBOLS)
    for i, a, b in RULES:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            cell = (x[0] + y[0], None, x, y)
            if out[i] is None or _before(cell, out[i]):
                out[i] = cell
    return out


def _shared(cells: list[Cell]) -> list:
    return [None if c is None else (c[0], c[1], None, None) for c in cells]


def combine_blocks(blocks: list[list[Cell]]) -> tuple[int, list[str]]:
    """Cost, and the audit of each block (the inserts at the end belong to the last), of a whole conversation."""
    spans = [_shared(b) for b in blocks] + [_shared(INSERTS)]
    while len(spans) > 1:
        joined = [_combine_shared(a, b) for a, b in zip(spans[::2], spans[1::2])]
        spans = joined + spans[len(joined) * 2 :]
    best = None
    for goal in GOALS:
        cell = spans[0][_AT[0, goal]]
        if cell is not None and (best is None or _before(cell, best)):
            best = cell
    *parts, last = _audits(best)
    if parts:
        parts[-1] += last
    return best[0], parts


# --- rows -----------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of the rows after the registered query's damage."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    chance = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), chance.alias("chance")
    )
    text = F.when(F.col("chance") == 1, F.lit("")).when(F.col("chance") == 2, F.translate("text", "".join(SENTENCE_ENDS), "")).otherwise(F.col("text"))
    return rows.where("chance <> 0").select(
        "conv_id", "turn", F.when(F.col("chance") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("chance") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    space = F.lit(" ")
    keyed = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), copies.alias("copies"))
    return keyed.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def faults(rows: DataFrame) -> DataFrame:
    """One row for each distinct (conv_id, turn, role, text): its digest, how many there are (n), blank, truncated, and whether the
    same role and text stand in an earlier turn (seen). Staged.

    Equal rows are counted before they are shuffled; a text that a conversation repeats in many turns is a hot key of the join with
    first turns, whose partitions Spark splits.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    light = stage(
        _keyed(rows)
        .withColumns({"blank": trimmed == "", "truncated": ~F.right(trimmed, F.lit(1)).isin(*SENTENCE_ENDS)})
        .groupBy("conv_id", "turn", "role", "digest", "blank", "truncated")
        .agg(F.sum("copies").alias("n")),
        "turn_faults",
    )
    repeated = (
        light.groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
        .where("turns > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), F.col("first.turn").alias("_turn"), F.lit(True).alias("_repeated"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    later = F.col("_repeated").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn"))
    return light.join(repeated, same, "left").select("conv_id", "turn", "role", "digest", "n", "blank", "truncated", later.alias("seen"))


_CELLS = "array<struct<cost: bigint, audit: string>>"
_KEY = ("turn", "role", "digest")


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _written(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 1 + len(row.get("text") or row.get("audit") or "") // 1000
        if weight >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _blocks(schema: pa.Schema, block: int):
    def of_rows(rows: list[dict]) -> dict:
        leaves, before = [], None
        found = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        for row in rows:
            initial, n = row["role"][:1], row["n"]
            if before is not None:
                found["illegal"] += illegal(before, initial)
            found["illegal"] += (n - 1) * illegal(initial, initial)
            before = initial
            if row["blank"]:
                found["blank"] += n
            else:
                found["duplicate"] += n - (not row["seen"])
                found["truncated"] += row["truncated"] and not row["seen"]
            if row["blank"] or row["seen"]:
                leaves.append(_deleted(n))
            else:
                leaves.append(row_cells(initial, False, row["truncated"]))
                if n > 1:
                    leaves.append(_deleted(n - 1))
        turns = [row["turn"] for row in rows if row["turn"] is not None]
        cells = [None if c is None else {"cost": c[0], "audit": c[1]} for c in parse(leaves)]
        return found | {k: rows[0][k] for k in ("conv_id", *_KEY)} | {
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
            "last_role": before, "cells": cells,
        }

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        here, number = TaskContext.get().partitionId(), 0
        for _, rows in groupby(_values(batches), key=lambda r: r["conv_id"]):
            while part := [row for _, row in zip(range(block), rows)]:
                yield of_rows(part) | {"segment": (here << 32) + number}
                number += 1

    return lambda batches: _written(blocks(batches), schema)


def _conversations(schema: pa.Schema):
    """Kind 0: a conversation's counts, cost and audit. Kind 1: the audit of one of its blocks, under the key of its first row."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv_id, group in groupby(_values(batches), key=lambda r: r["conv_id"]):
            found = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            cells, keys, turns, first, last, role = [], [], 0, None, None, None
            for part in group:
                for k in found:
                    found[k] += part[k]
                if role is not None:
                    found["illegal"] += illegal(role, part["role"][:1])
                role = part["last_role"]
                if part["turns"]:
                    turns += part["turns"] - (last is not None and last == part["first_turn"])
                    first = part["first_turn"] if first is None else first
                    last = part["last_turn"]
                cells.append([None if c is None else (c["cost"], c["audit"]) for c in part["cells"]])
                keys.append({k: part[k] for k in _KEY})
            cost, audits = combine_blocks(cells)
            gaps = last - first + 1 - turns if first is not None else 0
            yield found | {"kind": 0, "conv_id": conv_id, "gaps": gaps, "cost": cost, "audit": "".join(audits)}
            for key, audit in zip(keys, audits):
                yield key | {"kind": 1, "conv_id": conv_id, "audit": audit}

    return lambda batches: _written(whole(batches), schema)


def _arrow(df: DataFrame, more: str) -> tuple[str, pa.Schema]:
    """The DDL and the Arrow schema of an output whose key columns have the types of `df`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    key = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in ("conv_id", *_KEY) if c in df.columns)
    ddl = f"{key}, {more}"
    return ddl, to_arrow_schema(StructType.fromDDL(ddl), prefers_large_types=False)


def find_repairs(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The edits of every conversation, staged: see `_conversations` for the two kinds of rows."""
    light = faults(rows)
    order = ("conv_id", *_KEY)
    ddl, schema = _arrow(
        light,
        "segment bigint, first_turn bigint, last_turn bigint, turns bigint, last_role string, "
        f"blank bigint, duplicate bigint, truncated bigint, illegal bigint, cells {_CELLS}",
    )
    blocks = light.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(schema, block), ddl)
    ddl, schema = _arrow(
        light, "kind int, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    )
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return stage(ordered.mapInArrow(_conversations(schema), ddl), "turn_repairs")


def _editor(schema: pa.Schema):
    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv_id, group in groupby(_values(batches), key=lambda r: r["conv_id"]):
            audit, at, state, place = "", 0, 0, 0

            def turn(edit: str, role: str, text: str) -> dict:
                nonlocal state, place
                state, place = STEPS[role[0]][state], place + 1
                return {"conv_id": conv_id, "place": place - 1, "edit": edit, "role": role, "text": text}

            def wanted() -> str:
                return "assistant" if state == 2 else "user"

            for row in group:
                if row["kind"] == 0:
                    audit, at = audit[at:] + row["text"], 0
                    continue
                for _ in range(row["copies"]):
                    while audit[at] == "I":
                        yield turn("I", wanted(), "")
                        at += 1
                    if audit[at] == "K":
                        yield turn("K", row["role"], row["text"])
                    elif audit[at] == "R":
                        yield turn("R", wanted(), row["text"])
                    at += 1
            for _ in audit[at:]:
                yield turn("I", wanted(), "")

    return lambda batches: _written(edit(batches), schema)


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """conv_id, place, edit, role and text of the repaired conversations; in a partition they stand in order, whole."""
    texts = _keyed(rows).select("conv_id", *_KEY, F.lit(1).alias("kind"), "copies", "text")
    edits = repairs.where("kind = 1").select("conv_id", *_KEY, F.lit(0).alias("kind"), F.lit(0).alias("copies"), F.col("audit").alias("text"))
    ordered = texts.unionByName(edits).repartition("conv_id").sortWithinPartitions("conv_id", *_KEY, "kind")
    ddl, schema = _arrow(rows.select("conv_id"), "place bigint, edit string, role string, text string")
    return ordered.mapInArrow(_editor(schema), ddl)


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of `role:text`, joined by line ends, of conversations as `repaired_turns` gives them."""
    ddl, schema = _arrow(turns.select("conv_id"), "repaired_sha256 string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv_id, group in groupby(_values(batches), key=lambda r: r["conv_id"]):
            sha = hashlib.sha256()
            for i, row in enumerate(group):
                sha.update(("\n" * (i > 0) + f"{row['role']}:{row['text']}").encode())
            yield {"conv_id": conv_id, "repaired_sha256": sha.hexdigest()}

    return turns.mapInArrow(lambda batches: _written(digest(batches), schema), ddl)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(rows: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, the counts, cost, audit and repaired_sha256 of every conversation in `ids`, also of those without rows."""
    repairs = find_repairs(rows, block)
    digests = turn_digests(repaired_turns(rows, repairs))
    found = ids.select("conv_id").distinct()
    found = found.unionByName(repairs.where("kind = 0").select("conv_id", *COUNTS, "audit"), allowMissingColumns=True)
    found = found.unionByName(digests, allowMissingColumns=True)
    empty = hashlib.sha256().hexdigest()
    return found.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in COUNTS],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    )
