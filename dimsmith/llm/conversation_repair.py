"""Conversation repair by generalised LR parsing over the role grammar.

Grammar of role initials: C -> (nothing) | s P | P, P -> u a | P u a. Rows are
the tokens. At each row a graph-structured stack holds every stack that some
edits of the rows so far lead to: shift the row (Keep, Rerole), skip it
(Delete), shift an empty row that isn't there (Insert). Stacks with equal tops
are merged by the least (cost, audit). Equal costs of equal tops over the same
rows have audits of which none is the beginning of another, so the least stays
least whatever follows.

Rows are spread by range of (conversation, turn, role, text), so a conversation
of any length lies in as many tasks as its rows need. A conversation that lies
inside one partition is parsed at once. Of others, each segment of at most
``SEGMENT`` rows is parsed from every stack top; a pass over the segments joins
the parses, and the chosen stretch of each segment is written out in a task of
its own. One conversation's audit and the digest of its text, which are single
values, are the only things put together in one place, segment by segment.

Rows without a conversation id are one conversation with the id null. A null
role or text is one space. A null turn comes first; rows of one turn are taken
by role, then text. Repeated rows are repeated rows: each copy after the first
is a duplicate. An empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from dimsmith.functions.joins import broadcast_if_small

from .common import batches, partitions, reliable

SEGMENT = 512
SPACES = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}

# LR(0) states: 0 start, 1 after s, 2 after the u of a first pair, 3 after pairs,
# 4 after s and pairs, 5 after the u of a further pair. A stack is its top and
# the state below that a reduction returns to (-1: none).
Top = tuple[int, int]
START: Top = (0, -1)
# Shift u, then shift a; the a completes a pair, and its reduction pops to the
# state below and goes on from there.
GOTO = {0: 3, 1: 4, 3: 3, 4: 4}
TOPS: tuple[Top, ...] = ((0, -1), (1, -1), (2, 0), (2, 1), (3, -1), (4, -1), (5, 3), (5, 4))
ACCEPT = {(0, -1), (3, -1), (4, -1)}


def shift(top: Top, symbol: str) -> Top | None:
    """The stack after shifting a role initial and reducing; None if the grammar forbids it."""
    state, below = top
    if symbol == "u" and state in GOTO:
        return (2 if state < 2 else 5), state
    if symbol == "a" and state in (2, 5):
        return GOTO[below], -1
    return (1, -1) if symbol == "s" and state == 0 else None


SHIFTS = {(t, c): n for t in TOPS for c in "sua" if (n := shift(t, c)) is not None}
Stacks = dict[Top, tuple[int, str]]


def _merge(stacks: Stacks, top: Top, cost: int, audit: str) -> bool:
    have = stacks.get(top)
    if have is None or (cost, audit) < have:
        stacks[top] = cost, audit
        return True
    return False


def insert(stacks: Stacks) -> Stacks:
    """Stacks with any number of inserted rows; each costs, so few are ever taken."""
    out, fresh = dict(stacks), list(stacks)
    while fresh:
        cost, audit = out[top := fresh.pop()]
        for c in "ua":
            to = SHIFTS.get((top, c))
            if to is not None and _merge(out, to, cost + INSERT, audit + "I"):
                fresh.append(to)
    return out


def step(stacks: Stacks, initial: str, fault: str) -> Stacks:
    """Stacks after one row, rows inserted before it included."""
    out: Stacks = {}
    late = TRUNCATED if fault == "t" else 0
    for top, (cost, audit) in insert(stacks).items():
        _merge(out, top, cost + DELETE, audit + "D")
        if fault not in ("b", "d"):
            to = SHIFTS.get((top, initial))
            if to is not None:
                _merge(out, to, cost + KEEP + late, audit + "K")
            for c in "ua":
                to = SHIFTS.get((top, c))
                if to is not None:
                    _merge(out, to, cost + REROLE + late, audit + "R")
    return out


# A row: (turn, role, text, fault of its first copy, fault of further copies, copies).
Row = tuple


def parse(rows: Iterable[Row], start: Top = START) -> Stacks:
    stacks: Stacks = {start: (0, "")}
    for _, role, _, fault, _, copies in rows:
        stacks = step(stacks, role[:1], fault)
        if copies > 1:  # further copies can only be deleted; an insertion after them sorts first
            stacks = {t: (c + DELETE * (copies - 1), x + "D" * (copies - 1)) for t, (c, x) in stacks.items()}
    return stacks


def finish(stacks: Stacks) -> tuple[int, str, Top]:
    return min((c, x, t) for t, (c, x) in insert(stacks).items() if t in ACCEPT)


def render(rows: Iterable[Row], audit: str, top: Top) -> tuple[list[str], Top]:
    """Repaired lines of a stretch of rows under an audit that starts at ``top``."""
    copies = ((role, text) for _, role, text, _, _, n in rows for _ in range(n))
    lines = []
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(copies)
        if edit == "D":
            continue
        initial = role[:1]
        if edit in "IR":
            initial = "a" if (top, "a") in SHIFTS else "u"
            role = ROLES[initial]
        top = SHIFTS[top, initial]
        lines.append(f"{role}:{text}")
    return lines, top


def _tally(rows: list[Row]) -> dict:
    """Counts of a run of rows, and what is needed to join it to its neighbours."""
    n = {"b": 0, "d": 0, "t": 0}
    illegal, initials, turns = 0, [], []
    for turn, role, _, fault, again, copies in rows:
        if fault:
            n[fault] += 1
        if copies > 1:
            n[again] += copies - 1
            illegal += copies - 1
        if initials and initials[-1] + role[:1] not in LEGAL:
            illegal += 1
        initials = [*initials[:1], role[:1]]
        if turn is not None and (not turns or turns[-1] != turn):
            turns.append(turn)
    return {"blank": n["b"], "duplicate": n["d"], "truncated": n["t"], "illegal": illegal,
            "ends": (initials[0], initials[-1]) if initials else None,
            "turns": (turns[0], turns[-1], len(turns)) if turns else None}


def _join(a: dict | None, b: dict) -> dict:
    if a is None:
        return b
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal")}
    x, y = a["ends"], b["ends"]
    out["illegal"] += int(bool(x and y) and x[1] + y[0] not in LEGAL)
    out["ends"] = (x[0], y[1]) if x and y else x or y
    x, y = a["turns"], b["turns"]
    out["turns"] = (x[0], y[1], x[2] + y[2] - (x[1] == y[0])) if x and y else x or y
    return out


def _result(tally: dict, cost: int, audit: str) -> tuple:
    first, last, distinct = tally["turns"] or (0, -1, 0)
    return (last - first + 1 - distinct, tally["blank"], tally["duplicate"], tally["truncated"], tally["illegal"],
            cost, audit)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text and dropped: the rows after damage, dropped ones marked and empty.

    A fifth of the rows is damaged by crc32 of ``conv_id:turn`` mod 20.
    """
    conv, turn = F.col(conv_col), F.col(turn_col).cast("long")
    key = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col(turn_col).cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    return rows.select(
        conv.alias("conv_id"), turn.alias("turn"), F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"), F.when(kind == 3, 2).otherwise(1).alias("copies"))


def _ordered(turn: Column) -> Column:
    """Turns as values that sort, a null first."""
    return F.struct(turn.isNotNull().alias("there"), turn.alias("turn"))


def ordered_rows(damaged: DataFrame) -> DataFrame:
    """Distinct rows with their copies and whether an earlier turn has them, spread and sorted by range.

    A dropped row stays as a mark of its conversation.
    """
    rows = damaged.groupBy("conv_id", "turn", "role", "text", "dropped").agg(F.sum("copies").alias("copies"))
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    key = F.sha2(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("conv_id").isNull().cast("string"), said), 256)
    rows = rows.withColumn("said", key)
    firsts = (rows.where("not dropped").groupBy("said")
              .agg(F.min(_ordered(F.col("turn"))).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("said", "first.there", F.col("first.turn").alias("first_turn")))
    again = rows.join(broadcast_if_small(firsts), "said", "left")
    seen = F.coalesce((F.col("turn").isNotNull() & ~F.col("there")) | (F.col("turn") > F.col("first_turn")), F.lit(False))
    order = ["conv_id", "turn", "role", "text", "dropped"]
    return (again.select(*order, "copies", seen.alias("seen"))
            .repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order))


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(conversation, row or None for a dropped one)."""
    for conv, turn, role, text, dropped, copies, seen in zip(*(c.to_pylist() for c in batch.columns)):
        if dropped:
            yield conv, None
            continue
        end = text.rstrip(SPACES)[-1:]
        fault = "b" if not end else "d" if seen else "" if end in ".!?" else "t"
        yield conv, (turn, role, text, fault, fault if fault == "b" else "d", copies)


def _segments(it: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Conversations inside the partition, whole; segments of those that are long or touch its ends."""
    part, seg = TaskContext.get().partitionId(), 0
    conv, rows, first, split = None, None, True, False
    out = []

    def close(last: bool) -> tuple:
        nonlocal seg
        seg += 1
        tally = _tally(rows)
        if first or last or split:
            moves = {t: parse(rows, t) for t in TOPS}
            return conv, part, seg, *[None] * 8, pickle.dumps((tally, moves)), pickle.dumps(rows)
        cost, audit, _ = finish(parse(rows))
        lines, _ = render(rows, audit, START)
        digest = hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()
        return conv, part, seg, *_result(tally, cost, audit), digest, None, None

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for batch in it:
        for c, row in _rows_of(batch):
            if rows is None:
                conv, rows = c, []
            elif c != conv:
                out.append(close(False))
                conv, rows, first, split = c, [], False, False
            elif len(rows) >= SEGMENT:
                split = True
                out.append(close(False))
                rows = []
            if row is not None:
                rows.append(row)
        if len(out) > 500:
            yield emit()
            out = []
    if rows is not None:
        out.append(close(True))
    if out:
        yield emit()


def _rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in it:
        yield from zip(*(c.to_pylist() for c in batch.columns))


class _Joined:
    """The segments of one conversation so far: its tally, its stacks, and the way back through them."""

    def __init__(self):
        self.tally, self.stacks = None, {START: (0, "")}
        self.places: list[tuple[int, int]] = []
        self.came: list[dict[Top, tuple[Top, int]]] = []  # per segment: top after it -> (top before, edits)

    def add(self, part: int, seg: int, tally: dict, moves: dict[Top, Stacks]) -> None:
        stacks, came = {}, {}
        for top, (cost, audit) in self.stacks.items():
            for to, (more, edits) in moves[top].items():
                if _merge(stacks, to, cost + more, audit + edits):
                    came[to] = top, len(edits)
        self.tally, self.stacks = _join(self.tally, tally), stacks
        self.places.append((part, seg))
        self.came.append(came)

    def close(self) -> tuple[tuple, list[tuple]]:
        """Totals of the conversation, and (part, seg, top before, edits) of each segment."""
        cost, audit, top = min((*finish({t: v})[:2], t) for t, v in self.stacks.items())
        at, upto, stretches = len(self.stacks[top][1]), len(audit), []  # rows inserted at the end go with the last segment
        for place, came in zip(reversed(self.places), reversed(self.came)):
            top, edits = came[top]
            at -= edits
            stretches.append((*place, top, audit[at:upto]))
            upto = at
        return _result(self.tally, cost, audit), stretches


_PLACE = "part int, seg int, state int, below int, edits string"
_RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _join_segments(it: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row of totals for each conversation, and a row for each of its segments; segments come in order."""
    def rows() -> Iterator[tuple]:
        conv, joined = None, None

        def done() -> Iterator[tuple]:
            totals, stretches = joined.close()
            yield conv, *[None] * 5, *totals
            for part, seg, top, edits in stretches:
                yield conv, part, seg, *top, edits, *[None] * 7
        for c, part, seg, moves in _rows(it):
            if joined is None or c != conv:
                if joined is not None:
                    yield from done()
                conv, joined = c, _Joined()
            joined.add(part, seg, *pickle.loads(moves))
        if joined is not None:
            yield from done()
    return batches(rows(), schema, 500)


def _write_segments(it: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for conv, part, seg, state, below, edits, held in _rows(it):
            lines, _ = render(pickle.loads(held), edits, (state, below))
            yield conv, part, seg, "\n".join(lines) if lines else None
    return batches(rows(), schema, 50)


def _digests(it: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's text, taken in segment by segment."""
    def rows() -> Iterator[tuple]:
        conv, digest, lines = None, None, False
        for c, _, _, text in _rows(it):
            if digest is None or c != conv:
                if digest is not None:
                    yield conv, digest.hexdigest()
                conv, digest, lines = c, hashlib.sha256(), False
            if text is not None:
                digest.update((b"\n" if lines else b"") + text.encode("utf-8", "surrogatepass"))
                lines = True
        if digest is not None:
            yield conv, digest.hexdigest()
    return batches(rows(), schema)


def _run(df: DataFrame, work, conv: str, columns: str) -> DataFrame:
    ddl = f"conv_id {conv}, {columns}"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return df.mapInArrow(lambda it: work(it, schema), ddl)


def repair(damaged: DataFrame) -> DataFrame:
    """One row a conversation of ``damaged`` (columns as ``damage`` gives them).

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256; counts are those before the repair.
    """
    conv = damaged.schema["conv_id"].dataType.simpleString()
    n = partitions(damaged.sparkSession)
    rows = reliable(ordered_rows(damaged))
    parsed = reliable(_run(rows, _segments, conv, f"part int, seg int, {_RESULT}, moves binary, held binary"))
    result = [f.name for f in StructType.fromDDL(_RESULT)]
    whole = parsed.where("moves IS NULL").select("conv_id", *result)
    opened = parsed.where("moves IS NOT NULL")
    of_one = ["conv_id", "part", "seg"]
    joined = reliable(_run(opened.select(*of_one, "moves").repartition(n, "conv_id").sortWithinPartitions(*of_one),
                           _join_segments, conv, f"{_PLACE}, {_RESULT.replace(', repaired_sha256 string', '')}"))
    stretches = joined.where("part IS NOT NULL").select("part", "seg", "state", "below", "edits").join(
        opened.select(*of_one, "held"), ["part", "seg"])
    texts = _run(stretches.select(*of_one, "state", "below", "edits", "held"), _write_segments, conv,
                 "part int, seg int, text string")
    digests = _run(texts.repartition(n, "conv_id").sortWithinPartitions(*of_one), _digests, conv, "repaired_sha256 string")
    totals = joined.where("part IS NULL").select("conv_id", *result[:-1]).alias("j").join(
        digests.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    return whole.unionByName(totals)


def report(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Damage the rows and repair their conversations."""
    return repair(damage(rows, conv_col, turn_col, role_col, text_col))
