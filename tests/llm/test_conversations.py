import hashlib
import random
import re
import zlib
from collections import defaultdict
from heapq import heappop, heappush

import pytest
from pyspark.sql import functions as F

from dimsmith.llm import conversation_repair as op

from .conftest import SF
from .helpers import bag

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Dijkstra over (rows read, role initials written): no tables, no merging but equal positions."""
    ok = re.compile("s?(ua)*u?")
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, tail, lines = heappop(heap)
        done = at == len(rows)
        state = (at, "" if not tail else "s" if tail == "s" else tail[-1] + ("2" if len(tail.lstrip("s")) > 1 else ""))
        if done and re.fullmatch("(s?(ua)+)?", tail):
            return cost, audit, lines
        if state in seen:
            continue
        seen.add(state)
        options = [(3, "I", "u", "user:"), (3, "I", "a", "assistant:")]
        if not done:
            role, text, fault = rows[at]
            options.append((4, "D", None, None))
            if fault in ("", "t"):
                late = 3 if fault == "t" else 0
                options += [(late, "K", role[:1], f"{role}:{text}"), (3 + late, "R", "u", f"user:{text}"),
                            (3 + late, "R", "a", f"assistant:{text}")]
        for more, edit, initial, line in options:
            if edit != "D" and not (initial and ok.fullmatch(tail + initial)):
                continue
            now = tail if edit == "D" else tail + initial
            short = now if len(now) < 6 else now[:1] * (now[0] == "s") + "ua" + ("u" if now[-1] == "u" else "")
            heappush(heap, (cost + more, audit + edit, at + (edit != "I"), short, lines if edit == "D" else (*lines, line)))


def expected(rows):
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        have = kept[conv]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        have += [(turn, role, text)] * (kind != 0) * (1 + (kind == 3))
    out = []
    for conv, have in kept.items():
        have.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in have:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = [t for t, _, _ in have if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(have, have[1:]))
        cost, audit, lines = cheapest([(r, t, f) for (_, r, t), f in zip(have, faults)])
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"),
                    faults.count("d"), faults.count("t"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def made(seed, conversations=60):
    rnd, rows = random.Random(seed), []
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "sys"]
    texts = ["Hello.", "hello", "  ", None, "", "What?  \n", "Wow!", "ends here\x0b", "日本語。", "é.", "Hello."]
    for conv in range(conversations):
        for turn in range(rnd.randint(1, 9)):
            legal = rnd.random() < 0.6
            rows.append((conv if conv % 13 else None, rnd.choice([turn, turn, turn + rnd.randint(0, 3), None]),
                         roles[turn % 2] if legal else rnd.choice(roles), rnd.choice(texts) if not legal else f"t{turn}."))
    return rows + rows[:7]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(session, seed):
    rows = made(seed)
    df = session.createDataFrame(rows, SCHEMA).repartition(5)
    got = op.report(df)
    assert got.columns == COLUMNS
    assert bag(map(tuple, got.collect())) == bag(expected(rows))


def test_table_equals_brute_force(session):
    df = session.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert bag(map(tuple, op.report(df).collect())) == bag(expected(rows))


def test_long_conversations_in_many_segments(session, monkeypatch):
    """Conversations over many segments and partitions: the same result as in one."""
    monkeypatch.setattr(op, "SEGMENT", 7)
    rnd, rows = random.Random(5), []
    for conv in range(4):
        for turn in range(400 if conv == 2 else 60):
            rows.append((conv, turn // 2 if conv == 3 else turn, rnd.choice(["user", "assistant", "system"]),
                         rnd.choice(["Yes.", "No.", f"text {turn}.", f"open {turn}", " "])))
    rows += [rows[-1]] * 30
    got = op.report(session.createDataFrame(rows, SCHEMA).repartition(6))
    assert bag(map(tuple, got.collect())) == bag(expected(rows))


def test_other_columns_types_and_empty_table(session):
    rows = made(9, 12)
    df = session.createDataFrame(rows, SCHEMA)
    odd = df.select(F.col("conv_id").cast("string").alias("c"), F.col("turn").alias("t"), F.col("role").alias("r"),
                    F.col("text").alias("x"), F.lit(1).alias("said"), F.lit(2).alias("copies"), F.lit(3).alias("part"))
    got = op.report(odd, "c", "t", "r", "x").collect()
    assert bag(tuple(r)[1:] for r in got) == bag(r[1:] for r in expected(rows))
    assert {r.conv_id for r in got} == {None if r[0] is None else str(r[0]) for r in rows}
    assert op.report(df.where("false")).collect() == []


def test_all_rows_dropped(session):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = op.report(session.createDataFrame([(5, turn, "user", "Gone.")], SCHEMA)).collect()
    assert list(map(tuple, got)) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_stacks_with_equal_tops_are_merged():
    rows = [(t, r, "x.", "", "d", 1) for t, r in enumerate(["user"] * 50 + ["assistant"] * 50)]
    stacks = op.parse(rows)
    assert set(stacks) <= set(op.TOPS)
    assert op.finish(stacks)[0] == 150  # every second row of each run changes its role
