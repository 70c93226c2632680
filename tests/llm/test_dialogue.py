"""Repaired conversations against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywork.llm import dialogue
from tallywork.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    found = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        found += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return found


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """Cost, audit and lines by trying every edit of every row from each state; none is pruned
    but what costs more, or as much with a greater audit, in the same state."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit, lines) in list(ways.items()):
                new = "a" if state == "u" else "u"
                better(ways, new, (cost + 2, audit + "I", [*lines, full[new] + ":"]))
        return ways

    def better(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    # Ways without a pending insert and those with some are kept apart: audits of unlike length.
    ways = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        step = {}
        for state, (cost, audit, lines) in ways.items():
            ahead = [(state, cost, audit, lines)]
            for _ in range(3):
                s, c, au, li = ahead[-1]
                new = "a" if s == "u" else "u"
                ahead.append((new, c + 2, au + "I", [*li, full[new] + ":"]))
            for s, c, au, li in ahead:
                better(step, s, (c + 3, au + "D", li))
                if fault in ("blank", "duplicate"):
                    continue
                more = 1 if fault == "truncated" else 0
                if role[:1] and role[:1] in follow[s]:
                    better(step, role[0], (c + more, au + "K", [*li, f"{role}:{text}"]))
                new = "a" if s == "u" else "u"
                better(step, new, (c + 2 + more, au + "R", [*li, f"{full[new]}:{text}"]))
        ways = step
    ended = []
    for state, (cost, audit, lines) in ways.items():
        while state not in ("", "a"):
            state = "a" if state == "u" else "u"
            cost, audit, lines = cost + 2, audit + "I", [*lines, full[state] + ":"]
        ended.append((cost, audit, lines))
    return min(ended, key=lambda w: w[:2])


def brute(originals):
    damaged = damage(originals)
    answer = []
    for conv in {r[0] for r in originals}:
        rows = [r for r in damaged if r[0] == conv]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found = faults(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
        cost, audit, lines = cheapest(rows, found) if rows else (0, "", [])
        answer.append(
            (
                conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"),
                sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return sorted(answer, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def report(spark, rows, more=None):
    df = spark.createDataFrame(rows, ROWS)
    if more:
        df = df.withColumns({c: F.lit(7) for c in more})
    return dialogue.repair_report(dialogue.damaged(df), df.select("conv_id"))


def made(seed, conversations=40, longest=9):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randrange(1, longest)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Agent", "ä"])
            text = draw.choice(["Yes.", "No!", "well", "", " \t", "a.\n", "b?", "Süß.", None, "x. y", "Yes."])
            rows.append((conv, None if draw.random() < 0.05 else turn * draw.choice([1, 1, 2]), role, text))
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    found = QUERIES["op11_conversation_repair"](spark, SMALL)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    assert answer(found) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows_equal_brute_force(spark, seed):
    rows = made(seed) + [(None, 1, "user", "Hi."), (None, None, "assistant", "Oh."), (-4, 2, None, None)]
    rows += [(99, 5, "user", "Again.")] * 7 + [(98, n, "user", "Again.") for n in range(6)]
    rows.append((97, 1, "user", "long " * 200_000))
    assert answer(report(spark, rows, ["_fate", "place", "piece", "kind", "copies", "fault", "fate"])) == brute(rows)


def test_conversation_of_many_pieces(spark, settings, monkeypatch):
    # Pieces of four rows, dealt over partitions: the crossing at every seam must be the best one.
    monkeypatch.setattr(dialogue, "PIECE_BITS", 2)
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    draw = random.Random(5)
    rows = [
        (conv, n, draw.choice(["user", "assistant", "system", "tool"]), draw.choice([f"T{n}.", f"t{n}", "", "Same."]))
        for conv, length in ((1, 400), (2, 90), (3, 5))
        for n in range(length)
    ]
    assert answer(report(spark, rows)) == brute(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], ROWS)
    assert dialogue.repair_report(dialogue.damaged(empty), empty.select("conv_id")).collect() == []
    # Every row dropped: the conversation stays, with nothing in it.
    lost = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = report(spark, [(lost, 0, "user", "Gone.")]).first()
    assert tuple(found) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_crossings_keep_to_the_least_audit():
    # Whole runs at once against each run alone, and the audits against the plain search.
    draw = random.Random(3)
    step, order = dialogue.row_costs()
    kinds = np.array([draw.randrange(9) for _ in range(3_000)])
    bounds = sorted({0, 3_000, *(draw.randrange(3_000) for _ in range(300))})
    low, high = np.array(bounds[:-1]), np.array(bounds[1:])
    cost, place = dialogue.whole(step[kinds], order[kinds], low, high)
    last = dialogue.ends(cost, place)
    after = dialogue.crossings(step[kinds], order[kinds], low, high, np.zeros(len(low), int), last)
    for a, b, end in zip(low, high, last, strict=True):
        rows = [(0, n, "uas?"[(k - 1) // 2] if k else "u", "t") for n, k in enumerate(kinds[a:b])]
        found = ["blank" if k == 0 else ("truncated" if k % 2 == 0 else "") for k in kinds[a:b]]
        before = np.concatenate([[0], after[a : b - 1]])
        numbers = order[kinds[a:b], before, after[a:b]]
        audit = "".join(dialogue.SUFFIXES[n] for n in numbers) + dialogue.TRAILING[end]
        assert (audit, after[b - 1]) == (cheapest(rows, found)[1], end)


def test_hot_conversation_is_dealt_over_tasks(spark, settings):
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, -7, id) AS conv_id", "id AS turn", "'user' AS role", "concat('t', id) AS text", "1L AS copies"
    )
    found = dialogue.with_faults(rows).where("conv_id = -7").groupBy(F.spark_partition_id()).count().collect()
    assert len(found) >= 2 and sum(r["count"] for r in found) == 10_000
