"""Conversations repaired to alternating turns at least cost, by divide and conquer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.shared import table, whole_groups, with_texts, written

# Role patterns accepted: an optional system row, then user and assistant in turns, or nothing.
START, SYSTEM, USER, ASSISTANT = range(4)
TRAILING = ("", "II", "I", "")  # inserts that lead from a state to an accepted end
REROLE, DELETE, INSERT, FLAWED = 2, 3, 2, 1  # costs
MUST_DELETE = 0  # kind of a row; the others are 1 + 2 * initial + (1 if truncated)
INITIALS = "uas"  # any other initial is number 3
SUFFIXES = sorted("I" * k + edit for k in range(3) for edit in "DKR")  # inserts ahead of a row, its edit
NEVER = 1 << 40
ORDERS = 1 << 12  # above any product of a state's place and a suffix's number
PIECE_BITS = 10  # a piece of a conversation has at most 1,024 rows
BLANK, TRUNCATED = r"^[\x20\x09-\x0D]*$", r"[.!?][\x20\x09-\x0D]*$"
PIECE_ROWS_AT_ONCE = 200_000


def _after(state: int, letter: str) -> int | None:
    """State after a role's initial, or None where it is not accepted."""
    return {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}[letter].get(state)


def _only(state: int) -> int:
    """State after an inserted or rerolled row: its role, user or assistant, follows from the state."""
    return ASSISTANT if state == USER else USER


@lru_cache(maxsize=1)
def row_costs() -> tuple[np.ndarray, np.ndarray]:
    """Of each kind of row, from state to state: the least cost, and the ASCII-least suffix of that cost."""
    cost = np.full((9, 4, 4), NEVER, np.int64)
    order = np.zeros((9, 4, 4), np.int64)
    for kind in range(9):
        initial, flawed = (kind - 1) // 2, (kind - 1) % 2 * FLAWED
        for number, suffix in enumerate(SUFFIXES):
            for first in range(4):
                state = first
                for _ in suffix[:-1]:
                    state = _only(state)
                price = INSERT * (len(suffix) - 1)
                if suffix[-1] == "D":
                    price += DELETE
                elif kind == MUST_DELETE:
                    continue
                elif suffix[-1] == "R":
                    state, price = _only(state), price + REROLE + flawed
                else:
                    state = _after(state, INITIALS[initial]) if initial < 3 else None
                    price += flawed
                if state is not None and price < cost[kind, first, state]:
                    cost[kind, first, state], order[kind, first, state] = price, number
    return cost, order


def _forward(cost: np.ndarray, place: np.ndarray, step: np.ndarray, order: np.ndarray) -> tuple:
    """One item further: least costs of the states, and the places of their least audits.

    Audits that end in different states differ, and none is the start of another, as all have an
    edit for each row. So an earlier difference decides, and the places carry all that is needed.
    """
    total = cost[:, :, None] + step
    key = total * ORDERS + place[:, :, None] * 16 + order
    best = key.min(axis=1)
    cost = np.minimum(best // ORDERS, NEVER)
    return cost, np.argsort(np.argsort(best % ORDERS, axis=1, kind="stable"), axis=1)


def _from_state(states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cost = np.full((len(states), 4), NEVER, np.int64)
    cost[np.arange(len(states)), states] = 0
    return cost, np.tile(np.arange(4), (len(states), 1))


def crossings(step: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The state after every item on the audit-least of the cheapest ways, by Hirschberg's method.

    ``step`` and ``order`` are the items' costs and audit orders from state to state; run r holds
    the items ``low[r]`` up to ``high[r]`` and leads from ``start[r]`` to ``end[r]``. Each round
    halves every run: costs of the first half forwards and of the second backwards meet in the
    middle, and of the states with the least sum the one with the ASCII-least audit is crossed.
    Only four-state vectors are kept. All runs of a round advance together.
    """
    after = np.zeros(len(step), np.int8)
    after[high - 1] = end
    while True:
        open_runs = high - low > 1
        low, high, start, end = low[open_runs], high[open_runs], start[open_runs], end[open_runs]
        if not len(low):
            return after
        middle = (low + high) // 2
        longest = np.argsort(low - high, kind="stable")
        low, high, middle, start, end = (x[longest] for x in (low, high, middle, start, end))
        ahead, place = _from_state(start)
        for n in range(int((middle - low).max())):
            live = int(np.searchsorted(low - middle, -n))  # longest first: those still on the way
            at = low[:live] + n
            ahead[:live], place[:live] = _forward(ahead[:live], place[:live], step[at], order[at])
        back, _ = _from_state(end)
        for n in range(int((high - middle).max())):
            live = int((high - middle > n).sum())
            at = high[:live] - 1 - n
            back[:live] = np.minimum((step[at] + back[:live, None, :]).min(axis=2), NEVER)
        crossed = np.argmin((ahead + back) * ORDERS + place, axis=1)
        after[middle - 1] = crossed
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        start, end = np.concatenate([start, crossed]), np.concatenate([crossed, end])


def whole(step: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run as one item: costs from state to state, and the places of their least audits."""
    longest = np.argsort(low - high, kind="stable")
    low, high = low[longest], high[longest]
    cost = np.empty((len(low), 4, 4), np.int64)
    place = np.empty((len(low), 4, 4), np.int64)
    for first in range(4):
        cost[:, first], place[:, first] = _from_state(np.full(len(low), first))
    for n in range(int((high - low).max(initial=0))):
        live = int(np.searchsorted(low - high, -n))
        at = low[:live] + n
        for first in range(4):
            cost[:live, first], place[:live, first] = _forward(cost[:live, first], place[:live, first], step[at], order[at])
    back = np.argsort(longest)
    return cost[back], place[back]


def ends(cost: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The last state of the cheapest accepted repair from the start, ASCII-least among equals."""
    trailing = np.array([INSERT * len(t) for t in TRAILING])
    return np.argmin((cost[:, START] + trailing) * ORDERS + place[:, START], axis=1)


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows after made damage, as ``conv_id``, ``turn``, ``role``, ``text`` and ``copies``.

    The checksum of conversation and turn, modulo 20, decides: 0 drops the row, 1 empties the
    text, 2 takes its full stops, 3 repeats the row, 4 makes it a user's. Nulls count as one
    space. Other columns are left out, so none can clash.
    """
    fate = F.pmod(F.crc32(F.concat(_or_space(conversation), F.lit(":"), _or_space(turn))), F.lit(20))
    words = _or_space(text)
    return (
        rows.select(
            F.col(conversation).alias("conv_id"),
            F.col(turn).alias("turn"),
            F.when(fate == 4, "user").otherwise(_or_space(role)).alias("role"),
            F.when(fate == 1, "").when(fate == 2, F.regexp_replace(words, "[.!?]", "")).otherwise(words).alias("text"),
            F.when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
            (fate == 0).alias("_dropped"),
        )
        .where("NOT _dropped")
        .drop("_dropped")
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality, with a hash as one more key so that AQE can split a hot one."""
    equal = F.xxhash64(*[left[n] for n in names]) == F.xxhash64(*[right[f"_{n}"] for n in names])
    for n in names:
        equal = equal & left[n].eqNullSafe(right[f"_{n}"])
    return equal


def with_faults(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one with their ``copies``, in order, with ``place``, ``fault`` and ``kind``.

    Needs ``conv_id``, ``turn``, ``role``, ``text`` without nulls in the last two, and ``copies``.
    ``fault`` is the row's first: blank, duplicate (role and text came earlier), truncated, or ''.
    Copies beyond the first are duplicates (or blank). ``place`` rises with conversation, turn
    (nulls first), role and text; ties beyond these are equal rows. A hot conversation is dealt
    over many tasks by ranges of turn and text, and repeated texts are found by an aggregate.
    """
    texts = with_texts(rows)
    single = texts.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    at = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    blank = F.col("text").rlike(BLANK)
    again = (
        single.where(~blank)
        .groupBy("conv_id", "role", "text")
        .agg(F.min(at).alias("_first"), F.count("*").alias("_turns"))
        .where("_turns > 1")
        .withColumnsRenamed({n: f"_{n}" for n in ("conv_id", "role", "text")})
    )
    found = single.join(again, _same(single, again, "conv_id", "role", "text"), "left")
    fault = (
        F.when(blank, "blank")
        .when(at > F.col("_first"), "duplicate")
        .when(~F.col("text").rlike(TRUNCATED), "truncated")
        .otherwise("")
    )
    initial = F.lit(3)
    for n, letter in enumerate(INITIALS):
        initial = F.when(F.substring("role", 1, 1) == letter, n).otherwise(initial)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), MUST_DELETE).otherwise(
        1 + 2 * F.col("initial") + (F.col("fault") == "truncated").cast("int")
    )
    ordered = (
        found.select(*single.columns, fault.alias("fault"), initial.alias("initial"))
        .withColumn("kind", kind.cast("byte"))
        .withColumn("initial", F.col("initial").cast("byte"))
        .repartitionByRange("conv_id", "turn", "role", "text")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.withColumn("place", F.monotonically_increasing_id())


def _runs(batch: pa.Table, *names: str) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last row of each run of equal values."""
    new = np.ones(batch.num_rows, bool)
    if batch.num_rows:
        new[1:] = False
        for name in names:
            column = batch.column(name).combine_chunks()
            given = column.is_valid().to_numpy(zero_copy_only=False)
            values = column.fill_null(0).to_numpy(zero_copy_only=False)
            new[1:] |= (values[1:] != values[:-1]) | (given[1:] != given[:-1])
    low = np.flatnonzero(new)
    return low, np.append(low[1:], batch.num_rows)[: len(low)]


def _pieces(rows: DataFrame) -> DataFrame:
    """One row a piece: costs and audit places from state to state, initials at its ends, bad pairs."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, piece long, cost array<long>, audit array<long>, opens byte, closes byte, illegal long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, order = row_costs()
        for group in whole_groups(batches, ("conv_id", "piece"), PIECE_ROWS_AT_ONCE):
            low, high = _runs(group, "conv_id", "piece")
            kinds = group.column("kind").to_numpy()
            cost, place = whole(step[kinds], order[kinds], low, high)
            initial = group.column("initial").to_numpy()
            extra = group.column("copies").to_numpy() - 1  # equal neighbours: never a fair pair
            pair = np.zeros(len(initial), np.int64)
            pair[1:] = ~_fair(initial[:-1], initial[1:])
            pair[low] = 0
            bad = np.add.reduceat(pair + extra, low)
            yield pa.RecordBatch.from_arrays(
                [
                    group.column("conv_id").combine_chunks().take(pa.array(low)),
                    group.column("piece").combine_chunks().take(pa.array(low)),
                    _lists(cost.reshape(-1, 16)), _lists(place.reshape(-1, 16)),
                    pa.array(initial[low]), pa.array(initial[high - 1]), pa.array(bad),
                ],
                names=["conv_id", "piece", "cost", "audit", "opens", "closes", "illegal"],
            )

    skinny = rows.select("conv_id", "piece", "place", "kind", "initial", "copies")
    dealt = skinny.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "place")
    return dealt.mapInArrow(run, schema)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def _fair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether initials may stand side by side: su, ua or au."""
    return ((left == 2) & (right == 0)) | ((left == 0) & (right == 1)) | ((left == 1) & (right == 0))


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """States at the ends of each piece, and on the conversation's last piece its bad pairs.

    A conversation meets here as one row of some hundred bytes for each thousand of its rows.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, piece long, first byte, last byte, closing boolean, illegal long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, ("conv_id",), PIECE_ROWS_AT_ONCE // 16):
            low, high = _runs(group, "conv_id")
            step, order = (
                group.column(n).combine_chunks().flatten().to_numpy().reshape(-1, 4, 4) for n in ("cost", "audit")
            )
            cost, place = whole(step, order, low, high)
            after = crossings(step, order, low, high, np.zeros(len(low), int), ends(cost, place))
            before = np.concatenate([[START], after[:-1]])
            before[low] = START
            opens, closes = (group.column(n).to_numpy() for n in ("opens", "closes"))
            seam = np.zeros(len(after), np.int64)
            seam[1:] = ~_fair(closes[:-1], opens[1:])
            seam[low] = 0
            closing = np.zeros(len(after), bool)
            closing[high - 1] = True
            bad = np.zeros(len(after), np.int64)
            bad[high - 1] = np.add.reduceat(seam + group.column("illegal").to_numpy(), low)
            yield pa.RecordBatch.from_arrays(
                [
                    group.column("conv_id").combine_chunks(), group.column("piece").combine_chunks(),
                    pa.array(before.astype(np.int8)), pa.array(after), pa.array(closing), pa.array(bad),
                ],
                names=["conv_id", "piece", "first", "last", "closing", "illegal"],
            )

    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return dealt.mapInArrow(run, schema)


def repaired(faults: DataFrame) -> DataFrame:
    """The rows of ``with_faults`` with their edits at least cost, ASCII-least among equal audits.

    Adds ``edits`` (inserts ahead of the row, its own edit, and D for every further copy),
    ``trailing`` (inserts behind the conversation's last row, else ''), ``lines`` (what the row
    leaves, inserted rows included, as ``role:text``), ``cost`` and, on the last row,
    ``illegal``. A conversation of any length is cut into pieces of at most 1,024 rows that are
    summed up and repaired apart; a null conversation is one of its own. No rows give no rows.
    """
    rows = faults.withColumn("piece", F.shiftright("place", PIECE_BITS))
    met = _joined_pieces(_pieces(rows)).withColumnsRenamed({"conv_id": "_conv_id", "piece": "_piece"})
    joined = rows.join(met, _same(rows, met, "conv_id", "piece"))
    kept = ["conv_id", "place", "turn", "role", "text", "copies", "fault"]
    carried = {n: faults.schema[n].dataType.simpleString() for n in kept}
    made = {"edits": "string", "trailing": "string", "lines": "array<string>", "cost": "long", "illegal": "long"}
    schema = ", ".join(f"{n} {t}" for n, t in (carried | made).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, order = row_costs()
        for group in whole_groups(batches, ("conv_id", "piece")):
            low, high = _runs(group, "conv_id", "piece")
            kinds, copies = group.column("kind").to_numpy(), group.column("copies").to_numpy()
            first, last = (group.column(n).to_numpy() for n in ("first", "last"))
            after = crossings(step[kinds], order[kinds], low, high, first[low], last[low])
            before = np.concatenate([[START], after[:-1]]).astype(np.int8)
            before[low] = first[low]
            number, cost = order[kinds, before, after], step[kinds, before, after] + DELETE * (copies - 1)
            closing = np.zeros(len(after), bool)
            closing[high - 1] = group.column("closing").to_numpy(zero_copy_only=False)[high - 1]
            trailing = ["" if not c else TRAILING[s] for c, s in zip(closing, after, strict=True)]
            edits = [SUFFIXES[n] + "D" * (int(c) - 1) for n, c in zip(number, copies, strict=True)]
            roles, texts = group.column("role").to_pylist(), group.column("text").to_pylist()
            lines = [_lines(*x) for x in zip(before, number, roles, texts, after, trailing, strict=True)]
            cost = cost + np.array([INSERT * len(t) for t in trailing], np.int64)
            arrays = [group.column(n).combine_chunks() for n in kept]
            arrays += [pa.array(edits, pa.string()), pa.array(trailing, pa.string()), pa.array(lines, pa.list_(pa.string()))]
            arrays += [pa.array(cost), pa.array(np.where(closing, group.column("illegal").to_numpy(), 0))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*carried, *made])

    needed = joined.select(*kept, "piece", "kind", "first", "last", "closing", "illegal")
    dealt = needed.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "place")
    return dealt.mapInArrow(run, schema)


def _lines(before: int, number: int, role: str, text: str, after: int, trailing: str) -> list[str]:
    """What a row leaves: inserted rows ahead of it, itself unless deleted, inserted rows behind it."""
    names = {USER: "user", ASSISTANT: "assistant"}
    lines, state = [], int(before)
    for edit in SUFFIXES[number]:
        if edit == "I":
            state = _only(state)
            lines.append(f"{names[state]}:")
        elif edit == "R":
            lines.append(f"{names[_only(state)]}:{text}")
        elif edit == "K":
            lines.append(f"{role}:{text}")
    state = int(after)
    for _ in trailing:
        state = _only(state)
        lines.append(f"{names[state]}:")
    return lines


def digests(edited: DataFrame) -> DataFrame:
    """Per conversation the summed ``cost`` and ``illegal``, the ``audit`` and ``repaired_sha256``.

    A digest is made in the order of its input, so the rows of a conversation pass through one
    task; they stream, sorted on disk where need be, and only the audit is gathered.
    """
    kind = edited.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, illegal long, cost long, audit string, repaired_sha256 string"
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [None, pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, key_type = None, [], None

        def closed() -> tuple:
            key, bad, cost, audit, digest, _ = now
            return key, bad, cost, "".join(audit), digest.hexdigest()

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t or key_type) for c, t in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            for key, edits, trailing, lines, cost, bad in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now[0] != key:
                    if now is not None:
                        done.append(closed())
                    now = [key, 0, 0, [], hashlib.sha256(), False]
                now[1] += bad
                now[2] += cost
                now[3].append(edits + trailing)
                for line in lines:
                    now[4].update((("\n" if now[5] else "") + line).encode())
                    now[5] = True
            if len(done) >= 10_000:
                yield out()
                done = []
        if now is not None:
            done.append(closed())
        if done:
            yield out()

    skinny = edited.select("conv_id", "place", "edits", "trailing", "lines", "cost", "illegal")
    dealt = skinny.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.drop("place").mapInArrow(run, schema)


def repair_report(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """One row for each conversation of ``originals``: faults, cost, audit and digest of its repair.

    ``rows`` as ``with_faults`` needs them. A conversation without rows has zeros, an empty audit
    and the digest of the empty string. Empty tables give no rows.
    """
    faults = written(with_faults(rows), "conversations")
    count = lambda name: F.sum(F.when(F.col("fault") == name, 1).otherwise(0)).alias(name)
    repeats = F.sum(F.when(F.col("fault") == "blank", 0).otherwise(F.col("copies") - 1))
    blanks = F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0))
    facts = (
        faults.groupBy("conv_id", "turn")
        .agg(blanks.alias("blank"), count("duplicate"), repeats.alias("repeats"), count("truncated"))
        .groupBy("conv_id")
        .agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
            F.sum("blank").alias("blank"),
            F.sum(F.col("duplicate") + F.col("repeats")).alias("duplicate"),
            F.sum("truncated").alias("truncated"),
        )
    )
    edited = digests(repaired(faults))
    known = originals.distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        known.join(facts.withColumnRenamed("conv_id", "_f"), F.col("conv_id").eqNullSafe(F.col("_f")), "left")
        .join(edited.withColumnRenamed("conv_id", "_e"), F.col("conv_id").eqNullSafe(F.col("_e")), "left")
        .select(
            "conv_id",
            *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
        )
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    conversations = table(spark, folder, "conversations")
    return repair_report(damaged(conversations), conversations.select("conv_id"))


# The checksum bit by bit; then every edit of every row from each state, row by row, of which the
# cheapest (ASCII-least audit) way into each state goes on.
OP11_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
),
fated AS (
  SELECT *, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), CAST([1, 2, 3, 4, 5, 6, 7, 8] AS BIGINT[])),
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)
    ), CAST(4294967295 AS BIGINT)) % 20 AS fate
  FROM named
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END)
  WHERE fate <> 0
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         count(*) OVER (PARTITION BY conv_id) AS rows_there
  FROM damaged
),
faulty AS (
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) || substr(role, 1, 1) AS pair
  FROM ordered
),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
),
ahead(state, inserts, reached, added) AS (
  VALUES ('', '', '', CAST([] AS VARCHAR[])), ('', 'I', 'u', ['user:']), ('', 'II', 'a', ['user:', 'assistant:']),
         ('s', '', 's', []), ('s', 'I', 'u', ['user:']), ('s', 'II', 'a', ['user:', 'assistant:']),
         ('u', '', 'u', []), ('u', 'I', 'a', ['assistant:']), ('u', 'II', 'u', ['assistant:', 'user:']),
         ('a', '', 'a', []), ('a', 'I', 'u', ['user:']), ('a', 'II', 'a', ['user:', 'assistant:'])
),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '' AS state,
         {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS way
  FROM (SELECT DISTINCT conv_id FROM faulty)
  UNION ALL
  SELECT conv_id, n, state, min(way) FROM (
    SELECT w.conv_id, f.n,
           CASE e.edit WHEN 'D' THEN a.reached WHEN 'K' THEN f.initial
                       ELSE CASE WHEN a.reached = 'u' THEN 'a' ELSE 'u' END END AS state,
           {'cost': w.way.cost + 2 * length(a.inserts) + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                    + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END,
            'audit': w.way.audit || a.inserts || e.edit,
            'lines': w.way.lines || a.added || CASE e.edit WHEN 'D' THEN CAST([] AS VARCHAR[])
              WHEN 'K' THEN [f.role || ':' || f.text]
              ELSE [CASE WHEN a.reached = 'u' THEN 'assistant:' ELSE 'user:' END || f.text] END} AS way
    FROM ways w
    JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
    JOIN ahead a ON a.state = w.state
    JOIN (VALUES ('D'), ('K'), ('R')) e(edit)
      ON e.edit = 'D' OR (f.fault NOT IN ('blank', 'duplicate')
         AND (e.edit = 'R' OR a.reached || f.initial IN ('s', 'u', 'su', 'ua', 'au') AND f.initial <> ''))
  ) GROUP BY conv_id, n, state
),
done AS (
  SELECT w.conv_id, min({'cost': w.way.cost + 2 * length(a.inserts), 'audit': w.way.audit || a.inserts,
                         'lines': w.way.lines || a.added}) AS way
  FROM ways w JOIN ahead a ON a.state = w.state
  JOIN (SELECT DISTINCT conv_id, rows_there FROM ordered) o
    ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.rows_there = w.n
  WHERE a.reached IN ('', 'a') GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(d.way.cost, 0) AS cost,
       coalesce(d.way.audit, '') AS audit,
       sha256(coalesce(array_to_string(d.way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""
