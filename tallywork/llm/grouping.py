"""Documents packed into as few sequences as possible by a grouping genetic algorithm."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.llm.packing import rank_file
from tallywork.llm.shared import table, with_texts, written

CAPACITY = 1_024  # ids of a sequence
END_ID = 2  # closes every document
ADDED = {"<|endoftext|>": 50_256}  # fixed value: the vocabulary's added token
ISLANDS = 6
POPULATION = 8  # packings of an island
EPOCHS = 3  # after each but the last, elites move to the next island
GENERATIONS = 8  # children of an island's epoch, times the population
ELITES = 2
PLACED = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
DISSOLVED = 60  # bins at most that a mutation takes apart

Packing = dict[tuple[int, ...], int]  # lengths of a bin, longest first -> number of such bins


# Packings of counted lengths: whatever the corpus, there are at most CAPACITY lengths.


def used(packing: Packing) -> dict[int, int]:
    lengths: dict[int, int] = {}
    for bin_, count in packing.items():
        for length in bin_:
            lengths[length] = lengths.get(length, 0) + count
    return lengths


def best_fit(demand: dict[int, int], order: list[int], open_bins: Packing, capacity: int) -> Packing:
    """Lengths in the given order, each item into the fullest bin that takes it; equal items at once.

    The bin that takes an item stays the fullest for the next of that length until it is full,
    so each bin of a room takes ``room // length`` of them.
    """
    rooms: dict[int, Packing] = {}
    mask = 0  # rooms that some bin has

    def put(bin_: tuple[int, ...], room: int, count: int) -> None:
        nonlocal mask
        there = rooms.setdefault(room, {})
        there[bin_] = there.get(bin_, 0) + count
        mask |= 1 << room

    for bin_, count in open_bins.items():
        put(bin_, capacity - sum(bin_), count)
    for length in order:
        left = demand.get(length, 0)
        while left:
            fitting = mask >> length
            if not fitting:
                most = capacity // length
                if left >= most:
                    put((length,) * most, capacity - most * length, left // most)
                if left % most:
                    put((length,) * (left % most), capacity - left % most * length, 1)
                break
            room = length + (fitting & -fitting).bit_length() - 1
            bin_, count = next(iter(rooms[room].items()))
            most = room // length
            taken = min(count, left // most)
            items, bins = (most, taken) if taken else (left, 1)
            grown = tuple(sorted((*bin_, *(length,) * items), reverse=True))
            rooms[room][bin_] -= bins
            if not rooms[room][bin_]:
                del rooms[room][bin_]
                if not rooms[room]:
                    mask &= ~(1 << room)
            put(grown, room - items * length, bins)
            left -= items * bins
    packing: Packing = {}
    for there in rooms.values():
        for bin_, count in there.items():
            packing[bin_] = packing.get(bin_, 0) + count
    return packing


def least_bins(demand: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: long items need bins of their own, and what small items find
    no room beside them need more."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in demand.items():
        counts[length] = count
    number, total = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half, best = capacity // 2, 0
    for small in range(half + 1):
        below = max(small - 1, 0)
        alone = number[-1] - number[capacity - small]
        long = number[capacity - small] - number[half]
        beside = long * capacity - (total[capacity - small] - total[half])
        rest = total[half] - total[below] - beside
        best = max(best, int(alone + long + max(0, -(-rest // capacity))))
    return best


def fitness(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then bins as unequally filled as can be, which leaves room to gain one."""
    bins = sum(packing.values())
    return bins, -sum(count * (sum(bin_) / capacity) ** 2 for bin_, count in packing.items())


def _by_fill(packing: Packing, rng: np.random.Generator) -> list[tuple[tuple[int, ...], int]]:
    bins = list(packing.items())
    chance = rng.random(len(bins))
    return [bins[i] for i in sorted(range(len(bins)), key=lambda i: (-sum(bins[i][0]), chance[i]))]


def _loosely_falling(lengths, rng: np.random.Generator, loose: float) -> list[int]:
    order = sorted(lengths)
    key = np.array(order) * (1 + loose * rng.standard_normal(len(order)))
    return [order[i] for i in np.argsort(-key, kind="stable")]


def least_slack(free: dict[int, int], packing: Packing, capacity: int, rng: np.random.Generator) -> Packing:
    """The packing with bins more: each takes the longest free item and what fills it best.

    Which sums the free items can reach is kept as the bits of a number, length after length in
    an order that is chance; the way back through the steps names the items.
    """
    packing, free = dict(packing), {x: n for x, n in free.items() if n}
    while free:
        longest = max(free)
        room = capacity - longest
        steps, reach = [], 1
        mask = (1 << (room + 1)) - 1
        lengths = [x for x in free if x <= room]
        for i in rng.permutation(len(lengths)):
            left = free[lengths[i]] - (lengths[i] == longest)
            for _ in range(min(left, room // lengths[i])):
                more = reach | (reach << lengths[i]) & mask
                if more == reach:
                    break
                steps.append((lengths[i], reach))
                reach = more
            if reach >> room:
                break
        bin_, target = [longest], reach.bit_length() - 1
        for length, before in reversed(steps):
            if not before >> target & 1:
                bin_.append(length)
                target -= length
        full = tuple(sorted(bin_, reverse=True))
        times = min(free[x] // full.count(x) for x in full)  # as many bins like it as the items allow
        packing[full] = packing.get(full, 0) + times
        free = {x: left for x, n in free.items() if (left := n - times * full.count(x))}
    return packing


def crossed(one: Packing, other: Packing, demand: dict[int, int], capacity: int, rng: np.random.Generator) -> Packing:
    """A child: whole well-filled bins of ``other``; of ``one`` the bins that still have all their
    items; the items of the rest by best fit, longest first."""
    free = dict(demand)
    child: Packing = {}
    wanted = int(rng.uniform(0.2, 0.7) * sum(other.values()))
    for bin_, count in _by_fill(other, rng):
        count = min(count, wanted)
        if not count:
            break
        wanted -= count
        child[bin_] = count
        for length in bin_:
            free[length] -= count
    for bin_, count in _by_fill(one, rng):
        kept = min([count, *(free[length] // bin_.count(length) for length in set(bin_))])
        if kept:
            child[bin_] = child.get(bin_, 0) + kept
            for length in bin_:
                free[length] -= kept
    return best_fit(free, sorted((x for x in free if free[x]), reverse=True), child, capacity)


def mutated(packing: Packing, capacity: int, rng: np.random.Generator) -> Packing:
    """The emptiest bins and some others dissolved, and their items in bins of least slack."""
    kept, free = dict(packing), {}
    bins = _by_fill(packing, rng)
    emptiest = bins[::-1][: int(rng.integers(1, 8))]
    others = [bins[i] for i in rng.integers(len(bins), size=int(rng.integers(4, DISSOLVED)))]
    for bin_, _ in [*emptiest, *others]:
        if kept.get(bin_):
            kept[bin_] -= 1
            for length in bin_:
                free[length] = free.get(length, 0) + 1
    return least_slack(free, {b: n for b, n in kept.items() if n}, capacity, rng)


def evolved(population: list[Packing], demand: dict[int, int], capacity: int, seed: tuple[int, ...], children: int) -> list[Packing]:
    """The population after so many children, best first; an empty one is founded first.

    A child takes the place of the worst, if it is better and not there already. Ends early at
    the least possible number of bins. The same seed gives the same result, so a lost task is
    simply done again.
    """
    rng = np.random.default_rng(seed)
    least = least_bins(demand, capacity)
    falling = sorted(demand, reverse=True)
    rank = lambda p: (*fitness(p, capacity), sorted(p.items()))
    if not population:
        population = [best_fit(demand, falling, {}, capacity)]
        while len(population) < POPULATION and sum(population[0].values()) > least:
            if len(population) % 2:
                population.append(least_slack(demand, {}, capacity, rng))
            else:
                population.append(best_fit(demand, _loosely_falling(demand, rng, 0.1), {}, capacity))
    population = sorted(population, key=rank)[:POPULATION]
    for _ in range(children):
        if sum(population[0].values()) <= least:
            break
        # The better of two drawn at random, twice.
        one, other = (population[min(rng.integers(len(population), size=2))] for _ in range(2))
        child = crossed(one, other, demand, capacity, rng)
        if rng.random() < 0.5 or child in population:
            child = mutated(child, capacity, rng)
        if child not in population:
            population = sorted([*population, child], key=rank)[:POPULATION]
    return population


def _columns(island: int, population: list[Packing], capacity: int) -> pd.DataFrame:
    rows = []
    for place, packing in enumerate(population):
        bins, fill = fitness(packing, capacity)
        rows.append((island, place, bins, fill, list(packing.values()), [list(b) for b in packing]))
    return pd.DataFrame(rows, columns=["island", "place", "bins", "fill", "counts", "lengths"])


_POPULATION = "island int, place int, bins long, fill double, counts array<long>, lengths array<array<int>>"


def fewest_bins(spark: SparkSession, demand: dict[int, int], capacity: int = CAPACITY, islands: int = ISLANDS) -> Packing:
    """The best packing that islands find for counted lengths; they evolve apart, as Spark tasks.

    After each epoch the elites of an island also go to the next one, in a ring. Populations pass
    through the shared folder. All of this has a size that follows from the number of lengths,
    not from the corpus: a bin stands for all bins like it. Ends early at the least number of
    bins that any packing could have.
    """
    if not demand:
        return {}
    least = least_bins(demand, capacity)
    shared = spark.sparkContext.broadcast(demand)  # at most one entry for each length

    def epoch(number: int):
        def evolve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            island = int(key[0])
            there = [
                {tuple(map(int, b)): int(c) for b, c in zip(r.lengths, r.counts)}
                for r in rows.sort_values(["place", "bins", "fill"]).itertuples()
                if len(r.counts)
            ]
            unlike = [p for i, p in enumerate(there) if p not in there[:i]]
            seed = (island, number)
            return _columns(island, evolved(unlike, shared.value, capacity, seed, GENERATIONS * POPULATION), capacity)

        return evolve

    population = spark.range(islands).selectExpr(
        "CAST(id AS INT) AS island", "0 AS place", "0L AS bins", "0D AS fill",
        "CAST(array() AS array<long>) AS counts", "CAST(array() AS array<array<int>>) AS lengths",
    )
    best = None
    for number in range(EPOCHS):
        dealt = population.repartition(islands, "island").groupBy("island").applyInPandas(epoch(number), _POPULATION)
        population = written(dealt, "islands")
        best = population.orderBy("bins", "fill", "island", "place").first()
        if best["bins"] <= least:
            break
        elites = population.where(F.col("place") < ELITES)
        population = population.unionByName(elites.withColumn("island", (F.col("island") + 1) % islands))
    return {tuple(b): c for b, c in zip(best["lengths"], best["counts"], strict=True)}


# Documents as pieces.


@lru_cache(maxsize=2)
def _encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    known = {base64.b64decode(t): int(r) for t, r in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("added", pat_str=pattern, mergeable_ranks=known, special_tokens=ADDED)


def pieces(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: ``doc_id``, ``piece``, ``start``,
    ``length``, ``ids_crc32``, and with ``with_ids`` the ``ids`` themselves.

    A document is its text's ids and the end id, so null and empty texts have one id. Only longer
    documents than ``capacity`` are cut: into whole pieces, with the remainder first. ``part``
    and ``nth`` number the pieces of a length within their task.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="ascii"))  # under a megabyte
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoding.encode_to_numpy(value.as_py() or "", allowed_special="all"), END_ID).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, end - capacity) if piece else 0
                    own = ids[start:end]
                    row = (doc, piece, start, len(own), zlib.crc32(own.tobytes()), part, seen[len(own)])
                    rows.append((*row, own.astype(np.int32)) if with_ids else row)
                    seen[len(own)] += 1
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    wanted = with_texts(docs).selectExpr(f"CAST(`{key}` AS BIGINT) AS k", f"`{text}` AS t")
    return wanted.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def places(packing: Packing) -> dict[str, np.ndarray]:
    """Where the items of each length lie, by their number: runs of equal bins, sorted by length and number."""
    rows, first, taken = [], 0, {}
    for bin_, count in sorted(packing.items(), key=lambda b: (-sum(b[0]), b[0])):
        offset = 0
        for length in sorted(set(bin_), reverse=True):
            times = bin_.count(length)
            rows.append((length, taken.get(length, 0), first, times, offset))
            taken[length] = taken.get(length, 0) + count * times
            offset += length * times
        first += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "number", "first", "times", "offset"), table.T, strict=True))


_NUMBERS = 1 << 50  # above the number of items of one length


def _placed(numbered: DataFrame, packing: Packing) -> DataFrame:
    """``sequence_id`` and ``offset`` of every piece, looked up by its length and number."""
    shared = numbered.sparkSession.sparkContext.broadcast(places(packing))  # some thousand entries
    kept = [c for c in numbered.columns if c not in ("length", "number")]
    schema = ", ".join(f"{c} {numbered.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        keys = runs["length"] * _NUMBERS + runs["number"]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(keys, length * _NUMBERS + number, side="right") - 1
            within, times = number - runs["number"][at], runs["times"][at]
            sequence = runs["first"][at] + within // times
            offset = runs["offset"][at] + within % times * length
            arrays = [*(batch.column(c) for c in kept), batch.column("length"), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "length", "sequence_id", "offset"])

    return numbered.mapInArrow(run, f"{schema}, length long, sequence_id long, offset long")


def packed(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``; sequences have no gaps.

    Each row of ``docs`` is a document of its own, whatever its id; null ids stay null. Of equal
    lengths any order holds. An empty table gives no rows; other columns are not read, so none
    can clash. Only the pieces' numbers by length reach the driver, at most ``capacity`` of them.
    The packing found for these numbers is dealt out again by each piece's number among those of
    its length: its number within its task plus those of the tasks before. So no length, however
    frequent, meets in one task.
    """
    cut = written(pieces(docs, path, pattern, capacity, with_ids, text, key), "pieces")
    counts = written(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    demand = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    packing = fewest_bins(docs.sparkSession, demand, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select(
        F.col("length").alias("_length"), F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_earlier")
    )
    same = (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part"))
    numbered = cut.join(earlier, same).withColumn("number", F.col("nth") + F.col("_earlier"))
    placed = _placed(numbered.drop("_length", "_part", "_earlier", "part", "nth"), packing)
    return placed.select(*PLACED, *["ids"] * with_ids)


def sequences(placed: DataFrame) -> DataFrame:
    """One row a sequence: its ids, the documents and lengths of its pieces, in order of their offsets.

    Needs ``packed(..., with_ids=True)``. A sequence has at most its capacity of ids.
    """
    piece = F.struct("offset", "doc_id", "piece", "length", "ids")
    return (
        placed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(piece)).alias("p"))
        .select(
            "sequence_id",
            F.flatten("p.ids").alias("input_ids"),
            F.col("p.doc_id").alias("doc_ids"),
            F.col("p.length").alias("lengths"),
        )
    )


def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in as few sequences of 1,024 ids as the islands find."""
    import public_tokenizers

    return packed(table(spark, folder, "documents"), rank_file(), public_tokenizers.PATTERN)
