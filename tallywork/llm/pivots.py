"""Near-duplicate vectors by a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.shared import components, table, whole_groups, written
from tallywork.llm.vectors import matrix, usable

PIVOTS = 256  # reference vectors
SAMPLE = 1_024  # vectors, drawn by hash, from which pivots are chosen (fixed bound)
APART = 0.8  # greatest cosine of two pivots
NEAREST = 8  # pivots that describe a vector
SHARED = 3  # of which two vectors must share so many to be compared
RANKS = 10  # greatest sum of the ranks (nearest 0) of the pivots that name a list
LIST_ROWS = 2_048  # rows of an inverted list that one task compares at a time
SHORT = 64  # lists up to this length are compared many at once
PAIRS = 50_000  # pairs of short lists whose vectors are multiplied at a time

# The ranks of pivots that name the lists of a vector. Pivots that are both far down the order
# change places soonest, so they name no list together.
RANKED = np.array([c for c in combinations(range(NEAREST), SHARED) if sum(c) <= RANKS])


def _pivots(sample: list[list[float]], size: int) -> np.ndarray:
    """Unit vectors of one length, none close to another: of the sample, then random ones.

    Several pivots in one dense group of vectors would be the nearest of all its members in an
    order that is chance.
    """
    own = np.array([v for v in sample if len(v) == size], float).reshape(-1, size)
    more = np.random.default_rng(size).normal(size=(PIVOTS, size))
    every = np.concatenate([own, more])
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    chosen = np.empty((0, size))
    for v in every:
        if len(chosen) < PIVOTS and (size == 1 or not (chosen @ v > APART).any()):
            chosen = np.vstack([chosen, v])
    return chosen if len(chosen) >= NEAREST else np.vstack([chosen, every[:NEAREST]])


def described(classes: DataFrame, sample: list[list[float]]) -> DataFrame:
    """``unit`` (packed doubles), ``size``, ``near`` (the nearest pivots, nearest first) and ``lists``."""
    shared = classes.sparkSession.sparkContext.broadcast(sample)  # at most SAMPLE vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            units, sizes, near = [], [], []
            for v in batch.column("embedding"):
                x = np.array(v.as_py(), float)
                x /= np.abs(x).max()  # squares of very small or large components stay finite
                x /= np.linalg.norm(x)
                if len(x) not in known:
                    known[len(x)] = _pivots(shared.value, len(x))
                angle = known[len(x)] @ x
                near.append(np.argsort(-angle, kind="stable")[:NEAREST].astype(np.int32))
                units.append(x.tobytes()), sizes.append(len(x))
            columns = [batch.column(n) for n in ("label", "node", "members")]
            lists = list(list_numbers(np.array(near))) if near else []
            columns += [
                pa.array(sizes, pa.int32()), pa.array(units, pa.binary()),
                pa.array(near, pa.list_(pa.int32())), pa.array(lists, pa.list_(pa.int64())),
            ]
            names = ["label", "node", "members", "size", "unit", "near", "lists"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "label long, node long, members long, size int, unit binary, near array<int>, lists array<long>"
    return classes.mapInArrow(run, schema)


def list_numbers(near: np.ndarray) -> np.ndarray:
    """Numbers of the inverted lists of permutations: one for each set of pivots by ``RANKED``."""
    sets = np.sort(near[:, RANKED], axis=2).astype(np.int64)
    return sets[:, :, 0] << 40 | sets[:, :, 1] << 20 | sets[:, :, 2]


def _links(rows: DataFrame, least: float) -> DataFrame:
    """Compare the members of each part of an inverted list.

    Rows come with ``label``, ``size``, ``list``, ``i``, ``j``, ``part`` and what ``described``
    gives. Returns link counts (``a``, ``links``) and links that connect what is linked (``a``, ``b``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, tuple(keys), 10_000):
            columns = [rows[k].to_numpy() for k in keys]
            new = np.ones(len(rows), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            low = np.flatnonzero(new)
            high = np.append(low[1:], len(rows))
            short = (high - low <= SHORT) & (columns[3][low] == columns[4][low])
            for size in np.unique(columns[1][low[short]]):
                chosen = short & (columns[1][low] == size)
                yield from _compared_short(rows, low[chosen], high[chosen], least)
            for first, behind in zip(low[~short], high[~short], strict=True):
                found = _compared(rows.slice(first, behind - first), least)
                if found is not None:
                    yield found

    keys = ["label", "size", "list", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long, links long")


def _batch(node: np.ndarray, links: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Link counts of rows, and links between the rows ``a`` and ``b``."""
    counted = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([node[counted], node[a]]), pa.int64()),
            pa.array([*[None] * len(counted), *node[b].tolist()], pa.int64()),
            pa.array([*links[counted].tolist(), *[None] * len(a)], pa.int64()),
        ],
        names=["a", "b", "links"],
    )


def _near(rows: pa.Table) -> np.ndarray:
    return rows["near"].combine_chunks().flatten().to_numpy().reshape(len(rows), NEAREST)


def _compared_short(rows: pa.Table, low: np.ndarray, high: np.ndarray, least: float) -> Iterator[pa.RecordBatch]:
    """Compare all pairs within each of many short lists of vectors of one length.

    Every pair counts in one list only: that of the least number that both are in.
    """
    pairs = []
    for length in np.unique(high - low):
        first, second = np.triu_indices(length, 1)
        at = low[high - low == length][:, None]
        pairs.append(np.stack([(at + first).ravel(), (at + second).ravel()]))
    taken = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)])
    place = np.zeros(len(rows), np.int64)
    place[taken] = np.arange(len(taken))
    left, right = place[np.concatenate(pairs, axis=1)]
    rows = rows.take(pa.array(taken))
    x = matrix(rows["unit"])
    linked = np.zeros(len(left), bool)
    for start in range(0, len(left), PAIRS):
        part = slice(start, start + PAIRS)
        linked[part] = np.einsum("ij,ij->i", x[left[part]], x[right[part]]) >= least
    left, right = left[linked], right[linked]
    numbers, own = list_numbers(_near(rows)), rows["list"].to_numpy()
    here = np.zeros(len(left), bool)
    for start in range(0, len(left), PAIRS):
        part = slice(start, start + PAIRS)
        one, other = numbers[left[part]], numbers[right[part]]
        both = (one[:, :, None] == other[:, None, :]).any(axis=2)
        here[part] = np.where(both, one, np.iinfo(np.int64).max).min(axis=1) == own[left[part]]
    left, right = left[here], right[here]
    if len(left):
        members = rows["members"].to_numpy()
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, left, members[right])
        np.add.at(links, right, members[left])
        yield _batch(rows["node"].to_numpy(), links, left, right)


def _compared(rows: pa.Table, least: float) -> pa.RecordBatch | None:
    """Compare two parts of a long list, or one with itself."""
    if len(rows) < 2:
        return None
    number, i, j = (rows[c][0].as_py() for c in ("list", "i", "j"))
    node, members, part = (rows[c].to_numpy() for c in ("node", "members", "part"))
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    x = matrix(rows["unit"])
    mask = x[left] @ x[right].T >= least
    mask &= (node[left][:, None] < node[right][None, :]) if i == j else True
    if not mask.any():
        return None
    mask &= ~_met_earlier(list_numbers(_near(rows)), number, left, right, mask)
    if not mask.any():
        return None
    links = np.zeros(len(rows), np.int64)
    links[left] += mask @ members[right]
    links[right] += members[left] @ mask
    a, b = _connecting(mask)
    return _batch(node, links, left[a], right[b])


def _met_earlier(numbers: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Pairs that are also together in a list of a lower number, where they count.

    Only lists of linked rows matter, each as a column of ones and zeros; their product counts
    the lists that two rows share.
    """
    linked = np.zeros(len(numbers), bool)
    linked[left[mask.any(axis=1)]] = True
    linked[right[mask.any(axis=0)]] = True
    early = (numbers < own) & linked[:, None]
    names, times = np.unique(numbers[early], return_counts=True)
    names = names[times > 1]
    met = np.zeros(mask.shape, bool)
    for start in range(0, len(names), SHORT * 16):
        chosen = names[start : start + SHORT * 16]
        at = np.minimum(np.searchsorted(chosen, numbers), len(chosen) - 1)
        row, column = np.nonzero(early & (chosen[at] == numbers))
        held = np.zeros((len(numbers), len(chosen)), np.float32)
        held[row, at[row, column]] = 1
        met |= held[left] @ held[right].T > 0
    return met


def _connecting(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all that a matrix of links connects, far fewer than its entries.

    Labels spread along links until all linked rows and columns agree; the links along which a
    label changed are kept.
    """
    n, m = mask.shape
    rows, columns = np.arange(n), n + np.arange(m)
    found_a, found_b = [], []
    while True:
        best = np.where(mask, columns, n + m).argmin(1)
        better = np.flatnonzero(mask[np.arange(n), best] & (columns[best] < rows))
        rows[better] = columns[best[better]]
        found_a.append(better), found_b.append(best[better])
        other = np.where(mask, rows[:, None], n + m).argmin(0)
        lower = np.flatnonzero(mask[other, np.arange(m)] & (rows[other] < columns))
        columns[lower] = rows[other[lower]]
        found_a.append(other[lower]), found_b.append(lower)
        if not len(better) and not len(lower):
            return np.concatenate(found_a), np.concatenate(found_b)


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """Links of cosine ``least`` or more between vectors of equal label, and their components.

    Returns per row ``vec_id``, ``n_links`` (other rows linked directly), ``component_id``
    (smallest id reachable) and ``kept`` (id = component id).

    Equal vectors of a label are one class. A class is described by its ``NEAREST`` nearest
    pivots in their order; every set of ``SHARED`` of them whose ranks sum to at most ``RANKS`` is
    the number of an inverted list. Two vectors meet in the lists of all sets that they share,
    so only if their shared-pivot count reaches ``SHARED``, are compared by cosines of the
    original vectors in double precision, and counted in one list. Long lists are compared in
    parts, short ones many at once. Lists of one vector are left out ahead of the shuffle of
    vectors.

    A pair is missed only if the permutations have no such set in common; README has the
    measured recall. Vectors that are null, zero or not finite, and
    rows with a null id or label, link with nothing and are kept. Vectors of unlike length
    never link. Rows that share an id are one vector: a component with any of them has all.
    """
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    known = usable(rows).where("label IS NOT NULL")
    classes = written(
        known.groupBy("label", "embedding").agg(F.min("vec_id").cast("long").alias("node"), F.count("*").alias("members")),
        "classes",
    )
    drawn = classes.select("embedding").orderBy(F.xxhash64("embedding"), "node").limit(SAMPLE)
    index = written(described(classes, [r[0] for r in drawn.collect()]), "index")

    postings = index.select("label", "size", "node", F.explode("lists").alias("list"))
    lists = (
        postings.groupBy("label", "size", "list")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .withColumn("parts", F.expr(f"1 + n div {LIST_ROWS}"))
        .drop("n")
    )
    placed = postings.join(lists, ["label", "size", "list"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts"))
    )
    dealt = placed.select("label", "size", "list", "node", "part", F.explode(F.expr("sequence(0L, parts - 1)")).alias("other"))
    dealt = dealt.select(
        "label", "size", "list", "node", "part",
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
    )
    found = written(
        _links(dealt.join(index.select("label", "size", "node", "members", "unit", "near"), ["label", "size", "node"]), least),
        "links",
    )
    joined = components(found.where("b IS NOT NULL"))
    counts = found.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    per_class = (
        classes.join(counts, "node", "left")
        .join(joined, "node", "left")
        .select(
            "label", "embedding",
            (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("_links"),
            F.coalesce("component", "node").alias("_component"),
        )
    )
    answered = rows.join(per_class, ["label", "embedding"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("_component", F.col("vec_id").cast("long")))
    return answered.select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.coalesce("_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op9_vector_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all embeddings."""
    return near_vectors(table(spark, folder, "embeddings"))
