"""Approximate nearest neighbours: a graph by NN-descent, searched greedily."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywork.llm.shared import table, written
from tallywork.llm.vectors import groups, usable

DEGREE = 32  # neighbours of a node in the graph
REVERSE = 32  # nodes that have it as a neighbour, at most, which take part with them
START_ROUNDS = 2  # divisions into blocks that give the first neighbours
BLOCK = 2_048  # vectors that one task compares with one another, or holds for requests
ROUNDS = 3  # of NN-descent, unless few neighbours change before
FEW = 0.02  # share of changed neighbours that ends it
BEAM = 256  # nodes that a query keeps
MARGIN = 1.5  # lengths beyond so many times the usual count as that long in the graph
LONGEST = 64  # vectors beyond that length, of each size, at which every search starts as well
GRAPH = "node long, other long, score float, fresh boolean"


def _units(rows: pa.Table, column: str, kind) -> np.ndarray:
    values = rows[column].to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _best(node: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray, keep: int) -> pa.RecordBatch:
    """The best different neighbours of each node; a pair known before is not fresh."""
    order = np.lexsort((fresh, other, node))
    node, other, score, fresh = node[order], other[order], score[order], fresh[order]
    single = np.append(True, (node[1:] != node[:-1]) | (other[1:] != other[:-1])) if len(node) else np.zeros(0, bool)
    node, other, score, fresh = node[single], other[single], score[single], fresh[single]
    order = np.lexsort((other, -score, node))
    node, other, score, fresh = node[order], other[order], score[order], fresh[order]
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, int)
    place = np.arange(len(node)) - np.repeat(starts, np.diff(np.append(starts, len(node))))
    top = place < keep
    columns = [node[top], other[top], score[top].astype(np.float32), fresh[top]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "other", "score", "fresh"])


def _prepared(classes: DataFrame) -> DataFrame:
    """``node``, ``size``, ``vector`` (packed doubles), ``length`` and ``unit``: half-precision
    coordinates on a sphere, where the nearest by angle are the nearest by inner product.

    One more coordinate fills every vector up to a common length; units serve to build the graph
    only. That length is the greatest one, but no more than ``MARGIN`` times what nine in ten
    stay below, so that a few very long vectors cannot flatten the rest; those count as that long
    in the graph, and ``length``, in parts of it, tells them. Lengths are worked out in parts of a
    vector's largest component, so that no square overflows.
    """
    absolute = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    largest = classes.select("*", F.array_max(absolute).alias("largest"))
    parts = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") / F.col("largest"), F.lit(2.0)))
    norm = F.col("largest") * F.sqrt(parts)
    most, usual = largest.agg(F.max(norm), F.percentile_approx(norm, 0.9)).first()
    most = min(most, MARGIN * usual)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, units, sizes, lengths = [], [], [], []
            for v in batch.column(1):
                x = np.array(v.as_py(), float)
                top = np.abs(x).max()
                within = np.linalg.norm(x / top)
                length = float(top / most * within)
                scaled = x / top * min(top / most, 1 / within)
                fill = np.sqrt(max(0.0, 1 - scaled @ scaled))
                vectors.append(x.tobytes()), sizes.append(len(x)), lengths.append(length)
                units.append(np.append(scaled, fill).astype(np.float16).tobytes())
            arrays = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(lengths, pa.float64())]
            arrays += [pa.array(vectors, pa.binary()), pa.array(units, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "size", "length", "vector", "unit"])

    return classes.select("node", "embedding").mapInArrow(
        run, "node long, size int, length double, vector binary, unit binary"
    )


def _coded(nodes: DataFrame, seed: int, planes: int) -> DataFrame:
    """``code``: on which side of random planes a unit lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for unit in batch.column("unit"):
                x = np.frombuffer(unit.as_py(), np.float16).astype(np.float32)
                normal = np.random.default_rng((seed, len(x))).normal(size=(planes, len(x))) if planes else np.zeros((0, len(x)))
                codes.append(int((normal @ x > 0) @ (1 << np.arange(planes)))) if planes else codes.append(0)
            columns = [batch.column(n) for n in ("node", "size", "unit")] + [pa.array(codes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "unit", "code"])

    return nodes.select("node", "size", "unit").mapInArrow(run, "node long, size int, unit binary, code long")


def _first_neighbours(nodes: DataFrame, count: int) -> DataFrame:
    """Neighbours within blocks of the same side of random planes; large blocks are cut."""
    planes = max(0, (count // BLOCK).bit_length() - 1)
    found = None
    for seed in range(START_ROUNDS):
        coded = _coded(nodes, seed, planes)
        parts = coded.groupBy("size", "code").agg(F.expr(f"1 + count(*) div {BLOCK}").alias("parts"))
        blocks = coded.join(parts, ["size", "code"]).withColumn(
            "part", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("parts"))
        )
        keys = ["size", "code", "part"]

        def run(batches: Iterator[pa.RecordBatch], keys=keys) -> Iterator[pa.RecordBatch]:
            for rows in groups(batches, keys):
                x = _units(rows, "unit", np.float16).astype(np.float32)
                node = rows["node"].to_numpy()
                for low in range(0, len(node), 512):
                    near = x[low : low + 512] @ x.T
                    near[np.arange(len(near)), low + np.arange(len(near))] = -np.inf
                    keep = min(DEGREE, len(node) - 1)
                    best = np.argpartition(-near, keep - 1, axis=1)[:, :keep] if keep else np.zeros((len(near), 0), int)
                    mine = np.repeat(node[low : low + 512], keep)
                    score = np.take_along_axis(near, best, 1).ravel()
                    yield _best(mine, node[best].ravel(), score, np.ones(len(mine), bool), DEGREE)

        near = blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, GRAPH)
        found = near if found is None else found.unionByName(near)
    return _merged(found)


def _merged(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_thousands(batches):
            node, other, score, fresh = (batch[c].to_numpy(zero_copy_only=False) for c in ("node", "other", "score", "fresh"))
            yield _best(node, other, score, fresh, DEGREE)

    return pairs.repartition("node").sortWithinPartitions("node").mapInArrow(run, GRAPH)


def _by_thousands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole runs of equal nodes, as many as a batch has, from batches sorted by node."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        rest = now if rest is None else pa.concat_tables([rest, now])
        node = rest["node"].to_numpy()
        if len(node) and node[0] != node[-1]:
            cut = int(np.searchsorted(node, node[-1]))
            yield rest.slice(0, cut).combine_chunks()
            rest = rest.slice(cut)
    if rest is not None and len(rest):
        yield rest.combine_chunks()


def _both_ways(graph: DataFrame) -> DataFrame:
    """Neighbours and, by random choice of at most ``REVERSE``, the nodes that have a node as one."""
    turned = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "score", "fresh")
    chosen = Window.partitionBy("node").orderBy(F.xxhash64("other", "node"), "other")
    back = turned.withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= REVERSE).drop("place")
    return graph.unionByName(back)


def _round(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """One round of NN-descent: all neighbours of a node, with a fresh one among the two, meet."""
    worst = graph.groupBy("node").agg(
        F.when(F.count("*") >= DEGREE, F.min("score")).otherwise(F.lit(float("-inf"))).cast("float").alias("worst")
    )
    known = nodes.select("node", "unit").join(worst, "node", "left").na.fill(float("-inf"), ["worst"])
    around = _both_ways(graph).groupBy("node", "other").agg(F.bool_and("fresh").alias("fresh"))
    told = around.join(known.withColumnRenamed("node", "other"), "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_thousands(batches):
            node, other, fresh, worst = (rows[c].to_numpy(zero_copy_only=False) for c in ("node", "other", "fresh", "worst"))
            bounds = np.append(np.flatnonzero(np.append(True, node[1:] != node[:-1])), len(node))
            width = len(rows["unit"][0].as_py())
            units = np.frombuffer(b"".join(rows["unit"].to_pylist()), np.float16).reshape(-1, width // 2) if _even(rows) else None
            a, b, s = [], [], []
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                x = units[low:high] if units is not None else _units(rows.slice(low, high - low), "unit", np.float16)
                near = (x := x.astype(np.float32)) @ x.T
                new = fresh[low:high]
                better = (near > worst[low:high, None]) & (new[:, None] | new[None, :])
                better[np.arange(high - low), np.arange(high - low)] = False
                i, j = np.nonzero(better)
                a.append(other[low + i]), b.append(other[low + j]), s.append(near[i, j])
            mine = np.concatenate(a)
            yield _best(mine, np.concatenate(b), np.concatenate(s), np.ones(len(mine), bool), DEGREE)

    offers = told.repartition("node").sortWithinPartitions("node").select("node", "other", "fresh", "unit", "worst")
    return _merged(graph.withColumn("fresh", F.lit(False)).unionByName(offers.mapInArrow(run, GRAPH)))


def _even(rows: pa.Table) -> bool:
    return len(set(map(len, rows["unit"].to_pylist()))) == 1


def neighbour_graph(nodes: DataFrame, count: int) -> DataFrame:
    """The nearest neighbours found of every node, as rows ``node``, ``other``, ``score``."""
    graph = written(_first_neighbours(nodes, count), "graph")
    for _ in range(ROUNDS):
        graph = written(_round(graph, nodes), "graph")
        changed, rows = graph.agg(F.count_if("fresh"), F.count("*")).first()
        if changed <= FEW * rows:
            break
    return graph


def _block(node: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(node)), F.lit(blocks)).cast("long")


def _scored(wanted: DataFrame, nodes: DataFrame, blocks: int) -> DataFrame:
    """Inner products of wanted pairs (``query``, ``block``, ``ids``, ``target``), in doubles.

    A block's vectors come to a task first and stay; requests then stream past.
    """
    stored = nodes.select(
        _block("node", blocks).alias("block"), F.lit(0).alias("turn"), F.col("node").alias("query"),
        F.col("vector").alias("target"), F.lit(None).cast("array<long>").alias("ids"),
    )
    asked = wanted.select("block", F.lit(1).alias("turn"), "query", "target", "ids")
    stream = stored.unionByName(asked).repartition("block").sortWithinPartitions("block", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        now = None
        for batch in batches:
            queries, ids, scores = [], [], []
            for block, turn, query, target, some in zip(*[batch.column(i) for i in range(5)], strict=True):
                if block.as_py() != now:
                    held, now = {}, block.as_py()
                x = np.frombuffer(target.as_py(), np.float64)
                if turn.as_py() == 0:
                    held[query.as_py()] = x
                    continue
                some = some.values.to_numpy()
                queries.append(query.as_py()), ids.append(some)
                scores.append(np.stack([held[i] for i in some.tolist()]) @ x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))],
                names=["query", "ids", "scores"],
            )

    return stream.mapInArrow(run, "query long, ids array<long>, scores array<double>")


BEAMS = "query long, ids array<long>, scores array<double>, done array<boolean>"


def _beams(pieces: DataFrame) -> DataFrame:
    """Merge what is known of each query and keep the best ``BEAM`` nodes, ties to smaller ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["query"]):
            ids, scores, done = (np.concatenate([np.asarray(v.values) for v in rows[c].combine_chunks()]) for c in ("ids", "scores", "done"))
            order = np.lexsort((~done.astype(bool), ids))  # of a node met twice the expanded one stays
            ids, scores, done = ids[order], scores[order], done[order]
            single = np.append(True, ids[1:] != ids[:-1])
            ids, scores, done = ids[single], scores[single], done[single]
            best = np.lexsort((ids, -scores))[:BEAM]
            yield pa.RecordBatch.from_arrays(
                [
                    rows["query"].combine_chunks()[:1],
                    pa.array([ids[best]], pa.list_(pa.int64())),
                    pa.array([scores[best]], pa.list_(pa.float64())),
                    pa.array([done[best].astype(bool)], pa.list_(pa.bool_())),
                ],
                names=["query", "ids", "scores", "done"],
            )

    return pieces.repartition("query").sortWithinPartitions("query").mapInArrow(run, BEAMS)


def _wanted(met: DataFrame, targets: DataFrame, blocks: int) -> DataFrame:
    """Nodes a query has met (``query``, ``other``), each once, by block, with its vector."""
    return (
        met.groupBy("query", _block("other", blocks).alias("block"))
        .agg(F.collect_set("other").alias("ids"))
        .join(targets, "query")
    )


def greedy_search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, count: int) -> DataFrame:
    """Best nodes of each query (``query``, ``ids``, ``scores``) by best-first search.

    ``queries`` has ``query``, ``size``, ``start`` (a node) and ``target`` (packed doubles). Every step
    expands all nodes of a beam that are not expanded yet, for all queries at once, until no
    beam has any; that takes few steps, each of some shuffles. Nodes are met by joins with the
    graph and scored by blocks.
    """
    blocks = count // BLOCK + 1
    edges = written(_both_ways(graph).groupBy("node").agg(F.collect_set("other").alias("others")), "edges")
    targets = queries.select("query", "target")
    # Very long vectors are near to many queries that the graph does not lead to them.
    longest = Window.partitionBy("size").orderBy(F.desc("length"), "node")
    seeds = (
        nodes.where("length > 1").select("size", "length", "node")
        .withColumn("place", F.row_number().over(longest)).where(F.col("place") <= LONGEST)
        .select("size", F.col("node").alias("other"))
    )
    first = queries.select("query", F.col("start").alias("other")).unionByName(
        queries.select("query", "size").join(seeds, "size").select("query", "other")
    )
    fresh, all_done = F.expr("transform(ids, x -> false)"), F.expr("transform(ids, x -> true)")
    beams = written(_beams(_scored(_wanted(first, targets, blocks), nodes, blocks).withColumn("done", fresh)), "beams")
    while True:
        front = beams.select("query", F.explode(F.expr("filter(ids, (x, i) -> NOT done[i])")).alias("node"))
        if front.isEmpty():
            return beams
        met = front.join(edges, "node").select("query", F.explode("others").alias("other"))
        news = _scored(_wanted(met, targets, blocks), nodes, blocks).withColumn("done", fresh)
        beams = written(_beams(beams.withColumn("done", all_done).unionByName(news)), "beams")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The ``k`` nearest rows found for each query row, by inner product in double precision.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``; ties go to the smaller
    id, and a row is no neighbour of its own. Equal vectors are one node of the graph, with
    their ``k + 1`` smallest ids, more than which no query can return; so they cannot crowd a
    graph, and ties among them are exact.

    Vectors may differ in length by any factor, and components be as large as doubles allow.
    Vectors that are null, zero or not finite and rows with a null id take no part. Vectors
    meet only vectors of their length. Of an id with several vectors the first by node asks.
    An empty table gives an empty result.
    """
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asks")))
    by_vector = rows.groupBy("embedding").agg(F.min("vec_id").alias("node"))
    classes = written(by_vector, "classes")
    count = classes.count()
    nodes = written(_prepared(classes), "nodes") if count else None
    if nodes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    graph = neighbour_graph(nodes, count)

    placed = written(rows.join(classes, "embedding").select("vec_id", "node", "asks").distinct(), "placed")
    smallest = Window.partitionBy("node").orderBy("vec_id")
    members = (
        placed.select("vec_id", "node").distinct()
        .withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
        .select("node", "vec_id")
    )
    asking = placed.where("asks").groupBy(F.col("vec_id").alias("query")).agg(F.min("node").alias("node"))
    # Queries with equal vectors are searched for once.
    searched = nodes.join(asking.select("node").distinct(), "node", "left_semi").select(
        F.col("node").alias("query"), "size", F.col("node").alias("start"), F.col("vector").alias("target")
    )
    beams = greedy_search(graph, nodes, written(searched, "queries"), count)
    best = beams.select(
        F.col("query").alias("asked"), F.inline(F.expr(f"slice(arrays_zip(ids, scores), 1, {k + 1})"))
    ).withColumnsRenamed({"ids": "node", "scores": "score"})
    found = asking.withColumnRenamed("node", "asked").join(best, "asked").join(members, "node").where("vec_id <> query")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        found.select("query", "vec_id", "score").distinct()
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
    )


def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found of every embedding whose id is divisible by 20."""
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
