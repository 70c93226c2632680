"""Approximate nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywork.llm import neighbours
from tallywork.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>"


def brute(data, asks, k=20):
    known = [(i, np.array(v, float)) for i, v in data if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    found = []
    for q, x in known:
        if not asks(q):
            continue
        near = sorted((-float(y @ x), i) for i, y in known if i != q and len(y) == len(x))[:k]
        found += [(q, n, i) for n, (_, i) in enumerate(near, 1)]
    return sorted(found)


def answer(df):
    return sorted((r.query_id, r.rank, r.vec_id) for r in df.collect())


def test_registered_query_finds_nearly_all(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = brute(data, lambda i: i % 20 == 0)
    found = QUERIES["op8_nearest_neighbours"](spark, SMALL)
    pairs = {(q, i) for q, _, i in answer(found)}
    assert len({(q, i) for q, _, i in expected} & pairs) >= 0.9 * len(expected)
    vectors = {i: np.array(v, float) for i, v in data}
    for r in found.collect():
        assert abs(r.score - vectors[r.query_id] @ vectors[r.vec_id]) < 1e-12


def test_odd_rows_ties_and_lengths(spark):
    data = [(i, [float(np.cos(i)), float(np.sin(i)), 0.5]) for i in range(40)]
    data += [(100 + i, [3.0, 0.0, 0.0]) for i in range(30)]  # equal: ties go to smaller ids
    data += [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 0.0]), (204, [float("nan"), 1.0, 1.0])]
    data += [(None, [1.0, 1.0, 1.0]), (205, [float("inf"), 0.0, 0.0]), (220, [1.0, 2.0]), (221, [2.0, 2.0])]
    stored = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in data]
    df = spark.createDataFrame(stored, VECTORS).withColumn("node", F.lit("own")).withColumn("score", F.lit(1))
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0)
    assert answer(found) == brute(stored, lambda i: i % 20 == 0)


def test_fewer_candidates_than_asked_for(spark):
    data = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    found = neighbours.nearest(spark.createDataFrame(data, VECTORS), F.col("vec_id") % 20 == 0)
    assert answer(found) == [(0, 1, 2), (0, 2, 1)]


def test_empty_and_lonely(spark):
    everything = F.col("vec_id") >= 0
    assert answer(neighbours.nearest(spark.createDataFrame([], VECTORS), everything)) == []
    assert answer(neighbours.nearest(spark.createDataFrame([(0, [1.0])], VECTORS), everything)) == []


def test_repeated_rows_are_one(spark):
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0])]
    found = neighbours.nearest(spark.createDataFrame(data, VECTORS), F.col("vec_id") == 0)
    assert answer(found) == [(0, 1, 1)]


def test_several_rounds_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "DEGREE", 12)
    rng = np.random.default_rng(2)
    data = [(i, [float(np.float32(c)) for c in rng.normal(size=8) * rng.uniform(0.2, 3)]) for i in range(500)]
    expected = {(q, i) for q, _, i in brute(data, lambda i: i % 20 == 0)}
    found = {(q, i) for q, _, i in answer(neighbours.nearest(spark.createDataFrame(data, VECTORS), F.col("vec_id") % 20 == 0))}
    assert len(found & expected) >= 0.9 * len(expected)


def recall(spark, data, schema):
    expected = {(q, i) for q, _, i in brute(data, lambda i: i % 20 == 0)}
    found = {(q, i) for q, _, i in answer(neighbours.nearest(spark.createDataFrame(data, schema), F.col("vec_id") % 20 == 0))}
    return len(found & expected) / len(expected)


@pytest.mark.parametrize("odd", ["longer", "overflow", "some"])
def test_long_vectors_do_not_flatten_the_rest(spark, odd):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    vectors = [centres[n % 40] + 0.4 * rng.normal(size=32) for n in range(4_000)]
    if odd == "longer":
        vectors[7] = vectors[7] * 10_000
    if odd == "overflow":  # its norm squared is beyond any double
        vectors[7] = np.where(np.arange(32) % 2, 1e200, -1e200)
    if odd == "some":
        vectors[::40] = [v * 1_000 for v in vectors[::40]]
    data = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    assert recall(spark, data, "vec_id long, embedding array<double>") >= 0.95
