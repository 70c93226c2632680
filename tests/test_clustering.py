"""Features and k-means."""

import math

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from support import rows
from tallywork.operators import clustering
from tallywork.operators.clustering import (
    cluster_costs,
    fit_features,
    fit_kmeans,
    split_at,
    with_distances,
    with_weekday,
)
from tallywork.sources.tables import retail


@pytest.fixture(scope="module")
def parts(tables):
    sales = retail(tables, "quantity", "unit_price", "customer_id", "invoice_ts")
    prepared = with_weekday(sales, "invoice_ts")
    return split_at(prepared, "invoice_ts", F.expr("timestamp_ntz'1998-07-01 00:00:00'"))


@pytest.fixture(scope="module")
def features(parts):
    return fit_features(parts[0], "day_of_week", ["unit_price", "quantity"])


def test_preparation_and_split(parts, tables):
    train, test = parts
    assert train.count() + test.count() == tables.lineitem.count()
    assert train.where("customer_id IS NULL").count() == 0
    assert train.where("customer_id = 0").count() > 0


def test_a_null_time_is_in_neither_part(spark):
    df = spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS t UNION ALL SELECT timestamp_ntz'2011-01-01'")
    before, after = split_at(df, "t", F.expr("timestamp_ntz'2011-07-01'"))
    assert (before.count(), after.count()) == (1, 0)


def test_index_by_frequency_then_name(spark):
    labels = ["b", "a", "c", "c", "c"]
    df = spark.createDataFrame([(x, 1.0) for x in labels], "label string, n double")
    indexed = fit_features(df, "label", ["n"]).transform(df)
    assert dict(rows(indexed.select("label", "label_index").distinct())) == {
        "c": 0.0,
        "a": 1.0,
        "b": 2.0,
    }


def test_a_label_not_seen_in_training_gets_its_own_place(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "label string, n double")
    later = spark.createDataFrame([("z", 3.0)], "label string, n double")
    row = fit_features(train, "label", ["n"]).transform(later).first()
    assert row.label_index == 2.0 and row.features.toArray().tolist() == [3.0, 0.0, 0.0]


def test_features_of_both_parts_have_one_shape(parts, features):
    sizes = [
        features.transform(p).select(F.size(vector_to_array("features"))).distinct().collect()
        for p in parts
    ]
    assert sizes[0] == sizes[1] and sizes[0][0][0] == 9


def test_cluster_cost_equals_brute_force_and_the_model(parts, features):
    train = features.transform(parts[0])
    model = fit_kmeans(train, k=20, seed=1)
    costs = cluster_costs(model, train)
    total = costs.agg(F.sum("cost")).first()[0]
    # The summary's cost is that of the last step before the centres settled.
    assert math.isclose(total, model.summary.trainingCost, rel_tol=1e-3)
    centres = model.clusterCenters()
    points = [row.features.toArray() for row in train.select("features").collect()]
    brute = sum(min(((p - c) ** 2).sum() for c in centres) for p in points)
    assert math.isclose(total, brute, rel_tol=1e-6)
    assert costs.agg(F.sum("n")).first()[0] == len(points)
    held_out = cluster_costs(model, features.transform(parts[1]))
    assert held_out.agg(F.sum("n")).first()[0] == parts[1].count()


def test_distances_equal_brute_force(parts, features):
    model = fit_kmeans(features.transform(parts[0]), k=20, seed=1)
    both = model.transform(features.transform(parts[1])).select("quantity", "features", "prediction")
    centres = model.clusterCenters()
    measured = with_distances(model, both)
    assert measured.columns == ["quantity", "prediction", "own_distance", "least_distance"]
    points = {tuple(r.features.toArray()): r.prediction for r in both.collect()}
    expected = {
        (round(((p - c) ** 2).sum(), 6), round(min(((p - x) ** 2).sum() for x in centres), 6))
        for p, c in ((np.array(p), centres[at]) for p, at in points.items())
    }
    found = {(round(r.own_distance, 6), round(r.least_distance, 6)) for r in measured.collect()}
    assert found == expected


def test_a_fit_keeps_its_vectors_once_in_whole_rounds_of_the_cores(spark, monkeypatch):
    seen = []

    class Watched(KMeans):
        def fit(self, dataset):
            kept = dataset.storageLevel.useMemory or dataset.storageLevel.useDisk
            seen.append((dataset.rdd.getNumPartitions(), kept, self.getSolver()))
            return super().fit(dataset)

    monkeypatch.setattr(clustering, "KMeans", Watched)
    df = spark.createDataFrame([(Vectors.dense([float(n % 5), n % 2]),) for n in range(90)], ["features"])
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = fit_kmeans(df, k=3, rows_per_partition=10)
    assert seen == [(16, False, "row")]
    assert len(model.clusterCenters()) == 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_features_are_kept_as_arrays_on_demand(spark):
    df = spark.createDataFrame([(n, Vectors.sparse(2, {0: float(n)})) for n in range(6)], ["n", "features"])
    model = fit_kmeans(df, k=2, seed=1)
    measured = with_distances(model, model.transform(df), places="places")
    assert measured.columns == ["n", "prediction", "places", "own_distance", "least_distance"]
    assert rows(measured, "n", "places") == [(n, [float(n), 0.0]) for n in range(6)]


def test_distance_to_another_cluster_may_be_the_least(spark):
    df = spark.createDataFrame([(Vectors.dense([x]),) for x in (0.0, 0.0, 10.0, 10.0)], ["features"])
    model = fit_kmeans(df, k=2, seed=1)
    swapped = model.transform(df).withColumn("prediction", 1 - F.col("prediction"))
    assert rows(with_distances(model, swapped), "own_distance", "least_distance") == [(100.0, 0.0)] * 4


def test_distances_keep_their_digits_far_from_the_origin(spark):
    rows = [(Vectors.dense([1e8 + n % 2, 5.0 * (n % 2)]),) for n in range(40)]
    df = spark.createDataFrame(rows, ["features"])
    model = fit_kmeans(df, k=2, seed=1)
    measured = with_distances(model, model.transform(df))
    assert measured.agg(F.max("own_distance"), F.max("least_distance")).first() == (0.0, 0.0)
    with pytest.raises(ValueError, match="own_distance"):
        with_distances(model, model.transform(df.withColumn("own_distance", F.lit(1))))
    assert with_distances(model, model.transform(df.where("false"))).collect() == []


def test_scaled_features(parts):
    scaled = fit_features(parts[0], "day_of_week", ["unit_price", "quantity"], scale=True)
    first = F.get(vector_to_array("features"), F.lit(1))
    deviation = scaled.transform(parts[0]).agg(F.stddev_samp(first)).first()[0]
    assert math.isclose(deviation, 1.0, rel_tol=1e-9)
