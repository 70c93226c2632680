"""Feature preparation and k-means."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.dates import weekday
from tallywork.operators.layout import partitions_for


def with_weekday(df: DataFrame, time: str) -> DataFrame:
    """Numbers without nulls (null becomes 0) and the day name in ``day_of_week``."""
    return df.na.fill(0).withColumn("day_of_week", weekday(F.col(time)))


def split_at(df: DataFrame, time: str, cut: Column) -> tuple[DataFrame, DataFrame]:
    """Rows before and from ``cut`` on; a null time is in neither part."""
    return df.where(F.col(time) < cut), df.where(F.col(time) >= cut)


def with_part(df: DataFrame, time: str, cut: Column) -> DataFrame:
    """The same split in one pass: ``part`` is train before ``cut``, else test; no null times."""
    part = F.when(F.col(time) < cut, "train").otherwise("test")
    return df.where(F.col(time).isNotNull()).withColumn("part", part)


def feature_steps(label: str, numeric: Sequence[str], scale: bool = False) -> Pipeline:
    """Label index, one-hot vector and feature vector, fitted together.

    Labels are indexed by falling frequency, equal ones by name. A label first seen in later
    data gets an index of its own. ``scale`` divides by the deviation, so that no feature rules
    the distance by its unit alone.
    """
    index, encoded = f"{label}_index", f"{label}_encoded"
    assembled = "unscaled" if scale else "features"
    steps = [
        StringIndexer(inputCol=label, outputCol=index, handleInvalid="keep"),
        OneHotEncoder(inputCol=index, outputCol=encoded),
        VectorAssembler(inputCols=[*numeric, encoded], outputCol=assembled),
    ]
    if scale:
        steps.append(StandardScaler(inputCol=assembled, outputCol="features"))
    return Pipeline(stages=steps)


def fit_features(
    train: DataFrame, label: str, numeric: Sequence[str], scale: bool = False
) -> PipelineModel:
    return feature_steps(label, numeric, scale).fit(train)


def fit_kmeans(
    features: DataFrame, k: int = 20, seed: int = 1, rows_per_partition: int = 1_000_000
) -> KMeansModel:
    """Fit ``k`` centres to the feature vectors.

    Every iteration reads all rows, so they are spread evenly over the cores, whatever
    joins left them in, in as many parts as the cores work off in whole rounds. The fit itself
    keeps the vectors it reads (and spills them) until the model is there; were the frame kept
    here, each iteration would decode all rows again. The row solver is named because its
    distances keep their digits far from the origin, and choosing one takes a pass.
    """
    cores = features.sparkSession.sparkContext.defaultParallelism
    rounds = -(-partitions_for(features, rows_per_partition, cores) // cores)
    training = features.select("features").repartition(rounds * cores)
    return KMeans(k=k, seed=seed, featuresCol="features", solver="row").fit(training)


def with_distances(
    model: KMeansModel, assigned: DataFrame, features: str = "features", places: str | None = None
) -> DataFrame:
    """The rows of ``model.transform`` with ``own_distance`` and ``least_distance``.

    Squared distances to the row's own centre and to the nearest of all. Whole batches of rows
    are multiplied with the matrix of the centres, which are part of the model and few; the two
    distances are then taken from the differences, so that large coordinates cost no digits. The
    feature vectors themselves are left out; ``places`` names a column that keeps them as arrays.
    """
    centres = np.array([list(c) for c in model.clusterCenters()], float)
    carried = [c for c in assigned.columns if c != features]
    values = places or "_places"
    clashing = {values, "own_distance", "least_distance"} & set(carried)
    if clashing:
        raise ValueError(f"rename before measuring: {', '.join(sorted(clashing))}")
    fields = [assigned.schema[c] for c in carried]
    returned = carried
    if places:
        fields.append(T.StructField(places, T.ArrayType(T.DoubleType())))
        returned = [*carried, places]
    schema = T.StructType(
        [*fields, T.StructField("own_distance", T.DoubleType()), T.StructField("least_distance", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (centres**2).sum(axis=1) / 2
        for batch in batches:
            points = batch.column(values).flatten().to_numpy().reshape(batch.num_rows, -1)
            # |x - c|^2 / 2 = |x|^2 / 2 - x.c + |c|^2 / 2, and the first term is one for all centres.
            nearest = (half - points @ centres.T).argmin(axis=1)
            own = batch.column(model_column).to_numpy(zero_copy_only=False)
            own_distance = ((points - centres[own]) ** 2).sum(axis=1)
            # One distance serves for both, but for rows at the edge of two clusters.
            least_distance, other = own_distance.copy(), own != nearest
            least_distance[other] = ((points[other] - centres[nearest[other]]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in returned), pa.array(own_distance), pa.array(least_distance)],
                names=[*returned, "own_distance", "least_distance"],
            )

    model_column = model.getPredictionCol()
    return assigned.select(*carried, vector_to_array(features).alias(values)).mapInArrow(run, schema)


def cluster_costs(model: KMeansModel, features: DataFrame) -> DataFrame:
    """Rows and summed squared distance per cluster, for training or any other rows."""
    column = model.getFeaturesCol()
    assigned = model.transform(features).select(column, model.getPredictionCol())
    return (
        with_distances(model, assigned, column)
        .groupBy(model.getPredictionCol())
        .agg(F.count("*").alias("n"), F.sum("own_distance").alias("cost"))
    )
