"""User-defined functions, features and clusters, and data layout."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.udfs import power3, power3_native, register_udfs
from tallywork.operators.clustering import (
    fit_features,
    fit_kmeans,
    with_distances,
    with_part,
    with_weekday,
)
from tallywork.operators.layout import (
    kept,
    partition_profile,
    partitions_for_bytes,
    row_bytes,
    spread,
    text_bytes,
)
from tallywork.plans.registry import on_retail, query
from tallywork.session import scratch_path
from tallywork.sources.tables import Tables, retail

# --- user-defined functions ----------------------------------------------------------------


@query(
    "udf_column",
    """
    SELECT event_id, round(value * value * value, 4) AS cubed,
           round(value * value * value, 4) AS cubed_native
    FROM events
    """,
)
def udf_column(t: Tables) -> DataFrame:
    value = F.col("value")
    return t.events.select(
        "event_id",
        F.round(power3(value), 4).alias("cubed"),
        F.round(power3_native(value), 4).alias("cubed_native"),
    )


@query(
    "udf_sql",
    on_retail(
        """
        SELECT quantity, CAST(quantity AS DOUBLE) * quantity * quantity AS quantity_cubed,
               CAST(customer_id AS DOUBLE) * customer_id * customer_id AS customer_cubed
        FROM retail
        """
    ),
)
def udf_sql(t: Tables) -> DataFrame:
    register_udfs(t.spark)
    return t.spark.sql(
        """
        SELECT quantity, power3(quantity) AS quantity_cubed, power3(customer_id) AS customer_cubed
        FROM {sales}
        """,
        sales=retail(t, "quantity", "customer_id"),
    )


# --- features and clusters -----------------------------------------------------------------

CUT = "timestamp_ntz'1998-07-01 00:00:00'"
NUMERIC = ["unit_price", "quantity"]
LABEL = "day_of_week"

_PREPARED = """
SELECT invoice_no, quantity, unit_price, coalesce(customer_id, 0) AS customer_id,
       strftime(invoice_ts, '%A') AS day_of_week,
       CASE WHEN invoice_ts < TIMESTAMP '1998-07-01 00:00:00' THEN 'train' ELSE 'test' END AS part
FROM retail WHERE invoice_ts IS NOT NULL
"""
_INDEXED = f"""
SELECT p.*, i.day_index FROM ({_PREPARED}) p JOIN (
  SELECT day_of_week, row_number() OVER (ORDER BY count(*) DESC, day_of_week) - 1 AS day_index
  FROM ({_PREPARED}) WHERE part = 'train' GROUP BY 1
) i USING (day_of_week)
"""
# One place per weekday; the place for labels not seen in training is the one left out.
_ONE_HOT = ", ".join(
    f"CASE WHEN day_index = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS day_{i}" for i in range(7)
)


def _prepared(t: Tables, *columns: str) -> DataFrame:
    """Both parts in one pass, told apart by ``part``; only the wanted look-ups are joined."""
    sales = retail(t, *columns, "invoice_ts")
    return with_part(with_weekday(sales, "invoice_ts"), "invoice_ts", F.expr(CUT))


def _train(t: Tables) -> DataFrame:
    return _prepared(t, "invoice_no", *NUMERIC).where("part = 'train'")


@query(
    "ml_prep",
    on_retail(
        f"""
        SELECT part, day_of_week, count(*) AS n,
               count(*) FILTER (WHERE customer_id = 0) AS no_customer
        FROM ({_PREPARED}) GROUP BY 1, 2
        """
    ),
)
def ml_prep(t: Tables) -> DataFrame:
    return _prepared(t, "customer_id").groupBy("part", LABEL).agg(
        F.count("*").alias("n"), F.count_if(F.col("customer_id") == 0).alias("no_customer")
    )


def _transformed_train(t: Tables) -> DataFrame:
    train = _train(t)
    return fit_features(train, LABEL, NUMERIC).transform(train)


@query(
    "ml_index",
    on_retail(
        f"""
        SELECT day_of_week, CAST(day_index AS DOUBLE) AS day_index, count(*) AS n
        FROM ({_INDEXED}) WHERE part = 'train' GROUP BY 1, 2
        """
    ),
)
def ml_index(t: Tables) -> DataFrame:
    index = F.col("day_of_week_index").alias("day_index")
    return _transformed_train(t).groupBy(LABEL, index).agg(F.count("*").alias("n"))


@query(
    "ml_onehot",
    on_retail(
        f"SELECT DISTINCT day_of_week, {_ONE_HOT} FROM ({_INDEXED}) WHERE part = 'train'"
    ),
)
def ml_onehot(t: Tables) -> DataFrame:
    encoded = _transformed_train(t).select(LABEL, vector_to_array("day_of_week_encoded").alias("e"))
    return encoded.select(LABEL, *[F.get("e", F.lit(i)).alias(f"day_{i}") for i in range(7)]).distinct()


@query(
    "ml_assemble",
    on_retail(
        f"""
        SELECT invoice_no, unit_price, CAST(quantity AS DOUBLE) AS quantity, {_ONE_HOT}
        FROM ({_INDEXED}) WHERE part = 'train'
        """
    ),
)
def ml_assemble(t: Tables) -> DataFrame:
    rows = _transformed_train(t).select("invoice_no", vector_to_array("features").alias("f"))
    names = [*NUMERIC, *[f"day_{i}" for i in range(7)]]
    return rows.select(
        "invoice_no", *[F.get("f", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )


@query(
    "ml_stages",
    on_retail(
        f"""
        SELECT part, CAST(day_index AS DOUBLE) AS day_index, count(*) AS n,
               CAST(sum(quantity) AS BIGINT) AS quantity
        FROM ({_INDEXED}) GROUP BY 1, 2
        """
    ),
)
def ml_stages(t: Tables) -> DataFrame:
    # Fitted on the training rows only, then applied to both parts alike.
    both = _prepared(t, *NUMERIC)
    model = fit_features(both.where("part = 'train'"), LABEL, NUMERIC)
    return (
        model.transform(both)
        .groupBy("part", F.col("day_of_week_index").alias("day_index"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.get(vector_to_array("features"), F.lit(1)).cast("bigint")).alias("quantity"),
        )
    )


def _clustered(t: Tables) -> tuple[DataFrame, KMeansModel]:
    """Feature vectors of both parts, and the clusters of the training part.

    The prepared rows are written once, and fit, assignment and cost read them from there.
    """
    path = scratch_path(t.spark, "features")
    _prepared(t, *NUMERIC).select("part", LABEL, *NUMERIC).write.parquet(path)
    rows = t.spark.read.parquet(path)
    train = rows.where("part = 'train'")
    model = fit_features(train, LABEL, NUMERIC)
    return model.transform(rows), fit_kmeans(model.transform(train), k=20, seed=1)


@query(
    "ml_kmeans",
    on_retail(
        f"""
        SELECT count(*) FILTER (WHERE part = 'train') AS n, true AS each_at_its_nearest,
               true AS at_most_k
        FROM ({_PREPARED})
        """
    ),
)
def ml_kmeans(t: Tables) -> DataFrame:
    # Every training row is assigned, to the centre that is nearest of all.
    features, clusters = _clustered(t)
    assigned = clusters.transform(features.where("part = 'train'")).select("features", "prediction")
    own, least = F.col("own_distance"), F.col("least_distance")
    return with_distances(clusters, assigned).agg(
        F.count("*").alias("n"),
        F.every(own <= least + 1e-6 * (1 + least)).alias("each_at_its_nearest"),
        (F.count_distinct("prediction") <= 20).alias("at_most_k"),
    )


# The encoded day is one place of eight (the last, for unknown days, is left out).
_SPREAD = f"""
SELECT part, count(*) AS n,
       var_pop(unit_price) * count(*) + var_pop(quantity) * count(*) + count(*)
         - (SELECT sum(m * m) FROM (SELECT part AS p, day_index, count(*)::DOUBLE AS m FROM ({_INDEXED}) GROUP BY 1, 2)
            WHERE p = part) / count(*) AS about_mean
FROM ({_INDEXED}) GROUP BY 1
"""


@query(
    "ml_kmeans_cost",
    on_retail(
        f"""
        SELECT part, n, round(about_mean / 1e4) AS about_mean, part = 'train' AS within_training,
               part = 'train' AS as_reported
        FROM ({_SPREAD})
        """
    ),
)
def ml_kmeans_cost(t: Tables) -> DataFrame:
    # For the training part clusters cost no more than one centre at the mean, nor more than the
    # fit reports (for the centres before its last move); the other part is measured against the same centres without a promise.
    features, clusters = _clustered(t)
    size = len(clusters.clusterCenters()[0])
    place = [F.get("places", F.lit(i)) for i in range(size)]
    assigned = clusters.transform(features).select("part", "features", "prediction")
    measured = (
        with_distances(clusters, assigned, places="places")
        .groupBy("part")
        .agg(
            F.count("*").alias("n"),
            F.sum("own_distance").alias("cost"),
            sum((F.var_pop(p) for p in place[1:]), F.var_pop(place[0])).alias("spread"),
        )
    )
    total = F.col("spread") * F.col("n")
    reported = F.lit(float(clusters.summary.trainingCost))
    train = F.col("part") == "train"
    return measured.select(
        "part",
        "n",
        F.round(total / 1e4).alias("about_mean"),
        (train & (F.col("cost") <= total)).alias("within_training"),
        (train & (F.col("cost") <= reported * (1 + 1e-9))).alias("as_reported"),
    )


# --- layout --------------------------------------------------------------------------------


BYTES_PER_PARTITION = 128 * 1024 * 1024


def _cores(t: Tables) -> int:
    return t.spark.sparkContext.defaultParallelism


@query("lay_coalesce", "SELECT o_orderkey, o_custkey FROM orders")
def lay_coalesce(t: Tables) -> DataFrame:
    # The number follows the table: a fixed one would leave a large cluster idle.
    orders = t.orders.select("o_orderkey", "o_custkey")
    return orders.coalesce(partitions_for_bytes(orders, BYTES_PER_PARTITION, _cores(t)))


@query(
    "lay_repartition",
    """
    SELECT o_orderkey, o_orderpriority, way FROM orders, (VALUES ('by number'), ('by column'),
      ('by both')) w(way)
    """,
)
def lay_repartition(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    number = partitions_for_bytes(orders, BYTES_PER_PARTITION, _cores(t))
    ways = {
        "by number": orders.repartition(number),
        "by column": spread(orders, "o_orderpriority"),
        "by both": spread(orders, "o_orderpriority", partitions=2 * number, salts=number).coalesce(
            number
        ),
    }
    by_number, by_column, by_both = [df.withColumn("way", F.lit(w)) for w, df in ways.items()]
    return by_number.union(by_column).union(by_both)


@query(
    "lay_by_bytes",
    """
    SELECT 'orders' AS name, count(*) AS n, true AS near_target FROM orders
    UNION ALL SELECT 'documents', count(*), true FROM documents
    """,
)
def lay_by_bytes(t: Tables) -> DataFrame:
    # Narrow rows and wide ones fill partitions of about the same size, whatever their number.
    checks = []
    for name in ("orders", "documents"):
        df = getattr(t, name)
        target = max(1, text_bytes(df) // 12)
        laid = df.repartition(partitions_for_bytes(df, target))
        sizes = laid.groupBy(F.spark_partition_id().alias("partition")).agg(
            F.count("*").alias("n"), F.sum(row_bytes(df)).alias("bytes")
        )
        checks.append(
            sizes.agg(F.sum("n").alias("n"), F.avg("bytes").alias("mean")).select(
                F.lit(name).alias("name"), "n", F.col("mean").between(target / 2, target * 2).alias("near_target")
            )
        )
    return checks[0].unionByName(checks[1])


@query("lay_partition_profile", "SELECT count(*) AS n, true AS filled FROM lineitem")
def lay_partition_profile(t: Tables) -> DataFrame:
    profile = partition_profile(t.lineitem)
    return profile.agg(F.sum("n").alias("n"), F.every(F.col("n") > 0).alias("filled"))


@query(
    "lay_cache",
    """
    SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders WHERE o_totalprice > 1000)
      AS total
    FROM orders WHERE o_totalprice > 1000 GROUP BY 1
    """,
)
def lay_cache(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-by-status")
    with kept(t.orders.where("o_totalprice > 1000").select("o_orderstatus")) as orders:
        total = orders.count()
        by_status = orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
        by_status.withColumn("total", F.lit(total).cast("bigint")).write.parquet(path)
    return t.spark.read.schema("o_orderstatus string, n bigint, total bigint").parquet(path)
