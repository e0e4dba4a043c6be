"""Clustering, the event classifier and samples."""

from pyspark.sql import functions as F

from eventmart.operators import learning, sampling, stats
from eventmart.plans import oracle
from eventmart.plans.batch import rounded_marts
from eventmart.plans.registry import query
from eventmart.schemas import FEATURES
from eventmart.session import work_dir
from eventmart.sources.adapter import app_events

CLUSTERS, ITERATIONS = 4, 20
# Shares of the sample per event type.
FRACTIONS = {"buy": 0.5, "login": 0.25, "win": 0.1, "lose": 0.1, "logout": 0.1}

BUCKET = "CAST('0x' || md5(event_id)[1:8] AS BIGINT) % 10000"


def _clustered(spark, sf_dir):
    """(model, feature rows) with the features stored, so that fitting and assigning read the same numbers once."""
    path = work_dir(spark, "features")
    stats.features(rounded_marts(spark, sf_dir)).write.parquet(path)
    rows = spark.read.parquet(path)
    return learning.fit_kmeans(rows, CLUSTERS, ITERATIONS), rows


@query("mart_kmeans_centers")
def mart_kmeans_centers(spark, sf_dir):
    return learning.kmeans_centers(spark, _clustered(spark, sf_dir)[0])


@query("mart_kmeans_assignments")
def mart_kmeans_assignments(spark, sf_dir):
    model, rows = _clustered(spark, sf_dir)
    return learning.kmeans_assignments(model, rows).select("account_id", "app_id", "cluster")


SPREAD = " + ".join(f"var_pop({f}) * count(*)" for f in FEATURES)


@query("mart_kmeans_invariants", oracle.with_marts(f"""
    SELECT {CLUSTERS} AS clusters, count(*) AS marts, count(*) AS in_clusters, CAST(0 AS BIGINT) AS not_nearest,
      CAST(round({SPREAD}, 0) AS BIGINT) AS spread, true AS tighter FROM mart"""))
def mart_kmeans_invariants(spark, sf_dir):
    """What holds for any k-means: every mart is in the cluster of its nearest center, and the clusters are tighter
    than all marts around their mean."""
    model, rows = _clustered(spark, sf_dir)
    centers = learning.kmeans_centers(spark, model)

    def distance(center):
        return sum((F.col(f) - F.lit(float(x))) ** 2 for f, x in zip(FEATURES, center))

    distances = F.array(*[distance(c) for c in model.clusterCenters()])
    rated = learning.kmeans_assignments(model, rows).select("*", F.get(distances, "cluster").alias("own"), F.array_min(distances).alias("least"))
    spread = sum(F.var_pop(f) * F.count("*") for f in FEATURES)
    summed = rated.agg(
        F.count("*").alias("marts"), F.count_if(F.col("own") > F.col("least") * 1.000001 + 1e-6).alias("not_nearest"),
        spread.alias("total"), F.sum("own").alias("inertia"))
    sized = centers.agg(F.count("*").cast("int").alias("clusters"), F.sum("size").alias("in_clusters"))
    return sized.join(summed).select(
        "clusters", "marts", "in_clusters", "not_nearest", F.round("total", 0).cast("long").alias("spread"),
        (F.col("inertia") <= F.col("total")).alias("tighter"))


@query("event_label_features", oracle.with_events(f"""
    SELECT event_id, CAST(event_type = 'win' AS DOUBLE) AS label, purchase,
      CAST(payment_type = 'credit' AS DOUBLE) AS payment_credit,
      CAST(event_timestamp AS DOUBLE) AS event_timestamp,
      CAST(dayofweek(make_timestamp(event_timestamp * 1000)) + 1 AS DOUBLE) AS day_of_week,
      CAST(hour(make_timestamp(event_timestamp * 1000)) AS DOUBLE) AS hour_of_day,
      CAST({oracle.hash_sql('app_id')} AS DOUBLE) AS app_hash FROM app_event"""))
def event_label_features(spark, sf_dir):
    return learning.event_label_features(app_events(spark, sf_dir))


@query("train_test_split", oracle.with_events(f"""
    SELECT event_id, CASE WHEN {BUCKET} < 7000 THEN 'train' ELSE 'test' END AS split FROM app_event"""))
def train_test_split(spark, sf_dir):
    return learning.split_by_id(app_events(spark, sf_dir).select("event_id"))


def _fitted_tree(spark, sf_dir):
    """(model, its predictions of the test rows), with the features stored."""
    path = work_dir(spark, "labels")
    learning.split_by_id(event_label_features(spark, sf_dir)).write.parquet(path)
    rows = spark.read.parquet(path)
    model = learning.fit_event_tree(rows.where(F.col("split") == "train"))
    return model, learning.predict_events(model, rows.where(F.col("split") == "test"))


def _tree_predictions(spark, sf_dir):
    return _fitted_tree(spark, sf_dir)[1]


@query("event_tree_invariants", oracle.with_events(f"""
    SELECT count(*) AS rows, count(*) FILTER (event_type = 'win') AS wins, count(DISTINCT event_id) AS ids,
      CAST(0 AS BIGINT) AS other_predictions, true AS no_worse_than_guessing, true AS depth_in_bounds
    FROM app_event WHERE {BUCKET} >= 7000"""))
def event_tree_invariants(spark, sf_dir):
    """What holds for any useful tree: every test row once, with one of two labels, and no more errors than from
    always answering with the commoner label."""
    model, predictions = _fitted_tree(spark, sf_dir)
    wrong = F.count_if(F.col("label") != F.col("prediction"))
    wins = F.count_if(F.col("label") == 1.0)
    return predictions.agg(
        F.count("*").alias("rows"), wins.alias("wins"), F.count_distinct("event_id").alias("ids"),
        F.count_if(~F.col("prediction").isin(0.0, 1.0)).alias("other_predictions"),
        (wrong <= F.least(wins, F.count("*") - wins)).alias("no_worse_than_guessing"),
        F.lit(model.depth <= 5).alias("depth_in_bounds"))


@query("event_tree_predictions")
def event_tree_predictions(spark, sf_dir):
    return _tree_predictions(spark, sf_dir)


@query("event_tree_error")
def event_tree_error(spark, sf_dir):
    return learning.prediction_error(_tree_predictions(spark, sf_dir))


@query("stratified_sample", oracle.with_events(
    f"SELECT * FROM app_event WHERE {BUCKET} < CASE event_type "
    + " ".join(f"WHEN '{k}' THEN {round(v * 10_000)}" for k, v in FRACTIONS.items()) + " ELSE 0 END"))
def stratified_sample(spark, sf_dir):
    return learning.stratified_sample_by_id(app_events(spark, sf_dir), "event_type", FRACTIONS)


SHARES = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {round(v * 10_000)}" for k, v in FRACTIONS.items()) + " ELSE 0 END"


@query("stratified_sample_exact", oracle.with_events(f"""
    SELECT * EXCLUDE (place, wanted) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY CAST('0x' || md5(event_id)[1:15] AS BIGINT), event_id) AS place,
               (count(*) OVER (PARTITION BY event_type) * {SHARES} + 9999) // 10000 AS wanted FROM app_event)
    WHERE place <= wanted"""))
def stratified_sample_exact(spark, sf_dir):
    """As many rows of each kind as its share says, to the row."""
    return sampling.exact_stratified_sample(app_events(spark, sf_dir), "event_type", FRACTIONS, "event_id")
