"""Clustering of marts and the event classifier."""

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from eventmart.functions.hashing import java_string_hash
from eventmart.functions.instants import utc_date, utc_hour
from eventmart.operators.stats import column_stats, correlation, features, with_vector
from eventmart.schemas import CREDIT, FEATURES, WIN

LABEL_FEATURES = ["purchase", "payment_credit", "event_timestamp", "day_of_week", "hour_of_day", "app_hash"]


def fit_kmeans(feature_rows, k, iterations, seed=1, columns=FEATURES):
    """Train k-means on the feature columns; the cluster sizes are counted along with it."""
    vectors = with_vector(feature_rows, columns).select("features")
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=k, maxIter=iterations, seed=seed).fit(vectors)
        model.summary.clusterSizes  # computed now, while the vectors are at hand, and kept by the model
        return model
    finally:
        vectors.unpersist()


def kmeans_assignments(model, feature_rows, columns=FEATURES):
    """Feature rows with their cluster number."""
    vectors = with_vector(feature_rows, columns)
    return model.transform(vectors).drop("features").withColumnRenamed("prediction", "cluster")


def kmeans_centers(spark, model, columns=FEATURES):
    """One row per cluster: its number, size and center. As many rows as the model has clusters."""
    sizes = model.summary.clusterSizes
    rows = [(i, int(sizes[i]), *map(float, center)) for i, center in enumerate(model.clusterCenters())]
    fields = ", ".join(f"center_{c} double" for c in columns)
    return spark.createDataFrame(rows, f"cluster int, size long, {fields}")


def event_label_features(events):
    """Label (1 for a win) and numeric features of each event; the event type is no feature."""
    return events.select(
        "event_id",
        F.when(F.col("event_type") == WIN, 1.0).otherwise(0.0).alias("label"),
        "purchase",
        F.when(F.col("payment_type") == CREDIT, 1.0).otherwise(0.0).alias("payment_credit"),
        F.col("event_timestamp").cast("double").alias("event_timestamp"),
        F.dayofweek(utc_date("event_timestamp")).cast("double").alias("day_of_week"),
        utc_hour("event_timestamp").cast("double").alias("hour_of_day"),
        java_string_hash("app_id").cast("double").alias("app_hash"),
    )


def bucket_of(column, buckets=10_000):
    """Even, repeatable bucket of an id: the leading 32 bits of its digest modulo `buckets`."""
    return F.conv(F.substring(F.md5(column), 1, 8), 16, 10).cast("long") % buckets


def split_by_id(rows, train_share=0.7, column="event_id"):
    """Add `split` = train or test. The same id lands on the same side in every run and retry."""
    limit = round(train_share * 10_000)
    return rows.withColumn("split", F.when(bucket_of(column) < limit, "train").otherwise("test"))


def random_split(rows, train_share=0.7, seed=1):
    """Random (train, test) split."""
    return rows.randomSplit([train_share, 1.0 - train_share], seed)


def fit_event_tree(train):
    """Two-class decision tree: gini impurity, depth 5, 32 bins."""
    vectors = with_vector(train, LABEL_FEATURES).select("label", "features")
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return DecisionTreeClassifier(impurity="gini", maxDepth=5, maxBins=32).fit(vectors)
    finally:
        vectors.unpersist()


def predict_events(model, rows):
    """(event_id, label, prediction) of each row."""
    return model.transform(with_vector(rows, LABEL_FEATURES)).select("event_id", "label", "prediction")


def prediction_error(predictions):
    """Number of rows and share of wrong predictions."""
    wrong = F.when(F.col("label") != F.col("prediction"), 1.0).otherwise(0.0)
    return predictions.agg(F.count("*").alias("rows"), F.avg(wrong).alias("error"))


def stratified_sample(rows, column, fractions, seed=1):
    """Random sample with its own share per stratum."""
    return rows.sampleBy(column, fractions, seed)


def stratified_sample_by_id(rows, column, fractions, id_column="event_id"):
    """As `stratified_sample`, but repeatable: an id is drawn by its bucket. Unnamed strata give none."""
    share = F.lit(0)
    for value, fraction in fractions.items():
        share = F.when(F.col(column) == value, F.lit(round(fraction * 10_000))).otherwise(share)
    return rows.where(bucket_of(id_column) < share)


def report(spark, marts, k, iterations, seed=1):
    """Cluster centers, correlations and column statistics of the marts, from one cached feature table."""
    rows = features(marts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centers = kmeans_centers(spark, fit_kmeans(rows, k, iterations, seed))
        correlations = correlation(rows)
        summary = column_stats(rows).collect()  # one row per feature
        return {
            "centers": centers, "correlation": correlations,
            "column_stats": spark.createDataFrame(summary, column_stats(rows).schema),
        }
    finally:
        rows.unpersist()
