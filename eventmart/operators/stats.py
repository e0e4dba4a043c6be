"""Column statistics and correlation of the mart features."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from eventmart.schemas import FEATURES

# Statistic names, in the order they are reported.
METRICS = ["count", "mean", "variance", "min", "max", "numNonZeros", "normL1", "normL2"]


def features(marts):
    """Marts with their ten features as doubles."""
    return marts.select("account_id", "app_id", *[F.col(f).cast("double").alias(f) for f in FEATURES])


def with_vector(df, columns=FEATURES):
    """Add the columns as one dense vector named `features`."""
    return df.withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))


def column_stats(feature_rows, columns=FEATURES):
    """One row per feature: count, mean, sample variance, min, max, non-zeros, L1 and L2 norm.

    One pass with partial aggregation; only one summary per task is shuffled.
    """
    vectors = with_vector(feature_rows.select(*columns), columns)
    summary = vectors.agg(Summarizer.metrics(*METRICS).summary(F.col("features")).alias("s"))
    arrays = {m: vector_to_array(f"s.{m}") for m in METRICS if m != "count"}
    zipped = summary.select(
        F.col("s.count").alias("count"),
        F.posexplode(F.arrays_zip(F.array(*[F.lit(c) for c in columns]).alias("feature"),
                                  *[a.alias(m) for m, a in arrays.items()])).alias("position", "z"),
    )
    return zipped.select(
        F.col("z.feature").alias("feature"), "count",
        F.col("z.mean").alias("mean"), F.col("z.variance").alias("variance"),
        F.col("z.min").alias("min"), F.col("z.max").alias("max"),
        F.col("z.numNonZeros").cast("long").alias("num_nonzeros"),
        F.col("z.normL1").alias("norm_l1"), F.col("z.normL2").alias("norm_l2"),
    )


def correlation(feature_rows, columns=FEATURES):
    """Pearson correlation in long form, one row per ordered pair of features.

    A constant feature gives NaN against others; the diagonal is always 1. Only the matrix, as large
    as the number of columns squared, comes to the driver.
    """
    vectors = with_vector(feature_rows, columns).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        matrix = Correlation.corr(vectors, "features", "pearson").first()[0].toArray()
    finally:
        vectors.unpersist()
    rows = [(a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return feature_rows.sparkSession.createDataFrame(rows, "feature_i string, feature_j string, corr double")
