"""Column statistics and correlation that add up: a batch leaves one row of moments, and rows of moments merge.

A state holds the number of rows and, for every pair of columns, means and the co-moment (the sum of products of
deviations from the means). States merge exactly but for rounding, pair by pair in order of their part, by what the
deviation between their means adds; nothing but states is read again.
"""

from itertools import combinations_with_replacement

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import FEATURES
from eventmart.storage.upsert import KeyedTable

STATE_SCHEMA = T.StructType([T.StructField("part", T.StringType())] + [T.StructField(n, t) for n, t in (
    ("feature_i", T.StringType()), ("feature_j", T.StringType()), ("count", T.LongType()), ("mean_i", T.DoubleType()),
    ("mean_j", T.DoubleType()), ("comoment", T.DoubleType()), ("min", T.DoubleType()), ("max", T.DoubleType()),
    ("num_nonzeros", T.LongType()), ("norm_l1", T.DoubleType()), ("squares", T.DoubleType()))])


def moments(rows, part, columns=FEATURES):
    """The state of some rows: one row per pair of columns, i not after j, in one pass with partial aggregates."""
    x = {c: F.col(c).cast("double") for c in columns}
    pairs = list(combinations_with_replacement(columns, 2))
    once = [a.alias(f"{n}_{i}") for i, c in enumerate(columns) for n, a in (
        ("mean", F.avg(x[c])), ("min", F.min(x[c])), ("max", F.max(x[c])), ("nonzeros", F.count_if(x[c] != 0)),
        ("l1", F.sum(F.abs(x[c]))), ("squares", F.sum(x[c] * x[c])))]
    both = [(F.covar_pop(x[a], x[b]) * F.count("*")).alias(f"co_{n}") for n, (a, b) in enumerate(pairs)]
    one = rows.agg(F.count("*").alias("count"), *once, *both)
    place = {c: i for i, c in enumerate(columns)}
    states = [F.struct(
        F.lit(part).alias("part"), F.lit(a).alias("feature_i"), F.lit(b).alias("feature_j"), F.col("count"),
        F.col(f"mean_{place[a]}").alias("mean_i"), F.col(f"mean_{place[b]}").alias("mean_j"), F.col(f"co_{n}").alias("comoment"),
        *[F.col(f"{short}_{place[a]}").alias(name) for short, name in (
            ("min", "min"), ("max", "max"), ("nonzeros", "num_nonzeros"), ("l1", "norm_l1"), ("squares", "squares"))])
        for n, (a, b) in enumerate(pairs)]
    return one.where("count > 0").select(F.explode(F.array(*states)).alias("s")).select("s.*")


def moment_table(spark, path):
    """States by part; a part that is stored again replaces what it stored."""
    return KeyedTable(spark, path, STATE_SCHEMA, ["part", "feature_i", "feature_j"], one_row_per_batch=True)


def merged(states):
    """One state of several, per pair of columns. A group has a row per part."""
    def add(a, b):
        n = a["count"] + b["count"]
        i, j = b["mean_i"] - a["mean_i"], b["mean_j"] - a["mean_j"]
        share = b["count"] / n
        return F.struct(
            n.alias("count"), (a["mean_i"] + i * share).alias("mean_i"), (a["mean_j"] + j * share).alias("mean_j"),
            (a["comoment"] + b["comoment"] + i * j * a["count"] * share).alias("comoment"))

    part = F.struct("part", "count", "mean_i", "mean_j", "comoment")
    grouped = states.groupBy("feature_i", "feature_j").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("num_nonzeros").alias("num_nonzeros"), F.sum("norm_l1").alias("norm_l1"), F.sum("squares").alias("squares"))
    nothing = F.struct(*[F.lit(0).cast(t).alias(n) for n, t in (("count", "long"), ("mean_i", "double"), ("mean_j", "double"), ("comoment", "double"))])
    return grouped.select("*", F.aggregate("parts", nothing, add).alias("all")).select(
        "feature_i", "feature_j", "all.*", "min", "max", "num_nonzeros", "norm_l1", "squares")


def stats_of(state):
    """What `stats.column_stats` gives, from a merged state."""
    variance = F.when(F.col("count") > 1, F.col("comoment") / (F.col("count") - 1)).otherwise(F.lit(0.0))
    return state.where("feature_i = feature_j").select(
        F.col("feature_i").alias("feature"), "count", F.col("mean_i").alias("mean"), variance.alias("variance"), "min", "max",
        "num_nonzeros", "norm_l1", F.sqrt("squares").alias("norm_l2"))


def correlation_of(state):
    """What `stats.correlation` gives, from a merged state: one row per ordered pair, 1 on the diagonal, NaN for a constant."""
    own = state.where("feature_i = feature_j").select(F.col("feature_i").alias("feature"), F.col("comoment").alias("own"))
    pairs = state.select("feature_i", "feature_j", "comoment").unionByName(
        state.where("feature_i != feature_j").select(F.col("feature_j").alias("feature_i"), F.col("feature_i").alias("feature_j"), "comoment"))
    a, b = own.select(F.col("feature").alias("feature_i"), F.col("own").alias("own_i")), own.select(F.col("feature").alias("feature_j"), F.col("own").alias("own_j"))
    joined = pairs.join(a, "feature_i").join(b, "feature_j")
    product = F.sqrt(F.col("own_i")) * F.sqrt(F.col("own_j"))
    corr = F.when(F.col("feature_i") == F.col("feature_j"), F.lit(1.0)).when(product > 0, F.col("comoment") / product).otherwise(F.lit(float("nan")))
    return joined.select("feature_i", "feature_j", corr.alias("corr"))
