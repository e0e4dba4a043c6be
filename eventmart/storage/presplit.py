"""Key-sorted tables split at given keys: each region is a folder, each of its files one range of keys.

The split points come from the caller, as for any table that is created pre-split, and a row goes straight to the
partition that its key belongs to; nothing is sampled to find regions. A region of more than `target_rows` rows is
split again, at keys from a sample of its own, so a hot salt is written by several tasks, each a range of keys.
"""

from bisect import bisect_right

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.wide_rows import SALT_WIDTH

TARGET_ROWS = 4_000_000
SAMPLED = 20          # keys for each split inside a region, as in Spark's own range partitioning
COMPARED = 64         # split points that are compared one by one in generated code


def salt_splits(num_salts, regions):
    """Split points that deal the salts out to contiguous regions; region 0 begins before all keys."""
    if not 1 <= regions <= num_salts:
        raise ValueError("regions must be between 1 and num_salts")
    return [str(r * (num_salts // regions)).zfill(SALT_WIDTH) for r in range(1, regions)]


def place_of(column, splits):
    """Number of the range that a key lies in: how many split points are not beyond it."""
    if len(splits) <= COMPARED:
        return sum(((F.col(column) >= s).cast("int") for s in splits), F.lit(0))
    return F.size(F.filter(F.array(*map(F.lit, splits)), lambda s: s <= F.col(column)))


def _finer(rows, splits, target_rows):
    """The split points with those inside regions of too many rows."""
    region = place_of("row_key", splits)
    sizes = {r["region"]: r["count"] for r in rows.groupBy(region.alias("region")).count().collect()}  # a row per region
    finer = list(splits)
    for number, size in sizes.items():
        parts = -(-size // target_rows)
        if parts > 1:
            keys = rows.where(region == number).select("row_key")
            # sampled by the digest of the key, so the same on every run
            share = max(1, size // (SAMPLED * parts))
            sample = sorted(r[0] for r in keys.where(F.pmod(F.xxhash64("row_key"), F.lit(share)) == 0).collect())
            finer += {sample[len(sample) * i // parts] for i in range(1, parts)} if sample else []
    return sorted(set(finer))


def write_presplit(rows, path, splits, target_rows=TARGET_ROWS, mode="overwrite"):
    """Write rows with unique `row_key`s under one folder per region, `region=N`, each file a sorted range of keys.

    Returns the split points in use. Snappy, with a bloom filter on the key.
    """
    if list(splits) != sorted(set(splits)):
        raise ValueError("split points must rise")
    points = _finer(rows, splits, target_rows)
    placed = rows.withColumn("region", place_of("row_key", splits))
    ordered = placed.repartitionById(len(points) + 1, place_of("row_key", points)).sortWithinPartitions("region", "row_key")
    (ordered.write.mode(mode).partitionBy("region").option("compression", "snappy")
        .option("parquet.bloom.filter.enabled#row_key", "true").parquet(path))
    return points


def read_presplit(spark, path, schema):
    """Rows and their region."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("region", T.IntegerType())])).parquet(path)


def key_range(rows, splits, low=None, high=None):
    """Rows with low <= row_key < high, from the folders of the regions that the range touches."""
    key, region = F.col("row_key"), F.col("region")
    if low is not None:
        rows = rows.where((key >= low) & (region >= bisect_right(splits, low)))
    if high is not None:
        rows = rows.where((key < high) & (region <= bisect_right(splits, high)))
    return rows
