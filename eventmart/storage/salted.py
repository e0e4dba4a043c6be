"""Salted, key-sorted wide-row tables on Parquet."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.wide_rows import SALT_WIDTH
from eventmart.operators.lookups import region_of
from eventmart.storage.upsert import latest_per_key


def with_salt(rows, num_salts, regions):
    """Add the salt text and the region number of each row key."""
    return rows.withColumns({
        "salt": F.substring("row_key", 1, SALT_WIDTH),
        "region": region_of("row_key", num_salts, regions),
    })


def salt_region_counts(rows, num_salts, regions):
    """Rows per salt and region."""
    return with_salt(rows, num_salts, regions).groupBy("salt", "region").agg(F.count("*").alias("rows"))


def write_salted(rows, path, num_salts, regions, order=(), unique=False, mode="overwrite"):
    """Write row keys and cells sorted by key under one folder per salt.

    As in any keyed store a key keeps one row, the last by the `order` columns: copies are folded
    first, unless `unique` says there are none. Range partitioning then spreads even a hot account, since its keys differ in time and
    id. Snappy, with a bloom filter on the key.
    """
    if not unique:
        rows = latest_per_key(rows, ["row_key"], list(order))
    salted = with_salt(rows.drop(*order), num_salts, regions)
    ordered = salted.repartitionByRange("salt", "row_key").sortWithinPartitions("salt", "row_key")
    (ordered.write.mode(mode).partitionBy("salt")
        .option("compression", "snappy")
        .option("parquet.bloom.filter.enabled#row_key", "true")
        .parquet(path))


def read_salted(spark, path, schema):
    """Read a salted table; salts stay text, so `0002` keeps its zeros and prunes folders."""
    full = T.StructType([
        *schema.fields, T.StructField("region", T.IntegerType()), T.StructField("salt", T.StringType()),
    ])
    return spark.read.schema(full).parquet(path)
