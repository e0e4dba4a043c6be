"""Catalog tables: the Parquet event table, bucketed keyed tables, table copies."""

from pyspark.sql import functions as F

from eventmart.schemas import EVENT_COLUMNS, EVENT_FILE_COLUMNS, EVENT_FILE_SCHEMA


def to_file_layout(events):
    """Events in the file table's column order, with a TIMESTAMP."""
    stamped = events.withColumn("event_timestamp", F.timestamp_millis("event_timestamp"))
    return stamped.select(*EVENT_FILE_COLUMNS)


def from_file_layout(rows):
    """Rows of the file table as events."""
    return rows.withColumn("event_timestamp", F.unix_millis("event_timestamp")).select(*EVENT_COLUMNS)


def create_file_table(spark, table, location):
    """External Parquet event table over a folder."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_FILE_SCHEMA)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{location}'")
    return spark.table(table)


def table_schema(spark, table):
    """Schema of a catalog table; nothing is read."""
    return spark.table(table).schema


def write_keyed(rows, table, buckets=3, path=None, mode="overwrite"):
    """Table hashed into buckets by account, so that a lookup opens one bucket only.

    Tasks write their share of every bucket without a shuffle. Choose `buckets` by table size. A hot
    account makes its bucket large, so aggregates read the folder with `scan_unbucketed` and rely on
    partial aggregation; the bucketed read serves lookups and joins.
    """
    writer = rows.write.format("parquet").mode(mode).bucketBy(buckets, "account_id").sortBy("account_id")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return rows.sparkSession.table(table)


def scan_unbucketed(spark, table):
    """The files of a bucketed table as an ordinary scan, split by size rather than by bucket."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return spark.read.schema(table_schema(spark, table)).parquet(described.first()["data_type"])


def copy_table(spark, source, target, path=None):
    """CREATE TABLE AS SELECT into Parquet; `source` is a table or view name."""
    location = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {target} USING parquet {location} AS SELECT * FROM {source}")
    return spark.table(target)


def drop_tables(spark, *tables):
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
