"""Streaming readers: a Kafka topic, or a folder of key/value records that stands in for one."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.csv_text import parse_events
from eventmart.schemas import COORDINATE_SCHEMA, COORDINATES, TOPIC_SCHEMA


def kafka_records(spark, brokers, topics, starting_offsets="latest", **options):
    """Records of a comma-separated list of topics, with their coordinates."""
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )
    return source.select(F.col("key").cast("string"), F.col("value").cast("string"), *COORDINATES)


def folder_records(spark, path, files_per_batch=None):
    """Key/value Parquet files in a folder, new files being new records. Coordinates are null where the files
    have none."""
    fields = [T.StructField(c, COORDINATE_SCHEMA[c].dataType) for c in COORDINATES]
    reader = spark.readStream.schema(T.StructType([*TOPIC_SCHEMA.fields, *fields]))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def record_stream(spark, kind, **options):
    """`kind` is kafka or folder; the options are those of the reader."""
    readers = {"kafka": kafka_records, "folder": folder_records}
    if kind not in readers:
        raise ValueError(f"unknown stream kind {kind!r}; use one of {sorted(readers)}")
    return readers[kind](spark, **options)


def event_stream(records, coordinates=False):
    """Events of a record stream, parsed from the value; malformed records fail the batch."""
    return parse_events(records, "value", COORDINATES if coordinates else [])
