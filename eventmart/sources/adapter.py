"""App events derived from the test tables' `events`; every row becomes one event."""

from pyspark.sql import functions as F

from eventmart.functions.csv_text import event_line
from eventmart.functions.instants import utc_date
from eventmart.schemas import BUY, CREDIT, DEBIT, LOGIN, LOGOUT, LOSE, PAYPAL, WIN

# `ts` is declared TIMESTAMP so that its wall clock is read as UTC in every session time zone.
RAW_SCHEMA = "event_id LONG, ts TIMESTAMP, user_id LONG, event_type STRING, value DOUBLE, props STRING"


def app_events(spark, sf_dir, account_id=None, start=None, end=None):
    """The event table. An account or time range [start, end] given here prunes the raw scan as well."""
    raw = spark.read.schema(RAW_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    if account_id is not None:
        raw = raw.where(F.col("user_id") == int(account_id))
    if start is not None:
        raw = raw.where(F.col("ts") >= F.timestamp_millis(F.lit(start)))
    if end is not None:
        raw = raw.where(F.col("ts") < F.timestamp_millis(F.lit(end + 1)))
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    turn = F.pmod(F.col("event_id"), F.lit(3))
    stamped = raw.withColumn("event_timestamp", F.unix_millis("ts"))
    return stamped.select(
        user.alias("account_id"),
        (F.get_json_object("props", "$.k").cast("int") % 12).cast("string").alias("app_id"),
        "event_timestamp",
        F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == "purchase", BUY).when(kind == "signup", LOGIN).when(kind == "click", WIN)
        .when(kind == "error", LOSE).otherwise(LOGOUT).alias("event_type"),
        F.when(kind == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("purchase"),
        F.when(turn == 0, CREDIT).when(turn == 1, DEBIT).otherwise(PAYPAL).alias("payment_type"),
        F.concat_ws("-", user, utc_date("event_timestamp").cast("string")).alias("session_id"),
        (F.lit(37.0) + F.pmod(F.col("event_id"), F.lit(1000)) / F.lit(1000.0)).alias("latitude"),
        (F.lit(-122.0) - F.pmod(F.col("user_id"), F.lit(1000)) / F.lit(1000.0)).alias("longitude"),
    )


def document_lines(spark, sf_dir):
    """All lines of all documents as `value`."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return documents.select(F.explode(F.split("text", "\r\n|\n|\r")).alias("value"))


def stage_lines(lines, path, batches=4):
    """Write lines (`value`) as records without a key, with coordinates, in files for about `batches` micro-batches; the
    number of files per micro-batch. Records are numbered within the partition that wrote them."""
    placed = lines.select("value", F.monotonically_increasing_id().alias("place"))
    records = placed.select(
        F.lit(None).cast("string").alias("key"), "value", F.timestamp_millis(F.lit(0)).alias("timestamp"), F.lit("lines").alias("topic"),
        F.shiftright("place", 33).cast("int").alias("partition"), F.col("place").bitwiseAND((1 << 33) - 1).alias("offset"))
    records.write.parquet(path)
    return max(1, -(-len(lines.sparkSession.read.parquet(path).inputFiles()) // batches))


def stage_topic(spark, sf_dir, path, batches=4, repeats=False):
    """Write the events as key/value CSV records with coordinates, in enough files for about `batches` micro-batches.

    With `repeats` every purchase is sent a second time, one cent higher and at a later offset of its topic, in the
    same file. Returns the number of files per micro-batch. Nothing is shuffled: a task cuts its own output.
    """
    events = app_events(spark, sf_dir).withColumn("later", F.lit(0))
    if repeats:
        again = F.when(F.col("event_type") == BUY, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        events = events.withColumn("later", F.explode(again))
        events = events.withColumn("purchase", F.col("purchase") + F.col("later"))
    count = events.count()
    records = events.select(
        F.col("account_id").alias("key"), event_line().alias("value"), F.timestamp_millis("event_timestamp").alias("timestamp"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"),
        (F.col("event_id").cast("long") * 2 + F.col("later")).alias("offset"))
    per_file = max(1, -(-count // batches))
    records.write.option("maxRecordsPerFile", per_file).parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return max(1, -(-files // batches))
