"""Key/value records for a topic, and writing them to Kafka."""

from pyspark.sql import functions as F

from eventmart.functions.csv_text import event_line
from eventmart.functions.hashing import java_string_hash_text

# Header prefix and shortest line that is published.
HEADER_PREFIX = "vendor_name"
SHORTEST_LINE = 10


def line_records(lines, column="value"):
    """Lines of text as records keyed by their hash; headers and lines under ten characters are left out.

    Length is counted in UTF-16 units, so a character above the basic plane counts twice; only lines
    whose code points leave the answer open are looked at that closely.
    """
    line, points = F.col(column), F.length(column)
    units = points + F.length(F.regexp_replace(line, r"[\x{0}-\x{FFFF}]", ""))
    long_enough = (
        F.when(points >= SHORTEST_LINE, True)
        .when(points * 2 < SHORTEST_LINE, False)
        .otherwise(units >= SHORTEST_LINE)
    )
    kept = lines.where(~line.startswith(HEADER_PREFIX) & long_enough)
    return kept.select(java_string_hash_text(line).cast("string").alias("key"), line.alias("value"))


def event_records(events):
    """Events as records keyed by account, with the CSV line as value."""
    return events.select(F.col("account_id").alias("key"), event_line().alias("value"))


def producer_options(brokers, topic, acks=1, retries=3, linger_ms=None, batch_size=None):
    """Writer options of the Kafka sink."""
    options = {
        "kafka.bootstrap.servers": brokers, "topic": topic,
        "kafka.acks": str(acks), "kafka.retries": str(retries),
    }
    if linger_ms is not None:
        options["kafka.linger.ms"] = str(linger_ms)
    if batch_size is not None:
        options["kafka.batch.size"] = str(batch_size)
    return options


def publish(records, **options):
    """Send key/value records to Kafka with `producer_options` settings."""
    records.select("key", "value").write.format("kafka").options(**producer_options(**options)).save()
