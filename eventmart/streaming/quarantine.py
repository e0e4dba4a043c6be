"""Malformed records of a stream: set aside, counted, and never in the way of the good ones."""

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.storagelevel import StorageLevel

from eventmart.functions.csv_text import EVENT_OUTCOME, REJECT_OUTCOME, parse_events_outcomes
from eventmart.schemas import COORDINATE_SCHEMA, COORDINATES, EVENT_COLUMNS
from eventmart.storage.upsert import KeyedTable

METRICS = "quarantine"
# Coordinates tell records apart; of records without any, equal lines count once.
REJECT_KEY = ["place"]
REJECT_SCHEMA = T.StructType([T.StructField("place", T.StringType()), T.StructField("value", T.StringType()), *COORDINATE_SCHEMA.fields])


def reject_table(spark, path):
    """Rejected lines, each under the place of its record, so that a replayed batch changes nothing."""
    return KeyedTable(spark, path, REJECT_SCHEMA, REJECT_KEY)


def outcomes(records):
    """Every record once, parsed, with its outcome, and the counts of both outcomes as observed metrics."""
    rows = parse_events_outcomes(records, "value", COORDINATES)
    return rows.observe(
        METRICS, F.count_if(F.col("outcome") == EVENT_OUTCOME).alias("accepted"), F.count_if(F.col("outcome") == REJECT_OUTCOME).alias("rejected"))


def split_sink(events, rejects):
    """A batch sink that sends events to one keyed table and rejected lines to another; the lines are parsed once."""
    def sink(rows, batch_id, owner):
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events.write(rows.where(F.col("outcome") == EVENT_OUTCOME).select(*EVENT_COLUMNS, *COORDINATES), batch_id, owner)
            bad = rows.where(F.col("outcome") == REJECT_OUTCOME)
            numbered = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
            place = F.when(F.col("offset").isNull(), F.sha2(F.coalesce("value", F.lit("")), 256)).otherwise(numbered)
            rejects.write(bad.select(place.alias("place"), "value", *COORDINATES), batch_id, owner)
        finally:
            rows.unpersist()
    return sink


class OutcomeCounts(StreamingQueryListener):
    """Accepted and rejected records of every batch of one query, from its observed metrics: {batch: (accepted, rejected)}.

    Add it to the session before the query starts; batches of other queries, which observe nothing, are passed over.
    """

    def __init__(self):
        self.batches = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(METRICS)
        if row is not None and event.progress.numInputRows:
            self.batches[event.progress.batchId] = (row["accepted"], row["rejected"])

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    @property
    def totals(self):
        return tuple(sum(b[i] for b in self.batches.values()) for i in (0, 1))
