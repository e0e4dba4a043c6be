"""Running marts with state of our own, and the state of any mart job as a table.

The processor keeps one value per account and app. It can start from a stored mart, and it can send every key with every
batch, also those without new events: a timer per key, due at once, makes each batch visit all keys. Events are added up
to one row per key and Arrow batch before the shuffle, so a hot key costs a task one row per 10,000 events.
"""

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from eventmart.operators.mart import event_deltas
from eventmart.schemas import MART_COLUMNS, MART_KEY, MART_MEASURES, MART_SCHEMA

KEYS = T.StructType([MART_SCHEMA[k] for k in MART_KEY])
TOTALS = T.StructType([MART_SCHEMA[m] for m in MART_MEASURES])


class RunningMart(StatefulProcessor):
    """Adds mart rows to the totals of their key."""

    def __init__(self, every_key):
        self.every_key = every_key

    def init(self, handle):
        self._handle = handle
        self._totals = handle.getValueState("totals", TOTALS)

    def handleInitialState(self, key, initialState, timerValues):
        self._totals.update(tuple(initialState[m] for m in MART_MEASURES))
        self._visit_next(timerValues)  # a new key: only this batch's timer can be there, and it is the same

    def handleInputRows(self, key, rows, timerValues):
        totals = list(self._totals.get()) if self._totals.exists() else [0] * len(MART_MEASURES)
        for row in rows:
            totals = [a + row[m] for a, m in zip(totals, MART_MEASURES)]
        self._totals.update(tuple(totals))
        self._visit_again(timerValues)
        yield _mart(key, totals)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._visit_next(timerValues)  # the key's one timer is the expired one, which Spark deletes after this
        yield _mart(key, self._totals.get())

    def _visit_again(self, timerValues):
        """Replace a timer of an earlier batch, due now, so that a key with input is sent once a batch."""
        if self.every_key:
            for due in self._handle.listTimers():
                self._handle.deleteTimer(due)
        self._visit_next(timerValues)

    def _visit_next(self, timerValues):
        """One state call: a key without input costs its batch this, its totals and Spark's own calls."""
        if self.every_key:
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1)

    def close(self):
        pass


def _mart(key, totals):
    return Row(*MART_COLUMNS)(*key, *totals)


def _added_up(batches):
    """One mart row per key of each Arrow batch."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(MART_KEY).aggregate([(m, "sum") for m in MART_MEASURES])
        yield from table.select([*MART_KEY, *[f"{m}_sum" for m in MART_MEASURES]]).rename_columns(MART_COLUMNS).to_batches()


def running_mart(events, seed=None, every_key=True):
    """The running mart of a stream of events; with `seed`, a mart that it starts from."""
    spark = events.sparkSession
    rows = event_deltas(events).mapInArrow(_added_up, MART_SCHEMA)
    start = spark.createDataFrame([], MART_SCHEMA) if seed is None else seed.select(*MART_COLUMNS)
    return rows.groupBy(*MART_KEY).transformWithState(
        RunningMart(every_key), MART_SCHEMA, "Update", "ProcessingTime" if every_key else "None", initialState=start.groupBy(*MART_KEY))


def _renamed(column, schema):
    """A struct with its fields renamed by place; the fields of a sum are all named alike."""
    return F.col(column).cast(schema)


def state_marts(spark, checkpoint):
    """The marts that a mart job with aggregated totals holds in its state, as of its last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    named = state.select(_renamed("key", KEYS).alias("key"), _renamed("value", TOTALS).alias("value"))
    return named.select("key.*", "value.*")


def seeded_state_marts(spark, checkpoint):
    """The same of a job that keeps its own state."""
    state = spark.read.format("statestore").option("stateVarName", "totals").load(checkpoint)
    return state.select(_renamed("key", KEYS).alias("key"), "value").select("key.*", "value.*")
