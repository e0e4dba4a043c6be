"""The ingestion jobs. Each takes a record stream (key, value, coordinates) and starts its queries.

Marts are running totals that never expire: there is no watermark, so an event arrives late at no
cost but its state. Totals survive a restart through the checkpoint, and every sink is keyed by
batch or by record, so that a replayed batch changes nothing. Tables know batches by the query's id in its
checkpoint as well as by number, so a new checkpoint over an old table adds to it.

`seconds` None works off what is there and stops. `state_partitions` is the number of state partitions of a new
query, which it keeps for good; None leaves it to `spark.sql.shuffle.partitions`. Compaction is a job of its own
(`KeyedTable.compact_finished`) beside a running stream; `compact_every` does it inside the stream instead.
"""

import json
import time

from pyspark.sql import types as T

from eventmart.functions.documents import event_documents
from eventmart.functions.wide_rows import encode_events, encode_marts
from eventmart.operators.mart import account_mart
from eventmart.schemas import (
    COORDINATE_SCHEMA, COORDINATES, DOCUMENT_SCHEMA, EVENT_FILE_SCHEMA, EVENT_KEY, EVENT_SCHEMA, EVENT_WIDE_SCHEMA, MART_KEY, MART_SCHEMA,
    MART_WIDE_SCHEMA,
)
from eventmart.session import STATE_STORE, session_conf
from eventmart.sources.streams import event_stream
from eventmart.storage.compaction import CompactingTable
from eventmart.storage.documents import index_documents
from eventmart.storage.files import Files
from eventmart.storage.layouts import table_schema, to_file_layout
from eventmart.storage.index_sink import register_index
from eventmart.storage.upsert import KeyedTable
from eventmart.streaming.quarantine import outcomes, reject_table, split_sink
from eventmart.streaming.state import running_mart

PARTITIONS = "spark.sql.shuffle.partitions"


def _placed(schema):
    return T.StructType([*schema.fields, *COORDINATE_SCHEMA.fields])


def event_table(spark, path):
    """Keyed event table; later batches win, within a batch the later record: by broker time, then topic, partition and offset."""
    return KeyedTable(spark, path, _placed(EVENT_SCHEMA), EVENT_KEY, COORDINATES)


def mart_table(spark, path):
    """Keyed mart table of absolute totals."""
    return KeyedTable(spark, path, MART_SCHEMA, MART_KEY, one_row_per_batch=True)


def event_wide_table(spark, path):
    return KeyedTable(spark, path, _placed(EVENT_WIDE_SCHEMA), ["row_key"], COORDINATES)


def mart_wide_table(spark, path):
    return KeyedTable(spark, path, MART_WIDE_SCHEMA, ["row_key"])


def document_table(spark, path):
    """Documents keyed by id."""
    return KeyedTable(spark, path, _placed(DOCUMENT_SCHEMA), ["id"], COORDINATES)


def _into(table, compact_every):
    def sink(rows, batch_id, owner):
        table.write(rows, batch_id, owner)
        if compact_every and batch_id and batch_id % compact_every == 0:
            table.compact_finished()  # the current batch may still be replayed
    return sink


def query_id(spark, checkpoint):
    """The id that a checkpoint gives its query for good."""
    return json.loads(Files(spark, checkpoint).read_text(f"{checkpoint}/metadata"))["id"]


def _start(rows, sink, checkpoint, seconds, mode, state_partitions=None):
    spark = rows.sparkSession
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    settings = {**STATE_STORE, **({PARTITIONS: str(state_partitions)} if state_partitions else {})}
    with session_conf(spark, settings):
        return writer.foreachBatch(lambda batch, n: sink(batch, n, query_id(spark, checkpoint))).trigger(**trigger).start()


def run_keyed(records, events_path, marts_path, checkpoint, seconds=None, compact_every=0, state_partitions=None):
    """Events and running marts into keyed tables: two queries over one source."""
    spark = records.sparkSession
    events = event_stream(records, coordinates=True)
    marts = account_mart(event_stream(records))
    return [
        _start(events, _into(event_table(spark, events_path), compact_every),
               f"{checkpoint}/events", seconds, "append"),
        _start(marts, _into(mart_table(spark, marts_path), compact_every),
               f"{checkpoint}/marts", seconds, "update", state_partitions),
    ]


def run_marts(records, marts_path, checkpoint, seconds=None, compact_every=0, state_partitions=None):
    """Only the running marts."""
    marts = account_mart(event_stream(records))
    sink = _into(mart_table(records.sparkSession, marts_path), compact_every)
    return _start(marts, sink, f"{checkpoint}/marts", seconds, "update", state_partitions)


def run_seeded_marts(records, marts_path, checkpoint, seed=None, every_key=True, seconds=None, compact_every=0, state_partitions=None):
    """Running marts that start from the totals of a stored mart, where `seed` is given with the first start.

    With `every_key` each batch stores all keys, changed or not, so the last batch alone is the whole mart; such a query
    has something to do as long as it runs, and `finish_idle` ends a bounded one.
    """
    marts = running_mart(event_stream(records), seed, every_key)
    sink = _into(mart_table(records.sparkSession, marts_path), compact_every)
    return _start(marts, sink, f"{checkpoint}/seeded", seconds, "update", state_partitions)


def run_quarantined(records, events_path, rejects_path, checkpoint, seconds=None):
    """Events into a keyed table and malformed records into another, parsed once; no record stops the job.

    `quarantine.OutcomeCounts` listens to how many of each a batch had.
    """
    spark = records.sparkSession
    sink = split_sink(event_table(spark, events_path), reject_table(spark, rejects_path))
    return _start(outcomes(records), sink, f"{checkpoint}/quarantined", seconds, "append")


def run_wide(records, events_path, marts_path, num_salts, checkpoint, seconds=None, compact_every=0, state_partitions=None):
    """Events and running marts as salted wide rows, in two tables."""
    spark = records.sparkSession
    events = encode_events(event_stream(records, coordinates=True), num_salts, COORDINATES)
    marts = encode_marts(account_mart(event_stream(records)), num_salts)
    return [
        _start(events, _into(event_wide_table(spark, events_path), compact_every),
               f"{checkpoint}/events", seconds, "append"),
        _start(marts, _into(mart_wide_table(spark, marts_path), compact_every),
               f"{checkpoint}/marts", seconds, "update", state_partitions),
    ]


def run_files(records, path, min_file_size, checkpoint, seconds=None, table=None):
    """Events into Parquet files of a minimum size, in the file table's layout.

    `path/table` is the folder for an external table. The columns are those of `table` where a catalog
    table is named, otherwise those of the standard event table.
    """
    spark = records.sparkSession
    schema = table_schema(spark, table) if table else EVENT_FILE_SCHEMA
    sink = CompactingTable(spark, path, schema, min_file_size)
    rows = to_file_layout(event_stream(records)).select(*schema.names)
    return _start(rows, sink.add, f"{checkpoint}/files", seconds, "append")


def run_docs(records, checkpoint, send=None, table_path=None, batch_size=100, retry_wait=2.0, seconds=None,
             compact_every=0):
    """Events as search documents, to an index through `send` or into a table keyed by id."""
    if (send is None) == (table_path is None):
        raise ValueError("give either send or table_path")
    if send is not None:
        documents = event_documents(event_stream(records))

        def sink(rows, batch_id, owner):
            index_documents(rows, send, batch_size, retry_wait=retry_wait)
    else:
        events = event_stream(records, coordinates=True)
        documents = event_documents(events, COORDINATES)
        sink = _into(document_table(records.sparkSession, table_path), compact_every)
    return _start(documents, sink, f"{checkpoint}/docs", seconds, "append")


def run_index(records, checkpoint, index, seconds=None, **rules):
    """Events as search documents into an index that commits every batch (`storage.index_sink`)."""
    documents = event_documents(event_stream(records))
    name = register_index(records.sparkSession, index, **rules)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    writer = documents.writeStream.format(name).outputMode("append").option("checkpointLocation", f"{checkpoint}/index")
    return writer.trigger(**trigger).start()


def finish_idle(query, timeout=None):
    """End a query whose timers never rest, after the first batch without input."""
    deadline = None if timeout is None else time.monotonic() + timeout
    while not query.awaitTermination(0.2):
        progress = query.lastProgress
        if progress is not None and progress.batchId > 0 and progress.numInputRows == 0:
            query.stop()
        elif deadline is not None and time.monotonic() > deadline:
            query.stop()
            raise TimeoutError(f"query {query.id} did not finish within {timeout} seconds")


def finish(queries, timeout=None):
    """Wait for bounded queries, however long they take. When one fails, or after `timeout` seconds where that is
    given, all queries of the job are stopped and the error is raised.
    """
    queries = queries if isinstance(queries, list) else [queries]
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        running = list(queries)
        while running:
            running = [q for q in running if not q.awaitTermination(1)]
            if running and deadline is not None and time.monotonic() > deadline:
                raise TimeoutError(f"query {running[0].id} did not finish within {timeout} seconds")
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
