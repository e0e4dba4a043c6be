"""Bounded runs of the streaming jobs: the events as a record stream, in several micro-batches."""

import uuid

from pyspark.sql import functions as F

from eventmart.functions.csv_text import event_line
from eventmart.operators import sums
from eventmart.operators.mart import account_mart
from eventmart.plans import oracle
from eventmart.plans.batch import DOCUMENTS_SQL, LINES, NUM_SALTS, OUTCOMES_SQL, WINS, cents, mixed_lines
from eventmart.plans.registry import query
from eventmart.schemas import DOCUMENT_SCHEMA, EVENT_FILE_SCHEMA
from eventmart.session import work_dir
from eventmart.sources.adapter import app_events, stage_lines, stage_topic
from eventmart.sources.open import open_events, open_marts
from eventmart.sources.streams import record_stream
from eventmart.storage.compaction import CompactingTable
from eventmart.storage.files import Files
from eventmart.storage.index_sink import FolderIndex, indexed
from eventmart.storage.layouts import create_file_table, from_file_layout
from eventmart.streaming import jobs, quarantine, state


def _records(spark, sf_dir, work, repeats=False):
    files = stage_topic(spark, sf_dir, f"{work}/topic", repeats=repeats)
    return record_stream(spark, "folder", path=f"{work}/topic", files_per_batch=files)


@query("stream_account_mart", oracle.with_marts("SELECT * FROM mart"))
def stream_account_mart(spark, sf_dir):
    work = work_dir(spark, "stream-mart")
    jobs.finish(jobs.run_marts(_records(spark, sf_dir, work), f"{work}/marts", f"{work}/checkpoint"))
    return cents(jobs.mart_table(spark, f"{work}/marts").latest())


@query("stream_timed_marts", oracle.with_marts("SELECT * FROM mart"))
def stream_timed_marts(spark, sf_dir):
    """The same job on its interval: a micro-batch a second until the records are worked off."""
    work = work_dir(spark, "stream-timed")
    running = jobs.run_marts(_records(spark, sf_dir, work), f"{work}/marts", f"{work}/checkpoint", seconds=1)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return cents(jobs.mart_table(spark, f"{work}/marts").latest())


CORRECTED = """SELECT * REPLACE (CASE WHEN event_type = 'buy' THEN purchase + 1 ELSE purchase END AS purchase)
    FROM app_event"""


def _keyed(spark, sf_dir, repeats):
    work = work_dir(spark, "stream-keyed")
    jobs.finish(jobs.run_keyed(
        _records(spark, sf_dir, work, repeats), f"{work}/events", f"{work}/marts", f"{work}/checkpoint"))
    return work


@query("stream_event_upsert", oracle.with_events(CORRECTED))
def stream_event_upsert(spark, sf_dir):
    """Every purchase arrives twice in one batch; the later offset wins."""
    return open_events(spark, f"{_keyed(spark, sf_dir, True)}/events")


@query("stream_keyed_marts", oracle.with_marts("SELECT * FROM mart"))
def stream_keyed_marts(spark, sf_dir):
    return cents(open_marts(spark, f"{_keyed(spark, sf_dir, False)}/marts"))


@query("stream_then_wins", oracle.with_marts(WINS))
def stream_then_wins(spark, sf_dir):
    """The sums job over the table that the stream has written, in which a mart has several versions."""
    return sums.wins_per_account(open_marts(spark, f"{_keyed(spark, sf_dir, False)}/marts"))


@query("stream_restarted_table", oracle.with_events(CORRECTED))
def stream_restarted_table(spark, sf_dir):
    """A second checkpoint, whose batches count from 0 again, sends corrections into the same table."""
    work = work_dir(spark, "stream-restarted")
    for n, repeats in enumerate((False, True)):
        records = _records(spark, sf_dir, f"{work}/{n}", repeats)
        jobs.finish(jobs.run_keyed(records, f"{work}/events", f"{work}/marts", f"{work}/{n}/checkpoint"))
    return open_events(spark, f"{work}/events")


def _half(staged, half):
    return staged.where(F.pmod(F.col("offset") / 2, F.lit(2)) == half)


def _resumed(spark, sf_dir):
    """The work folder of a mart job that ended after half of the records and went on with the rest."""
    work = work_dir(spark, "stream-resumed")
    stage_topic(spark, sf_dir, f"{work}/all")
    staged = spark.read.parquet(f"{work}/all")
    for half in (0, 1):
        _half(staged, half).write.mode("append").parquet(f"{work}/topic")
        records = record_stream(spark, "folder", path=f"{work}/topic")
        jobs.finish(jobs.run_marts(records, f"{work}/marts", f"{work}/checkpoint"))
    return work


@query("stream_resumed_marts", oracle.with_marts("SELECT * FROM mart"))
def stream_resumed_marts(spark, sf_dir):
    """The stream ends after half of the records and goes on from its checkpoint with the rest."""
    return cents(open_marts(spark, f"{_resumed(spark, sf_dir)}/marts"))


@query("stream_state_marts", oracle.with_marts("SELECT *, true AS in_sink FROM mart"))
def stream_state_marts(spark, sf_dir):
    """What the state of the resumed job holds, and whether its sink holds the same."""
    work = _resumed(spark, sf_dir)
    held = cents(state.state_marts(spark, f"{work}/checkpoint/marts"))
    stored = cents(open_marts(spark, f"{work}/marts"))
    same = stored.withColumn("in_sink", F.lit(True))
    return held.join(same, held.columns, "left").select(*held.columns, F.coalesce("in_sink", F.lit(False)).alias("in_sink"))


@query("stream_seeded_marts", oracle.with_marts("SELECT * FROM mart"))
def stream_seeded_marts(spark, sf_dir):
    """A stored mart of half of the events, taken on by a stream of the other half that sends every key each batch."""
    work = work_dir(spark, "stream-seeded")
    before = app_events(spark, sf_dir).where(F.pmod(F.col("event_id").cast("long"), F.lit(2)) == 0)
    jobs.mart_table(spark, f"{work}/before").write(account_mart(before), 0)
    stage_topic(spark, sf_dir, f"{work}/all")
    _half(spark.read.parquet(f"{work}/all"), 1).write.parquet(f"{work}/topic")
    records = record_stream(spark, "folder", path=f"{work}/topic")
    seed = open_marts(spark, f"{work}/before")
    jobs.finish_idle(jobs.run_seeded_marts(records, f"{work}/marts", f"{work}/checkpoint", seed))
    return cents(open_marts(spark, f"{work}/marts"))


@query("stream_csv_quarantine", oracle.with_events(OUTCOMES_SQL + " WHERE value IS NOT NULL", LINES))
def stream_csv_quarantine(spark, sf_dir):
    """The lines of `event_csv_quarantine` as records: what reached the two tables, each record once."""
    work = work_dir(spark, "stream-quarantine")
    files = stage_lines(mixed_lines(spark, sf_dir), f"{work}/topic")
    records = record_stream(spark, "folder", path=f"{work}/topic", files_per_batch=files)
    jobs.finish(jobs.run_quarantined(records, f"{work}/events", f"{work}/rejects", f"{work}/checkpoint"))
    lines = jobs.event_table(spark, f"{work}/events").latest().select(event_line().alias("value"), F.lit("event").alias("outcome"))
    return lines.unionByName(quarantine.reject_table(spark, f"{work}/rejects").latest().select("value", F.lit("reject").alias("outcome")))


@query("stream_indexed_documents", oracle.with_events(DOCUMENTS_SQL))
def stream_indexed_documents(spark, sf_dir):
    """The documents that the commits of an index have published."""
    work = work_dir(spark, "stream-index")
    jobs.finish(jobs.run_index(_records(spark, sf_dir, work), f"{work}/checkpoint", FolderIndex(f"{work}/index")))
    return indexed(spark, f"{work}/index", DOCUMENT_SCHEMA)


def _wide(spark, sf_dir, repeats):
    work = work_dir(spark, "stream-wide")
    jobs.finish(jobs.run_wide(
        _records(spark, sf_dir, work, repeats), f"{work}/events", f"{work}/marts", NUM_SALTS, f"{work}/checkpoint"))
    return work


@query("stream_wide_marts", oracle.with_marts("SELECT * FROM mart"))
def stream_wide_marts(spark, sf_dir):
    return cents(open_marts(spark, f"{_wide(spark, sf_dir, False)}/marts"))


@query("stream_wide_events", oracle.with_events(CORRECTED))
def stream_wide_events(spark, sf_dir):
    return open_events(spark, f"{_wide(spark, sf_dir, True)}/events")


@query("stream_search_docs", oracle.with_events(DOCUMENTS_SQL))
def stream_search_docs(spark, sf_dir):
    work = work_dir(spark, "stream-docs")
    jobs.finish(jobs.run_docs(
        _records(spark, sf_dir, work), f"{work}/checkpoint", table_path=f"{work}/documents"))
    return jobs.document_table(spark, f"{work}/documents").latest().select(*DOCUMENT_SCHEMA.names)


def _files(spark, sf_dir):
    """The file job with a minimum that some of its files reach, from the size of the staged records."""
    work = work_dir(spark, "stream-files")
    records = _records(spark, sf_dir, work)
    size = max(1, Files(spark, work).size(f"{work}/topic") // 6)
    jobs.finish(jobs.run_files(records, f"{work}/files", size, f"{work}/checkpoint"))
    return CompactingTable(spark, f"{work}/files", EVENT_FILE_SCHEMA, size)


@query("stream_event_files", oracle.with_events("SELECT * FROM app_event"))
def stream_event_files(spark, sf_dir):
    return open_events(spark, _files(spark, sf_dir).path)


@query("stream_files_external_table", oracle.with_events("SELECT * FROM app_event"))
def stream_files_external_table(spark, sf_dir):
    """The external table over the published files, after a flush."""
    table = _files(spark, sf_dir)
    table.flush()
    return from_file_layout(create_file_table(spark, f"event_files_{uuid.uuid4().hex}", table.table))
