import json
import os
import uuid

import pytest
from conftest import event, rows_of
from pyspark.errors import StreamingQueryException

from eventmart.functions.documents import event_documents
from eventmart.functions.wide_rows import decode_events, decode_marts
from eventmart.operators.mart import account_mart
from eventmart.schemas import DOCUMENT_SCHEMA, EVENT_COLUMNS, EVENT_FILE_SCHEMA
from eventmart.sources import streams
from eventmart.storage.compaction import CompactingTable
from eventmart.storage.layouts import create_file_table, drop_tables, from_file_layout
from eventmart.streaming import jobs

DAY = 86_400_000

# Four batches: a new and a known key each time, late events, an event sent again with another amount.
BATCHES = [
    [dict(account="a", kind="win", event_id="1"), dict(account="b", kind="login", event_id="2")],
    [dict(account="a", kind="buy", event_id="3", purchase=5.0, ts=1704067207179 - 50 * DAY),
     dict(account="c", kind="lose", event_id="4", payment="paypal")],
    [dict(account="a", kind="win", event_id="5", app="y"), dict(account="d", event_id="6", payment="debit")],
    [dict(account="a", kind="buy", event_id="3", purchase=7.5, ts=1704067207179 - 50 * DAY)],
]


class Topic:
    """A folder of key/value files, one per batch, oldest first."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.sent = spark, f"{folder}/topic", 0
        os.makedirs(self.path)

    def send(self, lines):
        staging = f"{self.path}-{self.sent}"
        self.spark.createDataFrame([("k", l) for l in lines], "key string, value string").coalesce(1).write.parquet(staging)
        part = [n for n in os.listdir(staging) if n.endswith(".parquet")][0]
        target = f"{self.path}/{self.sent:04}.parquet"
        os.rename(f"{staging}/{part}", target)
        os.utime(target, (1_700_000_000 + self.sent,) * 2)
        self.sent += 1

    def send_events(self, rows):
        self.send([",".join(map(str, event(**r))) for r in rows])

    def records(self):
        return streams.record_stream(self.spark, "folder", path=self.path, files_per_batch=1)


@pytest.fixture
def topic(spark, folder):
    return Topic(spark, folder)


@pytest.fixture
def full_topic(topic):
    for batch in BATCHES:
        topic.send_events(batch)
    return topic


def all_rows():
    return [r for batch in BATCHES for r in batch]


def last_versions():
    latest = {(r.get("account"), r.get("app"), r["event_id"]): r for r in all_rows()}
    return list(latest.values())


def test_keyed_job_equals_batch(spark, folder, full_topic, make_events):
    queries = jobs.run_keyed(full_topic.records(), f"{folder}/e", f"{folder}/m", f"{folder}/c", compact_every=2)
    jobs.finish(queries)
    assert [p.numInputRows for p in queries[1].recentProgress] == [2, 2, 2, 1]
    marts = jobs.mart_table(spark, f"{folder}/m").latest()
    assert rows_of(marts) == rows_of(account_mart(make_events(*all_rows())))
    events = jobs.event_table(spark, f"{folder}/e").latest().select(*EVENT_COLUMNS)
    assert rows_of(events) == rows_of(make_events(*last_versions()))
    assert jobs.mart_table(spark, f"{folder}/m").versions() == (1, [2, 3])


def test_a_second_checkpoint_adds_to_the_tables(spark, folder, topic, make_events):
    """Its batches are numbered from 0 again; nothing stored before is lost, whatever the kind of table."""
    topic.send_events([dict(account="a", event_id="1"), dict(account="b", event_id="2")])
    for checkpoint in ("c1", "c2"):
        jobs.finish(jobs.run_keyed(topic.records(), f"{folder}/e", f"{folder}/m", f"{folder}/{checkpoint}"))
        jobs.finish(jobs.run_files(topic.records(), f"{folder}/f", 1, f"{folder}/{checkpoint}"))
        if checkpoint == "c1":
            os.rename(f"{topic.path}/0000.parquet", f"{folder}/gone")
            topic.send_events([dict(account="a", event_id="1", purchase=3.0), dict(account="c", event_id="3")])
    events = jobs.event_table(spark, f"{folder}/e").latest()
    assert sorted((r.event_id, r.purchase) for r in events.collect()) == [("1", 3.0), ("2", 0.0), ("3", 0.0)]
    assert CompactingTable(spark, f"{folder}/f", EVENT_FILE_SCHEMA, 1).rows().count() == 4


def test_a_failing_query_stops_its_sister(folder, topic):
    topic.send(["a,x,1"])
    queries = jobs.run_keyed(topic.records(), f"{folder}/e", f"{folder}/m", f"{folder}/c", seconds=1)
    with pytest.raises(StreamingQueryException):
        jobs.finish(queries)
    assert not any(q.isActive for q in queries)


def test_state_partitions_are_an_argument(spark, folder, topic):
    topic.send_events([dict(account="a", event_id="1")])
    jobs.finish(jobs.run_marts(topic.records(), f"{folder}/m", f"{folder}/c", state_partitions=2))
    assert sorted(n for n in os.listdir(f"{folder}/c/marts/state/0") if n.isdigit()) == ["0", "1"]


def test_totals_continue_after_a_restart_and_idle_keys_stay(spark, folder, topic):
    def run():
        query = jobs.run_marts(topic.records(), f"{folder}/m", f"{folder}/c")
        jobs.finish(query)
        return {r.account_id: r.win_count for r in jobs.mart_table(spark, f"{folder}/m").latest().collect()}

    topic.send_events([dict(account="a", kind="win"), dict(account="b", kind="win")])
    assert run() == {"a": 1, "b": 1}
    topic.send_events([dict(account="a", kind="win", event_id="2"), dict(account="c", kind="win")])
    assert run() == {"a": 2, "b": 1, "c": 1}
    log = jobs.mart_table(spark, f"{folder}/m").rows(None, [1])
    assert {r.account_id for r in log.collect()} == {"a", "c"}  # only changed keys are written
    assert run() == {"a": 2, "b": 1, "c": 1}


def test_wide_job(spark, folder, full_topic, make_events):
    jobs.finish(jobs.run_wide(full_topic.records(), f"{folder}/e", f"{folder}/m", 6, f"{folder}/c"))
    marts = decode_marts(jobs.mart_wide_table(spark, f"{folder}/m").latest())
    assert rows_of(marts) == rows_of(account_mart(make_events(*all_rows())))
    events = decode_events(jobs.event_wide_table(spark, f"{folder}/e").latest())
    assert rows_of(events) == rows_of(make_events(*last_versions()))


def test_file_job(spark, folder, full_topic, make_events):
    jobs.finish(jobs.run_files(full_topic.records(), f"{folder}/f", 100_000, f"{folder}/c"))
    table = CompactingTable(spark, f"{folder}/f", EVENT_FILE_SCHEMA, 100_000)
    assert table.last_version() == 3 and table.pending().count() == len(all_rows())
    assert rows_of(from_file_layout(table.rows())) == rows_of(make_events(*all_rows()))


def test_file_job_feeds_an_external_table(spark, folder, full_topic, make_events):
    table = create_file_table(spark, "streamed_events", f"{folder}/f/table")
    try:
        jobs.finish(jobs.run_files(full_topic.records(), f"{folder}/f", 1, f"{folder}/c", table="streamed_events"))
        spark.catalog.refreshTable("streamed_events")
        assert rows_of(from_file_layout(spark.table("streamed_events"))) == rows_of(make_events(*all_rows()))
        assert table.columns == EVENT_FILE_SCHEMA.names
    finally:
        drop_tables(spark, "streamed_events")


def test_document_job_into_a_table(spark, folder, full_topic, make_events):
    jobs.finish(jobs.run_docs(full_topic.records(), f"{folder}/c", table_path=f"{folder}/d"))
    found = jobs.document_table(spark, f"{folder}/d").latest().select(*DOCUMENT_SCHEMA.names)
    assert rows_of(found) == rows_of(event_documents(make_events(*last_versions())))
    with pytest.raises(ValueError):
        jobs.run_docs(full_topic.records(), f"{folder}/c")


def test_document_job_to_an_index(folder, full_topic):
    target = f"{folder}/index"
    os.makedirs(target)

    def send(batch):
        with open(f"{target}/{uuid.uuid4().hex}", "w") as out:
            json.dump(batch, out)

    jobs.finish(jobs.run_docs(full_topic.records(), f"{folder}/c", send=send, batch_size=1))
    sent = [d for n in os.listdir(target) for d in json.load(open(f"{target}/{n}"))]
    assert sorted(d["id"] for d in sent) == sorted(f"{event(**r)[4]}:{r['event_id']}" for r in all_rows())


def test_malformed_record_stops_the_job(folder, topic):
    topic.send(["a,x,1"])
    with pytest.raises(StreamingQueryException, match="malformed line"):
        jobs.finish(jobs.run_marts(topic.records(), f"{folder}/m", f"{folder}/c"))


def test_continuous_trigger(spark, folder, full_topic):
    query = jobs.run_marts(full_topic.records(), f"{folder}/m", f"{folder}/c", seconds=1)
    try:
        query.processAllAvailable()
        assert query.isActive and jobs.mart_table(spark, f"{folder}/m").latest().count() == 5
    finally:
        query.stop()


def test_unknown_source_and_missing_kafka_package(spark):
    with pytest.raises(ValueError, match="unknown stream kind"):
        streams.record_stream(spark, "socket")
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.record_stream(spark, "kafka", brokers="b:1", topics="t")


def test_mart_state_has_no_watermark(full_topic):
    plan = account_mart(streams.event_stream(full_topic.records()))._jdf.queryExecution().analyzed().toString()
    assert "Watermark" not in plan
