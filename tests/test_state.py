"""State of our own, state read as a table, quarantine in a stream, and the committing index."""

import json
import os
import time

import pytest
from conftest import event, rows_of
from pyspark.sql import functions as F
from test_streaming import BATCHES, Topic, all_rows, last_versions

from eventmart.functions.documents import event_documents
from eventmart.operators.mart import account_mart, merge_marts
from eventmart.schemas import DOCUMENT_SCHEMA, EVENT_COLUMNS, MART_COLUMNS
from eventmart.storage import index_sink
from eventmart.streaming import jobs, quarantine, state


@pytest.fixture
def topic(spark, folder):
    return Topic(spark, folder)


@pytest.fixture
def full_topic(topic):
    for batch in BATCHES:
        topic.send_events(batch)
    return topic


def versions(spark, path):
    """The rows that each batch stored."""
    table = jobs.mart_table(spark, path)
    return [rows_of(table.rows(None, [run]).select(*MART_COLUMNS)) for run in table.versions()[1]]


def test_every_key_comes_with_every_batch(spark, folder, full_topic, make_events):
    jobs.finish_idle(jobs.run_seeded_marts(full_topic.records(), f"{folder}/m", f"{folder}/c"), timeout=120)
    stored = versions(spark, f"{folder}/m")
    seen = []
    for n, batch in enumerate(BATCHES):
        seen += batch
        assert stored[n] == rows_of(account_mart(make_events(*seen)))
    assert stored[len(BATCHES)] == stored[len(BATCHES) - 1]


def test_a_seed_is_where_totals_start(spark, folder, full_topic, make_events):
    seed = account_mart(make_events(dict(account="a", kind="win", event_id="9"), dict(account="old", kind="buy", purchase=2.0, event_id="8")))
    jobs.finish_idle(jobs.run_seeded_marts(full_topic.records(), f"{folder}/m", f"{folder}/c", seed), timeout=120)
    want = rows_of(merge_marts(seed, account_mart(make_events(*all_rows()))))
    assert rows_of(jobs.mart_table(spark, f"{folder}/m").latest()) == want
    assert rows_of(state.seeded_state_marts(spark, f"{folder}/c/seeded")) == want


def test_changed_keys_only_and_totals_after_a_restart(spark, folder, topic, make_events):
    for n, batch in enumerate(BATCHES):
        topic.send_events(batch)
        jobs.finish(jobs.run_seeded_marts(topic.records(), f"{folder}/m", f"{folder}/c", every_key=False))
        assert len(versions(spark, f"{folder}/m")[n]) == len({(r.get("account"), r.get("app")) for r in batch})
    assert rows_of(jobs.mart_table(spark, f"{folder}/m").latest()) == rows_of(account_mart(make_events(*all_rows())))


def test_state_equals_sink(spark, folder, full_topic):
    jobs.finish(jobs.run_marts(full_topic.records(), f"{folder}/m", f"{folder}/c"))
    assert rows_of(state.state_marts(spark, f"{folder}/c/marts")) == rows_of(jobs.mart_table(spark, f"{folder}/m").latest())


def test_bad_records_are_set_aside_and_counted(spark, folder, topic, make_events):
    bad = ["a,x,1", "", "a,x,no,1,win,0.0,credit,s,1.0,2.0"]
    for n, batch in enumerate(BATCHES):
        topic.send([",".join(map(str, event(**r))) for r in batch] + bad[n:n + 1])
    counts = quarantine.OutcomeCounts()
    spark.streams.addListener(counts)
    try:
        for _ in range(2):  # the second start finds nothing new
            jobs.finish(jobs.run_quarantined(topic.records(), f"{folder}/e", f"{folder}/r", f"{folder}/c"))
        for _ in range(100):
            if len(counts.batches) == len(BATCHES):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    assert counts.batches == {n: (len(b), 1 if n < 3 else 0) for n, b in enumerate(BATCHES)}
    assert counts.totals == (len(all_rows()), len(bad))
    assert rows_of(jobs.event_table(spark, f"{folder}/e").latest().select(*EVENT_COLUMNS)) == rows_of(make_events(*last_versions()))
    assert sorted(r.value for r in quarantine.reject_table(spark, f"{folder}/r").latest().collect()) == sorted(bad)


def test_a_replayed_batch_rejects_nothing_twice(spark, folder, topic):
    records = spark.createDataFrame([(None, "bad", None, None, None, None), (None, "bad", None, "t", 0, 7), (None, "bad", None, "t", 0, 8)],
                                    "key string, value string, timestamp timestamp, topic string, partition int, offset long")
    events, rejects = jobs.event_table(spark, f"{folder}/e"), quarantine.reject_table(spark, f"{folder}/r")
    rows = quarantine.outcomes(records)
    for batch in (0, 0, 1):
        quarantine.split_sink(events, rejects)(rows, batch, "q")
    assert rejects.latest().count() == 3 and events.latest().count() == 0


def flaky(path, connection):
    """An index that fails once when it takes in document 77: with a broken connection, or the whole task."""
    error = ConnectionResetError if connection else ValueError

    class Flaky(index_sink.FolderIndex):  # in here, so that it travels by value
        def open(self):
            session, path = super().open(), self.path
            send = session.send

            def once(documents):
                if any(d["id"] == "77" for d in documents):
                    try:
                        os.close(os.open(f"{path}/failed", os.O_CREAT | os.O_EXCL))
                    except FileExistsError:
                        pass
                    else:
                        raise error("first time")
                send(documents)

            session.send = once
            return session

    return Flaky(path)


ROWS = "id string, n long"


def numbered(spark, n=250):
    return spark.range(0, n, 1, 2).select(F.col("id").cast("string").alias("id"), F.col("id").alias("n"))


def test_a_commit_counts_what_was_sent(spark, folder):
    index_sink.write_index(numbered(spark), index_sink.FolderIndex(folder), batch="first")
    assert [tuple(r) for r in index_sink.committed(spark, folder).collect()] == [("first", 250, 4, 100, 0)]
    assert rows_of(index_sink.indexed(spark, folder, ROWS)) == rows_of(numbered(spark))


def test_a_broken_connection_is_tried_again(spark, folder):
    index_sink.write_index(numbered(spark), flaky(folder, True), retry_wait=0.0)
    assert [(r.documents, r.resent) for r in index_sink.committed(spark, folder).collect()] == [(250, 1)]
    assert rows_of(index_sink.indexed(spark, folder, ROWS)) == rows_of(numbered(spark))


def test_a_failed_task_is_not_published(spark, folder):
    """Without task retries here, the write fails: what finished tasks sent is taken back and no commit is there."""
    with pytest.raises(Exception, match="first time"):
        index_sink.write_index(numbered(spark), flaky(folder, False))
    assert not os.path.exists(f"{folder}/commits")
    index_sink.write_index(numbered(spark), flaky(folder, False))
    assert rows_of(index_sink.indexed(spark, folder, ROWS)) == rows_of(numbered(spark))


RETRIED = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from eventmart.session import build_session
from eventmart.storage import index_sink
from test_state import flaky, numbered
spark = build_session(master="local[2,3]", **{{"spark.ui.enabled": "false", "spark.sql.warehouse.dir": {folder!r}}})
index_sink.write_index(numbered(spark), flaky({folder!r} + "/i", False))
print(index_sink.committed(spark, {folder!r} + "/i").toJSON().first())
"""


def test_a_task_that_ran_again_counts_once(folder):
    """In a session of its own, whose tasks may fail twice: one file more than the commit names."""
    import subprocess
    import sys
    tests = os.path.dirname(os.path.abspath(__file__))
    code = RETRIED.format(root=os.path.dirname(tests), tests=tests, folder=folder)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert json.loads(done.stdout.splitlines()[-1]) == {"batch": "batch", "documents": 250, "batches": 4, "largest": 100, "resent": 0}
    assert len(os.listdir(f"{folder}/i/documents")) == 3


def test_a_stream_commits_every_batch(spark, folder, full_topic, make_events):
    jobs.finish(jobs.run_index(full_topic.records(), f"{folder}/c", index_sink.FolderIndex(f"{folder}/i"), batch_size=1))
    commits = index_sink.committed(spark, f"{folder}/i").collect()
    assert sorted((r.batch, r.documents, r.largest) for r in commits) == [(str(n), len(b), 1) for n, b in enumerate(BATCHES)]
    found = index_sink.indexed(spark, f"{folder}/i", DOCUMENT_SCHEMA)
    assert rows_of(found) == rows_of(event_documents(make_events(*all_rows())))


def test_an_empty_index(spark, folder):
    index_sink.write_index(numbered(spark, 0), index_sink.FolderIndex(folder))
    assert index_sink.indexed(spark, folder, ROWS).count() == 0
