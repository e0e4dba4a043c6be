import os
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.wide_rows import encode_events
from eventmart.operators import lookups
from eventmart.operators.mart import account_mart
from eventmart.operators.sums import wins_per_account
from eventmart.schemas import EVENT_KEY, EVENT_SCHEMA, EVENT_WIDE_SCHEMA, MART_KEY, MART_SCHEMA
from eventmart.session import session_conf, work_dir
from eventmart.sources.tables import events_by_name, marts_by_name, scan_table, text_lines
from eventmart.storage import documents, layouts
from eventmart.storage.compaction import CompactingTable
from eventmart.storage.salted import read_salted, write_salted
from eventmart.storage.upsert import KeyedTable, latest_per_key


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- keyed tables ----------------------------------------------------------------------------------

def event_table(spark, folder, **options):
    return KeyedTable(spark, f"{folder}/events", EVENT_SCHEMA, EVENT_KEY, **options)


def test_newest_version_of_a_key_wins(spark, folder, make_events):
    table = event_table(spark, folder)
    assert table.latest().count() == 0
    table.write(make_events({"purchase": 9.0}, {"event_id": "2"}), 0)
    table.write(make_events({"purchase": 1.0}), 1)
    table.write(make_events({"purchase": 1.0}), 1)  # replay
    assert sorted((r.event_id, r.purchase) for r in table.latest().collect()) == [("1", 1.0), ("2", 0.0)]


def mart_row(key, n):
    return (key, "x", n, n, n, float(n), 0.0, 0, 0.0, 0, 0.0, 0)


@pytest.mark.parametrize("one_row_per_batch", [False, True])
def test_compaction_changes_no_row(spark, folder, make_marts, one_row_per_batch):
    table = KeyedTable(spark, f"{folder}/m", MART_SCHEMA, MART_KEY, one_row_per_batch=one_row_per_batch)
    expected = {}
    for batch in range(7):
        keys = ["abc"[batch % 3], "d"]
        table.write(make_marts(*[mart_row(k, batch) for k in keys]), batch)
        expected.update({k: batch for k in keys})
        if batch in (2, 4):
            table.compact(batch - 1)
        assert {r.account_id: r.win_count for r in table.latest().collect()} == expected
    table.write(make_marts(*[mart_row(k, 6) for k in keys]), 6)  # replay of the last batch
    table.compact()
    assert {r.account_id: r.win_count for r in table.latest().collect()} == expected
    assert table.versions() == (6, [])
    table.compact()  # nothing new: what was replaced goes
    assert {r.account_id: r.win_count for r in table.latest().collect()} == expected
    assert table._finished("whole") == [6] and table._finished("runs") == []


def test_readers_keep_their_files_until_the_next_compaction(spark, folder, make_marts):
    table = KeyedTable(spark, f"{folder}/m", MART_SCHEMA, MART_KEY, one_row_per_batch=True)
    for batch in range(2):
        table.write(make_marts(mart_row("a", batch), mart_row(f"k{batch}", batch)), batch)
    before = table.latest()
    table.compact()
    table.write(make_marts(mart_row("a", 2)), 2)
    assert sorted(r.win_count for r in before.collect()) == [0, 1, 1]
    assert table.versions() == (1, [2]) and sorted(r.win_count for r in table.latest().collect()) == [0, 1, 2]


def test_unfinished_run_is_not_read(spark, folder, make_marts):
    table = KeyedTable(spark, f"{folder}/m", MART_SCHEMA, MART_KEY)
    table.write(make_marts(mart_row("a", 1)), 0)
    table.write(make_marts(mart_row("a", 2)), 1)
    os.remove(f"{folder}/m/runs/version=1/_SUCCESS")
    assert [r.win_count for r in table.latest().collect()] == [1]


def test_a_folded_batch_is_not_replayed(spark, folder, make_marts):
    def table():
        return KeyedTable(spark, f"{folder}/m", MART_SCHEMA, MART_KEY)
    for batch in (0, 1):
        table().write(make_marts(mart_row("a", batch)), batch)
    table().compact()
    with pytest.raises(ValueError, match="already folded"):
        table().write(make_marts(mart_row("a", 9)), 0)
    table().write(make_marts(mart_row("a", 9)), 2)
    assert table().latest().first().win_count == 9


@pytest.mark.parametrize("fold", [False, True])
def test_a_new_owner_counts_from_zero_and_touches_nothing(spark, folder, make_marts, fold):
    def table():
        return KeyedTable(spark, f"{folder}/m", MART_SCHEMA, MART_KEY)
    for batch in range(3):
        table().write(make_marts(mart_row("a", batch), mart_row(f"old{batch}", 1)), batch, "first")
    if fold:
        table().compact_finished()
    table().write(make_marts(mart_row("a", 10), mart_row("new", 1)), 0, "second")
    table().write(make_marts(mart_row("a", 11), mart_row("new", 1)), 0, "second")  # replay
    found = {r.account_id: r.win_count for r in table().latest().collect()}
    assert found == {"a": 11, "old0": 1, "old1": 1, "old2": 1, "new": 1}


def test_compacted_files_hold_ranges_of_keys(spark, folder, make_marts):
    table = KeyedTable(spark, f"{folder}/m", MART_SCHEMA, MART_KEY, one_row_per_batch=True)
    for batch in range(3):
        table.write(make_marts(*[mart_row(f"k{i:04}", batch) for i in range(0, 4000, 2)]), batch)
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        table.compact()
    files = spark.read.parquet(table._folder("whole", 2)).groupBy(F.input_file_name()).agg(F.min("account_id").alias("a"), F.max("account_id").alias("b")).collect()
    ranges = sorted((r.a, r.b) for r in files)
    assert len(ranges) > 1 and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))


def test_null_key_is_an_error(spark, folder, make_marts):
    table = KeyedTable(spark, f"{folder}/m", MART_SCHEMA, MART_KEY)
    with pytest.raises(PySparkException, match="null in key"):
        table.write(make_marts(mart_row(None, 1)), 0)


def test_order_inside_a_batch(spark, folder, make_events):
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("offset", T.LongType())])
    table = KeyedTable(spark, f"{folder}/o", schema, EVENT_KEY, ["offset"])
    rows = make_events({"purchase": 9.0}).withColumn("offset", F.lit(1).cast("long")).unionByName(
        make_events({"purchase": 1.0}).withColumn("offset", F.lit(2).cast("long")))
    table.write(rows, 0)
    assert [r.purchase for r in table.latest().collect()] == [1.0]


def test_copies_of_a_hot_key_shrink_before_the_shuffle(spark, make_events):
    rows = make_events({}).withColumn("batch_id", F.lit(1).cast("long"))
    plan = plan_of(latest_per_key(rows, EVENT_KEY, ["batch_id"]))
    assert plan.index("partial_max") > plan.index("Exchange") > plan.index("max(")
    marts = account_mart(make_events({})).withColumn("batch_id", F.lit(1).cast("long"))
    plan = plan_of(latest_per_key(marts, MART_KEY, ["batch_id"], one_row_per_order=True))
    assert "partial_max_by" in plan and "SortAggregate" not in plan


def test_lookup_filter_reaches_the_files(spark, folder, make_events):
    table = event_table(spark, folder)
    table.write(make_events({}, {"account": "b"}), 0)
    table.write(make_events({"event_id": "9"}), 1)
    table.compact()
    table.write(make_events({"account": "b"}), 2)
    found = lookups.events_of_account(table.latest(), "b")
    assert found.count() == 1
    plan = plan_of(found)  # the compacted rows and the later batch are both pruned
    assert plan.count("EqualTo(account_id,b)") >= 2 and plan.count("FileScan") == plan.count("EqualTo(account_id,b)")


# --- salted tables ---------------------------------------------------------------------------------

def test_salted_table(spark, folder, make_events):
    events = make_events(*[{"account": f"u{i % 20}", "ts": 1000 + i, "event_id": str(i)} for i in range(300)])
    rows = encode_events(events, 6)
    write_salted(rows.unionByName(rows), folder + "/s", 6, 3)
    stored = read_salted(spark, folder + "/s", EVENT_WIDE_SCHEMA)
    assert rows_of(stored.select(*rows.columns)) == rows_of(rows)
    assert {r.salt for r in stored.select("salt").distinct().collect()} == {"0000", "0001", "0002", "0003", "0004", "0005"}
    found = lookups.events_in_range(stored, "u7", "x", 6, 1000, 1200)
    assert found.count() == 10
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(salt" in plan and "GreaterThanOrEqual(row_key" in plan
    for name in os.listdir(folder + "/s"):
        if name.startswith("salt="):
            for part in [p for p in os.listdir(f"{folder}/s/{name}") if p.endswith(".parquet")]:
                keys = [r.row_key for r in spark.read.parquet(f"{folder}/s/{name}/{part}").collect()]
                assert keys == sorted(keys) and part.endswith(".snappy.parquet")


# --- catalog tables --------------------------------------------------------------------------------

def test_file_table(spark, folder, make_events):
    events = make_events({}, {"ts": 5, "event_id": "2"})
    layouts.to_file_layout(events).write.parquet(f"{folder}/f")
    table = layouts.create_file_table(spark, "file_events", f"{folder}/f")
    try:
        assert table.columns[4] == "event_timestamp" and table.schema == layouts.table_schema(spark, "file_events")
        assert rows_of(layouts.from_file_layout(table)) == rows_of(events)
    finally:
        layouts.drop_tables(spark, "file_events")
    assert not spark.catalog.tableExists("file_events")


def test_keyed_layout_prunes_buckets_and_saves_the_shuffle(spark, folder, make_events):
    events = make_events(*[{"account": f"u{i}", "kind": "win"} for i in range(40)])
    table = layouts.write_keyed(account_mart(events), "keyed_marts", buckets=3, path=f"{folder}/k")
    try:
        wins = wins_per_account(table)
        assert "Exchange" not in plan_of(wins) and wins.count() == 40
        found = lookups.marts_of_account(table, "u7")
        loose = layouts.scan_unbucketed(spark, "keyed_marts")
        assert "Exchange" in plan_of(wins_per_account(loose)) and rows_of(loose) == rows_of(table)
        bucket = found.select(F.input_file_name()).first()[0].rsplit("_", 1)[1][:5]
        for name in os.listdir(f"{folder}/k"):
            if name.endswith(".parquet") and f"_{bucket}" not in name:
                (Path(folder) / "k" / name).write_text("unreadable")  # a lookup opens its own bucket only
        assert found.count() == 1
    finally:
        layouts.drop_tables(spark, "keyed_marts")


def test_table_copy_and_scan(spark, folder, make_events):
    marts = account_mart(make_events({}, {"account": "b"}))
    marts.withColumn("more", F.lit(1)).write.parquet(f"{folder}/m")
    view = scan_table(spark, f"{folder}/m", view="mart_view")
    copy = layouts.copy_table(spark, "mart_view", "mart_copy", f"{folder}/c")
    try:
        assert rows_of(copy) == rows_of(view)
        assert rows_of(marts_by_name(copy)) == rows_of(marts)
    finally:
        layouts.drop_tables(spark, "mart_copy")
    events = make_events({})
    assert rows_of(events_by_name(events.select(*reversed(events.columns)))) == rows_of(events)


def test_text_lines_of_a_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.txt").write_text("three")
    assert rows_of(text_lines(spark, str(tmp_path))) == [("one",), ("three",), ("two",)]
    assert rows_of(text_lines(spark, str(tmp_path / "b.txt"))) == [("three",)]


# --- compacting sink -------------------------------------------------------------------------------

def sizes(folder):
    return [os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.endswith(".parquet") and n[0] not in "._"]


def test_compaction_keeps_every_row_once(spark, folder, make_events):
    minimum = 20_000
    table = CompactingTable(spark, folder + "/c", EVENT_SCHEMA, minimum)
    events = lambda batch, n: make_events(*[{"event_id": f"{batch}-{i}", "session": str(hash((batch, i)))} for i in range(n)])
    expected = []
    for batch, n in enumerate([20, 30, 0, 4000, 10, 3000, 5]):
        rows = events(batch, n)
        expected += [r.event_id for r in rows.collect()]
        for _ in range(2 if batch in (1, 3, 5) else 1):  # some batches run twice
            table.add(rows, batch)
        assert sorted(r.event_id for r in table.rows().collect()) == sorted(expected)
        assert all(size >= minimum for size in sizes(table.table))
        if batch < 3:
            assert not sizes(table.table)
    assert sizes(table.table) and table.pending().count() > 0
    assert table.published().count() + table.pending().count() == len(expected)
    assert not os.listdir(folder + "/c/scratch")


def test_unfinished_batch_is_undone(spark, folder, make_events):
    """What a batch left before it was done is not read, and is taken back when the batch runs again."""
    table = CompactingTable(spark, folder + "/c", EVENT_SCHEMA, 1)
    table.add(make_events({}), 0)
    table.add(make_events({"event_id": "2"}, {"event_id": "3"}), 1)
    os.rmdir(f"{folder}/c/done/v=1")
    assert [r.event_id for r in table.rows().collect()] == ["1"]
    table.add(make_events({"event_id": "2"}), 1)
    assert sorted(r.event_id for r in table.rows().collect()) == ["1", "2"]


def test_a_batch_runs_again_from_what_was_pending_before(spark, folder, make_events):
    table = CompactingTable(spark, folder + "/c", EVENT_SCHEMA, 10**9)
    for batch in (0, 1, 2, 2, 3, 3):
        table.add(make_events({"event_id": str(batch)}).repartition(2), batch)
        assert sorted(r.event_id for r in table.rows().collect()) == [str(n) for n in range(batch + 1)]
    assert len(os.listdir(f"{folder}/c/pending")) == 2 and len(sizes(f"{folder}/c/pending/v=3")) == 1


def test_a_new_owner_adds_to_the_files(spark, folder, make_events):
    """A second checkpoint sends batch 0 again, fails in the middle, and is retried."""
    def table():
        return CompactingTable(spark, folder + "/c", EVENT_SCHEMA, 1)
    for batch in range(4):
        table().add(make_events({"event_id": f"old{batch}"}), batch, "first")
    broken = make_events({"event_id": "new"}).withColumn("purchase", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(PySparkException, match="broken"):
        table().add(broken, 0, "second")
    assert table().rows().count() == 4
    for _ in range(2):
        table().add(make_events({"event_id": "new"}), 0, "second")
        assert sorted(r.event_id for r in table().rows().collect()) == ["new", "old0", "old1", "old2", "old3"]


def test_flush_publishes_what_is_pending(spark, folder, make_events):
    table = CompactingTable(spark, folder + "/c", EVENT_SCHEMA, 10**9)
    table.flush()
    for batch in range(2):
        table.add(make_events({"event_id": str(batch)}), batch)
    assert table.published().count() == 0 and table.pending().count() == 2
    table.flush()
    assert table.published().count() == 2 and table.pending().count() == 0
    table.flush()
    table.add(make_events({"event_id": "2"}), 2)
    assert table.rows().count() == 3 and spark.read.parquet(table.table).count() == 2


def test_a_batch_under_way_is_not_seen(spark, folder, make_events):
    table = CompactingTable(spark, folder + "/c", EVENT_SCHEMA, 10**9)
    table.add(make_events({}, {"event_id": "2"}), 0)
    os.link(table._sized(table._pending(0))[0][0], f"{table.table}/part-1-0.parquet")  # published, but not done
    assert table.rows().count() == 2


# --- document index --------------------------------------------------------------------------------

def test_documents_go_out_in_batches(spark, tmp_path):
    target = str(tmp_path)

    def send(batch):
        import json
        import uuid
        with open(f"{target}/{uuid.uuid4().hex}.json", "w") as out:
            json.dump(batch, out)

    rows = spark.range(0, 250, 1, 2).select(F.col("id").cast("string").alias("id"))
    assert documents.index_documents(rows, send, batch_size=100) == 250
    import json
    batches = [json.load(open(f"{target}/{n}")) for n in os.listdir(target)]
    assert sorted(map(len, batches)) == [25, 25, 100, 100]
    assert {d["id"] for b in batches for d in b} == {str(i) for i in range(250)}


def test_retry_only_after_a_broken_connection():
    calls = []

    def failing(errors):
        def send(batch):
            calls.append(batch)
            if len(calls) <= len(errors):
                raise errors[len(calls) - 1]
            return "sent"
        return send

    wrapped = RuntimeError("outer")
    wrapped.__cause__ = ConnectionResetError()
    for error in (ConnectionRefusedError(), wrapped):
        calls.clear()
        assert documents.send_with_retry(failing([error]), [1], retry_wait=0) == "sent" and len(calls) == 2
    calls.clear()
    with pytest.raises(ValueError):
        documents.send_with_retry(failing([ValueError()]), [1], retry_wait=0)
    assert len(calls) == 1
    calls.clear()
    with pytest.raises(ConnectionError):
        documents.send_with_retry(failing([ConnectionError()] * 2), [1], retry_wait=0)
    assert len(calls) == 2


# --- session ---------------------------------------------------------------------------------------

def test_session_helpers(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(f"{root}/eventmart-{spark.sparkContext.applicationId}/x-") and work_dir(spark, "x") != work_dir(spark, "x")
    with session_conf(spark, {"spark.sql.shuffle.partitions": "3", "spark.some.option": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4" and spark.conf.get("spark.some.option", None) is None
