import json

import pytest
from conftest import event, rows_of

from eventmart.__main__ import main, parser
from eventmart.functions.documents import ordered
from eventmart.operators.mart import account_mart
from eventmart.schemas import EVENT_WIDE_SCHEMA
from eventmart.storage.layouts import drop_tables
from eventmart.storage.salted import read_salted
from eventmart.streaming import jobs
from eventmart.streaming.quarantine import reject_table


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, make_events):
    folder = str(tmp_path_factory.mktemp("cli"))
    events = make_events(*[
        dict(account=f"u{i % 5}", app=str(i % 3), event_id=str(i), ts=1000 + i, kind="win", purchase=float(i))
        for i in range(40)])
    events.write.parquet(f"{folder}/events")
    account_mart(events).write.parquet(f"{folder}/marts")
    return folder


def test_sums(tables, capsys):
    main(["wins", "--marts", f"{tables}/marts"])
    assert "|u0        |8        |" in capsys.readouterr().out
    main(["purchases", "--events", f"{tables}/events"])
    assert "|u0        |140.0   |" in capsys.readouterr().out


def test_lookups(tables, capsys):
    main(["lookup-marts", "--marts", f"{tables}/marts", "--account", "u1"])
    assert len(capsys.readouterr().out.splitlines()) == 3
    main(["lookup-marts", "--marts", f"{tables}/marts", "--account", "u1", "--app", "0"])
    assert json.loads(capsys.readouterr().out)["app_id"] == "0"
    main(["lookup-events", "--events", f"{tables}/events", "--account", "u1", "--start", "1001", "--end", "1011"])
    assert [json.loads(l)["event_timestamp"] for l in capsys.readouterr().out.splitlines()] == [1006]


def test_ml_report(tables, capsys):
    main(["ml-report", "--marts", f"{tables}/marts", "--centers", "2", "--iterations", "5"])
    out = capsys.readouterr().out
    assert "center_purchase_total" in out and "feature_i" in out and "norm_l2" in out


def test_copy_and_salted(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/marts").createOrReplaceTempView("cli_marts")
    main(["copy-table", "--source", "cli_marts", "--target", "cli_copy", "--path", f"{tmp_path}/copy"])
    try:
        assert rows_of(spark.table("cli_copy")) == rows_of(spark.table("cli_marts"))
    finally:
        drop_tables(spark, "cli_copy")
    main(["create-salted", "--events", f"{tables}/events", "--path", f"{tmp_path}/s", "--salts", "6", "--regions", "3"])
    assert read_salted(spark, f"{tmp_path}/s", EVENT_WIDE_SCHEMA).count() == 40


def test_stream(spark, tmp_path):
    lines = [("k", ",".join(map(str, event(event_id=str(i), kind="login")))) for i in range(3)]
    spark.createDataFrame(lines, "key string, value string").write.parquet(f"{tmp_path}/topic")
    main(["stream-keyed", "--input", f"{tmp_path}/topic", "--events", f"{tmp_path}/e", "--marts", f"{tmp_path}/m",
          "--checkpoint", f"{tmp_path}/c"])
    assert jobs.mart_table(spark, f"{tmp_path}/m").latest().first().sign_on_count == 3
    main(["stream-docs", "--input", f"{tmp_path}/topic", "--path", f"{tmp_path}/d", "--checkpoint", f"{tmp_path}/dc"])
    assert jobs.document_table(spark, f"{tmp_path}/d").latest().count() == 3


def test_quarantine_and_seed(spark, tmp_path):
    lines = [("k", ",".join(map(str, event(event_id=str(i), kind="login")))) for i in range(3)]
    spark.createDataFrame(lines + [("k", "bad")], "key string, value string").write.parquet(f"{tmp_path}/topic")
    main(["stream-quarantined", "--input", f"{tmp_path}/topic", "--events", f"{tmp_path}/e", "--rejects", f"{tmp_path}/r", "--checkpoint", f"{tmp_path}/c"])
    assert jobs.event_table(spark, f"{tmp_path}/e").latest().count() == 3
    assert [r.value for r in reject_table(spark, f"{tmp_path}/r").latest().collect()] == ["bad"]
    account_mart(jobs.event_table(spark, f"{tmp_path}/e").latest()).write.parquet(f"{tmp_path}/seed")
    spark.createDataFrame(lines[:1], "key string, value string").write.parquet(f"{tmp_path}/more")
    main(["stream-seeded", "--input", f"{tmp_path}/more", "--marts", f"{tmp_path}/m", "--seed", f"{tmp_path}/seed", "--checkpoint", f"{tmp_path}/c"])
    assert jobs.mart_table(spark, f"{tmp_path}/m").latest().first().sign_on_count == 4


def test_jobs_over_streamed_tables(spark, tmp_path, capsys):
    """Two deliveries; every job sees one version of a mart or event."""
    at = str(tmp_path)
    for i in range(2):
        lines = [("k", ",".join(map(str, event(account=a, event_id=str(i), kind="win", purchase=1.0)))) for a in "ab"]
        spark.createDataFrame(lines, "key string, value string").write.mode("append").parquet(f"{at}/topic")
        for job, paths in (("stream-keyed", ["--events", f"{at}/e", "--marts", f"{at}/m"]), ("stream-wide", ["--events", f"{at}/we", "--marts", f"{at}/wm", "--salts", "6"]),
                           ("stream-files", ["--path", f"{at}/f", "--min-file-size", "1000000"])):
            main([job, "--input", f"{at}/topic", "--checkpoint", f"{at}/c-{job}", "--state-partitions", "2", *paths])
    for marts in ("m", "wm"):
        main(["wins", "--marts", f"{at}/{marts}"])
        assert "|a         |2        |" in capsys.readouterr().out
    for events in ("e", "we", "f"):
        main(["purchases", "--events", f"{at}/{events}"])
        assert "|a         |2.0     |" in capsys.readouterr().out
    main(["compact", "--path", f"{at}/m"])
    main(["compact", "--path", f"{at}/f"])
    assert spark.read.parquet(f"{at}/f/table").count() == 4
    main(["lookup-marts", "--marts", f"{at}/m", "--account", "a"])
    main(["lookup-mart-by-key", "--path", f"{at}/wm", "--account", "a", "--app", "x", "--salts", "6"])
    assert [json.loads(l)["win_count"] for l in capsys.readouterr().out.splitlines()] == [2, 2]
    main(["create-salted", "--events", f"{at}/e", "--path", f"{at}/s", "--salts", "6", "--regions", "3"])
    main(["lookup-events-by-key", "--path", f"{at}/s", "--account", "b", "--app", "x", "--salts", "6"])
    assert [json.loads(l)["event_id"] for l in capsys.readouterr().out.splitlines()] == ["0", "1"]
    main(["copy-table", "--source", f"{at}/m", "--target", "copied_marts", "--path", f"{at}/copy"])
    main(["create-table", "--table", "bucketed_marts", "--marts", f"{at}/m", "--buckets", "4", "--path", f"{at}/b"])
    main(["create-table", "--table", "event_files", "--files", f"{at}/f/table"])
    try:
        assert spark.table("copied_marts").count() == spark.table("bucketed_marts").count() == 2
        assert spark.table("event_files").count() == 4
    finally:
        for table in ("copied_marts", "bucketed_marts", "event_files"):
            main(["drop-table", "--table", table])
    assert not spark.catalog.tableExists("event_files")


def test_versions_are_never_read_raw(spark, tmp_path):
    from eventmart.sources.open import open_table
    spark.range(1).write.parquet(f"{tmp_path}/x/runs/version=0")
    with pytest.raises(ValueError, match="versions"):
        open_table(spark, f"{tmp_path}/x")


def test_arguments():
    args = parser().parse_args(["publish-lines", "--path", "p", "--brokers", "b", "--topic", "t", "--linger-ms", "5"])
    assert (args.acks, args.linger_ms, args.batch_size) == (1, 5, None)
    with pytest.raises(SystemExit):
        parser().parse_args(["wins"])


def test_documents_without_a_value_come_last(spark):
    docs = spark.createDataFrame([(None,), ("b",), ("a",)], "f string")
    assert [r.f for r in ordered(docs, "f").collect()] == ["a", "b", None]
