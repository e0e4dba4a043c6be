"""Command line: `spark-submit ... eventmart/__main__.py <job> --options`, or `python -m eventmart <job>`."""

import argparse
import importlib

from eventmart.functions.documents import as_json
from eventmart.functions.wide_rows import encode_events, encode_marts
from eventmart.operators import learning, lookups, publish, sums
from eventmart.session import build_session
from eventmart.sources.open import open_events, open_marts, open_table, open_wide, stored_table
from eventmart.sources.streams import record_stream
from eventmart.sources.tables import text_lines
from eventmart.storage import layouts
from eventmart.storage.compaction import CompactingTable
from eventmart.storage.salted import write_salted
from eventmart.streaming import jobs


def records(spark, args):
    if args.brokers:
        return record_stream(
            spark, "kafka", brokers=args.brokers, topics=args.topics, starting_offsets=args.starting_offsets)
    return record_stream(spark, "folder", path=args.input)


def run_stream(queries, args):
    queries = queries if isinstance(queries, list) else [queries]
    if args.seconds is None:
        jobs.finish(queries)
    else:
        queries[0].sparkSession.streams.awaitAnyTermination()


def stream_keyed(spark, args):
    run_stream(jobs.run_keyed(
        records(spark, args), args.events, args.marts, args.checkpoint, args.seconds,
        state_partitions=args.state_partitions), args)


def stream_wide(spark, args):
    run_stream(jobs.run_wide(
        records(spark, args), args.events, args.marts, args.salts, args.checkpoint, args.seconds,
        state_partitions=args.state_partitions), args)


def stream_files(spark, args):
    run_stream(jobs.run_files(
        records(spark, args), args.path, args.min_file_size, args.checkpoint, args.seconds, args.table), args)


def stream_docs(spark, args):
    send = None
    if args.send:
        module, function = args.send.split(":")
        send = getattr(importlib.import_module(module), function)
    run_stream(jobs.run_docs(
        records(spark, args), args.checkpoint, send=send, table_path=args.path, seconds=args.seconds), args)


def stream_quarantined(spark, args):
    run_stream(jobs.run_quarantined(records(spark, args), args.events, args.rejects, args.checkpoint, args.seconds), args)


def stream_seeded(spark, args):
    """Running marts that start from a stored one; each batch stores every key."""
    seed = open_marts(spark, args.seed) if args.seed else None
    query = jobs.run_seeded_marts(
        records(spark, args), args.marts, args.checkpoint, seed, seconds=args.seconds, state_partitions=args.state_partitions)
    jobs.finish_idle(query) if args.seconds is None else run_stream(query, args)


def compact(spark, args):
    """Fold a keyed table beside its stream, or publish what a compacting table still holds back."""
    table = stored_table(spark, args.path)
    if table is None:
        raise SystemExit(f"{args.path} is no keyed or compacting table")
    table.flush() if isinstance(table, CompactingTable) else table.compact_finished()


def wins(spark, args):
    sums.first_accounts(sums.wins_per_account(open_marts(spark, args.marts))).show(100, truncate=False)


def purchases(spark, args):
    sums.first_accounts(sums.purchases_per_account(open_events(spark, args.events))).show(100, truncate=False)


def copy(spark, args):
    source = args.source
    if "/" in source:
        open_table(spark, source).createOrReplaceTempView("source_of_copy")
        source = "source_of_copy"
    layouts.copy_table(spark, source, args.target, args.path)


def create_table(spark, args):
    """An external table over a folder of event files, or a bucketed copy of an event or mart table."""
    if args.files:
        layouts.create_file_table(spark, args.table, args.files)
    else:
        rows = open_events(spark, args.events) if args.events else open_marts(spark, args.marts)
        layouts.write_keyed(rows, args.table, args.buckets, args.path)


def drop_table(spark, args):
    layouts.drop_tables(spark, args.table)


def ml_report(spark, args):
    for name, table in learning.report(spark, open_marts(spark, args.marts), args.centers, args.iterations).items():
        print(name)
        table.show(max(1, table.count()), truncate=False)


def create_salted(spark, args):
    """Rows of a keyed table have one version per key already."""
    name = args.events or args.marts
    unique = "/" in name and stored_table(spark, name) is not None and not isinstance(stored_table(spark, name), CompactingTable)
    if args.events:
        rows = encode_events(open_events(spark, args.events), args.salts)
    else:
        rows = encode_marts(open_marts(spark, args.marts), args.salts)
    write_salted(rows, args.path, args.salts, args.regions, unique=unique)


def publish_lines(spark, args):
    publish.publish(
        publish.line_records(text_lines(spark, args.path)), brokers=args.brokers, topic=args.topic,
        acks=args.acks, linger_ms=args.linger_ms, batch_size=args.batch_size)


def publish_events(spark, args):
    publish.publish(
        publish.event_records(open_events(spark, args.events)), brokers=args.brokers, topic=args.topic,
        acks=args.acks, linger_ms=args.linger_ms, batch_size=args.batch_size)


def lookup_marts(spark, args):
    marts = open_marts(spark, args.marts)
    found = lookups.mart_of(marts, args.account, args.app) if args.app else lookups.marts_of_account(marts, args.account)
    for row in as_json(found).toLocalIterator():
        print(row.json)


def lookup_events(spark, args):
    found = lookups.events_between(open_events(spark, args.events), args.account, args.start, args.end)
    for row in as_json(found).toLocalIterator():
        print(row.json)


def lookup_events_by_key(spark, args):
    rows = open_wide(spark, args.path)
    found = lookups.events_in_range(rows, args.account, args.app, args.salts, args.start, args.end)
    for row in as_json(found).toLocalIterator():
        print(row.json)


def lookup_mart_by_key(spark, args):
    found = lookups.mart_by_row_key(open_wide(spark, args.path, marts=True), args.account, args.app, args.salts)
    for row in as_json(found).toLocalIterator():
        print(row.json)


STREAM = ["--brokers", "--topics", "--input", "--starting-offsets=latest", "--seconds:int", "--checkpoint!", "--state-partitions:int"]
KAFKA = ["--brokers!", "--topic!", "--acks:int=1", "--linger-ms:int", "--batch-size:int"]

# Options per job: `!` marks a required one, `:int` a number, `=` a default.
JOBS = {
    "stream-keyed": (stream_keyed, [*STREAM, "--events!", "--marts!"]),
    "stream-wide": (stream_wide, [*STREAM, "--events!", "--marts!", "--salts:int!"]),
    "stream-files": (stream_files, [*STREAM, "--path!", "--min-file-size:int!", "--table"]),
    "stream-docs": (stream_docs, [*STREAM, "--path", "--send"]),
    "stream-quarantined": (stream_quarantined, [*STREAM, "--events!", "--rejects!"]),
    "stream-seeded": (stream_seeded, [*STREAM, "--marts!", "--seed"]),
    "compact": (compact, ["--path!"]),
    "create-table": (create_table, ["--table!", "--files", "--events", "--marts", "--buckets:int=3", "--path"]),
    "drop-table": (drop_table, ["--table!"]),
    "wins": (wins, ["--marts!"]),
    "purchases": (purchases, ["--events!"]),
    "copy-table": (copy, ["--source!", "--target!", "--path"]),
    "ml-report": (ml_report, ["--marts!", "--centers:int!", "--iterations:int!"]),
    "create-salted": (create_salted, ["--events", "--marts", "--path!", "--salts:int!", "--regions:int!"]),
    "publish-lines": (publish_lines, ["--path!", *KAFKA]),
    "publish-events": (publish_events, ["--events!", *KAFKA]),
    "lookup-marts": (lookup_marts, ["--marts!", "--account!", "--app"]),
    "lookup-events-by-key": (lookup_events_by_key, ["--path!", "--account!", "--app!", "--salts:int!", "--start:int", "--end:int"]),
    "lookup-mart-by-key": (lookup_mart_by_key, ["--path!", "--account!", "--app!", "--salts:int!"]),
    "lookup-events": (lookup_events, ["--events!", "--account!", "--start:int", "--end:int"]),
}


def parser():
    top = argparse.ArgumentParser(prog="eventmart", description="Account-activity jobs on Spark")
    commands = top.add_subparsers(dest="job", required=True)
    for name, (_, options) in JOBS.items():
        command = commands.add_parser(name)
        for option in options:
            option, _, default = option.partition("=")
            required, option = option.endswith("!"), option.rstrip("!")
            flag, _, kind = option.partition(":")
            cast = int if kind else str
            command.add_argument(flag, type=cast, required=required, default=cast(default) if default else None)
    return top


def main(argv=None):
    args = parser().parse_args(argv)
    run, _ = JOBS[args.job]
    run(build_session(f"eventmart-{args.job}"), args)


if __name__ == "__main__":
    main()
