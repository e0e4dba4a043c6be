"""One way to open a table for batch jobs, whatever wrote it."""

from pyspark.sql import types as T

from eventmart.functions.wide_rows import decode_events, decode_marts
from eventmart.sources.tables import events_by_name, marts_by_name
from eventmart.storage.compaction import CompactingTable
from eventmart.storage.descriptor import described
from eventmart.storage.files import Files
from eventmart.storage.layouts import from_file_layout
from eventmart.storage.salted import read_salted
from eventmart.storage.upsert import KeyedTable
from eventmart.schemas import EVENT_WIDE_SCHEMA, MART_WIDE_SCHEMA


def stored_table(spark, path):
    """The keyed or compacting table in a folder, or None for any other folder."""
    files = Files(spark, path)
    about = described(files, path)
    if about is None:
        if files.exists(f"{path}/runs") or files.exists(f"{path}/done"):
            raise ValueError(f"{path} holds versions of rows but does not say how they are keyed")
        return None
    schema = T.StructType.fromJson(about["schema"])
    if about["kind"] == "keyed":
        return KeyedTable(spark, path, schema, about["key"], about["order"], about["one_row_per_batch"])
    return CompactingTable(spark, path, schema, about["min_size"])


def open_table(spark, name):
    """Rows of a table: a folder where the name has a slash, otherwise a catalog table.

    Of a keyed table the last version of every key, of a compacting table published and pending rows, never the
    raw files of either.
    """
    if "/" not in name:
        return spark.table(name)
    table = stored_table(spark, name)
    if table is None:
        return spark.read.parquet(name)
    return table.latest() if isinstance(table, KeyedTable) else table.rows()


def open_events(spark, name):
    """Events of an event table of any layout: records, file layout or wide rows."""
    rows = open_table(spark, name)
    if "row_key" in rows.columns:
        return decode_events(rows)
    if isinstance(rows.schema["event_timestamp"].dataType, (T.TimestampType, T.TimestampNTZType)):
        return from_file_layout(rows)
    return events_by_name(rows)


def open_marts(spark, name):
    """Marts of a mart table of any layout."""
    rows = open_table(spark, name)
    return decode_marts(rows) if "row_key" in rows.columns else marts_by_name(rows)


def open_wide(spark, name, marts=False):
    """Wide rows for key lookups: of a salted table, with its salt, or of a keyed table of wide rows."""
    table = stored_table(spark, name)
    return table.latest() if table is not None else read_salted(spark, name, MART_WIDE_SCHEMA if marts else EVENT_WIDE_SCHEMA)
