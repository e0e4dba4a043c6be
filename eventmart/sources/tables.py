"""Batch readers."""

from eventmart.schemas import EVENT_COLUMNS, MART_COLUMNS


def scan_table(spark, path=None, view=None, fmt="parquet", schema=None, **options):
    """Load any Spark source, optionally as a temporary view."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path) if path else reader.load()
    if view:
        rows.createOrReplaceTempView(view)
    return rows


def events_by_name(rows):
    """Event columns of a table in record order, whatever else it holds."""
    return rows.select(*EVENT_COLUMNS)


def marts_by_name(rows):
    """Mart columns of a table in record order."""
    return rows.select(*MART_COLUMNS)


def text_lines(spark, path):
    """Lines of a text file, or of every file in a folder, as `value`."""
    return spark.read.text(path)
