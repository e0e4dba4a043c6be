"""Comma-separated event and mart lines: no header, no quoting, extra cells ignored."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import EVENT_COLUMNS, EVENT_SCHEMA, MART_COLUMNS, MART_SCHEMA

EVENT_OUTCOME, REJECT_OUTCOME = "event", "reject"


def _cell(i, field):
    """A cell as its type, or null. A whole number has no blanks around it; a double may have."""
    cell = F.get("_cells", F.lit(i))
    value = cell.try_cast(field.dataType)
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        return F.when(~cell.rlike(r"\s"), value)
    return value


def _typed(lines, schema, column, carry):
    # Exploding a one-element array keeps the optimizer from splitting the line once per cell.
    cells = lines.select(*carry, F.explode(F.array(F.split(column, ","))).alias("_cells"))
    typed = cells.select(
        *carry, "_cells",
        *[_cell(i, f).alias(f.name) for i, f in enumerate(schema)],
    )
    complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in schema.names])
    return typed, complete


def _parse(lines, schema, column, carry):
    typed, complete = _typed(lines, schema, column, carry)
    message = F.concat(F.lit("malformed line: "), F.coalesce(F.array_join("_cells", ","), F.lit("null")))
    checked = typed.where(F.when(complete, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*carry, *schema.names)


def _outcomes(lines, schema, column, carry):
    typed, complete = _typed(lines, schema, column, carry)
    outcome = F.when(complete, EVENT_OUTCOME).otherwise(REJECT_OUTCOME)
    return typed.select(*carry, F.array_join("_cells", ",").alias(column), outcome.alias("outcome"), *schema.names)


def _quarantine(lines, schema, column, carry):
    rows = _outcomes(lines, schema, column, carry)
    good = rows.where(F.col("outcome") == EVENT_OUTCOME).select(*carry, *schema.names)
    return good, rows.where(F.col("outcome") == REJECT_OUTCOME).select(*carry, column)


def parse_events(lines, column="value", carry=()):
    """CSV lines to events. A short line or an unreadable number fails the job."""
    return _parse(lines, EVENT_SCHEMA, column, list(carry))


def parse_events_quarantine(lines, column="value", carry=()):
    """CSV lines to (events, rejected lines); nothing fails and nothing is lost."""
    return _quarantine(lines, EVENT_SCHEMA, column, list(carry))


def parse_events_outcomes(lines, column="value", carry=()):
    """CSV lines with their `outcome` (event or reject) and the events' columns, in one pass over the lines: to
    be written once, partitioned by outcome, where both sides are wanted."""
    return _outcomes(lines, EVENT_SCHEMA, column, list(carry))


def parse_marts(lines, column="value", carry=()):
    """CSV lines to marts. A short line or an unreadable number fails the job."""
    return _parse(lines, MART_SCHEMA, column, list(carry))


def parse_marts_quarantine(lines, column="value", carry=()):
    """CSV lines to (marts, rejected lines)."""
    return _quarantine(lines, MART_SCHEMA, column, list(carry))


def _line(columns, cells):
    return F.concat_ws(",", *[F.coalesce(cells.get(c, F.col(c)).cast("string"), F.lit("null")) for c in columns])


def event_line(cells=None):
    """An event as one CSV line. `cells` replaces the text of columns."""
    return _line(EVENT_COLUMNS, cells or {})


def mart_line():
    """A mart as one CSV line."""
    return _line(MART_COLUMNS, {})
