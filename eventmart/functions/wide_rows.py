"""Salted row keys and string cells of the wide-row tables."""

from pyspark.sql import functions as F

from eventmart.functions.hashing import hash_of, java_string_hash
from eventmart.schemas import EVENT_CELLS, EVENT_COLUMNS, EVENT_SCHEMA, MART_CELLS, MART_COLUMNS, MART_SCHEMA

SALT_WIDTH = 4
TIMESTAMP_WIDTH = 11  # shorter timestamps are padded; 13-digit milliseconds stay whole


def _check_salts(num_salts):
    if not 1 <= num_salts <= 10 ** SALT_WIDTH:
        raise ValueError(f"num_salts must be between 1 and {10 ** SALT_WIDTH}")


def salt(account, num_salts):
    """Four-digit salt of an account: |hash mod n|."""
    _check_salts(num_salts)
    return F.lpad(F.abs(java_string_hash(account) % num_salts).cast("string"), SALT_WIDTH, "0")


def salt_of(account_id, num_salts):
    """The salt of one account id given as a Python string."""
    _check_salts(num_salts)
    return str(abs(hash_of(account_id)) % num_salts).zfill(SALT_WIDTH)


def _padded(timestamp):
    text = F.col(timestamp).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(TIMESTAMP_WIDTH)), F.lit("0"))


def joined_key(*parts):
    """Parts joined by colons. A missing part is an error: without it the others would shift."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    key = F.concat(*[x for c in columns for x in (F.lit(":"), c)][1:])
    return F.coalesce(key, F.raise_error(F.lit("null in a key part")).cast("string"))


def event_row_key(num_salts):
    return joined_key(
        salt("account_id", num_salts), "account_id", "app_id", _padded("event_timestamp"), "event_type", "event_id")


def mart_row_key(num_salts):
    return joined_key(salt("account_id", num_salts), "account_id", "app_id")


def mart_key_of(account_id, app_id, num_salts):
    """Row key of one mart, for a point lookup."""
    return ":".join([salt_of(account_id, num_salts), account_id, app_id])


def range_bound_of(account_id, app_id, timestamp, num_salts):
    """Smallest row key of an account and app at a time, for a range lookup."""
    return ":".join([mart_key_of(account_id, app_id, num_salts), str(timestamp).rjust(TIMESTAMP_WIDTH, "0")])


def _encode(df, key, cells, carry):
    return df.select(key.alias("row_key"), *[F.col(c).cast("string").alias(n) for n, c in cells.items()], *carry)


def encode_events(events, num_salts, carry=()):
    """Events as row key plus cells p, pt, s, lt, lg."""
    return _encode(events, event_row_key(num_salts), EVENT_CELLS, list(carry))


def encode_marts(marts, num_salts, carry=()):
    """Marts as row key plus cells s, w, l, pt, pct, pcc, pdt, pdc, ppt, ppc."""
    return _encode(marts, mart_row_key(num_salts), MART_CELLS, list(carry))


def _decode(df, schema, columns, key_parts, cells, carry=()):
    parts = F.split("row_key", ":")
    source = {name: parts[position] for name, position in key_parts.items()}
    source.update({column: F.col(cell) for cell, column in cells.items()})
    return df.select(*carry, *[source[c].cast(schema[c].dataType).alias(c) for c in columns])


def decode_events(rows, carry=()):
    """Row key and cells back to events, whatever their type."""
    key_parts = {"account_id": 1, "app_id": 2, "event_timestamp": 3, "event_type": 4, "event_id": 5}
    return _decode(rows, EVENT_SCHEMA, EVENT_COLUMNS, key_parts, EVENT_CELLS, list(carry))


def decode_marts(rows):
    """Row key and cells back to marts."""
    return _decode(rows, MART_SCHEMA, MART_COLUMNS, {"account_id": 1, "app_id": 2}, MART_CELLS)
