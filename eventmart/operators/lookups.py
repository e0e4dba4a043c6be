"""Point and time-range reads. All are filters that reach the scan; `None` leaves a side open."""

from pyspark.sql import functions as F

from eventmart.functions.wide_rows import (
    SALT_WIDTH, decode_events, decode_marts, mart_key_of, range_bound_of, salt, salt_of,
)


def mart_of(marts, account_id, app_id):
    """The mart of one account and app: no row or one row."""
    return marts.where((F.col("account_id") == account_id) & (F.col("app_id") == app_id))


def marts_of_account(marts, account_id):
    return marts.where(F.col("account_id") == account_id)


def events_of_account(events, account_id):
    return events.where(F.col("account_id") == account_id)


def events_between(events, account_id, start=None, end=None):
    """Events of an account strictly between two times."""
    found = events_of_account(events, account_id)
    if start is not None:
        found = found.where(F.col("event_timestamp") > start)
    if end is not None:
        found = found.where(F.col("event_timestamp") < end)
    return found


def _with_salt(rows, account_id, num_salts):
    """Prune to the salt folder where the table has one."""
    return rows.where(F.col("salt") == salt_of(account_id, num_salts)) if "salt" in rows.columns else rows


def event_rows_in_range(rows, account_id, app_id, num_salts, start=None, end=None):
    """Wide event rows of an account and app with time in [start, end), in row-key order."""
    key, stem = F.col("row_key"), mart_key_of(account_id, app_id, num_salts)
    # `;` follows the separator `:`, so it bounds all keys of the account and app
    low = f"{stem}:" if start is None else range_bound_of(account_id, app_id, start, num_salts)
    high = f"{stem};" if end is None else range_bound_of(account_id, app_id, end, num_salts)
    return _with_salt(rows, account_id, num_salts).where((key >= low) & (key < high)).orderBy("row_key")


def events_in_range(rows, account_id, app_id, num_salts, start=None, end=None):
    """`event_rows_in_range` decoded to events."""
    return decode_events(event_rows_in_range(rows, account_id, app_id, num_salts, start, end))


def mart_by_row_key(rows, account_id, app_id, num_salts):
    """Point read of a wide mart row, decoded."""
    found = _with_salt(rows, account_id, num_salts)
    return decode_marts(found.where(F.col("row_key") == mart_key_of(account_id, app_id, num_salts)))


def region_of(row_key, num_salts, regions):
    """Region number of a row: salts are dealt out to `regions` contiguous ranges."""
    if not 1 <= regions <= num_salts:
        raise ValueError("regions must be between 1 and num_salts")
    salt_number = F.substring(row_key, 1, SALT_WIDTH).cast("int")
    per_region = num_salts // regions
    return F.least(F.lit(regions - 1), F.floor(salt_number / per_region).cast("int"))


def events_for_requests(rows, requests, num_salts):
    """Events of many requests at once, decoded, each with its `request_id`: [start, end) of one account and app per request.

    `rows` is a table of wide event rows with a folder per salt, `requests` has request_id, account_id, app_id, start and
    end, where a null bound leaves that side open. Both meet on salt, account and app, so the salts that no request has are not
    opened (pruning by the requests' own salts at run time) and a row meets the requests of its own key only.
    """
    wanted = requests.select(
        "request_id", F.col("account_id").alias("of_account"), F.col("app_id").alias("of_app"), "start", "end", salt("account_id", num_salts).alias("salt"))
    cells = F.split("row_key", ":")
    keyed = rows.withColumns({"of_account": cells[1], "of_app": cells[2], "at": cells[3].cast("long")})
    met = keyed.join(wanted, ["salt", "of_account", "of_app"])
    met = met.where((F.col("start").isNull() | (F.col("at") >= F.col("start"))) & (F.col("end").isNull() | (F.col("at") < F.col("end"))))
    return decode_events(met, ["request_id"])
