"""UTC calendar parts of epoch milliseconds, the same in every session time zone."""

from pyspark.sql import functions as F

DAY_MS = 86_400_000


def _ms(column):
    return F.col(column) if isinstance(column, str) else column


def _ms_of_day(column):
    return F.pmod(_ms(column), F.lit(DAY_MS))


def utc_date(column):
    days = ((_ms(column) - _ms_of_day(column)) / F.lit(DAY_MS)).cast("int")
    return F.date_from_unix_date(days)


def utc_hour(column):
    return F.floor(_ms_of_day(column) / F.lit(3_600_000)).cast("int")


def _two_digits(value):
    return F.lpad(value.cast("string"), 2, "0")


def utc_seconds_text(column):
    """yyyy-MM-ddTHH:mm:ssZ with the fraction of a second cut off."""
    seconds = F.floor(_ms_of_day(column) / F.lit(1000))
    return F.concat(
        utc_date(column).cast("string"), F.lit("T"), _two_digits(utc_hour(column)), F.lit(":"),
        _two_digits(F.floor(seconds / 60) % 60), F.lit(":"), _two_digits(seconds % 60), F.lit("Z"),
    )
