"""Record layouts shared by every reader, operator and sink."""

from pyspark.sql import types as T

# The event and mart records, in the order of their CSV cells.
EVENT_SCHEMA = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),  # epoch milliseconds
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("purchase", T.DoubleType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

MART_SCHEMA = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("sign_on_count", T.LongType()),
    T.StructField("win_count", T.LongType()),
    T.StructField("lose_count", T.LongType()),
    T.StructField("purchase_total", T.DoubleType()),
    T.StructField("payment_credit_total", T.DoubleType()),
    T.StructField("payment_credit_count", T.LongType()),
    T.StructField("payment_debit_total", T.DoubleType()),
    T.StructField("payment_debit_count", T.LongType()),
    T.StructField("payment_paypal_total", T.DoubleType()),
    T.StructField("payment_paypal_count", T.LongType()),
])

# Column order of the Parquet event table, whose timestamp is a TIMESTAMP.
EVENT_FILE_COLUMNS = [
    "account_id", "app_id", "event_id", "event_type", "event_timestamp",
    "purchase", "payment_type", "session_id", "latitude", "longitude",
]

EVENT_FILE_SCHEMA = T.StructType([
    T.StructField(c, T.TimestampType()) if c == "event_timestamp" else EVENT_SCHEMA[c] for c in EVENT_FILE_COLUMNS
])

EVENT_COLUMNS = EVENT_SCHEMA.names
MART_COLUMNS = MART_SCHEMA.names
EVENT_KEY = ["account_id", "app_id", "event_timestamp", "event_id", "event_type"]
MART_KEY = ["account_id", "app_id"]
MART_MEASURES = [c for c in MART_COLUMNS if c not in MART_KEY]
MART_TOTALS = [c for c in MART_MEASURES if c.endswith("_total")]

# Event and payment names.
BUY, LOGIN, LOGOUT, WIN, LOSE = "buy", "login", "logout", "win", "lose"
CREDIT, DEBIT, PAYPAL = "credit", "debit", "paypal"

# Order of the numeric mart features.
FEATURES = [
    "purchase_total", "lose_count", "win_count", "sign_on_count",
    "payment_credit_count", "payment_credit_total",
    "payment_debit_count", "payment_debit_total",
    "payment_paypal_count", "payment_paypal_total",
]

# Cell names of the wide-row tables, mapped to the record columns.
EVENT_CELLS = {
    "p": "purchase", "pt": "payment_type", "s": "session_id", "lt": "latitude", "lg": "longitude",
}
MART_CELLS = {
    "s": "sign_on_count", "w": "win_count", "l": "lose_count", "pt": "purchase_total",
    "pct": "payment_credit_total", "pcc": "payment_credit_count",
    "pdt": "payment_debit_total", "pdc": "payment_debit_count",
    "ppt": "payment_paypal_total", "ppc": "payment_paypal_count",
}


def wide_schema(cells):
    """Schema of a wide-row table: the row key and its string cells."""
    return T.StructType([T.StructField(n, T.StringType()) for n in ["row_key", *cells]])


EVENT_WIDE_SCHEMA = wide_schema(EVENT_CELLS)
MART_WIDE_SCHEMA = wide_schema(MART_CELLS)

# The search document.
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("account_id", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("event_time_stamp", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("purchase", T.DoubleType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# Where a record lies in its topic. Offsets of different topics or partitions do not compare, so the time at which
# the broker took a record ranks first.
COORDINATE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
])
COORDINATES = COORDINATE_SCHEMA.names
