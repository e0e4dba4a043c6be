"""Scans, codecs, marts, sums, lookups, keys and documents."""

from pyspark.sql import functions as F

from eventmart.functions.csv_text import (
    event_line, mart_line, parse_events, parse_events_outcomes, parse_marts,
)
from eventmart.functions.documents import as_json, as_xml, dynamic_fields, event_documents, field_names, from_xml, variant_documents
from eventmart.functions.hashing import java_string_hash_text
from eventmart.functions.wide_rows import (
    decode_events, decode_marts, encode_events, encode_marts, event_row_key, mart_row_key, salt,
)
from eventmart.operators import mart, moments, publish, stats, sums
from eventmart.plans import oracle
from eventmart.plans.registry import query
from eventmart.schemas import BUY, CREDIT, DEBIT, EVENT_COLUMNS, EVENT_SCHEMA, MART_CELLS, MART_KEY, MART_TOTALS, PAYPAL
from eventmart.session import work_dir
from eventmart.sources.adapter import app_events, document_lines
from eventmart.sources.tables import events_by_name, marts_by_name, scan_table
from eventmart.storage.layouts import to_file_layout
from eventmart.storage.salted import salt_region_counts

# Parameters of the registered queries.
NUM_SALTS, REGIONS = 6, 6
ACCOUNT, APP = "8", "3"
START, END = 1704499200000, 1705795200000


def cents(marts):
    """Totals rounded for comparison; the operators themselves do not round."""
    return marts.select(*[F.round(c, 2).alias(c) if c in MART_TOTALS else F.col(c) for c in marts.columns])


def marts_of(spark, sf_dir, account_id=None):
    return mart.account_mart(app_events(spark, sf_dir, account_id))


def rounded_marts(spark, sf_dir):
    return cents(marts_of(spark, sf_dir))


# --- scans and marts -------------------------------------------------------------------------------

@query("account_mart", oracle.with_marts("SELECT * FROM mart"))
def account_mart(spark, sf_dir):
    return rounded_marts(spark, sf_dir)


@query("scan_event_table", oracle.with_events("SELECT * FROM app_event"))
def scan_event_table(spark, sf_dir):
    """The events stored with their columns turned round, scanned into a view."""
    path = work_dir(spark, "scan")
    app_events(spark, sf_dir).select(*reversed(EVENT_COLUMNS)).write.parquet(path)
    return events_by_name(scan_table(spark, path, view="scanned_events"))


@query("scan_mart_table", oracle.with_marts("SELECT * FROM mart"))
def scan_mart_table(spark, sf_dir):
    path = work_dir(spark, "scan")
    marts = rounded_marts(spark, sf_dir)
    marts.select(*reversed(marts.columns)).write.parquet(path)
    return marts_by_name(scan_table(spark, path))


@query("event_file_layout", oracle.with_events(
    "SELECT * REPLACE (make_timestamp(event_timestamp * 1000) AS event_timestamp) FROM app_event"))
def event_file_layout(spark, sf_dir):
    layout = to_file_layout(app_events(spark, sf_dir))
    return layout.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@query("event_to_mart_delta", oracle.with_events("SELECT * FROM delta", oracle.DELTAS))
def event_to_mart_delta(spark, sf_dir):
    return mart.event_deltas(app_events(spark, sf_dir))


@query("mart_merge", oracle.with_marts("SELECT * FROM mart"))
def mart_merge(spark, sf_dir):
    """The marts of three kinds of payment, whose keys differ, merged."""
    events = app_events(spark, sf_dir)
    return cents(mart.merge_marts(*[mart.account_mart(events.where(F.col("payment_type") == p)) for p in (CREDIT, DEBIT, PAYPAL)]))


@query("pending_union_new", oracle.with_events("SELECT * FROM app_event UNION ALL SELECT * FROM app_event"))
def pending_union_new(spark, sf_dir):
    events = app_events(spark, sf_dir)
    return events.unionByName(events.select(*reversed(EVENT_COLUMNS)))


# --- sums ------------------------------------------------------------------------------------------

WINS = "SELECT account_id, CAST(sum(win_count) AS BIGINT) AS win_count FROM mart GROUP BY account_id"


@query("wins_per_account", oracle.with_marts(WINS))
def wins_per_account(spark, sf_dir):
    return sums.wins_per_account(marts_of(spark, sf_dir))


@query("wins_per_account_100", oracle.with_marts(WINS + " ORDER BY account_id LIMIT 100"))
def wins_per_account_100(spark, sf_dir):
    return sums.first_accounts(wins_per_account(spark, sf_dir))


@query("purchases_per_account", oracle.with_events(
    "SELECT account_id, round(sum(purchase), 2) AS purchase FROM app_event GROUP BY account_id"))
def purchases_per_account(spark, sf_dir):
    return sums.purchases_per_account(app_events(spark, sf_dir)).withColumn("purchase", F.round("purchase", 2))


# --- text codecs and publishing --------------------------------------------------------------------

@query("event_csv_roundtrip", oracle.with_events("SELECT * FROM app_event"))
def event_csv_roundtrip(spark, sf_dir):
    return parse_events(app_events(spark, sf_dir).select(event_line().alias("value")))


@query("mart_csv_roundtrip", oracle.with_marts("SELECT * FROM mart"))
def mart_csv_roundtrip(spark, sf_dir):
    return parse_marts(rounded_marts(spark, sf_dir).select(mart_line().alias("value")))


EVENT_LINE_SQL = """concat_ws(',', account_id, app_id, event_timestamp, event_id, event_type,
  purchase, payment_type, session_id, latitude, longitude)"""


@query("event_publish_records", oracle.with_events(
    f"SELECT account_id AS key, {EVENT_LINE_SQL} AS value FROM app_event"))
def event_publish_records(spark, sf_dir):
    return publish.event_records(app_events(spark, sf_dir))


LINES = "lines AS (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\n|\\r')) AS line FROM documents)"


@query("line_publish_records", f"""WITH {LINES}
    SELECT CAST({oracle.hash_sql('line')} AS VARCHAR) AS key, line AS value FROM lines
    WHERE NOT starts_with(line, 'vendor_name')
      AND length(line) + length(regexp_replace(line, '[\\x{{0}}-\\x{{FFFF}}]', '', 'g')) >= 10""")
def line_publish_records(spark, sf_dir):
    return publish.line_records(document_lines(spark, sf_dir))


BLANK_LINE_SQL = EVENT_LINE_SQL.replace("event_timestamp", "' ' || event_timestamp")


OUTCOMES_SQL = f"""SELECT * FROM (
    SELECT line AS value, CASE WHEN len(cells) >= 10 AND TRY_CAST(cells[3] AS BIGINT) IS NOT NULL AND NOT regexp_matches(cells[3], '\\s')
        AND TRY_CAST(cells[6] AS DOUBLE) IS NOT NULL AND TRY_CAST(cells[9] AS DOUBLE) IS NOT NULL
        AND TRY_CAST(cells[10] AS DOUBLE) IS NOT NULL THEN 'event' ELSE 'reject' END AS outcome
    FROM (SELECT line, string_split(line, ',') AS cells
          FROM (SELECT {EVENT_LINE_SQL} AS line FROM app_event UNION ALL SELECT line FROM lines
                UNION ALL SELECT {BLANK_LINE_SQL} FROM app_event WHERE event_type = 'buy')))"""


def mixed_lines(spark, sf_dir):
    """Event lines mixed with the lines of all documents and with lines whose whole numbers have blanks."""
    events = app_events(spark, sf_dir)
    blank = events.where(F.col("event_type") == BUY).select(
        event_line({"event_timestamp": F.concat(F.lit(" "), F.col("event_timestamp").cast("string"))}).alias("value"))
    return events.select(event_line().alias("value")).unionByName(document_lines(spark, sf_dir)).unionByName(blank)


@query("event_csv_quarantine", oracle.with_events(OUTCOMES_SQL, LINES))
def event_csv_quarantine(spark, sf_dir):
    return parse_events_outcomes(mixed_lines(spark, sf_dir)).select("value", "outcome")


@query("java_string_hash", f"SELECT doc_id, {oracle.hash_sql('text')} AS hash FROM documents")
def java_string_hash_query(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", java_string_hash_text("text").alias("hash"))


# --- salted keys and wide rows ---------------------------------------------------------------------

@query("event_row_keys", oracle.with_events(f"""
    SELECT event_id, {oracle.salt_sql('account_id', NUM_SALTS)} AS salt,
      {oracle.event_key_sql(NUM_SALTS)} AS row_key FROM app_event"""))
def event_row_keys(spark, sf_dir):
    return app_events(spark, sf_dir).select(
        "event_id", salt("account_id", NUM_SALTS).alias("salt"), event_row_key(NUM_SALTS).alias("row_key"))


@query("mart_row_keys", oracle.with_marts(f"""
    SELECT account_id, app_id, {oracle.mart_key_sql(NUM_SALTS)} AS row_key FROM mart"""))
def mart_row_keys(spark, sf_dir):
    return marts_of(spark, sf_dir).select(*MART_KEY, mart_row_key(NUM_SALTS).alias("row_key"))


EVENT_CELLS_SQL = f"""SELECT {oracle.event_key_sql(NUM_SALTS)} AS row_key, CAST(purchase AS VARCHAR) AS p,
  payment_type AS pt, session_id AS s, CAST(latitude AS VARCHAR) AS lt, CAST(longitude AS VARCHAR) AS lg
  FROM app_event"""


@query("event_wide_cells", oracle.with_events(EVENT_CELLS_SQL))
def event_wide_cells(spark, sf_dir):
    return encode_events(app_events(spark, sf_dir), NUM_SALTS)


# Totals are compared as numbers: engines write large ones differently.
MART_TOTAL_CELLS = [cell for cell, column in MART_CELLS.items() if column in MART_TOTALS]


@query("mart_wide_cells", oracle.with_marts(
    f"SELECT {oracle.mart_key_sql(NUM_SALTS)} AS row_key, " + ", ".join(
        f"{column} AS {cell}" if cell in MART_TOTAL_CELLS else f"CAST({column} AS VARCHAR) AS {cell}"
        for cell, column in MART_CELLS.items()) + " FROM mart"))
def mart_wide_cells(spark, sf_dir):
    cells = encode_marts(rounded_marts(spark, sf_dir), NUM_SALTS)
    return cells.withColumns({c: F.col(c).cast("double") for c in MART_TOTAL_CELLS})


@query("event_wide_roundtrip", oracle.with_events("SELECT * FROM app_event"))
def event_wide_roundtrip(spark, sf_dir):
    return decode_events(event_wide_cells(spark, sf_dir))


@query("mart_wide_roundtrip", oracle.with_marts("SELECT * FROM mart"))
def mart_wide_roundtrip(spark, sf_dir):
    return decode_marts(encode_marts(rounded_marts(spark, sf_dir), NUM_SALTS))


@query("salt_region_counts", oracle.with_events(f"""
    SELECT salt, least({REGIONS - 1}, CAST(salt AS INTEGER) // ({NUM_SALTS} // {REGIONS})) AS region,
      count(*) AS rows
    FROM (SELECT {oracle.salt_sql('account_id', NUM_SALTS)} AS salt FROM app_event) GROUP BY ALL"""))
def salt_region_counts_query(spark, sf_dir):
    return salt_region_counts(event_wide_cells(spark, sf_dir), NUM_SALTS, REGIONS)


# --- documents -------------------------------------------------------------------------------------

DOCUMENTS_SQL = """SELECT event_type || ':' || event_id AS id, account_id, app_id,
  strftime(make_timestamp(event_timestamp * 1000), '%Y-%m-%dT%H:%M:%SZ') AS event_time_stamp,
  event_id, event_type, purchase, payment_type, session_id, latitude, longitude FROM app_event"""


@query("event_search_docs", oracle.with_events(DOCUMENTS_SQL))
def event_search_docs(spark, sf_dir):
    return event_documents(app_events(spark, sf_dir))


def _string_fields_sql(*columns):
    return ", ".join(
        f"CASE WHEN instr({c}, ' ') = 0 THEN {c} END AS {c}_s, CASE WHEN instr({c}, ' ') > 0 THEN {c} END AS {c}_t"
        for c in columns)


@query("dynamic_field_docs", f"""
    SELECT CAST(doc_id AS VARCHAR) AS id, doc_id AS doc_id_l, {_string_fields_sql('text', 'source')},
      lang AS lang_s, n_chars AS n_chars_l FROM documents""")
def dynamic_field_docs(spark, sf_dir):
    return dynamic_fields(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", {"lang": "_s"})


@query("dynamic_field_orders", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS o_orderkey_l, o_custkey AS o_custkey_l,
      {_string_fields_sql('o_orderstatus', 'o_orderpriority')}, o_totalprice AS o_totalprice_d,
      o_orderdate AS o_orderdate_tdt FROM orders""")
def dynamic_field_orders(spark, sf_dir):
    return dynamic_fields(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderkey")


@query("mart_json", oracle.with_marts("SELECT * FROM mart"))
def mart_json(spark, sf_dir):
    """Rows as JSON, parsed again: engines write large numbers differently."""
    marts = rounded_marts(spark, sf_dir)
    return as_json(marts).select(F.from_json("json", marts.schema).alias("mart")).select("mart.*")


@query("event_xml_roundtrip", oracle.with_events("SELECT * FROM app_event"))
def event_xml_roundtrip(spark, sf_dir):
    """Events as XML elements, parsed again."""
    return from_xml(as_xml(app_events(spark, sf_dir), "appEvent"), EVENT_SCHEMA, "appEvent")


@query("mart_xml_roundtrip", oracle.with_marts("SELECT * FROM mart"))
def mart_xml_roundtrip(spark, sf_dir):
    marts = rounded_marts(spark, sf_dir)
    return from_xml(as_xml(marts, "accountMart"), marts.schema, "accountMart")


def _variant_fields(documents, **fields):
    """The names of each document's fields and the values of some."""
    values = [F.variant_get("document", f"$.{name}", kind).alias(name) for name, kind in fields.items()]
    return documents.select("id", F.array_join(field_names(), ",").alias("fields"), *values)


def _present_sql(*cases):
    return f"array_to_string(list_sort(list_filter([{', '.join(cases)}], lambda f: f IS NOT NULL)), ',') AS fields"


def _string_name_sql(c):
    return f"CASE WHEN instr({c}, ' ') > 0 THEN '{c}_t' WHEN {c} IS NOT NULL THEN '{c}_s' END"


def _name_sql(c, suffix):
    return f"CASE WHEN {c} IS NOT NULL THEN '{c}{suffix}' END"


@query("variant_field_docs", f"""
    SELECT CAST(doc_id AS VARCHAR) AS id,
      {_present_sql(_name_sql('doc_id', '_l'), _string_name_sql('text'), _string_name_sql('source'), _name_sql('lang', '_s'), _name_sql('n_chars', '_l'))},
      doc_id AS doc_id_l, {_string_fields_sql('text', 'source')}, lang AS lang_s, n_chars AS n_chars_l FROM documents""")
def variant_field_docs(spark, sf_dir):
    documents = variant_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", {"lang": "_s"})
    return _variant_fields(documents, doc_id_l="long", text_s="string", text_t="string", source_s="string", source_t="string", lang_s="string", n_chars_l="long")


@query("variant_field_orders", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id,
      {_present_sql(_name_sql('o_orderkey', '_l'), _name_sql('o_custkey', '_l'), _string_name_sql('o_orderstatus'), _string_name_sql('o_orderpriority'),
                    _name_sql('o_totalprice', '_d'), _name_sql('o_orderdate', '_tdt'))},
      o_orderkey AS o_orderkey_l, o_custkey AS o_custkey_l, {_string_fields_sql('o_orderstatus', 'o_orderpriority')}, o_totalprice AS o_totalprice_d
    FROM orders""")
def variant_field_orders(spark, sf_dir):
    documents = variant_documents(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderkey")
    return _variant_fields(documents, o_orderkey_l="long", o_custkey_l="long", o_orderstatus_s="string", o_orderstatus_t="string",
                           o_orderpriority_s="string", o_orderpriority_t="string", o_totalprice_d="double")


# --- statistics ------------------------------------------------------------------------------------

@query("mart_features", oracle.with_marts(
    "SELECT account_id, app_id, " + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in stats.FEATURES) + " FROM mart"))
def mart_features(spark, sf_dir):
    return stats.features(rounded_marts(spark, sf_dir))


def _column_stats_sql(f):
    return f"""SELECT '{f}' AS feature, count({f}) AS count, round(avg({f}), 6) AS mean,
      round(var_samp({f}), 6) AS variance, CAST(min({f}) AS DOUBLE) AS min, CAST(max({f}) AS DOUBLE) AS max,
      count(*) FILTER ({f} <> 0) AS num_nonzeros, round(CAST(sum(abs({f})) AS DOUBLE), 6) AS norm_l1,
      round(sqrt(CAST(sum({f} * {f}) AS DOUBLE)), 6) AS norm_l2 FROM mart"""


@query("mart_column_stats", oracle.with_marts(" UNION ALL ".join(map(_column_stats_sql, stats.FEATURES))))
def mart_column_stats(spark, sf_dir):
    table = stats.column_stats(stats.features(rounded_marts(spark, sf_dir)))
    rounded = {c: F.round(c, 6) for c in ["mean", "variance", "norm_l1", "norm_l2"]}
    return table.withColumns(rounded)


def _correlation_sql(a, b):
    value = f"CAST(least(count({a}), 1) AS DOUBLE)" if a == b else f"round(corr({a}, {b}), 6)"
    return f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, {value} AS corr FROM mart"


@query("mart_correlation", oracle.with_marts(
    " UNION ALL ".join(_correlation_sql(a, b) for a in stats.FEATURES for b in stats.FEATURES)))
def mart_correlation(spark, sf_dir):
    table = stats.correlation(stats.features(rounded_marts(spark, sf_dir)))
    return table.withColumn("corr", F.round("corr", 6))


def _merged_moments(spark, sf_dir):
    """The marts' moments, left behind by three parts of them and merged."""
    table = moments.moment_table(spark, work_dir(spark, "moments"))
    rows = stats.features(rounded_marts(spark, sf_dir))
    for part in range(3):
        here = rows.where(F.pmod(F.xxhash64("account_id", "app_id"), F.lit(3)) == part)
        table.write(moments.moments(here, f"part{part}"), part)
    return moments.merged(table.latest())


@query("mart_merged_stats", oracle.with_marts(" UNION ALL ".join(map(_column_stats_sql, stats.FEATURES))))
def mart_merged_stats(spark, sf_dir):
    table = moments.stats_of(_merged_moments(spark, sf_dir))
    return table.withColumns({c: F.round(c, 6) for c in ["mean", "variance", "norm_l1", "norm_l2"]})


@query("mart_merged_correlation", oracle.with_marts(
    " UNION ALL ".join(_correlation_sql(a, b) for a in stats.FEATURES for b in stats.FEATURES)))
def mart_merged_correlation(spark, sf_dir):
    return moments.correlation_of(_merged_moments(spark, sf_dir)).withColumn("corr", F.round("corr", 6))
