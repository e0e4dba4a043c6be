"""SQL fragments shared by the oracles."""

EVENTS = """
app_event AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 12 AS VARCHAR) AS app_id,
    epoch_us(ts) // 1000 AS event_timestamp,
    CAST(event_id AS VARCHAR) AS event_id,
    CASE e.event_type WHEN 'purchase' THEN 'buy' WHEN 'signup' THEN 'login' WHEN 'click' THEN 'win'
      WHEN 'error' THEN 'lose' ELSE 'logout' END AS event_type,
    CASE WHEN e.event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS purchase,
    CASE e.event_id % 3 WHEN 0 THEN 'credit' WHEN 1 THEN 'debit' ELSE 'paypal' END AS payment_type,
    CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
    CAST(37 AS DOUBLE) + CAST(e.event_id % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS latitude,
    CAST(-122 AS DOUBLE) - CAST(user_id % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS longitude
  FROM events e)"""

DELTAS = """
delta AS (
  SELECT account_id, app_id,
    CAST(event_type = 'login' AS BIGINT) AS sign_on_count,
    CAST(event_type = 'win' AS BIGINT) AS win_count,
    CAST(event_type = 'lose' AS BIGINT) AS lose_count,
    purchase AS purchase_total,
    CASE WHEN payment_type = 'credit' THEN purchase ELSE CAST(0 AS DOUBLE) END AS payment_credit_total,
    CAST(payment_type = 'credit' AS BIGINT) AS payment_credit_count,
    CASE WHEN payment_type = 'debit' THEN purchase ELSE CAST(0 AS DOUBLE) END AS payment_debit_total,
    CAST(payment_type = 'debit' AS BIGINT) AS payment_debit_count,
    CASE WHEN payment_type = 'paypal' THEN purchase ELSE CAST(0 AS DOUBLE) END AS payment_paypal_total,
    CAST(payment_type = 'paypal' AS BIGINT) AS payment_paypal_count
  FROM app_event)"""


def marts(source="delta", name="mart", factor=1):
    """The mart as a common table expression, totals rounded to cents."""
    def count(c):
        return f"CAST(sum({c}) * {factor} AS BIGINT) AS {c}"

    def total(c):
        return f"round(sum({c}) * {factor}, 2) AS {c}"

    columns = [
        count("sign_on_count"), count("win_count"), count("lose_count"), total("purchase_total"),
        total("payment_credit_total"), count("payment_credit_count"),
        total("payment_debit_total"), count("payment_debit_count"),
        total("payment_paypal_total"), count("payment_paypal_count"),
    ]
    return f"{name} AS (SELECT account_id, app_id, {', '.join(columns)} FROM {source} GROUP BY account_id, app_id)"


def hash_sql(column):
    """The polynomial string hash; a character above the basic plane counts as two surrogates."""
    point = "unicode(ch)"
    step = f"""CASE WHEN {point} < 65536 THEN (h * 31 + {point}) & 4294967295
      ELSE (((h * 31 + 55296 + (({point} - 65536) >> 10)) & 4294967295) * 31
            + 56320 + (({point} - 65536) & 1023)) & 4294967295 END"""
    step = step.replace(point, "ch")
    points = f"list_transform(string_split({column}, ''), lambda c: CAST(unicode(c) AS BIGINT))"
    fold = f"list_reduce(list_prepend(CAST(0 AS BIGINT), {points}), lambda h, ch: {step})"
    fold = f"CASE WHEN {column} = '' THEN 0 ELSE {fold} END"
    return f"CAST(CASE WHEN ({fold}) >= 2147483648 THEN ({fold}) - 4294967296 ELSE ({fold}) END AS INTEGER)"


def salt_sql(column, num_salts):
    return f"lpad(CAST(abs({hash_sql(column)} % {num_salts}) AS VARCHAR), 4, '0')"


def event_key_sql(num_salts):
    stamp = "CAST(event_timestamp AS VARCHAR)"
    padded = f"lpad({stamp}, CAST(greatest(11, length({stamp})) AS INTEGER), '0')"
    return (f"{salt_sql('account_id', num_salts)} || ':' || account_id || ':' || app_id || ':' || {padded}"
            " || ':' || event_type || ':' || event_id")


def mart_key_sql(num_salts):
    return f"{salt_sql('account_id', num_salts)} || ':' || account_id || ':' || app_id"


def with_events(body, *more):
    return "WITH " + ", ".join([EVENTS, *more]) + "\n" + body


def with_marts(body, *more):
    return with_events(body, DELTAS, marts(), *more)
