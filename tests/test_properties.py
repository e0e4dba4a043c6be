from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.functions.csv_text import event_line, parse_events
from eventmart.functions.wide_rows import decode_events, encode_events
from eventmart.operators.mart import account_mart, merge_marts
from eventmart.schemas import EVENT_SCHEMA
from eventmart.storage.upsert import latest_per_key

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

text = st.text(st.characters(exclude_characters=",:\r\n", exclude_categories=["Cs"]), min_size=1, max_size=8)
cents = st.integers(0, 10**6).map(lambda n: n / 4)
events = st.tuples(
    st.sampled_from(["a", "b"]), st.sampled_from(["x", "y"]), st.integers(0, 2**42), text,
    st.sampled_from(["buy", "login", "logout", "win", "lose"]), cents,
    st.sampled_from(["credit", "debit", "paypal"]), text, cents, cents)
batches = st.lists(events, min_size=1, max_size=20)


@few
@given(rows=batches)
def test_text_and_wide_rows_lose_nothing(spark, rows):
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    assert rows_of(parse_events(df.select(event_line().alias("value")))) == rows_of(df)
    assert rows_of(decode_events(encode_events(df, 7))) == rows_of(df)


@few
@given(rows=batches, cut=st.integers(0, 20))
def test_mart_of_a_whole_is_the_merge_of_its_parts(spark, rows, cut):
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    parts = [account_mart(spark.createDataFrame(part, EVENT_SCHEMA)) for part in (rows[:cut], rows[cut:])]
    assert rows_of(merge_marts(*parts)) == rows_of(account_mart(df))


@few
@given(versions=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9)), min_size=1, max_size=30))
def test_last_version_matches_brute_force(spark, versions):
    rows = [(k, n, n * 2) for k, n in versions]
    df = spark.createDataFrame(rows, "key string, version long, value long")
    expected = sorted((k, max(n for key, n in versions if key == k)) for k in {k for k, _ in versions})
    for unique in (False, True):
        found = latest_per_key(df, ["key"], ["version"], one_row_per_order=unique)
        assert sorted((r.key, r.version) for r in found.collect()) == expected
        assert all(r.value == 2 * r.version for r in found.collect())
