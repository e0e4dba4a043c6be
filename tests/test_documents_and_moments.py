"""Variant documents, XML, statistics that add up, and lookups of many requests at once."""

import math
import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from eventmart.functions.documents import as_xml, field_names, from_xml, variant_documents
from eventmart.functions.wide_rows import encode_events
from eventmart.operators import lookups, moments, stats
from eventmart.schemas import EVENT_SCHEMA, EVENT_WIDE_SCHEMA
from eventmart.storage.salted import read_salted, write_salted


def documents_of(spark, schema, rows, **options):
    found = variant_documents(spark.createDataFrame(rows, schema), "id", **options)
    return {r.id: (r.fields, r.document) for r in found.select("id", field_names().alias("fields"), F.to_json("document").alias("document")).collect()}


def test_documents_hold_what_is_there(spark):
    got = documents_of(spark, "id string, name string, n int, x double, ok boolean, day date, tags array<string>, raw binary", [
        ("1", "one", 5, 0.5, True, None, ["a"], b"x"), ("2", "one two", None, None, None, None, None, None)], overrides={"tags": "_ss"})
    assert got["1"][0] == ["id_s", "n_i", "name_s", "ok_b", "x_d"] and got["2"] == (["id_s", "name_t"], '{"id_s":"2","name_t":"one two"}')


def test_structs_and_maps_are_fields(spark):
    got = documents_of(spark, "id string, s struct<a: string, b: struct<c: bigint>>, m map<string, string>, k map<string, int>, o map<int, string>, d map<string, array<int>>", [
        ("1", ("p q", (7,)), {"u": "v", "w": "x y", "z": None}, {"n": 3}, {1: "x"}, {"g": [1]}), ("2", None, None, None, None, None)])
    assert got["1"][0] == ["a_t", "c_l", "id_s", "n_i", "u_s", "w_t"] and got["2"][0] == ["id_s"]


def test_the_later_of_two_fields_of_one_name_counts(spark):
    got = documents_of(spark, "id string, a string, m map<string, string>", [("1", "first", {"a": "second"}), ("2", "first", {"a": "sec ond"})])
    assert got["1"][1] == '{"a_s":"second","id_s":"1"}' and got["2"][0] == ["a_s", "a_t", "id_s"]


def test_an_override_is_taken_as_given(spark):
    got = documents_of(spark, "id string, a string", [("1", "x y")], overrides={"a": "_s", "id": "_key"})
    assert got["1"][0] == ["a_s", "id_key"]


def test_xml_round_trip(spark, make_events):
    rows = make_events({"account": "<a & b>"}, {"account": " spaced ", "session": None}, {"account": "é中\U0001f600", "lat": -1e-7})
    xml = as_xml(rows, "appEvent")
    assert all(r.xml.startswith("<appEvent>") for r in xml.collect())
    assert rows_of(from_xml(xml, EVENT_SCHEMA, "appEvent")) == rows_of(rows)
    with pytest.raises(Exception, match="(?i)malformed|cannot|parse"):
        from_xml(spark.createDataFrame([("<appEvent><purchase>x</purchase></appEvent>",)], "xml string"), EVENT_SCHEMA, "appEvent").collect()


COLUMNS = ["p", "q", "constant"]


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [(float(i * 37 % 101) + 1e6, float(i * i % 17 - 5), 3.0) for i in range(500)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLUMNS))


def test_parts_merge_to_the_whole(spark, folder, numbers):
    """Three parts, one of a single row, one stored twice and one without rows."""
    table = moments.moment_table(spark, folder + "/m")
    first = numbers.limit(1)
    rest = numbers.exceptAll(first)
    parts = [first, rest.where("q < 0"), rest.where("q >= 0"), numbers.limit(0)]
    for n, part in enumerate(parts + parts[1:2]):
        name = n if n < 4 else 1
        table.write(moments.moments(part, f"part{name}", COLUMNS), name)
    state = moments.merged(table.latest())
    whole = {r.feature: r for r in stats.column_stats(numbers, COLUMNS).collect()}
    for row in moments.stats_of(state).collect():
        for field in ("count", "mean", "variance", "min", "max", "num_nonzeros", "norm_l1", "norm_l2"):
            assert row[field] == pytest.approx(whole[row.feature][field], rel=1e-9, abs=1e-9)
    want = {(r.feature_i, r.feature_j): r["corr"] for r in stats.correlation(numbers, COLUMNS).collect()}
    got = {(r.feature_i, r.feature_j): r["corr"] for r in moments.correlation_of(state).collect()}
    assert got.keys() == want.keys()
    assert all(math.isnan(got[k]) and math.isnan(want[k]) or got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_no_rows_leave_no_state(numbers):
    assert moments.moments(numbers.limit(0), "p", COLUMNS).count() == 0
    assert moments.merged(moments.moments(numbers.limit(0), "p", COLUMNS)).count() == 0


def test_requests_open_their_salts_only(spark, folder, make_events):
    events = make_events(*[dict(account=f"u{a}", app="x" if a % 2 else "y", ts=1000 * t, event_id=f"{a}-{t}") for a in range(12) for t in range(6)])
    write_salted(encode_events(events, 6), f"{folder}/t", 6, 6, unique=True)
    rows = read_salted(spark, f"{folder}/t", EVENT_WIDE_SCHEMA)
    asked = [(1, "u3", "x", 2000, 4000), (2, "u3", "x", None, 1000), (3, "u3", "y", None, None), (4, "u4", "y", 5000, None), (5, "none", "x", None, None)]
    spark.createDataFrame(asked, "request_id long, account_id string, app_id string, start long, end long").write.parquet(f"{folder}/r")
    requests = spark.read.parquet(f"{folder}/r")
    got = lookups.events_for_requests(rows, requests.where("request_id < 10"), 6)
    assert sorted((r.request_id, r.event_id) for r in got.collect()) == [(1, "3-2"), (1, "3-3"), (2, "3-0"), (4, "4-5")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan)
    assert lookups.events_for_requests(rows, requests.where("request_id > 10"), 6).count() == 0
