import math

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from eventmart.functions.wide_rows import encode_events, encode_marts, salt_of
from eventmart.operators import learning, lookups, mart, stats, sums
from eventmart.schemas import FEATURES, MART_COLUMNS
from eventmart.storage.salted import salt_region_counts


def one_mart(events):
    return mart.account_mart(events).first().asDict()


def test_payments_split_by_payment_type(make_events):
    got = one_mart(make_events(*[
        {"event_id": p, "kind": "buy", "purchase": a, "payment": p}
        for p, a in [("credit", 10.0), ("debit", 20.0), ("paypal", 30.0)]]))
    assert got["purchase_total"] == 60
    assert [got[f"payment_{p}_total"] for p in ("credit", "debit", "paypal")] == [10, 20, 30]
    assert [got[f"payment_{p}_count"] for p in ("credit", "debit", "paypal")] == [1, 1, 1]


def test_any_event_type_adds_its_purchase(make_events):
    got = one_mart(make_events({"kind": "win", "purchase": 5.0}, {"kind": "logout", "event_id": "2"}))
    assert got["purchase_total"] == 5 and got["win_count"] == 1
    assert got["sign_on_count"] == got["lose_count"] == 0 and got["payment_credit_count"] == 2


def test_late_events_count(make_events):
    got = one_mart(make_events({"kind": "login"}, {"kind": "login", "ts": 1704067207179 - 50 * 86_400_000}))
    assert got["sign_on_count"] == 2


def test_merge_is_commutative_and_associative(make_events):
    a, b, c = [mart.account_mart(make_events(
        *[{"account": x, "kind": "win", "purchase": float(i)} for x in names])) for i, names in
        enumerate(["ab", "bc", "acd"], 1)]
    left = mart.merge_marts(mart.merge_marts(a, b), c)
    assert rows_of(left) == rows_of(mart.merge_marts(a, mart.merge_marts(c, b))) == rows_of(mart.merge_marts(c, b, a))
    assert left.columns == MART_COLUMNS


def test_sums_and_first_accounts(make_events):
    events = make_events(*[{"account": f"{i:03}", "kind": "win", "purchase": 2.0} for i in range(120)])
    wins = sums.wins_per_account(mart.account_mart(events))
    assert [r.account_id for r in sums.first_accounts(wins).collect()] == [f"{i:03}" for i in range(100)]
    assert sums.purchases_per_account(events).agg(F.sum("purchase")).first()[0] == 240


def ids(df):
    return [r.event_id for r in df.collect()]


def test_open_and_half_open_ranges(make_events):
    events = make_events(*[{"ts": t, "event_id": str(t)} for t in (100, 150, 200)],
                         {"ts": 150, "event_id": "other", "app": "y"}, {"account": "aa", "ts": 150})
    assert ids(lookups.events_between(events, "a", 100, 200)) == ["150", "other"]
    assert len(ids(lookups.events_between(events, "a"))) == len(ids(lookups.events_of_account(events, "a"))) == 4
    rows = encode_events(events, 6)
    assert ids(lookups.events_in_range(rows, "a", "x", 6, 100, 200)) == ["100", "150"]
    assert ids(lookups.events_in_range(rows, "a", "x", 6)) == ["100", "150", "200"]
    assert ids(lookups.events_in_range(rows, "a", "x", 6, start=150)) == ["150", "200"]


def test_range_order_is_time_type_id(make_events):
    events = make_events({"ts": 2, "event_id": "1", "kind": "buy"}, {"ts": 1, "event_id": "2", "kind": "win"},
                         {"ts": 1, "event_id": "3", "kind": "buy"}, {"ts": 1, "event_id": "1", "kind": "win"})
    found = lookups.events_in_range(encode_events(events, 6), "a", "x", 6)
    assert ids(found) == ["3", "1", "2", "1"]


def test_mart_lookups(make_events):
    marts = mart.account_mart(make_events({}, {"app": "y"}, {"account": "b"}))
    assert lookups.mart_of(marts, "a", "x").count() == 1 and lookups.mart_of(marts, "a", "z").count() == 0
    assert lookups.marts_of_account(marts, "a").count() == 2
    rows = encode_marts(marts, 6)
    assert rows_of(lookups.mart_by_row_key(rows, "a", "y", 6)) == rows_of(lookups.mart_of(marts, "a", "y"))


@pytest.mark.parametrize("salts,regions", [(6, 6), (10, 3), (7, 2)])
def test_regions_cover_all_salts(make_events, salts, regions):
    rows = encode_events(make_events(*[{"account": str(i)} for i in range(200)]), salts)
    counts = salt_region_counts(rows, salts, regions).collect()
    assert sum(r.rows for r in counts) == 200
    assert {r.region for r in counts} == set(range(regions))
    for r in counts:
        assert r.region == min(regions - 1, int(r.salt) // (salts // regions))
    with pytest.raises(ValueError):
        lookups.region_of("row_key", 2, 3)
    assert salt_of("hello", 6) == "0004"


@pytest.fixture(scope="module")
def feature_rows(spark):
    rng = np.random.default_rng(5)
    data = rng.integers(0, 50, (60, len(FEATURES))).astype(float)
    data[:, 2] = 7.0  # a constant feature
    data[:, 4] = data[:, 3] * 2 + 1
    schema = ", ".join(f"{f} double" for f in FEATURES)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in data], schema)
    return data, frame.select(F.lit("a").alias("account_id"), F.lit("x").alias("app_id"), *FEATURES)


def test_column_stats(feature_rows):
    data, frame = feature_rows
    table = {r.feature: r for r in stats.column_stats(frame).collect()}
    for i, f in enumerate(FEATURES):
        column, r = data[:, i], table[f]
        assert r["count"] == 60 and r.num_nonzeros == np.count_nonzero(column)
        expected = [column.mean(), column.var(ddof=1), column.min(), column.max(),
                    np.abs(column).sum(), np.sqrt((column ** 2).sum())]
        np.testing.assert_allclose([r["mean"], r.variance, r["min"], r["max"], r.norm_l1, r.norm_l2], expected, atol=1e-9)


def test_correlation_with_a_constant_feature(feature_rows):
    data, frame = feature_rows
    table = {(r.feature_i, r.feature_j): r["corr"] for r in stats.correlation(frame).collect()}
    assert len(table) == len(FEATURES) ** 2
    assert all(table[f, f] == 1.0 for f in FEATURES)
    assert math.isnan(table[FEATURES[2], FEATURES[0]]) and math.isnan(table[FEATURES[0], FEATURES[2]])
    assert table[FEATURES[3], FEATURES[4]] == pytest.approx(1.0)
    assert table[FEATURES[0], FEATURES[1]] == pytest.approx(np.corrcoef(data[:, 0], data[:, 1])[0, 1])


def test_kmeans(spark, feature_rows):
    data, frame = feature_rows
    model = learning.fit_kmeans(frame, 3, 20)
    centers = learning.kmeans_centers(spark, model).collect()
    assert len(centers) == 3 and sum(r.size for r in centers) == 60
    sizes = {r.cluster: r["count"] for r in learning.kmeans_assignments(model, frame).groupBy("cluster").count().collect()}
    assert sizes == {r.cluster: r.size for r in centers}
    assert model.summary.trainingCost <= ((data - data.mean(axis=0)) ** 2).sum()


def test_event_tree_and_samples(spark, make_events):
    events = make_events(*[
        {"event_id": str(i), "kind": "win" if i % 2 else "buy", "purchase": 0.0 if i % 2 else 5.0} for i in range(400)])
    rows = learning.event_label_features(events)
    first = rows.first()
    assert (first.label, first.payment_credit, first.day_of_week, first.hour_of_day) == (0.0, 1.0, 2.0, 0.0)
    split = learning.split_by_id(rows)
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 400 and 230 < sizes["train"] < 330
    model = learning.fit_event_tree(split.where("split = 'train'"))
    error = learning.prediction_error(learning.predict_events(model, split.where("split = 'test'"))).first()
    assert error.rows == sizes["test"] and error.error == 0.0
    fractions = {"win": 1.0, "buy": 0.0}
    assert {r.event_type for r in learning.stratified_sample(events, "event_type", fractions).collect()} == {"win"}
    assert learning.stratified_sample_by_id(events, "event_type", fractions).count() == 200
    half = learning.stratified_sample_by_id(events, "event_type", {"win": 0.5})
    assert 60 < half.count() < 140 and half.where("event_type = 'buy'").count() == 0
    train, test = learning.random_split(events)
    assert train.count() + test.count() == 400
