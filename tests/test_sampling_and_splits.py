"""Exact samples and tables split at given keys."""

import glob
import hashlib
import math
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventmart.operators import sampling
from eventmart.storage import presplit


def smallest(rows, fractions):
    """The sample by sorting every stratum."""
    found = set()
    for stratum, share in fractions.items():
        ids = sorted((int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i) for i, s in rows if s == stratum)
        found |= {i for _, i in ids[:math.ceil(round(share * 10_000) * len(ids) / 10_000)]}
    return found


@pytest.fixture(scope="module")
def strata(spark):
    """A stratum of a third of the rows, a small one, one of a single row, one without a name and a null one."""
    rows = [(str(i), "hot" if i % 3 == 0 else "one" if i == 1 else "small" if i % 50 == 2 else None if i % 7 == 0 else "rest") for i in range(6000)]
    return rows, spark.createDataFrame(rows, "id string, stratum string").withColumn("draw", F.lit("x")).withColumn("rank", F.lit(1))


@pytest.mark.parametrize("deviations", [8, 0])
def test_samples_have_exact_sizes(strata, deviations):
    """With no margin at all the bands miss and are widened; the sample is the same."""
    rows, frame = strata
    fractions = {"hot": 0.1, "small": 0.333, "one": 0.0001, "absent": 0.5, "rest": 0.0}
    for shape in (frame, frame.repartition(7)):
        sample = sampling.exact_stratified_sample(shape, "stratum", fractions, "id", deviations)
        assert sample.columns == frame.columns
        got = [r.id for r in sample.collect()]
        assert len(got) == len(set(got)) and set(got) == smallest(rows, fractions)


def test_all_none_and_empty(strata):
    rows, frame = strata
    assert sampling.exact_stratified_sample(frame, "stratum", {"hot": 1.0}, "id").count() == 2000
    assert sampling.exact_stratified_sample(frame, "stratum", {"hot": 0.0}, "id").count() == 0
    assert sampling.exact_stratified_sample(frame.limit(0), "stratum", {"hot": 0.5}, "id").count() == 0


def test_few_rows_wait_to_be_ranked():
    for size in (1000, 10**6, 10**12):
        low, high = sampling._band(size, size // 10, sampling.DEVIATIONS)
        assert (high - low) / (1 << sampling.BITS) * size <= 16 * (math.sqrt(size) + 1)


SCHEMA = "row_key string, c string"


def keys(spark, n=3000):
    """Two thirds of the keys have one salt."""
    return spark.createDataFrame([(f"{3 if i % 3 else i % 6:04}:a{i:05}", str(i)) for i in range(n)], SCHEMA)


def test_a_region_is_a_folder_and_a_hot_one_several_files(spark, folder):
    splits = presplit.salt_splits(6, 3)
    assert splits == ["0002", "0004"]
    rows = keys(spark)
    points = presplit.write_presplit(rows, f"{folder}/t", splits, target_rows=400)
    assert set(splits) < set(points)
    bounds, files = ["", *splits, "~"], {}
    for path in glob.glob(f"{folder}/t/region=*/*.parquet"):
        meta, region = pq.ParquetFile(path).metadata, int(re.search(r"region=(\d+)", path)[1])
        stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        low, high = min(s.min for s in stats), max(s.max for s in stats)
        assert bounds[region] <= low <= high < bounds[region + 1]
        files.setdefault(region, []).append((low, high, meta.num_rows))
    assert len(files[1]) >= 5 and max(n for f in files.values() for _, _, n in f) < 900
    for region in files.values():  # ranges that do not overlap
        region.sort()
        assert all(a[1] < b[0] for a, b in zip(region, region[1:]))
    found = presplit.read_presplit(spark, f"{folder}/t", rows.schema)
    assert found.count() == 3000 and found.where("region <> least(2, cast(cast(substring(row_key, 1, 4) as int) / 2 as int))").count() == 0


def test_a_range_opens_its_regions_only(spark, folder):
    splits = presplit.salt_splits(6, 6)
    presplit.write_presplit(keys(spark, 600), f"{folder}/t", splits)
    rows = presplit.key_range(presplit.read_presplit(spark, f"{folder}/t", keys(spark, 1).schema), splits, "0003:a00100", "0003:a00200")
    want = keys(spark, 600).where("row_key >= '0003:a00100' AND row_key < '0003:a00200'").count()
    assert rows.count() == want > 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "region" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert presplit.key_range(presplit.read_presplit(spark, f"{folder}/t", keys(spark, 1).schema), splits).count() == 600


def test_many_split_points_and_wrong_ones(spark, folder):
    points = [f"{i:04}" for i in range(1, 200)]
    got = spark.createDataFrame([("0000",), ("0001",), ("0100x",), ("9",)], "row_key string").select(presplit.place_of("row_key", points)).collect()
    assert [r[0] for r in got] == [0, 1, 100, 199]
    with pytest.raises(ValueError):
        presplit.write_presplit(keys(spark, 1), f"{folder}/t", ["b", "a"])
    with pytest.raises(ValueError):
        presplit.salt_splits(3, 4)
