"""Positions, folds, quantiles: sliced forms against brute force."""

import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wagegrid.operators import features, positions, quantiles


@pytest.mark.parametrize("rows_per_slice", [50, 333, 10_000])
def test_row_numbers(spark, rows_per_slice):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("k")).repartition(5)
    found = positions.row_numbers(df, "k", rows_per_slice=rows_per_slice).collect()
    assert sorted((r.k, r.position) for r in found) == [(i * i, i) for i in range(1000)]


def test_row_numbers_by_stamp_within(spark):
    df = spark.range(500).selectExpr(
        "timestamp_seconds(id * 37) t", "cast(case when id < 350 then 'hot' end as string) g", "id"
    )
    found = positions.row_numbers(df, "t", within=("g",), rows_per_slice=40).collect()
    assert all(r.position == (r.id if r.g else r.id - 350) for r in found)
    assert len(found) == 500


@pytest.mark.parametrize("rows_per_slice", [30, 10_000])
def test_row_numbers_by_text_within_odd_groups(spark, rows_per_slice):
    groups = [None, "\0", "", "g"]
    rows = [(f"k{i * 7919 % 1000:04d}\0", groups[i % 4]) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, g string").repartition(3)
    found = positions.row_numbers(df, "k", within=("g",), rows_per_slice=rows_per_slice).collect()
    want = {(k, g): sorted(x for x, h in rows if h == g).index(k) for k, g in rows}
    assert len(found) == 200 and {(r.k, r.g): r.position for r in found} == want
    between = positions.rows_between(df, "k", 50, 60, rows_per_slice=rows_per_slice).collect()
    assert sorted((r.position, r.k) for r in between) == list(enumerate(sorted(k for k, _ in rows)))[50:60]


@pytest.mark.parametrize("rows_per_slice", [40, 10_000])
@pytest.mark.parametrize("k", [5, 6, 700])
def test_folds(spark, rows_per_slice, k):
    df = spark.range(600).selectExpr("id", "cast(id % 3 = 0 as int) y")
    found = positions.stratified_folds(df, "y", "id", k, rows_per_slice=rows_per_slice).collect()
    assert len(found) == 600
    for y in (0, 1):
        rows = sorted(((r.id, r.fold) for r in found if r.y == y))
        folds = [f for _, f in rows]
        sizes = [folds.count(f) for f in range(k)]
        assert folds == sorted(folds) and max(sizes) - min(sizes) <= 1
        assert sizes == sorted(sizes, reverse=True)


def test_small_folds(spark):
    df = spark.range(14).selectExpr("id", "id % 2 y")
    found = positions.stratified_folds(df, "y", "id", 6).collect()
    for y in (0, 1):
        folds = [r.fold for r in found if r.y == y]
        assert [folds.count(f) for f in range(6)] == [2, 1, 1, 1, 1, 1]


@pytest.mark.parametrize(
    "values",
    [
        [1.0], [1.0, 2.0], [5.0] * 50, [3.0, 1.0, 2.0],
        [7.0] * 400 + [float(i) for i in range(600)],
        [float(i) for i in range(1001)], [1e300, -1e300, 0.0, 1.0] * 100,
    ],
)
@pytest.mark.parametrize("direct", [5, 1_000_000])
def test_median(spark, values, direct):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    found = quantiles.median_value(df, "x", direct_rows=direct).first()[0]
    assert found == pytest.approx(statistics.median(values))


def test_quantile_narrows(spark):
    draw = np.random.default_rng(0).lognormal(0, 3, 20_000).round(4)
    df = spark.createDataFrame([(float(v),) for v in draw], "x double")
    for q in (0.0, 0.25, 0.75, 0.999, 1.0):
        found = quantiles.quantile_value(df, "x", q, direct_rows=500).first()[0]
        assert found == pytest.approx(float(np.quantile(draw, q)), rel=1e-12)


@pytest.mark.parametrize("values", [[float("inf"), 1.0, float("inf")], [float("-inf"), 1.0], [1.0, float("inf"), 2.0, 3.0]])
def test_infinite_values_on_both_sides_of_the_bound(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    small, narrowed = (quantiles.median_value(df, "x", direct_rows=n).first()[0] for n in (1, 100))
    assert small == narrowed == statistics.median(values)


def test_empty_median(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles.median_value(df, "x").first()[0] is None


def test_above_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    got = [r[1] for r in features.above_median(df, "x").collect()]
    assert got == [0, 0, 1, 0]
    same = spark.createDataFrame([(4.0,)] * 3, "x double")
    assert {r[1] for r in features.above_median(same, "x").collect()} == {0}


def test_median_estimate(spark):
    assert quantiles.median_estimate(spark.range(101), "id").first()[0] == 50.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 3)), min_size=1, max_size=60))
def test_median_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = quantiles.median_value(df, "x", direct_rows=3).first()[0]
    assert found == pytest.approx(statistics.median(values), rel=1e-9, abs=1e-9)
