import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from epochloom.operators import daily as d, quality
from epochloom.plans import series


def days(spark, *rows, columns="x double"):
    return spark.createDataFrame(
        [(f"2024-01-{i + 1:02d}", *r) for i, r in enumerate(rows)], f"date string, {columns}"
    ).withColumn("date", F.to_date("date"))


def column(df, name):
    return [r[name] for r in df.orderBy("date").collect()]


def test_trailing_mean_skips_nulls(spark):
    df = days(spark, (1.0,), (None,), (3.0,), (None,), (None,), (None,))
    assert column(d.rolling_mean(df, ["x"], 3), "x") == [1.0, 1.0, 2.0, 3.0, 3.0, None]
    full = d.rolling_mean(df, ["x"], 3, min_samples=2)
    assert column(full, "x") == [None, None, 2.0, None, None, None]


def test_change_is_against_the_previous_row(spark):
    df = days(spark, (1.0,), (4.0,), (9.0,)).where("day(date) <> 2")
    assert column(df.select("date", d.change("x").alias("c")), "c") == [None, 8.0]


def test_pivot_has_fixed_columns(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "a", 1.0), ("2024-01-01", "a", 3.0), ("2024-01-02", "z", 5.0)],
        "date string, k string, v double",
    )
    wide = d.pivot_mean(df, "k", "v", ["a", "b"]).orderBy("date")
    assert [tuple(r) for r in wide.collect()] == [
        ("2024-01-01", 2.0, None),
        ("2024-01-02", None, None),
    ]


def test_yield_needs_both_positive(spark):
    gains = days(spark, (None,), (10.0,), (-5.0,), (8.0,))
    counts = days(spark, (2,), (4,), (1,), (0,), columns="n long")
    found = d.yield_per_unit(gains, counts, "x", "n", "y").collect()
    assert [(r.date.day, r.y) for r in found] == [(2, 2.5)]


def test_pct_check(spark):
    good = days(spark, (40.0, 60.0), (None, 1.0), columns="a double, b double")
    checked = quality.check_pct_sum(good, ["a", "b"])
    assert checked.collect() == good.collect()
    bad = days(spark, (40.0, 60.0), (40.0, 59.5), columns="a double, b double")
    broken = quality.check_pct_sum(bad, ["a", "b"])
    with pytest.raises(SparkRuntimeException, match="is off by 0.5 on"):
        broken.collect()


def test_repeated_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "cid string")
    assert [tuple(r) for r in quality.repeated_ids(df).collect()] == [("a", 2)]


def test_series_points_are_finite_and_sorted(spark):
    df = days(spark, (2.0,), (float("nan"),), (None,), (float("inf"),), (5.0,))
    points = series.series_points(df.orderBy(F.desc("date")), "x").collect()
    assert [(r.x_millis, r.y) for r in points] == [(1704067200000, 2.0), (1704412800000, 5.0)]


def test_series_flags(spark):
    df = days(spark, (1.0, None), (None, None), columns="a double, b double")
    flags = series.series_has_data(df, ["a", "b"]).collect()
    found = {r.series: (r.points, r.has_data) for r in flags}
    assert found == {"a": (1, True), "b": (0, False)}
    both = series.series_unpivot(df, ["a", "b"], ["first", "second"])
    assert [r.series for r in both.collect()] == ["first"]


def test_phase_coverage_needs_expiries(spark):
    df = days(
        spark,
        (5.0, None, 7.0, 3),
        (None, None, 8.0, 0),
        columns="renewal_rate_pre_pct double, renewal_rate_during_pct double, "
        "renewal_rate_post_pct double, expired_count long",
    )
    found = {r.phase: r.covered for r in series.phase_coverage(df).collect()}
    assert found == {"pre": True, "during": False, "post": True}


def test_catalogue_shape():
    assert len(series.CHARTS) == 22
    assert sum(len(c.columns) for c in series.CHARTS) == 43
    assert len({c.metric for c in series.CHARTS}) == 16
    assert len({c.name for c in series.CHARTS}) == 22
