import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.operators.percentiles import counted_sizes, day_percentiles

WANTED = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def frame(spark, days):
    rows = [(day, v) for day, vs in days.items() for v in vs]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "date string, v double").repartition(5)


def test_against_numpy(spark):
    rng = random.Random(7)
    days = {
        "a": [rng.random() for _ in range(4001)],
        "b": [float(rng.randrange(5)) for _ in range(1000)],
        "c": [3.0],
        "d": [rng.lognormvariate(0, 4) for _ in range(777)],
        # One value holds most of its day.
        "e": [1.0] * 5000 + [rng.random() * 2 for _ in range(100)],
        "f": [5.0, 1.0],
    }
    df = frame(spark, {**days, "g": [None]})
    found = day_percentiles(df, "v", WANTED)
    rows = {r.date: r for r in found.collect()}
    assert set(rows) == {*days, "g"}
    assert rows["g"].p50 is None
    for day, vs in days.items():
        for name, p in WANTED.items():
            assert rows[day][name] == pytest.approx(np.quantile(vs, p), rel=1e-12), (day, name)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "date string, v double")
    assert day_percentiles(empty, "v", WANTED).count() == 0


def test_counted_sizes(spark):
    rows = [("a", 1, 2), ("a", 7, 1), ("a", 9, 1), ("b", 4, 1), ("b", 6, 1), ("b", None, 50)]
    rows += [("c", None, 3), ("d", 0, 2), ("d", 5, 1)]
    df = spark.createDataFrame(rows, "date string, n long, messages long")
    found = counted_sizes(df, "n", "messages").orderBy("date").collect()
    assert [tuple(r) for r in found] == [
        ("a", 4.5, 1, 4),
        ("b", 5.0, 4, 52),
        ("c", None, None, 3),
        ("d", pytest.approx(5 / 3), 0, 3),
    ]
    positive = counted_sizes(df, "n", "messages", F.col("n") > 0).where("date = 'd'")
    assert tuple(positive.first()) == ("d", 5.0, 5, 3)


def test_counted_median_matches_the_sketch(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("d"), F.col("id") % 7).alias("date"), (F.col("id") * 37 % 53).alias("n")
    )
    counts = df.groupBy("date", "n").agg(F.count("*").alias("w"))
    exact = counted_sizes(counts, "n", "w")
    sketch = df.groupBy("date").agg(F.percentile_approx("n", 0.5, 10000).alias("s"))
    assert exact.join(sketch, "date").where("median <> s").count() == 0
