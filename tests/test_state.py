import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from epochloom.config import LedgerConfig
from epochloom.functions.time import epoch_to_day
from epochloom.operators import state
from epochloom.plans.marts import POWERS

CFG = LedgerConfig(genesis_unix=0, window_start=10 * 2880 - 1)
SCHEMA = "height long, miner_id string, raw_byte_power double, quality_adj_power double"


def claims(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def dense_delta(rows):
    """Brute force: fill every miner over every observed day, then difference the totals."""
    latest = {}
    for height, miner, *values in sorted(
        rows, key=lambda r: (r[0], r[2] is not None, r[2] or 0, r[3] is not None, r[3] or 0)
    ):
        day = height // 2880 if height > CFG.window_start else None
        latest[day, miner] = values
    days = sorted({d for d, _ in latest if d is not None})
    miners = {m for d, m in latest if d is not None}
    held = {m: [0.0, 0.0] for m in miners}
    out, last = {}, None

    def apply(day):
        for m in miners:
            for i, v in enumerate(latest.get((day, m), [None, None])):
                if v is not None:
                    held[m][i] = v

    apply(None)
    for day in days:
        apply(day)
        total = [sum(h[i] for h in held.values()) for i in (0, 1)]
        out[day] = (None, None) if last is None else tuple(a - b for a, b in zip(total, last))
        last = total
    return out


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        day = rng.choice([3, 5, 9, 10, 11, 12, 14, 15, 20])
        height = day * 2880 + rng.randrange(0, 2880, 7)
        miner = "hot" if rng.random() < 0.3 else f"m{rng.randrange(12)}"
        value = [None if rng.random() < 0.1 else float(rng.randrange(100)) for _ in range(2)]
        rows.append((height, miner, *value))
    rows.append((4 * 2880, "only_before", 50.0, 50.0))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_sparse_delta_equals_the_dense_one(spark, seed):
    rows = random_rows(seed)
    changes = state.state_changes(claims(spark, rows), "miner_id", ["height"], POWERS, CFG)
    found = state.state_delta_daily(changes, "miner_id", POWERS)
    got = {r[0]: (r[1], r[2]) for r in found.select(F.unix_date("date"), *POWERS).collect()}
    assert got == dense_delta(rows)


def test_first_day_is_null_but_uses_the_seed_later(spark):
    rows = [
        (5 * 2880, "a", 100.0, 100.0),
        (10 * 2880, "b", 1.0, 1.0),
        (11 * 2880, "a", 90.0, None),
    ]
    changes = state.state_changes(claims(spark, rows), "miner_id", ["height"], POWERS, CFG)
    found = state.state_delta_daily(changes, "miner_id", POWERS).orderBy("date").collect()
    assert [tuple(r)[1:] for r in found] == [(None, None), (-10.0, 0.0)]


@pytest.mark.parametrize("parts", [1, 2, 9])
def test_latest_is_independent_of_row_order(spark, parts):
    rows = [(10 * 2880, "a", v, -v) for v in (3.0, 9.0, 1.0)] + [(10 * 2880 - 5, "a", 99.0, 99.0)]
    random.Random(parts).shuffle(rows)
    df = claims(spark, rows, parts).withColumn("date", epoch_to_day(F.lit(10 * 2880), CFG))
    found = state.daily_latest(df, "miner_id", ["height"], POWERS).collect()
    assert [(r.raw_byte_power, r.quality_adj_power) for r in found] == [(9.0, -9.0)]


def test_latest_keeps_a_null_value(spark):
    rows = [(10 * 2880, "a", 5.0, 5.0), (10 * 2880 + 1, "a", None, 6.0)]
    df = claims(spark, rows).withColumn("date", epoch_to_day(F.col("height"), CFG))
    assert state.daily_latest(df, "miner_id", ["height"], POWERS).first()[2:] == (None, 6.0)


def test_fill_forward_has_one_interval_per_change(spark):
    rows = [(d, k, v) for d, k, v in [
        ("2024-01-01", "a", 1.0), ("2024-01-03", "a", None), ("2024-01-04", "a", 4.0),
        ("2024-01-03", "b", 7.0),
    ]]
    df = spark.createDataFrame(rows, "date string, k string, v double")
    found = state.fill_forward(df, "k", ["v"]).orderBy("k", "valid_from")
    assert [tuple(r) for r in found.collect()] == [
        ("a", 1.0, "2024-01-01", "2024-01-03"),
        ("a", 1.0, "2024-01-03", "2024-01-04"),
        ("a", 4.0, "2024-01-04", None),
        ("b", 7.0, "2024-01-03", None),
    ]


def test_seed_only_for_keys_seen_later(spark):
    before = claims(spark, [(1, "a", 1.0, 1.0), (2, "a", 2.0, 2.0), (3, "gone", 5.0, 5.0)])
    seen = spark.createDataFrame([("a",), ("new",)], "miner_id string")
    seed = state.seed_state(before, "miner_id", ["height"], POWERS, seen)
    assert [tuple(r) for r in seed.collect()] == [("a", 2.0, 2.0)]


def test_state_on_against_looking_back(spark):
    rng = random.Random(3)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(200))
    keys = ["hot"] * 6 + ["a", "b", "c", "d"]
    changes = {(rng.choice(keys), day()): rng.choice([1.0, 2.0, None]) for _ in range(150)}
    rows = [(k, d, v) for (k, d), v in changes.items()] + [("gone", dt.date(2023, 1, 1), 9.0)]
    held = state.fill_forward(spark.createDataFrame(rows, "k string, date date, v double"), "k", ["v"])
    asked = [(i, rng.choice([*keys, "gone", "never", None]), rng.choice([day(), day(), None])) for i in range(400)]
    asked += [(1000 + i, "hot", dt.date(2024, 3, 1)) for i in range(50)]
    found = state.state_on(held, spark.createDataFrame(asked, "i long, k string, date date"), "k", ["v"])

    def looked_up(key, date):
        known = [(d, v) for k, d, v in rows if k == key and date and d <= date and v is not None]
        return max(known)[1] if known else None

    got = {r.i: (r.k, r.date, r.v) for r in found.collect()}
    assert found.columns == ["i", "k", "date", "v"] and len(got) == len(asked)
    assert got == {i: (k, d, looked_up(k, d)) for i, k, d in asked}
    none = state.state_on(held.limit(0), found.drop("v").limit(5), "k", ["v"])
    assert [r.v for r in none.collect()] == [None] * 5
