"""Facts of published outputs that hold without their inputs: columns, order, days, invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from epochloom.functions.time import epoch_to_day
from epochloom.plans.marts import Marts
from epochloom.plans.metrics import METRICS
from tests.ledgers import CFG, rows, store

# Metric: its columns, the first and the last day of the published rows, and their number.
PUBLISHED = {
    "ddo_sector_onboarding": (
        ["date", "ddo_sectors", "non_ddo_sectors", "total_pcs3_sectors"],
        CFG.onboarding_window_start + 1,
        dt.date(2026, 3, 29),
        203,
    ),
    "gas_utilization": (
        ["date", "gas_utilization_pct", "theoretical_max_sectors_per_day"],
        CFG.window_start + 1,
        dt.date(2026, 2, 15),
        613,
    ),
    "sector_daily_fee_cost": (
        ["date", "avg_daily_fee_lifetime_cost_nanofil", "sector_count"],
        CFG.upgrade_epoch,
        dt.date(2026, 2, 15),
        308,
    ),
}


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("golden")
    return Marts(store(spark, str(root), rows(extra_days=12)), CFG)


@pytest.mark.parametrize("name", PUBLISHED)
def test_columns_order_and_first_day(spark, marts, name):
    columns, first_height, last, days = PUBLISHED[name]
    first = spark.range(1).select(epoch_to_day(F.lit(first_height), CFG)).first()[0]
    assert (last - first).days + 1 == days
    found = METRICS[name](marts).collect()
    assert found[0].asDict().keys() == dict.fromkeys(columns).keys()
    dates = [r.date for r in found]
    assert dates == sorted(set(dates), reverse=True) and dates[-1] == first


def test_invariants(marts):
    found = METRICS["ddo_sector_onboarding"](marts).collect()
    assert all(r.total_pcs3_sectors == r.ddo_sectors + r.non_ddo_sectors > 0 for r in found)
    dates = [r.date for r in found]
    assert (dates[0] - dates[-1]).days + 1 == len(dates)
    assert all(r.sector_count > 0 for r in METRICS["sector_daily_fee_cost"](marts).collect())
    used = [r.gas_utilization_pct for r in METRICS["gas_utilization"](marts).collect()]
    assert all(0 < u <= 100 for u in used)
