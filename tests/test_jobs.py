"""The metrics on the real chain's clock, storage and output."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from epochloom.plans.marts import (
    FROM_ONBOARDING,
    MARTS,
    Marts,
    activations,
    archetype_costs,
    burn,
    onboarding,
)
from epochloom.plans.metrics import METRICS, small_batch_count
from epochloom.plans.runner import reached_days, store_marts, write_metrics
from epochloom.config import ARCHETYPE_ACTIVATION_FIELDS
from epochloom.sources.json_records import read_record_array, read_records
from epochloom.sources.tables import catalog_ledger, in_window, load_ledger, resolve_column
from epochloom.streaming.refresh import refresh
from tests.ledgers import BOUNDARIES, CFG, COIN, rows, store

COLUMNS = {
    "base_fee_percentiles": ["base_fee_p50_nanofil", "base_fee_p95_nanofil"],
    "burn_composition": [
        "dispute_termination_gas_fil",
        "sector_onboarding_gas_fil",
        "other_burn_fil",
    ],
    "circulating_supply_vs_burn": [
        "circulating_fil",
        "burnt_fil",
        "circulating_growth_pct",
        "daily_burn_rate_pct",
    ],
    "daily_fee_burn": ["total_fee_burn_fil", "sector_onboarding_gas_fil"],
    "ddo_sector_onboarding": ["ddo_sectors", "non_ddo_sectors", "total_pcs3_sectors"],
    "fil_return_per_sector": ["fil_return_per_sector"],
    "gas_per_sector_by_path": [
        "PreCommitSectorBatch2",
        "ProveCommitSectors3",
        "ProveCommitAggregate",
        "ProveReplicaUpdates3",
    ],
    "gas_utilization": ["gas_utilization_pct", "theoretical_max_sectors_per_day"],
    "participating_miner_count": ["participating_miner_count"],
    "power_added": ["raw_power_added", "quality_adjusted_power_added"],
    "precommit_sector_batch_size": [
        "avg_sectors_per_message",
        "median_sectors_per_message",
        "messages",
        "avg_aggregate_size",
        "median_aggregate_size",
        "aggregate_messages",
    ],
    "renewal_rate": [
        "expired_count",
        "extended_count",
        "renewal_rate_pct",
        "renewal_rate_pre_pct",
        "renewal_rate_during_pct",
        "renewal_rate_post_pct",
    ],
    "sector_daily_fee_cost": ["avg_daily_fee_lifetime_cost_nanofil", "sector_count"],
    "sector_extensions": [
        "extensions_per_day",
        "extensions_pre_grace",
        "extensions_during_grace",
        "extensions_post_grace",
        "baseline_rolling_30d",
    ],
    "sector_lifetime_cost": ["large_sp", "medium_sp", "small_sp"],
    "small_batch_count": [
        "small_batch_count",
        "total_batch_count",
        "small_batch_pct",
        "fuller_batch_pct",
    ],
}


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    return store(spark, str(tmp_path_factory.mktemp("ledger")), rows())


@pytest.fixture(scope="module")
def marts(ledger):
    return Marts(ledger, CFG)


def by_day(df):
    return {str(r.date): r for r in df.collect()}


@pytest.mark.parametrize("name", METRICS)
def test_columns_and_order(marts, name):
    df = METRICS[name](marts)
    assert df.columns == ["date", *COLUMNS[name]]
    days = [r.date for r in df.collect()]
    assert days and days == sorted(set(days), reverse=True)


def test_window_bounds(marts):
    found = by_day(METRICS["participating_miner_count"](marts))
    # The first boundary is outside the window; the upgrade and grace days hold two heights.
    assert {d: r.participating_miner_count for d, r in found.items()} == {
        "2024-06-13": 1001,
        "2025-04-14": 1003,
        "2025-07-13": 1005,
        "2025-09-08": 1007,
    }


def test_phase_days_hold_two_phases(marts):
    found = by_day(METRICS["sector_extensions"](marts))
    phases = {d: tuple(r)[2:5] for d, r in found.items()}
    assert phases == {
        "2024-06-13": (2, None, None),
        "2025-04-14": (3, 4, None),
        "2025-07-13": (None, 5, 6),
        "2025-09-08": (None, None, 15),
    }


def test_onboarding_window(marts, ledger):
    found = by_day(METRICS["ddo_sector_onboarding"](marts))
    assert {d: tuple(r)[1:] for d, r in found.items()} == {"2025-09-08": (0, 2, 2)}
    strict = activations(ledger, CFG, strict=True).collect()
    assert [(r.total, r.market) for r in strict] == [(2, 2)]


def test_burn_classes_sum_to_the_total(marts):
    totals = by_day(METRICS["daily_fee_burn"](marts))
    parts = by_day(METRICS["burn_composition"](marts))
    assert set(totals) == set(parts)
    for day, r in parts.items():
        assert sum(tuple(r)[1:]) == pytest.approx(totals[day].total_fee_burn_fil)


def test_event_fallback_gives_the_aggregate_size(marts):
    found = by_day(METRICS["precommit_sector_batch_size"](marts))["2025-04-14"]
    assert tuple(found)[1:] == (4.5, 4, 2, 3.0, 3, 2)


def test_archetype_fields(ledger):
    """By default the activation array is not a count, so those messages have none."""
    documented = onboarding(ledger, CFG, archetype_fields=ARCHETYPE_ACTIVATION_FIELDS)
    for rows_, counted in ((onboarding(ledger, CFG), 0), (documented, 7)):
        proofs = rows_.where("method = 'ProveCommitSectors3'")
        assert proofs.count() == 7
        assert proofs.where("archetype_sectors is not null").count() == counted
        assert archetype_costs(ledger, CFG, messages=rows_).count() >= 4


def test_frames_share_the_onboarding_messages(ledger):
    shared = onboarding(ledger, CFG)
    for name, build in FROM_ONBOARDING.items():
        own, common = build(ledger, CFG), build(ledger, CFG, messages=shared)
        assert own.count() > 0
        assert own.exceptAll(common).count() == common.exceptAll(own).count() == 0, name


def test_power_starts_with_null(marts):
    rows_ = METRICS["power_added"](marts).collect()
    assert tuple(rows_[-1])[1:] == (None, None)
    assert all(r.raw_power_added is not None for r in rows_[:-1])


def test_completeness_check(marts, spark):
    assert len(small_batch_count(marts).collect()) == 4
    sizes = spark.createDataFrame(
        [(dt.date(2025, 1, 1), 2, 1), (dt.date(2025, 1, 1), None, 1)],
        "date date, sector_count long, messages long",
    )
    broken = Marts(stored={"batch_sizes": sizes}, cfg=CFG)
    assert small_batch_count(broken, check=False).first().total_batch_count == 2
    with pytest.raises(SparkRuntimeException, match="small_batch_pct"):
        small_batch_count(broken).collect()


def test_day_partitions_are_pruned(ledger):
    plan = in_window(ledger.chain_powers, CFG, 5300000)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "GreaterThan(height,5300000)" in plan


def test_recent_days_cut_the_scan(ledger):
    recent = burn(ledger, CFG, dt.date(2025, 9, 8))._jdf.queryExecution().toString()
    first = CFG.first_epoch_of((dt.date(2025, 9, 8) - dt.date(1970, 1, 1)).days)
    assert f"GreaterThan(height,{first - 1})" in recent
    assert [str(r.date) for r in burn(ledger, CFG, dt.date(2025, 9, 8)).collect()] == [
        "2025-09-08"
    ]


def test_amounts_as_text_and_other_table_names(spark, ledger, marts):
    """Catalog tables, one under another name, with amounts stored as text."""
    text = F.col("daily_fee").cast("string").alias("daily_fee")
    infos = ledger.miner_sector_infos.select("activation_epoch", "expiration_epoch", text)
    infos.createOrReplaceTempView("infos_v9")
    ledger.block_headers.select(
        "height", F.col("parent_base_fee").cast("string").alias("parent_base_fee")
    ).createOrReplaceTempView("block_headers")
    other = Marts(catalog_ledger(spark, names={"miner_sector_infos": "infos_v9"}), CFG)
    for name in ("sector_daily_fee_cost", "base_fee_percentiles"):
        assert METRICS[name](other).collect() == METRICS[name](marts).collect()


def test_folders_with_their_own_schema(spark, tmp_path):
    rows_ = [(4000001, "7"), (4000002, "9")]
    spark.createDataFrame(rows_, "height long, participating_miner_count string").write.parquet(
        str(tmp_path / "powers")
    )
    own = load_ledger(spark, str(tmp_path), declared=False, names={"chain_powers": "powers"})
    assert [r.participating_miner_count for r in own.chain_powers.orderBy("height").collect()] == [
        "7",
        "9",
    ]


def test_resolve_column(spark):
    df = spark.createDataFrame([], "message string, msg_cid string")
    assert resolve_column(df) == "msg_cid"
    assert resolve_column(spark.createDataFrame([], "height long")) is None


def test_records_round_trip(spark, marts, tmp_path):
    write_metrics(marts, str(tmp_path), ["circulating_supply_vs_burn"])
    folder = tmp_path / "circulating_supply_vs_burn"
    (part,) = [f for f in os.listdir(folder) if f.startswith("part-")]
    lines = [json.loads(line) for line in (folder / part).read_text().splitlines()]
    assert [r["date"] for r in lines] == ["2025-09-08", "2025-07-13", "2025-04-14", "2024-06-13"]
    assert lines[-1]["circulating_growth_pct"] is None
    schema = "date date, circulating_fil double, circulating_growth_pct double"
    back = read_records(spark, str(folder), schema)
    assert back.count() == 4 and back.where("circulating_growth_pct is null").count() == 1
    array = tmp_path / "array.json"
    array.write_text(json.dumps(lines, indent=1))
    assert read_record_array(spark, str(array), schema).exceptAll(back).count() == 0


def test_refresh_equals_a_full_run(spark, tmp_path):
    """New facts arrive, some on a day already stored; only recent days are rebuilt."""
    root, mart_root = str(tmp_path / "facts"), str(tmp_path / "marts")
    everything = rows(extra_days=4)
    cut = 5300001 + 2 * 2880

    def height(row):
        return row[0]

    early = {n: [r for r in data if height(r) < cut] for n, data in everything.items()}
    late = {n: [r for r in data if height(r) >= cut] for n, data in everything.items()}
    # Sent later on an early day, and joined to a message of that day.
    again = (5300001 + 2880 + 7, "m8", COIN, COIN, 3, 40)
    late["derived_gas_outputs"].append(again)

    store_marts(spark, store(spark, root, early), CFG, mart_root)
    ledger = store(spark, root, late)
    spark.catalog.clearCache()
    refreshed = refresh(spark, ledger, CFG, mart_root, str(tmp_path / "out"))
    planned = Marts(ledger, CFG)
    full = Marts(cfg=CFG, stored={name: planned[name].cache() for name in MARTS})

    def content(df, columns):
        return sorted(map(str, df.select(columns).collect()))

    for name in MARTS:
        columns = sorted(full[name].columns)
        assert content(refreshed[name], columns) == content(full[name], columns), name
    for name, metric in METRICS.items():
        a, b = metric(refreshed), metric(full)
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()], name
        assert os.path.isdir(tmp_path / "out" / name)
    newest = max(r.date for r in full["miner_counts"].collect())
    assert reached_days(spark, mart_root)["miner_counts"] == newest
    assert reached_days(spark, str(tmp_path / "nowhere")) == {}


def test_boundaries_are_what_the_settings_say():
    assert CFG.upgrade_epoch in BOUNDARIES and CFG.grace_end_epoch in BOUNDARIES
