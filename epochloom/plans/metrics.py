"""The sixteen daily metrics, newest day first, from the daily frames of `plans.marts`."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, functions as F

from epochloom.config import (
    ATTO_PER_COIN,
    ONBOARDING_PATHS,
    SECTOR_ADDED,
    SECTOR_EXPIRED,
    SECTOR_EXTENDED,
    SIZE_CLASSES,
)
from epochloom.functions.amounts import nanos, pebibytes, percent, ratio
from epochloom.operators.daily import (
    change,
    join_days,
    newest_first,
    pivot_mean,
    previous,
    rolling_mean,
    trailing_mean,
    yield_per_unit,
)
from epochloom.operators.percentiles import counted_sizes
from epochloom.operators.quality import check_pct_sum
from epochloom.operators.state import state_delta_daily
from epochloom.plans.marts import POWERS, Marts, events_where

PHASES = ("pre", "during", "post")
# Metrics by name: as daily frames in no order, and newest day first.
DAILY: dict[str, Callable[..., DataFrame]] = {}
METRICS: dict[str, Callable[..., DataFrame]] = {}


def metric(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @wraps(build)
    def in_order(m: Marts, **options) -> DataFrame:
        return newest_first(build(m, **options))

    DAILY[build.__name__] = build
    METRICS[build.__name__] = in_order
    return in_order


@metric
def base_fee_percentiles(m: Marts) -> DataFrame:
    return m["base_fees"].select(
        "date",
        nanos(F.col("p50")).alias("base_fee_p50_nanofil"),
        nanos(F.col("p95")).alias("base_fee_p95_nanofil"),
    )


@metric
def burn_composition(m: Marts) -> DataFrame:
    return m["burn"].select(
        "date",
        F.col("dispute").alias("dispute_termination_gas_fil"),
        F.col("onboarding").alias("sector_onboarding_gas_fil"),
        F.col("other").alias("other_burn_fil"),
    )


@metric
def circulating_supply_vs_burn(m: Marts) -> DataFrame:
    """Growth is relative to the previous day's supply, burn to the current one's."""
    growth = percent(change("circulating_fil"), previous("circulating_fil"), 6)
    burnt = percent(change("burnt_fil"), F.col("circulating_fil"), 6)
    return m["supply"].select(
        "date",
        "circulating_fil",
        "burnt_fil",
        growth.alias("circulating_growth_pct"),
        burnt.alias("daily_burn_rate_pct"),
    )


@metric
def daily_fee_burn(m: Marts) -> DataFrame:
    return m["burn"].select(
        "date",
        F.col("total").alias("total_fee_burn_fil"),
        F.col("onboarding").alias("sector_onboarding_gas_fil"),
    )


@metric
def ddo_sector_onboarding(m: Marts) -> DataFrame:
    return m["activations"].select(
        "date",
        (F.col("total") - F.col("market")).alias("ddo_sectors"),
        F.col("market").alias("non_ddo_sectors"),
        F.col("total").alias("total_pcs3_sectors"),
    )


@metric
def fil_return_per_sector(m: Marts) -> DataFrame:
    gained = m["rewards"].select("date", (change("top") / F.lit(ATTO_PER_COIN)).alias("reward"))
    added = (
        m["sector_events"]
        .where(F.col("event") == SECTOR_ADDED)
        .groupBy("date")
        .agg(F.sum("events").alias("added"))
    )
    return yield_per_unit(gained, added, "reward", "added", "fil_return_per_sector")


@metric
def gas_per_sector_by_path(m: Marts) -> DataFrame:
    return pivot_mean(m["path_costs"], "method", "cost", ONBOARDING_PATHS)


def theoretical_capacity(capacity: float, unit_cost: Column) -> Column:
    return F.round(ratio(F.lit(capacity), unit_cost), 0)


@metric
def gas_utilization(m: Marts) -> DataFrame:
    return join_days(m["gas_totals"], m["batch_gas"]).select(
        "date",
        percent(F.col("gas_used"), F.col("gas_limit"), 4).alias("gas_utilization_pct"),
        theoretical_capacity(m.cfg.daily_gas_capacity, F.col("gas_per_sector")).alias(
            "theoretical_max_sectors_per_day"
        ),
    )


@metric
def participating_miner_count(m: Marts) -> DataFrame:
    return m["miner_counts"].select("date", "participating_miner_count")


@metric
def power_added(m: Marts) -> DataFrame:
    names = dict(zip(POWERS, ("raw_power_added", "quality_adjusted_power_added"), strict=True))
    daily = state_delta_daily(m["power_changes"], "miner_id", POWERS).select(
        "date", *[pebibytes(F.col(power)).alias(name) for power, name in names.items()]
    )
    return rolling_mean(daily, names.values(), m.cfg.smooth_days)


@metric
def precommit_sector_batch_size(m: Marts) -> DataFrame:
    batches = counted_sizes(m["batch_sizes"], "sector_count", "messages").select(
        "date",
        F.col("mean").alias("avg_sectors_per_message"),
        F.col("median").alias("median_sectors_per_message"),
        F.col("rows").alias("messages"),
    )
    sized = F.col("sector_count") > 0
    proofs = counted_sizes(m["aggregate_sizes"], "sector_count", "messages", sized).select(
        "date",
        F.col("mean").alias("avg_aggregate_size"),
        F.col("median").alias("median_aggregate_size"),
        F.col("rows").alias("aggregate_messages"),
    )
    return join_days(batches, proofs)


@metric
def renewal_rate(m: Marts) -> DataFrame:
    """Only the phase columns are smoothed."""
    extended = F.col("event") == SECTOR_EXTENDED

    def rate(rows: Column) -> Column:
        return percent(events_where(extended & rows), events_where(rows), 2)

    columns = {phase: f"renewal_rate_{phase}_pct" for phase in PHASES}
    daily = (
        m["sector_events"]
        .where(F.col("event").isin(SECTOR_EXPIRED, SECTOR_EXTENDED))
        .groupBy("date")
        .agg(
            events_where(F.col("event") == SECTOR_EXPIRED).alias("expired_count"),
            events_where(extended).alias("extended_count"),
            rate(F.lit(True)).alias("renewal_rate_pct"),
            *[rate(F.col("phase") == phase).alias(c) for phase, c in columns.items()],
        )
    )
    return rolling_mean(daily, columns.values(), m.cfg.smooth_days)


@metric
def sector_daily_fee_cost(m: Marts) -> DataFrame:
    """`sector_count` counts table rows, not distinct sectors."""
    return m["fee_costs"].select(
        "date",
        F.col("cost").alias("avg_daily_fee_lifetime_cost_nanofil"),
        F.col("sectors").alias("sector_count"),
    )


@metric
def sector_extensions(m: Marts) -> DataFrame:
    columns = {phase: f"extensions_{phase}_grace" for phase in PHASES}
    daily = (
        m["sector_events"]
        .where(F.col("event") == SECTOR_EXTENDED)
        .groupBy("date")
        .agg(
            F.sum("events").alias("extensions_per_day"),
            *[events_where(F.col("phase") == phase).alias(c) for phase, c in columns.items()],
        )
    )
    return daily.select(
        "date",
        "extensions_per_day",
        *[F.nullif(F.col(c), F.lit(0)).alias(c) for c in columns.values()],
        trailing_mean("extensions_per_day", m.cfg.baseline_days).alias(
            "baseline_rolling_30d"
        ),
    )


@metric
def sector_lifetime_cost(m: Marts) -> DataFrame:
    return pivot_mean(m["archetype_costs"], "sp_archetype", "cost", SIZE_CLASSES)


@metric
def small_batch_count(m: Marts, check: bool = True) -> DataFrame:
    """Messages without a count are in the total only, so the shares may fall short of 100.

    Reading a day on which they fall short raises an error, unless `check` is off.
    """
    small = events_where(F.col("sector_count") < m.cfg.small_batch_below, "messages")
    fuller = events_where(F.col("sector_count") >= m.cfg.small_batch_below, "messages")
    daily = (
        m["batch_sizes"]
        .groupBy("date")
        .agg(
            small.alias("small_batch_count"),
            F.sum("messages").alias("total_batch_count"),
            percent(small, F.sum("messages"), 2).alias("small_batch_pct"),
            percent(fuller, F.sum("messages"), 2).alias("fuller_batch_pct"),
        )
    )
    return check_pct_sum(daily, ["small_batch_pct", "fuller_batch_pct"]) if check else daily
