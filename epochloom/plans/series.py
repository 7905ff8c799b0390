"""Chart-ready long series over the daily metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from epochloom.functions.amounts import finite
from epochloom.functions.time import day_millis


@dataclass(frozen=True)
class Chart:
    metric: str
    columns: tuple[str, ...]
    unit: str

    @property
    def name(self) -> str:
        return f"{self.metric}:{self.columns[0]}"


# Which columns are drawn together, and their units.
CHARTS = (
    Chart("power_added", ("raw_power_added",), "PiB"),
    Chart("power_added", ("quality_adjusted_power_added",), "PiB (QAP)"),
    Chart("participating_miner_count", ("participating_miner_count",), "Miners"),
    Chart(
        "precommit_sector_batch_size",
        ("avg_sectors_per_message", "median_sectors_per_message"),
        "Sectors",
    ),
    Chart("precommit_sector_batch_size", ("messages", "aggregate_messages"), "Messages"),
    Chart(
        "precommit_sector_batch_size", ("avg_aggregate_size", "median_aggregate_size"), "Sectors"
    ),
    Chart(
        "gas_per_sector_by_path",
        (
            "PreCommitSectorBatch2",
            "ProveCommitSectors3",
            "ProveCommitAggregate",
            "ProveReplicaUpdates3",
        ),
        "nanoFIL",
    ),
    Chart("ddo_sector_onboarding", ("ddo_sectors", "non_ddo_sectors"), "Sectors"),
    Chart("small_batch_count", ("fuller_batch_pct",), "%"),
    Chart("fil_return_per_sector", ("fil_return_per_sector",), "FIL / sector"),
    Chart("daily_fee_burn", ("total_fee_burn_fil", "sector_onboarding_gas_fil"), "FIL"),
    Chart("sector_lifetime_cost", ("large_sp", "medium_sp", "small_sp"), "nanoFIL"),
    Chart("sector_daily_fee_cost", ("avg_daily_fee_lifetime_cost_nanofil",), "nanoFIL"),
    Chart("base_fee_percentiles", ("base_fee_p50_nanofil", "base_fee_p95_nanofil"), "nanoFIL"),
    Chart("gas_utilization", ("gas_utilization_pct",), "%"),
    Chart("gas_utilization", ("theoretical_max_sectors_per_day",), "Sectors / day"),
    Chart(
        "burn_composition",
        ("dispute_termination_gas_fil", "sector_onboarding_gas_fil", "other_burn_fil"),
        "FIL",
    ),
    Chart("circulating_supply_vs_burn", ("circulating_fil", "burnt_fil"), "FIL"),
    Chart("circulating_supply_vs_burn", ("circulating_growth_pct", "daily_burn_rate_pct"), "%"),
    Chart(
        "sector_extensions",
        (
            "extensions_pre_grace",
            "extensions_during_grace",
            "extensions_post_grace",
            "baseline_rolling_30d",
        ),
        "Extensions",
    ),
    Chart("renewal_rate", ("expired_count", "extended_count"), "Sectors"),
    Chart(
        "renewal_rate",
        ("renewal_rate_pre_pct", "renewal_rate_during_pct", "renewal_rate_post_pct"),
        "%",
    ),
)


def series_unpivot(
    daily: DataFrame, columns: Sequence[str], labels: Sequence[str] | None = None
) -> DataFrame:
    """(series, date, x_millis, y): the finite points of each column, one row per point."""
    points = F.explode(
        F.array(
            *[
                F.struct(F.lit(label).alias("series"), finite(F.col(c)).alias("y"))
                for c, label in zip(columns, labels or columns, strict=True)
            ]
        )
    ).alias("p")
    return (
        daily.where(F.col("date").isNotNull())
        .select("date", points)
        .select("p.series", "date", day_millis(F.col("date")).alias("x_millis"), "p.y")
        .where(F.col("y").isNotNull())
    )


def drawn(daily: DataFrame, charts: Sequence[Chart]) -> DataFrame:
    """(chart, series, unit, date, x_millis, y): the finite points of charts whose columns one frame
    holds, in one pass over it."""
    points = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(chart.name).alias("chart"),
                    F.lit(c).alias("series"),
                    F.lit(chart.unit).alias("unit"),
                    finite(F.col(c)).alias("y"),
                )
                for chart in charts
                for c in chart.columns
            ]
        )
    ).alias("p")
    return (
        daily.where(F.col("date").isNotNull())
        .select("date", points)
        .where(F.col("p.y").isNotNull())
        .select(
            "p.chart", "p.series", "p.unit", "date", day_millis(F.col("date")).alias("x_millis"), "p.y"
        )
    )


def series_points(daily: DataFrame, column: str) -> DataFrame:
    """(date, x_millis, y), oldest first."""
    return series_unpivot(daily, [column]).drop("series").orderBy("x_millis")


def chart_series(metrics: Mapping[str, DataFrame], charts: Sequence[Chart] = CHARTS) -> DataFrame:
    """(chart, series, unit, date, x_millis, y) of every chart, each metric planned once."""
    wanted: dict[str, list[Chart]] = {}
    for chart in charts:
        wanted.setdefault(chart.metric, []).append(chart)
    return reduce(DataFrame.unionByName, [drawn(metrics[m], c) for m, c in wanted.items()])


def series_has_data(
    daily: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(series, points, has_data) for each column, including columns without a point."""
    points = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("series"), finite(F.col(c)).alias("y")) for c in columns]
        )
    ).alias("p")
    counted = daily.select(points).groupBy("p.series").agg(F.count("p.y").alias("points"))
    return counted.withColumn("has_data", F.col("points") > 0)


def phase_coverage(renewal: DataFrame) -> DataFrame:
    """(phase, covered): whether any day has a rate for the phase and observed expiries."""
    phases = ("pre", "during", "post")
    seen = {
        p: finite(F.col(f"renewal_rate_{p}_pct")).isNotNull() & (F.col("expired_count") > 0)
        for p in phases
    }
    wide = renewal.agg(
        *[F.coalesce(F.bool_or(seen[p]), F.lit(False)).alias(p) for p in phases]
    )
    return wide.unpivot([], list(phases), "phase", "covered")
