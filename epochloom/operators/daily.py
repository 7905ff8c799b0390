"""Operators on daily frames.

A daily frame has at most one row per calendar day and series, so an unpartitioned window
over it sees a few thousand rows however large the ledger is, and so it may be broadcast.
Never apply these to a fact table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from epochloom.functions.amounts import ratio


def by_day(*within: str):
    """Days in order; with ``within``, each value of those columns on its own."""
    return Window.partitionBy(*within).orderBy("date")


def newest_first(daily: DataFrame, *then: str) -> DataFrame:
    return daily.orderBy(F.desc("date"), *[F.asc(c) for c in then])


def previous(value: str, *within: str) -> Column:
    """The value of the previous row, which need not be the previous calendar day."""
    return F.lag(value).over(by_day(*within))


def change(value: str, *within: str) -> Column:
    return F.col(value) - previous(value, *within)


def trailing_mean(value: str, rows: int, min_samples: int = 1, within: Sequence[str] = ()) -> Column:
    """Mean of the last `rows` rows, NULLs skipped; NULL below `min_samples` values."""
    frame = by_day(*within).rowsBetween(1 - rows, 0)
    mean = F.avg(value).over(frame)
    if min_samples <= 1:
        return mean
    return F.when(F.count(value).over(frame) >= min_samples, mean)


def rolling_mean(
    daily: DataFrame, columns: Iterable[str], rows: int, min_samples: int = 1
) -> DataFrame:
    return daily.withColumns({c: trailing_mean(c, rows, min_samples) for c in columns})


def join_days(base: DataFrame, *others: DataFrame, how: str = "left") -> DataFrame:
    """Join daily frames on the day; the right sides are bounded by the calendar."""
    return reduce(lambda left, right: left.join(right, "date", how), others, base)


def pivot_mean(daily: DataFrame, names: str, value: str, columns: Sequence[str]) -> DataFrame:
    """Long to wide with fixed columns; absent names give NULL."""
    return daily.groupBy("date").pivot(names, list(columns)).agg(F.avg(value))


def cumulative_to_daily(df: DataFrame, value: str, name: str, scale: float) -> DataFrame:
    """Largest cumulative value of each day, differenced against the previous day present."""
    top = df.groupBy("date").agg(F.max(F.col(value).cast("double")).alias("top"))
    return top.select("date", (change("top") / F.lit(scale)).alias(name))


def yield_per_unit(
    increments: DataFrame, counts: DataFrame, increment: str, count: str, name: str
) -> DataFrame:
    """Increment per counted unit on days where both are positive."""
    both = join_days(increments, counts, how="inner")
    return both.where((F.col(increment) > 0) & (F.col(count) > 0)).select(
        "date", ratio(F.col(increment), F.col(count)).alias(name)
    )
