"""Checks on results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F


def pct_sum_report(
    daily: DataFrame, columns: Sequence[str], target: float, tolerance: float
) -> DataFrame:
    """One row: largest distance of the columns' sum from the target, and days out of bounds."""
    off = F.abs(reduce(add, [F.col(c) for c in columns]) - F.lit(target))
    return daily.agg(
        F.max(off).alias("max_off"),
        F.count_if(off >= tolerance).alias("days_off"),
        F.count(off).alias("days_checked"),
    )


def check_pct_sum(
    daily: DataFrame, columns: Sequence[str], target: float = 100.0, tolerance: float = 0.5
) -> DataFrame:
    """The frame, whose columns raise an error when a day that breaks the sum is computed.

    The check is part of the plan: nothing runs before the frame is used, and nothing twice.
    """
    off = F.abs(reduce(add, [F.col(c) for c in columns]) - F.lit(target))
    said = F.concat(
        F.lit(f"{' + '.join(columns)} should be about {target}, but is off by "),
        F.round(off, 4).cast("string"),
        F.lit(" on "),
        F.col("date").cast("string"),
    )
    broken = off >= tolerance
    return daily.withColumns(
        {c: F.when(broken, F.raise_error(said).cast("double")).otherwise(F.col(c)) for c in columns}
    )


def repeated_ids(df: DataFrame, key: str = "cid") -> DataFrame:
    """Ids that occur more than once; joins on them multiply rows."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
