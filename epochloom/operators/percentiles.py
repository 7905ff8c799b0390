"""Exact daily percentiles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from epochloom.functions.amounts import ratio

SLICES = 32
SKETCH_ACCURACY = 1000


def _ranks(fraction: float) -> tuple[Column, Column, Column]:
    """Zero-based ranks around the wanted position, and the share of the upper one."""
    position = F.lit(fraction) * (F.col("n") - 1)
    return F.floor(position), F.ceil(position), position - F.floor(position)


def _slice_of(value: Column, cuts: Column, low: int = 0, high: int = SLICES - 1) -> Column:
    """How many of the ascending cuts lie below the value, by halving: plain comparisons."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value > cuts[middle], _slice_of(value, cuts, middle + 1, high)).otherwise(
        _slice_of(value, cuts, low, middle)
    )


def day_percentiles(df: DataFrame, value: str, wanted: Mapping[str, float]) -> DataFrame:
    """One row per `date` with the named interpolated percentiles of `value`, NULLs skipped; rows
    without a date are left out.

    Rows are counted per day and value first, in one scan and one exchange, whose files the three
    steps after it share. A sketch of each day's distinct values proposes cut points; the slices
    between them are counted; and only the slices that hold a wanted rank are sorted. The counts
    are exact, so the sketch decides how evenly work spreads and never what the answer is; no day
    comes together in one buffer. A day without values has a row of NULLs.

    Cut points and slices with a rank are broadcast: the calendar bounds them, at `SLICES` numbers
    a day.
    """
    counted = (
        df.where(F.col("date").isNotNull())
        .groupBy("date", F.col(value).alias("v"))
        .agg(F.count("*").alias("copies"))
    )
    cuts = [i / SLICES for i in range(1, SLICES)]
    sketch = counted.groupBy("date").agg(
        F.percentile_approx("v", cuts, SKETCH_ACCURACY).alias("cuts"),
        F.sum(F.when(F.col("v").isNotNull(), F.col("copies"))).alias("n"),
    )
    known = F.when(F.col("v").isNotNull(), _slice_of(F.col("v"), F.col("cuts")))
    sliced = counted.join(F.broadcast(sketch), "date").select(
        "date", "v", "copies", "n", F.coalesce(known, F.lit(-1)).alias("slice")
    )
    slices = (
        sliced.groupBy("date", "n", "slice")
        .agg(F.sum(F.when(F.col("slice") >= 0, F.col("copies")).otherwise(0)).alias("size"))
        .withColumn(
            "before",
            F.sum("size").over(Window.partitionBy("date").orderBy("slice")) - F.col("size"),
        )
    )
    ranks = {name: _ranks(p) for name, p in wanted.items()}
    held = reduce(
        or_,
        [
            (rank >= F.col("before")) & (rank < F.col("before") + F.col("size"))
            for low, high, _ in ranks.values()
            for rank in (low, high)
        ],
        F.col("n").isNull(),  # such a day keeps the row of its NULLs
    )
    hit = slices.where(held).select("date", "slice", "before")
    in_slice = Window.partitionBy("date", "slice").orderBy("v")
    placed = (
        sliced.join(F.broadcast(hit), ["date", "slice"])
        .withColumn("end", F.col("before") + F.sum("copies").over(in_slice))
        .withColumn("start", F.col("end") - F.col("copies"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col("v")))

    found = placed.groupBy("date", "n").agg(
        *[
            at(rank).alias(f"{name}_{side}")
            for name, (low, high, _) in ranks.items()
            for side, rank in (("low", low), ("high", high))
        ],
    )
    return found.select(
        "date",
        *[
            (
                F.col(f"{name}_low")
                + (F.col(f"{name}_high") - F.col(f"{name}_low")) * share
            ).alias(name)
            for name, (_, _, share) in ranks.items()
        ],
    )


def counted_sizes(
    counts: DataFrame, value: str, weight: str, keep: Column | None = None
) -> DataFrame:
    """date, mean, median, rows: of `value`, each row standing for `weight` equal ones.

    The median is the lower middle element. Mean and median skip NULLs and what `keep` rules
    out; `rows` counts everything. For sizes already counted per day: the window sees one row
    per distinct size, and sizes that differ add up, so a day with S sectors in all holds at
    most about sqrt(2 S) of them.
    """
    by_day = Window.partitionBy("date")
    kept = F.col(value).isNotNull() if keep is None else F.col(value).isNotNull() & keep
    ranked = counts.select(
        "date",
        F.col(weight).alias("all"),
        F.when(kept, F.col(value)).alias("v"),
        F.when(kept, F.col(weight)).alias("w"),
    ).withColumns(
        {
            "reached": F.sum("w").over(by_day.orderBy("v")),
            "total": F.sum("w").over(by_day),
        }
    )
    return ranked.groupBy("date").agg(
        ratio(F.sum(F.col("v") * F.col("w")), F.sum("w")).alias("mean"),
        F.min(F.when(F.col("reached") * 2 >= F.col("total"), F.col("v"))).alias("median"),
        F.sum("all").alias("rows"),
    )
