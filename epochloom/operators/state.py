"""Change-driven state: a key has a row only when its values changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from epochloom.functions.time import epoch_to_day
from epochloom.config import LedgerConfig


def _latest(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Sequence[str]):
    """Last row per group by `order`, as an aggregate so each map task sends one row per group.

    The values themselves settle ties, which makes the choice independent of row order.
    """
    newest = F.max_by(F.struct(*values), F.struct(*order, *values))
    return df.groupBy(*by).agg(newest.alias("s")).select(*by, "s.*")


def daily_latest(
    df: DataFrame, key: str, order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    return _latest(df, ["date", key], order, values)


def seed_state(
    before: DataFrame, key: str, order: Sequence[str], values: Sequence[str], seen: DataFrame
) -> DataFrame:
    """Last row per key before the window, for keys that also appear inside it.

    Both sides are reduced to one row per key before they meet.
    """
    latest = _latest(before, [key], order, values)
    return latest.join(seen.select(key).distinct(), key, "left_semi")


def seed_anchor(daily: DataFrame, seed: DataFrame) -> DataFrame:
    """The daily rows plus the seed, placed on the day before the first one."""
    first = daily.agg(F.min("date").alias("first"))
    anchored = seed.withColumn("date", F.date_sub(first.scalar(), 1))
    return daily.unionByName(anchored.select(daily.columns))


def state_changes(
    claims: DataFrame, key: str, order: Sequence[str], values: Sequence[str], cfg: LedgerConfig
) -> DataFrame:
    """Last state per key and day, and per key before the window (date NULL), in one pass.

    `claims` has a `height`; the whole history shares a single scan and a single shuffle.
    """
    day = F.when(F.col("height") > cfg.window_start, epoch_to_day(F.col("height"), cfg))
    return _latest(claims.withColumn("date", day), ["date", key], order, values)


def _by_key(key: str):
    return Window.partitionBy(key).orderBy(F.asc_nulls_first("date"))


def carried(value: str, key: str) -> Column:
    """Last non-NULL value along a key's rows; for frames with one row per key and day."""
    frame = _by_key(key).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(frame)


def state_delta_daily(changes: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Day-over-day change of the total over all keys, from the change rows alone.

    Equal to filling every key forward over every day and differencing the totals, without
    building that grid. The first day has no predecessor and is NULL; a NULL value keeps the
    key's previous one. A key has at most one row per day here, so its window is short.
    """
    before = _by_key(key).rowsBetween(Window.unboundedPreceding, -1)
    deltas = changes.select(
        "date",
        *[
            (
                F.coalesce(carried(v, key), F.lit(0.0))
                - F.coalesce(F.last(v, ignorenulls=True).over(before), F.lit(0.0))
            ).alias(v)
            for v in values
        ],
    )
    daily = deltas.where(F.col("date").isNotNull()).groupBy("date").agg(
        *[F.sum(v).alias(v) for v in values]
    )
    has_previous = F.lag("date").over(Window.orderBy("date")).isNotNull()
    return daily.select("date", *[F.when(has_previous, F.col(v)).alias(v) for v in values])


def fill_forward(rows: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """(key, values, valid_from, valid_to): the values of a key from each change on.

    A value that a change leaves NULL keeps the one before. An interval holds on `valid_from` and
    the days after it, up to but without `valid_to`, which is NULL for a key's last one. There is
    one row per change row, so the result is never larger than the changes.
    """
    ordered = Window.partitionBy(key).orderBy("date")
    return rows.select(
        key,
        *[carried(v, key).alias(v) for v in values],
        F.col("date").alias("valid_from"),
        F.lead("date").over(ordered).alias("valid_to"),
    )


BIN_DAYS = 32


def state_on(
    intervals: DataFrame,
    asked: DataFrame,
    key: str,
    values: Sequence[str],
    date: str = "date",
    bin_days: int = BIN_DAYS,
) -> DataFrame:
    """The asked rows with the values that held for their key on their day; NULL before the first
    interval, and for a NULL key or day.

    `intervals` is what `fill_forward` returns. Time is cut into bins. What a key carries into a bin
    is the last state of an earlier one, from one row per key and bin that something happens in; and
    each bin is then looked through on its own, so a key with many changes or many questions spreads
    over as many tasks as it has bins. No row is made for a day on which nothing changes or is
    asked. Questions about one key and day are answered once.
    """
    bin_of = lambda day: F.floor(F.unix_date(day.cast("date")) / bin_days).alias("_bin")
    state = F.struct(*values).alias("_state")
    day = F.col(date).cast("date").alias("_day")
    changes = intervals.select(
        F.col(key).alias("_key"), F.col("valid_from").cast("date").alias("_day"), state
    ).withColumn("_asked", F.lit(False))
    questions = (
        asked.where(F.col(key).isNotNull() & F.col(date).isNotNull())
        .select(F.col(key).alias("_key"), day)
        .distinct()
        .withColumn("_asked", F.lit(True))
    )
    rows = changes.unionByName(questions, allowMissingColumns=True).withColumn(
        "_bin", bin_of(F.col("_day"))
    )
    earlier = Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    into = (
        rows.groupBy("_key", "_bin")
        .agg(F.max_by("_state", F.when(~F.col("_asked"), F.col("_day"))).alias("_last"))
        .select("_key", "_bin", F.last("_last", ignorenulls=True).over(earlier).alias("_state"))
        .where(F.col("_state").isNotNull())
        # before all days of the bin
        .withColumns({"_asked": F.lit(False), "_day": F.lit(None).cast("date")})
    )
    upto = (
        Window.partitionBy("_key", "_bin")
        .orderBy(F.asc_nulls_first("_day"), "_asked")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    answers = (
        rows.unionByName(into)
        .withColumn("_state", F.last("_state", ignorenulls=True).over(upto))
        .where("_asked")
        .select("_key", "_day", "_state")
    )
    same = (F.col(key) == F.col("_key")) & (F.col(date).cast("date") == F.col("_day"))
    return asked.join(answers, same, "left").select(
        *[F.col(c) for c in asked.columns], *[F.col(f"_state.{v}").alias(v) for v in values]
    )
