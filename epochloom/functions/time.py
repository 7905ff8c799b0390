"""Heights, days and phases.

A day is computed from the height with integer arithmetic, so it does not depend on the
session time zone and compiles into the scan's stage.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from epochloom.config import SECONDS_PER_DAY, LedgerConfig


def epoch_to_day(height: Column, cfg: LedgerConfig) -> Column:
    seconds = height.cast("bigint") * F.lit(cfg.epoch_seconds) + F.lit(cfg.genesis_unix)
    return F.date_from_unix_date(F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int"))


def phase_of(height: Column, cfg: LedgerConfig) -> Column:
    """'pre', 'during' or 'post' the grace window, by half-open bounds."""
    return (
        F.when(height < cfg.upgrade_epoch, "pre")
        .when(height < cfg.grace_end_epoch, "during")
        .otherwise("post")
    )


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def day_millis(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * F.lit(SECONDS_PER_DAY * 1000)
