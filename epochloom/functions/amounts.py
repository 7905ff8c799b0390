"""Amounts, units and ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from epochloom.config import ATTO_PER_COIN, ATTO_PER_NANO, BYTES_PER_PIB


def number(amount: Column) -> Column:
    return amount.cast("double")


def coins(amount: Column) -> Column:
    return number(amount) / F.lit(ATTO_PER_COIN)


def nanos(amount: Column) -> Column:
    return number(amount) / F.lit(ATTO_PER_NANO)


def pebibytes(size: Column) -> Column:
    return number(size) / F.lit(BYTES_PER_PIB)


def ratio(top: Column, bottom: Column) -> Column:
    """NULL where the divisor is zero or NULL."""
    return F.try_divide(number(top), number(bottom))


def percent(top: Column, bottom: Column, digits: int) -> Column:
    return F.round(ratio(F.lit(100.0) * top, bottom), digits)


def burnt_fee(unit: float) -> Column:
    """Cost of a message: base-fee burn plus over-estimation burn."""
    return (number(F.col("base_fee_burn")) + number(F.col("over_estimation_burn"))) / F.lit(unit)


def lifetime_cost(fee: Column, start: Column, end: Column, cfg) -> Column:
    """A daily fee projected over a sector's declared lifetime, in nano units."""
    days = (number(end) - number(start)) * F.lit(float(cfg.epoch_seconds)) / F.lit(86400.0)
    return number(fee) * days / F.lit(ATTO_PER_NANO)


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def finite(value: Column) -> Column:
    """The value as a double, or NULL when it is missing, not numeric, NaN or infinite.

    The cast alone would take a type suffix, as in "1d", for part of a number.
    """
    text = value.cast("string")
    x = F.when(text.rlike(NUMBER), text).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)
