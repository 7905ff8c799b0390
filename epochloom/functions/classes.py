"""Labels for methods and batch sizes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from epochloom.config import DISPUTE_METHODS, ONBOARDING_METHODS, LedgerConfig

METHOD_CLASSES = ("dispute", "onboarding", "other")


def method_class(method: Column) -> Column:
    """A NULL method belongs to no class."""
    return (
        F.when(method.isin(*DISPUTE_METHODS), "dispute")
        .when(method.isin(*ONBOARDING_METHODS), "onboarding")
        .when(method.isNotNull(), "other")
    )


def size_class(sectors: Column, cfg: LedgerConfig) -> Column:
    return (
        F.when(sectors >= cfg.large_batch_from, "large_sp")
        .when(sectors >= cfg.small_batch_below, "medium_sp")
        .otherwise("small_sp")
    )
