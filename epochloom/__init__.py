"""Daily metrics over proof-of-storage chain ledgers, as Spark DataFrame jobs."""

from epochloom.config import LedgerConfig

__all__ = ["LedgerConfig"]
