"""The scheduled refresh: recompute recent days only.

Facts arrive in height order within a table, but tables may lag behind each other. Each run
rebuilds every daily frame from the newest day that all of its tables had reached, replaces those
day partitions, and finishes every metric from the stored frames, whose windows need earlier days
but no earlier facts. Frames over sector lifetimes are built in full, for a sector may be recorded
long after its activation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from epochloom.config import LedgerConfig
from epochloom.plans.marts import FRAME_TABLES, Marts
from epochloom.plans.runner import publish_metrics, reached_days, store_marts, write_metrics
from epochloom.sources.tables import Ledger


def refresh(
    spark: SparkSession,
    ledger: Ledger,
    cfg: LedgerConfig,
    mart_root: str,
    out_root: str | None = None,
    since: dt.date | None = None,
    overlap_days: int = 1,
    check: bool = True,
    versions: bool = False,
) -> Marts:
    """Bring stored frames and metrics up to date with the ledger.

    Without `since`, each frame starts `overlap_days` before the day up to which it was complete
    after the last finished run; that day may have been stored while still partial. With
    `versions`, the metrics are published as a whole, beside the versions before.
    """
    back = dt.timedelta(days=overlap_days)
    starts = {frame: day - back for frame, day in reached_days(spark, mart_root).items()}
    if since is not None:
        starts = dict.fromkeys(FRAME_TABLES, since)
    marts = store_marts(spark, ledger, cfg, mart_root, starts)
    if out_root is not None and versions:
        publish_metrics(spark, marts, out_root, check=check)
    elif out_root is not None:
        write_metrics(marts, out_root, check=check)
    return marts
