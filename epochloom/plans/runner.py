"""Full runs: daily frames stored once, then every metric as JSON records."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from epochloom.config import LedgerConfig
from epochloom.functions.time import epoch_to_day
from epochloom.plans.marts import (
    FRAME_SCHEMAS,
    FRAME_TABLES,
    FROM_FACTS,
    FROM_ONBOARDING,
    MARTS,
    ONBOARDING,
    Marts,
    day_marks,
    onboarding,
)
from epochloom.plans.metrics import DAILY
from epochloom.sources.json_records import read_records, write_records
from epochloom.sources.tables import Ledger, in_window

STATE = "_reached"
STATE_SCHEMA = "frame STRING, date DATE"
MARKS = "_marks"
MARKS_SCHEMA = "date DATE, mark STRING"


def frame_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(f"{FRAME_SCHEMAS[name]}, date DATE")


def _figures(name: str) -> dict[str, Column]:
    """What is counted of a stored frame while it is written."""
    copies = F.col("copies")
    if name == "batch_sizes":
        missing = F.when(F.col("sector_count").isNull(), F.col("messages"))
        return {"messages": F.sum("messages"), "without_count": F.sum(missing)}
    if name == ONBOARDING:
        return {
            "messages": F.sum("copies"),
            "repeated": F.sum(F.when(copies > 1, copies)),
            "without_gas": F.sum(F.when(F.col("gas_rows").isNull(), copies)),
            "repeated_gas": F.sum(F.when(F.col("gas_rows") > 1, copies)),
            "without_sectors": F.sum(F.when(F.col("path_sectors").isNull(), copies)),
        }
    return {}


def store_mart(
    df: DataFrame, root: str, name: str, replace_days_only: bool = False
) -> dict[str, int]:
    """Write a daily frame as day partitions, replacing all of it or only the days it holds, and
    return its figures, counted in the same job.

    Rebalancing gives each day few files and splits a day that is much larger than others.
    """
    mode = "dynamic" if replace_days_only else "static"
    declared = df.select(*[F.col(f.name).cast(f.dataType) for f in frame_schema(name)])
    wanted, seen = _figures(name), None
    if wanted:
        seen = Observation(name)
        zero = F.lit(0).cast("bigint")
        counts = [F.coalesce(c.cast("bigint"), zero).alias(n) for n, c in wanted.items()]
        declared = declared.observe(seen, F.count("*").alias("rows"), *counts)
    declared.hint("rebalance", F.col("date")).write.mode("overwrite").option(
        "partitionOverwriteMode", mode
    ).partitionBy("date").parquet(f"{root}/{name}")
    return dict(seen.get) if seen else {}


def stored_frame(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored frame by its declared schema, so one without any row can be read too."""
    return spark.read.schema(frame_schema(name)).parquet(f"{root}/{name}")


def _kept(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """The rows of a small table, none where there is no such table yet."""
    try:
        return spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def reached_days(spark: SparkSession, root: str) -> dict[str, dt.date]:
    """Up to which day each frame was complete after the last run that finished; empty before
    the first one and after a full run that broke off."""
    return {r.frame: r.date for r in _kept(spark, f"{root}/{STATE}", STATE_SCHEMA)}


def changed_days(
    spark: SparkSession, ledger: Ledger, root: str
) -> tuple[dict[dt.date, str], list[dt.date] | None]:
    """Marks of the activation days as they are now, and the days whose mark is another than after
    the last finished run. None where that can't be told, and all days are to be built; so it is
    too when a day is gone."""
    found = day_marks(ledger.miner_sector_infos)
    if found is None:
        return {}, None
    # one row per calendar day
    now = {r.date: r.mark for r in found.collect()}
    before = {r.date: r.mark for r in _kept(spark, f"{root}/{MARKS}", MARKS_SCHEMA)}
    if not before or set(before) - set(now):
        return now, None
    return now, sorted(day for day, mark in now.items() if before.get(day) != mark)


def _write_small(spark: SparkSession, rows: list, schema: str, path: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def complete_days(ledger: Ledger, cfg: LedgerConfig) -> dict[str, dt.date]:
    """Per frame the newest day that all of its tables have reached; without one, no entry."""
    newest = {}
    for table in sorted({t for tables in FRAME_TABLES.values() for t in tables}):
        top = in_window(getattr(ledger, table), cfg).agg(F.max("height").alias("height"))
        newest[table] = top.select(epoch_to_day(F.col("height"), cfg)).first()[0]
    found = {frame: [newest[t] for t in tables] for frame, tables in FRAME_TABLES.items()}
    return {frame: min(days) for frame, days in found.items() if None not in days}


def stored_marts(spark: SparkSession, cfg: LedgerConfig, root: str) -> Marts:
    return Marts(cfg=cfg, stored={n: stored_frame(spark, root, n) for n in MARTS})


def store_marts(
    spark: SparkSession,
    ledger: Ledger,
    cfg: LedgerConfig,
    root: str,
    since: Mapping[str, dt.date] | None = None,
) -> Marts:
    """Build and store every daily frame and read them back; `since` names the frames of which
    only the days from a given one on are built.

    `figures` of the result holds, by frame, what was counted while it was written: messages in
    all, repeated ones, and those without gas or without a count.

    A job that later loses an executor re-reads these files. A day left without rows keeps its
    earlier result where `since` applies, which append-only facts never bring about.
    """
    since = since or {}
    if not since:
        # Whatever an earlier run reached no longer holds once its frames are overwritten.
        _write_small(spark, [], STATE_SCHEMA, f"{root}/{STATE}")
        _write_small(spark, [], MARKS_SCHEMA, f"{root}/{MARKS}")
    # Taken before the frames, so that facts arriving meanwhile are read again next time.
    reached = complete_days(ledger, cfg)
    marks, changed = changed_days(spark, ledger, root)
    figures = {}
    for name, build in FROM_FACTS.items():
        if name == "fee_costs":
            if changed is None:
                store_mart(build(ledger, cfg), root, name)
            elif changed:
                store_mart(build(ledger, cfg, days=changed), root, name, True)
            continue
        day = since.get(name)
        store_mart(build(ledger, cfg, day), root, name, day is not None)
    day = since.get(ONBOARDING)
    figures[ONBOARDING] = store_mart(
        onboarding(ledger, cfg, day), root, ONBOARDING, day is not None
    )
    messages = stored_frame(spark, root, ONBOARDING)
    if day is not None:
        messages = messages.where(F.col("date") >= F.lit(day))
    for name, build in FROM_ONBOARDING.items():
        seen = store_mart(build(ledger, cfg, day, messages), root, name, day is not None)
        figures |= {name: seen} if seen else {}
    # Written last, so a run that breaks off is repeated from the same days.
    _write_small(spark, sorted(marks.items()), MARKS_SCHEMA, f"{root}/{MARKS}")
    _write_small(spark, sorted(reached.items()), STATE_SCHEMA, f"{root}/{STATE}")
    marts = stored_marts(spark, cfg, root)
    marts.figures = figures
    return marts


def write_metrics(
    marts: Marts, out_root: str, only: Iterable[str] | None = None, check: bool = True
) -> list[str]:
    """Write `out_root/<metric>` for each metric and return the names written."""
    written = []
    for name in only or DAILY:
        options = {"check": check} if name == "small_batch_count" else {}
        write_records(DAILY[name](marts, **options), f"{out_root}/{name}")
        written.append(name)
    return written


PUBLISHED = "published"
PUBLISHED_SCHEMA = "version STRING, metric STRING"


def publish_metrics(
    spark: SparkSession,
    marts: Marts,
    out_root: str,
    only: Iterable[str] | None = None,
    check: bool = True,
) -> str:
    """Write the metrics as a new version and, when all are there, name it; returns the version.

    Nothing that a reader may hold is overwritten: versions are folders of their own, and naming
    one adds a single file to the list of versions, which is there or is not. A run that breaks off
    leaves the version before it in force.
    """
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    written = write_metrics(marts, f"{out_root}/{version}", only, check)
    named = spark.createDataFrame([(version, name) for name in written], PUBLISHED_SCHEMA)
    named.coalesce(1).write.mode("append").json(f"{out_root}/{PUBLISHED}")
    return version


def published(spark: SparkSession, out_root: str) -> tuple[str | None, list[str]]:
    """The newest named version and its metrics; None before the first."""
    try:
        rows = spark.read.schema(PUBLISHED_SCHEMA).json(f"{out_root}/{PUBLISHED}").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None, []
        raise
    newest = max((r.version for r in rows), default=None)
    return newest, sorted(r.metric for r in rows if r.version == newest)


def read_published(spark: SparkSession, out_root: str, metric: str, schema: str) -> DataFrame:
    """A metric's records of the newest version."""
    version, metrics = published(spark, out_root)
    if metric not in metrics:
        raise KeyError(metric)
    return read_records(spark, f"{out_root}/{version}/{metric}", schema)
