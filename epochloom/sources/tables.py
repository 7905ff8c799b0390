"""The ledger's fact tables: schemas, loading and window filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from epochloom.config import MESSAGE_ID_COLUMNS, LedgerConfig
from epochloom.functions.params import VARIANT
from epochloom.functions.time import epoch_to_day

AMOUNT = "DECIMAL(38,0)"
SCHEMAS = {
    "block_headers": f"height BIGINT, parent_base_fee {AMOUNT}",
    "derived_gas_outputs": (
        f"height BIGINT, cid STRING, base_fee_burn {AMOUNT}, over_estimation_burn {AMOUNT}, "
        "gas_used BIGINT, gas_limit BIGINT"
    ),
    "parsed_messages": "height BIGINT, cid STRING, method STRING, params STRING",
    "miner_sector_events": "height BIGINT, event STRING, message_cid STRING",
    "power_actor_claims": (
        f"height BIGINT, miner_id STRING, raw_byte_power {AMOUNT}, quality_adj_power {AMOUNT}"
    ),
    "chain_economics": f"height BIGINT, circulating_fil {AMOUNT}, burnt_fil {AMOUNT}",
    "chain_rewards": f"height BIGINT, total_mined_reward {AMOUNT}",
    "chain_powers": "height BIGINT, participating_miner_count BIGINT",
    "miner_sector_infos": (
        f"activation_epoch BIGINT, expiration_epoch BIGINT, daily_fee {AMOUNT}"
    ),
}
# The table whose message id column differs between schema versions.
PROBED = "miner_sector_events"


class Ledger:
    """The fact tables by name; each is opened when a job first asks for it."""

    def __init__(self, **tables: Callable[[], DataFrame]):
        self._tables = tables
        self._opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = self._tables[name]()
        return self._opened[name]


def load_ledger(
    spark: SparkSession,
    root: str,
    declared: bool = True,
    names: Mapping[str, str] | None = None,
    variant: bool = False,
) -> Ledger:
    """Tables stored as Parquet folders under `root`, named otherwise where `names` says so.

    The events table keeps the schema of its files, because its message id column varies, and
    with `declared=False` so do the others, for instance where amounts are stored as text. With
    `variant`, messages were stored with their parsed parameters, and these are read.
    """
    schemas = dict(SCHEMAS)
    if variant:
        schemas["parsed_messages"] += f", {VARIANT} VARIANT"

    def table(name: str) -> DataFrame:
        reader = spark.read.schema(schemas[name]) if declared and name != PROBED else spark.read
        return reader.parquet(f"{root}/{(names or {}).get(name, name)}")

    return Ledger(**{name: partial(table, name) for name in SCHEMAS})


def catalog_ledger(
    spark: SparkSession, database: str | None = None, names: Mapping[str, str] | None = None
) -> Ledger:
    """Tables or views of the session's catalog."""

    def table(name: str) -> DataFrame:
        known = (names or {}).get(name, name)
        return spark.table(f"{database}.{known}" if database else known)

    return Ledger(**{name: partial(table, name) for name in SCHEMAS})


def _by_day(df: DataFrame, cfg: LedgerConfig) -> DataFrame:
    height = "activation_epoch" if "activation_epoch" in df.columns else "height"
    return df.withColumn("day", epoch_to_day(F.col(height), cfg))


def write_table(df: DataFrame, root: str, name: str, cfg: LedgerConfig) -> None:
    """Append facts as day partitions, so that later windows skip whole days.

    Rebalancing gives each day few files and splits a day much larger than the others.
    """
    _by_day(df, cfg).hint("rebalance", F.col("day")).write.mode("append").partitionBy(
        "day"
    ).parquet(f"{root}/{name}")


def write_buckets(
    df: DataFrame, root: str, table: str, cfg: LedgerConfig, buckets: int
) -> None:
    """Append messages, events or gas to a catalog table with day partitions, each in buckets of the
    message id. Tables that are joined need the same number of buckets.

    With `stored_by_id` set, jobs over such tables plan no exchange of the facts. A day has one
    file per bucket, so appends should hold whole days.
    """
    key = resolve_column(df, ("cid", *MESSAGE_ID_COLUMNS))
    if key is None:
        raise ValueError(f"{table} has no message id")
    laid_out = _by_day(df, cfg).repartition(buckets, key)
    name = table.rpartition(".")[2]
    laid_out.write.mode("append").partitionBy("day").bucketBy(buckets, key).sortBy(key).option(
        "path", f"{root}/{name}"
    ).saveAsTable(table)


def resolve_column(df: DataFrame, preferred: Sequence[str] = MESSAGE_ID_COLUMNS) -> str | None:
    """First preferred column the table has, or None."""
    return next((c for c in preferred if c in df.columns), None)


def in_window(df: DataFrame, cfg: LedgerConfig, after: int | None = None) -> DataFrame:
    """Rows strictly above a height, the window start unless given.

    The comparison reaches the Parquet scan; where the table has day partitions, whole days
    are skipped as well.
    """
    start = cfg.window_start if after is None else after
    rows = df.where(F.col("height") > start)
    if "day" in df.columns:
        rows = rows.where(F.col("day") >= epoch_to_day(F.lit(start + 1), cfg))
    return rows
