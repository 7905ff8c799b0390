"""Fact tables reduced to daily frames.

Every builder takes the ledger, the settings and optionally `since`, a day: with it, only days
from that one on are produced. The day of a row comes from one table, whose scan is cut at the
matching height; tables joined to it are read over the whole window, because a message and its
gas may lie on different days. So a frame for some days equals those days of the full frame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from epochloom.config import (
    ACTIVATION_FIELDS,
    ARCHETYPE_COUNT_FIELDS,
    ATTO_PER_COIN,
    PATH_COUNT_FIELDS,
    PRECOMMIT_BATCH,
    PROVE_AGGREGATE,
    PROVE_COMMIT,
    PROVE_UPDATES,
    LedgerConfig,
)
from epochloom.functions.amounts import coins, lifetime_cost, number, ratio
from epochloom.functions.classes import size_class
from epochloom.functions.params import (
    message_arrays,
    notifies_market,
    notifies_market_strict,
)
from epochloom.functions.time import epoch_to_day, phase_of
from epochloom.operators.messages import (
    fee_per_class,
    fold_messages,
    gas_by_message,
    mean_cost_per_sector,
    of_ids,
    sectors_of,
    with_event_counts,
)
from epochloom.operators.percentiles import day_percentiles
from epochloom.operators.state import state_changes
from epochloom.sources.tables import Ledger, in_window, resolve_column

POWERS = ("raw_byte_power", "quality_adj_power")
Day = dt.date | None


def start_height(cfg: LedgerConfig, since: Day, after: int | None = None) -> int:
    """Height a scan starts after: the window start, or the end of the day before `since`."""
    start = cfg.window_start if after is None else after
    if since is None:
        return start
    return max(start, cfg.first_epoch_of((since - dt.date(1970, 1, 1)).days) - 1)


def dated(
    df: DataFrame, cfg: LedgerConfig, since: Day = None, after: int | None = None
) -> DataFrame:
    """In-window rows with their day."""
    rows = in_window(df, cfg, start_height(cfg, since, after))
    return rows.withColumn("date", epoch_to_day(F.col("height"), cfg))


def base_fees(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, p50, p95 in atto; a day whose fees are all NULL still has a row."""
    fees = dated(t.block_headers, cfg, since).select(
        "date", number(F.col("parent_base_fee")).alias("fee")
    )
    return day_percentiles(fees, "fee", {"p50": 0.5, "p95": 0.95})


def burn(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, total, dispute, onboarding, other: coins burnt, by class of message."""
    start = start_height(cfg, since)
    return fee_per_class(t.derived_gas_outputs, t.parsed_messages, ATTO_PER_COIN, cfg, start)


def supply(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, circulating_fil, burnt_fil: daily means in coins."""
    return (
        dated(t.chain_economics, cfg, since)
        .groupBy("date")
        .agg(
            coins(F.avg(number(F.col("circulating_fil")))).alias("circulating_fil"),
            coins(F.avg(number(F.col("burnt_fil")))).alias("burnt_fil"),
        )
    )


def rewards(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, top: the largest cumulative reward of the day, in atto."""
    top = F.max(number(F.col("total_mined_reward"))).alias("top")
    return dated(t.chain_rewards, cfg, since).groupBy("date").agg(top)


def sector_events(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, event, phase, events."""
    return (
        dated(t.miner_sector_events, cfg, since)
        .groupBy("date", "event", phase_of(F.col("height"), cfg).alias("phase"))
        .agg(F.count("*").alias("events"))
    )


def activations(
    t: Ledger,
    cfg: LedgerConfig,
    since: Day = None,
    strict: bool = False,
    fields: Mapping[str, str] = ACTIVATION_FIELDS,
) -> DataFrame:
    """date, total, market: activated sectors, and those that notify the market actor.

    Sectors are classed inside each message's own array; no row per sector is made.
    """
    through_market = notifies_market_strict if strict else notifies_market
    sectors = F.coalesce(
        *[F.when(F.col("method") == method, F.col("arrays")[field]) for method, field in fields.items()]
    )
    return (
        dated(t.parsed_messages, cfg, since, cfg.onboarding_window_start)
        .where(F.col("method").isin(*fields))
        .select("date", "method", message_arrays(t.parsed_messages, fields.values()).alias("arrays"))
        .select("date", sectors.alias("sectors"))
        .groupBy("date")
        .agg(
            F.sum(F.array_size("sectors")).alias("total"),
            F.sum(F.array_size(F.filter("sectors", through_market))).alias("market"),
        )
        .where(F.col("total") > 0)
    )


PATH_EVENT_METHODS = (PROVE_COMMIT, PROVE_AGGREGATE, PROVE_UPDATES)
ARCHETYPE_EVENT_METHODS = (PROVE_COMMIT,)


def onboarding(
    t: Ledger,
    cfg: LedgerConfig,
    since: Day = None,
    counts: Sequence[str] = ("path_sectors", "archetype_sectors"),
    events: bool = True,
    gas: str | None = "all",
    archetype_fields: Mapping[str, Sequence[str]] = ARCHETYPE_COUNT_FIELDS,
    prefer: str = "params",
) -> DataFrame:
    """Onboarding messages with their sector counts and gas, equal ones folded.

    The parameters are parsed, and messages, events and gas brought together by id, once for
    all frames below. `counts`, `events` and `gas` (None or "window") leave out what a single
    frame does not use.
    """
    start = start_height(cfg, since)
    sources = {
        "path_sectors": (PATH_COUNT_FIELDS, PATH_EVENT_METHODS),
        "archetype_sectors": (archetype_fields, ARCHETYPE_EVENT_METHODS),
    }
    fields = {name: sources[name][0] for name in counts}
    rows = fold_messages(t.parsed_messages, fields, cfg, start)
    if events:
        id_column = resolve_column(t.miner_sector_events)
        rows = with_event_counts(
            rows, t.parsed_messages, t.miner_sector_events, id_column, cfg, start
        )
        rows = rows.withColumns(
            {name: sectors_of(name, sources[name][1], prefer) for name in counts}
        ).drop("seen")
    for name in counts:
        counted = F.when(F.col("method").isin(*fields[name]), F.col(name))
        rows = rows.withColumn(name, counted)
    if gas is None:
        return rows
    outputs = t.derived_gas_outputs
    matched = in_window(outputs, cfg) if gas == "window" else outputs
    if start > cfg.window_start:
        # A refresh: few ids are new, and all other gas goes before it is folded.
        methods = sorted({method for by_method in fields.values() for method in by_method})
        new = in_window(t.parsed_messages, cfg, start).where(F.col("method").isin(*methods))
        matched = of_ids(matched, new)
    return rows.join(gas_by_message(matched, cfg), "cid", "left")


def _given(messages: DataFrame | None, t: Ledger, cfg: LedgerConfig, since: Day, **parts):
    return onboarding(t, cfg, since, **parts) if messages is None else messages


def path_costs(
    t: Ledger, cfg: LedgerConfig, since: Day = None, messages: DataFrame | None = None
) -> DataFrame:
    """date, method, cost: mean nano cost per sector of each onboarding path."""
    rows = _given(messages, t, cfg, since, counts=["path_sectors"], gas="window")
    return mean_cost_per_sector(rows, "path_sectors", ["date", "method"], "cost")


def archetype_costs(
    t: Ledger, cfg: LedgerConfig, since: Day = None, messages: DataFrame | None = None
) -> DataFrame:
    """date, sp_archetype, cost: mean cost per method and size class, summed over methods."""
    rows = _given(messages, t, cfg, since, counts=["archetype_sectors"], gas="window")
    classed = rows.withColumn("sp_archetype", size_class(F.col("archetype_sectors"), cfg))
    by_method = ["date", "method", "sp_archetype"]
    return (
        mean_cost_per_sector(classed, "archetype_sectors", by_method, "cost")
        .groupBy("date", "sp_archetype")
        .agg(F.sum("cost").alias("cost"))
    )


def batch_gas(
    t: Ledger, cfg: LedgerConfig, since: Day = None, messages: DataFrame | None = None
) -> DataFrame:
    """date, gas_per_sector: gas used by batched pre-commits over the sectors they carry.

    Unlike the fees, the gas matched here carries no window of its own.
    """
    rows = _given(messages, t, cfg, since, counts=["path_sectors"], events=False)
    batches = rows.where(
        (F.col("method") == PRECOMMIT_BATCH)
        & (F.col("path_sectors") > 0)
        & (F.col("gas_rows") > 0)
    )
    gas, sectors = F.col("gas_used"), F.col("path_sectors") * F.col("gas_rows")
    per_sector = ratio(F.sum(F.col("copies") * gas), F.sum(F.col("copies") * sectors))
    return batches.groupBy("date").agg(per_sector.alias("gas_per_sector"))


def batch_sizes(
    t: Ledger, cfg: LedgerConfig, since: Day = None, messages: DataFrame | None = None
) -> DataFrame:
    """date, sector_count, messages of the batched pre-commits; the count may be NULL."""
    if messages is None:
        # Needs neither side nor folding by id, so each message counts as one.
        messages = dated(t.parsed_messages, cfg, since).select(
            "date",
            "method",
            F.array_size(message_arrays(t.parsed_messages, ["Sectors"])["Sectors"])
            .cast("bigint")
            .alias("path_sectors"),
            F.lit(1).cast("bigint").alias("copies"),
        )
    return _sizes(messages, PRECOMMIT_BATCH)


def aggregate_sizes(
    t: Ledger, cfg: LedgerConfig, since: Day = None, messages: DataFrame | None = None
) -> DataFrame:
    """date, sector_count, messages of the aggregated proofs, with the event fallback."""
    rows = _given(messages, t, cfg, since, counts=["path_sectors"], gas=None)
    return _sizes(rows, PROVE_AGGREGATE)


def _sizes(messages: DataFrame, method: str) -> DataFrame:
    return (
        messages.where(F.col("method") == method)
        .groupBy("date", F.col("path_sectors").alias("sector_count"))
        .agg(F.sum("copies").alias("messages"))
    )


def gas_totals(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, gas_used, gas_limit."""
    return (
        dated(t.derived_gas_outputs, cfg, since)
        .groupBy("date")
        .agg(F.sum("gas_used").alias("gas_used"), F.sum("gas_limit").alias("gas_limit"))
    )


def miner_counts(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, participating_miner_count: the day's largest reading."""
    top = F.max("participating_miner_count").alias("participating_miner_count")
    return dated(t.chain_powers, cfg, since).groupBy("date").agg(top)


def power_changes(t: Ledger, cfg: LedgerConfig, since: Day = None) -> DataFrame:
    """date, miner_id and the powers after each day's last change; date NULL is the seed."""
    claims = t.power_actor_claims
    if since is not None:
        claims = in_window(claims, cfg, start_height(cfg, since))
    claims = claims.select(
        "height", "miner_id", *[F.col(c).cast("double").alias(c) for c in POWERS]
    )
    return state_changes(claims, "miner_id", ["height"], POWERS, cfg)


def day_marks(facts: DataFrame) -> DataFrame | None:
    """(date, mark): a sum of hashes over the files and rows of each stored day, which differs once
    rows are added to it. Only file footers are read. None for a table without day partitions."""
    if "day" not in facts.columns:
        return None
    file = F.xxhash64(
        *[f"_metadata.{c}" for c in ("file_path", "file_size", "file_modification_time")]
    )
    return (
        facts.select(F.col("day").alias("date"), file.cast("decimal(38,0)").alias("file"))
        .groupBy("date")
        .agg(F.sum("file").cast("string").alias("mark"))
    )


def fee_costs(
    t: Ledger, cfg: LedgerConfig, since: Day = None, days: Sequence[dt.date] | None = None
) -> DataFrame:
    """date, cost, sectors: mean projected fee over declared lifetimes, and the rows behind it.

    `days` names the activation days to build, of a table with day partitions.
    """
    start, end, fee = F.col("activation_epoch"), F.col("expiration_epoch"), F.col("daily_fee")
    first = start_height(cfg, since, cfg.upgrade_epoch - 1) + 1
    sectors = t.miner_sector_infos
    if "day" in sectors.columns:
        sectors = sectors.where(F.col("day") >= epoch_to_day(F.lit(first), cfg))
    if days is not None:
        sectors = sectors.where(F.col("day").isin(*days))
    valid = (start >= first) & (end > start) & fee.isNotNull() & (number(fee) > 0)
    return (
        sectors.where(valid)
        .groupBy(epoch_to_day(start, cfg).alias("date"))
        .agg(
            F.avg(lifetime_cost(fee, start, end, cfg)).alias("cost"),
            F.count("*").alias("sectors"),
        )
    )


# Frames taken from the onboarding messages, and frames taken from the facts themselves.
FROM_ONBOARDING = {
    f.__name__: f for f in (path_costs, archetype_costs, batch_gas, batch_sizes, aggregate_sizes)
}
FROM_FACTS = {
    f.__name__: f
    for f in (
        base_fees,
        burn,
        supply,
        rewards,
        sector_events,
        activations,
        gas_totals,
        miner_counts,
        power_changes,
        fee_costs,
    )
}
MARTS = {**FROM_FACTS, **FROM_ONBOARDING}
ONBOARDING = "onboarding"
# What stored frames hold beside their `date`.
FRAME_SCHEMAS = {
    "base_fees": "p50 DOUBLE, p95 DOUBLE",
    "burn": "total DOUBLE, dispute DOUBLE, onboarding DOUBLE, other DOUBLE",
    "supply": "circulating_fil DOUBLE, burnt_fil DOUBLE",
    "rewards": "top DOUBLE",
    "sector_events": "event STRING, phase STRING, events BIGINT",
    "activations": "total BIGINT, market BIGINT",
    "gas_totals": "gas_used BIGINT, gas_limit BIGINT",
    "miner_counts": "participating_miner_count BIGINT",
    "power_changes": "miner_id STRING, raw_byte_power DOUBLE, quality_adj_power DOUBLE",
    "fee_costs": "cost DOUBLE, sectors BIGINT",
    ONBOARDING: (
        "cid STRING, method STRING, path_sectors BIGINT, archetype_sectors BIGINT, "
        "copies BIGINT, fee DOUBLE, fee_rows BIGINT, window_rows BIGINT, gas_used DOUBLE, "
        "gas_rows BIGINT"
    ),
    "path_costs": "method STRING, cost DOUBLE",
    "archetype_costs": "sp_archetype STRING, cost DOUBLE",
    "batch_gas": "gas_per_sector DOUBLE",
    "batch_sizes": "sector_count BIGINT, messages BIGINT",
    "aggregate_sizes": "sector_count BIGINT, messages BIGINT",
}
# The tables whose rows a frame's days are made of. Sectors may be added for any past day, so
# `fee_costs` has none; the days to build are told by the marks of its files.
FRAME_TABLES = {
    "base_fees": ("block_headers",),
    "burn": ("derived_gas_outputs", "parsed_messages"),
    "supply": ("chain_economics",),
    "rewards": ("chain_rewards",),
    "sector_events": ("miner_sector_events",),
    "activations": ("parsed_messages",),
    "gas_totals": ("derived_gas_outputs",),
    "miner_counts": ("chain_powers",),
    "power_changes": ("power_actor_claims",),
    ONBOARDING: ("parsed_messages", "miner_sector_events", "derived_gas_outputs"),
}


class Marts:
    """The daily frames of one ledger: stored ones where given, planned ones otherwise."""

    def __init__(
        self,
        ledger: Ledger | None = None,
        cfg: LedgerConfig | None = None,
        stored: Mapping[str, DataFrame] | None = None,
    ):
        self.cfg = cfg or LedgerConfig()
        self._ledger = ledger
        self._frames = dict(stored or {})
        #: What a stored run counted while it wrote its frames.
        self.figures: dict[str, dict[str, int]] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if self._ledger is None:
                raise KeyError(name)
            self._frames[name] = MARTS[name](self._ledger, self.cfg)
        return self._frames[name]


def events_where(condition: Column, count: str = "events") -> Column:
    """Sum of counts over rows that meet the condition; 0 where none does."""
    return F.coalesce(F.sum(F.when(condition, F.col(count))), F.lit(0).cast("bigint"))
