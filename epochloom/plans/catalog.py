"""All charts from one pass over each fact table.

The metrics of `plans.metrics` are planned one by one, so a page that draws them all would read
most tables several times. Here every table is read once for all of its measures:

* `readings`: tables whose rows are only counted or averaged per day. Their rows are put under
  each other, each with its own measures, and one aggregate by day makes them columns.
* `by_id`: messages, their gas and their sector-added events, laid out by message id. Equal rows
  are counted first, so what one id has in the end is bounded by days, methods and sizes, however
  hot it is; windows over the id then give each row what it needs of the other two tables.

The wide daily frames hold the columns of several metrics, and the charts are unpivoted from them.
A day that one metric has and another has not is told apart by flags, and windows over days run
within those, so that they see the rows of their own metric only.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from epochloom.config import (
    ACTIVATION_FIELDS,
    ARCHETYPE_COUNT_FIELDS,
    ATTO_PER_COIN,
    ATTO_PER_NANO,
    ONBOARDING_PATHS,
    PATH_COUNT_FIELDS,
    PRECOMMIT_BATCH,
    PROVE_AGGREGATE,
    SECTOR_ADDED,
    SECTOR_EXPIRED,
    SECTOR_EXTENDED,
    SIZE_CLASSES,
    LedgerConfig,
)
from epochloom.functions.amounts import burnt_fee, coins, number, percent, ratio
from epochloom.functions.classes import METHOD_CLASSES, method_class, size_class
from epochloom.functions.params import (
    array_names,
    message_arrays,
    notifies_market,
    param_count,
)
from epochloom.functions.time import epoch_to_day, phase_of
from epochloom.operators.daily import change, previous, trailing_mean
from epochloom.operators.messages import by_id as laid_out_by_id, partitions_of, sectors_of
from epochloom.plans.marts import (
    ARCHETYPE_EVENT_METHODS,
    PATH_EVENT_METHODS,
    Marts,
    dated,
)
from epochloom.plans.metrics import DAILY, PHASES, theoretical_capacity
from epochloom.plans.series import CHARTS, drawn
from epochloom.sources.tables import Ledger, in_window, resolve_column

#: The metrics that each wide frame holds; all others have a table of their own.
READINGS = (
    "circulating_supply_vs_burn",
    "fil_return_per_sector",
    "participating_miner_count",
    "renewal_rate",
    "sector_extensions",
)
BY_ID = (
    "burn_composition",
    "daily_fee_burn",
    "ddo_sector_onboarding",
    "gas_per_sector_by_path",
    "gas_utilization",
    "precommit_sector_batch_size",
    "sector_lifetime_cost",
    "small_batch_count",
)
#: Of these, the ones that need messages outside the window and of all methods.
BURNS = ("burn_composition", "daily_fee_burn")


def _under_each_other(parts: list[DataFrame]) -> DataFrame:
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)


def _daily_readings(t: Ledger, cfg: LedgerConfig) -> DataFrame:
    """One row per day with a reading: counts of sector events, and readings of the chain."""
    supply = dated(t.chain_economics, cfg).select(
        "date",
        number(F.col("circulating_fil")).alias("circulating"),
        number(F.col("burnt_fil")).alias("burnt"),
        F.lit(1).alias("supply_rows"),
    )
    rewards = dated(t.chain_rewards, cfg).select(
        "date", number(F.col("total_mined_reward")).alias("reward"), F.lit(1).alias("reward_rows")
    )
    miners = dated(t.chain_powers, cfg).select("date", "participating_miner_count")
    events = dated(t.miner_sector_events, cfg).select(
        "date", "event", phase_of(F.col("height"), cfg).alias("phase")
    )

    def seen(event: str, phase: str | None = None) -> Column:
        rows = F.col("event") == event
        return F.count_if(rows if phase is None else rows & (F.col("phase") == phase))

    kinds = {"expired": SECTOR_EXPIRED, "extended": SECTOR_EXTENDED}
    return (
        _under_each_other([events, supply, rewards, miners])
        .groupBy("date")
        .agg(
            coins(F.avg("circulating")).alias("circulating_fil"),
            coins(F.avg("burnt")).alias("burnt_fil"),
            (F.count("supply_rows") > 0).alias("has_supply"),
            F.max("reward").alias("top"),
            (F.count("reward_rows") > 0).alias("has_reward"),
            F.max("participating_miner_count").alias("participating_miner_count"),
            seen(SECTOR_ADDED).alias("added"),
            *[seen(event).alias(name) for name, event in kinds.items()],
            *[
                seen(event, phase).alias(f"{name}_{phase}")
                for name, event in kinds.items()
                for phase in PHASES
            ],
        )
    )


def readings(t: Ledger, cfg: LedgerConfig) -> DataFrame:
    """The columns of the metrics in `READINGS`, by day; NULL where a metric lacks the day."""
    extended, both = F.col("extended"), F.col("expired") + F.col("extended")
    rates = {
        f"renewal_rate_{p}_pct": percent(
            F.col(f"extended_{p}"), F.col(f"extended_{p}") + F.col(f"expired_{p}"), 2
        )
        for p in PHASES
    }
    daily = _daily_readings(t, cfg).withColumns(
        {
            "has_renewal": both > 0,
            "has_extended": extended > 0,
            "gained": change("top", "has_reward") / F.lit(ATTO_PER_COIN),
            **rates,
        }
    )
    renewing, extending = F.col("has_renewal"), F.col("has_extended")
    positive = F.col("has_reward") & (F.col("gained") > 0) & (F.col("added") > 0)
    growth = percent(
        change("circulating_fil", "has_supply"), previous("circulating_fil", "has_supply"), 6
    )
    return daily.select(
        "date",
        "circulating_fil",
        "burnt_fil",
        growth.alias("circulating_growth_pct"),
        percent(
            change("burnt_fil", "has_supply"), F.col("circulating_fil"), 6
        ).alias("daily_burn_rate_pct"),
        F.when(positive, ratio(F.col("gained"), F.col("added"))).alias("fil_return_per_sector"),
        "participating_miner_count",
        F.when(renewing, F.col("expired")).alias("expired_count"),
        F.when(renewing, extended).alias("extended_count"),
        *[trailing_mean(c, cfg.smooth_days, within=["has_renewal"]).alias(c) for c in rates],
        *[F.nullif(F.col(f"extended_{p}"), F.lit(0)).alias(f"extensions_{p}_grace") for p in PHASES],
        F.when(
            extending, trailing_mean("extended", cfg.baseline_days, within=["has_extended"])
        ).alias("baseline_rolling_30d"),
    )


#: Rows of the three tables once they lie under each other.
MESSAGE, EVENT, GAS = 0, 1, 2


def _facts_by_id(t: Ledger, cfg: LedgerConfig, burns: bool) -> DataFrame:
    """Messages, sector-added events and gas, equal rows counted, each with its id's totals."""
    fields = {"path_sectors": PATH_COUNT_FIELDS, "archetype_sectors": ARCHETYPE_COUNT_FIELDS}
    methods = sorted({m for f in fields.values() for m in f} | set(ACTIVATION_FIELDS))
    names = {n for f in fields.values() for n in array_names(f)} | set(ACTIVATION_FIELDS.values())
    height, method = F.col("height"), F.col("method")
    inside, counted = height > cfg.window_start, method.isin(*methods)
    messages = t.parsed_messages if burns else in_window(t.parsed_messages, cfg).where(counted)
    sectors = F.coalesce(
        *[F.when(method == m, F.col("arrays")[field]) for m, field in ACTIVATION_FIELDS.items()]
    )
    activated = F.when(height > cfg.onboarding_window_start, sectors)
    messages = messages.select(
        "height", "cid", "method",
        F.when(inside & counted, message_arrays(t.parsed_messages, names)).alias("arrays"),
    ).select(
        F.lit(MESSAGE).alias("kind"),
        "cid",
        "method",
        F.when(inside, epoch_to_day(height, cfg)).alias("date"),
        *[
            F.when(inside & method.isin(*f), param_count(method, F.col("arrays"), f)).alias(name)
            for name, f in fields.items()
        ],
        F.array_size(activated).alias("activated"),
        F.array_size(F.filter(activated, notifies_market)).alias("through_market"),
    )
    parts = [messages]
    event_id = resolve_column(t.miner_sector_events)
    if event_id is not None:
        parts.append(
            in_window(t.miner_sector_events, cfg)
            .where((F.col("event") == SECTOR_ADDED) & F.col(event_id).isNotNull())
            .select(
                F.lit(EVENT).alias("kind"),
                F.col(event_id).alias("cid"),
                epoch_to_day(height, cfg).alias("date"),
            )
        )
    # Gas before the window counts for batches, which match gas of any height.
    parts.append(
        t.derived_gas_outputs.select(
            F.lit(GAS).alias("kind"),
            "cid",
            F.when(inside, epoch_to_day(height, cfg)).alias("date"),
            F.when(inside, burnt_fee(1.0)).alias("fee"),
            number(F.col("gas_used")).alias("used"),
            F.when(inside, F.col("gas_used")).alias("used_inside"),
            F.when(inside, F.col("gas_limit")).alias("limit_inside"),
        )
    )
    folded = (
        _under_each_other(parts)
        .groupBy("cid", "kind", "method", "date", *fields, "activated", "through_market")
        .agg(
            F.count("*").alias("copies"),
            F.sum("fee").alias("fee"),
            F.count("fee").alias("fee_rows"),
            F.sum("used").alias("used"),
            F.sum("used_inside").alias("used_inside"),
            F.sum("limit_inside").alias("limit_inside"),
        )
    )
    # One sort, of as many partitions as the rows need, serves both windows.
    if not cfg.stored_by_id:
        laid_out = laid_out_by_id(folded, cfg, partitions_of(*parts))
        folded = laid_out.sortWithinPartitions("cid", "date")
    by_cid, by_date = Window.partitionBy("cid"), Window.partitionBy("cid", "date")
    known, kind, copies = F.col("cid").isNotNull(), F.col("kind"), F.col("copies")
    label = method_class(method)

    def total(of: int, value: Column, over, rows: Column | None = None) -> Column:
        chosen = kind == of if rows is None else (kind == of) & rows
        return F.when(known, F.sum(F.when(chosen, value)).over(over))

    dated_rows = F.col("date").isNotNull()
    same_method = F
    for name in sorted({*PATH_EVENT_METHODS, *ARCHETYPE_EVENT_METHODS}):
        of_method = total(MESSAGE, copies, by_cid, dated_rows & (method == name))
        same_method = same_method.when(method == name, of_method)
    return folded.withColumns(
        {
            "messages": total(MESSAGE, copies, by_cid),
            **{
                name: F.coalesce(total(MESSAGE, copies, by_cid, label == name), F.lit(0))
                for name in METHOD_CLASSES
            },
            "id_fee": total(GAS, F.col("fee"), by_cid),
            "id_fee_rows": total(GAS, F.col("fee_rows"), by_cid),
            "id_window_rows": total(GAS, copies, by_cid, dated_rows),
            "id_used": total(GAS, F.col("used"), by_cid),
            "id_gas_rows": total(GAS, copies, by_cid),
            # only asked for messages of these methods
            "seen": total(EVENT, copies, by_date) * same_method,
        }
    )


def _daily_by_id(t: Ledger, cfg: LedgerConfig, burns: bool) -> DataFrame:
    """Sums by day, kind of row, method, sectors and size class."""
    rows = _facts_by_id(t, cfg, burns)
    method, copies = F.col("method"), F.col("copies")
    fallback = {"path_sectors": PATH_EVENT_METHODS, "archetype_sectors": ARCHETYPE_EVENT_METHODS}
    fields = {"path_sectors": PATH_COUNT_FIELDS, "archetype_sectors": ARCHETYPE_COUNT_FIELDS}
    rows = rows.where(F.col("date").isNotNull()).withColumns(
        {
            name: F.when(method.isin(*fields[name]), sectors_of(name, by_event))
            for name, by_event in fallback.items()
        }
    )

    def cost(sectors: str) -> list[Column]:
        costed = (F.col(sectors) > 0) & (F.col("id_window_rows") > 0)
        each = copies * ratio(F.col("id_fee") / F.lit(ATTO_PER_NANO), F.col(sectors))
        return [
            F.sum(F.when(costed, each)).alias(f"{sectors}_cost"),
            F.sum(F.when(costed, copies * F.col("id_fee_rows"))).alias(f"{sectors}_rows"),
        ]

    path = F.col("path_sectors")
    batched = (method == PRECOMMIT_BATCH) & (path > 0) & (F.col("id_gas_rows") > 0)
    gas, matched, fee = F.col("kind") == GAS, F.col("messages") > 0, F.col("fee") / F.lit(ATTO_PER_COIN)

    def burnt(name: str) -> Column:
        # Other classes' messages add zero, so the sum is NULL only when there are none.
        some = F.when(F.col(name) < F.col("messages"), F.coalesce(fee, F.lit(0.0))).otherwise(fee)
        return F.sum(F.when(gas & matched, some * F.col(name))).alias(f"burnt_{name}")

    return rows.groupBy(
        "date", "kind", "method", "path_sectors",
        F.when(F.col("archetype_sectors").isNotNull(), size_class(F.col("archetype_sectors"), cfg)).alias("size"),
    ).agg(
        F.sum(copies).alias("copies"),
        *cost("path_sectors"),
        *cost("archetype_sectors"),
        F.sum(F.when(batched, copies * F.col("id_used"))).alias("batch_used"),
        F.sum(F.when(batched, copies * path * F.col("id_gas_rows"))).alias("batch_sectors"),
        F.sum(copies * F.col("activated")).alias("activated"),
        F.sum(copies * F.col("through_market")).alias("through_market"),
        F.sum("used_inside").alias("gas_used"),
        F.sum("limit_inside").alias("gas_limit"),
        F.sum(F.when(gas & matched, fee * F.col("messages"))).alias("burnt_total"),
        *[burnt(name) for name in METHOD_CLASSES],
    )


def by_id(t: Ledger, cfg: LedgerConfig, burns: bool = True) -> DataFrame:
    """The columns of the metrics in `BY_ID`, by day; NULL where a metric lacks the day. Without
    `burns`, messages of other methods and before the window are not read."""
    sums, method, size = _daily_by_id(t, cfg, burns), F.col("method"), F.col("path_sectors")
    message = F.col("kind") == MESSAGE
    of_batch, of_proof = message & (method == PRECOMMIT_BATCH), message & (method == PROVE_AGGREGATE)
    # The sizes that count for a mean and median: proofs of no sectors do not.
    sized = (of_batch & size.isNotNull()) | (of_proof & (size > 0))
    by_method = Window.partitionBy("date", "method", "kind")
    sums = sums.withColumns(
        {"v": F.when(sized, size), "w": F.when(sized, F.col("copies"))}
    ).withColumns(
        {"reached": F.sum("w").over(by_method.orderBy("v")), "total": F.sum("w").over(by_method)}
    )
    v, w = F.col("v"), F.col("w")

    def mean(rows: Column) -> Column:
        return ratio(F.sum(F.when(rows, v * w)), F.sum(F.when(rows, w)))

    def median(rows: Column) -> Column:
        return F.min(F.when(rows & (F.col("reached") * 2 >= F.col("total")), v))

    def copies(rows: Column) -> Column:
        return F.sum(F.when(rows, F.col("copies")))

    def cost(sectors: str, rows: Column) -> Column:
        return ratio(
            F.sum(F.when(rows, F.col(f"{sectors}_cost"))),
            F.sum(F.when(rows, F.col(f"{sectors}_rows"))),
        )

    def class_cost(name: str) -> Column:
        """Mean costs of the methods, added; NULL without any."""
        each = [
            cost("archetype_sectors", (F.col("size") == name) & (method == m))
            for m in ARCHETYPE_COUNT_FIELDS
        ]
        return F.when(
            F.coalesce(*each).isNotNull(), reduce(Column.__add__, [F.coalesce(c, F.lit(0.0)) for c in each])
        )

    batches = copies(of_batch)
    fuller = F.coalesce(copies(of_batch & (size >= cfg.small_batch_below)), F.lit(0))
    per_sector = ratio(F.sum("batch_used"), F.sum("batch_sectors"))
    on_gas_days = F.count_if(F.col("kind") == GAS) > 0
    total, market = F.sum("activated"), F.sum("through_market")
    return sums.groupBy("date").agg(
        F.sum("burnt_total").alias("total_fee_burn_fil"),
        F.sum("burnt_dispute").alias("dispute_termination_gas_fil"),
        F.sum("burnt_onboarding").alias("sector_onboarding_gas_fil"),
        F.sum("burnt_other").alias("other_burn_fil"),
        F.when(total > 0, total - market).alias("ddo_sectors"),
        F.when(total > 0, market).alias("non_ddo_sectors"),
        *[cost("path_sectors", method == m).alias(m) for m in ONBOARDING_PATHS],
        *[class_cost(name).alias(name) for name in SIZE_CLASSES],
        percent(F.sum("gas_used"), F.sum("gas_limit"), 4).alias("gas_utilization_pct"),
        F.when(on_gas_days, theoretical_capacity(cfg.daily_gas_capacity, per_sector)).alias(
            "theoretical_max_sectors_per_day"
        ),
        mean(of_batch).alias("avg_sectors_per_message"),
        median(of_batch).alias("median_sectors_per_message"),
        batches.alias("messages"),
        F.when(batches > 0, copies(of_proof)).alias("aggregate_messages"),
        F.when(batches > 0, mean(of_proof)).alias("avg_aggregate_size"),
        F.when(batches > 0, median(of_proof)).alias("median_aggregate_size"),
        percent(fuller, batches, 2).alias("fuller_batch_pct"),
    )


def wide_frames(
    t: Ledger, cfg: LedgerConfig, metrics: Collection[str] = tuple(DAILY)
) -> list[tuple[tuple[str, ...], DataFrame]]:
    """The named metrics in few daily frames: which each holds, and the frame."""
    found = []
    for names, build in (
        (READINGS, readings),
        (BY_ID, partial(by_id, burns=bool(set(BURNS) & set(metrics)))),
    ):
        wanted = tuple(n for n in names if n in metrics)
        if wanted:
            found.append((wanted, build(t, cfg)))
    marts = Marts(t, cfg)
    rest = [n for n in metrics if n not in READINGS + BY_ID]
    return found + [((n,), DAILY[n](marts)) for n in rest]


def catalog(frames: list[tuple[tuple[str, ...], DataFrame]]) -> DataFrame:
    """(chart, series, unit, date, x_millis, y) of every chart of the frames' metrics."""
    return reduce(
        DataFrame.unionByName,
        [drawn(daily, [c for c in CHARTS if c.metric in names]) for names, daily in frames],
    )
