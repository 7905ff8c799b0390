"""Every job and operator as a query over the stand-in ledger of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from epochloom.config import (
    ATTO_PER_COIN,
    ATTO_PER_NANO,
    DISPUTE_METHODS,
    ONBOARDING_METHODS,
    ONBOARDING_PATHS,
    PATH_COUNT_FIELDS,
    PRECOMMIT_BATCH,
    PROVE_COMMIT,
    PROVE_UPDATES,
    SECTOR_ADDED,
    LedgerConfig,
)
from epochloom.functions import amounts, classes, params as js
from epochloom.functions.time import day_text, epoch_to_day, phase_of
from epochloom.operators import daily as d, messages as m, quality, state
from epochloom.operators.percentiles import counted_sizes, day_percentiles
from epochloom.plans import catalog, marts, metrics, series
from epochloom.plans.marts import POWERS, Marts, dated, power_changes
from epochloom.sources.stand_in import CLAIMS, EVENTS, FACTS, stand_in_ledger
from epochloom.sources.tables import Ledger, in_window, resolve_column

Query = Callable[[SparkSession, str], DataFrame]
# Metrics over the event table, which covers January 2024, and the claims' own window.
CONFIGS = {
    "base_fee_percentiles": EVENTS,
    "circulating_supply_vs_burn": EVENTS,
    "fil_return_per_sector": EVENTS,
    "participating_miner_count": EVENTS,
    "renewal_rate": EVENTS,
    "sector_extensions": EVENTS,
    "power_added": CLAIMS,
}
# Metrics in nano units per sector, shown to four places.
NANO_METRICS = ("gas_per_sector_by_path", "sector_lifetime_cost", "sector_daily_fee_cost")
NANO_ZEROS = 5
# Some stand-in messages have no count, so their days would not pass the check of this metric.
OPTIONS = {"small_batch_count": {"check": False}}
ORDER = ["height"]


def publish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Days as text and doubles rounded, the form both engines are compared in."""

    def shown(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return day_text(column).alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return (F.round(column, digits) + F.lit(0.0)).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


def config_of(metric: str) -> LedgerConfig:
    return CONFIGS.get(metric, FACTS)


def digits_of(metric: str) -> int:
    return 4 if metric in NANO_METRICS else 6


def zeros_of(metric: str) -> int:
    return NANO_ZEROS if metric in NANO_METRICS else 12


def _marts(spark: SparkSession, sf_dir: str, metric: str) -> Marts:
    return Marts(stand_in_ledger(spark, sf_dir, zeros_of(metric)), config_of(metric))


def metric_frame(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    frame = metrics.METRICS[metric](_marts(spark, sf_dir, metric), **OPTIONS.get(metric, {}))
    return publish(frame, digits_of(metric))


def _metric(name: str) -> Query:
    return lambda spark, sf_dir: metric_frame(spark, sf_dir, name)


def _on_ledger(build: Callable[[Ledger], DataFrame], digits: int = 6, zeros: int = 12) -> Query:
    return lambda spark, sf_dir: publish(build(stand_in_ledger(spark, sf_dir, zeros)), digits)


# --- sources, filters ---------------------------------------------------------------------


def scan_project(t: Ledger) -> DataFrame:
    return t.chain_powers.select("height", "participating_miner_count")


def schema_resolve_column(t: Ledger) -> DataFrame:
    column = resolve_column(t.miner_sector_events)
    return t.miner_sector_events.agg(F.count(column).alias("ids")).select(
        F.lit(column).alias("column_name"), "ids"
    )


def filter_epoch_after(t: Ledger) -> DataFrame:
    return in_window(t.parsed_messages, FACTS).select("height", "cid")


def filter_in(t: Ledger) -> DataFrame:
    return t.parsed_messages.where(F.col("method").isin(*ONBOARDING_PATHS)).select(
        "cid", "method"
    )


def bucket_not_in(t: Ledger) -> DataFrame:
    method = F.col("method")
    classed = (*DISPUTE_METHODS, *ONBOARDING_METHODS)

    def tally(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return (
        dated(t.parsed_messages, FACTS)
        .groupBy("date")
        .agg(
            tally(method.isin(*classed)).alias("classed"),
            tally(~method.isin(*classed)).alias("other"),
            F.count("*").alias("messages"),
        )
    )


def _daily_claims(t: Ledger) -> DataFrame:
    return state.daily_latest(dated(_claims(t), CLAIMS), "miner_id", ORDER, POWERS)


def _in_pib(df: DataFrame) -> DataFrame:
    return df.withColumns({c: amounts.pebibytes(F.col(c)) for c in POWERS})


def _claims(t: Ledger) -> DataFrame:
    return t.power_actor_claims.select(
        "height", "miner_id", *[F.col(c).cast("double").alias(c) for c in POWERS]
    )


def _claims_before(t: Ledger) -> DataFrame:
    return _claims(t).where(F.col("height") <= CLAIMS.window_start)


def _seed(t: Ledger) -> DataFrame:
    return state.seed_state(_claims_before(t), "miner_id", ORDER, POWERS, _daily_claims(t))


def _anchored(t: Ledger) -> DataFrame:
    return state.seed_anchor(_daily_claims(t), _seed(t))


def scalar_subquery_filter(t: Ledger) -> DataFrame:
    first = _daily_claims(t).agg(F.min("date"))
    return _in_pib(_anchored(t).where(F.col("date") >= first.scalar()))


# --- joins --------------------------------------------------------------------------------


def join_inner_cid(t: Ledger) -> DataFrame:
    return m.matched_totals(t.derived_gas_outputs, t.parsed_messages, ATTO_PER_COIN, FACTS)


def _rewards(t: Ledger) -> DataFrame:
    return d.cumulative_to_daily(
        dated(t.chain_rewards, EVENTS), "total_mined_reward", "reward", ATTO_PER_COIN
    )


def _added(t: Ledger) -> DataFrame:
    rows = dated(t.miner_sector_events, EVENTS).where(F.col("event") == SECTOR_ADDED)
    return rows.groupBy("date").agg(F.count("*").alias("added"))


def join_inner_daily(t: Ledger) -> DataFrame:
    return d.join_days(_rewards(t), _added(t), how="inner")


def join_left_daily(t: Ledger) -> DataFrame:
    used = dated(t.derived_gas_outputs, FACTS).groupBy("date").agg(
        F.sum("gas_used").alias("gas_used")
    )
    return d.join_days(used, marts.batch_gas(t, FACTS))


def join_left_composite(t: Ledger) -> DataFrame:
    messages = dated(t.parsed_messages, FACTS).groupBy("date", "cid", "method").agg(
        F.count("*").alias("copies")
    )
    added = m.added_by_message(t.miner_sector_events, "message_cid", FACTS)
    return messages.join(added, ["date", "cid"], "left")


def join_semi(t: Ledger) -> DataFrame:
    return _in_pib(_seed(t))


def explode_json_array(t: Ledger) -> DataFrame:
    rows = t.parsed_messages.where(F.col("method") == PROVE_COMMIT)
    return rows.select(
        "cid",
        F.posexplode(js.array_elements(F.col("params"), "SectorActivations")).alias(
            "position", "sector"
        ),
    )


# --- aggregates ---------------------------------------------------------------------------


def _gas_days(t: Ledger) -> DataFrame:
    return dated(t.derived_gas_outputs, FACTS).withColumn(
        "fee", amounts.burnt_fee(ATTO_PER_COIN)
    )


def agg_sum(t: Ledger) -> DataFrame:
    return _gas_days(t).groupBy("date").agg(
        F.sum("gas_used").alias("gas_used"), F.sum("fee").alias("fee")
    )


def agg_sum_case(t: Ledger) -> DataFrame:
    large = F.col("gas_used") >= 25_000_000
    return _gas_days(t).groupBy("date").agg(
        F.sum(F.when(large, F.col("fee")).otherwise(0)).alias("large_fee"),
        F.sum(F.when(~large, F.col("fee")).otherwise(0)).alias("small_fee"),
    )


def agg_count(t: Ledger) -> DataFrame:
    return dated(t.miner_sector_events, EVENTS).groupBy("date", "event").agg(
        F.count("*").alias("events")
    )


def agg_count_if(t: Ledger) -> DataFrame:
    """A NULL method is counted by neither condition."""
    method = F.col("method")
    return dated(t.parsed_messages, FACTS).groupBy("date").agg(
        F.count_if(method == PRECOMMIT_BATCH).alias("batches"),
        F.count_if(method != PRECOMMIT_BATCH).alias("others"),
        F.count("*").alias("messages"),
    )


def agg_avg(t: Ledger) -> DataFrame:
    return dated(_claims(t), CLAIMS).groupBy("date").agg(
        *[amounts.pebibytes(F.avg(c)).alias(c) for c in POWERS]
    )


def agg_min_max(t: Ledger) -> DataFrame:
    power = F.col("participating_miner_count")
    return dated(t.chain_powers, EVENTS).groupBy("date").agg(
        F.min(power).alias("least"), F.max(power).alias("most")
    )


def agg_percentile_exact(t: Ledger) -> DataFrame:
    fees = _gas_days(t).select("date", "fee")
    wanted = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    return day_percentiles(fees, "fee", wanted)


def _batch_sizes(t: Ledger) -> DataFrame:
    return (
        dated(t.parsed_messages, FACTS)
        .where(F.col("method") == PRECOMMIT_BATCH)
        .select("date", js.array_length(F.col("params"), "Sectors").alias("sector_count"))
    )


def agg_median_approx(t: Ledger) -> DataFrame:
    """Exact, from counted sizes, where an approximate one would do."""
    counted = _batch_sizes(t).groupBy("date", "sector_count").agg(F.count("*").alias("messages"))
    return counted_sizes(counted, "sector_count", "messages").select("date", "median")


def ratio_of_sums(t: Ledger) -> DataFrame:
    return _gas_days(t).groupBy("date").agg(
        amounts.ratio(F.sum("gas_used"), F.sum("gas_limit")).alias("share")
    )


def mean_of_ratios(t: Ledger) -> DataFrame:
    return _gas_days(t).groupBy("date").agg(
        F.avg(amounts.ratio(F.col("fee"), F.col("gas_used") / 1_000_000 - 25)).alias("fee_rate")
    )


def ratio_of_counts(t: Ledger) -> DataFrame:
    small = F.count_if(F.col("sector_count") < FACTS.small_batch_below)
    return _batch_sizes(t).groupBy("date").agg(
        amounts.percent(small, F.count("*"), 2).alias("small_pct")
    )


def agg_two_level(t: Ledger) -> DataFrame:
    return marts.archetype_costs(t, FACTS)


def distinct_keys(t: Ledger) -> DataFrame:
    return dated(t.power_actor_claims, CLAIMS).select("date", "miner_id").distinct()


def _path_counts(t: Ledger) -> DataFrame:
    return m.sector_counts(
        t.parsed_messages,
        t.miner_sector_events,
        resolve_column(t.miner_sector_events),
        PATH_COUNT_FIELDS,
        marts.PATH_EVENT_METHODS,
        FACTS,
    )


def pivot_mean(t: Ledger) -> DataFrame:
    sizes = (
        _parsed(dated(t.parsed_messages, FACTS))
        .select(
            "date",
            "method",
            js.param_count(F.col("method"), F.col("arrays"), PATH_COUNT_FIELDS).alias("n"),
        )
        .groupBy("date", "method")
        .agg(F.avg("n").alias("n"))
    )
    return d.pivot_mean(sizes, "method", "n", ONBOARDING_PATHS)


def agg_any(t: Ledger) -> DataFrame:
    return dated(_claims(t), CLAIMS).groupBy("date").agg(
        F.bool_or(F.col("quality_adj_power").isNull()).alias("any_silent"),
        F.coalesce(F.bool_or(F.col("raw_byte_power") > 3.5e14), F.lit(False)).alias("any_large"),
    )


# --- windows, order, sets -----------------------------------------------------------------


def win_latest_per_day(t: Ledger) -> DataFrame:
    return state.daily_latest(
        dated(_claims(t), CLAIMS), "miner_id", ORDER, ["raw_byte_power"]
    ).select("date", "miner_id", amounts.pebibytes(F.col("raw_byte_power")).alias("raw"))


def win_latest_before(t: Ledger) -> DataFrame:
    before = _claims_before(t).withColumn("date", epoch_to_day(F.lit(0), CLAIMS))
    return _in_pib(state.daily_latest(before, "miner_id", ORDER, POWERS).drop("date"))


def _daily_supply(t: Ledger) -> DataFrame:
    return dated(t.chain_economics, EVENTS).groupBy("date").agg(
        amounts.coins(F.avg(amounts.number(F.col("circulating_fil")))).alias("supply")
    )


def win_lag_delta(t: Ledger) -> DataFrame:
    return _daily_supply(t).select("date", d.change("supply").alias("change"))


def win_lag_pct(t: Ledger) -> DataFrame:
    return _daily_supply(t).select(
        "date", amounts.percent(d.change("supply"), d.previous("supply"), 6).alias("growth_pct")
    )


def win_fill_forward(t: Ledger) -> DataFrame:
    """Along each miner's own rows only."""
    return _anchored(t).select(
        "date",
        "miner_id",
        amounts.pebibytes(state.carried("quality_adj_power", "miner_id")).alias("carried"),
    )


def _extended(t: Ledger) -> DataFrame:
    rows = dated(t.miner_sector_events, EVENTS).where(F.col("event") == "SECTOR_EXTENDED")
    return rows.groupBy("date").agg(F.count("*").alias("extended"))


def win_rolling_30(t: Ledger) -> DataFrame:
    return _extended(t).select("date", d.trailing_mean("extended", 30).alias("mean_30"))


def win_rolling_7(t: Ledger) -> DataFrame:
    return _extended(t).select(
        "date",
        d.trailing_mean("extended", 7).alias("mean_7"),
        d.trailing_mean("extended", 7, min_samples=7).alias("mean_full_7"),
    )


def sort_desc(t: Ledger) -> DataFrame:
    return d.newest_first(agg_sum(t))


def sort_mixed(t: Ledger) -> DataFrame:
    return d.newest_first(agg_count(t), "event")


def union_all(t: Ledger) -> DataFrame:
    """Duplicates are kept."""
    messages = dated(t.parsed_messages, FACTS).select("date", "cid")
    return messages.unionByName(dated(t.derived_gas_outputs, FACTS).select("date", "cid"))


# --- scalar functions ---------------------------------------------------------------------


def epoch_day(t: Ledger) -> DataFrame:
    return t.parsed_messages.select(
        "cid", "height", epoch_to_day(F.col("height"), FACTS).alias("date")
    )


def format_date(t: Ledger) -> DataFrame:
    days = epoch_day(t).select(day_text(F.col("date")).alias("text"))
    return days.groupBy("text").agg(F.count("*").alias("messages"))


def unit_convert(t: Ledger) -> DataFrame:
    burnt = F.col("base_fee_burn")
    return t.derived_gas_outputs.select(
        "height",
        "cid",
        amounts.coins(burnt).alias("coins"),
        (amounts.nanos(burnt) / 1e6).alias("thousandths"),
        (amounts.pebibytes(F.col("gas_used")) * 1e6).alias("size"),
    )


def safe_divide(t: Ledger) -> DataFrame:
    """NULL where the divisor is zero."""
    return t.derived_gas_outputs.select(
        "height",
        "cid",
        amounts.ratio(F.col("base_fee_burn"), F.col("over_estimation_burn")).alias("share"),
    )


def nullif_zero(t: Ledger) -> DataFrame:
    return t.parsed_messages.select(
        "cid",
        F.nullif(js.array_length(F.col("params"), "Sectors"), F.lit(0)).alias("sectors"),
    )


def coalesce_chain(t: Ledger) -> DataFrame:
    p = F.col("params")
    fields = PATH_COUNT_FIELDS[PROVE_UPDATES]
    return t.parsed_messages.where(F.col("method") == PROVE_UPDATES).select(
        "cid", F.coalesce(*[js.array_length(p, f) for f in fields]).alias("sectors")
    )


def case_bucket(t: Ledger) -> DataFrame:
    used = F.col("gas_used")
    label = (
        F.when(used >= 40_000_000, "heavy").when(used >= 20_000_000, "middle").otherwise("light")
    )
    return dated(t.derived_gas_outputs, FACTS).groupBy("date", label.alias("load")).agg(
        F.count("*").alias("rows")
    )


def json_array_len(t: Ledger) -> DataFrame:
    fields = ("Sectors", "SectorActivations", "SectorUpdates", "SectorNumbers", "Deadline")
    return t.parsed_messages.select(
        "cid", *[js.array_length(F.col("params"), f).alias(f) for f in fields]
    )


def json_query(t: Ledger) -> DataFrame:
    return explode_json_array(t).select(
        "cid", "position", F.get_json_object("sector", "$.Pieces").alias("pieces")
    )


def regexp_match(t: Ledger) -> DataFrame:
    return t.parsed_messages.select(
        "cid", F.coalesce(F.col("params").rlike(js.MARKET_ADDRESS), F.lit(False)).alias("calls")
    )


def to_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names hold a number after the '#', the rest of the text is not one."""
    schema = "c_custkey BIGINT, c_name STRING"
    customers = spark.read.schema(schema).parquet(f"{sf_dir}/customer.parquet")
    tail = F.substring_index("c_name", "#", -1)
    text = F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")).when(
        F.col("c_custkey") % 5 == 1, F.lit("")
    )
    text = text.when(F.col("c_custkey") % 5 == 2, F.lit("Infinity"))
    text = text.when(F.col("c_custkey") % 5 == 3, F.concat(tail, F.lit("d"))).otherwise(tail)
    return publish(customers.select("c_custkey", amounts.finite(text).alias("number")))


# --- composites ---------------------------------------------------------------------------


def daily_latest(t: Ledger) -> DataFrame:
    return _in_pib(_daily_claims(t))


def fill_forward(t: Ledger) -> DataFrame:
    return _in_pib(state.fill_forward(_anchored(t), "miner_id", POWERS))


def state_as_of(t: Ledger) -> DataFrame:
    """Each claim of the window with what its miner had seven days before."""
    asked = dated(_claims(t), CLAIMS).select(
        "height", "miner_id", F.date_sub("date", 7).alias("week_before")
    )
    held = state.fill_forward(_anchored(t), "miner_id", POWERS)
    return _in_pib(state.state_on(held, asked, "miner_id", POWERS, "week_before"))


def state_delta_daily(t: Ledger) -> DataFrame:
    daily = state.state_delta_daily(power_changes(t, CLAIMS), "miner_id", POWERS)
    return _in_pib(daily)


def rolling_mean(t: Ledger) -> DataFrame:
    daily = state_delta_daily(t)
    return d.rolling_mean(daily, POWERS, 7)


def cumulative_to_daily(t: Ledger) -> DataFrame:
    return _rewards(t)


def phases(t: Ledger) -> DataFrame:
    return dated(t.miner_sector_events, EVENTS).groupBy(
        "date", phase_of(F.col("height"), EVENTS).alias("phase")
    ).agg(F.count("*").alias("events"))


def method_class(t: Ledger) -> DataFrame:
    return t.parsed_messages.groupBy(
        "method", classes.method_class(F.col("method")).alias("class")
    ).agg(F.count("*").alias("messages"))


def size_class(t: Ledger) -> DataFrame:
    sized = _path_counts(t).where(F.col("sector_count") > 0)
    label = classes.size_class(F.col("sector_count"), FACTS).alias("size")
    return sized.groupBy("date", label).agg(
        F.sum("copies").alias("messages"),
        F.sum(F.col("copies") * F.col("sector_count")).alias("sectors"),
    )


def _parsed(messages: DataFrame) -> DataFrame:
    """Onboarding messages with the arrays of their parameters."""
    arrays = js.parsed_arrays(F.col("params"), js.array_names(PATH_COUNT_FIELDS))
    rows = messages.where(F.col("method").isin(*ONBOARDING_PATHS))
    return rows.withColumn("arrays", arrays).drop("params")


def param_count(t: Ledger) -> DataFrame:
    return _parsed(t.parsed_messages).select(
        "cid",
        "method",
        js.param_count(F.col("method"), F.col("arrays"), PATH_COUNT_FIELDS).alias("sectors"),
    )


def count_with_event_fallback(t: Ledger) -> DataFrame:
    return _path_counts(t)


def message_cost(t: Ledger) -> DataFrame:
    return in_window(t.derived_gas_outputs, FACTS).select(
        "height", "cid", amounts.burnt_fee(ATTO_PER_NANO).alias("cost")
    )


def classify_nested(t: Ledger) -> DataFrame:
    sectors = js.array_elements(F.col("params"), "SectorActivations")
    rows = t.parsed_messages.where(F.col("method") == PROVE_COMMIT).select(
        "cid", sectors.alias("sectors")
    )
    return rows.where(F.col("sectors").isNotNull()).select(
        "cid",
        F.size("sectors").cast("bigint").alias("total"),
        F.size(F.filter("sectors", js.notifies_market)).cast("bigint").alias("market"),
        F.size(F.filter("sectors", js.notifies_market_strict)).cast("bigint").alias("strict"),
    )


def lifetime_cost(t: Ledger) -> DataFrame:
    start, end = F.col("activation_epoch"), F.col("expiration_epoch")
    return t.miner_sector_infos.select(
        "activation_epoch",
        "expiration_epoch",
        amounts.lifetime_cost(F.col("daily_fee"), start, end, FACTS).alias("cost"),
    )


def theoretical_capacity(t: Ledger) -> DataFrame:
    return marts.batch_gas(t, FACTS).select(
        "date",
        metrics.theoretical_capacity(FACTS.daily_gas_capacity, F.col("gas_per_sector")).alias(
            "capacity"
        ),
    )


def yield_per_unit(t: Ledger) -> DataFrame:
    return d.yield_per_unit(_rewards(t), _added(t), "reward", "added", "per_sector")


def check_pct_sum(t: Ledger) -> DataFrame:
    columns = ["small_batch_pct", "fuller_batch_pct"]
    daily = metrics.small_batch_count(Marts(t, FACTS), check=False)
    return quality.pct_sum_report(daily, columns, 100.0, 0.5)


# --- series -------------------------------------------------------------------------------


def series_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_frame(spark, sf_dir, "gas_utilization")
    return publish(series.series_points(daily, "gas_utilization_pct"))


def daily_frame(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """As `metric_frame`, unordered and with the day still a date."""
    return _shown(metric, _marts(spark, sf_dir, metric))


def _shown(metric: str, frames: Marts) -> DataFrame:
    daily = metrics.DAILY[metric](frames, **OPTIONS.get(metric, {}))
    shown = publish(daily, digits_of(metric))
    return shown.withColumn("date", F.to_date("date"))


def series_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_frame(spark, sf_dir, "precommit_sector_batch_size")
    columns = ["avg_aggregate_size", "median_aggregate_size"]
    return publish(series.series_unpivot(daily, columns, ["mean", "median"]))


def series_has_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_frame(spark, sf_dir, "renewal_rate")
    columns = [c for c in daily.columns if c != "date"]
    return publish(series.series_has_data(daily, columns))


def phase_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.phase_coverage(daily_frame(spark, sf_dir, "renewal_rate"))


def metric_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics with the same settings and amounts share wide frames, one read of each table."""
    groups: dict[tuple[int, LedgerConfig], list[str]] = {}
    for metric in metrics.DAILY:
        groups.setdefault((zeros_of(metric), config_of(metric)), []).append(metric)
    frames = []
    for (zeros, cfg), names in groups.items():
        for held, daily in catalog.wide_frames(stand_in_ledger(spark, sf_dir, zeros), cfg, names):
            shown = publish(daily, digits_of(held[0])).withColumn("date", F.to_date("date"))
            frames.append((held, shown))
    return publish(catalog.catalog(frames))


_LEDGER_QUERIES = (
    scan_project,
    schema_resolve_column,
    filter_epoch_after,
    filter_in,
    bucket_not_in,
    scalar_subquery_filter,
    join_inner_cid,
    join_inner_daily,
    join_left_daily,
    join_left_composite,
    join_semi,
    explode_json_array,
    agg_sum,
    agg_sum_case,
    agg_count,
    agg_count_if,
    agg_avg,
    agg_min_max,
    agg_percentile_exact,
    agg_median_approx,
    ratio_of_sums,
    mean_of_ratios,
    ratio_of_counts,
    distinct_keys,
    pivot_mean,
    agg_any,
    win_latest_per_day,
    win_latest_before,
    win_lag_delta,
    win_lag_pct,
    win_fill_forward,
    win_rolling_30,
    win_rolling_7,
    sort_desc,
    sort_mixed,
    union_all,
    format_date,
    unit_convert,
    safe_divide,
    nullif_zero,
    coalesce_chain,
    case_bucket,
    json_array_len,
    json_query,
    regexp_match,
    daily_latest,
    fill_forward,
    state_as_of,
    state_delta_daily,
    rolling_mean,
    cumulative_to_daily,
    method_class,
    size_class,
    param_count,
    count_with_event_fallback,
    classify_nested,
    theoretical_capacity,
    yield_per_unit,
    check_pct_sum,
)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: _metric(name) for name in metrics.METRICS}
    found |= {f.__name__: _on_ledger(f) for f in _LEDGER_QUERIES}
    found |= {
        "epoch_to_day": _on_ledger(epoch_day),
        "phase_of": _on_ledger(phases),
        "seed_state": _on_ledger(join_semi),
        "seed_anchor": _on_ledger(lambda t: _in_pib(_anchored(t))),
        "agg_two_level": _on_ledger(agg_two_level, 4, NANO_ZEROS),
        "message_cost": _on_ledger(message_cost, 4, NANO_ZEROS),
        "lifetime_cost": _on_ledger(lifetime_cost, 4),
    }
    for query in (
        to_finite,
        series_points,
        series_unpivot,
        series_has_data,
        phase_coverage,
        metric_catalog,
    ):
        found[query.__name__] = query
    return found
