"""The queries of `workload.queries` in SQL, written row by row over the same tables.

Joins here run on plain rows and state is filled over a full grid, so these texts share no
plan with the DataFrame side.
"""

from __future__ import annotations

from epochloom.config import LedgerConfig
from epochloom.sources.stand_in import CLAIMS, EVENTS, FACTS
from workload.queries import NANO_ZEROS

PATHS = (
    "('PreCommitSectorBatch2', 'ProveCommitSectors3', 'ProveCommitAggregate', "
    "'ProveReplicaUpdates3')"
)
EVENT_PATHS = "('ProveCommitSectors3', 'ProveCommitAggregate', 'ProveReplicaUpdates3')"
ONBOARDING = (
    "('PreCommitSectorBatch2', 'ProveCommitSectors3', 'ProveCommitAggregate', "
    "'ProveReplicaUpdates3', 'PreCommitSector')"
)
DISPUTE = "('DisputeWindowedPoSt', 'TerminateSectors')"
CLASSED = DISPUTE[:-1] + ", " + ONBOARDING[1:]
PIB = "pow(1024, 5)"
RAW, QAP = f"raw / {PIB}", f"qap / {PIB}"


def day(height: str) -> str:
    return f"(DATE '1970-01-01' + CAST(({height} * 30 + 788918400) // 86400 AS INTEGER))"


def text(date: str = "date") -> str:
    return f"strftime({date}, '%Y-%m-%d')"


def r(expression: str, digits: int = 6) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0"


def n(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def length(field: str, params: str = "params") -> str:
    return (
        f"CASE WHEN json_type({params}, '$.{field}') = 'ARRAY' "
        f"THEN CAST(json_array_length({params}, '$.{field}') AS BIGINT) END"
    )


def phase(cfg: LedgerConfig) -> str:
    return (
        f"CASE WHEN height < {cfg.upgrade_epoch} THEN 'pre' "
        f"WHEN height < {cfg.grace_end_epoch} THEN 'during' ELSE 'post' END"
    )


def _array(field: str, element: str) -> str:
    return (
        f"'{{\"{field}\":[' || array_to_string(list_transform(range(0, o_custkey % 13), "
        f"lambda i: {element}), ',') || ']}}'"
    )


_SECTOR = "'{\"SectorNumber\":' || i || '}'"
_ACTIVATION = (
    "CASE (o_custkey + i) % 5 WHEN 0 THEN '{\"SectorType\":8}' "
    "WHEN 1 THEN '{\"Pieces\":null}' "
    "WHEN 3 THEN '{\"Pieces\":[{\"Size\":1,\"Address\":\"f05\",\"Notify\":[]}]}' "
    "WHEN 2 THEN '{\"Pieces\":[{\"Size\":1,\"Notify\":[{\"Address\":\"f05\"}]}]}' "
    "ELSE '{\"Pieces\":[{\"Size\":1,\"Notify\":[{\"Address\":\"f099\"}]}]}' END"
)
_EVENT_HEIGHT = (
    "date_diff('day', DATE '1995-01-01', CAST(ts AS DATE)) * 2880 + "
    "(hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // 30"
)
_ORDER_HEIGHT = (
    "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 2880 + o_orderkey % 2880"
)
_LINE_HEIGHT = (
    "date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 2880 + l_partkey % 2880"
)


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def _amount(units: str, zeros: int, key: str) -> str:
    digits = f"CAST({key} * 7919 * 1000003 % {10**zeros} AS DOUBLE)"
    scaled = f"CAST({units} AS DOUBLE) * CAST({10**zeros} AS DOUBLE) + {digits}"
    return f"CASE WHEN ({units}) <> 0 THEN {scaled} ELSE CAST(0 AS DOUBLE) END"


def tables(zeros: int = 12) -> dict[str, str]:
    """The stand-in tables."""
    price, value = _cents("l_extendedprice"), _cents("value")
    discount, tax = (f"CAST(round({c} * 100) AS BIGINT)" for c in ("l_discount", "l_tax"))
    return {
        "msgs": f"""
            SELECT height, cid, method, CASE
                WHEN o_orderkey % 7 = 0 THEN NULL
                WHEN o_orderkey % 11 = 0 THEN '{{"Deadline":1}}'
                WHEN method = 'PreCommitSectorBatch2' THEN {_array("Sectors", _SECTOR)}
                WHEN method = 'ProveCommitSectors3' AND o_orderkey % 2 = 0
                    THEN {_array("SectorActivations", _ACTIVATION)}
                WHEN method = 'ProveCommitSectors3' THEN {_array("SectorProofs", _SECTOR)}
                WHEN method = 'ProveCommitAggregate' THEN {_array("SectorNumbers", _SECTOR)}
                WHEN method = 'ProveReplicaUpdates3' AND o_custkey % 3 = 0
                    THEN {_array("SectorUpdates", _SECTOR)}
                WHEN method = 'ProveReplicaUpdates3' AND o_custkey % 3 = 1
                    THEN {_array("Sectors", _SECTOR)}
                WHEN method = 'ProveReplicaUpdates3' THEN {_array("SectorNumbers", _SECTOR)}
            END AS params
            FROM (SELECT *, {_ORDER_HEIGHT} AS height, unnest(range(0,
                    CASE WHEN o_orderkey % 40 = 3 THEN 2 ELSE 1 END)) AS copy,
                'm' || (o_orderkey - CASE WHEN o_orderkey % 40 = 7 THEN 4 ELSE 0 END) AS cid, CASE
                WHEN o_orderpriority = '1-URGENT' THEN 'PreCommitSectorBatch2'
                WHEN o_orderpriority = '2-HIGH' THEN 'ProveCommitSectors3'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'ProveCommitAggregate'
                WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'ProveReplicaUpdates3'
                WHEN o_orderstatus = 'O' THEN 'DisputeWindowedPoSt'
                WHEN o_orderstatus = 'F' THEN 'SubmitWindowedPoSt'
            END AS method FROM orders)""",
        "gas": f"""
            SELECT {_LINE_HEIGHT} AS height, 'm' || l_orderkey AS cid,
                CASE WHEN l_linenumber <> 6
                    THEN {_amount(f"{price} * {discount}", zeros, "l_partkey")} END AS base_fee_burn,
                CASE WHEN l_linenumber <> 5
                    THEN {_amount(f"{price} * {tax}", zeros, "l_suppkey")} END
                    AS over_estimation_burn,
                CAST(l_quantity AS BIGINT) * 1000000 AS gas_used,
                CAST(50000000 AS BIGINT) AS gas_limit
            FROM lineitem""",
        "mse": f"""
            SELECT {_ORDER_HEIGHT}
                    + CASE WHEN o_orderkey % 14 = 0 THEN 2880 ELSE 0 END AS height,
                'SECTOR_ADDED' AS event, 'm' || o_orderkey AS message_cid
            FROM (SELECT *, unnest(range(0, 1 + o_custkey % 4)) AS copy FROM orders)
            UNION ALL
            SELECT {_EVENT_HEIGHT}, CASE event_type WHEN 'view' THEN 'SECTOR_ADDED'
                WHEN 'signup' THEN 'SECTOR_EXTENDED' WHEN 'purchase' THEN 'SECTOR_EXPIRED'
                ELSE 'SECTOR_SNAPPED' END, NULL
            FROM events""",
        "claims": f"""
            SELECT {_EVENT_HEIGHT} AS height, 'f0' || user_id AS miner_id,
                {_amount(value, 10, "event_id")} AS raw,
                CASE WHEN event_id % 50 <> 0
                    THEN {_amount(f"{value} * (1 + event_id % 10)", 10, "user_id")} END AS qap
            FROM events""",
        "econ": f"""
            SELECT {_EVENT_HEIGHT} AS height,
                {_amount(f"{value} + 100000", 16, "event_id")} AS circulating,
                {_amount(f"{value} // 10", 16, "event_id")} AS burnt
            FROM events""",
        "rewards": f"""
            SELECT {_EVENT_HEIGHT} AS height,
                {_amount(f"event_id * 1000 + {value}", 16, "event_id")} AS total
            FROM events""",
        "headers": f"""
            SELECT {_EVENT_HEIGHT} AS height,
                CASE WHEN event_id % 31 <> 0 THEN {_amount(value, 7, "event_id")} END AS fee
            FROM events""",
        "powers": f"SELECT {_EVENT_HEIGHT} AS height, user_id AS miners FROM events",
        "infos": f"""
            SELECT {_LINE_HEIGHT} AS start, {_LINE_HEIGHT}
                    + (l_suppkey % 20 - 4) * 28800 + 1 + l_partkey % 6 AS stop,
                CASE WHEN l_linenumber <> 7 THEN CASE WHEN l_discount = 0 THEN CAST(0 AS DOUBLE)
                    ELSE {_amount(price, 6, "l_partkey")} END END AS fee
            FROM lineitem""",
    }


def query(select: str, zeros: int = 12, **steps: str) -> str:
    """The select over those stand-in tables its text needs, after the given named steps."""
    named = tables(zeros)
    body = "\n".join(steps.values()) + select
    used = {t: sql for t, sql in named.items() if f" {t} " in f"{body} ".replace("\n", " ")}
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in {**used, **steps}.items())
    return f"WITH {ctes}\n{select}" if ctes else select


def dated(table: str, cfg: LedgerConfig, after: int | None = None) -> str:
    start = cfg.window_start if after is None else after
    return f"SELECT *, {day('height')} AS date FROM {table} WHERE height > {start}"


# --- shared steps -------------------------------------------------------------------------

# A miner's reading of a day is its greatest (height, powers); NULL powers count as -1 for that.
# Readings up to the window start share the NULL day. Powers of any day are looked up as of it.
_SINCE = f"CASE WHEN height > {CLAIMS.window_start} THEN {day('height')} END"
_FIRST = "(SELECT min(date) FROM held)"


def _as_of(power: str) -> str:
    return f"""SELECT d.date, coalesce(sum(c.{power}), 0) AS total
        FROM (SELECT DISTINCT date, miner_id FROM
            (SELECT DISTINCT date FROM held WHERE date IS NOT NULL) CROSS JOIN
            (SELECT DISTINCT miner_id FROM known)) d
        ASOF LEFT JOIN (SELECT * FROM known WHERE {power} IS NOT NULL) c
            ON d.miner_id = c.miner_id AND d.date >= c.date
        GROUP BY d.date"""


POWER_STEPS = {
    "held": f"""SELECT miner_id, date, nullif(top.raw, -1) AS raw, nullif(top.qap, -1) AS qap
        FROM (SELECT miner_id, {_SINCE} AS date, max(struct_pack(h := height,
            raw := coalesce(raw, -1), qap := coalesce(qap, -1))) AS top
            FROM claims GROUP BY ALL)""",
    "known": f"""SELECT coalesce(date, CAST({_FIRST} - 1 AS DATE)) AS date, miner_id, raw, qap
        FROM held WHERE miner_id IN (SELECT miner_id FROM held WHERE date IS NOT NULL)""",
    "raw_days": _as_of("raw"),
    "qap_days": _as_of("qap"),
    "gained": f"""SELECT r.date, (r.total - p.total) / {PIB} AS raw,
            (q.total - o.total) / {PIB} AS qap
        FROM raw_days r JOIN qap_days q ON r.date = q.date
        ASOF LEFT JOIN raw_days p ON r.date > p.date
        ASOF LEFT JOIN qap_days o ON r.date > o.date""",
    "evened": """SELECT a.date, avg(b.raw) AS raw, avg(b.qap) AS qap
        FROM (SELECT *, count(*) OVER (ORDER BY date) AS i FROM gained) a
        JOIN (SELECT *, count(*) OVER (ORDER BY date) AS i FROM gained) b
            ON b.i BETWEEN a.i - 6 AND a.i GROUP BY a.date""",
}


def claims_query(select: str, last: str) -> str:
    """Select over the power steps up to the named one."""
    names = list(POWER_STEPS)
    return query(select, **{k: POWER_STEPS[k] for k in names[: names.index(last) + 1]})


FEES = {
    "fees": f"""SELECT {day("g.height")} AS date, m.method,
        (g.base_fee_burn + g.over_estimation_burn) / 1e18 AS fee
        FROM gas g JOIN msgs m ON g.cid = m.cid WHERE g.height > {FACTS.window_start}"""
}

# Where a method's sectors are listed: the lowest rank that is an array counts.
FIELDS = """(VALUES
    ('path', 'PreCommitSectorBatch2', 1, 'Sectors'),
    ('path', 'ProveCommitSectors3', 1, 'SectorActivations'),
    ('path', 'ProveReplicaUpdates3', 1, 'SectorUpdates'),
    ('path', 'ProveReplicaUpdates3', 2, 'Sectors'),
    ('path', 'ProveReplicaUpdates3', 3, 'SectorNumbers'),
    ('path', 'ProveCommitAggregate', 1, 'SectorNumbers'),
    ('size', 'PreCommitSectorBatch2', 1, 'Sectors'),
    ('size', 'ProveCommitSectors3', 1, 'SectorNumbers'),
    ('size', 'ProveCommitSectors3', 2, 'SectorProofs'),
    ('size', 'ProveCommitSectors3', 3, 'Sectors')) AS f(use, method, rank, field)"""


def listed(use: str) -> str:
    """The number of sectors that a message's parameters list, NULL without a list."""
    return f"""(SELECT CAST(arg_min(json_array_length(m.params, '$.' || f.field), f.rank) AS BIGINT)
        FROM {FIELDS} WHERE f.use = '{use}' AND f.method = m.method
        AND json_type(m.params, '$.' || f.field) = 'ARRAY')"""


def counted(methods: str, event_methods: str, use: str) -> dict[str, str]:
    """Per message: its listed sectors, else what its events say, each event once for every
    message of the id and method."""
    return {
        "adds": f"""SELECT message_cid, {day("height")} AS date, count(*) AS adds FROM mse
            WHERE event = 'SECTOR_ADDED' AND height > {FACTS.window_start} GROUP BY ALL""",
        "counts": f"""SELECT {day("m.height")} AS date, m.cid, m.method, coalesce({listed(use)},
                CASE WHEN m.method IN {event_methods} THEN look.adds * twin.copies END) AS sectors
            FROM msgs m
            LEFT JOIN LATERAL (SELECT adds FROM adds WHERE adds.message_cid = m.cid
                AND adds.date = {day("m.height")}) look ON true
            LEFT JOIN LATERAL (SELECT count(*) AS copies FROM msgs o WHERE o.cid = m.cid
                AND o.method = m.method AND o.height > {FACTS.window_start}) twin ON true
            WHERE m.height > {FACTS.window_start} AND m.method IN {methods}""",
    }


PATH_STEPS = counted(PATHS, EVENT_PATHS, "path")
COST = f"""SELECT cid, (base_fee_burn + over_estimation_burn) / 1e9 AS cost
    FROM gas WHERE height > {FACTS.window_start}"""
ARCHETYPE_STEPS = {
    **counted(
        "('PreCommitSectorBatch2', 'ProveCommitSectors3')", "('ProveCommitSectors3')", "size"
    ),
    "cost": COST,
    "classed": f"""SELECT date, method, CASE WHEN sectors >= {FACTS.large_batch_from}
        THEN 'large_sp' WHEN sectors >= {FACTS.small_batch_below} THEN 'medium_sp'
        ELSE 'small_sp' END AS sp_archetype, avg(cost / sectors) AS cost
        FROM counts JOIN cost ON counts.cid = cost.cid WHERE sectors > 0 GROUP BY 1, 2, 3""",
    "summed": "SELECT date, sp_archetype, sum(cost) AS cost FROM classed GROUP BY 1, 2",
}
AGG_SIZES = counted("('ProveCommitAggregate')", "('ProveCommitAggregate')", "path")
BATCHES = {
    "batches": f"""SELECT {day("height")} AS date, cid, {length("Sectors")} AS sectors FROM msgs
        WHERE height > {FACTS.window_start} AND method = 'PreCommitSectorBatch2'"""
}
BATCH_GAS = {
    **BATCHES,
    "batch_gas": """SELECT b.date, sum(CAST(g.gas_used AS DOUBLE)) / sum(b.sectors) AS per_sector
        FROM batches b JOIN gas g ON b.cid = g.cid WHERE b.sectors > 0 GROUP BY b.date""",
}
SUPPLY = {
    "daily": f"""SELECT date, avg(circulating) / 1e18 AS circulating, avg(burnt) / 1e18 AS burnt
        FROM ({dated("econ", EVENTS)}) GROUP BY date"""
}
REWARDS = {
    "tops": f"SELECT date, max(total) AS top FROM ({dated('rewards', EVENTS)}) GROUP BY date",
    "gains": "SELECT date, (top - lag(top) OVER (ORDER BY date)) / 1e18 AS gain FROM tops",
}
ADDED = {
    "added": f"""SELECT date, count(*) AS added FROM ({dated("mse", EVENTS)})
        WHERE event = 'SECTOR_ADDED' GROUP BY date"""
}
EXTENDED = {
    "extended": f"""SELECT date, count(*) AS extended FROM ({dated("mse", EVENTS)})
        WHERE event = 'SECTOR_EXTENDED' GROUP BY date"""
}
GAS_DAYS = {
    "gas_days": f"""SELECT *, (base_fee_burn + over_estimation_burn) / 1e18 AS fee
        FROM ({dated("gas", FACTS)})"""
}
RENEWAL = {
    "staged": f"""SELECT *, {phase(EVENTS)} AS phase FROM ({dated("mse", EVENTS)})
        WHERE event IN ('SECTOR_EXPIRED', 'SECTOR_EXTENDED')""",
    "daily": "SELECT date, count(*) FILTER (event = 'SECTOR_EXPIRED') AS expired, "
    "count(*) FILTER (event = 'SECTOR_EXTENDED') AS extended, "
    "round(100.0::DOUBLE * count(*) FILTER (event = 'SECTOR_EXTENDED') / count(*), 2) AS rate, "
    + ", ".join(
        f"round(100.0::DOUBLE * count(*) FILTER (event = 'SECTOR_EXTENDED' AND phase = '{p}') "
        f"/ nullif(count(*) FILTER (phase = '{p}'), 0), 2) AS {p}_rate"
        for p in ("pre", "during", "post")
    )
    + " FROM staged GROUP BY date",
}
SMALL = {
    **BATCHES,
    "small": """SELECT date, count(*) FILTER (sectors < 4) AS small, count(*) AS total,
        round(100.0::DOUBLE * count(*) FILTER (sectors < 4) / count(*), 2) AS small_pct,
        round(100.0::DOUBLE * count(*) FILTER (sectors >= 4) / count(*), 2) AS fuller_pct
        FROM batches GROUP BY date""",
}
ACTIVATIONS = {
    "acts": """SELECT cid, height, params, unnest(json_extract(params,
        '$.SectorActivations[*]')) AS sector,
        generate_subscripts(json_extract(params, '$.SectorActivations[*]'), 1) - 1 AS position
        FROM msgs WHERE method = 'ProveCommitSectors3'
        AND json_type(params, '$.SectorActivations') = 'ARRAY'""",
    "judged": """SELECT *, coalesce(regexp_matches(CAST(json_extract(sector, '$.Pieces')
        AS VARCHAR), '"Address"\\s*:\\s*"f05"'), false) AS market,
        coalesce(regexp_matches(CAST(json_extract(sector, '$.Pieces[*].Notify')
        AS VARCHAR), '"Address"\\s*:\\s*"f05"'), false) AS strict FROM acts""",
}


def _calling(part: str) -> str:
    """How many of a message's activations name the market actor in a part of theirs."""
    return f"""len(list_filter(json_extract(params, '$.SectorActivations[*]'),
        lambda s: coalesce(regexp_matches(CAST(json_extract(s, '$.{part}') AS VARCHAR),
        '"Address"\\s*:\\s*"f05"'), false)))"""


def metric_sql() -> dict[str, str]:
    c = FACTS.daily_gas_capacity
    seven = "OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    share = "sum(CASE WHEN method {} {} THEN fee ELSE 0 END)"
    return {
        "base_fee_percentiles": query(
            f"""SELECT {text()} AS date,
            {r("quantile_cont(fee, 0.5) / 1e9")} AS base_fee_p50_nanofil,
            {r("quantile_cont(fee, 0.95) / 1e9")} AS base_fee_p95_nanofil
            FROM ({dated("headers", EVENTS)}) GROUP BY ALL"""
        ),
        "burn_composition": query(
            f"""SELECT {text()} AS date,
            {r(share.format("IN", DISPUTE))} AS dispute_termination_gas_fil,
            {r(share.format("IN", ONBOARDING))} AS sector_onboarding_gas_fil,
            {r(share.format("NOT IN", CLASSED))} AS other_burn_fil
            FROM fees GROUP BY ALL""",
            **FEES,
        ),
        "circulating_supply_vs_burn": query(
            f"""SELECT {text()} AS date, {r("circulating")} AS circulating_fil,
            {r("burnt")} AS burnt_fil,
            {r("100.0 * (circulating - lag(circulating) OVER (ORDER BY date)) / lag(circulating) OVER (ORDER BY date)")} AS circulating_growth_pct,
            {r("100.0 * (burnt - lag(burnt) OVER (ORDER BY date)) / circulating")}
                AS daily_burn_rate_pct FROM daily""",
            **SUPPLY,
        ),
        "daily_fee_burn": query(
            f"""SELECT {text()} AS date, {r("sum(fee)")} AS total_fee_burn_fil,
            {r(share.format("IN", ONBOARDING))} AS sector_onboarding_gas_fil
            FROM fees GROUP BY ALL""",
            **FEES,
        ),
        "ddo_sector_onboarding": query(
            f"""SELECT {text(day("height"))} AS date,
            count(*) FILTER (NOT market) AS ddo_sectors,
            count(*) FILTER (market) AS non_ddo_sectors, count(*) AS total_pcs3_sectors
            FROM judged WHERE height > {FACTS.onboarding_window_start} GROUP BY ALL""",
            **ACTIVATIONS,
        ),
        "fil_return_per_sector": query(
            f"""SELECT {text("g.date")} AS date, {r("gain / added")} AS fil_return_per_sector
            FROM gains g JOIN added a ON g.date = a.date WHERE gain > 0 AND added > 0""",
            **REWARDS,
            **ADDED,
        ),
        "gas_per_sector_by_path": query(
            f"SELECT {text()} AS date, "
            + ", ".join(
                f"{r(f'avg(cost / sectors) FILTER (method = {p!r})', 4)} AS {p}"
                for p in PATHS[2:-2].split("', '")
            )
            + " FROM counts JOIN cost ON counts.cid = cost.cid WHERE sectors > 0 GROUP BY date",
            NANO_ZEROS,
            **PATH_STEPS,
            cost=COST,
        ),
        "gas_utilization": query(
            f"""SELECT {text("d.date")} AS date, d.pct AS gas_utilization_pct,
            round({c} / b.per_sector, 0) AS theoretical_max_sectors_per_day
            FROM (SELECT date, round(100.0::DOUBLE * sum(gas_used) / sum(gas_limit), 4) AS pct
                FROM gas_days GROUP BY date) d
            LEFT JOIN batch_gas b ON d.date = b.date""",
            **GAS_DAYS,
            **BATCH_GAS,
        ),
        "participating_miner_count": query(
            f"""SELECT {text()} AS date, max(miners) AS participating_miner_count
            FROM ({dated("powers", EVENTS)}) GROUP BY date"""
        ),
        "power_added": claims_query(
            f"""SELECT {text()} AS date, {r("raw")} AS raw_power_added,
            {r("qap")} AS quality_adjusted_power_added FROM evened""",
            "evened",
        ),
        "precommit_sector_batch_size": query(
            f"""SELECT {text("p.date")} AS date, {r("mean")} AS avg_sectors_per_message,
            median AS median_sectors_per_message, p.messages,
            {r("agg_mean")} AS avg_aggregate_size, agg_median AS median_aggregate_size,
            m.messages AS aggregate_messages
            FROM (SELECT date, avg(sectors) AS mean, quantile_disc(sectors, 0.5) AS median,
                count(*) AS messages FROM batches GROUP BY date) p
            LEFT JOIN (SELECT date, avg(sectors) AS agg_mean,
                quantile_disc(sectors, 0.5) AS agg_median
                FROM counts WHERE sectors > 0 GROUP BY date) a ON p.date = a.date
            LEFT JOIN (SELECT date, count(*) AS messages FROM counts GROUP BY date) m
                ON p.date = m.date""",
            **BATCHES,
            **AGG_SIZES,
        ),
        "renewal_rate": query(
            f"""SELECT {text()} AS date, expired AS expired_count, extended AS extended_count,
            rate AS renewal_rate_pct,
            {r(f"avg(pre_rate) {seven}")} AS renewal_rate_pre_pct,
            {r(f"avg(during_rate) {seven}")} AS renewal_rate_during_pct,
            {r(f"avg(post_rate) {seven}")} AS renewal_rate_post_pct FROM daily""",
            **RENEWAL,
        ),
        "sector_daily_fee_cost": query(
            f"""SELECT {text(day("start"))} AS date,
            {r("avg(fee * CAST(stop - start AS DOUBLE) * 30.0 / 86400.0 / 1e9)", 4)}
                AS avg_daily_fee_lifetime_cost_nanofil, count(*) AS sector_count
            FROM infos WHERE start >= {FACTS.upgrade_epoch} AND stop > start AND fee > 0
            GROUP BY 1"""
        ),
        "sector_extensions": query(
            f"""SELECT {text()} AS date, total AS extensions_per_day,
            nullif(pre, 0) AS extensions_pre_grace, nullif(during, 0) AS extensions_during_grace,
            nullif(post, 0) AS extensions_post_grace,
            {r("avg(total) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)")}
                AS baseline_rolling_30d
            FROM (SELECT date, count(*) AS total, count(*) FILTER (phase = 'pre') AS pre,
                count(*) FILTER (phase = 'during') AS during,
                count(*) FILTER (phase = 'post') AS post
                FROM staged WHERE event = 'SECTOR_EXTENDED' GROUP BY date)""",
            staged=RENEWAL["staged"],
        ),
        "sector_lifetime_cost": query(
            f"SELECT {text()} AS date, "
            + ", ".join(
                f"{r(f'max(cost) FILTER (sp_archetype = {a!r})', 4)} AS {a}"
                for a in ("large_sp", "medium_sp", "small_sp")
            )
            + " FROM summed GROUP BY date",
            NANO_ZEROS,
            **ARCHETYPE_STEPS,
        ),
        "small_batch_count": query(
            f"""SELECT {text()} AS date, small AS small_batch_count, total AS total_batch_count,
            small_pct AS small_batch_pct, fuller_pct AS fuller_batch_pct FROM small""",
            **SMALL,
        ),
    }


def operator_sql() -> dict[str, str]:
    facts, events, claims = dated("msgs", FACTS), dated("mse", EVENTS), dated("claims", CLAIMS)
    rows = {
        "scan_project": query("SELECT height, miners AS participating_miner_count FROM powers "),
        "schema_resolve_column": query(
            "SELECT 'message_cid' AS column_name, count(message_cid) AS ids FROM mse "
        ),
        "filter_epoch_after": query(
            f"SELECT height, cid FROM msgs WHERE height > {FACTS.window_start}"
        ),
        "filter_in": query(f"SELECT cid, method FROM msgs WHERE method IN {PATHS}"),
        "bucket_not_in": query(
            f"""SELECT {text()} AS date,
            {n(f"sum(CASE WHEN method IN {CLASSED} THEN 1 ELSE 0 END)")} AS classed,
            {n(f"sum(CASE WHEN method NOT IN {CLASSED} THEN 1 ELSE 0 END)")} AS other,
            count(*) AS messages FROM ({facts}) GROUP BY date"""
        ),
        "scalar_subquery_filter": claims_query(
            f"""SELECT {text()} AS date, miner_id, {r(RAW)} AS raw_byte_power,
            {r(QAP)} AS quality_adj_power FROM known WHERE date >= {_FIRST}""",
            "known",
        ),
        "join_inner_cid": query(
            f"""SELECT g.cid, {text(day("g.height"))} AS date, m.method, count(*) AS pairs,
            {r("sum((g.base_fee_burn + g.over_estimation_burn) / 1e18)")} AS fee
            FROM gas g JOIN msgs m ON g.cid = m.cid WHERE g.height > {FACTS.window_start}
            GROUP BY ALL"""
        ),
        "join_inner_daily": query(
            f"""SELECT {text("g.date")} AS date, {r("gain")} AS reward, added
            FROM gains g JOIN added a ON g.date = a.date""",
            **REWARDS,
            **ADDED,
        ),
        "join_left_daily": query(
            f"""SELECT {text("d.date")} AS date, {n("d.gas_used")} AS gas_used,
            {r("b.per_sector")} AS gas_per_sector
            FROM (SELECT date, sum(gas_used) AS gas_used FROM gas_days GROUP BY date) d
            LEFT JOIN batch_gas b ON d.date = b.date""",
            **GAS_DAYS,
            **BATCH_GAS,
        ),
        "join_left_composite": query(
            f"""SELECT {text("s.date")} AS date, s.cid, s.method, count(DISTINCT s.rid) AS copies,
            nullif(count(e.message_cid) // count(DISTINCT s.rid), 0) AS events
            FROM (SELECT *, row_number() OVER () AS rid FROM ({facts})) s
            LEFT JOIN (SELECT {day("height")} AS date, message_cid FROM mse
                WHERE height > {FACTS.window_start} AND event = 'SECTOR_ADDED') e
            ON s.date = e.date AND s.cid = e.message_cid GROUP BY ALL"""
        ),
        "join_semi": claims_query(
            f"""SELECT miner_id, {r(RAW)} AS raw_byte_power, {r(QAP)} AS quality_adj_power
            FROM held WHERE date IS NULL
            AND miner_id IN (SELECT miner_id FROM held WHERE date IS NOT NULL)""",
            "held",
        ),
        "explode_json_array": query(
            "SELECT cid, CAST(position AS INTEGER) AS position, CAST(sector AS VARCHAR) AS sector "
            "FROM acts ",
            acts=ACTIVATIONS["acts"],
        ),
        "agg_sum": query(
            f"""SELECT {text()} AS date, {n("sum(gas_used)")} AS gas_used, {r("sum(fee)")} AS fee
            FROM gas_days GROUP BY date""",
            **GAS_DAYS,
        ),
        "agg_sum_case": query(
            f"""SELECT {text()} AS date,
            {r("sum(CASE WHEN gas_used >= 25000000 THEN fee ELSE 0 END)")} AS large_fee,
            {r("sum(CASE WHEN gas_used < 25000000 THEN fee ELSE 0 END)")} AS small_fee
            FROM gas_days GROUP BY date""",
            **GAS_DAYS,
        ),
        "agg_count": query(
            f"SELECT {text()} AS date, event, count(*) AS events FROM ({events}) GROUP BY ALL"
        ),
        "agg_count_if": query(
            f"""SELECT {text()} AS date,
            count(*) FILTER (method = 'PreCommitSectorBatch2') AS batches,
            count(*) FILTER (method <> 'PreCommitSectorBatch2') AS others,
            count(*) AS messages FROM ({facts}) GROUP BY date"""
        ),
        "agg_avg": query(
            f"""SELECT {text()} AS date, {r(f"avg(raw) / {PIB}")} AS raw_byte_power,
            {r(f"avg(qap) / {PIB}")} AS quality_adj_power FROM ({claims}) GROUP BY date"""
        ),
        "agg_min_max": query(
            f"""SELECT {text()} AS date, min(miners) AS least, max(miners) AS most
            FROM ({dated("powers", EVENTS)}) GROUP BY date"""
        ),
        "agg_percentile_exact": query(
            f"SELECT {text()} AS date, "
            + ", ".join(
                f"{r(f'quantile_cont(fee, {p})')} AS {name}"
                for name, p in (
                    ("p05", 0.05),
                    ("p25", 0.25),
                    ("p50", 0.5),
                    ("p95", 0.95),
                    ("p100", 1.0),
                )
            )
            + " FROM gas_days GROUP BY date",
            **GAS_DAYS,
        ),
        "agg_median_approx": query(
            f"""SELECT {text()} AS date, quantile_disc(sectors, 0.5) AS median
            FROM batches GROUP BY date""",
            **BATCHES,
        ),
        "ratio_of_sums": query(
            f"""SELECT {text()} AS date,
            {r("CAST(sum(gas_used) AS DOUBLE) / nullif(sum(gas_limit), 0)")} AS share
            FROM gas_days GROUP BY date""",
            **GAS_DAYS,
        ),
        "mean_of_ratios": query(
            f"""SELECT {text()} AS date,
            {r("avg(fee / nullif(gas_used / 1000000.0 - 25, 0))")} AS fee_rate
            FROM gas_days GROUP BY date""",
            **GAS_DAYS,
        ),
        "ratio_of_counts": query(
            f"SELECT {text()} AS date, small_pct AS small_pct FROM small ", **SMALL
        ),
        "agg_two_level": query(
            f"SELECT {text()} AS date, sp_archetype, {r('cost', 4)} AS cost FROM summed ",
            NANO_ZEROS,
            **ARCHETYPE_STEPS,
        ),
        "distinct_keys": query(
            f"SELECT DISTINCT {text()} AS date, miner_id FROM ({claims})"
        ),
        "pivot_mean": query(
            f"SELECT {text()} AS date, "
            + ", ".join(
                f"{r(f'avg(parsed) FILTER (method = {p!r})')} AS {p}"
                for p in PATHS[2:-2].split("', '")
            )
            + " FROM sized GROUP BY date",
            sized=f"""SELECT {day("m.height")} AS date, method, {listed("path")} AS parsed
                FROM msgs m WHERE height > {FACTS.window_start} AND method IN {PATHS}""",
        ),
        "agg_any": query(
            f"""SELECT {text()} AS date, bool_or(qap IS NULL) AS any_silent,
            coalesce(bool_or(raw > 3.5e14), false) AS any_large FROM ({claims}) GROUP BY date"""
        ),
        "win_latest_per_day": query(
            f"""SELECT {text()} AS date, miner_id, {r(f"raw / {PIB}")} AS raw FROM (
            SELECT *, row_number() OVER (PARTITION BY date, miner_id
                ORDER BY height DESC, raw DESC NULLS LAST) AS rn FROM ({claims})) WHERE rn = 1"""
        ),
        "win_latest_before": query(
            f"""SELECT miner_id, {r(RAW)} AS raw_byte_power, {r(QAP)} AS quality_adj_power
            FROM held WHERE date IS NULL""",
            held=POWER_STEPS["held"],
        ),
        "win_lag_delta": query(
            f"""SELECT {text()} AS date,
            {r("circulating - lag(circulating) OVER (ORDER BY date)")} AS change FROM daily """,
            **SUPPLY,
        ),
        "win_lag_pct": query(
            f"""SELECT {text()} AS date, {r("100.0 * (circulating - lag(circulating) OVER (ORDER BY date)) / lag(circulating) OVER (ORDER BY date)")} AS growth_pct FROM daily """,
            **SUPPLY,
        ),
        "win_fill_forward": claims_query(
            f"""SELECT {text()} AS date, miner_id, {r(f'''last_value(qap IGNORE NULLS) OVER (
                PARTITION BY miner_id ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / {PIB}''')} AS carried
            FROM known""",
            "known",
        ),
        "win_rolling_30": query(
            f"""SELECT {text()} AS date, {r('''avg(extended) OVER (ORDER BY date
                ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)''')} AS mean_30 FROM extended """,
            **EXTENDED,
        ),
        "win_rolling_7": query(
            f"""SELECT {text()} AS date, {r("avg(extended) OVER w")} AS mean_7,
            CASE WHEN count(extended) OVER w >= 7 THEN {r("avg(extended) OVER w")} END
                AS mean_full_7
            FROM extended
            WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
            **EXTENDED,
        ),
        "union_all": query(
            f"""SELECT {text()} AS date, cid FROM (SELECT date, cid FROM ({facts})
            UNION ALL SELECT date, cid FROM ({dated("gas", FACTS)}))"""
        ),
        "epoch_to_day": query(
            f"SELECT cid, height, {text(day('height'))} AS date FROM msgs "
        ),
        "format_date": query(
            f"SELECT {text(day('height'))} AS text, count(*) AS messages FROM msgs GROUP BY 1"
        ),
        "unit_convert": query(
            f"""SELECT height, cid, {r("base_fee_burn / 1e18")} AS coins,
            {r("base_fee_burn / 1e9 / 1e6")} AS thousandths, {r(f"gas_used / {PIB} * 1e6")} AS size
            FROM gas """
        ),
        "safe_divide": query(
            f"""SELECT height, cid, {r("base_fee_burn / nullif(over_estimation_burn, 0)")} AS share
            FROM gas """
        ),
        "nullif_zero": query(f"SELECT cid, nullif({length('Sectors')}, 0) AS sectors FROM msgs "),
        "coalesce_chain": query(
            f"""SELECT cid, coalesce({length("SectorUpdates")}, {length("Sectors")},
            {length("SectorNumbers")}) AS sectors FROM msgs
            WHERE method = 'ProveReplicaUpdates3'"""
        ),
        "case_bucket": query(
            f"""SELECT {text()} AS date, CASE WHEN gas_used >= 40000000 THEN 'heavy'
            WHEN gas_used >= 20000000 THEN 'middle' ELSE 'light' END AS load,
            count(*) AS rows FROM gas_days GROUP BY ALL""",
            **GAS_DAYS,
        ),
        "json_array_len": query(
            "SELECT cid, "
            + ", ".join(
                f"{length(f)} AS {f}"
                for f in (
                    "Sectors",
                    "SectorActivations",
                    "SectorUpdates",
                    "SectorNumbers",
                    "Deadline",
                )
            )
            + " FROM msgs "
        ),
        "json_query": query(
            """SELECT cid, CAST(position AS INTEGER) AS position,
            CASE WHEN json_type(sector, '$.Pieces') <> 'NULL'
                THEN CAST(json_extract(sector, '$.Pieces') AS VARCHAR) END AS pieces
            FROM acts """,
            acts=ACTIVATIONS["acts"],
        ),
        "regexp_match": query(
            """SELECT cid, coalesce(regexp_matches(params, '"Address"\\s*:\\s*"f05"'), false)
            AS calls FROM msgs """
        ),
        "to_finite": """SELECT c_custkey, CASE WHEN isfinite(x) THEN x END + 0.0 AS number FROM (
            SELECT c_custkey, try_cast(nullif(CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN ''
                WHEN 2 THEN 'Infinity' WHEN 3 THEN split_part(c_name, '#', 2) || 'd'
                ELSE split_part(c_name, '#', 2) END, '') AS DOUBLE) AS x
            FROM customer)""",
        "daily_latest": claims_query(
            f"""SELECT {text()} AS date, miner_id, {r(RAW)} AS raw_byte_power,
            {r(QAP)} AS quality_adj_power FROM held WHERE date IS NOT NULL""",
            "held",
        ),
        "seed_anchor": claims_query(
            f"""SELECT {text()} AS date, miner_id, {r(RAW)} AS raw_byte_power,
            {r(QAP)} AS quality_adj_power FROM known""",
            "known",
        ),
        "fill_forward": claims_query(
            f"""SELECT k.miner_id, {r("a.raw / " + PIB)} AS raw_byte_power,
            {r("b.qap / " + PIB)} AS quality_adj_power, {text("k.date")} AS valid_from,
            {text("(SELECT min(n.date) FROM known n WHERE n.miner_id = k.miner_id AND n.date > k.date)")}
                AS valid_to
            FROM known k
            ASOF LEFT JOIN (SELECT * FROM known WHERE raw IS NOT NULL) a
                ON k.miner_id = a.miner_id AND k.date >= a.date
            ASOF LEFT JOIN (SELECT * FROM known WHERE qap IS NOT NULL) b
                ON k.miner_id = b.miner_id AND k.date >= b.date""",
            "known",
        ),
        "state_as_of": claims_query(
            f"""SELECT c.height, c.miner_id, {text("c.week_before")} AS week_before,
            {r("a.raw / " + PIB)} AS raw_byte_power, {r("b.qap / " + PIB)} AS quality_adj_power
            FROM (SELECT height, miner_id, CAST(date - 7 AS DATE) AS week_before FROM ({claims})) c
            ASOF LEFT JOIN (SELECT * FROM known WHERE raw IS NOT NULL) a
                ON c.miner_id = a.miner_id AND c.week_before >= a.date
            ASOF LEFT JOIN (SELECT * FROM known WHERE qap IS NOT NULL) b
                ON c.miner_id = b.miner_id AND c.week_before >= b.date""",
            "known",
        ),
        "state_delta_daily": claims_query(
            f"""SELECT {text()} AS date, {r("raw")} AS raw_byte_power,
            {r("qap")} AS quality_adj_power FROM gained""",
            "gained",
        ),
        "rolling_mean": claims_query(
            f"""SELECT {text()} AS date, {r("raw")} AS raw_byte_power,
            {r("qap")} AS quality_adj_power FROM evened""",
            "evened",
        ),
        "cumulative_to_daily": query(
            f"SELECT {text()} AS date, {r('gain')} AS reward FROM gains ", **REWARDS
        ),
        "phase_of": query(
            f"""SELECT {text()} AS date, {phase(EVENTS)} AS phase, count(*) AS events
            FROM ({events}) GROUP BY ALL"""
        ),
        "method_class": query(
            f"""SELECT method, CASE WHEN method IN {DISPUTE} THEN 'dispute'
            WHEN method IN {ONBOARDING} THEN 'onboarding' WHEN method IS NOT NULL THEN 'other'
            END AS class, count(*) AS messages FROM msgs GROUP BY ALL"""
        ),
        "size_class": query(
            f"""SELECT {text()} AS date, CASE WHEN sectors >= 10 THEN 'large_sp'
            WHEN sectors >= 4 THEN 'medium_sp' ELSE 'small_sp' END AS size, count(*) AS messages,
            {n("sum(sectors)")} AS sectors FROM counts WHERE sectors > 0 GROUP BY 1, 2""",
            **PATH_STEPS,
        ),
        "param_count": query(
            f"SELECT cid, method, {listed('path')} AS sectors FROM msgs m WHERE method IN {PATHS}"
        ),
        "count_with_event_fallback": query(
            f"""SELECT {text()} AS date, cid, method, sectors AS sector_count, count(*) AS copies
            FROM counts GROUP BY ALL""",
            **PATH_STEPS,
        ),
        "message_cost": query(
            f"""SELECT height, cid, {r("(base_fee_burn + over_estimation_burn) / 1e9", 4)} AS cost
            FROM gas WHERE height > {FACTS.window_start}""",
            NANO_ZEROS,
        ),
        "classify_nested": query(
            f"""SELECT cid, {length("SectorActivations")} AS total,
            {n(_calling("Pieces"))} AS market, {n(_calling("Pieces[*].Notify"))} AS strict
            FROM msgs WHERE method = 'ProveCommitSectors3'
            AND json_type(params, '$.SectorActivations') = 'ARRAY'"""
        ),
        "lifetime_cost": query(
            f"""SELECT start AS activation_epoch, stop AS expiration_epoch,
            {r("fee * CAST(stop - start AS DOUBLE) * 30.0 / 86400.0 / 1e9", 4)} AS cost
            FROM infos """
        ),
        "theoretical_capacity": query(
            f"""SELECT {text()} AS date, round({FACTS.daily_gas_capacity} / per_sector, 0)
            AS capacity FROM batch_gas """,
            **BATCH_GAS,
        ),
        "yield_per_unit": query(
            f"""SELECT {text("g.date")} AS date, {r("gain / added")} AS per_sector
            FROM gains g JOIN added a ON g.date = a.date WHERE gain > 0 AND added > 0""",
            **REWARDS,
            **ADDED,
        ),
        "check_pct_sum": query(
            f"""SELECT {r("max(off)")} AS max_off, count(*) FILTER (off >= 0.5) AS days_off,
            count(off) AS days_checked
            FROM (SELECT abs(small_pct + fuller_pct - 100) AS off FROM small)""",
            **SMALL,
        ),
    }
    rows["seed_state"] = rows["join_semi"]
    rows["sort_desc"] = rows["agg_sum"] + " ORDER BY 1 DESC"
    rows["sort_mixed"] = rows["agg_count"] + " ORDER BY 1 DESC, 2"
    return rows


# Every chart of the page, with its metric, unit and columns.
PAGE = (
    ("power_added", "power_added:raw_power_added", "PiB", "raw_power_added"),
    ("power_added", "power_added:quality_adjusted_power_added", "PiB (QAP)", "quality_adjusted_power_added"),
    ("participating_miner_count", "participating_miner_count:participating_miner_count", "Miners", "participating_miner_count"),
    ("precommit_sector_batch_size", "precommit_sector_batch_size:avg_sectors_per_message", "Sectors", "avg_sectors_per_message median_sectors_per_message"),
    ("precommit_sector_batch_size", "precommit_sector_batch_size:messages", "Messages", "messages aggregate_messages"),
    ("precommit_sector_batch_size", "precommit_sector_batch_size:avg_aggregate_size", "Sectors", "avg_aggregate_size median_aggregate_size"),
    ("gas_per_sector_by_path", "gas_per_sector_by_path:PreCommitSectorBatch2", "nanoFIL", "PreCommitSectorBatch2 ProveCommitSectors3 ProveCommitAggregate ProveReplicaUpdates3"),
    ("ddo_sector_onboarding", "ddo_sector_onboarding:ddo_sectors", "Sectors", "ddo_sectors non_ddo_sectors"),
    ("small_batch_count", "small_batch_count:fuller_batch_pct", "%", "fuller_batch_pct"),
    ("fil_return_per_sector", "fil_return_per_sector:fil_return_per_sector", "FIL / sector", "fil_return_per_sector"),
    ("daily_fee_burn", "daily_fee_burn:total_fee_burn_fil", "FIL", "total_fee_burn_fil sector_onboarding_gas_fil"),
    ("sector_lifetime_cost", "sector_lifetime_cost:large_sp", "nanoFIL", "large_sp medium_sp small_sp"),
    ("sector_daily_fee_cost", "sector_daily_fee_cost:avg_daily_fee_lifetime_cost_nanofil", "nanoFIL", "avg_daily_fee_lifetime_cost_nanofil"),
    ("base_fee_percentiles", "base_fee_percentiles:base_fee_p50_nanofil", "nanoFIL", "base_fee_p50_nanofil base_fee_p95_nanofil"),
    ("gas_utilization", "gas_utilization:gas_utilization_pct", "%", "gas_utilization_pct"),
    ("gas_utilization", "gas_utilization:theoretical_max_sectors_per_day", "Sectors / day", "theoretical_max_sectors_per_day"),
    ("burn_composition", "burn_composition:dispute_termination_gas_fil", "FIL", "dispute_termination_gas_fil sector_onboarding_gas_fil other_burn_fil"),
    ("circulating_supply_vs_burn", "circulating_supply_vs_burn:circulating_fil", "FIL", "circulating_fil burnt_fil"),
    ("circulating_supply_vs_burn", "circulating_supply_vs_burn:circulating_growth_pct", "%", "circulating_growth_pct daily_burn_rate_pct"),
    ("sector_extensions", "sector_extensions:extensions_pre_grace", "Extensions", "extensions_pre_grace extensions_during_grace extensions_post_grace baseline_rolling_30d"),
    ("renewal_rate", "renewal_rate:expired_count", "Sectors", "expired_count extended_count"),
    ("renewal_rate", "renewal_rate:renewal_rate_pre_pct", "%", "renewal_rate_pre_pct renewal_rate_during_pct renewal_rate_post_pct"),
)


def series_sql(frames: dict[str, str]) -> dict[str, str]:
    millis = "CAST(epoch_ms(CAST(date AS TIMESTAMP)) AS BIGINT)"

    def points(metric: str, column: str, extra: str) -> str:
        return (
            f"SELECT {extra} date, {millis} AS x_millis, CAST({column} AS DOUBLE) AS y "
            f"FROM ({frames[metric]}) WHERE {column} IS NOT NULL"
        )

    sizes = (("avg_aggregate_size", "mean"), ("median_aggregate_size", "median"))
    renewal = (
        "expired_count",
        "extended_count",
        "renewal_rate_pct",
        "renewal_rate_pre_pct",
        "renewal_rate_during_pct",
        "renewal_rate_post_pct",
    )
    return {
        "series_points": points("gas_utilization", "gas_utilization_pct", ""),
        "series_unpivot": " UNION ALL ".join(
            points("precommit_sector_batch_size", column, f"'{label}' AS series,")
            for column, label in sizes
        ),
        "series_has_data": " UNION ALL ".join(
            f"SELECT '{c}' AS series, count({c}) AS points, count({c}) > 0 AS has_data "
            f"FROM ({frames['renewal_rate']})"
            for c in renewal
        ),
        "phase_coverage": " UNION ALL ".join(
            f"SELECT '{p}' AS phase, coalesce(bool_or(renewal_rate_{p}_pct IS NOT NULL "
            f"AND expired_count > 0), false) AS covered FROM ({frames['renewal_rate']})"
            for p in ("pre", "during", "post")
        ),
        "metric_catalog": " UNION ALL ".join(
            points(
                metric,
                column,
                f"'{chart}' AS chart, '{column}' AS series, '{unit}' AS unit,",
            )
            for metric, chart, unit, columns in PAGE
            for column in columns.split()
        ),
    }


def all_sql() -> dict[str, str]:
    frames = metric_sql()
    return {**frames, **operator_sql(), **series_sql(frames)}
