"""Ledger tables derived from the order, line-item and event tables of the test data.

Every row is derived on its own from one source row: no join and no grouping, so the views
nearly keep the size and the key distribution of their sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epochloom.config import LedgerConfig
from epochloom.sources.tables import Ledger

# Orders and line items: a window from 1995-03, an upgrade at noon on 1997-06-15.
FACTS = LedgerConfig(
    genesis_unix=788_918_400,
    window_start=59 * 2880,
    onboarding_window_start=1096 * 2880 + 1440,
    upgrade_epoch=896 * 2880 + 1440,
)
# Events: January 2024, with the upgrade and the end of the grace window inside days.
EVENTS = LedgerConfig(
    genesis_unix=788_918_400,
    window_start=10593 * 2880,
    upgrade_epoch=10602 * 2880 + 720,
    grace_days=9,
)
# Claims before 2024-01-08 become the seed.
CLAIMS = EVENTS.with_(window_start=10599 * 2880 - 1)


# Declared, so that opening a table reads no file footers.
SCHEMAS = {
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}
EVENT_HEIGHT = (
    "datediff(to_date(ts), DATE'1995-01-01') * 2880L"
    " + (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) div 30"
)
ORDER_HEIGHT = "datediff(to_date(o_orderdate), DATE'1995-01-01') * 2880L + o_orderkey % 2880"
LINE_HEIGHT = "datediff(to_date(l_shipdate), DATE'1995-01-01') * 2880L + l_partkey % 2880"
CENTS = "CAST(round(value * 100) AS BIGINT)"
PRICE = "CAST(round(l_extendedprice * 100) AS BIGINT)"
METHOD = """CASE
    WHEN o_orderpriority = '1-URGENT' THEN 'PreCommitSectorBatch2'
    WHEN o_orderpriority = '2-HIGH' THEN 'ProveCommitSectors3'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'ProveCommitAggregate'
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'ProveReplicaUpdates3'
    WHEN o_orderstatus = 'O' THEN 'DisputeWindowedPoSt'
    WHEN o_orderstatus = 'F' THEN 'SubmitWindowedPoSt' END"""
SECTOR = """concat('{"SectorNumber":', i, '}')"""
ACTIVATION = """CASE (o_custkey + i) % 5
    WHEN 0 THEN '{"SectorType":8}'
    WHEN 1 THEN '{"Pieces":null}'
    WHEN 3 THEN '{"Pieces":[{"Size":1,"Address":"f05","Notify":[]}]}'
    WHEN 2 THEN '{"Pieces":[{"Size":1,"Notify":[{"Address":"f05"}]}]}'
    ELSE '{"Pieces":[{"Size":1,"Notify":[{"Address":"f099"}]}]}' END"""


def _amount(units: str, zeros: int, key: str) -> str:
    """The units scaled up, with lower digits drawn from the key; 0 stays 0.

    Doubles, because that is how every job reads an amount. The drawn digits keep results off
    the exact halves on which engines round differently.
    """
    digits = f"CAST({key} * 7919L * 1000003L % {10**zeros}L AS DOUBLE)"
    scaled = f"CAST({units} AS DOUBLE) * CAST({10**zeros}L AS DOUBLE) + {digits}"
    return f"CASE WHEN ({units}) <> 0 THEN {scaled} ELSE 0D END"


def _array(field: str, element: str) -> str:
    """JSON object with one array of o_custkey % 13 elements."""
    index = "filter(sequence(0, 12), i -> i < o_custkey % 13)"
    joined = f"array_join(transform({index}, i -> {element}), ',')"
    return f"""concat('{{"{field}":[', {joined}, ']}}')"""


PARAMS = f"""CASE
    WHEN o_orderkey % 7 = 0 THEN NULL
    WHEN o_orderkey % 11 = 0 THEN '{{"Deadline":1}}'
    WHEN method = 'PreCommitSectorBatch2' THEN {_array("Sectors", SECTOR)}
    WHEN method = 'ProveCommitSectors3' AND o_orderkey % 2 = 0
        THEN {_array("SectorActivations", ACTIVATION)}
    WHEN method = 'ProveCommitSectors3' THEN {_array("SectorProofs", SECTOR)}
    WHEN method = 'ProveCommitAggregate' THEN {_array("SectorNumbers", SECTOR)}
    WHEN method = 'ProveReplicaUpdates3' AND o_custkey % 3 = 0
        THEN {_array("SectorUpdates", SECTOR)}
    WHEN method = 'ProveReplicaUpdates3' AND o_custkey % 3 = 1 THEN {_array("Sectors", SECTOR)}
    WHEN method = 'ProveReplicaUpdates3' THEN {_array("SectorNumbers", SECTOR)} END"""


# Some messages come twice, and some have the id of an order four before, on another day.
COPIES = "explode(sequence(1, if(o_orderkey % 40 = 3, 2, 1))) AS copy"
MESSAGE_ID = "concat('m', o_orderkey - if(o_orderkey % 40 = 7, 4, 0))"


def _messages(orders: DataFrame) -> DataFrame:
    return orders.selectExpr("*", f"{METHOD} AS method", COPIES).selectExpr(
        f"{ORDER_HEIGHT} AS height",
        f"{MESSAGE_ID} AS cid",
        "method",
        f"{PARAMS} AS params",
    )


def _sector_events(orders: DataFrame, events: DataFrame) -> DataFrame:
    added = orders.selectExpr(
        f"{ORDER_HEIGHT} + if(o_orderkey % 14 = 0, 2880, 0) AS height",
        "'SECTOR_ADDED' AS event",
        "concat('m', o_orderkey) AS message_cid",
        "explode(sequence(1, CAST(1 + o_custkey % 4 AS INT))) AS copy",
    ).drop("copy")
    other = events.selectExpr(
        f"{EVENT_HEIGHT} AS height",
        """CASE event_type WHEN 'view' THEN 'SECTOR_ADDED' WHEN 'signup' THEN 'SECTOR_EXTENDED'
            WHEN 'purchase' THEN 'SECTOR_EXPIRED' ELSE 'SECTOR_SNAPPED' END AS event""",
        "CAST(NULL AS STRING) AS message_cid",
    )
    return added.unionByName(other)


def _claims(events: DataFrame) -> DataFrame:
    adjusted = _amount(f"{CENTS} * (1 + event_id % 10)", 10, "user_id")
    return events.selectExpr(
        f"{EVENT_HEIGHT} AS height",
        "concat('f0', user_id) AS miner_id",
        f"{_amount(CENTS, 10, 'event_id')} AS raw_byte_power",
        f"CASE WHEN event_id % 50 <> 0 THEN {adjusted} END AS quality_adj_power",
    )


def _gas(lines: DataFrame, fee_zeros: int) -> DataFrame:
    base = _amount(f"{PRICE} * CAST(round(l_discount * 100) AS BIGINT)", fee_zeros, "l_partkey")
    over = _amount(f"{PRICE} * CAST(round(l_tax * 100) AS BIGINT)", fee_zeros, "l_suppkey")
    return lines.selectExpr(
        f"{LINE_HEIGHT} AS height",
        "concat('m', l_orderkey) AS cid",
        f"CASE WHEN l_linenumber <> 6 THEN {base} END AS base_fee_burn",
        f"CASE WHEN l_linenumber <> 5 THEN {over} END AS over_estimation_burn",
        "CAST(l_quantity AS BIGINT) * 1000000L AS gas_used",
        "50000000L AS gas_limit",
    )


def _sector_infos(lines: DataFrame) -> DataFrame:
    fee = f"CASE WHEN l_discount = 0 THEN 0D ELSE {_amount(PRICE, 6, 'l_partkey')} END"
    return lines.selectExpr(
        f"{LINE_HEIGHT} AS activation_epoch",
        f"{LINE_HEIGHT} + (l_suppkey % 20 - 4) * 28800 + 1 + l_partkey % 6 AS expiration_epoch",
        f"CASE WHEN l_linenumber <> 7 THEN {fee} END AS daily_fee",
    )


def stand_in_ledger(spark: SparkSession, sf_dir: str, fee_zeros: int = 12) -> Ledger:
    """`fee_zeros` scales the burnt fees, to suit metrics in whole coins (12) or nanos (5)."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def from_events(*columns: str) -> DataFrame:
        return table("events").selectExpr(f"{EVENT_HEIGHT} AS height", *columns)

    def amount(units: str, zeros: int, name: str) -> str:
        return f"{_amount(units, zeros, 'event_id')} AS {name}"

    return Ledger(
        block_headers=lambda: from_events(
            f"CASE WHEN event_id % 31 <> 0 THEN {_amount(CENTS, 7, 'event_id')} END"
            " AS parent_base_fee"
        ),
        derived_gas_outputs=lambda: _gas(table("lineitem"), fee_zeros),
        parsed_messages=lambda: _messages(table("orders")),
        miner_sector_events=lambda: _sector_events(table("orders"), table("events")),
        power_actor_claims=lambda: _claims(table("events")),
        chain_economics=lambda: from_events(
            amount(f"{CENTS} + 100000", 16, "circulating_fil"),
            amount(f"{CENTS} div 10", 16, "burnt_fil"),
        ),
        chain_rewards=lambda: from_events(
            amount(f"event_id * 1000 + {CENTS}", 16, "total_mined_reward")
        ),
        chain_powers=lambda: from_events("user_id AS participating_miner_count"),
        miner_sector_infos=lambda: _sector_infos(table("lineitem")),
    )
