"""Plans over facts stored by id, and plans of a refresh."""

import datetime as dt
import random
import re

import pytest

from epochloom.functions.params import with_variant
from epochloom.operators import messages as m
from epochloom.plans import catalog
from epochloom.plans.marts import Marts, onboarding
from epochloom.plans.metrics import DAILY
from epochloom.plans.series import CHARTS, drawn
from epochloom.sources.tables import (
    SCHEMAS,
    catalog_ledger,
    load_ledger,
    write_buckets,
    write_table,
)
from tests.ledgers import CFG, COIN, rows, store

FACTS = ("parsed_messages", "miner_sector_events", "derived_gas_outputs")


def hot_rows(seed=2):
    """The boundary rows, and ids that repeat on every side, some of them NULL."""
    rng = random.Random(seed)
    out = rows(extra_days=4)
    cid = lambda: "hot" if rng.random() < 0.4 else rng.choice(["b", "c", "d", None])
    height = lambda: rng.choice([3990000, 5200000]) + rng.randrange(6) * 2880
    fields = ["Sectors", "SectorActivations", "SectorNumbers", "SectorProofs", "SectorUpdates"]
    methods = ["PreCommitSectorBatch2", "ProveCommitSectors3", "ProveCommitAggregate",
               "ProveReplicaUpdates3", "TerminateSectors", "Send", None]
    for _ in range(120):
        params = f'{{"{rng.choice(fields)}":{list(range(rng.randrange(13)))}}}'
        out["parsed_messages"].append(
            (height(), cid(), rng.choice(methods), rng.choice([params, params, None]))
        )
        fee = [None if rng.random() < 0.1 else COIN * rng.randrange(9) for _ in range(2)]
        out["derived_gas_outputs"].append((height(), cid(), *fee, rng.randrange(99), 99))
        kind = rng.choice(["SECTOR_ADDED", "SECTOR_ADDED", "SECTOR_EXPIRED"])
        out["miner_sector_events"].append((height(), kind, cid()))
    return out


def points(frame):
    found = frame.collect()
    return sorted((r.chart, r.series, str(r.date), r.unit, round(r.y, 4)) for r in found)


@pytest.fixture
def ledger(spark, tmp_path):
    return store(spark, str(tmp_path / "facts"), hot_rows())


@pytest.mark.parametrize("metric", catalog.READINGS + catalog.BY_ID)
def test_wide_frames_hold_each_metric(spark, ledger, metric):
    options = {"check": False} if metric == "small_batch_count" else {}
    charts = [c for c in CHARTS if c.metric == metric]
    wanted = points(drawn(DAILY[metric](Marts(ledger, CFG), **options), charts))
    (found,) = [f for names, f in catalog.wide_frames(ledger, CFG, [metric]) if metric in names]
    assert points(drawn(found, charts)) == wanted
    assert wanted or metric == "ddo_sector_onboarding"


def test_the_catalogue_reads_each_fact_once(spark, ledger):
    names = [n for n in DAILY if n in catalog.READINGS + catalog.BY_ID]
    frames = catalog.wide_frames(ledger, CFG, names)
    assert len(frames) == 2
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        plan = catalog.catalog(frames)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    for table in ("derived_gas_outputs", "parsed_messages", "chain_rewards", "chain_powers"):
        assert sum(table in line for line in scans) == 1, table
    # for the day counts, and by id for the event fallback
    assert sum("miner_sector_events" in line for line in scans) == 2
    assert len(scans) == 7


@pytest.fixture
def bucketed(spark, tmp_path):
    spark.sql("CREATE DATABASE by_id")
    root = str(tmp_path / "by_id")
    data = hot_rows()
    for name in FACTS:
        frame = spark.createDataFrame(data[name], SCHEMAS[name])
        write_buckets(frame, root, f"by_id.{name}", CFG, 4)
    yield catalog_ledger(spark, "by_id")
    spark.sql("DROP DATABASE by_id CASCADE")


@pytest.mark.parametrize("metric", ["daily_fee_burn", "gas_per_sector_by_path", "sector_lifetime_cost"])
def test_facts_stored_by_id_are_not_exchanged(spark, ledger, bucketed, metric):
    cfg = CFG.with_(stored_by_id=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = DAILY[metric](Marts(bucketed, cfg))
        plan = found._jdf.queryExecution().executedPlan().toString()
        usual = DAILY[metric](Marts(ledger, CFG))
        usual_plan = usual._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(cid" not in plan and "hashpartitioning(message_cid" not in plan
        assert "hashpartitioning(cid" in usual_plan
        columns = found.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, usual.select(columns).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def parsed(spark, tmp_path):
    root, data = str(tmp_path / "variant"), hot_rows()
    texts = ["no json", "[1]", '{"Sectors":null}', '{"Sectors":{"a":1}}', '{"Sectors":[null,[2],"x"]}']
    for i, text in enumerate(texts):
        data["parsed_messages"].append((5300001, f"t{i}", "PreCommitSectorBatch2", text))
    messages = data.pop("parsed_messages")
    store(spark, root, data)
    rows = spark.createDataFrame(messages, SCHEMAS["parsed_messages"])
    write_table(with_variant(rows), root, "parsed_messages", CFG)
    return root


@pytest.mark.parametrize(
    "metric",
    ["ddo_sector_onboarding", "gas_per_sector_by_path", "precommit_sector_batch_size", "sector_lifetime_cost"],
)
def test_stored_variants_are_not_parsed_again(spark, parsed, metric):
    ledger, usual = (load_ledger(spark, parsed, variant=v) for v in (True, False))
    found, wanted = (DAILY[metric](Marts(x, CFG)) for x in (ledger, usual))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "params#" not in plan and "params_variant" in plan
    assert "from_json" in wanted._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(str, found.collect()))
    assert rows == sorted(map(str, wanted.collect())) and rows
    charts = [c for c in CHARTS if c.metric == metric]
    ((_, wide),) = catalog.wide_frames(ledger, CFG, [metric])
    assert points(drawn(wide, charts)) == points(drawn(wanted, charts))


def test_tables_without_an_id_have_no_buckets(spark, tmp_path):
    with pytest.raises(ValueError):
        frame = spark.createDataFrame([(1, 2)], SCHEMAS["chain_powers"])
        write_buckets(frame, str(tmp_path), "powers", CFG, 4)


def test_a_refresh_groups_only_messages_and_gas_of_new_ids(spark, ledger):
    """Below every aggregate by id stands a semi-join with the ids of the new days."""
    day = dt.date(2025, 8, 27)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        new = onboarding(ledger, CFG, day)._jdf.queryExecution().optimizedPlan().toString()
        full = onboarding(ledger, CFG)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert new.count("Join LeftSemi") == 2 and "Join LeftSemi" not in full
    later = [r for r in onboarding(ledger, CFG).collect() if r.date and r.date >= day]
    key = lambda r: str(sorted(r.asDict().items()))
    assert later and sorted(map(key, onboarding(ledger, CFG, day).collect())) == sorted(map(key, later))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_size_of_the_files(spark, ledger, monkeypatch):
    gas, messages = ledger.derived_gas_outputs, ledger.parsed_messages
    wanted = sorted(map(str, m.matched_totals(gas, messages, 1e18, CFG).collect()))
    assert m.partitions_of(gas, messages) is None
    assert m.partitions_of(spark.createDataFrame(gas.rdd, gas.schema)) is None  # of no known size
    monkeypatch.setattr(m, "PARTITION_BYTES", 500)
    few, many = m.partitions_of(gas), m.partitions_of(gas, messages)
    assert 1 < few < many
    found = m.matched_totals(gas, messages, 1e18, CFG)
    # counts, join and totals by as many tasks as the rows need, not merged into few
    exchanges = re.findall(r"Exchange hashpartitioning\(cid#\d+, (\d+)\), (\w+)", plan_of(found))
    assert len(exchanges) == 2 and {kind for _, kind in exchanges} == {"REPARTITION_BY_NUM"}
    assert len({n for n, _ in exchanges}) == 1 and int(exchanges[0][0]) > 1
    assert sorted(map(str, found.collect())) == wanted
    monkeypatch.setattr(m, "MOST_PARTITIONS", 3)
    assert m.partitions_of(gas, messages) == 3


def test_catalogue_sorts_its_facts_once(ledger, monkeypatch):
    wanted = sorted(map(str, catalog.by_id(ledger, CFG).collect()))
    monkeypatch.setattr(m, "PARTITION_BYTES", 500)
    frame = catalog.by_id(ledger, CFG)
    assert len(re.findall(r" Sort \[cid#", plan_of(frame))) == 1
    assert re.search(r"hashpartitioning\(cid#\d+, \d+\), REPARTITION_BY_NUM", plan_of(frame))
    assert sorted(map(str, frame.collect())) == wanted
