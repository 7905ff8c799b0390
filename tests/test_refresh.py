"""A refresh gives the frames of a full run, however its facts arrived."""

import datetime as dt
import glob
from decimal import Decimal

import pytest

from epochloom.config import PATH_COUNT_FIELDS as METHODS
from epochloom.plans import runner
from epochloom.plans.marts import FRAME_SCHEMAS, MARTS, Marts
from epochloom.plans.runner import reached_days, store_marts
from epochloom.streaming.refresh import refresh
from tests.ledgers import CFG, rows, store

LAST = 5300001 + 4 * 2880


def content(df, columns):
    return sorted(map(str, df.select(columns).collect()))


def same_as_full(spark, ledger, refreshed):
    spark.catalog.clearCache()
    planned = Marts(ledger, CFG)
    for name in MARTS:
        columns = sorted(planned[name].columns)
        assert content(refreshed[name], columns) == content(planned[name], columns), name


def split(everything, cuts):
    early = {n: [r for r in d if r[0] < cuts.get(n, LAST)] for n, d in everything.items()}
    late = {n: [r for r in d if r[0] >= cuts.get(n, LAST)] for n, d in everything.items()}
    return early, late


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "facts"), str(tmp_path / "marts")


def test_a_lagging_table(spark, roots):
    """Events four days behind the rest at the first run."""
    root, mart_root = roots
    early, late = split(rows(extra_days=4), {"miner_sector_events": LAST - 4 * 2880})
    store_marts(spark, store(spark, root, early), CFG, mart_root)
    reached = reached_days(spark, mart_root)
    assert reached["onboarding"] == reached["sector_events"] < reached["base_fees"]
    ledger = store(spark, root, late)
    same_as_full(spark, ledger, refresh(spark, ledger, CFG, mart_root))


def test_a_late_row_for_an_old_activation_day(spark, roots):
    root, mart_root = roots
    early, late = split(rows(extra_days=4), {})
    late["miner_sector_infos"].append((5138040, 5138040 + 57600, Decimal(7 * 10**9)))
    store_marts(spark, store(spark, root, early), CFG, mart_root)
    ledger = store(spark, root, late)
    same_as_full(spark, ledger, refresh(spark, ledger, CFG, mart_root))


def files_by_day(root):
    found = {}
    for path in glob.glob(f"{root}/fee_costs/date=*/*.parquet"):
        found.setdefault(path.split("date=")[1][:10], set()).add(path)
    return found


def test_a_late_row_rebuilds_its_day_alone(spark, roots):
    root, mart_root = roots
    early, late = split(rows(extra_days=4), {})
    late["miner_sector_infos"] = [(5138040, 5138040 + 57600, Decimal(7 * 10**9))]
    store_marts(spark, store(spark, root, early), CFG, mart_root)
    before = files_by_day(mart_root)
    ledger = store(spark, root, late)
    marts = refresh(spark, ledger, CFG, mart_root)
    after = files_by_day(mart_root)
    day = str(dt.date(1970, 1, 1) + dt.timedelta((CFG.genesis_unix + 5138040 * 30) // 86400))
    assert set(after) == set(before) and len(before) > 2
    assert [d for d in sorted(before) if before[d] != after[d]] == [day]
    same_as_full(spark, ledger, marts)
    # nothing new: nothing of it is written
    refresh(spark, store(spark, root, {}), CFG, mart_root)
    assert files_by_day(mart_root) == after


def test_figures_are_counted_while_frames_are_written(spark, roots):
    root, mart_root = roots
    data = rows(extra_days=2)
    data["parsed_messages"] += [data["parsed_messages"][-4]] * 2
    data["parsed_messages"].append((LAST, "alone", "PreCommitSectorBatch2", None))
    marts = store_marts(spark, store(spark, root, data), CFG, mart_root)
    seen, sizes = marts.figures["onboarding"], marts.figures["batch_sizes"]
    wanted = [r for r in data["parsed_messages"] if r[0] > CFG.window_start and r[2] in METHODS]
    repeated = [r for r in wanted if wanted.count(r) > 1]
    assert (seen["messages"], seen["repeated"]) == (len(wanted), len(repeated))
    assert (seen["without_gas"], sizes["without_count"]) == (1, 1)
    assert sizes["messages"] == sum(r[2] == "PreCommitSectorBatch2" for r in wanted)
    (later,) = refresh(spark, store(spark, root, {}), CFG, mart_root).figures.keys() - {"batch_sizes"}
    assert later == "onboarding"


def test_a_ledger_without_activations(spark, roots):
    root, mart_root = roots
    early, late = split(rows(extra_days=4), {})
    for part in (early, late):
        part["parsed_messages"] = [
            r for r in part["parsed_messages"] if r[2] != "ProveCommitSectors3"
        ]
    marts = store_marts(spark, store(spark, root, early), CFG, mart_root)
    assert marts["activations"].count() == 0
    ledger = store(spark, root, late)
    same_as_full(spark, ledger, refresh(spark, ledger, CFG, mart_root))


def test_a_rebuild_that_breaks_off(spark, roots, monkeypatch):
    root, mart_root = roots
    early, late = split(rows(extra_days=4), {})
    ledger = store(spark, root, early)
    store_marts(spark, ledger, CFG, mart_root)
    written, whole = [], runner.store_mart

    def breaks(df, root, name, replace_days_only=False):
        if len(written) == 3:
            raise RuntimeError("broken off")
        written.append(name)
        whole(df.limit(1), root, name, replace_days_only)

    monkeypatch.setattr(runner, "store_mart", breaks)
    with pytest.raises(RuntimeError):
        store_marts(spark, ledger, CFG, mart_root)
    monkeypatch.undo()
    assert reached_days(spark, mart_root) == {}
    ledger = store(spark, root, late)
    same_as_full(spark, ledger, refresh(spark, ledger, CFG, mart_root))


def test_a_publication_that_breaks_off(spark, roots, tmp_path, monkeypatch):
    """Readers keep the whole version before, whichever metric the next one stops at."""
    out, names = str(tmp_path / "json"), ["power_added", "renewal_rate", "sector_extensions"]
    early, late = split(rows(extra_days=4), {})
    before = Marts(store(spark, roots[0], early), CFG)
    assert runner.published(spark, out) == (None, [])
    first = runner.publish_metrics(spark, before, out, names)
    schema = "date STRING, expired_count BIGINT, extended_count BIGINT"
    read = lambda: content(runner.read_published(spark, out, "renewal_rate", schema), "*")
    old, written, whole = read(), [], runner.write_records

    def breaks(daily, path):
        if len(written) == 2:
            raise RuntimeError("broken off")
        written.append(path)
        whole(daily, path)

    after = Marts(store(spark, roots[0], late), CFG)
    monkeypatch.setattr(runner, "write_records", breaks)
    with pytest.raises(RuntimeError):
        runner.publish_metrics(spark, after, out, names)
    monkeypatch.undo()
    assert len(written) == 2 and runner.published(spark, out) == (first, names)
    assert read() == old
    second = runner.publish_metrics(spark, after, out, names)
    assert runner.published(spark, out) == (second, names) and len(read()) > len(old)
    with pytest.raises(KeyError):
        runner.read_published(spark, out, "base_fee_percentiles", schema)


def test_only_a_missing_path_is_a_first_run(spark, tmp_path):
    assert reached_days(spark, str(tmp_path / "nowhere")) == {}


def test_declared_frames_have_the_planned_columns(spark, roots):
    planned = Marts(store(spark, roots[0], rows()), CFG)
    for name in MARTS:
        declared = runner.frame_schema(name)
        found = {f.name: f.dataType for f in planned[name].schema}
        assert found == {f.name: f.dataType for f in declared}, name
    assert set(FRAME_SCHEMAS) == {*MARTS, runner.ONBOARDING}

