import datetime as dt

import pytest
from pyspark.sql import functions as F

from epochloom.config import LedgerConfig, PATH_COUNT_FIELDS
from epochloom.functions import amounts, classes, params, time

CFG = LedgerConfig()


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Auckland", "America/Los_Angeles"])
def test_day_does_not_depend_on_the_session_zone(spark, zone):
    heights = [(4_000_000,), (4_878_839,), (4_878_840,), (5_138_040,), (5_300_000,)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = values(spark, heights, "h long", time.epoch_to_day(F.col("h"), CFG))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    expected = [(2024, 6, 13), (2025, 4, 14), (2025, 4, 14), (2025, 7, 13), (2025, 9, 8)]
    assert [d for (d,) in days] == [dt.date(*e) for e in expected]


def test_first_epoch_of_a_day(spark):
    day = (dt.date(2025, 4, 14) - dt.date(1970, 1, 1)).days
    first = CFG.first_epoch_of(day)
    rows = values(spark, [(first - 1,), (first,)], "h long", time.epoch_to_day(F.col("h"), CFG))
    assert [d for (d,) in rows] == [dt.date(2025, 4, 13), dt.date(2025, 4, 14)]


def test_phases_are_half_open(spark):
    heights = [(4_878_839,), (4_878_840,), (5_138_039,), (5_138_040,)]
    phases = values(spark, heights, "h long", time.phase_of(F.col("h"), CFG))
    assert [p for (p,) in phases] == ["pre", "during", "during", "post"]


def test_settings_agree_with_each_other():
    assert CFG.grace_end_epoch == 5_138_040
    assert CFG.daily_gas_capacity == 28.8e12


def test_array_length(spark):
    texts = [
        '{"Sectors":[1,2,3]}',
        '{"Sectors":[]}',
        '{"Sectors":null}',
        '{"Sectors":{"a":1}}',
        "{}",
        "{bad",
        None,
    ]
    found = values(
        spark, [(t,) for t in texts], "p string", params.array_length(F.col("p"), "Sectors")
    )
    assert [n for (n,) in found] == [3, 0, None, None, None, None, None]


def test_param_count_takes_the_first_array_present(spark):
    rows = [
        ("PreCommitSectorBatch2", '{"Sectors":[1,2],"SectorNumbers":[1]}'),
        ("ProveCommitSectors3", '{"SectorNumbers":[1],"SectorActivations":[{},{},{}]}'),
        ("ProveCommitSectors3", '{"SectorNumbers":[1]}'),
        ("ProveReplicaUpdates3", '{"SectorUpdates":[],"Sectors":[1]}'),
        ("ProveReplicaUpdates3", '{"SectorUpdates":null,"Sectors":[1]}'),
        ("ProveReplicaUpdates3", '{"SectorNumbers":[1,2]}'),
        ("ProveCommitAggregate", '{"SectorNumbers":[1,2,3,4],"AggregateSize":9}'),
        ("Other", None),
        ("PreCommitSectorBatch2", '{"Sectors":{"a":1},"SectorNumbers":[1]}'),
        ("PreCommitSectorBatch2", '{"Sectors":"x"}'),
        ("PreCommitSectorBatch2", "[1,2]"),
        ("PreCommitSectorBatch2", "not json"),
        ("PreCommitSectorBatch2", '{"Sectors":[null,1,"a",[2],{"b":3}]}'),
    ]
    arrays = params.parsed_arrays(F.col("p"), params.array_names(PATH_COUNT_FIELDS))
    count = params.param_count(F.col("m"), arrays, PATH_COUNT_FIELDS)
    found = values(spark, rows, "m string, p string", count)
    assert [n for (n,) in found] == [2, 3, None, 0, 1, 2, 4, 1, None, None, None, None, 5]


def test_market_calls(spark):
    cases = [
        ('{"Pieces":[{"Notify":[{"Address":"f05"}]}]}', True, True),
        ('{"Pieces":[{"Notify":[{"Address" : "f05"}]}]}', True, True),
        ('{"Pieces":[{"Notify":[{"Address":"f099"}]}]}', False, False),
        ('{"Pieces":[{"Notify":null},{"Notify":[{"Address":"f05"}]}]}', True, True),
        ('{"Pieces":[{"Address":"f05"}]}', True, False),
        ('{"Pieces":null}', False, False),
        ('{"Address":"f05"}', False, False),
        ('{"Pieces":[{"Notify":null}]}', False, False),
        (None, False, False),
    ]
    found = values(
        spark,
        [(text,) for text, _, _ in cases],
        "a string",
        params.notifies_market(F.col("a")),
        params.notifies_market_strict(F.col("a")),
    )
    assert found == [(any_, strict) for _, any_, strict in cases]


def test_classes(spark):
    methods = ["TerminateSectors", "PreCommitSector", "Send", None]
    found = values(spark, [(m,) for m in methods], "m string", classes.method_class(F.col("m")))
    assert [c for (c,) in found] == ["dispute", "onboarding", "other", None]
    sizes = values(
        spark, [(n,) for n in (1, 3, 4, 9, 10)], "n long", classes.size_class(F.col("n"), CFG)
    )
    assert [c for (c,) in sizes] == ["small_sp", "small_sp", "medium_sp", "medium_sp", "large_sp"]


def test_ratios_and_finite_values(spark):
    found = values(
        spark,
        [(1, 4), (1, 0), (None, 4)],
        "a long, b long",
        amounts.ratio(F.col("a"), F.col("b")),
        amounts.percent(F.col("a"), F.col("b"), 2),
    )
    assert found == [(0.25, 25.0), (None, None), (None, None)]
    texts = ["1.5", "", None, "NaN", "Infinity", "-Infinity", "x", "-2", "1d", "2f", ".5e1"]
    finite = values(spark, [(t,) for t in texts], "t string", amounts.finite(F.col("t")))
    assert [x for (x,) in finite] == [1.5, *[None] * 6, -2.0, None, None, 5.0]


def test_lifetime_cost(spark):
    cost = amounts.lifetime_cost(F.col("f"), F.col("s"), F.col("e"), CFG)
    assert values(spark, [(2_000_000_000, 0, 2880 * 10)], "f long, s long, e long", cost) == [
        (20.0,)
    ]
