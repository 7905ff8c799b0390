"""One id holds a third of both sides: its pairs alone would be ten thousand million rows."""

from pyspark.sql import functions as F

from epochloom.config import LedgerConfig, PATH_COUNT_FIELDS
from epochloom.operators import messages as m
from epochloom.operators.percentiles import day_percentiles

CFG = LedgerConfig(genesis_unix=0, window_start=-1)
N = 300_000
HOT = "if(id % 3 = 0, 'hot', string(id))"


def gas(spark):
    return spark.range(N).select(
        (F.col("id") % 2880).alias("height"),
        F.expr(HOT).alias("cid"),
        F.lit(1.0).alias("base_fee_burn"),
        F.lit(1.0).alias("over_estimation_burn"),
        F.lit(1).cast("long").alias("gas_used"),
    )


def messages(spark):
    return spark.range(N).select(
        (F.col("id") % 2880).alias("height"),
        F.expr(HOT).alias("cid"),
        F.lit("PreCommitSectorBatch2").alias("method"),
        F.lit('{"Sectors":[1,2]}').alias("params"),
    )


def test_hot_id_on_both_sides(spark):
    third = N // 3
    row = m.fee_per_class(gas(spark), messages(spark), 1.0, CFG).first()
    assert row.total == row.onboarding == 2.0 * (third**2 + 2 * third)
    assert row.other == 0.0


def test_hot_id_in_the_costs(spark):
    events = spark.range(N).select(
        (F.col("id") % 2880).alias("height"),
        F.lit("SECTOR_ADDED").alias("event"),
        F.expr(HOT).alias("message_cid"),
    )
    counts = m.sector_counts(messages(spark), events, "message_cid", PATH_COUNT_FIELDS, [], CFG)
    costed = counts.join(m.gas_by_message(gas(spark), CFG, 1.0), "cid", "left")
    costs = m.mean_cost_per_sector(costed, "sector_count", ["date", "method"], "cost")
    assert [r.cost for r in costs.collect()] == [1.0]


def test_hot_day_in_the_percentiles(spark):
    day = F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(99))
    value = (F.col("id") * 7919 % N).cast("double")
    df = spark.range(N).select(day.alias("date"), value.alias("v"))
    found = day_percentiles(df, "v", {"p50": 0.5, "p95": 0.95})
    wanted = df.groupBy("date").agg(F.percentile("v", [0.5, 0.95]).alias("w"))
    both = found.join(wanted, "date")
    assert both.count() == 51
    assert both.where((F.abs(F.col("p50") - F.col("w")[0]) > 1e-6)).count() == 0
    assert both.where((F.abs(F.col("p95") - F.col("w")[1]) > 1e-6)).count() == 0
