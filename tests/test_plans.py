"""Physical plans of every query."""

import pytest

from workload.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for forbidden in (
        "CartesianProduct",
        "BroadcastNestedLoopJoin",
        "Python",
        "Pandas",
        "CollectLimit",
    ):
        assert forbidden not in plan


@pytest.mark.parametrize(
    "name",
    [
        "ddo_sector_onboarding",
        "gas_per_sector_by_path",
        "precommit_sector_batch_size",
        "sector_lifetime_cost",
    ],
)
def test_parameters_are_parsed_once(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scans = sum("orders" in line and "FileScan" in line for line in plan.split("\n"))
    assert "json_array_length" not in plan
    assert 1 <= plan.count("from_json(") <= scans


def test_planning_runs_no_job(spark):
    context = spark.sparkContext
    context.setJobGroup("planning", "planning")
    for query in QUERIES.values():
        query(spark, SF_DIR)
    assert list(context.statusTracker().getJobIdsForGroup("planning")) == []
    context.setLocalProperty("spark.jobGroup.id", None)


def test_scans_read_only_what_is_used(spark):
    plan = QUERIES["participating_miner_count"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_burn_does_not_read_parameters(spark):
    plan = QUERIES["daily_fee_burn"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "o_custkey" not in plan.split("== Physical Plan ==")[1]


def test_costs_cut_the_gas_scan_at_the_window(spark):
    plan = QUERIES["gas_per_sector_by_path"](spark, SF_DIR)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1].split("\n")
    scans = [line for line in physical if "lineitem" in line]
    assert scans and all("l_shipdate" in line and "l_quantity" not in line for line in scans)
