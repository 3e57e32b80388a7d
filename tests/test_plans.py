"""What the plans must look like, whatever the data."""

import re

import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
BATCH = [n for n in entry_module.QUERIES if not n.startswith("stream_")]


def plan_of(spark, name):
    df = entry_module.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*)>", plan)]


@pytest.mark.parametrize("name", BATCH)
def test_nothing_leaves_the_engine_and_nothing_is_crossed(spark, name):
    plan = plan_of(spark, name)
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "RDDScan"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", ["gold_metrics", "gold_aml_alerts"])
def test_gold_reads_only_what_it_uses(spark, name):
    plan = plan_of(spark, name)
    (columns,) = read_columns(plan)
    assert columns == {
        "transaction_id",
        "account_id",
        "transaction_type",
        "amount",
        "transaction_timestamp",
        "status",
        "cdc_operation",
        "cdc_timestamp_ms",
        "_feed_offset",
    }
    # One shuffle for the upsert, one for the windows.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in plan


def test_filters_reach_the_scan(spark):
    assert "LessThanOrEqual(cdc_timestamp_ms" in plan_of(spark, "silver_customers_as_of")
    plan = plan_of(spark, "silver_transactions_merge")
    assert "IsNotNull(transaction_id)" in plan


def test_checks_send_one_row_per_task(spark):
    plan = plan_of(spark, "dq_domain")
    assert "Exchange hashpartitioning" not in plan
    assert plan.count("Exchange SinglePartition") == 3


def test_counts_combine_before_the_shuffle(spark):
    for name in ("dq_unique", "dq_fk_orphans", "feed_counts", "bronze_op_counts"):
        assert "partial_count" in plan_of(spark, name)
