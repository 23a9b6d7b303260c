"""Plan-shape guards: the scale properties the catalogue relies on."""
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def final_plan(spark, name):
    df = entry.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["dedup_natural_key", "latest_per_key"])
def test_partial_window_limit_before_the_shuffle(spark, name):
    plan = final_plan(spark, name)
    assert plan.count("WindowGroupLimit") >= 2          # partial (map side) + final


@pytest.mark.parametrize("name", ["table_reconcile", "reconcile_counts", "orphan_keys"])
def test_counts_without_joins(spark, name):
    plan = final_plan(spark, name)
    assert "Join" not in plan


def test_orders_fact_shuffled_once_for_all_levels(spark):
    plan = final_plan(spark, "fato_resultados_shape")
    pre_agg = re.findall(r"^[\s:|+-]*Exchange hashpartitioning\(o_custkey", plan, re.M)
    assert len(pre_agg) == 1                              # every other use is a ReusedExchange
    assert "ReusedExchange" in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = final_plan(spark, "orphan_keys")
    assert "PushedFilters: [In(o_orderstatus" in plan or "PushedFilters: [IsNotNull(o_orderstatus), In(o_orderstatus" in plan
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert all(len(cols.split(",")) <= 2 for cols in scans)   # key (+ status) only, not whole rows


def test_no_python_udfs_anywhere(spark):
    for name in ["event_parse", "label_normalise", "measure_cast", "quality_report"]:
        plan = final_plan(spark, name)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("only_accepted", [False, True])
def test_a_message_is_parsed_once(spark, only_accepted):
    from strata.plans.catalog.envelope import message
    from strata.streaming.views import accepted, parse_measurements
    events = spark.read.parquet(f"{SF}/events.parquet")
    messages = events.select(message().alias("data"), events.ts.alias("publish_time"))
    typed = accepted(messages) if only_accepted else parse_measurements(messages)
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and "get_json_object" not in plan


@pytest.mark.parametrize("name", ["unpivot_measures", "label_join", "fato_resultados_shape"])
def test_facts_are_joined_and_summed_once(spark, name):
    """Without automatic broadcasts: one join to customer, one aggregate for all levels and years."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"FileScan parquet \[c_custkey", plan)) == 1
    assert len(re.findall(r"\bExpand \[", plan)) <= 1
    assert "Union" not in plan
