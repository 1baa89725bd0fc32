"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from checks.catalog import all_checks
from checks.registry import open_tables
from contactloom.operators.pick import first_per_key, newest, oldest
from contactloom.operators.ranking import global_rank
from contactloom.plans import activity
from contactloom.plans.email_engagement import mail_activity
from contactloom.plans.interactions import digital_interactions

LIGHT = ["event_mail_funnel", "first_per_key", "activity_sequence", "repeat_flags", "interval_join", "sentinel_spread_join", "anti_join_null_guard",
         "bounce_summary", "trailing_units", "earliest_cause_and_clamp", "suppression_waterfall", "affiliation", "patient_party_base",
         "professional_party_base", "non_promotional_metrics", "target_list", "clip_order_spans"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_python_and_no_unkeyed_joins(spark, name):
    plan = plan_of(all_checks()[name].query(spark, SF))
    for node in ("CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "SinglePartition"):
        assert node not in plan, node
    # only null-aware or unkeyed joins become nested loops
    assert "BroadcastNestedLoopJoin" not in plan


def test_first_per_key_cuts_rows_before_the_shuffle(spark):
    orders = open_tables(spark, SF)["orders"]
    plan = plan_of(first_per_key(orders, ["o_custkey"], [newest("o_totalprice"), oldest("o_orderkey")]))
    exchange = plan.index("Exchange hashpartitioning")
    assert re.search(r"WindowGroupLimit .*Partial", plan[exchange:])


def test_filter_and_columns_reach_the_scan(spark):
    df = all_checks()["scan_pushdown"].query(spark, SF)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: (.*)", plan)[1]
    assert "EqualTo(l_returnflag,R)" in pushed and "GreaterThan(l_quantity,40.0)" in pushed
    assert set(re.findall(r"(l_\w+):", re.search(r"ReadSchema: (.*)", plan)[1])) == {
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"}


def test_global_rank_sorts_no_row_in_a_single_partition(spark):
    orders = open_tables(spark, SF)["orders"].select("o_orderkey", "o_totalprice")
    plan = plan_of(global_rank(orders, ["o_totalprice", "o_orderkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], "r", 4))
    singles = [line for line in plan.splitlines() if "SinglePartition" in line]
    below = plan[plan.index("SinglePartition"):].splitlines()[1]
    assert len(singles) == 1 and "HashAggregate(keys=[_part" in below  # per-partition counts only


def test_aggregates_combine_before_the_shuffle(spark):
    plan = plan_of(all_checks()["trailing_units"].query(spark, SF))
    assert "partial_sum" in plan


def test_bounded_readers_prune_months_of_the_activity(spark):
    product = activity.activity_product(open_tables(spark, SF))
    plan = plan_of(activity.since(product, "2019-01-01").select("mdm_id"))
    assert "activity_month" in re.search(r"PartitionFilters: \[([^\]]*)", plan)[1]


def test_readers_on_demand_write_nothing(spark, monkeypatch):
    written = []
    monkeypatch.setattr(activity, "settle", lambda df, label, *rest: written.append(label) or df)
    tables = open_tables(spark, SF)
    activity.net_bounces(activity.newest_activity(tables))
    mail_activity(tables)
    digital_interactions(tables)
    assert not written


def test_the_activity_moves_wide_rows_once(spark):
    """Rows of the fact are shuffled as they are, on their key; nothing made of them is shuffled again, and the numbers share one set of ranges."""
    plan = plan_of(activity.activity_by_month(open_tables(spark, SF)))
    assert len(re.findall(r"Exchange rangepartitioning", plan)) == 1
    assert "Exchange hashpartitioning(activity_month" not in plan


def test_bounce_flags_write_nothing_wide_and_equal_those_of_the_stored_activity(spark, monkeypatch):
    """On facts some of which share an integration key, under another customer or time, or come twice; some keys are empty."""
    tables = open_tables(spark, SF)
    facts = tables["marketing_fact"].filter("CAST(substr(integration_key, 2) AS BIGINT) % 3 = 0")
    n = F.substring("integration_key", 2, 12).cast("bigint")
    other = facts.filter(n % 5 == 0).withColumns({"mk_account_vnt_id": F.lit("-1"), "activity_time": F.expr("activity_time + INTERVAL 1 DAY")})
    keyless = facts.filter(n % 7 == 0).withColumn("integration_key", F.lit(None).cast("string"))
    folder = activity.settle(facts.union(facts.filter(n % 11 == 0)).union(other).union(keyless), "test-facts")
    tables = tables.with_results(marketing_fact=folder)
    expected = activity.activity_with_bounce(activity.activity_product(tables)).drop("activity_month")
    written, real = [], activity.settle
    monkeypatch.setattr(activity, "settle", lambda df, label, *rest: written.append((label, len(df.columns))) or real(df, label, *rest))
    got = activity.bounce_activity(tables)
    assert written == [("activity-side", 7)]
    assert got.columns == expected.columns
    # of rows that tie in all but what was looked up, either may get a number
    known = [c for c in got.columns if c not in ("activity_seq_number", "bounce_activity_seq_number")]
    assert got.select(*known).exceptAll(expected.select(*known)).isEmpty() and expected.select(*known).exceptAll(got.select(*known)).isEmpty()
    assert got.count() > facts.count() and got.filter("bounce_flag = 1").count() > 0
