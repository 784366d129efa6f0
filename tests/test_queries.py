"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
from pathproof.testbed.oracle import ORACLES as SQLS
from pathproof.testbed.queries import QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQLS)
    assert set(QUERIES) <= set(entry.queries()) and set(SQLS) <= set(entry.oracle_sql())


def test_the_oracle_takes_nothing_from_the_plans():
    import inspect

    from pathproof.testbed import oracle

    names = re.findall(r"^from (\S+) import", inspect.getsource(oracle), re.M)
    assert names == ["__future__", "pathproof.testbed.frames"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    equal, mine, theirs, diff = compare(spark, con, SF, QUERIES[name], SQLS[name])
    assert equal, (mine, theirs, diff)


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["interval_before", "asof_accept_point", "rule_115", "rule_006", "rule_008", "rule_004", "behavior_report",
     "sample_hits", "sample_controls", "check_s6", "device_attribution", "order_facts_union"],
)
def test_no_pair_joins_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "collect_list", "collect_set"):
        assert word not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "rule_115")
    scans = re.findall(r"FileScan parquet (\[.*?\]).*?PushedFilters: (\[.*?\])", plan)
    assert scans
    for _, pushed in scans:
        assert "event_type" in pushed
    assert all("value" not in columns for columns, _ in scans)


def test_a_run_rule_shuffles_pings_by_driver_and_slot_only(spark):
    plan = plan_of(spark, "rule_215")
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\), (\w+)", plan)
    names = [re.sub(r"#\d+L?", "", k) for k, _ in keys]
    assert "driver_id, _slot" in names
    assert not [n for n in names if n in ("driver_id", "order_id")]


def test_a_rule_repeats_its_inputs_few_times(spark):
    assert plan_of(spark, "rule_115").count("FileScan") <= 24


@pytest.mark.parametrize("name", ["dense_all_rules", "all_rules", "rules_on_repeated_rows", "rules_per_query"])
def test_plans_of_many_rules_are_cut(spark, name):
    """In one plan the steps repeat each other: dense_all_rules had 68 scans, too many for a driver of 1.5 GB."""
    assert plan_of(spark, name).count("FileScan") <= 4


def test_entry(spark):
    assert entry.entry(spark).count() == 28
