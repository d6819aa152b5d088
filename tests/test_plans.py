"""Shapes of physical plans that large inputs depend on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.views import AS_OF, DAY, dependencies, flat_runs, raw_runs, run_log, today_runs
from runtide.operators.layers import layer_status
from runtide.operators.runlog import upsert_runs
from runtide.operators.runs import flatten_runs, latest_run_per_job
from runtide.operators.status import (
    dependency_status,
    effective_state,
    failed_runs,
    not_yet_notified,
    notified_today,
    sla_by_layer,
)
from runtide.sources.dependencies import SLA_BY_LAYER
from tests.conftest import FLAT_DDL

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def test_ranking_sends_one_row_per_job_and_task(spark):
    plan = physical(latest_run_per_job(flat_runs(spark, SF)).select("run_id"))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_flattening_prunes_columns_to_the_scan(spark):
    plan = physical(flatten_runs(raw_runs(spark, SF)).select("job_id", "result_state"))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_upsert_shuffles_each_side_once(spark, no_broadcast):
    plan = physical(upsert_runs(run_log(spark, SF), flat_runs(spark, SF), AS_OF))
    assert plan.count("Exchange hashpartitioning") == 2


def test_outer_join_leaves_no_side_that_cannot_be_split(spark, no_broadcast):
    plan = physical(dependency_status(dependencies(spark, SF), today_runs(spark, SF)))
    assert "LeftOuter" not in plan and "Inner" in plan and "LeftAnti" in plan


def test_dedupe_of_runs_that_never_ran_needs_no_nested_loop(spark, make_log, no_broadcast):
    status = effective_state(dependency_status(dependencies(spark, SF), today_runs(spark, SF)))
    fresh = not_yet_notified(status, notified_today(make_log(("a", "FAILED", "2024-01-15 10:00:00")), DAY))
    assert "NestedLoop" not in physical(fresh)
    assert fresh.where("DependsOn = 'WF-never'").count() == 1


def test_failures_need_the_matches_only(spark, make_log):
    status = dependency_status(sla_by_layer(dependencies(spark, SF), SLA_BY_LAYER), today_runs(spark, SF))
    failed = failed_runs(effective_state(status), notified_today(make_log(), DAY))
    # The only anti join left is that with the notified jobs.
    assert optimized(failed).count("Join LeftAnti") == 1


def test_layer_counts_are_hash_aggregates_without_expand(spark):
    status = sla_by_layer(dependency_status(dependencies(spark, SF), today_runs(spark, SF)), SLA_BY_LAYER)
    plan = physical(layer_status(status))
    assert "Expand" not in plan and "SortAggregate" not in plan


def test_one_name_and_one_job_with_most_rows(spark, make_deps):
    """Against brute force: a third of the runs under one job, a third of the jobs under one name."""
    at = dt.datetime(2024, 1, 15, 6)
    rows = []
    for i in range(600):
        job = "hot" if i % 3 == 0 else f"j{i % 150}"
        name = "n-hot" if job == "hot" or int(job[1:]) % 3 == 1 else f"n-{job}"
        start = 1705300000000 + i * 1000
        state = ("SUCCESS", "FAILED", None)[i % 7 % 3]
        end = 0 if state is None else start + i % 11 * 60000
        rows.append((str(i), job, name, 0, start, end, at, at, 1.0, "PERIODIC", state, "" if state else "In run"))
    runs = spark.createDataFrame(rows, FLAT_DDL)
    best = {}
    for row in rows:
        key = (row[5] == 0, -row[5], int(row[0]))
        if row[1] not in best or key < best[row[1]][0]:
            best[row[1]] = (key, row)
    latest = latest_run_per_job(runs)
    assert sorted(r.run_id for r in latest.collect()) == sorted(row[0] for _, row in best.values())
    deps = make_deps(("Gold", "n-hot"), ("Gold", "n-hot"), ("Bronze", "n-j2"), ("Bronze", "n-none"))
    status = dependency_status(deps, latest)
    wanted = sorted(
        repr((layer, name, run))
        for layer, name in [("Gold", "n-hot"), ("Gold", "n-hot"), ("Bronze", "n-j2"), ("Bronze", "n-none")]
        for run in [row[0] for _, row in best.values() if row[2] == name] or [None]
    )
    assert sorted(repr((r.layer, r.DependsOn, r.run_id)) for r in status.collect()) == wanted
    counts = layer_status(sla_by_layer(effective_state(status), SLA_BY_LAYER)).select(
        "Layer", "DependsOnWorkflowCount", "RunWorkflowCount"
    )
    assert sorted(map(tuple, counts.collect())) == [("Bronze", 2, 1), ("Gold", 1, 1)]


def test_look_back_on_a_partitioned_log(spark, folder, make_log):
    log = make_log(("a", "FAILED", "2024-01-15 10:00:00"), ("b", "FAILED", "2024-01-14 10:00:00"))
    log.withColumn("InsertedDate", F.to_date("InsertedOn")).write.partitionBy("InsertedDate").parquet(f"{folder}/log")
    today = notified_today(spark.read.parquet(f"{folder}/log"), DAY)
    assert [tuple(row) for row in today.collect()] == [("a", "FAILED")]
    assert "PartitionFilters: [isnotnull(InsertedDate" in physical(today)
