import datetime as dt

import pytest

from runtide.operators.layers import all_layers_gate, failure_report, layer_label, layer_report, layer_status
from runtide.operators.runs import (
    flatten_runs,
    latest_run_per_job,
    newest_first,
    run_counts,
    runs_lookback,
    runs_recent_topk,
    runs_today_latest,
)
from runtide.operators.status import (
    dependency_rejoin,
    dependency_status,
    effective_state,
    expand_copies,
    failed_runs,
    not_yet_notified,
    notified_today,
    sla_by_layer,
)
from runtide.schema import RUN_COLUMNS, run_schema_ddl
from runtide.sources.dependencies import SLA_BY_LAYER, read_dependencies

DAY = dt.date(2024, 1, 15)


def values(df, *columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


@pytest.fixture()
def status_of(make_deps):
    def make(deps, runs):
        return effective_state(sla_by_layer(dependency_status(make_deps(*deps), runs), SLA_BY_LAYER))

    return make


# Runs


def test_flatten_tolerates_what_a_payload_lacks(spark):
    raw = spark.sql("""
        select 5 as run_id, 0L as start_time, 30000L as run_duration, named_struct('result_state', 'FAILED') as state,
          named_struct('new_cluster', named_struct('cluster_name', '', 'num_workers', 3)) as cluster_spec""")
    flat = flatten_runs(raw)
    assert tuple(flat.columns) == RUN_COLUMNS
    assert flat.dtypes == spark.createDataFrame([], run_schema_ddl()).dtypes
    row = flat.first().asDict()
    kept = {name: value for name, value in row.items() if value is not None}
    assert kept == {
        "run_id": "5", "start_time_in_ms": 0, "run_duration_min": 0.5, "result_state": "FAILED",
        "cluster_name": "CUSTOM", "num_workers": "3",
    }


def test_flatten_of_nothing(spark):
    assert flatten_runs(spark.range(0)).count() == 0


def test_lookback_bounds(make_runs):
    at = dt.datetime(2024, 1, 16, 5)  # midnight Eastern
    runs = make_runs(
        ("1", "j", "n", "2024-01-15 00:00:00", None, None),
        ("2", "j", "n", "2024-01-14 23:59:59", None, None),
        ("3", "j", "n", "2024-01-16 00:00:00", None, None),
        ("4", "j", "n", "2024-01-16 00:00:01", None, None),
        ("5", "j", "n", None, None, None),
    )
    assert values(runs_lookback(runs, at), "run_id") == [("1",), ("3",)]
    assert values(runs_lookback(runs, at, days_back=2), "run_id") == [("1",), ("2",), ("3",)]


def test_recent_topk(make_runs):
    runs = make_runs(*((str(i), "j", "n", f"2024-01-15 0{i % 3}:00:00", None, None) for i in range(9)))
    assert [row.run_id for row in runs_recent_topk(runs, 4).collect()] == ["2", "5", "8", "1"]
    assert runs_recent_topk(runs).count() == 9 == run_counts(runs).first()["run_count"]


def test_latest_run_per_job(make_runs):
    runs = make_runs(
        ("1", "a", "n", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("2", "a", "n", "2024-01-15 03:00:00", None, None, "In run"),  # a rerun under way ranks behind
        ("10", "b", "n", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("9", "b", "n", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),  # tie: lower run id
        ("7", "c", "n", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED", "", 1),
        ("7", "c", "n", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS", "", 0),  # tie: lower attempt
        ("20", None, "n", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("21", None, "n", "2024-01-15 01:00:00", "2024-01-15 03:00:00", "SUCCESS"),
    )
    assert values(latest_run_per_job(runs), "run_id", "result_state") == [
        ("1", "SUCCESS"), ("21", "SUCCESS"), ("7", "SUCCESS"), ("9", "FAILED"),
    ]


def test_rank_comes_before_the_day(make_runs):
    runs = make_runs(
        ("1", "a", "n", "2024-01-14 20:00:00", "2024-01-15 05:00:00", "SUCCESS"),
        ("2", "a", "n", "2024-01-15 03:00:00", None, None, "In run"),
        ("3", "b", "m", "2024-01-15 23:59:59", "2024-01-16 02:00:00", "SUCCESS"),
    )
    today = runs_today_latest(runs, DAY)
    assert values(today, "run_id", "BronzeWorkFlowName") == [("3", "m")]
    assert values(runs_today_latest(runs, dt.date(2024, 1, 16), "UTC"), "run_id") == [("3",)]


def test_newest_first(spark):
    runs = flatten_runs(spark.sql("select id as run_id, id * 1000 as start_time from range(1, 20)"))
    assert [row.run_id for row in newest_first(runs).collect()] == [str(i) for i in range(19, 0, -1)]


# Joins


def outer_join_by_hand(deps, runs):
    found = []
    for d in deps.collect():
        names = [r for r in runs.collect() if r.run_name is not None and r.run_name == d.DependsOn]
        found += [(d.layer, d.DependsOn, r and r.run_id) for r in names or [None]]
    return sorted(found, key=repr)


def test_dependency_status_is_an_outer_join(make_runs, make_deps):
    runs = make_runs(
        ("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("2", "b", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
        ("3", "c", "y", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("4", "d", None, "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
    )
    deps = make_deps(("Bronze", "x"), ("Gold", "x"), ("Gold", "y"), ("Gold", "never"), ("Gold", None), ("Gold", "y"))
    assert values(dependency_status(deps, runs), "layer", "DependsOn", "run_id") == outer_join_by_hand(deps, runs)


def test_rejoin_counts_copies(make_runs, make_deps):
    rows = [(str(i), f"j{i}", name, "2024-01-15 01:00:00", None, None) for i, name in enumerate("xxxy")]
    runs = make_runs(*rows).selectExpr("*", "run_name as BronzeWorkFlowName")
    status = dependency_status(make_deps(("Bronze", "x"), ("Gold", "y"), ("Gold", "z")), runs)
    counted = dependency_rejoin(status, runs)
    assert values(counted, "DependsOn", "run_id", "copies") == [
        ("x", "0", 3), ("x", "1", 3), ("x", "2", 3), ("y", "3", 1), ("z", None, 1),
    ]
    other = runs.selectExpr("BronzeWorkFlowName as other")
    by_hand = status.join(other, status["DependsOn"] == other["other"], "left_outer").select(*status.columns)
    assert values(expand_copies(counted), "DependsOn", "run_id") == values(by_hand, "DependsOn", "run_id")
    assert expand_copies(counted).columns == status.columns


def test_sla_from_mapping_and_table(spark, make_deps):
    deps = make_deps(("Bronze", "x"), ("Gold", "y"), ("Other", "z"), (None, "w"))
    wanted = [("Bronze", "4:30 AM EST"), ("Gold", "5:30 AM EST"), ("Other", None), (None, None)]
    table = spark.createDataFrame(list(SLA_BY_LAYER.items()), "layer string, sla_text string")
    for sla in (SLA_BY_LAYER, table):
        assert values(sla_by_layer(deps, sla), "layer", "SLA") == sorted(wanted, key=repr)


def test_effective_state(make_runs):
    runs = make_runs(
        ("1", "a", "x", "2024-01-15 01:00:00", None, None, "In run"),
        ("2", "b", None, "2024-01-15 01:00:00", None, None, "In run"),
        ("3", "c", "x", "2024-01-15 01:00:00", None, "FAILED", None),
    )
    assert values(effective_state(runs), "run_id", "result_state", "EventType") == [
        ("1", "SUCCESS", "SUCCESS"), ("2", None, None), ("3", "FAILED", "FAILED"),
    ]


# What was notified


@pytest.fixture()
def mixed(make_runs, status_of):
    runs = make_runs(
        ("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
        ("2", "b", "y", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
        ("3", "c", "z", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("4", "d", "k", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "CANCELED"),
    )
    return status_of([("Bronze", "x"), ("Bronze", "y"), ("Gold", "z"), ("Gold", "k"), ("Gold", "never")], runs)


def test_notified_today(make_log):
    log = make_log(
        ("a", "FAILED", "2024-01-15 23:59:59"), ("a", "FAILED", "2024-01-15 00:00:00"),
        ("b", "FAILED", "2024-01-14 23:59:59"), ("c", "SUCCESS", "2024-01-16 00:00:00"),
    )
    assert values(notified_today(log, DAY), "job_id", "EventType") == [("a", "FAILED")]
    assert notified_today(log.where("false"), DAY).count() == 0


def test_not_yet_notified_keeps_runs_that_never_ran(mixed, make_log):
    notified = notified_today(
        make_log(("a", "FAILED", "2024-01-15 10:00:00"), ("b", "SUCCESS", "2024-01-15 10:00:00")), DAY
    )
    assert values(not_yet_notified(mixed, notified), "DependsOn") == [("k",), ("never",), ("y",), ("z",)]


def test_failure_dedupe_by_job_or_by_event(mixed, make_log):
    notified = notified_today(
        make_log(("a", "FAILED", "2024-01-15 10:00:00"), ("b", "SUCCESS", "2024-01-15 10:00:00")), DAY
    )
    assert values(failed_runs(mixed, notified), "job_id") == []
    assert values(failed_runs(mixed, notified, "job_event"), "job_id") == [("b",)]
    assert values(failed_runs(mixed, notified.where("false")), "job_id") == [("a",), ("b",)]
    with pytest.raises(ValueError):
        failed_runs(mixed, notified, "other")


def test_failure_report_is_distinct(make_runs, status_of, make_log):
    runs = make_runs(("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED", "broke"))
    status = status_of([("Gold", "x"), ("Gold", "x"), ("Bronze", "x"), ("Other", "x")], runs)
    report = failure_report(failed_runs(status, notified_today(make_log(), DAY)))
    assert report.columns == ["WorkflowName", "RunId", "Layer", "SLA", "Status", "StatusMessage"]
    assert [tuple(row) for row in report.collect()] == [
        ("x", "1", "Other", None, "FAILED", "broke"),
        ("x", "1", "Bronze", "4:30 AM EST", "FAILED", "broke"),
        ("x", "1", "Gold", "5:30 AM EST", "FAILED", "broke"),
    ]


# Layers


def test_layer_status(mixed):
    rows = {row.Layer: row for row in layer_status(mixed).collect()}
    assert {k: (r.DependsOnWorkflowCount, r.RunWorkflowCount, r.SuccessCount, r.FailCount) for k, r in rows.items()} == {
        "Bronze": (2, 2, 0, 2), "Gold": (3, 2, 1, 1),
    }
    assert {row.Status for row in rows.values()} == {"Failed"}


def test_jobs_that_share_a_name_count_once(make_runs, status_of):
    runs = make_runs(
        ("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("2", "b", "x", "2024-01-15 01:00:00", "2024-01-15 03:00:00", "FAILED"),
    )
    row = layer_status(status_of([("Gold", "x")], runs), second_shift=False).first()
    counts = row.DependsOnWorkflowCount, row.RunWorkflowCount, row.SuccessCount, row.FailCount
    assert (*counts, row.Status, row.LatestRunTime) == (1, 1, 1, 1, "Completed", dt.datetime(2024, 1, 15, 3))


@pytest.mark.parametrize(
    "end, second_shift, shown, met",
    [
        ("2024-01-15 06:00:00", False, "6:00 AM EST", "N"),
        ("2024-01-15 06:00:00", True, "1:00 AM EST", "Y"),
        ("2024-01-15 02:14:00", False, "2:14 AM EST", "Y"),
        ("2024-01-15 02:14:00", True, "9:14 PM EST", "N"),
        ("2024-07-15 06:00:00", True, "2:00 AM EST", "Y"),
        ("2024-01-16 00:10:00", False, "12:10 AM EST", "Y"),
    ],
)
def test_second_shift(make_runs, status_of, end, second_shift, shown, met):
    status = status_of([("Bronze", "x")], make_runs(("1", "a", "x", "2024-01-15 01:00:00", end, "SUCCESS")))
    row = layer_status(status, second_shift=second_shift).first()
    assert (row.LatestRunTime_only, row.SLA_MET) == (shown, met)


def test_excluded_names_do_not_set_the_finish(make_runs, status_of):
    late = "DE-Bronze-Audit_Smartsheets"
    runs = make_runs(
        ("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
        ("2", "b", late, "2024-01-15 01:00:00", "2024-01-15 09:00:00", "SUCCESS"),
    )
    status = status_of([("Bronze", "x"), ("Bronze", late)], runs)
    assert layer_status(status, second_shift=False).first().LatestRunTime == dt.datetime(2024, 1, 15, 2)
    assert layer_status(status, (), second_shift=False).first().LatestRunTime == dt.datetime(2024, 1, 15, 9)
    assert layer_status(status, ("x", late), second_shift=False).first().LatestRunTime_only is None


def test_layer_without_sla_or_runs(make_runs, status_of):
    status = status_of([("Platinum", "never"), (None, "gone")], make_runs())
    assert values(layer_status(status), "Layer", "SLA", "RunWorkflowCount", "LatestRunTime_only", "Status", "SLA_MET") == [
        ("Platinum", None, 0, None, "Failed", "N"), (None, None, 0, None, "Failed", "N"),
    ]


def test_layer_report(mixed):
    report = layer_report(layer_status(mixed))
    assert report.columns == ["Data Layer", "SLA", "Completion Time", "Status", "SLA Met(Y/N)", "Comment"]
    assert [row["Data Layer"] for row in report.collect()] == ["Bronze", "Gold"]


def test_gate(make_runs, status_of):
    done = make_runs(
        ("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("2", "b", "y", "2024-01-15 01:00:00", None, None, "In run"),
    )

    def gate(deps):
        return tuple(all_layers_gate(layer_status(status_of(deps, done))).first())

    assert gate([("Bronze", "x"), ("Gold", "y")]) == (2, 2, True)
    assert gate([("Bronze", "x"), ("Gold", "never")]) == (2, 1, False)
    assert gate([]) == (0, 0, False)


def test_layer_label(make_deps):
    assert layer_label(make_deps(("b", "x"), ("A", "x"), ("b", "y"), (None, "z"))).first()[0] == "A and b"


def test_shipped_dependencies(spark):
    deps = read_dependencies(spark)
    assert deps.columns == ["SubjectArea", "WorkflowName", "DependsOn", "layer"]
    assert deps.groupBy("layer").count().orderBy("layer").collect() == [("Bronze", 3), ("Gold", 3)]
