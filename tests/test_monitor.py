import datetime as dt
import uuid

import pytest

from runtide.plans.lineage import settle, shared_folder
from runtide.plans.monitor import monitor, run_cycle
from runtide.sources.dependencies import SLA_BY_LAYER
from runtide.sources.tables import TableNames
from tests.conftest import eastern_ms

AS_OF = dt.datetime(2024, 1, 16, 4, 59, 59)
TO = {"failure_recipients": "a@x.com; b@x.com", "success_recipients": "c@x.com"}


def values(df, *columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


@pytest.fixture()
def day_with_failure(make_runs, make_deps):
    runs = make_runs(
        ("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED", "broke"),
        ("2", "b", "y", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
        ("3", "c", "z", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
    )
    return runs, make_deps(("Bronze", "x"), ("Bronze", "y"), ("Gold", "z"), ("Gold", "z"))


def test_day_with_a_failure(day_with_failure, make_log):
    found = monitor(*day_with_failure, SLA_BY_LAYER, make_log(), AS_OF, **TO)
    assert values(found["layers"], "Layer", "Status") == [("Bronze", "Failed"), ("Gold", "Completed")]
    assert values(found["outbox"], "kind", "subject", "recipients", "part", "parts") == [
        ("failure", "Prod - EDW - Data refresh - 15th January 2024", ["a@x.com", "b@x.com"], 0, 1)
    ]
    body = found["outbox"].first().body
    assert body.startswith("Hello All,<br><br>Data refresh for Bronze layer tables has failed. Below")
    assert values(found["notification_rows"], "job_id", "EventType", "layer", "NotificationEmailContent") == [
        ("a", "FAILED", "Bronze", body)
    ]


def test_good_day(day_with_failure, make_log):
    runs, deps = day_with_failure
    found = monitor(runs, deps.where("DependsOn <> 'x'"), SLA_BY_LAYER, make_log(), AS_OF, **TO)
    assert tuple(found["gate"].first()) == (2, 2, True)
    assert values(found["outbox"], "kind", "recipients") == [("success", ["c@x.com"])]
    body = found["outbox"].first().body
    assert body.startswith("Hello All,<br><br>Data refresh for Bronze and Gold layer tables has completed successfully.")
    assert values(found["notification_rows"], "job_id", "EventType", "layer", "NotificationEmailContent") == [
        ("b", "SUCCESS", "Bronze", body), ("c", "SUCCESS", "Gold", body),
    ]


def test_subject_prefix_and_escaped_cells(make_runs, make_deps, make_log):
    runs = make_runs(("1", "a", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED", "<b>broke"))
    found = monitor(
        runs, make_deps(("Bronze", "x")), SLA_BY_LAYER, make_log(), AS_OF, subject_prefix="Test - ", escape=True, **TO
    )
    message = found["outbox"].first()
    assert message.subject == "Test - 15th January 2024"
    assert "&lt;b&gt;broke" in message.body and "<b>broke" not in message.body


def test_notified_failure_before_and_after_status(day_with_failure, make_log):
    log = make_log(("a", "FAILED", "2024-01-15 03:00:00"))
    before = monitor(*day_with_failure, SLA_BY_LAYER, log, AS_OF)
    assert values(before["outbox"], "kind") == [("success",)]
    after = monitor(*day_with_failure, SLA_BY_LAYER, log, AS_OF, dedupe="after_status")
    assert values(after["layers"], "Layer", "Status") == [("Bronze", "Failed"), ("Gold", "Completed")]
    assert after["outbox"].count() == 0 == after["notification_rows"].count()
    with pytest.raises(ValueError):
        monitor(*day_with_failure, SLA_BY_LAYER, log, AS_OF, dedupe="never")


def test_everything_notified_closes_the_gate(day_with_failure, make_log):
    at = "2024-01-15 03:00:00"
    log = make_log(("a", "FAILED", at), ("b", "SUCCESS", at), ("c", "SUCCESS", at))
    found = monitor(*day_with_failure, SLA_BY_LAYER, log, AS_OF)
    assert tuple(found["gate"].first()) == (0, 0, False)
    assert found["outbox"].count() == 0


def test_long_failure_report_is_logged_by_part(make_runs, make_deps, make_log):
    names = [f"n{i:03d}" for i in range(60)]
    runs = make_runs(
        *((str(i), f"j{i}", name, "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED") for i, name in enumerate(names))
    )
    found = monitor(
        runs, make_deps(*(("Gold", name) for name in names)), SLA_BY_LAYER, make_log(), AS_OF, rows_per_part=10
    )
    messages = found["outbox"].collect()
    assert sorted(m.part for m in messages) == list(range(6)) and {m.parts for m in messages} == {6}
    assert sum(m.body.count("<tr><td>") for m in messages) == 60
    rows = found["notification_rows"].collect()
    assert sorted(row.WorkflowName for row in rows) == names
    assert all(f"<td>{row.WorkflowName}</td>" in row.NotificationEmailContent for row in rows)


@pytest.fixture()
def raw(spark):
    def make(*rows):
        parts = [
            f"""select {run_id} as run_id, {job} as job_id, '{name}' as run_name, {eastern_ms(start)}L as start_time,
            {eastern_ms(end) if end else 0}L as end_time, 60000L as run_duration, 'PERIODIC' as trigger,
            0 as attempt_number, named_struct('result_state', {f"'{state}'" if state else "cast(null as string)"},
              'state_message', '{"" if end else "In run"}') as state"""
            for run_id, job, name, start, end, state in rows
        ]
        return spark.sql(" union all ".join(parts))

    return make


def test_cycles_of_a_day(spark, raw, make_deps):
    tag = uuid.uuid4().hex[:8]
    names = TableNames(f"runs_{tag}", f"notices_{tag}", f"outbox_{tag}")
    deps = make_deps(("Bronze", "x"), ("Gold", "y"))
    failed = ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED")
    running = ("2", "8", "y", "2024-01-15 01:00:00", None, None)
    rerun = ("3", "7", "x", "2024-01-15 03:00:00", "2024-01-15 04:00:00", "SUCCESS")

    def cycle(at, *rows):
        run_cycle(raw(*rows), deps, at, names, **TO)
        return values(spark.table(names.outbox), "kind"), values(spark.table(names.notification_log), "job_id", "EventType")

    first = cycle(dt.datetime(2024, 1, 15, 8), failed, ("4", "8", "w", "2024-01-15 01:00:00", None, None))
    assert first == ([("failure",)], [("7", "FAILED")])
    # The same failure is not reported again, whatever else is still missing.
    again = cycle(dt.datetime(2024, 1, 15, 8, 30), failed, ("4", "8", "w", "2024-01-15 01:00:00", None, None))
    assert again == first
    done = cycle(dt.datetime(2024, 1, 15, 9), failed, rerun, running)
    assert done == ([("failure",), ("success",)], [("7", "FAILED"), ("7", "SUCCESS"), ("8", "SUCCESS")])
    assert cycle(dt.datetime(2024, 1, 15, 9, 30), failed, rerun, running) == done
    assert values(spark.table(names.run_log), "RunId", "WorkFlowState") == [
        (1, "FAILED"), (2, None), (3, "SUCCESS"), (4, None),
    ]


def test_settle(spark):
    df = spark.sql("select 1 as `SLA Met(Y/N)`, timestamp_ntz'2024-01-15 00:00:00' as t")
    settled = settle(df)
    assert settled.collect() == df.collect() and settled.dtypes == df.dtypes
    assert f"{shared_folder(spark)}/runtide/settled-" in settled.inputFiles()[0]
