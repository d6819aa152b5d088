import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from runtide.operators.notify import notification_rows, notifications_on
from runtide.operators.runlog import latest_of_key, run_log_rows, upsert_runs
from runtide.schema import NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION, RUN_LOG_COLUMNS, RUN_LOG_PARTITION
from runtide.sources.tables import TableNames, append_notifications, ensure_tables, merge_run_log, write_run_log

AS_OF = dt.datetime(2024, 1, 16, 4, 59, 59)
LATER = dt.datetime(2024, 1, 16, 5, 30)


@pytest.fixture()
def tables(spark):
    tag = uuid.uuid4().hex[:8]
    names = TableNames(f"runs_{tag}", f"notices_{tag}", f"outbox_{tag}")
    ensure_tables(spark, names)
    ensure_tables(spark, names)  # a second call finds them
    return names


def content(df, *columns):
    return sorted((tuple(row[c] for c in columns or df.columns) for row in df.collect()), key=repr)


def first_runs(make_runs):
    return make_runs(
        ("1", "7", "x", "2024-01-15 01:00:00", None, None, "In run", None),
        ("2", "7", "x", "2024-01-15 03:00:00", "2024-01-15 04:00:00.250000", "SUCCESS", "", 1),
        ("3", "8", "y", None, None, None, "queued"),
        ("4", "9", "z", "2024-01-10 01:00:00", "2024-01-10 02:00:00", "SUCCESS"),
    )


def second_runs(make_runs):
    return make_runs(
        ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 05:00:00", "FAILED", "broke", 0),
        ("3", "8", "y", "2024-01-15 06:00:00", None, None, "In run"),
        ("5", "9", "z", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"),
    )


SHOWN = ("RunId", "attempt_number", "WorkFlowState", "WorkFlowMessage", "InsertedOn")
NOW, THEN = dt.datetime(2024, 1, 15, 23, 59, 59), dt.datetime(2024, 1, 16, 0, 30)
AFTER_BOTH = [
    (1, 0, "FAILED", "broke", THEN), (2, 1, "SUCCESS", "", NOW), (3, 0, None, "In run", THEN),
    (4, 0, "SUCCESS", "", NOW), (5, 0, "SUCCESS", "", THEN),
]


def test_row_values(make_runs):
    row = run_log_rows(first_runs(make_runs), AS_OF).where("RunId = 2").drop("EndMs").first().asDict()
    assert row == {
        "RunId": 2, "attempt_number": 1, "WorkFlowId": 7, "WorkFlowStartType": "PERIODIC",
        "WorkFlowStartDttm": "2024-01-15 03:00:00", "WorkFlowEndDttm": "2024-01-15 04:00:00.25",
        "WorkFlowDuration": "1.5", "WorkFlowState": "SUCCESS", "WorkFlowMessage": "", "WorkFlowMetSLAFlag": None,
        "InsertedOn": NOW, RUN_LOG_PARTITION: dt.date(2024, 1, 15),
    }


def test_upsert_keeps_the_flag_and_partition_of_matched_rows(make_runs):
    log = run_log_rows(first_runs(make_runs), AS_OF).withColumn("WorkFlowMetSLAFlag", F.lit("Y"))
    after = upsert_runs(log, second_runs(make_runs), LATER)
    assert content(after, *SHOWN) == sorted(AFTER_BOTH, key=repr)
    assert content(after, "RunId", "WorkFlowMetSLAFlag", RUN_LOG_PARTITION) == [
        (1, "Y", dt.date(2024, 1, 15)), (2, "Y", dt.date(2024, 1, 15)), (3, "Y", None),
        (4, "Y", dt.date(2024, 1, 10)), (5, None, dt.date(2024, 1, 15)),
    ]


def test_upsert_twice_is_upsert_once(make_runs):
    log = run_log_rows(first_runs(make_runs), AS_OF)
    once = upsert_runs(log, second_runs(make_runs), LATER)
    assert content(upsert_runs(once, second_runs(make_runs), LATER)) == content(once)


def test_rows_without_a_full_key_are_always_added(make_runs):
    loose = make_runs(
        (None, "7", "x", "2024-01-15 01:00:00", None, None),
        (None, "7", "x", "2024-01-15 01:00:00", None, None),
        ("9", None, "x", "2024-01-15 01:00:00", None, None),
    )
    once = upsert_runs(run_log_rows(loose.where("false"), AS_OF), loose, AS_OF)
    assert once.count() == 3
    assert upsert_runs(once, loose, LATER).count() == 6


def test_rows_without_a_full_key_may_match_by_value(make_runs):
    loose = make_runs(
        (None, "7", "x", "2024-01-15 01:00:00", None, None),
        (None, "7", "x", "2024-01-15 01:00:00", None, None),
        (None, "7", "x", "2024-01-15 01:00:00", None, "FAILED"),
        ("9", None, "x", None, None, None),
    )
    once = upsert_runs(run_log_rows(loose.where("false"), AS_OF), loose, AS_OF, null_keys="match")
    assert once.count() == 3
    assert content(upsert_runs(once, loose, LATER, null_keys="match")) == content(once)
    with pytest.raises(ValueError):
        upsert_runs(once, loose, LATER, null_keys="never")


def test_a_logged_end_may_be_kept(make_runs):
    end = "2024-01-15 02:00:00"
    done = make_runs(*((str(k), "7", "x", "2024-01-15 01:00:00", end, "SUCCESS") for k in range(3)), ("3", "7", "x", None, None, None))
    late = make_runs(
        ("0", "7", "x", "2024-01-15 01:00:00", None, None, "In run"),
        ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 01:30:00", "FAILED"),
        ("2", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:30:00", "FAILED"),
        ("3", "7", "x", "2024-01-15 01:00:00", None, "FAILED"),
    )
    log = run_log_rows(done, AS_OF)
    states = [content(upsert_runs(log, late, LATER, older=older), "RunId", "WorkFlowState") for older in ("overwrites", "kept")]
    assert states == [
        [(0, None), (1, "FAILED"), (2, "FAILED"), (3, "FAILED")],
        [(0, "SUCCESS"), (1, "SUCCESS"), (2, "FAILED"), (3, "FAILED")],
    ]


def test_one_row_per_key_of_the_source(make_runs):
    runs = make_runs(
        ("1", "7", "x", "2024-01-15 01:00:00", None, None, "In run", None),
        ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS", "", 0),
        ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED", "", 1),
    )
    assert content(latest_of_key(run_log_rows(runs, AS_OF)), "RunId", "attempt_number", "WorkFlowState") == [
        (1, 0, "SUCCESS"), (1, 1, "FAILED"),
    ]


@pytest.mark.parametrize("whole_log", [False, True])
def test_write_run_log(spark, tables, make_runs, whole_log):
    write_run_log(first_runs(make_runs), tables.run_log, AS_OF)
    for _ in range(2):
        write_run_log(second_runs(make_runs), tables.run_log, LATER, whole_log=whole_log)
        assert content(spark.table(tables.run_log), *SHOWN) == sorted(AFTER_BOTH, key=repr)
    assert tuple(spark.table(tables.run_log).columns) == (*RUN_LOG_COLUMNS, RUN_LOG_PARTITION)


def test_untouched_partitions_are_not_rewritten(spark, tables, make_runs):
    write_run_log(first_runs(make_runs), tables.run_log, AS_OF)
    old = f"{RUN_LOG_PARTITION} = date'2024-01-10'"
    files = {row[0] for row in spark.table(tables.run_log).where(old).select("_metadata.file_path").collect()}
    write_run_log(second_runs(make_runs), tables.run_log, LATER)
    spark.catalog.refreshTable(tables.run_log)
    assert {row[0] for row in spark.table(tables.run_log).where(old).select("_metadata.file_path").collect()} == files


def test_merge_is_for_tables_with_row_level_operations(tables, make_runs):
    # Parquet tables have none, so this shows no more than that the statement names real columns.
    with pytest.raises(Exception, match="(?i)merge"):
        merge_run_log(first_runs(make_runs), tables.run_log, AS_OF)


def test_write_leaves_the_session_as_it_was(spark, tables, make_runs):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_run_log(first_runs(make_runs), tables.run_log, AS_OF)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_notification_rows(spark, tables, make_runs):
    status = make_runs(
        ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
        ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
    ).withColumn("layer", F.lit("Gold"))
    rows = notification_rows(status, "result_state", "a@x.com;b@x.com", "<p>", AS_OF)
    assert rows.collect() == [
        ("WF", "x", "7", "FAILED", dt.datetime(2024, 1, 15, 2), NOW, "a@x.com;b@x.com", "<p>", "Gold", NOW,
         dt.date(2024, 1, 15)),
    ]
    append_notifications(rows, tables.notification_log)
    append_notifications(rows, tables.notification_log)
    log = spark.table(tables.notification_log)
    assert tuple(log.columns) == (*NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION)
    assert notifications_on(log, dt.date(2024, 1, 15)).count() == 2
    assert notifications_on(log, dt.date(2024, 1, 16)).count() == 0


def test_body_in_parts(spark, make_runs):
    status = make_runs(
        ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
        ("2", "8", "y", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED"),
    ).selectExpr("*", "'Gold' as layer", "cast(job_id - 7 as int) as part")
    bodies = spark.createDataFrame([(0, 2, "first"), (1, 2, "second")], "part int, parts int, body string")
    rows = notification_rows(status, "result_state", "a", bodies, AS_OF)
    assert content(rows, "job_id", "NotificationEmailContent") == [("7", "first"), ("8", "second")]
