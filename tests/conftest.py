import datetime as dt
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("runtide-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="runtide-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="runtide-shared-"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="runtide-test-")


FLAT_DDL = """
    run_id string, job_id string, run_name string, attempt_number int, start_time_in_ms bigint, end_time_in_ms bigint,
    start_time_in_est timestamp_ntz, end_time_in_est timestamp_ntz, run_duration_min float, trigger string,
    result_state string, state_message string
"""


def eastern_ms(text: str) -> int:
    """Epoch ms of an Eastern wall-clock time."""
    from zoneinfo import ZoneInfo

    return int(dt.datetime.fromisoformat(text).replace(tzinfo=ZoneInfo("US/Eastern")).timestamp() * 1000)


@pytest.fixture()
def make_runs(spark):
    """Flat runs from (run_id, job_id, name, start, end, state[, message[, attempt]]), times Eastern or None."""

    def make(*rows):
        data = []
        for run_id, job_id, name, start, end, state, *rest in rows:
            message, attempt = (*rest, *("", 0)[len(rest) :])
            naive = [dt.datetime.fromisoformat(t) if t else None for t in (start, end)]
            ms = [eastern_ms(t) if t else 0 for t in (start, end)]
            data.append((run_id, job_id, name, attempt, *ms, *naive, 1.5, "PERIODIC", state, message))
        return spark.createDataFrame(data, FLAT_DDL)

    return make


@pytest.fixture()
def make_deps(spark):
    def make(*pairs):
        rows = [("Area", "Flow", name, layer) for layer, name in pairs]
        return spark.createDataFrame(rows, "SubjectArea string, WorkflowName string, DependsOn string, layer string")

    return make


@pytest.fixture()
def make_log(spark):
    """Notification log from (job_id, event, inserted)."""
    from runtide.schema import NOTIFICATION_COLUMNS, NOTIFICATION_LOG_DDL

    def make(*rows):
        data = []
        for job_id, event, inserted in rows:
            at = dt.datetime.fromisoformat(inserted)
            data.append(("WF", "name", job_id, event, at, at, "a@example.com", "text", "Bronze", at))
        return spark.createDataFrame(data, NOTIFICATION_LOG_DDL).select(*NOTIFICATION_COLUMNS)

    return make
