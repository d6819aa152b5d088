"""Operators on run histories: flatten, look back, latest run of each job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runtide.functions.clock import BUSINESS_ZONE, instant_ms
from runtide.functions.scalars import local_clock, minutes_1, or_default, path_sql, zero_as_null
from runtide.schema import RUN_FIELDS

DAY_MS = 24 * 60 * 60 * 1000


def flatten_runs(raw: DataFrame, zones: tuple[str, str] = ("US/Pacific", "US/Eastern")) -> DataFrame:
    """Nested run payloads -> the 27 typed columns of the flat run table, one row per run.

    A single projection of built-in expressions: columns that the rest of a query does not use
    are pruned down to the scan. The order of rows is left alone, see `newest_first`.
    """
    west, east = zones
    derived = {
        "start_time_in_pst": local_clock("start_time_in_pst", west),
        "start_time_in_est": local_clock("start_time_in_est", east),
        "setup_duration_min": minutes_1("setup_duration_min"),
        "run_duration_min": minutes_1("run_duration_min"),
        "end_time_in_pst": local_clock("end_time_in_pst", west),
        "end_time_in_est": local_clock("end_time_in_est", east),
        "cluster_name": or_default("cluster_name", "CUSTOM"),
    }
    schema = raw.schema
    picked = (
        path_sql(schema, path, "bigint" if kind in ("timestamp_ntz", "float") else kind) + f" as {name}"
        for name, kind, path in RUN_FIELDS
    )
    return raw.selectExpr(*picked).withColumns(derived)


def newest_first_order() -> list[Column]:
    """Pacific start time, newest first; ties by run id, so that the order is always the same."""
    return [F.col("start_time_in_pst").desc_nulls_last(), *_run_id_order()]


def newest_first(runs: DataFrame) -> DataFrame:
    """Total order by `newest_first_order`. For output only: it costs a range shuffle."""
    return runs.orderBy(*newest_first_order())


def runs_lookback(runs: DataFrame, as_of: dt.datetime | int, days_back: int = 1) -> DataFrame:
    """Runs started within `days_back` days before `as_of`, on raw or flat runs.

    The test is on the untouched long column, so file scans can skip row groups with it.
    """
    until = instant_ms(as_of)
    start = "start_time_in_ms" if "start_time_in_ms" in runs.columns else "start_time"
    return runs.where(F.col(start).between(until - days_back * DAY_MS, until))


def runs_recent_topk(runs: DataFrame, n: int | None = None) -> DataFrame:
    """The `n` runs started last, ties by run id; all runs, in no order, when `n` is None."""
    if n is None:
        return runs
    return runs.orderBy(F.col("start_time_in_ms").desc_nulls_last(), *_run_id_order()).limit(n)


def _run_id_order() -> list[Column]:
    return [
        F.col("run_id").try_cast("bigint").asc_nulls_last(),
        F.col("run_id").asc_nulls_last(),
        F.col("attempt_number").asc_nulls_last(),
    ]


def latest_run_order() -> list[Column]:
    """Order that puts the run a job is judged by first: last to end, unfinished runs last."""
    return [zero_as_null("end_time_in_ms").desc_nulls_last(), *_run_id_order()]


def latest_run_per_job(runs: DataFrame) -> DataFrame:
    """One run for each job id, the first by `latest_run_order`; runs without job id form one job.

    The rank filter becomes a group limit on both sides of the shuffle, so each task sends at most
    one row per job and a job that holds most of the history does not load one task.
    """
    first = Window.partitionBy("job_id").orderBy(*latest_run_order())
    return runs.withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank")


def runs_today_latest(runs: DataFrame, day: dt.date, tz: str = BUSINESS_ZONE) -> DataFrame:
    """Latest run of each job, kept only if it started on `day` in `tz`.

    The ranking comes first: a job whose latest run belongs to another day is left out.
    """
    started = F.to_date(local_clock("start_time_in_ms", tz))
    return (
        latest_run_per_job(runs).where(started == F.lit(day)).withColumn("BronzeWorkFlowName", F.col("run_name"))
    )


def run_counts(runs: DataFrame) -> DataFrame:
    """One row: the number of runs."""
    return runs.agg(F.count(F.lit(1)).alias("run_count"))
