"""Upsert of runs into the run log, as a DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runtide.functions.clock import BUSINESS_ZONE, stamp
from runtide.functions.scalars import local_clock, zero_as_null
from runtide.schema import RUN_LOG_COLUMNS, RUN_LOG_PARTITION

KEY = ("RunId", "WorkFlowId", "attempt_number")


def has_key() -> Column:
    """Whether all key columns are set. A row without a full key matches nothing."""
    return F.col("RunId").isNotNull() & F.col("WorkFlowId").isNotNull() & F.col("attempt_number").isNotNull()


def run_log_rows(runs: DataFrame, as_of: dt.datetime | int, tz: str = BUSINESS_ZONE) -> DataFrame:
    """Flat runs as rows of the run log, in one projection.

    The SLA flag is null: the upsert never writes it. The partition is the UTC date of the start.
    `EndMs` follows the columns of the log; it says which of several rows of one key is the latest.
    """
    return runs.select(
        F.col("run_id").cast("bigint").alias("RunId"),
        F.coalesce("attempt_number", F.lit(0)).alias("attempt_number"),
        F.col("job_id").cast("bigint").alias("WorkFlowId"),
        F.col("trigger").alias("WorkFlowStartType"),
        F.col("start_time_in_est").cast("string").alias("WorkFlowStartDttm"),
        F.col("end_time_in_est").cast("string").alias("WorkFlowEndDttm"),
        F.col("run_duration_min").cast("string").alias("WorkFlowDuration"),
        F.col("result_state").alias("WorkFlowState"),
        F.col("state_message").alias("WorkFlowMessage"),
        F.lit(None).cast("string").alias("WorkFlowMetSLAFlag"),
        stamp(as_of, tz).alias("InsertedOn"),
        F.to_date(local_clock("start_time_in_ms", "UTC")).alias(RUN_LOG_PARTITION),
        zero_as_null("end_time_in_ms").alias("EndMs"),
    )


def latest_of_key(rows: DataFrame) -> DataFrame:
    """One row for each key, the last to end; ties by the values, so that the choice is always the same."""
    values = [F.col(name).asc_nulls_last() for name in rows.columns if name not in (*KEY, "EndMs")]
    latest = Window.partitionBy(*KEY).orderBy(F.col("EndMs").desc_nulls_last(), *values)
    return rows.withColumn("rank", F.row_number().over(latest)).where("rank = 1").drop("rank")


def upsert_rows(log: DataFrame, rows: DataFrame, null_keys: str = "insert", older: str = "overwrites") -> DataFrame:
    """`log` after an upsert of `rows` from `run_log_rows`.

    Rows match on run id, job id and attempt. A matched log row takes every value of the new row
    but its SLA flag and partition; an unmatched new row is added. Of several new rows with one key
    the latest counts. Choosing it shuffles and sorts by the key, which serves the full outer join
    as well. Rows without a full key bypass both, where they would all meet in one task.

    `null_keys="insert"` adds rows without a full key each time, so a repeated pull repeats them;
    `"match"` adds only those that differ from all such rows of the log in some value, stamp and
    flag aside, and of equal new ones one. `older="overwrites"` lets the last pull win whatever it
    says; `"kept"` keeps a logged end against a row without one or with an earlier one.
    """
    if null_keys not in ("insert", "match"):
        raise ValueError(f"null_keys must be 'insert' or 'match', not {null_keys!r}")
    if older not in ("overwrites", "kept"):
        raise ValueError(f"older must be 'overwrites' or 'kept', not {older!r}")
    columns = [*RUN_LOG_COLUMNS, RUN_LOG_PARTITION]
    old = log.where(has_key()).select(*(F.col(name).alias(f"old_{name}") for name in columns))
    new = latest_of_key(rows.where(has_key()))
    match = [F.col(name) == F.col(f"old_{name}") for name in KEY]
    joined = old.join(new, match, "full_outer")
    keep_old = F.col("RunId").isNull()
    if older == "kept":
        logged, pulled = (F.col(name).try_cast("timestamp_ntz") for name in ("old_WorkFlowEndDttm", "WorkFlowEndDttm"))
        keep_old = keep_old | (logged.isNotNull() & F.coalesce(pulled < logged, F.lit(True)))

    def value(name: str) -> Column:
        if name in ("WorkFlowMetSLAFlag", RUN_LOG_PARTITION):
            picked = F.when(F.col("old_RunId").isNull(), F.col(name)).otherwise(F.col(f"old_{name}"))
        else:
            picked = F.when(keep_old, F.col(f"old_{name}")).otherwise(F.col(name))
        return picked.alias(name)

    merged = joined.select(*(value(name) for name in columns))
    loose = [side.where(~has_key()).select(*columns) for side in (log, rows)]
    if null_keys == "match":
        # All values make the join key, so rows without a run or job id spread over tasks.
        told = [name for name in columns if name not in ("InsertedOn", "WorkFlowMetSLAFlag")]
        seen = loose[0].select(*(F.col(name).alias(f"old_{name}") for name in told)).distinct()
        same = [F.col(name).eqNullSafe(F.col(f"old_{name}")) for name in told]
        loose[1] = loose[1].dropDuplicates(told).join(seen, same, "left_anti")
    return merged.unionByName(loose[0]).unionByName(loose[1])


def upsert_runs(
    log: DataFrame,
    runs: DataFrame,
    as_of: dt.datetime | int,
    tz: str = BUSINESS_ZONE,
    null_keys: str = "insert",
    older: str = "overwrites",
) -> DataFrame:
    """`log` after an upsert of flat `runs`, stamped with `as_of`."""
    return upsert_rows(log, run_log_rows(runs, as_of, tz), null_keys, older)
