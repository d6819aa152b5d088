"""Operators that match runs with the dependency table and leave out what was reported."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.schema import NOTIFICATION_PARTITION


def dependency_needs(deps: DataFrame) -> DataFrame:
    """The distinct (layer, DependsOn) pairs, all that status and reports depend on."""
    return deps.select("layer", "DependsOn").distinct()


def dependency_status(deps: DataFrame, runs: DataFrame) -> DataFrame:
    """Dependencies LEFT OUTER runs on `DependsOn = run_name`.

    Written as matches plus the dependencies without any run. An outer join keeps all runs of one
    name in one task; of an inner join adaptive execution can broadcast either side or split a hot
    name on both, and the second part joins with names that are distinct. A consumer that needs
    matches only, such as `failed_runs`, has the second part removed by the optimizer.
    """
    matched = deps.join(runs, F.col("DependsOn") == F.col("run_name"), "inner")
    names = runs.select(F.col("run_name").alias("name_with_run")).where("name_with_run is not null").distinct()
    missing = deps.join(names, F.col("DependsOn") == F.col("name_with_run"), "left_anti")
    no_run = [F.lit(None).cast(field.dataType).alias(field.name) for field in runs.schema]
    return matched.unionByName(missing.select(*deps.columns, *no_run))


def dependency_rejoin(status: DataFrame, runs: DataFrame) -> DataFrame:
    """Multiplicity of each status row after a second left join with the same runs.

    That join adds no columns and only repeats a row once per run of the same name, so `copies`
    says all of it without writing the pairs of a group; see `expand_copies`.
    """
    per_name = runs.groupBy(F.col("BronzeWorkFlowName").alias("rejoin_name")).agg(
        F.count(F.lit(1)).alias("rejoin_count")
    )
    return status.join(per_name, F.col("DependsOn") == F.col("rejoin_name"), "left_outer").select(
        *status.columns, F.coalesce("rejoin_count", F.lit(1)).alias("copies")
    )


def expand_copies(counted: DataFrame) -> DataFrame:
    """Repeats each row `copies` times."""
    rest = [name for name in counted.columns if name != "copies"]
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*rest)


def sla_by_layer(df: DataFrame, sla: DataFrame | Mapping[str, str]) -> DataFrame:
    """Adds `SLA`, the SLA text of `layer`, null for a layer without one.

    `sla` is a mapping, which becomes a constant expression, or a frame (layer, sla_text) with one
    row per layer, which is joined.
    """
    if isinstance(sla, Mapping):
        text = F.lit(None).cast("string")
        for layer, cut_off in sla.items():
            text = F.when(F.col("layer") == layer, cut_off).otherwise(text)
        return df.withColumn("SLA", text)
    table = sla.select(F.col("layer").alias("sla_layer"), F.col("sla_text").alias("SLA"))
    return df.join(table, F.col("layer") == F.col("sla_layer"), "left_outer").drop("sla_layer")


def effective_state(df: DataFrame, running_text: str = "In run") -> DataFrame:
    """Counts a run that is under way as a success, and copies the state to `EventType`."""
    running = (F.col("state_message") == running_text) & F.col("run_name").isNotNull()
    state = F.when(running, "SUCCESS").otherwise(F.col("result_state"))
    return df.withColumn("result_state", state).withColumn("EventType", F.col("result_state"))


def notified_today(log: DataFrame, day: dt.date) -> DataFrame:
    """Distinct (job_id, EventType) of the notifications inserted on `day`."""
    on_day = F.to_date("InsertedOn") == F.lit(day)
    if NOTIFICATION_PARTITION in log.columns:
        on_day = on_day & (F.col(NOTIFICATION_PARTITION) == F.lit(day))
    return log.where(on_day).select("job_id", "EventType").distinct()


def not_yet_notified(status: DataFrame, notified: DataFrame) -> DataFrame:
    """Status rows whose (job_id, EventType) was not notified.

    Rows without either, such as dependencies that never ran, stay. They bypass the join: there
    they would share one task, and on a branch where the key is a constant null the join would have
    no key left to partition by.
    """
    keyed = F.col("job_id").isNotNull() & F.col("EventType").isNotNull()
    seen = notified.select(F.col("job_id").alias("seen_job"), F.col("EventType").alias("seen_event")).distinct()
    same = (F.col("job_id") == F.col("seen_job")) & (F.col("EventType") == F.col("seen_event"))
    return status.where(keyed).join(seen, same, "left_anti").unionByName(status.where(~keyed))


def failed_runs(status: DataFrame, notified: DataFrame, failure_dedupe: str = "job") -> DataFrame:
    """Failed rows still to be reported.

    `failure_dedupe="job"` leaves out jobs with any notification of the day, so a failure after a
    notified success is silent; `"job_event"` leaves out only jobs whose failure was notified.
    Rows without a job id match nothing and bypass the join, where they would share one task.
    """
    if failure_dedupe not in ("job", "job_event"):
        raise ValueError(f"failure_dedupe must be 'job' or 'job_event', not {failure_dedupe!r}")
    failed = status.where(F.col("result_state") == "FAILED")
    if failure_dedupe == "job_event":
        return not_yet_notified(failed, notified)
    jobs = notified.select(F.col("job_id").alias("seen_job")).distinct()
    told = failed.where("job_id is not null").join(jobs, F.col("job_id") == F.col("seen_job"), "left_anti")
    return told.unionByName(failed.where("job_id is null"))
