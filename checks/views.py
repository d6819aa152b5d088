"""Inputs derived from the test tables, see FIXTURES.md: one event is one run, one user one job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtide.functions.scalars import local_clock
from runtide.operators.runs import flatten_runs, runs_lookback, runs_today_latest
from runtide.schema import NOTIFICATION_COLUMNS, RUN_LOG_COLUMNS, RUN_LOG_PARTITION

AS_OF = dt.datetime(2024, 1, 16, 4, 59, 59, tzinfo=dt.timezone.utc)
DAY = dt.date(2024, 1, 15)
RECIPIENTS = "person1@example.com;person2@example.com"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as run_id",
        "user_id as job_id",
        "concat('WF-', user_id) as run_name",
        "unix_millis(cast(ts as timestamp)) as start_time",
        "event_id % 7 * 1000 as setup_duration",
        "cast(round(value * 100) as bigint) * 600 as run_duration",
        """case when event_type = 'view' then 0L else unix_millis(cast(ts as timestamp)) + event_id % 7 * 1000
           + cast(round(value * 100) as bigint) * 600 end as end_time""",
        "case when event_id % 5 = 0 then null else cast(event_id % 3 as int) end as attempt_number",
        "case when event_id % 2 = 0 then 'PERIODIC' else 'ONE_TIME' end as trigger",
        "concat('https://jobs.example.com/', user_id, '/', event_id) as run_page_url",
        """named_struct(
             'result_state', case event_type when 'error' then 'FAILED' when 'view' then null else 'SUCCESS' end,
             'state_message', case event_type when 'view' then 'In run' else '' end,
             'user_cancelled_or_timedout', event_type = 'error' and event_id % 2 = 1) as state""",
        """case when event_id % 4 = 0 then null
           else named_struct('cluster_id', concat('c-', user_id % 8)) end as cluster_instance""",
        """case when event_type = 'click' then null else named_struct('new_cluster', named_struct(
             'cluster_name', case when event_type = 'signup' then '' else concat('pool-', user_id % 4) end,
             'spark_version', concat('v', event_id % 3),
             'instance_pool_id', case when user_id % 2 = 0 then concat('ip-', user_id % 4) end,
             'node_type_id', concat('node-', event_id % 5),
             'data_security_mode', case when user_id % 3 = 0 then 'SINGLE_USER' else 'NONE' end,
             'num_workers', case when event_id % 2 = 0 then event_id % 10 end,
             'autoscale', case when event_id % 2 = 1
                then named_struct('min_workers', event_id % 3, 'max_workers', event_id % 3 + 4) end)) end
           as cluster_spec""",
        "'MULTI_TASK' as format",
    )


def flat_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_runs(raw_runs(spark, sf_dir))


def today_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_today_latest(runs_lookback(flat_runs(spark, sf_dir), AS_OF), DAY)


def shared_name_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's runs under names that several jobs share."""
    shared = F.concat(F.lit("WF-"), (F.col("job_id").cast("bigint") % 50).cast("string"))
    return today_runs(spark, sf_dir).withColumn("run_name", shared).withColumn("BronzeWorkFlowName", shared)


def dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dependency for each job, and one (number -1 here) that never runs."""
    jobs = table(spark, sf_dir, "events").select(F.explode(F.array("user_id", F.lit(-1))).alias("job")).distinct()
    return jobs.selectExpr(
        "'Area' as SubjectArea",
        "concat('DE-Gold-', case when job < 0 then 0 else job % 3 end) as WorkflowName",
        "concat('WF-', case when job < 0 then 'never' else cast(job as string) end) as DependsOn",
        "case when job < 0 or job % 3 = 0 then 'Bronze' when job % 3 = 1 then 'Gold' else 'Platinum' end as layer",
    )


def dependencies_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dependencies whose run of the day succeeded or is under way."""
    good = today_runs(spark, sf_dir).where("result_state = 'SUCCESS' or state_message = 'In run'").select("run_name")
    return dependencies(spark, sf_dir).join(good, F.col("DependsOn") == F.col("run_name"), "left_semi")


def notification_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per job for its last run of the day: notified today (`job_id % 4 = 0`), notified today
    with the opposite state (`% 8 = 2`), or notified on an earlier day only (the others)."""
    of_day = F.to_date(local_clock("start_time_in_ms", "US/Eastern")) == F.lit(DAY)
    last = "struct(coalesce(nullif(end_time_in_ms, 0), 0), cast(run_id as bigint))"
    jobs = flat_runs(spark, sf_dir).where(of_day).groupBy("job_id", "run_name").agg(
        F.expr(f"coalesce(max_by(result_state, {last}), 'SUCCESS') = 'FAILED' as failed"),
        F.expr(f"max_by(end_time_in_est, {last}) as EventDTMM"),
    )
    log = jobs.selectExpr(
        "'WF' as ObjectType",
        "run_name as WorkflowName",
        "job_id",
        "case when failed = (cast(job_id as bigint) % 8 = 2) then 'SUCCESS' else 'FAILED' end as EventType",
        "EventDTMM",
        """case when cast(job_id as bigint) % 4 = 0 or cast(job_id as bigint) % 8 = 2
                then timestamp_ntz'2024-01-15 12:00:00'
                when cast(job_id as bigint) % 4 = 1 then timestamp_ntz'2024-01-14 12:00:00'
                else timestamp_ntz'2024-01-13 12:00:00' end as InsertedOn""",
        f"'{RECIPIENTS}' as NotificationSentTo",
        "'earlier report' as NotificationEmailContent",
        """case cast(job_id as bigint) % 3 when 0 then 'Bronze' when 1 then 'Gold' else 'Platinum' end as layer""",
    )
    return log.withColumn("NotificationDttm", F.col("InsertedOn")).select(*NOTIFICATION_COLUMNS)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every run: `run_id % 3 = 0` under the run's own key, the others under one that no run has."""
    log = flat_runs(spark, sf_dir).selectExpr(
        "cast(run_id as bigint) as RunId",
        """coalesce(attempt_number, 0) + case when cast(run_id as bigint) % 3 = 0 then 0 else 100 end
           as attempt_number""",
        "cast(job_id as bigint) as WorkFlowId",
        "trigger as WorkFlowStartType",
        "cast(start_time_in_est as string) as WorkFlowStartDttm",
        "cast(null as string) as WorkFlowEndDttm",
        "cast(null as string) as WorkFlowDuration",
        "'OLD' as WorkFlowState",
        "state_message as WorkFlowMessage",
        "'Y' as WorkFlowMetSLAFlag",
        "timestamp_ntz'2024-01-14 12:00:00' as InsertedOn",
        f"to_date(convert_timezone('US/Eastern', 'UTC', start_time_in_est)) as {RUN_LOG_PARTITION}",
    )
    return log.select(*RUN_LOG_COLUMNS, RUN_LOG_PARTITION)


LAYER_OF_JOB = "case {0} % 3 when 0 then 'Bronze' when 1 then 'Gold' else 'Platinum' end"


def dependency_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The workflow of job n depends on that of job n // 3; those of jobs 1 and 4 on each other."""
    jobs = table(spark, sf_dir, "events").select(F.col("user_id").alias("job")).distinct()
    back = F.expr("case when job = 1 then array(0L, 4L) else array(job div 3) end")
    return jobs.where("job > 0").select("job", F.explode(back).alias("on")).selectExpr(
        "concat('WF-', job) as WorkflowName", "concat('WF-', `on`) as DependsOn"
    )


def sla_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three texts for each layer; that of Platinum ends with the third."""
    layers = table(spark, sf_dir, "events").selectExpr(f"{LAYER_OF_JOB.format('user_id')} as layer").distinct()
    dated = layers.select("layer", F.posexplode(F.array(*(F.lit(d).cast("date") for d in ("2024-01-05", "2024-01-12", "2024-01-20")))).alias("n", "valid_from"))
    return dated.selectExpr(
        "layer", "case when n < 2 or layer <> 'Platinum' then concat(length(layer) + n, ':30 AM EST') end as sla_text", "valid_from"
    )
