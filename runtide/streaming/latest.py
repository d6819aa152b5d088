"""The latest run of each job and day, kept by a stream instead of ranking a history again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runtide.functions.scalars import zero_as_null
from runtide.operators.runs import latest_run_per_job
from runtide.sources.tables import overwrite_partitions

DAY = "Day"


def latest_first() -> Column:
    """A value that is smallest for the run a job is judged by, in the order of `latest_run_order`."""
    parts: list[Column] = []
    for value in (-zero_as_null("end_time_in_ms"), F.col("run_id").try_cast("bigint"), F.col("run_id"), F.col("attempt_number")):
        parts += [value.isNull(), value]
    return F.struct(*(part.alias(f"p{k}") for k, part in enumerate(parts)))


def latest_of_day(runs: DataFrame, late_by: str | None = None) -> DataFrame:
    """`run` (all columns), the latest of each job among the runs that start on a UTC `Day`.

    An aggregate, so each task sends one row per job and day, and a stream holds one. In a stream `late_by` says how much later than
    the newest start a run may arrive; days that are past it leave the state. Runs without a start have day null and
    are left to the batch: a stream has no time to file them under.
    """
    started = F.timestamp_millis(zero_as_null("start_time_in_ms"))
    dated = runs.select(F.struct(*runs.columns).alias("run"), "job_id", latest_first().alias("place"), started.alias("started"))
    if late_by is not None:
        dated = dated.withWatermark("started", late_by)
    day = F.window("started", "1 day")["start"].cast("date") if late_by is None else F.window("started", "1 day")
    found = dated.groupBy(day.alias("slot"), "job_id").agg(F.min_by("run", "place").alias("run"))
    return found.select((F.col("slot") if late_by is None else F.col("slot.start").cast("date")).alias(DAY), "run")


def ensure_latest_runs(spark: SparkSession, table: str, runs: DataFrame, location: str | None = None) -> None:
    """Creates the table of latest runs, one partition per day, if it does not exist; columns are those of `runs`."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in runs.schema)
    place = f" LOCATION '{location.rstrip('/')}/{table}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {DAY} date) USING parquet PARTITIONED BY ({DAY}){place}")


def keep_latest(changed: DataFrame, table: str) -> None:
    """Brings `changed` (Day, run) into the table of latest runs: of each job and day the run that comes first stays.

    Only the days that changed are read and written, in one write; repeating a call changes nothing.
    """
    spark = changed.sparkSession
    columns = [name for name in spark.table(table).columns if name != DAY]
    days = [row[0] for row in changed.select(DAY).distinct().collect()]  # of one batch
    fresh = changed.select("run.*", DAY)
    both = spark.table(table).where(F.col(DAY).isin(days)).unionByName(fresh)
    best = both.groupBy(DAY, "job_id").agg(F.min_by(F.struct(*columns), latest_first()).alias("run")).select("run.*", DAY)
    overwrite_partitions(best.hint("rebalance", DAY), table)


def stream_latest_runs(runs: DataFrame, table: str, checkpoint: str, late_by: str = "2 days") -> StreamingQuery:
    """Keeps `table` up to date with a stream of flat `runs`, takes what has arrived, then stops.

    The state holds one run of each job for each day that is not past `late_by`; it lives in `checkpoint`, so a stopped
    stream goes on where it was. Runs that start earlier than `late_by` before the newest start seen by an earlier batch are too late and are
    not taken: choose it longer than the look-back, and they are past every report.
    """
    batches = latest_of_day(runs, late_by).writeStream.outputMode("update")
    return (
        batches.foreachBatch(lambda batch, _batch_id: keep_latest(batch.persist(), table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_runs(kept: DataFrame) -> DataFrame:
    """One run for each job from the table of latest runs: few rows, those of a job's days."""
    return latest_run_per_job(kept.drop(DAY))
