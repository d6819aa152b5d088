"""The journal of cycles: what is to be written, before it is written, so that it is written once."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtide.operators.notify import not_yet_logged, not_yet_sent, with_bodies
from runtide.schema import NOTIFICATION_PARTITION
from runtide.sources.tables import (
    TableNames,
    append_entries,
    append_notifications,
    append_outbox,
    bodies_once,
)


def record_cycle(messages: DataFrame, entries: DataFrame, names: TableNames, day: dt.date) -> str:
    """Records messages (rows of the outbox) and entries of `day` under a new name, which is returned.

    The record counts from the moment its single row in the table of cycles is there; of a call that was stopped before, nothing
    was written to log or outbox and nothing will be.
    """
    spark = messages.sparkSession
    cycle = uuid.uuid4().hex
    journal = spark.table(names.journal).schema
    rows = [
        side.select(*(F.struct(*side.columns) if f == filled else F.lit(None) for f in ("message", "entry")))
        for side, filled in ((messages, "message"), (entries, "entry"))
    ]
    kinds = [journal[name].dataType for name in ("message", "entry")]
    both = [r.select(*(F.col(c).cast(k) for c, k in zip(r.columns, kinds, strict=True)), F.lit(cycle)) for r in rows]
    both[0].union(both[1]).write.insertInto(names.journal)
    _mark(spark, names, cycle, day, "recorded")
    return cycle


def apply_cycle(spark: SparkSession, names: TableNames, cycle: str) -> None:
    """Writes what a recorded cycle has and log and outbox have not: the log first, then the outbox. May be repeated."""
    log_cycle(spark, names, cycle)
    send_cycle(spark, names, cycle)
    day = spark.table(names.cycles).where(F.col("cycle") == cycle).first()["day"]
    _mark(spark, names, cycle, day, "applied")


def log_cycle(spark: SparkSession, names: TableNames, cycle: str) -> None:
    """The entries of a recorded cycle that the notification log lacks are appended to it; only their day is looked at."""
    day = spark.table(names.cycles).where(F.col("cycle") == cycle).first()["day"]
    entries = _recorded(spark, names, cycle, "entry")
    once = bodies_once(spark, names)
    log = spark.table(names.entries if once else names.notification_log)
    missing = not_yet_logged(entries, log.where(F.col(NOTIFICATION_PARTITION) == F.lit(day)))
    if once:
        append_entries(missing, names.entries)
    else:
        append_notifications(with_bodies(missing, _recorded(spark, names, cycle, "message")), names.notification_log)


def send_cycle(spark: SparkSession, names: TableNames, cycle: str) -> None:
    """The messages of a recorded cycle that the outbox lacks, by id, are appended to it."""
    append_outbox(not_yet_sent(_recorded(spark, names, cycle, "message"), spark.table(names.outbox)), names.outbox)


def replay_cycles(spark: SparkSession, names: TableNames) -> list[str]:
    """Completes the recorded cycles that were not applied to the end; at most one unless calls were stopped in a row."""
    states = spark.table(names.cycles).groupBy("cycle").agg(F.bool_or(F.col("state") == "applied").alias("done"))
    found = [row["cycle"] for row in states.where(~F.col("done")).select("cycle").collect()]
    for cycle in found:
        apply_cycle(spark, names, cycle)
    return found


def _recorded(spark: SparkSession, names: TableNames, cycle: str, part: str) -> DataFrame:
    return spark.table(names.journal).where(F.col("cycle") == cycle).where(f"{part} is not null").select(f"{part}.*")


def _mark(spark: SparkSession, names: TableNames, cycle: str, day: dt.date, state: str) -> None:
    spark.createDataFrame([(cycle, day, state)], "cycle string, day date, state string").coalesce(1).write.insertInto(names.cycles)
