"""Incremental ingest of landed payload pages, in place of pulling the same window again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from runtide.functions.clock import BUSINESS_ZONE
from runtide.operators.runs import flatten_runs
from runtide.plans.lineage import settle
from runtide.schema import RUN_PAGE_DDL
from runtide.sources.payload import broken_pages, quarantine, read_pages, runs_of_pages, sound_runs
from runtide.sources.tables import write_run_log


def stream_runs(spark: SparkSession, landing: str, multi_line: bool = False) -> DataFrame:
    """Flat runs of the payload pages that arrive below `landing`."""
    pages = spark.readStream.schema(RUN_PAGE_DDL).option("multiLine", multi_line).option("mode", "FAILFAST")
    return flatten_runs(runs_of_pages(pages.json(landing)))


def ingest_new_pages(
    spark: SparkSession,
    landing: str,
    run_log: str,
    checkpoint: str,
    as_of: dt.datetime | int,
    tz: str = BUSINESS_ZONE,
    multi_line: bool = False,
    quarantine_table: str | None = None,
) -> StreamingQuery:
    """Upserts every page not ingested before into the table `run_log`, then stops.

    Start it on the schedule of the monitoring job. A batch that is repeated after a failure leaves
    the log as it was: runs are upserted by key, those without a full key by all values. A page that
    arrives late does not take back the end of a run.

    A broken page is an error, and the stream stops before it each time; with `quarantine_table` it goes there, once, and the
    others are ingested.
    """

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        if quarantine_table:
            pages = settle(batch, "pages")
            quarantine(broken_pages(pages, as_of, tz), quarantine_table)
            batch = flatten_runs(sound_runs(pages))
        write_run_log(batch, run_log, as_of, tz, null_keys="match", older="kept")

    arriving = read_pages(spark, landing, multi_line, stream=True) if quarantine_table else stream_runs(spark, landing, multi_line)
    return (
        arriving.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
