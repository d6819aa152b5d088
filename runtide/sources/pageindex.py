"""An index of landed files by the starts of their runs, for landings without a folder per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runtide.functions.clock import instant_ms
from runtide.operators.runs import DAY_MS, runs_lookback
from runtide.schema import PAGE_INDEX_COLUMNS, PAGE_INDEX_DDL, RUN_PAGE_DDL
from runtide.sources.payload import read_runs


def page_index(pages: DataFrame) -> DataFrame:
    """One row for each file of `pages` (`runs` and the file's `_metadata`): time written, runs, first and last start.

    Minimum and maximum are taken within a page, then over the pages of a file; no run is unnested. A file
    without runs has none of them.
    """
    starts = F.transform("runs", lambda run: run["start_time"])
    # Runs without a start belong to no window, as in the look-back.
    return (
        pages.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.greatest(F.size("runs"), F.lit(0)).cast("bigint").alias("n"),
            F.array_min(starts).alias("first"),
            F.array_max(starts).alias("last"),
        )
        .groupBy("file", "modified")
        .agg(F.sum("n").alias("runs"), F.min("first").alias("first_start"), F.max("last").alias("last_start"))
    )


def ensure_page_index(spark: SparkSession, table: str, location: str | None = None) -> None:
    place = f" LOCATION '{location.rstrip('/')}/{table}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({PAGE_INDEX_DDL}) USING parquet{place}")


def index_new_pages(spark: SparkSession, landing: str, table: str, checkpoint: str, multi_line: bool = False) -> StreamingQuery:
    """Adds the files that arrived since the last call to the index `table`, then stops.

    A batch that is repeated after a failure may leave two rows of one file, which say the same.
    """
    pages = spark.readStream.schema(RUN_PAGE_DDL).option("multiLine", multi_line).option("mode", "FAILFAST").json(landing)

    def add(batch: DataFrame, _batch_id: int) -> None:
        page_index(batch).select(*PAGE_INDEX_COLUMNS).write.insertInto(table)

    # The metadata of a file goes with its rows.
    pages = pages.select("runs", "_metadata")
    return pages.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def files_of_window(spark: SparkSession, landing: str, index: DataFrame, as_of: dt.datetime | int, days_back: int = 1) -> list[str]:
    """Files below `landing` that may hold runs of the look-back: those whose starts meet it, and those that `index` does not know.

    A file that was written again since it was indexed counts as unknown. Files are listed, not opened; the list of those to open is
    held by the driver, as for any scan.
    """
    until = instant_ms(as_of)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    listed = listed.select(F.col("path").alias("listed"), F.col("modificationTime").alias("written"))
    known = index.dropDuplicates(["file", "modified"])
    same = (F.col("listed") == F.col("file")) & (F.col("written") == F.col("modified"))
    meets = (F.col("last_start") >= until - days_back * DAY_MS) & (F.col("first_start") <= until)
    found = listed.join(known, same, "left_outer").where(F.col("file").isNull() | meets)
    return [row["listed"] for row in found.select("listed").collect()]


def read_runs_indexed(
    spark: SparkSession, landing: str, index: DataFrame, as_of: dt.datetime | int, days_back: int = 1, multi_line: bool = False
) -> DataFrame:
    """Raw runs started within `days_back` days before `as_of`, from the files that may hold some; the others are not opened."""
    files = files_of_window(spark, landing, index, as_of, days_back)
    if not files:
        return spark.createDataFrame([], RUN_PAGE_DDL).select(F.inline("runs"))
    return runs_lookback(read_runs(spark, files, multi_line=multi_line), as_of, days_back)
