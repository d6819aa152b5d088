"""Scan of landed run-list payloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runtide.functions.clock import BUSINESS_ZONE, stamp
from runtide.schema import PAGE_TEXT, QUARANTINE_COLUMNS, RUN_PAGE_DDL


def read_runs(
    spark: SparkSession, path: str | list[str], format: str = "json", multi_line: bool = False, pages: Column | str | None = None
) -> DataFrame:
    """Raw runs, one nested row each, from the pages landed below `path`.

    `"json"`: each document is one page, `{"runs": [...]}`, on a line of its own, so that large
    files are split; `multi_line=True` reads pretty-printed files of one page each. Any other
    format holds one run per row, with the names and nesting of the payload, and gets column
    pruning and filters on `start_time` down to its row groups. Missing keys are null; text that
    is no JSON is an error.

    `pages` is a condition on the folder columns of the landing (such as `day >= '2024-01-14'` below `day=...`). It is
    applied before pages are opened, so a look-back reads its own folders only.
    """
    if format != "json":
        landed = spark.read.format(format).load(path)
        return landed if pages is None else landed.where(pages)
    landed = spark.read.schema(RUN_PAGE_DDL).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    return runs_of_pages(landed if pages is None else landed.where(pages))


def read_pages(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, pages: Column | str | None = None, stream: bool = False
) -> DataFrame:
    """The pages below `path`, broken ones among them: `runs`, the text of a page that is broken (else null), its file and folder columns.

    A page is broken if it is no JSON or does not have the types of the payload. `stream=True` follows the folder.
    """
    reader = (spark.readStream if stream else spark.read).schema(f"{RUN_PAGE_DDL}, {PAGE_TEXT} string")
    options = {"multiLine": multi_line, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": PAGE_TEXT}
    landed = reader.options(**options).json(path).withColumn("file", F.col("_metadata.file_path"))
    return landed if pages is None else landed.where(pages)


def sound_runs(pages: DataFrame) -> DataFrame:
    """One row per run of the pages that are not broken."""
    return runs_of_pages(pages.where(F.col(PAGE_TEXT).isNull()))


def broken_pages(pages: DataFrame, as_of: dt.datetime | int, tz: str = BUSINESS_ZONE) -> DataFrame:
    """The broken pages as rows of a quarantine table: file, text and when they were found."""
    # `runs` is named too: Spark reads the text of a broken record only beside another column.
    broken = pages.where(F.col(PAGE_TEXT).isNotNull() & F.coalesce(F.size("runs") >= -1, F.lit(True)))
    return broken.select("file", F.col(PAGE_TEXT).alias("page"), stamp(as_of, tz).alias("QuarantinedOn")).select(*QUARANTINE_COLUMNS)


def quarantine(broken: DataFrame, table: str) -> None:
    """Appends broken pages to the quarantine `table`, each text of a file once however often it is read."""
    seen = broken.sparkSession.table(table).select(F.col("file").alias("seen_file"), F.col("page").alias("seen_page"))
    same = (F.col("file") == F.col("seen_file")) & (F.col("page") == F.col("seen_page"))
    fresh = broken.dropDuplicates(["file", "page"]).join(seen, same, "left_anti")
    fresh.select(*QUARANTINE_COLUMNS).write.insertInto(table)


def runs_of_pages(pages: DataFrame) -> DataFrame:
    """One row per run of the payload pages; an empty page gives none."""
    return pages.select(F.inline("runs"))


def land_pages(
    runs: DataFrame, page: Column, path: str, partition_by: tuple[str, ...] = (), files: int | None = None
) -> None:
    """Writes raw runs below `path` as JSON pages, one for each value of `page`, pages dealt to at most `files` files, if given.

    A page is gathered in one row, so `page` must bound its size, as an API page limit does.
    """
    fields = [name for name in runs.columns if name not in partition_by]
    pages = runs.groupBy(*partition_by, page.alias("page")).agg(F.collect_list(F.struct(*fields)).alias("runs"))
    if files:
        pages = pages.repartition(files, "page")
    pages.drop("page").write.partitionBy(*partition_by).json(path)
