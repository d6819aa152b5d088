"""Distinct counts of a layer that add up over days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.operators.report import numbered

#: What is counted: column of the bitmap, and the condition on a status row.
MARKS = {"ran": "run_name is not null", "succeeded": "result_state = 'SUCCESS'", "failed": "result_state <> 'SUCCESS'"}


def name_numbers(names: DataFrame, known: DataFrame | None = None, column: str = "DependsOn") -> DataFrame:
    """(`column`, number): the names of `known` with their numbers, and the other distinct ones numbered on from them.

    Numbers are dense, so bitmaps stay short, and never change. No task numbers all names.
    """
    fresh = names.select(column).where(F.col(column).isNotNull()).distinct()
    if known is None:
        return numbered(fresh, [F.col(column)]).select(column, F.col("position").alias("number"))
    after = known.agg((F.coalesce(F.max("number"), F.lit(-1)) + 1).alias("after")).first()["after"]
    fresh = numbered(fresh.join(known, column, "left_anti"), [F.col(column)])
    return known.select(column, "number").unionByName(fresh.select(column, (F.col("position") + after).alias("number")))


def layer_bitmaps(status: DataFrame, numbers: DataFrame, by: Sequence[str] = ("layer", "SLA", "day")) -> DataFrame:
    """`by`, bucket, and one bitmap each of the dependency names that occur, ran, succeeded and failed, from status rows.

    One pass over the rows: bitmaps of 32,768 numbers are made by each task for its rows and merged. They are exact, and unlike counts of
    distinct names they can be merged again, over days or layers, without the rows; see `counts_of_bitmaps`.
    """
    marked = status.join(numbers, "DependsOn")
    bit = F.bitmap_bit_position("number")
    # A row that lacks a mark sets none: the aggregate passes over nulls.
    found = {name: F.bitmap_construct_agg(F.when(F.expr(condition), bit)) for name, condition in MARKS.items()}
    return marked.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("depended"), *(bitmap.alias(name) for name, bitmap in found.items())
    )


def counts_of_bitmaps(bitmaps: DataFrame, by: Sequence[str] = ("layer", "SLA")) -> DataFrame:
    """The distinct counts of `layer_status` for any coarser grouping `by` of `layer_bitmaps`."""
    columns = ("depended", *MARKS)
    merged = bitmaps.groupBy(*by, "bucket").agg(*(F.bitmap_or_agg(name).alias(name) for name in columns))
    names = ("DependsOnWorkflowCount", "RunWorkflowCount", "SuccessCount", "FailCount")
    counts = [F.sum(F.bitmap_count(name)).alias(shown) for name, shown in zip(columns, names, strict=True)]
    return merged.groupBy(*by).agg(*counts)
