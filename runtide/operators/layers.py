"""Status of each data layer: counts, latest finish, SLA test, gate and label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.functions.clock import BUSINESS_ZONE
from runtide.functions.scalars import clock_text, on_epoch_day, parse_sla, sla_met
from runtide.functions.text import name_list

# Fixed value: runs that do not count for the finish time of a layer.
NOT_COUNTED_FOR_FINISH = ("DE-Bronze-Audit_Smartsheets",)


def layer_status(
    status: DataFrame,
    excluded: Sequence[str] = NOT_COUNTED_FOR_FINISH,
    second_shift: bool = True,
    tz: str = BUSINESS_ZONE,
) -> DataFrame:
    """Counts, latest finish, status and SLA test for each (layer, SLA).

    `end_time_in_est` is already local. `second_shift=True` moves it from UTC to `tz` once more,
    which puts the latest finish four or five hours too early; `False` leaves it as it is.

    Rows are first reduced to one per dependency name, before and after the shuffle. The counts of
    distinct names are then plain sums, since a row's run name is its dependency name or null.
    """
    finished = F.when(~F.col("run_name").isin(*excluded), F.col("end_time_in_est"))
    by_name = status.groupBy("layer", "SLA", "DependsOn").agg(
        F.bool_or(F.col("run_name").isNotNull()).alias("ran"),
        F.bool_or(F.col("result_state") == "SUCCESS").alias("succeeded"),
        F.bool_or(F.col("result_state") != "SUCCESS").alias("failed"),
        F.max(finished).alias("finish"),
    )
    by_layer = by_name.groupBy(F.col("layer").alias("Layer"), "SLA").agg(
        F.count("DependsOn").alias("DependsOnWorkflowCount"),
        F.count_if("ran").alias("RunWorkflowCount"),
        F.count_if("succeeded").alias("SuccessCount"),
        F.count_if("failed").alias("FailCount"),
        F.max("finish").alias("LatestRunTime"),
    )
    if second_shift:
        shifted = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col("LatestRunTime"))
        by_layer = by_layer.withColumn("LatestRunTime", shifted)
    complete = F.col("DependsOnWorkflowCount") == F.col("SuccessCount")
    return by_layer.select(
        "*",
        clock_text("LatestRunTime").alias("LatestRunTime_only"),
        F.when(complete, "Completed").otherwise("Failed").alias("Status"),
        parse_sla("SLA").alias("SLA_ts"),
        on_epoch_day("LatestRunTime").alias("LatestRunTime_ts"),
        sla_met("LatestRunTime", parse_sla("SLA")).alias("SLA_MET"),
        F.lit("").alias("Comment"),
    )


def layer_report(layers: DataFrame) -> DataFrame:
    """Layer status under the titles of the report, in order of layer."""
    return layers.orderBy("Layer").select(
        F.col("Layer").alias("Data Layer"),
        "SLA",
        F.col("LatestRunTime_only").alias("Completion Time"),
        "Status",
        F.col("SLA_MET").alias("SLA Met(Y/N)"),
        "Comment",
    )


def failure_report(failed: DataFrame) -> DataFrame:
    """Distinct failed runs under the titles of the report, in order of SLA text, name and id."""
    return (
        failed.select(
            F.col("run_name").alias("WorkflowName"),
            F.col("run_id").alias("RunId"),
            F.col("layer").alias("Layer"),
            "SLA",
            F.col("result_state").alias("Status"),
            F.col("state_message").alias("StatusMessage"),
        )
        .distinct()
        .orderBy("SLA", "WorkflowName", "RunId")
    )


def all_layers_gate(layers: DataFrame) -> DataFrame:
    """One row: number of layers, number of complete ones, and whether the success report is due."""
    counts = layers.agg(
        F.count(F.lit(1)).alias("total_layers"),
        F.count_if(F.col("DependsOnWorkflowCount") == F.col("SuccessCount")).alias("matched_layers"),
    )
    is_open = (F.col("total_layers") == F.col("matched_layers")) & (F.col("total_layers") > 0)
    return counts.withColumn("gate_open", is_open)


def layer_label(df: DataFrame, column: str = "layer") -> DataFrame:
    """One row: the distinct names in `column` as a phrase, `A, B and C`.

    Names are made distinct before they are gathered; the phrase itself is what bounds the row.
    """
    return df.select(column).distinct().agg(name_list(F.collect_list(column)).alias("layer_label"))
