"""SLAs that change over time and that may lie after midnight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtide.functions.scalars import as_column, minute_of_day, parse_sla


def sla_as_of(rows: DataFrame, history: DataFrame, layer: str = "layer", day: str = "day") -> DataFrame:
    """`rows` with `SLA`, the text that held for their `layer` on their `day`; null before the first one.

    `history` has layer, sla_text and valid_from (a date), one row for each change; a text holds until the next one, and a null
    text ends it. An as-of join: the distinct layers and days of the rows, few however many rows there are, are put in line with the changes,
    and the rows are matched by equality with what was found. A layer with most of the rows is one of many days' keys.
    """
    asked = rows.select(F.col(layer).alias("of_layer"), F.col(day).alias("of_day")).distinct()
    changes = history.select(F.col("layer").alias("of_layer"), F.col("valid_from").alias("of_day"), F.struct("sla_text").alias("change"))
    line = Window.partitionBy("of_layer").orderBy("of_day", F.col("change").isNull())
    both = changes.unionByName(asked.where("of_layer is not null and of_day is not null"), allowMissingColumns=True)
    held = both.withColumn("held", F.last("change", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    held = held.where("change is null").select("of_layer", "of_day", F.col("held.sla_text").alias("SLA"))
    same = (F.col(layer) == F.col("of_layer")) & (F.col(day) == F.col("of_day"))
    return rows.join(held, same, "left_outer").drop("of_layer", "of_day")


def sla_deadline(day: Column | str, sla: Column | str, days_after: int = 0) -> Column:
    """The instant on local clocks by which the runs of `day` must have finished; null without a readable SLA text.

    `days_after=1` puts the cut-off on the morning after, for layers that are loaded over midnight.
    """
    midnight = F.date_add(as_column(day), days_after).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", minute_of_day(parse_sla(sla)), midnight)


def sla_met_by(finish: Column | str, deadline: Column | str) -> Column:
    """`Y` for a finish within the minute of the deadline or before, else `N`, null finishes and deadlines among them.

    Unlike `sla_met`, which compares times of day, a finish after midnight of the next day is late.
    """
    late_from = F.timestamp_add("MINUTE", F.lit(1), as_column(deadline))
    return F.when(as_column(finish) < late_from, "Y").otherwise("N")
