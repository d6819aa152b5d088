"""HTML reports as DataFrames: numbered lines, shown in parts of consecutive positions."""

from __future__ import annotations

import html
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtide.functions.text import STYLE_SHEET, html_cell
from runtide.plans.lineage import settle

ROWS_PER_PART = 1000

# Texts of the report frame.
TABLE_OPEN = "<br><br><table border='1'><thead><tr>"
SECOND_TITLE = "<br><br>SFTP Workflow Status"
SIGNATURE = "Team Data Integration"


def html_row(df: DataFrame, escape: bool = False) -> Column:
    """The `<tr>` of a row of `df`; booleans show as `True` / `False`."""
    values = [
        F.initcap(F.col(f"`{field.name}`").cast("string"))
        if isinstance(field.dataType, T.BooleanType)
        else F.col(f"`{field.name}`").cast("string")
        for field in df.schema
    ]
    cells = F.transform(F.array(*values), lambda value: html_cell(value, escape))
    return F.concat(F.lit("<tr>"), F.array_join(cells, ""), F.lit("</tr>"))


def numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """`df` with `position`, from 0, in the order of the columns `order`.

    Rows are sorted in ranges and numbered within each; only one count for each range is needed to place them, so no
    task numbers all rows. Settled, so numbers stay what they are.
    """
    ranges = settle(df.orderBy(*order).withColumn("id", F.monotonically_increasing_id()), "numbered")
    ranges = ranges.withColumn("range", F.shiftright("id", 33)).withColumn("at", F.expr("id & 8589934591L"))
    ahead, before = 0, []
    for number, rows in ranges.groupBy("range").agg(F.count(F.lit(1))).orderBy("range").collect():
        before.append((number, ahead))
        ahead += rows
    starts = df.sparkSession.createDataFrame(before, "range bigint, ahead bigint")
    columns = [F.col(f"`{name}`") for name in df.columns]
    return ranges.join(starts, "range").select(*columns, (F.col("ahead") + F.col("at")).alias("position"))


def numbered_lines(
    df: DataFrame, order: Sequence[str], escape: bool = False, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """`df` with `line` (its `<tr>`), `position` (from 0, ascending by `order`, ties by line) and `part`.

    A part is `rows_per_part` consecutive positions.
    """
    rows = df.select("*", html_row(df, escape).alias("line"))
    lines = numbered(rows, [*(F.col(f"`{name}`") for name in order), F.col("line")])
    return lines.withColumn("part", F.floor(F.col("position") / rows_per_part).cast("int"))


def html_table(
    df: DataFrame,
    order: Sequence[str],
    escape: bool = False,
    rows_per_part: int = ROWS_PER_PART,
    lines: DataFrame | None = None,
) -> DataFrame:
    """`df` as HTML tables (part, parts, html), rows ascending by `order` within and across parts.

    The parts one after another are the one sorted table at any size; a part bounds the length of a text and of what a
    task gathers, and no row is dropped. `lines` are the `numbered_lines` of `df`, if they are at hand.
    """
    titles = (f"<th>{html.escape(name) if escape else name}</th>" for name in df.columns)
    head = F.lit(TABLE_OPEN + "".join(titles) + "</tr></thead><tbody>")
    lines = numbered_lines(df, order, escape, rows_per_part) if lines is None else lines
    count = lines.agg(F.greatest(F.coalesce(F.max("part") + 1, F.lit(1)), F.lit(1)).cast("int").alias("parts"))
    parts = count.select(F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts")
    rows = lines.groupBy(F.col("part").alias("row_part")).agg(
        F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines")
    )
    body = F.coalesce(F.array_join(F.col("lines.line"), ""), F.lit(""))
    return parts.join(rows, F.col("part") == F.col("row_part"), "left_outer").select(
        "part", "parts", F.concat(head, body, F.lit("</tbody></table>")).alias("html")
    )


def html_report(
    df: DataFrame,
    intro: Column | str,
    order: Sequence[str],
    second: DataFrame | None = None,
    second_order: Sequence[str] | None = None,
    signature: str = SIGNATURE,
    escape: bool = False,
    rows_per_part: int = ROWS_PER_PART,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Full message bodies (part, parts, body): intro, style sheet, table, signature.

    `second` adds a second, titled table ordered by `second_order` (default: its columns). `intro`
    may be a column, such as one made from the scalar of `layer_label`. `lines` are the `numbered_lines` of
    `df`, if they are at hand.
    """
    tables = html_table(df, order, escape, rows_per_part, lines)
    style = F.lit(STYLE_SHEET)
    shown = F.concat(style, F.col("html"))
    if second is not None:
        extra = html_table(second, second_order or second.columns, escape, rows_per_part).select(
            "part", F.col("parts").alias("second_parts"), F.col("html").alias("second_html")
        )
        # The longer table has every part number, so its count is on every row of the join.
        tables = tables.join(extra, "part", "full_outer").withColumn("parts", F.greatest("parts", "second_parts"))
        second_shown = F.concat(F.lit(SECOND_TITLE), style, F.col("second_html"))
        shown = F.concat(F.coalesce(shown, F.lit("")), F.coalesce(second_shown, F.lit("")))
    opening = intro if isinstance(intro, Column) else F.lit(intro)
    closing = F.lit(f"<br><br>Thank you,<br>{signature}")
    return tables.select("part", "parts", F.concat(opening, shown, closing).alias("body"))
