"""Column functions that make report text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from runtide.functions.scalars import as_column

# Every character that counts as white space at the ends of a cell.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Cell texts that get a colour, and the style sheet of the report.
NOT_STARTED_TEXTS = ("NOT STARTED",)
FAIL_TEXTS = ("FAILED", "N")
SUCCESS_TEXTS = ("SUCCESS", "Y", "COMPLETED")
SUCCESS_MARK = "COMPLETED"
STYLE_SHEET = """
<style>
#tableformatting table, table th, table td {
    font-size: 10pt;
    border: 1px solid black;
    border-collapse: collapse;
    text-align: left;
    padding: 5px;
}
thead { background-color: yellow; }
table { border-collapse: collapse; }
.success { background-color: green; }
.fail { background-color: Orange; }
</style>
"""
SUBJECT_PREFIX = "Prod - EDW - Data refresh - "
INTRO_OPENING = "Hello All,<br><br>Data refresh for "
FAILURE_CLOSING = " layer tables has failed. Below are the failed refresh timings.<br>"
SUCCESS_CLOSING = " layer tables has completed successfully.<br>"
# End of fixed values.


def date_label(day: Column | str) -> Column:
    """A date with its English ordinal, such as `1st July 2024`."""
    day = as_column(day)
    number = F.dayofmonth(day)
    last = F.when(number.between(11, 13), 0).otherwise(number % 10)
    ordinal = F.when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(number.cast("string"), ordinal, F.date_format(day, " MMMM yyyy"))


def recipients(addresses: Column | str, sep: str = ";") -> Column:
    """Separated addresses -> array, each trimmed."""
    pieces = F.split(as_column(addresses), f"\\Q{sep}\\E", -1)
    return F.transform(pieces, lambda piece: F.btrim(piece, F.lit(WHITE_SPACE)))


def cell_class(value: Column | str) -> Column:
    """Style class of a report cell (`not-started`, `fail`, `success`), null for plain cells."""
    shown = F.upper(F.btrim(as_column(value).cast("string"), F.lit(WHITE_SPACE)))
    return (
        F.when(shown.isin(*NOT_STARTED_TEXTS), "not-started")
        .when(shown.isin(*FAIL_TEXTS), "fail")
        .when(shown.isin(*SUCCESS_TEXTS) | shown.contains(SUCCESS_MARK), "success")
    )


def escape_html(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&#39;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def html_cell(value: Column | str, escape: bool = False) -> Column:
    """One `<td>`; null shows as `None`."""
    text = as_column(value).cast("string")
    shown = F.coalesce(escape_html(text) if escape else text, F.lit("None"))
    style = F.coalesce(F.concat(F.lit(" class='"), cell_class(text), F.lit("'")), F.lit(""))
    return F.concat(F.lit("<td"), style, F.lit(">"), shown, F.lit("</td>"))


def name_list(names: Column) -> Column:
    """An array of names as a phrase in case-blind order: `""`, `A`, `A and B`, `A, B and C`."""
    keyed = F.array_sort(F.transform(names, lambda n: F.struct(F.lower(n).alias("key"), n.alias("name"))))
    ordered = F.transform(keyed, lambda item: item["name"])
    size = F.size(ordered)
    head = F.array_join(F.slice(ordered, F.lit(1), F.greatest(size - 1, F.lit(0))), ", ")
    last = F.coalesce(F.try_element_at(ordered, F.lit(-1)), F.lit(""))
    return F.when(size < 2, last).otherwise(F.concat(head, F.lit(" and "), last))


def subject(day: dt.date | Column, prefix: str = SUBJECT_PREFIX) -> Column:
    """Subject line of a report for `day`."""
    return F.concat(F.lit(prefix), date_label(day if isinstance(day, Column) else F.lit(day)))


def failure_intro(layers: Column) -> Column:
    """Opening text of a failure report about the layers named by the phrase `layers`."""
    return F.concat(F.lit(INTRO_OPENING), layers, F.lit(FAILURE_CLOSING))


def success_intro(layers: Column) -> Column:
    """Opening text of a success report about the layers named by the phrase `layers`."""
    return F.concat(F.lit(INTRO_OPENING), layers, F.lit(SUCCESS_CLOSING))
