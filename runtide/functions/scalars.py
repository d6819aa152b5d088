"""Scalar column functions: nested lookup, clocks, durations and SLA tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def path_get(source: DataFrame | T.StructType, path: str, cast_type: str | None = None) -> Column:
    """The value at a `/`-separated path below the columns of `source`, null if any step is missing.

    Steps may cross structs, maps, JSON text and variants; the schema of `source` says which, so a
    field that this source does not have at all is a null constant rather than an error. Empty
    steps are skipped. An empty object counts as missing.
    """
    return F.expr(path_sql(source, path, cast_type))


def path_sql(source: DataFrame | T.StructType, path: str, cast_type: str | None = None) -> str:
    """`path_get` as SQL text, for `selectExpr` of many paths at once."""
    kind = source if isinstance(source, T.StructType) else source.schema
    missing = f"cast(null as {cast_type or 'string'})"
    steps = [step for step in path.split("/") if step]
    text = "" if steps else missing
    for at, step in enumerate(steps):
        if isinstance(kind, T.StructType) and step in kind.names:
            text += ("." if text else "") + "`" + step.replace("`", "``") + "`"
            kind = kind[step].dataType
        elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            text, kind = f"{text}[{_literal(step)}]", kind.valueType
        elif isinstance(kind, (T.StringType, T.VariantType)):
            text, kind = _path_in_document(text, kind, steps[at:]), T.NullType()
            break
        else:
            text, kind = missing, T.NullType()
            break
    if isinstance(kind, T.StructType) and steps:
        text = f"case when to_json({text}) <> '{{}}' then {text} end"
    elif isinstance(kind, T.MapType):
        text = f"case when size({text}) > 0 then {text} end"
    return f"cast({text} as {cast_type})" if cast_type else text


def _path_in_document(text: str, kind: T.DataType, steps: list[str]) -> str:
    if isinstance(kind, T.StringType):
        place = _literal("$" + "".join(f"['{step}']" for step in steps))
        return f"nullif(get_json_object({text}, {place}), '{{}}')"
    place = _literal("$" + "".join(f'["{step}"]' for step in steps))
    return f"nullif(try_variant_get({text}, {place}, 'string'), '{{}}')"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def zero_as_null(number: Column | str) -> Column:
    return F.nullif(as_column(number), F.lit(0))


def local_clock(ms: Column | str, tz: str) -> Column:
    """Epoch milliseconds -> zone-less wall clock in `tz`; null and 0 -> null.

    The shift is done on the number of microseconds, so the session zone plays no part. For a
    constant zone `from_utc_timestamp` resolves it once per task, `convert_timezone` once per row.
    """
    shifted = F.unix_micros(F.from_utc_timestamp(F.timestamp_millis(zero_as_null(ms)), tz))
    return F.timestamp_add("MICROSECOND", shifted, F.lit("1970-01-01").cast("timestamp_ntz"))


def minutes_1(ms: Column | str) -> Column:
    """Non-negative milliseconds -> minutes to one decimal, halves up; null and 0 -> null.

    Rounding is done in integers, so it is exact; binary doubles would round 9000 ms down.
    """
    shifted = zero_as_null(ms) + 3000
    return ((shifted - shifted % 6000) / F.lit(60000.0)).cast("float")


def or_default(value: Column | str, text: str) -> Column:
    """`text` in place of null and the empty string."""
    return F.coalesce(F.nullif(as_column(value), F.lit("")), F.lit(text))


def clock_text(value: Column | str, suffix: str = " EST") -> Column:
    """`h:mm AM/PM` plus `suffix`; null stays null."""
    return F.concat(F.date_format(as_column(value), "h:mm a"), F.lit(suffix))


def minute_of_day(value: Column | str) -> Column:
    value = as_column(value)
    return F.hour(value) * 60 + F.minute(value)


def parse_sla(value: Column | str, suffix: str = " EST") -> Column:
    """SLA text such as `4:30 AM EST` -> that time on 1970-01-01; null if it cannot be read."""
    text = F.replace(as_column(value), F.lit(suffix), F.lit(""))
    return F.try_to_timestamp(text, F.lit("h:mm a")).cast("timestamp_ntz")


def on_epoch_day(value: Column | str) -> Column:
    """Hour and minute of `value` on 1970-01-01, seconds dropped."""
    value = as_column(value)
    epoch = [F.lit(part) for part in (1970, 1, 1)]
    return F.make_timestamp_ntz(*epoch, F.hour(value), F.minute(value), F.lit(0))


def sla_met(latest: Column | str, sla: Column | str) -> Column:
    """`Y` if the minute of day of `latest` is at or before that of `sla`, else `N`.

    Only times of day are compared: a finish after midnight counts as early on the next day.
    """
    return F.when(minute_of_day(latest) <= minute_of_day(sla), "Y").otherwise("N")
