"""The whole monitoring job: from runs, dependencies and logs to status, reports and log rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtide.functions.clock import BUSINESS_ZONE, business_day, stamp
from runtide.functions.text import failure_intro, recipients, subject, success_intro
from runtide.operators.layers import (
    NOT_COUNTED_FOR_FINISH,
    all_layers_gate,
    failure_report,
    layer_label,
    layer_report,
    layer_status,
)
from runtide.operators.notify import message_id, notification_entries, with_bodies
from runtide.operators.report import ROWS_PER_PART, html_report, numbered_lines
from runtide.operators.runs import flatten_runs, runs_lookback, runs_today_latest
from runtide.operators.status import (
    dependency_needs,
    dependency_status,
    effective_state,
    failed_runs,
    not_yet_notified,
    notified_today,
    sla_by_layer,
)
from runtide.plans.lineage import settle, settle_counted
from runtide.schema import OUTBOX_COLUMNS
from runtide.sources.dependencies import SLA_BY_LAYER
from runtide.sources.journal import apply_cycle, record_cycle, replay_cycles
from runtide.sources.tables import TableNames, ensure_tables, write_run_log

# Columns of the flat runs that status and reports use, and those that only the run log uses.
STATUS_COLUMNS = (
    "run_id",
    "job_id",
    "run_name",
    "attempt_number",
    "start_time_in_ms",
    "end_time_in_ms",
    "end_time_in_est",
    "result_state",
    "state_message",
)
LOG_COLUMNS = ("start_time_in_est", "run_duration_min", "trigger")


def settled_today(
    runs: DataFrame, as_of: dt.datetime | int, tz: str = BUSINESS_ZONE, days_back: int = 1
) -> DataFrame:
    """The runs of the day that count, from flat runs: the end of the long scan.

    Everything after it works on at most one narrow row per job, and uses it more than once, so it
    is settled.
    """
    pulled = runs_lookback(runs, as_of, days_back).select(*STATUS_COLUMNS)
    return settle(runs_today_latest(pulled, business_day(as_of, tz), tz), "today")


def open_status(today: DataFrame, deps: DataFrame, sla: DataFrame | Mapping[str, str]) -> DataFrame:
    """Status of every needed (layer, dependency) by the runs of the day; nothing left out yet."""
    return effective_state(dependency_status(sla_by_layer(dependency_needs(deps), sla), today))


def monitor(
    runs: DataFrame,
    deps: DataFrame,
    sla: DataFrame | Mapping[str, str],
    log: DataFrame,
    as_of: dt.datetime | int,
    tz: str = BUSINESS_ZONE,
    days_back: int = 1,
    dedupe: str = "before_status",
    failure_dedupe: str = "job",
    second_shift: bool = True,
    excluded: Sequence[str] = NOT_COUNTED_FOR_FINISH,
    failure_recipients: str = "",
    success_recipients: str = "",
    rows_per_part: int = ROWS_PER_PART,
    subject_prefix: str | None = None,
    escape: bool = False,
    success_cc: str | None = None,
) -> dict[str, DataFrame]:
    """Everything that one scheduled run finds out, as frames; nothing is written to the logs.

    `runs` are flat runs, `log` is the notification log. `dedupe="before_status"` leaves out what
    was notified today before layers are counted, so that a layer whose failures were all notified
    counts as complete; `"after_status"` counts all and leaves out afterwards.

    Success messages go to their recipients in copy, too, unless `success_cc` names others (`""`: nobody).

    Runs and log are read once, settled, and every output is made from that snapshot. Lines of a report are numbered
    once, for its text and to tell in which part a row was reported. `entries` are the rows of the notification log
    with the id of their message; `notification_rows` are the same with its text.
    """
    if dedupe not in ("before_status", "after_status"):
        raise ValueError(f"dedupe must be 'before_status' or 'after_status', not {dedupe!r}")
    day = business_day(as_of, tz)
    today = settled_today(runs, as_of, tz, days_back)
    notified = settle(notified_today(log, day), "notified")
    status = settle(open_status(today, deps, sla), "status")
    fresh = settle(not_yet_notified(status, notified), "fresh")

    layers = settle(layer_status(fresh if dedupe == "before_status" else status, excluded, second_shift, tz), "layers")
    gate = all_layers_gate(layers)
    report = layer_report(layers)
    failure_order, success_order = ["SLA", "WorkflowName", "RunId"], ["Data Layer"]
    failed = failed_runs(fresh, notified, failure_dedupe)
    failures = settle(failure_report(failed), "failures")
    failure_lines = numbered_lines(failures, failure_order, escape, rows_per_part)
    success_lines = numbered_lines(report, success_order, escape, rows_per_part)

    failure_body = html_report(
        failures,
        failure_intro(layer_label(failures, "Layer").scalar()),
        failure_order,
        lines=failure_lines,
    ).where(failures.agg(F.count(F.lit(1)) > 0).scalar())
    success_body = html_report(
        report,
        success_intro(layer_label(layers, "Layer").scalar()),
        success_order,
        lines=success_lines,
    ).where(gate.select("gate_open").scalar())
    if dedupe == "after_status":
        # The gate counts what was notified before, too: without anything new to tell, it is told once.
        success_body = success_body.where(fresh.agg(F.count("job_id") > 0).scalar())

    def message(kind: str, body: DataFrame, to: str, cc: str) -> DataFrame:
        made = {
            "kind": F.lit(kind),
            "subject": subject(day) if subject_prefix is None else subject(day, subject_prefix),
            "recipients": recipients(F.lit(to)),
            "CreatedOn": stamp(as_of, tz),
            "message_id": message_id(kind, day),
            "cc": recipients(F.lit(cc)) if cc else F.array().cast("array<string>"),
        }
        return body.select(*(made.get(name, F.col(name)).alias(name) for name in OUTBOX_COLUMNS))

    def reported_in(rows: DataFrame, lines: DataFrame, same: dict[str, str]) -> DataFrame:
        """`rows` with the part in which the line of each was reported first."""
        named = [F.col(f"`{line}`").alias(f"line_{row}") for row, line in same.items()]
        parts = lines.groupBy(*named).agg(F.min("part").alias("part"))
        match = [F.col(row).eqNullSafe(F.col(f"line_{row}")) for row in same]
        return rows.join(parts, match).drop(*(f"line_{row}" for row in same))

    copied = success_recipients if success_cc is None else success_cc
    outbox = settle(
        message("failure", failure_body, failure_recipients, "").unionByName(
            message("success", success_body, success_recipients, copied)
        ),
        "messages",
    )
    failure_entries = notification_entries(
        reported_in(failed, failure_lines, {"run_id": "RunId", "run_name": "WorkflowName", "layer": "Layer", "SLA": "SLA"}),
        "result_state", failure_recipients, outbox.where("kind = 'failure'"), as_of, tz,
    )
    success_entries = notification_entries(
        reported_in(fresh, success_lines, {"layer": "Data Layer", "SLA": "SLA"}),
        "result_state", success_recipients, outbox.where("kind = 'success'"), as_of, tz,
    )
    entries = failure_entries.unionByName(success_entries)
    return {
        "today": today,
        "status": fresh,
        "layers": layers,
        "report": report,
        "gate": gate,
        "failed": failed,
        "failure_report": failures.orderBy(*failure_order),
        "outbox": outbox,
        "entries": entries,
        "notification_rows": with_bodies(entries, outbox),
    }


def prepare_cycle(
    raw: DataFrame,
    deps: DataFrame,
    as_of: dt.datetime | int,
    tables: TableNames = TableNames(),
    sla: DataFrame | Mapping[str, str] = SLA_BY_LAYER,
    tz: str = BUSINESS_ZONE,
    days_back: int = 1,
    null_keys: str = "insert",
    older: str = "overwrites",
    **options,
) -> tuple[dict[str, DataFrame], str]:
    """The first half of `run_cycle`: what it found, and the name under which its messages and entries are recorded."""
    spark: SparkSession = raw.sparkSession
    ensure_tables(spark, tables, bodies="once")
    replay_cycles(spark, tables)
    pulled = flatten_runs(runs_lookback(raw, as_of, days_back)).select(*STATUS_COLUMNS, *LOG_COLUMNS)
    runs, pulled_runs = settle_counted(pulled, "pull")
    write_run_log(runs, tables.run_log, as_of, tz, null_keys=null_keys, older=older)
    found = monitor(runs, deps, sla, spark.table(tables.notification_log), as_of, tz, days_back, **options)
    found["run_count"] = spark.createDataFrame([(pulled_runs,)], "run_count bigint")
    return found, record_cycle(found["outbox"], found["entries"], tables, business_day(as_of, tz))


def run_cycle(
    raw: DataFrame,
    deps: DataFrame,
    as_of: dt.datetime | int,
    tables: TableNames = TableNames(),
    sla: DataFrame | Mapping[str, str] = SLA_BY_LAYER,
    tz: str = BUSINESS_ZONE,
    days_back: int = 1,
    **options,
) -> dict[str, DataFrame]:
    """One scheduled run with its writes: logs the runs pulled, fills the outbox, logs notifications.

    `raw` comes from `read_runs`, whose `pages` limit what is opened. The pull is settled, so that log and reports see
    the same runs even while more are landing; `run_count` tells how many they are.

    Every message reaches the outbox once and every notification the log once, wherever an earlier call was stopped:
    what is to be written is recorded first, and a call begins by completing what was recorded and is missing. Reports that were
    notified today are not repeated. One call at a time. Runs without a full key are added to the run log at each
    call unless `null_keys="match"`; `older="kept"` keeps logged ends, see `upsert_rows`. Other options are those of `monitor`.
    """
    found, cycle = prepare_cycle(raw, deps, as_of, tables, sla, tz, days_back, **options)
    apply_cycle(raw.sparkSession, tables, cycle)
    return found
