"""The log tables: creation, reads, the run log upsert and appends."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtide.functions.clock import BUSINESS_ZONE
from runtide.operators.runlog import KEY, has_key, latest_of_key, run_log_rows, upsert_rows
from runtide.plans.lineage import settle
from runtide.schema import (
    BODY,
    CYCLE_DDL,
    ENTRY_COLUMNS,
    ENTRY_DDL,
    JOURNAL_DDL,
    NOTIFICATION_COLUMNS,
    NOTIFICATION_LOG_DDL,
    NOTIFICATION_PARTITION,
    OUTBOX_COLUMNS,
    OUTBOX_DDL,
    RUN_LOG_COLUMNS,
    RUN_LOG_DDL,
    RUN_LOG_PARTITION,
)


@dataclass(frozen=True)
class TableNames:
    run_log: str = "workflow_run_log"
    notification_log: str = "notification_log"
    outbox: str = "notification_outbox"

    @property
    def entries(self) -> str:
        """The notification log without texts, where these are kept once."""
        return f"{self.notification_log}_entries"

    @property
    def journal(self) -> str:
        return f"{self.outbox}_journal"

    @property
    def cycles(self) -> str:
        return f"{self.outbox}_cycles"


def ensure_tables(
    spark: SparkSession,
    names: TableNames = TableNames(),
    format: str = "parquet",
    location: str | None = None,
    bodies: str = "each_row",
) -> None:
    """Creates the tables that do not exist yet, the logs partitioned by day; in folders below `location`, if given.

    `bodies="each_row"` makes the notification log a table with the text of its message in every row. `"once"` makes it a
    view of the same columns: texts stay in the outbox, entries in a table of their own. A log that
    exists stays what it is. An outbox of an older layout gets the columns it lacks.
    """
    if bodies not in ("each_row", "once"):
        raise ValueError(f"bodies must be 'each_row' or 'once', not {bodies!r}")

    def create(name: str, columns: str, partition: str = "", kind: str = "date") -> None:
        more = f", {partition} {kind}) USING {format} PARTITIONED BY ({partition}" if partition else f") USING {format}"
        place = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}{more}{')' if partition else ''}{place}")

    create(names.run_log, RUN_LOG_DDL, RUN_LOG_PARTITION)
    create(names.outbox, OUTBOX_DDL)
    held = spark.table(names.outbox).columns
    lacking = [c.strip() for c in OUTBOX_DDL.split(",") if c.split()[0] not in held]
    if lacking:
        spark.sql(f"ALTER TABLE {names.outbox} ADD COLUMNS ({', '.join(lacking)})")
    create(names.cycles, CYCLE_DDL)
    create(names.journal, JOURNAL_DDL, "cycle", "string")
    if bodies == "each_row" or spark.catalog.tableExists(names.notification_log) and not bodies_once(spark, names):
        create(names.notification_log, NOTIFICATION_LOG_DDL, NOTIFICATION_PARTITION)
        return
    create(names.entries, ENTRY_DDL, NOTIFICATION_PARTITION)
    shown = ", ".join(f"m.body AS {c}" if c == BODY else f"e.{c}" for c in (*NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION))
    spark.sql(
        f"""CREATE VIEW IF NOT EXISTS {names.notification_log} AS SELECT {shown} FROM {names.entries} e
            LEFT JOIN {names.outbox} m ON e.MessageId = m.message_id"""
    )


def bodies_once(spark: SparkSession, names: TableNames) -> bool:
    """Whether the notification log is a view of entries and messages."""
    return spark.catalog.tableExists(names.entries)


def ensure_bucketed_run_log(spark: SparkSession, name: str, buckets: int, location: str | None = None) -> None:
    """Creates a run log laid out by key within its days, if it does not exist.

    Rows of one key lie in one of `buckets` files of a day. An upsert then joins the log where it lies: only the pull is
    shuffled, into as many partitions as there are buckets. Spark takes this up if `buckets` is not below
    `spark.sql.shuffle.partitions`.
    """
    place = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} ({RUN_LOG_DDL}, {RUN_LOG_PARTITION} date) USING parquet
            PARTITIONED BY ({RUN_LOG_PARTITION}) CLUSTERED BY ({", ".join(KEY)}) INTO {int(buckets)} BUCKETS{place}"""
    )


def write_run_log(
    runs: DataFrame,
    table: str,
    as_of: dt.datetime | int,
    tz: str = BUSINESS_ZONE,
    whole_log: bool = False,
    null_keys: str = "insert",
    older: str = "overwrites",
) -> None:
    """Upserts flat `runs` into the run log `table`, in one write of the partitions it touches.

    A run never changes its start, so what is logged of it lies in the partition of that date, or
    in the one without a date if it was first seen before it started. That one is read for keys of the pull, and rewritten only
    if it has some or the pull has runs that did not start. `whole_log=True` looks for
    matches in every partition and rewrites them all, for logs not written this way. New files
    replace a partition when all are written. An interrupted call can be repeated; rows
    without a full key are then added again unless `null_keys="match"`, see `upsert_rows`.
    """
    spark = runs.sparkSession
    rows = settle(run_log_rows(runs, as_of, tz), "run-log-rows")
    merged = upsert_rows(spark.table(table) if whole_log else _touched(spark.table(table), rows), rows, null_keys, older)
    if not _buckets(spark, table):
        # Few files for each day; a log laid out by key has one for each bucket as it is.
        merged = merged.hint("rebalance", RUN_LOG_PARTITION)
    _insert(merged, table, (*RUN_LOG_COLUMNS, RUN_LOG_PARTITION), overwrite=True)


def _touched(log: DataFrame, rows: DataFrame) -> DataFrame:
    """The partitions of the run log that an upsert of `rows` can change: a day for each calendar day of the pull."""
    partition = F.col(RUN_LOG_PARTITION)
    days = [row[0] for row in rows.select(RUN_LOG_PARTITION).distinct().collect()]
    some = partition.isin([day for day in days if day is not None])
    undated = None in days
    if not undated:
        keys = rows.where(has_key()).select(*KEY)
        undated = not log.where(partition.isNull()).join(keys, list(KEY), "left_semi").isEmpty()
    return log.where(some | partition.isNull() if undated else some)


def _buckets(spark: SparkSession, table: str) -> int:
    """The number of buckets of a table, 0 without any."""
    told = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return int(told.get("Num Buckets", "0"))


def merge_run_log(runs: DataFrame, table: str, as_of: dt.datetime | int, tz: str = BUSINESS_ZONE) -> None:
    """The same upsert as one MERGE, for tables of a format with row-level operations."""
    rows = run_log_rows(runs, as_of, tz)
    rows = latest_of_key(rows.where(has_key())).unionByName(rows.where(~has_key()))
    match = " AND ".join(f"{table}.{name} = new.{name}" for name in KEY)
    written = [name for name in RUN_LOG_COLUMNS if name != "WorkFlowMetSLAFlag"]
    merge = rows.alias("new").mergeInto(table, F.expr(match))
    merge = merge.whenMatched().update({name: F.col(f"new.{name}") for name in written})
    merge.whenNotMatched().insert(
        {name: F.col(f"new.{name}") for name in (*written, RUN_LOG_PARTITION)}
    ).merge()


def append_notifications(rows: DataFrame, table: str) -> None:
    """Appends rows of `notification_rows` to the notification log."""
    _insert(rows, table, (*NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION))


def append_entries(entries: DataFrame, table: str) -> None:
    """Appends entries, which name their messages, to the table of a log that keeps texts once."""
    _insert(entries, table, (*ENTRY_COLUMNS, NOTIFICATION_PARTITION))


def append_outbox(messages: DataFrame, table: str) -> None:
    """Appends messages for an outside mailer to send."""
    _insert(messages, table, OUTBOX_COLUMNS)


def _insert(df: DataFrame, table: str, columns: tuple[str, ...], overwrite: bool = False) -> None:
    df = df.select(*columns)
    if overwrite:
        overwrite_partitions(df, table)
    else:
        df.write.insertInto(table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replaces the partitions of `table` that `df` has rows for, which may be made from them; the others stay.

    Spark takes this mode from the session for tables of the catalog, not from an option of the write; it is set for the write only.
    """
    spark = df.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(setting, before)
