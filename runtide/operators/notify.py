"""Rows of the notification log and its audit query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtide.functions.clock import BUSINESS_ZONE, business_day, stamp
from runtide.schema import BODY, ENTRY_COLUMNS, NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION, OUTBOX_COLUMNS


def notification_rows(
    df: DataFrame,
    event_type_col: str,
    recipients: str,
    body: str | DataFrame,
    as_of: dt.datetime | int,
    tz: str = BUSINESS_ZONE,
) -> DataFrame:
    """Distinct rows of the notification log for the status rows `df`.

    `body` is the text that was sent or, for a report in parts, its frame (part, parts, body); `df`
    then has a column `part` saying where each row was reported. Texts and stamps are added after
    the rows have been made distinct, so that they are not shuffled along.
    """
    in_parts = isinstance(body, DataFrame)
    rows = df.select(
        F.col("run_name").alias("WorkflowName"),
        "job_id",
        F.col(event_type_col).alias("EventType"),
        F.col("end_time_in_est").alias("EventDTMM"),
        "layer",
        *(["part"] if in_parts else []),
    ).distinct()
    if in_parts:
        rows = rows.join(body.select("part", F.col("body").alias("NotificationEmailContent")), "part")
    else:
        rows = rows.withColumn("NotificationEmailContent", F.lit(body))
    constants = {
        "ObjectType": F.lit("WF"),
        "NotificationDttm": stamp(as_of, tz),
        "NotificationSentTo": F.lit(recipients),
        "InsertedOn": stamp(as_of, tz),
    }
    return rows.select(
        *(constants.get(name, F.col(name)).alias(name) for name in NOTIFICATION_COLUMNS),
        F.lit(business_day(as_of, tz)).alias(NOTIFICATION_PARTITION),
    )


def message_id(kind: Column | str, day: dt.date) -> Column:
    """The id of a message (kind, part, parts, body): the same report of the same day has the same one, whenever it is made."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    place = [F.col("part").cast("string"), F.col("parts").cast("string")]
    return F.sha2(F.concat_ws("|", kind, F.lit(day.isoformat()), *place, F.sha2(F.coalesce("body", F.lit("")), 256)), 256)


def notification_entries(
    df: DataFrame,
    event_type_col: str,
    recipients: str,
    messages: DataFrame,
    as_of: dt.datetime | int,
    tz: str = BUSINESS_ZONE,
) -> DataFrame:
    """`notification_rows` for a report in parts, with the id of the message in place of its text.

    `messages` has part and message_id; `df` has a column `part`. No text is joined to the rows, however many share one.
    """
    ids = messages.select("part", messages["message_id"].alias("MessageId"))
    bare = notification_rows(df, event_type_col, recipients, ids.selectExpr("part", "MessageId as body"), as_of, tz)
    return bare.withColumnRenamed(BODY, "MessageId").select(*ENTRY_COLUMNS, NOTIFICATION_PARTITION)


def with_bodies(entries: DataFrame, messages: DataFrame) -> DataFrame:
    """Rows of the notification log from entries and the messages (message_id, body) that they name."""
    texts = messages.select("message_id", F.col("body").alias(BODY))
    full = entries.join(texts, F.col("MessageId") == F.col("message_id"), "left_outer")
    return full.select(*NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION)


def not_yet_logged(entries: DataFrame, log: DataFrame) -> DataFrame:
    """The entries that `log` does not have, by all values that both have but the text. Nulls are equal."""
    told = [name for name in NOTIFICATION_COLUMNS if name != BODY]
    seen = log.select(*(F.col(name).alias(f"seen_{name}") for name in told))
    return entries.join(seen, [F.col(name).eqNullSafe(F.col(f"seen_{name}")) for name in told], "left_anti")


def not_yet_sent(messages: DataFrame, outbox: DataFrame) -> DataFrame:
    """The messages whose id is not in `outbox`."""
    seen = outbox.select(F.col("message_id").alias("seen_id"))
    return messages.join(seen, F.col("message_id") == F.col("seen_id"), "left_anti").select(*OUTBOX_COLUMNS)


def notifications_on(log: DataFrame, day: dt.date) -> DataFrame:
    """Audit query: the notifications sent on `day`, descending by object type, then by workflow and job.

    Rows are filed under the day they were inserted, which is that of the notification: only its partition is read.
    The further sort keys let ranges of one object type go to many tasks.
    """
    sent = log.where(F.to_date("NotificationDttm") == F.lit(day))
    if NOTIFICATION_PARTITION in log.columns:
        sent = sent.where(F.col(NOTIFICATION_PARTITION) == F.lit(day))
    return sent.orderBy(*audit_order())


def audit_order() -> list[Column]:
    """Descending by object type, then by workflow and job."""
    return [F.col("ObjectType").desc(), F.col("WorkflowName").asc(), F.col("job_id").asc()]
