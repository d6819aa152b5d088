"""Column layouts of the inputs, the flat run table and the two log tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Flat run column, Spark type, path inside the run payload.
RUN_FIELDS = (
    ("run_id", "string", "run_id"),
    ("job_id", "string", "job_id"),
    ("run_name", "string", "run_name"),
    ("start_time_in_ms", "bigint", "start_time"),
    ("start_time_in_pst", "timestamp_ntz", "start_time"),
    ("start_time_in_est", "timestamp_ntz", "start_time"),
    ("setup_duration_min", "float", "setup_duration"),
    ("run_duration_min", "float", "run_duration"),
    ("end_time_in_ms", "bigint", "end_time"),
    ("end_time_in_pst", "timestamp_ntz", "end_time"),
    ("end_time_in_est", "timestamp_ntz", "end_time"),
    ("run_page_url", "string", "run_page_url"),
    ("trigger", "string", "trigger"),
    ("attempt_number", "int", "attempt_number"),
    ("result_state", "string", "state/result_state"),
    ("state_message", "string", "state/state_message"),
    ("user_cancelled_or_timedout", "string", "state/user_cancelled_or_timedout"),
    ("cluster_id", "string", "cluster_instance/cluster_id"),
    ("cluster_name", "string", "cluster_spec/new_cluster/cluster_name"),
    ("spark_version", "string", "cluster_spec/new_cluster/spark_version"),
    ("instance_pool_id", "string", "cluster_spec/new_cluster/instance_pool_id"),
    ("node_type_id", "string", "cluster_spec/new_cluster/node_type_id"),
    ("data_security_mode", "string", "cluster_spec/new_cluster/data_security_mode"),
    ("num_workers", "string", "cluster_spec/new_cluster/num_workers"),
    ("min_workers", "string", "cluster_spec/new_cluster/autoscale/min_workers"),
    ("max_workers", "string", "cluster_spec/new_cluster/autoscale/max_workers"),
    ("format", "string", "format"),
)

RUN_COLUMNS = tuple(name for name, _, _ in RUN_FIELDS)

# What one run object of a landed payload may hold. Identifiers and cluster settings are read as
# text, whatever JSON type they have; keys that a payload lacks come back as null.
RUN_OBJECT_DDL = """
    run_id string, job_id string, run_name string, start_time bigint, end_time bigint,
    setup_duration bigint, run_duration bigint, run_page_url string, trigger string,
    attempt_number int, format string,
    state struct<result_state: string, state_message: string, user_cancelled_or_timedout: string>,
    cluster_instance struct<cluster_id: string>,
    cluster_spec struct<new_cluster: struct<
        cluster_name: string, spark_version: string, instance_pool_id: string, node_type_id: string,
        data_security_mode: string, num_workers: string,
        autoscale: struct<min_workers: string, max_workers: string>>>
"""

RUN_PAGE_DDL = "runs array<struct<" + RUN_OBJECT_DDL.replace("\n", " ") + ">>"

#: Column with the text of a page that could not be read.
PAGE_TEXT = "_page_text"
QUARANTINE_DDL = "file string, page string, QuarantinedOn timestamp_ntz"
QUARANTINE_COLUMNS = ("file", "page", "QuarantinedOn")

#: One row for each landed file: when it was written, its number of runs, their first and last start.
PAGE_INDEX_DDL = "file string, modified timestamp, runs bigint, first_start bigint, last_start bigint"
PAGE_INDEX_COLUMNS = ("file", "modified", "runs", "first_start", "last_start")

DEPENDENCY_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("SubjectArea", "WorkflowName", "DependsOn", "layer")]
)

# Columns of the two logs, in their order.
RUN_LOG_DDL = """
    RunId bigint, attempt_number int, WorkFlowId bigint, WorkFlowStartType string,
    WorkFlowStartDttm string, WorkFlowEndDttm string, WorkFlowDuration string, WorkFlowState string,
    WorkFlowMessage string, WorkFlowMetSLAFlag string, InsertedOn timestamp_ntz
"""
NOTIFICATION_LOG_DDL = """
    ObjectType string, WorkflowName string, job_id string, EventType string,
    EventDTMM timestamp_ntz, NotificationDttm timestamp_ntz, NotificationSentTo string,
    NotificationEmailContent string, layer string, InsertedOn timestamp_ntz
"""
# End of fixed values.


def names_of(ddl: str) -> tuple[str, ...]:
    """Column names of a layout without nested columns."""
    return tuple(column.split()[0] for column in ddl.split(","))


RUN_LOG_COLUMNS = names_of(RUN_LOG_DDL)
NOTIFICATION_COLUMNS = names_of(NOTIFICATION_LOG_DDL)

# Both logs carry one partition column after the columns that users see. It is fixed when a row
# is first inserted, so a later update never moves a row to another partition.
RUN_LOG_PARTITION = "PartitionDate"
NOTIFICATION_PARTITION = "InsertedDate"

# A log entry without its text names the message that has it.
BODY = "NotificationEmailContent"
ENTRY_DDL = ",".join(c for c in NOTIFICATION_LOG_DDL.split(",") if BODY not in c) + ", MessageId string"
ENTRY_COLUMNS = names_of(ENTRY_DDL)

OUTBOX_DDL = """
    kind string, subject string, recipients array<string>, part int, parts int, body string,
    CreatedOn timestamp_ntz, message_id string, cc array<string>
"""
OUTBOX_COLUMNS = names_of(OUTBOX_DDL)

# What a cycle is about to write: rows of the outbox and of the notification log, and how far it came.
JOURNAL_DDL = f"""
    message struct<{OUTBOX_DDL.replace(chr(10), " ")}>, entry struct<{ENTRY_DDL.replace(chr(10), " ")}, {NOTIFICATION_PARTITION} date>
"""
CYCLE_DDL = "cycle string, day date, state string"


def run_schema_ddl() -> str:
    """The flat run schema as DDL text, for `spark.read.schema(...)` and `createDataFrame`."""
    return ", ".join(f"{name} {kind}" for name, kind, _ in RUN_FIELDS)
