"""One query for each operator, over the views of `checks.views`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import (
    AS_OF,
    DAY,
    RECIPIENTS,
    LAYER_OF_JOB,
    dependencies,
    dependencies_ok,
    dependency_chains,
    flat_runs,
    notification_log,
    raw_runs,
    run_log,
    shared_name_runs,
    sla_history,
    table,
    today_runs,
)
from runtide.functions.scalars import path_get
from runtide.functions.text import cell_class, date_label, failure_intro, name_list, recipients, success_intro
from runtide.operators import layers as lay
from runtide.operators import status as sta
from runtide.operators import closure as clo
from runtide.operators import sla as slas
from runtide.operators.notify import audit_order, notification_rows, notifications_on
from runtide.operators.report import html_report, html_table, numbered
from runtide.operators.rollup import counts_of_bitmaps, layer_bitmaps, name_numbers
from runtide.operators.runlog import upsert_runs
from runtide.operators.runs import (
    flatten_runs,
    latest_run_per_job,
    newest_first_order,
    run_counts,
    runs_lookback,
    runs_recent_topk,
)
from runtide.plans.lineage import fresh_path, settle, settle_counted
from runtide.plans.monitor import monitor, open_status, prepare_cycle, run_cycle, settled_today
from runtide.schema import BODY, NOTIFICATION_PARTITION, QUARANTINE_DDL, RUN_LOG_COLUMNS, run_schema_ddl
from runtide.sources.dependencies import SLA_BY_LAYER, read_dependencies
from runtide.sources.files import file_inventory, inventory
from runtide.sources.journal import log_cycle
from runtide.sources.pageindex import ensure_page_index, index_new_pages, read_runs_indexed
from runtide.sources.payload import broken_pages, land_pages, quarantine, read_pages, read_runs, sound_runs
from runtide.sources.tables import (
    TableNames,
    append_entries,
    append_notifications,
    ensure_bucketed_run_log,
    ensure_tables,
    write_run_log,
)
from runtide.streaming.ingest import stream_runs
from runtide.streaming.latest import ensure_latest_runs, latest_runs, stream_latest_runs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _status(spark: SparkSession, sf: str, deps: DataFrame | None = None) -> DataFrame:
    today = settled_today(flat_runs(spark, sf), AS_OF)
    return open_status(today, dependencies(spark, sf) if deps is None else deps, SLA_BY_LAYER)


def _notified(spark: SparkSession, sf: str) -> DataFrame:
    return sta.notified_today(notification_log(spark, sf), DAY)


def _fresh(spark: SparkSession, sf: str) -> DataFrame:
    return sta.not_yet_notified(_status(spark, sf), _notified(spark, sf))


def _monitor(spark: SparkSession, sf: str, deps: DataFrame) -> dict[str, DataFrame]:
    return monitor(
        flat_runs(spark, sf), deps, SLA_BY_LAYER, notification_log(spark, sf), AS_OF,
        failure_recipients=RECIPIENTS, success_recipients=RECIPIENTS,
    )


# Sources


@query
def runs_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All runs landed as payload pages of up to 1000 and read back."""
    path = fresh_path(spark, "pages")
    land_pages(raw_runs(spark, sf), F.floor(F.col("run_id") / 1000), path)
    return flatten_runs(read_runs(spark, path))


@query
def runs_scan_window(spark: SparkSession, sf: str) -> DataFrame:
    """Runs landed in a folder per start day; a look-back that opens the folders of three days only."""
    path = fresh_path(spark, "daily")
    daily = raw_runs(spark, sf).withColumn("day", F.date_format(F.timestamp_millis("start_time"), "yyyy-MM-dd"))
    land_pages(daily, F.floor(F.col("run_id") / 1000), path, ("day",))
    window = F.col("day").between("2024-01-13", "2024-01-15")
    return flatten_runs(read_runs(spark, path, pages=window))


@query
def dependencies_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "dependencies")
    dependencies(spark, sf).write.parquet(path)
    return read_dependencies(spark, path)


@query
def file_inventory_of_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Runs landed in a folder per start day, listed; file names and times are left out."""
    path = fresh_path(spark, "daily")
    daily = raw_runs(spark, sf).withColumn("day", F.date_format(F.timestamp_millis("start_time"), "yyyy-MM-dd"))
    land_pages(daily, F.floor(F.col("run_id") / 1000), path, ("day",))
    is_file = F.col("type") == "file"
    folder = F.element_at(F.split("path", "/"), F.when(is_file, -2).otherwise(-1))
    return (
        file_inventory(spark, path)
        .groupBy(folder.alias("folder"))
        .agg(F.count_if(~is_file).alias("folders"), F.bool_or(is_file).alias("has_files"))
    )


@query
def file_inventory_of_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The addresses of all pages as a listing, a page per file."""
    listing = table(spark, sf, "pages").where("url is not null").selectExpr(
        "concat('store/', regexp_replace(url, '^[a-z]+://', '')) as path", "page_id * 1000 as modificationTime"
    )
    return inventory(listing, "store")


# Runs


@query
def runs_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return flat_runs(spark, sf)


@query
def path_lookup(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_runs(spark, sf)
    events = table(spark, sf, "events").select(F.col("event_id").alias("run_id"), "props")
    from_structs = raw.select(
        "run_id",
        path_get(raw, "state//result_state/").alias("result_state"),
        path_get(raw, "cluster_spec/new_cluster/autoscale/max_workers", "int").alias("max_workers"),
        path_get(raw, "cluster_spec/no_such_key/x").alias("no_such_key"),
        path_get(raw, "run_name/not_an_object").alias("not_an_object"),
    )
    from_text = events.select("run_id", path_get(events, "props/k", "int").alias("k"))
    return from_structs.join(from_text, "run_id")


@query
def runs_lookback_two_days(spark: SparkSession, sf: str) -> DataFrame:
    return runs_lookback(flat_runs(spark, sf), AS_OF, 2).select("run_id", "job_id", "start_time_in_ms")


@query
def runs_recent_top_1000(spark: SparkSession, sf: str) -> DataFrame:
    return runs_recent_topk(flat_runs(spark, sf), 1000).select("run_id", "job_id", "start_time_in_ms")


@query
def latest_run_of_each_job(spark: SparkSession, sf: str) -> DataFrame:
    return latest_run_per_job(flat_runs(spark, sf))


@query
def runs_today_latest(spark: SparkSession, sf: str) -> DataFrame:
    return today_runs(spark, sf)


@query
def run_count(spark: SparkSession, sf: str) -> DataFrame:
    return run_counts(flat_runs(spark, sf))


@query
def effective_state(spark: SparkSession, sf: str) -> DataFrame:
    kept = "run_id", "result_state", "EventType"
    return sta.effective_state(flat_runs(spark, sf)).select(*kept)


@query
def run_log_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_runs(run_log(spark, sf), flat_runs(spark, sf), AS_OF).select(*RUN_LOG_COLUMNS)


def _tables(spark: SparkSession, bodies: str = "each_row") -> TableNames:
    """Log tables of one call, in the shared folder."""
    tag = uuid.uuid4().hex
    names = TableNames(f"run_log_{tag}", f"notification_log_{tag}", f"outbox_{tag}")
    ensure_tables(spark, names, location=fresh_path(spark, "tables"), bodies=bodies)
    return names


@query
def run_log_written(spark: SparkSession, sf: str) -> DataFrame:
    """The run log as a table: created, filled, the same pull upserted twice, read back with its partition."""
    names = _tables(spark)
    run_log(spark, sf).write.insertInto(names.run_log)
    for _ in range(2):
        write_run_log(flat_runs(spark, sf), names.run_log, AS_OF, null_keys="match", older="kept")
    return spark.table(names.run_log)


# Status


@query
def dependency_status(spark: SparkSession, sf: str) -> DataFrame:
    return sta.dependency_status(dependencies(spark, sf), settle(today_runs(spark, sf), "today"))


@query
def dependency_rejoin(spark: SparkSession, sf: str) -> DataFrame:
    runs = settle(shared_name_runs(spark, sf), "today")
    return sta.dependency_rejoin(sta.dependency_status(dependencies(spark, sf), runs), runs).select(
        "DependsOn", "layer", "run_id", "job_id", "run_name", "copies"
    )


@query
def sla_by_layer(spark: SparkSession, sf: str) -> DataFrame:
    return sta.sla_by_layer(dependencies(spark, sf), SLA_BY_LAYER)


@query
def sla_by_layer_table(spark: SparkSession, sf: str) -> DataFrame:
    sla = dependencies(spark, sf).select("layer").distinct().select(
        "layer", F.concat(F.length("layer").cast("string"), F.lit(":30 PM EST")).alias("sla_text")
    )
    return sta.sla_by_layer(dependencies(spark, sf), sla)


@query
def notified_today(spark: SparkSession, sf: str) -> DataFrame:
    return _notified(spark, sf)


STATUS_OUTPUT = ("layer", "SLA", "DependsOn", "run_id", "job_id", "run_name", "result_state", "EventType")


@query
def not_yet_notified(spark: SparkSession, sf: str) -> DataFrame:
    return _fresh(spark, sf).select(*STATUS_OUTPUT)


@query
def failed_runs(spark: SparkSession, sf: str) -> DataFrame:
    return sta.failed_runs(_fresh(spark, sf), _notified(spark, sf)).select(*STATUS_OUTPUT)


@query
def failed_runs_by_event(spark: SparkSession, sf: str) -> DataFrame:
    return sta.failed_runs(_status(spark, sf), _notified(spark, sf), "job_event").select(*STATUS_OUTPUT)


# Layers


@query
def layer_status(spark: SparkSession, sf: str) -> DataFrame:
    return lay.layer_status(_fresh(spark, sf))


@query
def layer_status_before_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return lay.layer_status(_status(spark, sf), second_shift=False)


@query
def layer_report(spark: SparkSession, sf: str) -> DataFrame:
    return lay.layer_report(lay.layer_status(_fresh(spark, sf)))


@query
def failure_report(spark: SparkSession, sf: str) -> DataFrame:
    return lay.failure_report(sta.failed_runs(_fresh(spark, sf), _notified(spark, sf)))


@query
def all_layers_gate(spark: SparkSession, sf: str) -> DataFrame:
    return lay.all_layers_gate(lay.layer_status(_fresh(spark, sf)))


@query
def all_layers_gate_open(spark: SparkSession, sf: str) -> DataFrame:
    return lay.all_layers_gate(lay.layer_status(_status(spark, sf, dependencies_ok(spark, sf))))


@query
def layer_label(spark: SparkSession, sf: str) -> DataFrame:
    return lay.layer_label(dependencies(spark, sf))


@query
def name_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """The order priorities that each customer uses, as a phrase."""
    used = table(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()
    return used.groupBy("o_custkey").agg(name_list(F.collect_list("o_orderpriority")).alias("phrase"))


# Text


@query
def date_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", date_label(F.to_date("o_orderdate")).alias("label"))


@query
def recipients_of_text(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr("concat(' ', lower(replace(c_name, '#', '.')), '@example.com ;', c_mktsegment, '@example.com;\t')")
    return table(spark, sf, "customer").select("c_custkey", F.posexplode(recipients(text)).alias("place", "address"))


@query
def cell_classes(spark: SparkSession, sf: str) -> DataFrame:
    cell = F.expr(
        """case event_type when 'error' then ' failed ' when 'view' then 'Not started'
           when 'click' then 'Incompleted' when 'signup' then null
           else case event_id % 3 when 0 then 'y' when 1 then ' N\t' else 'Skipped' end end"""
    )
    return table(spark, sf, "events").select("event_id", cell_class(cell).alias("css_class"))


@query
def html_layer_report(spark: SparkSession, sf: str) -> DataFrame:
    layers = settle(lay.layer_status(_fresh(spark, sf)), "layers")
    intro = success_intro(lay.layer_label(layers, "Layer").scalar())
    return html_report(lay.layer_report(layers), intro, ["Data Layer"])


@query
def html_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The failure report, with the layer report as second table."""
    fresh = settle(_fresh(spark, sf), "fresh")
    layers = settle(lay.layer_status(fresh), "layers")
    failed = settle(lay.failure_report(sta.failed_runs(fresh, _notified(spark, sf))), "failures")
    intro = failure_intro(lay.layer_label(failed, "Layer").scalar())
    order = ["SLA", "WorkflowName", "RunId"]
    return html_report(failed, intro, order, second=lay.layer_report(layers), second_order=["Data Layer"])


@query
def html_long_report(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as one sorted table, in parts of 1,000 lines."""
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus", F.col("o_orderkey").cast("string").alias("o_orderkey"))
    return html_table(orders, ["o_orderpriority", "o_orderkey"])


# Notifications


@query
def notification_rows_of_failures(spark: SparkSession, sf: str) -> DataFrame:
    failed = sta.failed_runs(_fresh(spark, sf), _notified(spark, sf))
    return notification_rows(failed, "result_state", RECIPIENTS, "body", AS_OF)


@query
def notifications_appended(spark: SparkSession, sf: str) -> DataFrame:
    """The log as a table: earlier notifications filed under their days, those of failures appended, the new ones read back."""
    names = _tables(spark)
    earlier = notification_log(spark, sf).withColumn(NOTIFICATION_PARTITION, F.to_date("InsertedOn"))
    append_notifications(earlier, names.notification_log)
    append_notifications(notification_rows_of_failures(spark, sf), names.notification_log)
    return notifications_on(spark.table(names.notification_log), DAY).where("NotificationEmailContent = 'body'")


@query
def notifications_today(spark: SparkSession, sf: str) -> DataFrame:
    return notifications_on(notification_log(spark, sf), DAY)


@query
def monitor_outbox(spark: SparkSession, sf: str) -> DataFrame:
    """The message of a day with failures, end to end."""
    sent = _monitor(spark, sf, dependencies(spark, sf))["outbox"]
    return sent.withColumn("recipients", F.array_join("recipients", ", ")).drop("message_id", "cc")


@query
def monitor_notifications(spark: SparkSession, sf: str) -> DataFrame:
    """The notifications logged once every layer is complete, end to end."""
    return _monitor(spark, sf, dependencies_ok(spark, sf))["notification_rows"]


def _sent(spark: SparkSession, names: TableNames, dedupe: str) -> DataFrame:
    """The outbox of some cycles, with the number of log rows that show each message."""
    log = spark.table(names.notification_log).where(F.col(BODY).isNotNull())
    logged = log.groupBy(BODY).agg(F.count(F.lit(1)).alias("n_logged")).withColumnRenamed(BODY, "logged_body")
    sent = spark.table(names.outbox).join(logged, F.col("body") == F.col("logged_body"), "left_outer")
    listed = [F.array_join(c, ", ").alias(c) for c in ("recipients", "cc")]
    return sent.select(F.lit(dedupe).alias("dedupe"), "kind", "subject", *listed, "part", "parts", "body", "CreatedOn", "n_logged")


def _cycles(spark: SparkSession, sf: str, interrupted: bool) -> DataFrame:
    found = []
    for dedupe in ("before_status", "after_status"):
        names = _tables(spark, "once")
        earlier = notification_log(spark, sf).withColumn(NOTIFICATION_PARTITION, F.to_date("InsertedOn"))
        append_entries(earlier.withColumn("MessageId", F.lit(None).cast("string")), names.entries)
        options = {"dedupe": dedupe, "failure_recipients": RECIPIENTS, "success_recipients": RECIPIENTS}
        if interrupted:
            _, cycle = prepare_cycle(raw_runs(spark, sf), dependencies(spark, sf), AS_OF, names, **options)
            log_cycle(spark, names, cycle)  # stopped here: logged, and not in the outbox
        else:
            run_cycle(raw_runs(spark, sf), dependencies(spark, sf), AS_OF, names, **options)
        run_cycle(raw_runs(spark, sf), dependencies(spark, sf), AS_OF, names, **options)
        found.append(_sent(spark, names, dedupe))
    return found[0].unionByName(found[1])


@query
def run_cycle_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The messages of a day and their log rows after two calls of the whole job."""
    return _cycles(spark, sf, interrupted=False)


@query
def run_cycle_interrupted(spark: SparkSession, sf: str) -> DataFrame:
    """The same if the first call is stopped between its two appends."""
    return _cycles(spark, sf, interrupted=True)


@query
def run_count_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The number of runs pulled in two days, observed while they are written."""
    _, rows = settle_counted(runs_lookback(flat_runs(spark, sf), AS_OF, 2), "pull")
    return spark.createDataFrame([(rows,)], "run_count bigint")


# Layouts of the landing and the logs


@query
def run_log_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """`run_log_written` on a log laid out by key."""
    name = f"run_log_{uuid.uuid4().hex}"
    ensure_bucketed_run_log(spark, name, 16, location=fresh_path(spark, "tables"))
    run_log(spark, sf).write.insertInto(name)
    for _ in range(2):
        write_run_log(flat_runs(spark, sf), name, AS_OF, null_keys="match", older="kept")
    return spark.table(name)


@query
def runs_scan_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """A look-back of two days over pages of a day each without day folders: half of them indexed, the others landed later."""
    landing, index = fresh_path(spark, "landing"), f"page_index_{uuid.uuid4().hex}"
    raw, day = raw_runs(spark, sf), F.floor(F.col("start_time") / 86_400_000)
    land_pages(raw.where("run_id % 2 = 0"), day, f"{landing}/first", files=16)
    ensure_page_index(spark, index, location=fresh_path(spark, "tables"))
    index_new_pages(spark, f"{landing}/*", index, fresh_path(spark, "stream")).awaitTermination()
    land_pages(raw.where("run_id % 2 = 1"), day, f"{landing}/second", files=16)
    return flatten_runs(read_runs_indexed(spark, landing, spark.table(index), AS_OF, 2))


@query
def pages_quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of 100 runs, some of them broken off: the runs of the others, and the broken texts after two pulls."""
    landing, kept = fresh_path(spark, "landing"), f"quarantine_{uuid.uuid4().hex}"
    pages = raw_runs(spark, sf).groupBy(F.expr("run_id div 100").alias("page")).agg(F.collect_list(F.struct("*")).alias("runs"))
    whole = F.to_json(F.struct("runs"))
    pages.select(F.when(F.col("page") % 7 == 3, F.format_string('{"runs": [{"run_id": %d, ', "page")).otherwise(whole)).write.text(landing)
    spark.sql(f"CREATE TABLE {kept} ({QUARANTINE_DDL}) USING parquet LOCATION '{fresh_path(spark, 'tables')}'")
    landed = read_pages(spark, landing)
    for _ in range(2):
        quarantine(broken_pages(landed, AS_OF), kept)
    runs = flatten_runs(sound_runs(landed)).select("run_id", F.lit(None).cast("string").alias("page"))
    return runs.unionByName(spark.table(kept).select("page"), allowMissingColumns=True)


@query
def run_schema_of_ddl(spark: SparkSession, sf: str) -> DataFrame:
    """Flat runs written as text and read back by the schema's DDL."""
    path = fresh_path(spark, "flat")
    flat_runs(spark, sf).write.json(path)
    return spark.read.schema(run_schema_ddl()).json(path)


# Orders


@query
def runs_newest_first(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(flat_runs(spark, sf), newest_first_order()).select("run_id", "position")


@query
def notifications_today_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(notifications_on(notification_log(spark, sf), DAY), audit_order())


# Streams, chains, changing SLAs, counts over days


@query
def latest_run_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The latest run of each job after three batches of about ten days, a tenth of the runs a batch late."""
    landing, state, name = fresh_path(spark, "landing"), fresh_path(spark, "stream"), f"latest_runs_{uuid.uuid4().hex}"
    ensure_latest_runs(spark, name, flat_runs(spark, sf), location=fresh_path(spark, "tables"))
    on_time = F.ceil(F.dayofmonth(F.timestamp_millis("start_time")) / 10)
    batch = F.least(on_time + (F.col("run_id") % 10 == 0).cast("int"), F.lit(3))
    raw = raw_runs(spark, sf).withColumn("batch", batch)
    for k in (1, 2, 3):
        land_pages(raw.where(F.col("batch") == k).drop("batch"), F.floor(F.col("run_id") / 1000), f"{landing}/{k}")
        stream_latest_runs(stream_runs(spark, f"{landing}/*"), name, state, "15 days").awaitTermination()
        spark.catalog.refreshTable(name)
    return latest_runs(spark.table(name))


@query
def dependency_closure(spark: SparkSession, sf: str) -> DataFrame:
    return clo.dependency_closure(dependency_chains(spark, sf))


@query
def failed_root_causes(spark: SparkSession, sf: str) -> DataFrame:
    failed = latest_run_per_job(flat_runs(spark, sf)).where("result_state = 'FAILED'").select(F.col("run_name").alias("WorkflowName"))
    return clo.root_causes(dependency_chains(spark, sf), settle(failed, "failed"))


@query
def sla_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Every run by the SLA that held for its layer on its day, due the morning after."""
    runs = flat_runs(spark, sf).select(
        "run_id", F.expr(LAYER_OF_JOB.format("cast(job_id as bigint)")).alias("layer"), F.to_date("start_time_in_est").alias("day"), "end_time_in_est"
    )
    found = slas.sla_as_of(runs, sla_history(spark, sf)).withColumn("deadline", slas.sla_deadline("day", "SLA", days_after=1))
    return found.withColumn("SLA_MET", slas.sla_met_by("end_time_in_est", "deadline"))


@query
def layer_counts_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct counts of each layer, by day and over the month (no day), from the bitmaps of the days."""
    needs = sta.sla_by_layer(sta.dependency_needs(dependencies(spark, sf)), SLA_BY_LAYER)
    status = sta.dependency_status(needs, flat_runs(spark, sf)).withColumn("day", F.to_date("start_time_in_est"))
    days = settle(layer_bitmaps(status, name_numbers(needs)), "bitmaps")
    month = counts_of_bitmaps(days).withColumn("day", F.lit(None).cast("date"))
    return counts_of_bitmaps(days.where("day is not null"), ("layer", "SLA", "day")).unionByName(month)
