"""Exactly-once reports: journal, replay, texts kept once."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from runtide.operators.notify import message_id
from runtide.plans.lineage import settle_counted
from runtide.plans.monitor import monitor, prepare_cycle, run_cycle
from runtide.schema import BODY, NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION, OUTBOX_COLUMNS
from runtide.sources.dependencies import SLA_BY_LAYER
from runtide.sources.journal import apply_cycle, log_cycle, replay_cycles, send_cycle
from runtide.sources.tables import TableNames, ensure_tables
from tests.test_monitor import AS_OF, TO, raw, values  # noqa: F401

DAY = dt.date(2024, 1, 15)
FAILED = ("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED")
ALSO_FAILED = ("2", "8", "y", "2024-01-15 01:00:00", "2024-01-15 02:30:00", "FAILED")


@pytest.fixture()
def names():
    tag = uuid.uuid4().hex[:8]
    return TableNames(f"runs_{tag}", f"notices_{tag}", f"outbox_{tag}")


@pytest.fixture()
def deps(make_deps):
    return make_deps(("Bronze", "x"), ("Gold", "y"))


def state(spark, names):
    return values(spark.table(names.outbox), "kind", "message_id"), values(spark.table(names.notification_log), "job_id", "EventType", BODY)


@pytest.mark.parametrize("bodies, done", [("once", ("log",)), ("once", ("send",)), ("each_row", ()), ("each_row", ("log",))])
def test_stopped_anywhere_every_message_is_sent_once(spark, raw, deps, names, bodies, done):  # noqa: F811
    ensure_tables(spark, names, bodies=bodies)
    found, cycle = prepare_cycle(raw(FAILED), deps, AS_OF, names, **TO)
    for step in done:
        {"log": log_cycle, "send": send_cycle}[step](spark, names, cycle)
    # The next call finds one more failure; what was recorded before is completed as it was.
    run_cycle(raw(FAILED, ALSO_FAILED), deps, AS_OF, names, **TO)
    sent, logged = state(spark, names)
    assert [kind for kind, _ in sent] == ["failure", "failure"] and len({i for _, i in sent}) == 2
    assert [row[:2] for row in logged] == [("7", "FAILED"), ("8", "FAILED")]
    assert all(body and "<td>" in body for _, _, body in logged)
    run_cycle(raw(FAILED, ALSO_FAILED), deps, AS_OF, names, **TO)
    assert state(spark, names) == (sent, logged) and replay_cycles(spark, names) == []


def test_unfinished_record_counts_for_nothing(spark, raw, deps, names):  # noqa: F811
    ensure_tables(spark, names, bodies="once")
    found = monitor_of(spark, raw(FAILED), deps, names)
    empty = found["entries"].limit(0)
    # Rows of a journal without its row in the table of cycles: the call was stopped while it recorded.
    spark.table(names.journal)
    kinds = spark.table(names.journal).schema
    found["outbox"].select(
        F.struct(*OUTBOX_COLUMNS).cast(kinds["message"].dataType), F.lit(None).cast(kinds["entry"].dataType), F.lit("lost")
    ).write.insertInto(names.journal)
    assert replay_cycles(spark, names) == [] and empty.count() == 0
    run_cycle(raw(FAILED), deps, AS_OF, names, **TO)
    assert len(state(spark, names)[0]) == 1


def monitor_of(spark, runs, deps, names, **options):
    from runtide.operators.runs import flatten_runs
    from runtide.plans.monitor import LOG_COLUMNS, STATUS_COLUMNS

    flat = flatten_runs(runs).select(*STATUS_COLUMNS, *LOG_COLUMNS)
    return monitor(flat, deps, SLA_BY_LAYER, spark.table(names.notification_log), AS_OF, **TO, **options)


def test_texts_are_kept_once(spark, raw, make_deps, names):  # noqa: F811
    rows = [(str(k), str(k), f"n{k}", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "FAILED") for k in range(1, 31)]
    run_cycle(raw(*rows), make_deps(*(("Gold", f"n{k}") for k in range(1, 31))), AS_OF, names, rows_per_part=10, **TO)
    assert "NotificationEmailContent" not in spark.table(names.entries).columns
    log = spark.table(names.notification_log)
    assert tuple(log.columns) == (*NOTIFICATION_COLUMNS, NOTIFICATION_PARTITION)
    assert [n for _, n in sorted(log.groupBy(BODY).count().collect())] == [10, 10, 10]
    # Reading no text reads no message.
    plan = log.where(F.col(NOTIFICATION_PARTITION) == F.lit(DAY)).select("job_id", "EventType").distinct()
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_message_ids_and_copies(spark, raw, deps, names, make_log):  # noqa: F811
    bodies = spark.createDataFrame([(0, 2, "text"), (1, 2, "text"), (0, 2, "more")], "part int, parts int, body string")
    ids = [r[0] for k in ("failure", "success") for day in (DAY, DAY + dt.timedelta(1)) for r in bodies.select(message_id(k, day)).collect()]
    assert len(set(ids)) == 12 and ids[:3] == [r[0] for r in bodies.select(message_id("failure", DAY)).collect()]
    ok = raw(("1", "7", "x", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"))
    ensure_tables(spark, names)
    for cc, wanted in ((None, ["c@x.com"]), ("", []), ("d@x.com; e@x.com", ["d@x.com", "e@x.com"])):
        found = monitor_of(spark, ok, deps.where("layer = 'Bronze'"), names, success_cc=cc)
        assert values(found["outbox"], "kind", "recipients", "cc") == [("success", ["c@x.com"], wanted)]


def test_old_outbox_gets_the_new_columns(spark, names):
    spark.sql(
        f"""create table {names.outbox} (kind string, subject string, recipients array<string>, part int, parts int,
            body string, CreatedOn timestamp_ntz) using parquet"""
    )
    spark.sql(f"insert into {names.outbox} values ('failure', 's', array('a'), 0, 1, 'b', null)")
    ensure_tables(spark, names)
    assert tuple(spark.table(names.outbox).columns) == OUTBOX_COLUMNS
    assert spark.table(names.outbox).first()["message_id"] is None
    with pytest.raises(ValueError):
        ensure_tables(spark, names, bodies="twice")


def test_counted_settling(spark):
    settled, rows = settle_counted(spark.range(1234).repartition(7))
    assert rows == 1234 == settled.count()
    assert settle_counted(spark.range(0))[1] == 0


def test_apply_may_be_repeated(spark, raw, deps, names):  # noqa: F811
    found, cycle = prepare_cycle(raw(FAILED), deps, AS_OF, names, **TO)
    assert found["run_count"].first()[0] == 1
    for _ in range(3):
        apply_cycle(spark, names, cycle)
    sent, logged = state(spark, names)
    assert len(sent) == len(logged) == 1
