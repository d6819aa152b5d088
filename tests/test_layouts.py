"""Run log by key, page index, quarantine."""

import datetime as dt
import pathlib
import uuid

import pytest
from pyspark.sql import functions as F

from checks.views import AS_OF, flat_runs, run_log
from runtide.operators.runlog import run_log_rows, upsert_rows
from runtide.operators.runs import flatten_runs
from runtide.schema import QUARANTINE_DDL, RUN_LOG_PARTITION
from runtide.sources.pageindex import ensure_page_index, files_of_window, index_new_pages, read_runs_indexed
from runtide.sources.payload import broken_pages, quarantine, read_pages, sound_runs
from runtide.sources.tables import TableNames, _buckets, _touched, ensure_bucketed_run_log, ensure_tables, write_run_log
from runtide.streaming.ingest import ingest_new_pages
from tests.test_logs import AFTER_BOTH, LATER, SHOWN, content, first_runs, second_runs
from tests.test_logs import AS_OF as LOG_AS_OF
from tests.test_plans import no_broadcast, physical  # noqa: F401
from tests.test_sources import PAGE, run, write

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def bucketed(spark):
    name = f"runs_{uuid.uuid4().hex[:8]}"
    ensure_bucketed_run_log(spark, name, 8)
    ensure_bucketed_run_log(spark, name, 8)
    return name


def test_bucketed_log_is_upserted_like_any(spark, bucketed, make_runs):
    assert _buckets(spark, bucketed) == 8
    write_run_log(first_runs(make_runs), bucketed, LOG_AS_OF)
    for _ in range(2):
        write_run_log(second_runs(make_runs), bucketed, LATER)
        assert content(spark.table(bucketed), *SHOWN) == sorted(AFTER_BOTH, key=repr)


def test_log_by_key_is_not_shuffled(spark, bucketed, no_broadcast):  # noqa: F811
    run_log(spark, SF).write.insertInto(bucketed)
    rows = run_log_rows(flat_runs(spark, SF), AS_OF)
    days = spark.table(bucketed).where(F.col(RUN_LOG_PARTITION) >= "2024-01-10")
    plan = physical(upsert_rows(days, rows))
    # Of the two sides of the join only the pull has an exchange.
    assert "FullOuter" in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Bucketed: true") < plan.index("Exchange hashpartitioning")


def test_partition_without_a_date_is_left_alone(spark, bucketed, make_runs):
    write_run_log(first_runs(make_runs), bucketed, LOG_AS_OF)  # run 3 has no start
    undated = spark.table(bucketed).where(f"{RUN_LOG_PARTITION} is null").select("_metadata.file_path")
    files = {r[0] for r in undated.collect()}
    other = make_runs(("5", "9", "z", "2024-01-15 01:00:00", "2024-01-15 02:00:00", "SUCCESS"))
    rows = run_log_rows(other, LATER)
    assert _touched(spark.table(bucketed), rows).where(f"{RUN_LOG_PARTITION} is null").count() == 0
    write_run_log(other, bucketed, LATER)
    spark.catalog.refreshTable(bucketed)
    assert {r[0] for r in spark.table(bucketed).where(f"{RUN_LOG_PARTITION} is null").select("_metadata.file_path").collect()} == files
    write_run_log(make_runs(("3", "8", "y", "2024-01-15 06:00:00", None, None, "started")), bucketed, LATER)
    spark.catalog.refreshTable(bucketed)
    rows = spark.table(bucketed).where("RunId = 3").collect()
    assert [(r.WorkFlowMessage, r[RUN_LOG_PARTITION]) for r in rows] == [("started", None)]


def start(text):
    return {"runs": [run(int(dt.datetime.fromisoformat(text).timestamp()), text)]}


@pytest.fixture()
def landing(spark, folder):
    write(f"{folder}/in/old.json", start("2024-01-10 01:00:00"), start("2024-01-11 01:00:00"))
    write(f"{folder}/in/new.json", start("2024-01-14 01:00:00"), start("2024-01-15 03:00:00"))
    write(f"{folder}/in/none.json", {"runs": []}, {"runs": [{"run_id": 1}]})
    name = f"page_index_{uuid.uuid4().hex[:8]}"
    ensure_page_index(spark, name)

    def index():
        index_new_pages(spark, f"{folder}/in", name, f"{folder}/state").awaitTermination(120)
        spark.catalog.refreshTable(name)
        return spark.table(name)

    return f"{folder}/in", index


def names_of(files):
    return sorted(pathlib.Path(f).name for f in files)


def test_files_outside_of_the_window_are_not_opened(spark, landing):
    folder, index = landing
    as_of = dt.datetime(2024, 1, 15, 12)
    known = index()
    assert sorted((pathlib.Path(r.file).name, r.runs) for r in known.collect()) == [("new.json", 2), ("none.json", 1), ("old.json", 2)]
    assert names_of(files_of_window(spark, folder, known, as_of)) == ["new.json"]
    # What is not opened may hold anything: here the old file is gone by the time of the read.
    runs = read_runs_indexed(spark, folder, known, as_of, 1)
    pathlib.Path(f"{folder}/old.json").unlink()
    assert names_of(runs.inputFiles()) == ["new.json"] and runs.count() == 1
    assert read_runs_indexed(spark, folder, known, dt.datetime(2024, 2, 15)).count() == 0


def test_unknown_and_changed_files_are_opened(spark, landing):
    folder, index = landing
    as_of = dt.datetime(2024, 1, 15, 12)
    known = index()
    write(f"{folder}/later.json", start("2024-01-15 05:00:00"))
    assert names_of(files_of_window(spark, folder, known, as_of)) == ["later.json", "new.json"]
    assert read_runs_indexed(spark, folder, known, as_of).count() == 2
    known = index()
    assert known.count() == 4 and names_of(files_of_window(spark, folder, known, as_of)) == ["later.json", "new.json"]
    path = pathlib.Path(f"{folder}/old.json")
    write(path, start("2024-01-15 06:00:00"))
    import os

    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert names_of(files_of_window(spark, folder, known, as_of)) == ["later.json", "new.json", "old.json"]


BROKEN = ['{"runs": [', "no json", '{"runs": [{"run_id": 5}]']


def test_broken_pages_are_put_aside_once(spark, folder):
    write(f"{folder}/in/a.json", PAGE)
    pathlib.Path(f"{folder}/in/b.json").write_text("\n".join([*BROKEN, '{"runs": [{"run_id": 9, "job_id": 7}]}', BROKEN[0]]))
    kept = f"quarantine_{uuid.uuid4().hex[:8]}"
    spark.sql(f"create table {kept} ({QUARANTINE_DDL}) using parquet")
    pages = read_pages(spark, f"{folder}/in")
    for _ in range(2):
        quarantine(broken_pages(pages, AS_OF), kept)
    rows = spark.table(kept).collect()
    assert sorted(r.page for r in rows) == sorted(BROKEN) and {pathlib.Path(r.file).name for r in rows} == {"b.json"}
    assert sorted(r.run_id for r in flatten_runs(sound_runs(pages)).collect()) == ["1", "2", "9"]


def test_stream_goes_on_past_broken_pages(spark, folder):
    tag = uuid.uuid4().hex[:8]
    names, kept = TableNames(run_log=f"runs_{tag}"), f"quarantine_{tag}"
    ensure_tables(spark, TableNames(f"runs_{tag}", f"notices_{tag}", f"outbox_{tag}"))
    spark.sql(f"create table {kept} ({QUARANTINE_DDL}) using parquet")

    def ingest(state, quarantine_table):
        query = ingest_new_pages(spark, f"{folder}/in", names.run_log, f"{folder}/{state}", AS_OF, quarantine_table=quarantine_table)
        query.awaitTermination(120)
        spark.catalog.refreshTable(names.run_log)
        spark.catalog.refreshTable(kept)
        return sorted(r.RunId for r in spark.table(names.run_log).collect()), spark.table(kept).count()

    write(f"{folder}/in/1.json", PAGE)
    pathlib.Path(f"{folder}/in/2.json").write_text(BROKEN[0])
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest("strict", None)
    assert ingest("state", kept) == ([1, 2], 1)
    write(f"{folder}/in/3.json", {"runs": [run(3)]})
    assert ingest("state", kept) == ([1, 2, 3], 1)
