import datetime as dt
import json
import pathlib
import uuid

import pytest

from checks.views import raw_runs, run_log
from runtide.operators.runs import flatten_runs, runs_lookback
from runtide.sources.dependencies import read_dependencies
from runtide.sources.files import file_inventory, inventory
from runtide.sources.payload import read_runs
from runtide.sources.tables import TableNames, ensure_tables
from runtide.streaming.ingest import ingest_new_pages
from tests.conftest import eastern_ms


def run(run_id, start="2024-01-15 01:00:00", **more):
    return {"run_id": run_id, "job_id": 7, "start_time": eastern_ms(start), "attempt_number": 0, **more}


PAGE = {"runs": [run(1, state={"user_cancelled_or_timedout": True}, cluster_spec={}), run(2, end_time=0)]}


def write(path, *documents, indent=None):
    path = pathlib.Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(document, indent=indent) for document in documents))


def test_pages_one_per_line(spark, folder):
    write(f"{folder}/a/1.json", PAGE, {"runs": []}, {"has_more": False})
    write(f"{folder}/a/2.json", {"runs": [run(3)]})
    rows = flatten_runs(read_runs(spark, f"{folder}/a")).orderBy("run_id").collect()
    assert [row.run_id for row in rows] == ["1", "2", "3"]
    assert rows[0].user_cancelled_or_timedout == "true" and rows[0].cluster_name == "CUSTOM"
    assert rows[1].end_time_in_ms == 0 and rows[1].end_time_in_est is None


def test_pretty_printed_pages(spark, folder):
    write(f"{folder}/a/1.json", PAGE, indent=2)
    assert read_runs(spark, f"{folder}/a", multi_line=True).count() == 2


def test_broken_page_is_an_error(spark, folder):
    write(f"{folder}/a/1.json", PAGE)
    pathlib.Path(f"{folder}/a/2.json").write_text('{"runs": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_runs(spark, f"{folder}/a").collect()


def test_columnar_payload(spark, folder):
    runs = raw_runs(spark, "/root/testdata/sf0.001")
    runs.write.parquet(f"{folder}/p")
    back = flatten_runs(read_runs(spark, f"{folder}/p", "parquet"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, flatten_runs(runs).collect()))


def test_dependencies_from_a_table(spark, folder, make_deps):
    make_deps(("Gold", "x")).selectExpr("layer", "DependsOn", "WorkflowName", "SubjectArea", "1 as more").write.parquet(
        f"{folder}/d"
    )
    assert read_dependencies(spark, f"{folder}/d").collect() == [("Area", "Flow", "x", "Gold")]


def test_file_inventory(spark, folder):
    for name in ("top.txt", "a/one.txt", "a/b/two.txt", "a/b/three.txt", "c d/four.txt"):
        write(f"{folder}/root/{name}", name)
    rows = file_inventory(spark, f"{folder}/root").collect()
    found = sorted((row.path.removeprefix(f"file:{folder}/root/"), row.name, row.type) for row in rows)
    assert found == [
        ("a", "a", "folder"), ("a/b", "b", "folder"), ("a/b/three.txt", "three.txt", "file"),
        ("a/b/two.txt", "two.txt", "file"), ("a/one.txt", "one.txt", "file"), ("c d", "c d", "folder"),
        ("c d/four.txt", "four.txt", "file"), ("top.txt", "top.txt", "file"),
    ]
    times = {row.name: row.modificationTime for row in rows}
    assert times["a"] == max(times["one.txt"], times["two.txt"], times["three.txt"])


def test_inventory_of_a_listing_has_hidden_names_and_empty_folders(spark):
    rows = [("a/.hidden/_x", 5), ("a/b.txt", 3), ("a/empty/", 7), ("a/.hidden/y", 4), ("a/b.txt", 3)]
    listing = spark.createDataFrame(rows, "path string, modificationTime long").selectExpr("*", "1 as type", "'n' as name")
    want = [("a/.hidden", ".hidden", 5, "folder"), ("a/.hidden/_x", "_x", 5, "file"), ("a/.hidden/y", "y", 4, "file"), ("a/b.txt", "b.txt", 3, "file"), ("a/b.txt", "b.txt", 3, "file"), ("a/empty", "empty", 7, "folder")]
    assert sorted(map(tuple, inventory(listing, "a/").collect())) == want
    assert sorted(map(tuple, inventory(listing).collect())) == sorted([("a", "a", 7, "folder"), *want])
    assert inventory(listing.limit(0), "a").count() == 0


def test_ingest_takes_each_page_once(spark, folder):
    names = TableNames(run_log=f"runs_{uuid.uuid4().hex[:8]}")
    ensure_tables(spark, names)
    as_of = dt.datetime(2024, 1, 16, 4, 59, 59)

    def ingest():
        ingest_new_pages(spark, f"{folder}/in", names.run_log, f"{folder}/state", as_of).awaitTermination(120)
        spark.catalog.refreshTable(names.run_log)
        rows = spark.table(names.run_log).orderBy("RunId").collect()
        return [(row.RunId, row.WorkFlowState) for row in rows]

    write(f"{folder}/in/1.json", PAGE)
    assert ingest() == [(1, None), (2, None)]
    assert ingest() == [(1, None), (2, None)]
    write(f"{folder}/in/2.json", {"runs": [run(2, state={"result_state": "FAILED"}), run(3, "2024-01-14 23:00:00")]})
    assert ingest() == [(1, None), (2, "FAILED"), (3, None)]


def test_fixture_log_has_its_partition(spark):
    log = run_log(spark, "/root/testdata/sf0.001")
    assert log.where("PartitionDate is null").count() == 0


def test_lookback_reaches_the_scan(spark, folder):
    raw_runs(spark, "/root/testdata/sf0.001").write.parquet(f"{folder}/p")
    flat = flatten_runs(read_runs(spark, f"{folder}/p", "parquet"))
    plan = runs_lookback(flat, dt.datetime(2024, 1, 16)).select("job_id", "end_time_in_ms")
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(start_time," in text and "LessThanOrEqual(start_time," in text
    assert "ReadSchema: struct<job_id:bigint,start_time:bigint,end_time:bigint>" in text
