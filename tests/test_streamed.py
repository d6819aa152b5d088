"""Streamed latest runs, dependency chains, changing SLAs, mergeable counts."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from runtide.operators.closure import dependency_closure, root_causes
from runtide.operators.report import numbered
from runtide.operators.rollup import counts_of_bitmaps, layer_bitmaps, name_numbers
from runtide.operators.runs import latest_run_per_job, newest_first
from runtide.operators.sla import sla_as_of, sla_deadline, sla_met_by
from runtide.streaming.latest import ensure_latest_runs, keep_latest, latest_of_day, latest_runs, stream_latest_runs
from tests.conftest import FLAT_DDL
from tests.test_plans import no_broadcast, physical  # noqa: F401


def shown(df, *columns):
    return sorted((tuple(row[c] for c in columns or df.columns) for row in df.collect()), key=repr)


def some_runs(spark, n=300, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = 1704067200000 + rng.randrange(12 * 24) * 3600_000
        end = rng.choice((0, None, start + 60_000, start + 120_000))
        job = rng.choice(("hot", "hot", None, *(f"j{k}" for k in range(20))))
        rows.append((str(rng.choice((i, i, f"x{i}"))), job, f"n{job}", rng.choice((None, 0, 1)), start, end, None, None, 1.0, "PERIODIC", "SUCCESS", ""))
    return spark.createDataFrame(rows, FLAT_DDL)


@pytest.fixture()
def table(spark):
    name = f"latest_{uuid.uuid4().hex[:8]}"
    ensure_latest_runs(spark, name, spark.createDataFrame([], FLAT_DDL))
    return name


def test_kept_latest_runs_equal_ranking_all(spark, table):
    runs = some_runs(spark)
    for part in runs.randomSplit([1.0, 1.0, 1.0], 3):
        for _ in range(2):
            keep_latest(latest_of_day(part), table)
            spark.catalog.refreshTable(table)
    assert shown(latest_runs(spark.table(table))) == shown(latest_run_per_job(runs))


def test_stream_keeps_late_rows_within_the_delay(spark, table, folder):
    runs = some_runs(spark, 200, 9)
    day = F.dayofmonth(F.timestamp_millis("start_time_in_ms"))
    late = F.pmod(F.xxhash64("run_id"), F.lit(5)) == 0
    batch = F.least(F.ceil(day / 4) + late.cast("int"), F.lit(3))
    for k in (1, 2, 3):
        runs.where(batch == k).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(FLAT_DDL).parquet(f"{folder}/in")
        stream_latest_runs(stream, table, f"{folder}/state", "6 days").awaitTermination(180)
        spark.catalog.refreshTable(table)
    assert shown(latest_runs(spark.table(table))) == shown(latest_run_per_job(runs))
    # Again, with nothing new: nothing changes.
    stream_latest_runs(spark.readStream.schema(FLAT_DDL).parquet(f"{folder}/in"), table, f"{folder}/state", "6 days").awaitTermination(180)
    spark.catalog.refreshTable(table)
    assert shown(latest_runs(spark.table(table))) == shown(latest_run_per_job(runs))


def plain_closure(edges):
    found = {(a, b): 1 for a, b in edges if a is not None and b is not None}
    steps = set(found)
    depth, fresh = 1, set(found)
    while fresh:
        depth += 1
        fresh = {(a, d) for a, b in fresh for c, d in steps if b == c} - set(found)
        found |= {pair: depth for pair in fresh}
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(f"w{rng.randrange(25)}", f"w{rng.randrange(25)}") for _ in range(28)] + [("w1", "w1"), (None, "w1"), ("w1", None), ("w1", "w1")]
    deps = spark.createDataFrame(edges, "WorkflowName string, DependsOn string")
    want = plain_closure(edges)
    assert {(a, b): d for a, b, d in shown(dependency_closure(deps), "WorkflowName", "Ancestor", "Depth")} == want
    failed = [f"w{k}" for k in range(25) if rng.random() < 0.5]
    rows = shown(root_causes(deps, spark.createDataFrame([(f,) for f in failed], "WorkflowName string")), "WorkflowName", "RootCause", "Depth")
    roots = {f for f in failed if not any((f, a) in want and (a, f) not in want for a in failed)}
    assert rows == sorted([(f, r, want[f, r]) for f in failed for r in roots if f != r and (f, r) in want] + [(r, r, 0) for r in roots], key=repr)


def test_closure_of_nothing_and_of_a_long_chain(spark):
    empty = spark.createDataFrame([], "WorkflowName string, DependsOn string")
    assert dependency_closure(empty).count() == 0
    assert root_causes(empty, spark.createDataFrame([("a",)], "WorkflowName string")).collect() == [("a", "a", 0)]
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(12)], "WorkflowName string, DependsOn string")
    assert dependency_closure(chain).agg(F.max("Depth"), F.count("*")).first() == (12, 78)


HISTORY = [("Bronze", "4:30 AM EST", "2024-01-05"), ("Bronze", "5:00 AM EST", "2024-01-10"), ("Bronze", None, "2024-01-20"), ("Gold", "1:00 AM EST", "2024-01-10")]


def test_sla_that_held_on_the_day(spark, no_broadcast):  # noqa: F811
    history = spark.createDataFrame([(a, b, dt.date.fromisoformat(c)) for a, b, c in HISTORY], "layer string, sla_text string, valid_from date")
    days = ["2024-01-04", "2024-01-05", "2024-01-09", "2024-01-10", "2024-01-19", "2024-01-20", "2024-01-25"]
    rows = [(layer, dt.date.fromisoformat(d), k) for k, d in enumerate(days) for layer in ("Bronze", "Gold", "Silver", None)] + [("Bronze", None, 9)] * 2
    frame = spark.createDataFrame(rows, "layer string, day date, id int").selectExpr("*", "'old' as sla_text")
    found = sla_as_of(frame, history)
    plan = physical(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {(r.layer, str(r.day)): r.SLA for r in found.collect()}
    bronze = [None, "4:30 AM EST", "4:30 AM EST", "5:00 AM EST", "5:00 AM EST", None, None]
    gold = [None, None, None, "1:00 AM EST", "1:00 AM EST", "1:00 AM EST", "1:00 AM EST"]
    assert [got["Bronze", d] for d in days] == bronze and [got["Gold", d] for d in days] == gold
    assert {got[x, d] for x in ("Silver", None) for d in days} == {None} and found.count() == len(rows)
    assert sla_as_of(frame, history.limit(0)).where("SLA is not null").count() == 0


def test_cut_off_after_midnight(spark):
    at = lambda text: dt.datetime.fromisoformat(text)
    rows = [("2024-01-15 23:59:00", "Y", "N"), ("2024-01-16 04:30:59", "Y", "N"), ("2024-01-16 04:31:00", "N", "N"), ("2024-01-15 04:30:00", "Y", "Y"), ("2024-01-17 01:00:00", "N", "N")]
    frame = spark.createDataFrame([(at(t), dt.date(2024, 1, 15), "4:30 AM EST", a, b) for t, a, b in rows], "finish timestamp_ntz, day date, sla string, a string, b string")
    met = [sla_met_by("finish", sla_deadline("day", "sla", k)) for k in (1, 0)]
    assert frame.where((met[0] != F.col("a")) | (met[1] != F.col("b"))).count() == 0
    nulls = spark.sql("select cast(null as timestamp_ntz) as finish, date'2024-01-15' as day, '4:30 AM EST' as sla union all select timestamp_ntz'2024-01-15 00:00:00', date'2024-01-15', 'soon'")
    assert [r[0] for r in nulls.select(sla_met_by("finish", sla_deadline("day", "sla"))).collect()] == ["N", "N"]


def test_counts_add_up_over_days(spark):
    rng = random.Random(3)
    names = [f"n{k}" for k in range(40)]
    rows = []
    for _ in range(900):
        name = "n0" if rng.random() < 0.3 else rng.choice(names)
        ran = rng.random() < 0.8
        state = rng.choice(("SUCCESS", "FAILED", None)) if ran else None
        rows.append((rng.choice(("Gold", "Bronze", None)), None, rng.randrange(4) or None, name, name if ran else None, state))
    status = spark.createDataFrame(rows, "layer string, SLA string, day int, DependsOn string, run_name string, result_state string")
    numbers = name_numbers(status.where("DependsOn < 'n3'"))
    numbers = name_numbers(status, numbers)  # names that come later are numbered on
    assert [r[0] for r in numbers.select("number").orderBy("number").collect()] == list(range(40))
    for spread in (1, 40_000):  # also numbers in many buckets
        days = layer_bitmaps(status, numbers.withColumn("number", F.col("number") * spread))
        for by in (("layer", "SLA", "day"), ("layer", "SLA"), ("day",)):
            got = counts_of_bitmaps(days, by)
            want = status.groupBy(*by).agg(
                F.count_distinct("DependsOn"), F.count_distinct("run_name"),
                F.count_distinct(F.when(F.col("result_state") == "SUCCESS", F.col("run_name"))),
                F.count_distinct(F.when(F.col("result_state") != "SUCCESS", F.col("run_name"))),
            ).toDF(*got.columns)
            assert shown(got) == shown(want)


def test_numbered_positions(spark):
    frame = spark.range(1000).selectExpr("id % 7 as a", "id as b").repartition(6)
    rows = numbered(frame, [F.col("a").desc(), F.col("b")]).collect()
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.position)] == sorted(((r.a, r.b) for r in rows), key=lambda r: (-r[0], r[1]))
    assert sorted(r.position for r in rows) == list(range(1000))
    assert numbered(frame.limit(0), [F.col("a")]).count() == 0


def test_newest_first_has_one_order(spark, make_runs):
    runs = make_runs(*((str(k), "7", "x", f"2024-01-{10 + k % 3} 01:00:00", None, None) for k in range(12))).withColumn("start_time_in_pst", F.col("start_time_in_est"))
    got = [int(r.run_id) for r in newest_first(runs.repartition(4)).collect()]
    assert got == sorted(range(12), key=lambda k: (-(k % 3), k))
