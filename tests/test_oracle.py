"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from tests.conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SQL_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


# No query may compare all pairs, none may leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def rows_of(arrow):
    columns = [arrow[name].to_pylist() for name in sorted(arrow.column_names)]
    return sorted(tuple(map(repr, row)) for row in zip(*columns, strict=True))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    wanted = duck.sql(ORACLE_SQL[name])
    types = {column: SQL_TYPES[kind] for column, kind in found.dtypes}
    assert types == dict(zip(wanted.columns, map(str, wanted.types), strict=True))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [word for word in UNWANTED if word in plan] == []
    assert rows_of(found.toArrow()) == rows_of(wanted.to_arrow_table())


def test_entry(spark):
    report = entry(spark)
    assert [row["Data Layer"] for row in report.collect()] == ["Bronze", "Gold", "Platinum"]


@pytest.mark.parametrize(
    "days_back, wanted",
    [
        (1, {"Bronze": (51, 42, 36, 6), "Gold": (50, 41, 30, 11), "Platinum": (50, 45, 40, 5)}),
        (2, {"Bronze": (51, 41, 35, 6), "Gold": (50, 36, 25, 11), "Platinum": (50, 41, 36, 5)}),
    ],
)
def test_layer_counts_known_in_advance(spark, days_back, wanted):
    from checks.views import AS_OF, dependencies, flat_runs
    from runtide.operators.layers import layer_status
    from runtide.plans.monitor import open_status, settled_today
    from runtide.sources.dependencies import SLA_BY_LAYER

    today = settled_today(flat_runs(spark, SF), AS_OF, days_back=days_back)
    status = open_status(today, dependencies(spark, SF), SLA_BY_LAYER)
    once = {row["Layer"]: row for row in layer_status(status, second_shift=False).collect()}
    twice = {row["Layer"]: row for row in layer_status(status).collect()}
    counts = ("DependsOnWorkflowCount", "RunWorkflowCount", "SuccessCount", "FailCount")
    assert {layer: tuple(row[c] for c in counts) for layer, row in once.items()} == wanted
    assert {layer: str(row["LatestRunTime"]) for layer, row in once.items()} == {
        "Bronze": "2024-01-16 02:14:46.652000",
        "Gold": "2024-01-16 01:01:31.419000",
        "Platinum": "2024-01-16 01:35:44.720000",
    }
    assert [once[layer]["SLA_MET"] for layer in wanted] == ["Y", "Y", "N"]
    assert [twice[layer]["LatestRunTime_only"] for layer in wanted] == ["9:14 PM EST", "8:01 PM EST", "8:35 PM EST"]
    assert [twice[layer]["SLA_MET"] for layer in wanted] == ["N", "N", "N"]
    assert {row["Status"] for row in once.values()} == {"Failed"}
