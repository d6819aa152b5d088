"""The dependency table and the SLA table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runtide.schema import DEPENDENCY_SCHEMA

# Subject area, its workflow, the workflow that it depends on, data layer.
EXAMPLE_DEPENDENCIES = (
    ("DataModel 1", "DE-Gold-Workflow-DataModel-1", "Load_edw_Bronze", "Bronze"),
    ("DataModel 1", "DE-Gold-Workflow-DataModel-1", "Load_edw_Gold", "Bronze"),
    ("DataModel 1", "DE-Gold-Workflow-DataModel-1", "Load_edw_Silver", "Bronze"),
    ("DataModel 2", "DE-Gold-Workflow-DataModel-2", "Load_edw_Bronze", "Gold"),
    ("DataModel 2", "DE-Gold-Workflow-DataModel-2", "Load_edw_Gold", "Gold"),
    ("DataModel 2", "DE-Gold-Workflow-DataModel-2", "Load_edw_Silver", "Gold"),
)

# Latest finish of each data layer.
SLA_BY_LAYER = {"Bronze": "4:30 AM EST", "Gold": "5:30 AM EST"}


def read_dependencies(spark: SparkSession, path: str | None = None, format: str = "parquet") -> DataFrame:
    """The dependency table at `path`, columns in their fixed order; the shipped rows without a path."""
    if path is None:
        return spark.createDataFrame(list(EXAMPLE_DEPENDENCIES), DEPENDENCY_SCHEMA)
    return spark.read.format(format).load(path).select(*DEPENDENCY_SCHEMA.fieldNames())
