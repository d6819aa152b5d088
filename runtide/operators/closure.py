"""Chains of dependencies: what a workflow depends on through others, and which failure stands at the root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.plans.lineage import settle_counted


def dependency_closure(deps: DataFrame) -> DataFrame:
    """(WorkflowName, Ancestor, Depth): everything each workflow depends on, directly (1) or through others, by the shortest chain.

    Each round joins the pairs found last with the direct dependencies and keeps those not known yet, until none is left. So
    a cycle ends by itself (its members are ancestors of themselves) and a pair is extended once, however many
    chains lead to it. A recursive SQL query would keep one row for each chain, and Spark limits the rows of it. Rows
    with a null name lead nowhere.
    """
    edges = deps.select("WorkflowName", F.col("DependsOn").alias("Ancestor")).dropna().distinct()
    edges, left = settle_counted(edges, "edges")
    steps = edges.select(F.col("WorkflowName").alias("Ancestor"), F.col("Ancestor").alias("Next"))
    known = fresh = edges.withColumn("Depth", F.lit(1))
    depth = 1
    while left:
        depth += 1
        reached = fresh.join(steps, "Ancestor").select("WorkflowName", F.col("Next").alias("Ancestor")).distinct()
        reached = reached.join(known, ["WorkflowName", "Ancestor"], "left_anti").withColumn("Depth", F.lit(depth))
        fresh, left = settle_counted(reached, "closure")
        known = known.unionByName(fresh)
    return known


def root_causes(deps: DataFrame, failed: DataFrame, closure: DataFrame | None = None) -> DataFrame:
    """(WorkflowName, RootCause, Depth): for each failed workflow the failures it may follow from that follow from none.

    `failed` has the names of failed workflows in `WorkflowName`. A failed workflow without a failed ancestor is its own root at depth 0.
    Failed members of one cycle are each other's ancestors; none is before the others, and all are roots unless a
    failure outside of the cycle leads to it.
    """
    closure = dependency_closure(deps) if closure is None else closure
    names = failed.select("WorkflowName").dropna().distinct()
    above = closure.join(names, "WorkflowName", "left_semi").join(names.select(F.col("WorkflowName").alias("Ancestor")), "Ancestor", "left_semi")
    # Pairs that also hold the other way round are of one cycle.
    back = closure.select(F.col("Ancestor").alias("WorkflowName"), F.col("WorkflowName").alias("Ancestor"))
    follows = above.join(back, ["WorkflowName", "Ancestor"], "left_anti").select("WorkflowName").distinct()
    roots = names.join(follows, "WorkflowName", "left_anti").select(F.col("WorkflowName").alias("RootCause"))
    led = above.where("WorkflowName <> Ancestor").withColumnRenamed("Ancestor", "RootCause").join(roots, "RootCause")
    own = roots.select(F.col("RootCause").alias("WorkflowName"), "RootCause", F.lit(0).alias("Depth"))
    return led.select("WorkflowName", "RootCause", "Depth").unionByName(own)
