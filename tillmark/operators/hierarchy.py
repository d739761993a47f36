"""Levels of the employee tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillmark.functions.ordering import rising
from tillmark.operators.constraints import RuleBroken
from tillmark.operators.keyed import fits_broadcast, lookup_join
from tillmark.session import materialize


def employee_hierarchy(employees: DataFrame) -> DataFrame:
    """Every employee below a root (``manager_id`` is NULL) with its level; roots are level 1.

    ``employee_id`` must be unique, a repeated one is an error: its pointers would multiply. Employees
    in a cycle or under a missing manager are not reached and left out.

    Each employee points to an ancestor a known number of steps up. In every round the pointer
    is replaced by the ancestor's own pointer, so the distance doubles and a tree of depth d is
    done after log2(d) rounds instead of d joins. A round in which nobody's level becomes known
    is the last one: whoever is still open is in a cycle. The state is four numbers per
    employee, written to the shared folder after each round.
    """
    repeated = employees.groupBy("employee_id").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    if not repeated.isEmpty():
        raise RuleBroken("employee_id is not unique")
    step = employees.select(
        "employee_id",
        F.col("manager_id").alias("ancestor"),
        F.lit(1).cast("bigint").alias("steps"),
        F.when(F.col("manager_id").isNull(), F.lit(1)).cast("bigint").alias("level"),
    )
    small = fits_broadcast(step)  # later rounds look up no more rows than this
    known = step.filter(F.col("level").isNotNull())
    while True:
        opened = step.filter(F.col("level").isNull())
        above = known.unionByName(opened).select(
            F.col("employee_id").alias("_id"),
            F.col("ancestor").alias("_ancestor"),
            F.col("steps").alias("_steps"),
            F.col("level").alias("_level"),
        )
        moved = lookup_join(opened, above, "ancestor", "_id", "inner", ["employee_id"], small).select(
            "employee_id",
            F.col("_ancestor").alias("ancestor"),
            (F.col("steps") + F.col("_steps")).alias("steps"),
            (F.col("steps") + F.col("_level")).alias("level"),
        )
        counts = Observation()
        moved = moved.observe(counts, F.count("level").alias("found"),
                              F.count_if(F.col("level").isNull()).alias("waiting"))
        step = materialize(moved, "hierarchy")
        known = known.unionByName(step.filter(F.col("level").isNotNull()))
        if not counts.get["found"] or not counts.get["waiting"]:
            break
    levels = known.select(F.col("employee_id").alias("_id"), F.col("level").cast("int").alias("level"))
    staff = employees.select("employee_id", "name", "role", "manager_id")
    return (
        lookup_join(staff, levels, "employee_id", "_id", "inner", small=small, hot=None)
        .select("employee_id", "name", "role", "manager_id", "level")
        .orderBy(rising("level"), rising("manager_id"), "employee_id")
    )
