"""Physical-plan inspection: exchanges, joins and Python evaluation in a plan."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
PAIR_EXPLOSIONS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def physical_plan(df: DataFrame) -> str:
    """The final physical plan as text (for adaptive plans, the initial plan)."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(plan: str, name: str) -> int:
    return len(re.findall(rf"\b{name}\b", plan))


def exchanges(df: DataFrame) -> int:
    """Shuffle exchanges planned (reused exchanges are not counted)."""
    return count_nodes(physical_plan(df), "Exchange hashpartitioning") + \
        count_nodes(physical_plan(df), "Exchange rangepartitioning") + \
        count_nodes(physical_plan(df), "Exchange SinglePartition")


def uses_python(df: DataFrame) -> bool:
    plan = physical_plan(df)
    return any(n in plan for n in PYTHON_NODES)


def explodes_pairs(df: DataFrame) -> bool:
    plan = physical_plan(df)
    return any(n in plan for n in PAIR_EXPLOSIONS)
