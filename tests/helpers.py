"""What the tests share besides fixtures."""

from __future__ import annotations

import datetime


def at(hour: int, minute: int = 0, second: int = 0) -> datetime.datetime:
    return datetime.datetime(2024, 3, 10, hour, minute, second)


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def plan_of(df) -> str:
    """The physical plan, after the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scan_metrics(df, column: str | None = None) -> dict[str, int]:
    """The counts of the scan of a file after ``df`` has run, of the one that reads ``column`` if there are several."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, found = _leaves(plan), []
    for leaf in leaves:
        if leaf.metrics().contains("numFiles") and (column is None or column in leaf.schema().simpleString()):
            metrics = leaf.metrics()
            found.append({m: metrics.apply(m).value() for m in ("numFiles", "filesSize", "numOutputRows", "numPartitions") if metrics.contains(m)})
    assert len(found) == 1, found
    return found[0]


def _leaves(plan) -> list:
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _leaves(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _leaves(plan.plan())
    children = plan.children()
    if children.isEmpty():
        return [plan]
    return [leaf for i in range(children.size()) for leaf in _leaves(children.apply(i))]


def planned(df) -> str:
    """The physical plan before adaptive execution changes it."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]
