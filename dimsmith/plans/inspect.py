"""Plan inspection from ``DataFrame.explain`` text: joins, exchanges, scans.

Used by the plan tests (trusted marts must show no joins, the control seven)
and by the benchmark to record the shape of each query's plan.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PHYSICAL_JOINS = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
                  "BroadcastNestedLoopJoin", "CartesianProduct")


def explain_text(df: DataFrame, mode: str = "extended") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _section(text: str, title: str) -> str:
    m = re.search(rf"== {re.escape(title)} ==\n(.*?)(?:\n== |\Z)", text, re.S)
    return m.group(1) if m else ""


def optimized_plan(df: DataFrame) -> str:
    return _section(explain_text(df, "extended"), "Optimized Logical Plan")


def physical_plan(df: DataFrame) -> str:
    return _section(explain_text(df, "extended"), "Physical Plan")


def logical_joins(df: DataFrame) -> int:
    """Joins left in the optimized logical plan (before physical planning)."""
    return len(re.findall(r"(?m)^[\s:+\-|]*Join ", optimized_plan(df)))


def physical_joins(df: DataFrame) -> int:
    plan = physical_plan(df)
    return sum(len(re.findall(rf"\b{j}\b", plan)) for j in PHYSICAL_JOINS)


def exchanges(df: DataFrame) -> int:
    """Shuffle exchanges in the initial physical plan (broadcasts excluded)."""
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                          physical_plan(df)))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", explain_text(df, "formatted"))


def summary(df: DataFrame) -> dict:
    return {"logical_joins": logical_joins(df), "physical_joins": physical_joins(df),
            "exchanges": exchanges(df)}
