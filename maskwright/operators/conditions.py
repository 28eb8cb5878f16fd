"""Conditions of rules as data: predicates over a table's other columns, read from a rulebook.

A condition is parsed by Spark and never put together from text. What it reads is taken from the
parsed tree and checked against the catalog before anything runs. It sees the unmasked row; a
rule with a condition masks the rows for which it is true or null: when in doubt, mask.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a tree that are no predicate over one row.
_NO_PREDICATE = ("Subquery", "Exists", "Window", "UnresolvedStar", "Lambda")
#: Functions that run code of the rulebook's choice, or change from run to run.
_REFUSED = frozenset("reflect java_method try_reflect rand randn random uuid shuffle now current_timestamp".split())


def _nodes(tree) -> Iterator:
    yield tree
    children = tree.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def columns_of(spark: SparkSession, condition: str) -> list[str] | None:
    """The columns a condition reads, or None if it is no predicate over a row's columns."""
    try:
        tree = spark._jsparkSession.sessionState().sqlParser().parseExpression(condition)
    except Exception:  # of the parser; its text could quote data
        return None
    found = []
    for node in _nodes(tree):
        kind = node.getClass().getSimpleName()
        if any(part in kind for part in _NO_PREDICATE):
            return None
        if kind == "UnresolvedFunction":
            name = node.nameParts()
            if name.size() != 1 or name.apply(0).lower() in _REFUSED:
                return None
        if kind == "UnresolvedAttribute":
            parts = node.nameParts()
            if parts.size() != 1:
                return None
            found.append(parts.apply(0))
    return sorted(set(found))


def fits(df: DataFrame, condition: str) -> bool:
    """Whether the condition is a deterministic predicate on the rows of ``df``."""
    columns = columns_of(df.sparkSession, condition)
    if columns is None or not set(columns) <= set(df.columns):
        return False
    try:
        plan = df.limit(0).where(F.expr(condition))._jdf.queryExecution().analyzed()
    except Exception:  # no such function, no predicate, types that do not match
        return False
    return all(plan.expressions().apply(i).deterministic() for i in range(plan.expressions().size()))
