"""Constraints that one row alone can break, as conditions and as counters.

The counters are plain aggregates: partial counts in the tasks, no shuffle, and measured while a table
is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealtide.model import Table


def row_rules(table: Table) -> list[tuple[str, str, Column]]:
    """``(rule, column, violated)`` for the constraints that one row alone can break."""
    rules = [("NOT_NULL", c, F.col(c).isNull()) for c in table.required]
    rules += [("NOT_NEGATIVE", c, F.col(c) < 0) for c in table.not_negative]
    rules += [("POSITIVE", c, F.col(c) <= 0) for c in table.positive]
    rules += [("DOMAIN", c, ~F.col(c).isin(*values)) for c, values in table.domains.items()]
    return rules


def measures(table: Table, columns: Sequence[str]) -> list[Column]:
    """Aggregates for an :class:`Observation` or ``agg``, or none if a column of a rule is missing;
    :func:`broken` reads their values."""
    rules = row_rules(table)
    if not {c for _, c, _ in rules} <= set(columns):
        return []
    return [F.count_if(violated).alias(f"broken.{rule}.{c}") for rule, c, violated in rules]


def broken(measured: Mapping[str, int]) -> dict[str, int]:
    """``rule.column`` -> rows that break it, from the values of :func:`measures`."""
    start = "broken."
    return {name[len(start):]: n for name, n in measured.items() if name.startswith(start)}
