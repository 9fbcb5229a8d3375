"""Checks that need nothing but one pass over the events.

Completeness, validity and date order are all conditional counts over the same
rows, so any number of them is one aggregation: Spark combines it map-side and
shuffles one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import Context
from ..functions.measures import Measure, rows_of

ROWS = "n"


@dataclass
class ScanChecks:
    category: str
    prefix: str = ""
    conditions: dict[str, str] = field(default_factory=dict)
    measures: list[Measure] = field(default_factory=list)

    def count_if(self, name: str, condition: str) -> str:
        """Register a conditional count; the result is its column."""
        name = self.prefix + name
        self.conditions[name] = condition
        return name

    def add(self, measure: Measure) -> None:
        self.measures.append(measure)


def run_scan(ctx: Context, *groups: ScanChecks) -> DataFrame:
    """All given checks in one aggregation over the events in scope."""
    conditions = {name: c for group in groups for name, c in group.conditions.items()}
    counts = [F.expr(f"count_if({c}) as {name}") for name, c in conditions.items()]
    wide = ctx.events().groupBy(*ctx.by).agg(F.count("*").alias(ROWS), *counts)
    structs = [m.as_struct(g.category) for g in groups for m in g.measures]
    return rows_of(ctx.complete(wide), ctx.by, structs)
