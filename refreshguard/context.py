"""What a check runs on: tables, profile, months and limits.

One operator serves three scopes.  ``by`` is the list of extra grouping
columns an operator adds to every ``groupBy``, join and window:

* ``month``  events of one refresh month, ``by`` is empty;
* ``all``    events of every refresh, ``by`` is empty;
* ``range``  every month from ``start`` to ``month`` in one job, ``by`` is
  ``["month"]`` (a backfill).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import months
from .profile import DimensionColumns, TableProfile, Thresholds
from .sources.tables import sample_by_hash

MONTH = "month"
OWN = "own"


@dataclass(frozen=True)
class Context:
    profile: TableProfile
    events_table: DataFrame
    month: str
    as_of: date
    previous: str | None = None
    dimensions: Mapping[str, DataFrame] = field(default_factory=dict)
    scope: str = "month"
    start: str | None = None
    snapshot: str = "upto"
    thresholds: Thresholds = field(default_factory=Thresholds)
    names: DimensionColumns = field(default_factory=DimensionColumns)
    sample_rows: int = 0
    fold_allowed: bool = True

    def __post_init__(self):
        if self.scope not in ("month", "all", "range"):
            raise ValueError(f"unknown scope: {self.scope}")
        if self.snapshot not in ("upto", "exact", "every"):
            raise ValueError(f"unknown snapshot rule: {self.snapshot}")
        if self.scope == "range" and self.start is None:
            raise ValueError("a range needs its start month")

    def with_(self, **changes) -> Context:
        return replace(self, **changes)

    @property
    def spark(self) -> SparkSession:
        return self.events_table.sparkSession

    @property
    def by(self) -> list[str]:
        return [MONTH] if self.scope == "range" else []

    @property
    def columns(self) -> set[str]:
        return set(self.events_table.columns)

    def has(self, *columns: str | None) -> bool:
        return all(c is not None and c in self.columns for c in columns)

    def present(self, columns: Iterable[str]) -> list[str]:
        return [c for c in columns if c in self.columns]

    def _in_scope(self) -> DataFrame:
        refresh = F.col(self.profile.refresh_date)
        if self.scope == "all":
            return self.events_table
        return self.events_table.filter(months.in_months(
            refresh, self.start if self.scope == "range" else self.month, self.month))

    def _sampled(self, rows: DataFrame) -> DataFrame:
        """The rows of the sample: ``sample_rows`` events in scope, chosen by their id's hash.

        The limit is one number for the whole scope, so every check, and both
        sides of a comparison, see the same events.
        """
        if self.sample_rows <= 0:
            return rows
        return sample_by_hash(rows, self._in_scope(), self.profile.event_id, self.sample_rows)

    def events(self) -> DataFrame:
        """Event rows in scope, with the month column if the scope needs it."""
        rows = self._sampled(self._in_scope())
        if self.scope != "range":
            return rows
        return rows.withColumn(MONTH, months.month_start(F.col(self.profile.refresh_date)))

    def compared(self) -> DataFrame:
        """Event rows of the compared months with their own refresh month ``own``."""
        refresh = F.col(self.profile.refresh_date)
        if self.scope == "range":
            wanted = months.in_months(refresh, months.shift(self.start, -1), self.month)
        else:
            wanted = months.in_months(refresh, self.month)
            if self.previous:
                wanted = wanted | months.in_months(refresh, self.previous)
        return self._sampled(self.events_table.filter(wanted)).withColumn(
            OWN, months.month_start(refresh))

    def pair(self, rows: DataFrame) -> DataFrame:
        """Mark rows with an ``own`` month ``in_cur`` / ``in_prev`` of a comparison.

        In a range each row is the current month's row once and the previous
        month's row of the following month once; a month without data therefore
        compares against nothing, not against the last month that had some.
        """
        others = [c for c in rows.columns if c != OWN]
        if self.scope != "range":
            current = F.col(OWN) == F.lit(months.first_day(self.month))
            previous = (F.col(OWN) == F.lit(months.first_day(self.previous))
                        if self.previous else F.lit(False))
            return rows.select(*others, current.alias("in_cur"), previous.alias("in_prev"))
        sides = rows.selectExpr(*others, (
            f"inline(array(named_struct('{MONTH}', {OWN}, 'in_cur', true, 'in_prev', false), "
            f"named_struct('{MONTH}', add_months({OWN}, 1), 'in_cur', false, 'in_prev', true)))"))
        return sides.filter(months.in_months(F.col(MONTH), self.start, self.month))

    def paired(self) -> DataFrame:
        """Event rows marked for a month comparison."""
        return self.pair(self.compared())

    @property
    def accumulates(self) -> bool:
        """Whether a month of a range sees snapshots of other months."""
        return self.scope == "range" and self.snapshot != "exact"

    def dimension(self, name: str, *columns: str) -> DataFrame:
        """The snapshots of a dimension that the scope can see.

        ``exact`` keeps the snapshot of the month itself, ``upto`` every
        snapshot not later than it, ``every`` all there are, for events of every
        refresh.  In a range the rows carry a month: their own one, which for
        ``upto`` and ``every`` is the first month that sees the row.
        """
        refresh_name = self.names.refresh_date
        refresh = F.col(refresh_name)
        table = self.dimensions[name].select(refresh_name, *columns)
        if self.snapshot == "every":
            seen = F.lit(True)
        elif self.snapshot == "exact":
            seen = months.in_months(refresh, self.start or self.month, self.month)
        else:
            seen = months.before_month_end(refresh, self.month)
        table = table.filter(seen)
        if self.scope != "range":
            return table
        own = months.month_start(refresh)
        if self.snapshot == "every":
            own = F.lit(months.first_day(self.start))
        elif self.snapshot == "upto":
            own = F.greatest(own, F.lit(months.first_day(self.start)))
        return table.withColumn(MONTH, own)

    def spine(self) -> DataFrame:
        """One row per month of the range."""
        count = months.months_between(self.start, self.month)
        first = F.lit(months.first_day(self.start))
        return self.spark.range(count, numPartitions=1).select(
            F.add_months(first, F.col("id").cast("int")).alias(MONTH))

    def labels(self) -> DataFrame:
        """One row per reporting month, for rows that need no data."""
        return self.spine() if self.by else self.spark.range(1, numPartitions=1)

    def complete(self, wide: DataFrame) -> DataFrame:
        """Add the months that have no row; their counts are 0.

        A global aggregate always has its row, so outside a range this is the
        identity.
        """
        if self.scope != "range":
            return wide
        return self.spine().join(wide, MONTH, "left").na.fill(0)
