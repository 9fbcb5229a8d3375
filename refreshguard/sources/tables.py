"""Table scans, row samples, refresh months and column probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import months


def read_table(spark: SparkSession, catalog: str, schema: str, table: str) -> DataFrame:
    """A catalog table by its three-part name; a missing table raises."""
    return spark.table(f"{catalog}.{schema}.{table}")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sample(table: DataFrame, rows: int, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``rows`` rows, or the whole table for 0.

    Without ``order`` Spark takes whichever rows come first; with it the sample
    is reproducible.
    """
    if rows <= 0:
        return table
    return (table.orderBy(*order) if order else table).limit(rows)


def sample_by_hash(table: DataFrame, scope: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of a table whose key's hash is among the ``rows`` least of a scope's rows.

    The greatest of these hashes is a scalar of the plan; the rows of a key stay
    together and are the same wherever the sample is taken.
    """
    hashed = F.xxhash64(F.col(key))
    last = (scope.select(hashed.alias("h")).orderBy("h").limit(rows)
            .agg(F.max("h").alias("h")).scalar())
    return table.filter(hashed <= last)


def latest_refresh_month(events: DataFrame, refresh_date: str) -> DataFrame:
    """One row, ``latest_month``; NULL for an empty table.

    ``max`` runs over the bare column, the only one that is read; the label is
    made from the result.
    """
    return (events.agg(F.max(refresh_date).alias("latest"))
            .select(months.label(F.col("latest")).alias("latest_month")))


def previous_month(events: DataFrame, refresh_date: str, month: str) -> DataFrame:
    """One row, ``previous_month``: the month before if it has rows, else NULL."""
    before = months.shift(month, -1)
    found = (events.filter(months.in_months(F.col(refresh_date), before))
             .select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("n")))
    return found.select(F.when(F.col("n") > 0, F.lit(before)).alias("previous_month"))


def resolve_months(events: DataFrame, refresh_date: str) -> tuple[str | None, str | None]:
    """Current and previous month as two driver-side scalars."""
    current = latest_refresh_month(events, refresh_date).first()[0]
    if current is None:
        return None, None
    before = months.shift(current, -1)
    rows = events.filter(months.in_months(F.col(refresh_date), before)).select(refresh_date)
    # take(1) starts with one task and stops at the first row.
    return current, before if rows.take(1) else None
