"""The fixed result schema and how metric rows become result rows."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import months

# The columns of a result table, in order.
RESULT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_start_time", T.TimestampType(), False),
    T.StructField("events_table_name", T.StringType(), False),
    T.StructField("refresh_month", T.StringType(), False),
    T.StructField("check_category", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("details", T.StringType(), True),
])


def new_run() -> tuple[str, datetime]:
    """A run identity: start time and an id made of it plus 8 hex digits."""
    now = datetime.now()
    return f"{now:%Y%m%d_%H%M%S}_{uuid4().hex[:8]}", now


def signed_percent(metric_name: Column, value: Column, text: Column) -> Column:
    """The notation ``+10.50%`` for percentage metrics, ``N/A`` for nothing.

    A metric counts as a percentage by its name; other metrics keep their text.
    """
    by_name = metric_name.rlike("(?i)%|percentage|pct")
    return F.coalesce(
        F.when(by_name & value.isNotNull(), F.format_string("%+.2f%%", value)).otherwise(text),
        F.lit("N/A"))


def to_results(metrics: DataFrame, run_id: str, run_start_time: datetime, table: str,
               month: str | None = None, signed: bool = False) -> DataFrame:
    """Metric rows in the result schema.

    ``month`` labels the rows unless they carry a month column of their own.
    """
    if "month" in metrics.columns:
        refresh_month = months.label(F.col("month"))
    else:
        refresh_month = F.lit(month)
    shown = F.col("metric_value")
    if signed:
        shown = signed_percent(F.col("metric_name"), F.col("value"), shown)
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_start_time).cast("timestamp").alias("run_start_time"),
        F.lit(table).alias("events_table_name"),
        refresh_month.alias("refresh_month"),
        "check_category", "check_name", "metric_name",
        shown.alias("metric_value"),
        "status", "details")
