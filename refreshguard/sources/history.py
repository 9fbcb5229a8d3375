"""The result history: combining, appending, committing once, and reading the latest run.

``append`` adds rows to a table or path.  ``commit`` writes the rows of a run such
that the same run written again takes the place of what it wrote before: the
layout has a folder for each run, table and family, written by dynamic
partition overwrite, and a manifest of the finished ones beside the rows.  A
part is marked open before it is written and done after, so readers see a
part whole or not at all, whatever died in between.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import RESULT_SCHEMA

#: The folder of the manifest below a history; Spark passes over it when it reads the rows.
MANIFEST = "_parts"
PART = ["run_id", "events_table_name", "check_category"]
MANIFEST_SCHEMA = ("run_id string, events_table_name string, check_category string, state string, "
                   "n_rows bigint")
OPEN, DONE = "open", "done"


def combine(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Union by name in result-column order.

    ``None`` and frames that lack a result column are left out; an empty frame
    adds no rows, so it needs no test (and no job).
    """
    names = RESULT_SCHEMA.fieldNames()
    usable = [f.select(*names) for f in frames
              if f is not None and set(names) <= set(f.columns)]
    return reduce(DataFrame.unionByName, usable) if usable else None


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_SCHEMA)


def append(results: DataFrame | None, target: str, fmt: str = "parquet") -> bool:
    """Append results to a table name or to a path.

    What is new is split by refresh month; an existing table keeps the layout
    it has.  Returns whether there was anything to write.  Files go through Spark's
    commit protocol, so a lost executor leaves no half-written rows behind.
    """
    if results is None:
        return False
    # The rows are few and come from many branches: one file a month.
    rows = results.select(*RESULT_SCHEMA.fieldNames()).repartition("refresh_month")
    spark = rows.sparkSession
    writer = rows.write.mode("append").format(fmt).partitionBy("refresh_month")
    if "/" in target:
        writer.save(target)
    elif spark.catalog.tableExists(target):
        rows.select(*spark.table(target).columns).write.insertInto(target)
    else:
        writer.saveAsTable(target)
    return True


def read_history(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    if "/" not in target:
        return spark.table(target).select(*RESULT_SCHEMA.fieldNames())
    schema = RESULT_SCHEMA
    return spark.read.format(fmt).schema(schema).load(target).select(*schema.fieldNames())


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the most recent run, ordered for reading."""
    newest = history.agg(F.max("run_start_time")).scalar()
    return (history.filter(F.col("run_start_time") >= newest)
            .select("check_category", "check_name", "metric_name", "metric_value",
                    "status", "details")
            .orderBy("check_category", "check_name"))


# -- runs that count once -----------------------------------------------------

def _overwrite(rows: DataFrame, path: str) -> None:
    """Write the partitions that occur in the rows; all others stay as they are."""
    (rows.repartition(*PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PART).parquet(path))


def _mark(spark: SparkSession, target: str, parts: Iterable[tuple], state: str,
          counts: dict[tuple, int]) -> None:
    rows = [(*p, state, counts.get(p, 0)) for p in parts]
    _overwrite(spark.createDataFrame(rows, MANIFEST_SCHEMA), f"{target}/{MANIFEST}")


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """One row per part of a run: its state and rows."""
    try:
        found = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{target}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], MANIFEST_SCHEMA)
    return found.select(*PART, "state", "n_rows")


def finished(spark: SparkSession, target: str, run_id: str) -> set[tuple[str, str]]:
    """(table, family) of the finished parts of a run: at most its tables times the families."""
    rows = manifest(spark, target).filter((F.col("run_id") == run_id) & (F.col("state") == DONE))
    return {(r["events_table_name"], r["check_category"]) for r in rows.collect()}


def commit(results: DataFrame, target: str, run_id: str, table: str,
           families: Sequence[str]) -> None:
    """Write the rows of some families of a run over a table, in place of what it wrote before.

    ``target`` is a path.  A family without rows is finished too; rows that it had before
    are no longer read.
    """
    spark = results.sparkSession
    parts = [(run_id, table, family) for family in families]
    mine = ((F.col("run_id") == run_id) & (F.col("events_table_name") == table)
            & F.col("check_category").isin(list(families)))
    _mark(spark, target, parts, OPEN, {})
    _overwrite(results.select(*RESULT_SCHEMA.fieldNames()).filter(mine), target)
    written = (_stored_rows(spark, target).filter(mine).groupBy(*PART).count().collect())
    counts = {tuple(r[c] for c in PART): r["count"] for r in written}
    _mark(spark, target, parts, DONE, counts)


def _stored_rows(spark: SparkSession, target: str) -> DataFrame:
    schema = RESULT_SCHEMA
    return spark.read.schema(schema).parquet(target).select(*schema.fieldNames())


def read_committed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of finished parts."""
    done = manifest(spark, target).filter((F.col("state") == DONE) & (F.col("n_rows") > 0))
    return _stored_rows(spark, target).join(done.select(*PART), PART, "left_semi").select(
        *RESULT_SCHEMA.fieldNames())
