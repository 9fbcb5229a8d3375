"""What several operators need: tables, folds and bounded samples."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 1 << 30
#: Rows of a few numbers and names that may be broadcast.
SENT = 200_000
#: What a Python worker holds of a table at once.  Executors run several workers beside their heap.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sent(frame: DataFrame, rows: int = SENT) -> DataFrame:
    """The frame, broadcast if it has at most so many (narrow) rows; a larger one is left to a shuffle."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def small_batches(spark: SparkSession) -> None:
    """Let the session send Arrow batches of a few MB at most; smaller settings stay."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(key).lower()).groups()
        given = int(number) << 10 * " kmgt".index(unit or " ")
        if given <= 0 or given > most:
            spark.conf.set(key, str(most))


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids that no label may be learned from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def bounded_sample(frame: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows (all, if there are fewer), chosen by the hash of a key: the same in each run."""
    n = frame.count()
    if n <= rows:
        return frame
    return frame.filter(F.pmod(F.xxhash64(key), F.lit(SCALE)) < math.ceil(rows / n * SCALE))


def join_spans(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of an array of (start, kind's index, end), by start and kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"),
        x["end"].cast("string"))))
