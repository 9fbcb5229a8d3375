"""Top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ratios import percent


def top_k(rows: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order`` of each group.

    Without a group this is ``orderBy.limit`` (each task keeps k rows).  With
    one, the rank filter is applied per task before the shuffle too, so a group
    never gathers in one task.  ``order`` must end in a key: ties would make
    the result depend on row order.
    """
    if not by:
        return rows.orderBy(*order).limit(k)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def top_with_total(counts: DataFrame, by: Sequence[str], key: str, k: int,
                   n: str = "n", order_by: str | None = None) -> DataFrame:
    """One row per group: ``total`` and the ``top`` k keys as an array.

    Array elements are ``(rank_value, key, n, m)``: the ordering count negated,
    the key, the count behind the share and the ordering count.  The array never
    has more than k elements, and the group always has its total, so shares
    need no further join.  Outside a group there is one row even without data.
    """
    order_by = order_by or n
    item = F.struct((-F.col(order_by)).alias("rank_value"), F.col(key).alias("key"),
                    F.col(n).alias("n"), F.col(order_by).alias("m"))
    best = (top_k(counts, by, [F.desc(order_by), F.asc(key)], k)
            .select(*by, item.alias("item"), F.lit(None).cast("bigint").alias("part")))
    totals = (counts.groupBy(*by).agg(F.sum(n).alias("part"))
              .select(*by, F.lit(None).cast(best.schema["item"].dataType).alias("item"), "part"))
    return best.unionByName(totals).groupBy(*by).agg(
        F.coalesce(F.sum("part"), F.lit(0)).alias("total"),
        F.array_sort(F.collect_list("item")).alias("top"))


def share_rows(summary: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """The top keys as rows ``(key, n, share)``, share in percent."""
    rows = summary.select(*by, "total", F.inline("top"))
    return rows.selectExpr(*by, f"key as {key}", "n", "m", f"{percent('n', 'total')} as share")


def top_share(top: str, total: str) -> str:
    """Share of the first key, as SQL; 0 without one."""
    return percent(f"try_element_at({top}, 1).n", total)
