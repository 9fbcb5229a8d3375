"""Which columns a table has, out of those its profile speaks of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import Context


def schema_probe(ctx: Context) -> DataFrame:
    """One row per column and purpose: is it there, and how many rows fill it?"""
    profile = ctx.profile
    wanted = [(c, "required") for c in profile.required]
    wanted += [(c, "optional") for c in profile.optional]
    wanted += [(c, f"role:{r}") for r, c in profile.roles.items()]
    known = sorted({c for c, _ in wanted if ctx.has(c)})
    filled = ctx.complete(ctx.events().groupBy(*ctx.by).agg(
        *[F.count(c).alias(f"filled_{c}") for c in known]))
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(purpose).alias("purpose"),
                     F.lit(ctx.has(c)).alias("present"),
                     (F.col(f"filled_{c}") if ctx.has(c) else F.lit(0)).cast("bigint")
                     .alias("n_filled")) for c, purpose in wanted]
    return filled.select(*ctx.by, F.inline(F.array(*rows)))
