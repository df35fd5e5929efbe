"""The as-of join: each row with the last one of another table that isn't later."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, on: str, by: list[str], values: list[str]) -> DataFrame:
    """left with the values of the last row of right whose `on` is at most the row's own, else NULL.

    Union, then the last value over time: one shuffle on `by`, no pairs of rows. A row of right stands for its
    time even if its values are NULL. Of rows of right with equal times any one counts; equal rows of
    left all stay. A NULL `on` or a NULL `by` meets nothing.
    """
    keep = [c for c in left.columns if c not in values]
    known = [F.col(c).isNotNull() for c in (*by, on)]
    ok = known[0]
    for k in known[1:]:
        ok = ok & k
    a = left.select(*by, on, F.struct(*keep).alias("__row"), F.lit(1).alias("__side"))
    b = right.where(ok).select(*by, on, F.struct(*values).alias("__value"), F.lit(0).alias("__side"))
    w = Window.partitionBy(*by).orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("__value", F.last("__value", ignorenulls=True).over(w)).where("__side = 1")
    return both.select(*[F.col(f"__row.{c}").alias(c) for c in keep], *[F.when(ok, F.col(f"__value.{c}")).alias(c) for c in values])
