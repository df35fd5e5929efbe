"""From finer bars to coarser ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleforge.functions.timegrid import ceil_ts, floor_ts, parse_tf


def _first(col: str) -> Column:
    return F.min_by(col, F.when(F.col(col).isNotNull(), F.col("ts")))


def _last(col: str) -> Column:
    return F.max_by(col, F.when(F.col(col).isNotNull(), F.col("ts")))


def _bars(grouped, with_gap: bool) -> DataFrame:
    values = [_first("o").alias("o"), F.max("h").alias("h"), F.min("l").alias("l"), _last("c").alias("c")]
    sums = [F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in ("v", "t")]
    return grouped.agg(*values, *sums, *([F.bool_or(F.coalesce("is_gap", F.lit(False))).alias("is_gap")] if with_gap else []))


def resample(bars: DataFrame, tf: str, label: str = "start") -> DataFrame:
    """Windows [start, start + tf): first, max, min, last and sums; NULLs are passed over.

    Partial windows count. label is the side of the window that ts names, `start` or `end`.
    """
    if label not in ("start", "end"):
        raise ValueError(f"label: {label}")
    step = parse_tf(tf)
    start = floor_ts("ts", step)
    if "is_gap" not in bars.columns:
        bars = bars.withColumn("is_gap", F.lit(False))
    out = _bars(bars.groupBy("symbol", start.alias("__start")), True)
    ts = F.col("__start") + (step if label == "end" else 0)
    return out.select("symbol", F.lit(tf).alias("tf"), ts.alias("ts"), "o", "h", "l", "c", "v", "t", "is_gap")


def resample_closed_right(minutes: DataFrame, tf: str) -> DataFrame:
    """Windows (start, start + tf] named by their start: what coarser bars are compared with.

    Unlike `resample`, a minute on the edge counts to the window that ends there. Windows without rows
    between the first and the last have NULL prices and no volume.
    """
    step = parse_tf(tf)
    out = _bars(minutes.groupBy("symbol", (ceil_ts("ts", step) - step).alias("ts")), False)
    span = out.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    grid = span.select("symbol", F.explode(F.sequence("a", "b", F.lit(step).cast("long"))).alias("ts"))
    return grid.join(out, ["symbol", "ts"], "left").withColumns({x: F.coalesce(x, F.lit(0.0)) for x in ("v", "t")})
