"""Normalising minute bars, filling gaps, and statistics of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleforge.functions.timegrid import MINUTE, floor_ts
from candleforge.schema import KEY, by_time, coerce, last_wins, with_key


def align_gaps(bars: DataFrame, step: int = MINUTE) -> DataFrame:
    """Bars on the grid from each series' first to its last ts; missing ones are flagged.

    A missing bar takes the last known close for its prices and 0 for v and t. Rows off the grid that
    starts at the first ts go; NULLs of rows that are there stay. Each row makes the missing bars up to
    the next one, so there is no join with a grid.
    """
    first = F.min("ts").over(Window.partitionBy(*KEY))
    on_grid = bars.withColumn("__first", first).where(F.pmod(F.col("ts") - F.col("__first"), F.lit(step).cast("long")) == 0)
    known = F.last("c", ignorenulls=True).over(by_time().rowsBetween(Window.unboundedPreceding, 0))
    ahead = on_grid.withColumns({"__known": known, "__next": F.lead("ts").over(by_time())})
    stop = F.coalesce(F.col("__next") - step, F.col("ts"))
    every = ahead.withColumn("__at", F.explode(F.sequence("ts", stop, F.lit(step).cast("long"))))
    gap = F.col("__at") > F.col("ts")
    values = [F.when(gap, F.col("__known")).otherwise(F.col(c)).alias(c) for c in ("o", "h", "l", "c")]
    zero = [F.when(gap, F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in ("v", "t")]
    flag = F.when(gap, F.lit(True)).otherwise(F.coalesce("is_gap", F.lit(False))) if "is_gap" in bars.columns else gap
    return every.select(*KEY, F.col("__at").alias("ts"), *values, *zero, flag.alias("is_gap"))


def normalize_bars(raw: DataFrame, seq: str, symbol: str = "?") -> tuple[DataFrame, DataFrame]:
    """(aligned minute bars, one row of statistics a series) of raw input.

    Coerced, floored to the minute, the greatest seq wins a minute, gaps filled.
    """
    rows = with_key(coerce(raw, extra=(seq,)), symbol, "1m")
    floored = rows.withColumns({"__off": (F.pmod("ts", F.lit(MINUTE).cast("long")) != 0).cast("int"), "ts": floor_ts("ts", MINUTE)})
    aligned = align_gaps(last_wins(floored.drop("__off"), seq).drop(seq))
    before = floored.groupBy(*KEY).agg(
        F.count("*").alias("rows_in"), F.sum("__off").alias("misaligned_fixed"), (F.count("*") - F.count_distinct("ts")).alias("dup_removed")
    )
    return aligned, before.join(gap_stats(aligned), KEY)


def gap_stats(aligned: DataFrame) -> DataFrame:
    """A row a series: rows_out, min_ts, max_ts, span, gaps, gap_pct (percent of the span)."""
    span = ((F.max("ts") - F.min("ts")) / MINUTE + 1).cast("long")
    gaps = F.count_if("is_gap")
    return aligned.groupBy(*KEY).agg(
        F.count("*").alias("rows_out"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), span.alias("span"),
        gaps.alias("gaps"), (gaps / F.greatest(F.lit(1), span) * 100).alias("gap_pct"),
    )


def missing_report(aligned: DataFrame, since_ms: int | None = None, until_ms: int | None = None) -> DataFrame:
    """A row a series: total, gaps, gap_pct (0 to 1) of the half-open range."""
    if since_ms is not None:
        aligned = aligned.where(F.col("ts") >= since_ms)
    if until_ms is not None:
        aligned = aligned.where(F.col("ts") < until_ms)
    gaps = F.count_if(F.coalesce("is_gap", F.lit(False)))
    return aligned.groupBy(*KEY).agg(F.count("*").alias("total"), gaps.alias("gaps"), (gaps / F.count("*")).alias("gap_pct"))


def range_gaps(bars: DataFrame, since_ms: int | None = None, until_ms: int | None = None) -> DataFrame:
    """One row: total_minutes, gaps, gap_pct (percent) of one series' half-open range, its edges included.

    A side that isn't given is the first bar, or the end of the last one. Rows flagged as gaps are gaps. Nothing
    is filled: minutes that are there are counted.
    """
    low, high = (F.min("ts") if since_ms is None else F.lit(since_ms + -since_ms % MINUTE)), (F.max("ts") + MINUTE if until_ms is None else F.lit(until_ms + -until_ms % MINUTE))
    if since_ms is not None:
        bars = bars.where(F.col("ts") >= since_ms)
    if until_ms is not None:
        bars = bars.where(F.col("ts") < until_ms)
    have = F.when(~F.coalesce("is_gap", F.lit(False)), floor_ts("ts", MINUTE)) if "is_gap" in bars.columns else floor_ts("ts", MINUTE)
    out = bars.agg(F.greatest(F.coalesce((high - low) / MINUTE, F.lit(0)), F.lit(0)).cast("long").alias("total_minutes"), F.count_distinct(have).alias("n"))
    gaps = F.col("total_minutes") - F.col("n")
    return out.select("total_minutes", gaps.alias("gaps"), F.when(F.col("total_minutes") > 0, gaps / F.col("total_minutes") * 100).otherwise(0.0).alias("gap_pct"))
