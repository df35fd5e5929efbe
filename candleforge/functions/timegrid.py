"""Epoch milliseconds on the grid of a timeframe. Days are UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MINUTE, DAY = 60_000, 86_400_000
_UNIT = {"s": 1_000, "m": MINUTE, "min": MINUTE, "h": 60 * MINUTE}


def parse_tf(tf: str) -> int:
    """Milliseconds of `<n>m`, `<n>min`, `<n>h` or `<n>s`."""
    m = re.fullmatch(r"(\d+)(s|m|min|h)", tf.strip().lower())
    if not m or int(m[1]) < 1:
        raise ValueError(f"unknown timeframe: {tf}")
    return int(m[1]) * _UNIT[m[2]]


def interval(tf: str) -> str:
    """The timeframe for window() and watermarks."""
    return f"{parse_tf(tf)} milliseconds"


def whole_minutes(tf: str) -> bool:
    return parse_tf(tf) % MINUTE == 0


def floor_ts(ts: Column | str, tf_ms: int) -> Column:
    """Floors before 1970, too: div would cut towards zero."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts - F.pmod(ts, F.lit(tf_ms).cast("long"))


def ceil_ts(ts: Column | str, tf_ms: int) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts + F.pmod(-ts, F.lit(tf_ms).cast("long"))


def parent_start(ts: Column | str, tf: str) -> Column:
    """Where the bar of the coarser timeframe begins that holds a minute."""
    return floor_ts(ts, parse_tf(tf))


def align_range(start: int, end: int, tf: str) -> tuple[int, int]:
    """The range widened to the grid; an empty one is (its start, its start)."""
    step = parse_tf(tf)
    low = start - start % step
    return (low, low) if end <= start else (low, end + -end % step)


def day_bounds(ts: int) -> tuple[int, int]:
    low = ts - ts % DAY
    return low, low + DAY


def misaligned(df: DataFrame, tf: str = "1m") -> DataFrame:
    """One row: how many ts are off the grid."""
    off = F.pmod("ts", F.lit(parse_tf(tf)).cast("long")) != 0
    return df.agg(F.count_if(off).alias("misaligned"))


def minute_grid(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Minutes of the half-open range, from its first whole minute on."""
    low = start + -start % MINUTE
    return spark.range(low, end, MINUTE).withColumnRenamed("id", "ts")
