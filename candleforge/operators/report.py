"""Reports and gates over validated bars."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.functions.timegrid import MINUTE
from candleforge.schema import KEY


def quality_summary(clean: DataFrame) -> DataFrame:
    """A row a series: min_ts, max_ts, bars, flagged_ratio, calendar_gap_ratio_1m."""
    calendar = (F.max("ts") - F.min("ts")) / MINUTE + 1
    return clean.groupBy(*KEY).agg(
        F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.count("*").alias("bars"),
        F.avg((F.col("dq_flags") != 0).cast("int")).alias("flagged_ratio"), F.greatest(F.lit(0.0), 1 - F.count("*") / calendar).alias("calendar_gap_ratio_1m"),
    )


def daily_flagged(clean: DataFrame) -> DataFrame:
    day = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    return clean.groupBy(*KEY, day.alias("day")).agg(F.count("*").alias("bars"), F.avg((F.col("dq_flags") != 0).cast("int")).alias("flagged_ratio"))


def issues_by_code(log: DataFrame) -> DataFrame:
    return log.groupBy("code").agg(F.count("*").alias("count"))


def late_series(bars: DataFrame, now_ms: int, grace_seconds: int = 90) -> DataFrame:
    """Series whose last ts is more than the grace before now, with the lag in ms."""
    lag = F.lit(now_ms) - F.max("ts")
    return bars.groupBy(*KEY).agg(F.max("ts").alias("max_ts"), lag.alias("lag_ms")).where(F.col("lag_ms") > grace_seconds * 1000)


def over_threshold(report: DataFrame, most: float = 1e-4) -> DataFrame:
    """Rows of a missing report whose share is above the gate."""
    return report.where(F.col("gap_pct") > most)


def as_json(clean: DataFrame, log: DataFrame) -> str:
    """All three summaries; as many rows as there are series, days and codes."""
    rows = lambda df: [r.asDict() for r in df.collect()]
    return json.dumps({"series": rows(quality_summary(clean)), "daily": rows(daily_flagged(clean)), "issues": rows(issues_by_code(log))}, indent=1, sort_keys=True)


def as_markdown(clean: DataFrame, log: DataFrame) -> str:
    lines = ["# Data quality", "", "| symbol | tf | bars | flagged | calendar gaps |", "|-|-|-|-|-|"]
    for r in quality_summary(clean).orderBy(*KEY).collect():
        lines.append(f"| {r.symbol} | {r.tf} | {r.bars} | {r.flagged_ratio:.4f} | {r.calendar_gap_ratio_1m:.4f} |")
    lines += ["", "| code | count |", "|-|-|", *(f"| {r['code']} | {r['count']} |" for r in issues_by_code(log).orderBy("code").collect())]
    return "\n".join(lines) + "\n"
