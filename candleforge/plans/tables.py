"""Bars from the supplied tables, the inputs of the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.functions.timegrid import floor_ts, parse_tf
from candleforge.operators.align import align_gaps
from candleforge.schema import PRICES

HOUR = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str, tf: str = "1h") -> DataFrame:
    """Events as bars: symbol is the type, price the value; ties in time go by event_id."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "event_id", "value")
    at = F.struct("ms", "event_id")
    out = ev.groupBy("symbol", floor_ts("ms", parse_tf(tf)).alias("ts")).agg(
        F.min_by("value", at).alias("o"), F.max("value").alias("h"), F.min("value").alias("l"), F.max_by("value", at).alias("c"),
        F.round(F.sum("value"), 6).alias("v"), F.round(F.sum(F.col("value") * F.col("value")), 6).alias("t"),
    )
    return out.select("symbol", F.lit(tf).alias("tf"), "ts", *PRICES, "v", "t", F.lit(False).alias("is_gap"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars without gaps."""
    return align_gaps(event_bars(spark, sf_dir), HOUR)


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of unit prices by return flag."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("symbol"), F.unix_millis(F.date_trunc("day", F.col("l_shipdate").cast("timestamp"))).alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"), F.col("l_quantity").alias("q"), F.struct("l_orderkey", "l_linenumber").alias("at"),
    )
    return li.groupBy("symbol", "ts").agg(
        F.min_by("p", "at").alias("o"), F.max("p").alias("h"), F.min("p").alias("l"), F.max_by("p", "at").alias("c"), F.sum("q").alias("v")
    )


def dirty(bars: DataFrame) -> DataFrame:
    """Hourly bars with a defect of each kind at fixed places of each series."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("symbol", "tf").orderBy("ts"))
    df = bars.withColumn("__n", n)
    at = lambda m, r: F.col("__n") % m == r
    still = F.col("__n").between(200, 206)
    return df.select(
        "symbol", "tf", (F.col("ts") + F.when(at(71, 13), 500).when(at(73, 17), HOUR // 2).otherwise(0)).alias("ts"),
        F.when(still, 50.0).when(at(97, 5), -F.col("o")).otherwise(F.col("o")).alias("o"),
        F.when(still, 50.0).when(at(53, 3), F.col("l") - 1).otherwise(F.col("h")).alias("h"),
        F.when(still, 50.0).otherwise(F.col("l")).alias("l"),
        F.when(still, 50.0).when(~at(89, 7), F.col("c")).alias("c"),
        F.when(at(61, 11), -F.col("v")).otherwise(F.col("v")).alias("v"), "t", "is_gap",
    )
