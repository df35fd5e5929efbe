"""Bars from a stream of ticks or finer bars, and a sink that upserts them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from candleforge.functions.timegrid import interval
from candleforge.schema import KEY, PRICES
from candleforge.sources.store import write_idempotent


def stream_bars(ticks: DataFrame, tf: str, late: str = "10 minutes") -> DataFrame:
    """ticks(symbol, at timestamp, seq, price, volume) to bars; a bar comes out when the watermark passes its end.

    Works on batches, too. Ties in time go by seq.
    """
    order = F.struct("at", "seq")
    bars = ticks.withWatermark("at", late).groupBy("symbol", F.window("at", interval(tf)).alias("w")).agg(
        F.min_by("price", order).alias("o"), F.max("price").alias("h"), F.min("price").alias("l"), F.max_by("price", order).alias("c"),
        F.sum("volume").alias("v"), F.sum(F.col("price") * F.col("volume")).alias("t"),
    )
    return bars.select("symbol", F.lit(tf).alias("tf"), F.unix_millis("w.start").alias("ts"), *PRICES, "v", "t", F.lit(False).alias("is_gap"))


def store_sink(bars: DataFrame, root: str, checkpoint: str, now_ms: int) -> DataStreamWriter:
    """Each micro-batch is upserted; a repeated batch changes versions, not values."""

    def put(batch: DataFrame, number: int) -> None:
        rows = batch.select(*KEY, "ts", *PRICES, "v", "t", "is_gap").withColumn("seq", F.lit(number).cast("long"))
        write_idempotent(batch.sparkSession, root, rows, "seq", now_ms, "stream")

    return bars.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(put)
