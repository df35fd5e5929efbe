"""Rolling features of few long series in many tasks: shards of time with a halo.

A window over a series is one task for each series. On bars without gaps, the last n rows are the last
n steps of time, so a series can be cut at fixed times: each shard also gets the bars of the n - 1
steps before it, computes, and drops those. Shards are told apart by their tf, by which all windows
partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleforge.functions.timegrid import DAY, parse_tf


def by_shards(bars: DataFrame, compute: Callable[[DataFrame], DataFrame], tf: str, halo: int, days: int = 30) -> DataFrame:
    """compute(bars), for what looks back at most `halo` bars. bars have no gaps (see align_gaps).

    Shards are whole UTC days, so what restarts each day needs no more halo than a day. Sums from a
    series' first bar on are not for this.
    """
    step, wide = parse_tf(tf), days * DAY
    if halo * step > wide:
        raise ValueError("the halo is longer than a shard")
    own = F.floor(F.col("ts") / wide)
    ahead = F.floor((F.col("ts") + halo * step) / wide)
    shards = bars.withColumn("__shard", F.explode(F.sequence(own, ahead)))
    keyed = shards.withColumns({"__tf": F.col("tf"), "tf": F.concat("tf", F.lit("#"), F.col("__shard").cast("string"))})
    out = compute(keyed.drop("__shard", "__tf"))
    shard = F.substring_index("tf", "#", -1).cast("long")
    return out.where(F.floor(F.col("ts") / wide) == shard).withColumn("tf", F.substring_index("tf", "#", 1))
