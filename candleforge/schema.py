"""Canonical tables: names, types and the rule that a missing number is NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

KEY = ["symbol", "tf"]
PRICES = ["o", "h", "l", "c"]
BAR = "symbol string, tf string, ts long, o double, h double, l double, c double, v double, t double, is_gap boolean"
STORED = BAR.replace("is_gap", "ver int, is_gap")
ISSUE = "ts long, code string, note string, symbol string, tf string"
#: Names that inputs use for the canonical columns: fixed values.
ALIASES = {
    "ts": ["ts", "timestamp_ms", "timestamp", "time"],
    "o": ["o", "open"],
    "h": ["h", "high"],
    "l": ["l", "low"],
    "c": ["c", "close"],
    "v": ["v", "volume"],
    "t": ["t", "turnover", "amount", "quote_volume"],
}
REQUIRED = ["ts", "o", "h", "l", "c", "v"]


def number(col: Column | str) -> Column:
    """As a double; text that is no number, and NaN, are NULL."""
    col = F.col(col) if isinstance(col, str) else col
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def coerce(df: DataFrame, on_null_ts: str = "raise", extra: tuple[str, ...] = ()) -> DataFrame:
    """Any bar input as ts, o, h, l, c, v, t after the key columns it has and `extra`.

    Names count without case, aliases apply, other columns go. t is NULL if absent. on_null_ts says
    what becomes of rows whose ts is no number: `raise` (when the row is read), `zero` or `drop`.
    """
    at = {c.lower(): c for c in df.columns}
    found = {k: next((at[a] for a in names if a in at), None) for k, names in ALIASES.items()}
    if missing := [k for k in REQUIRED if found[k] is None]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    keys = [F.col(at[k]).cast("string").alias(k) for k in KEY if k in at]
    others = [F.col(at[k]).alias(k) for k in extra if k in at]
    ts = F.col(found["ts"]).try_cast("long")
    if on_null_ts == "raise":
        ts = F.coalesce(ts, F.raise_error(F.lit("ts is no number")).cast("long"))
    elif on_null_ts == "zero":
        ts = F.coalesce(ts, F.lit(0).cast("long"))
    values = [(number(found[k]) if found[k] else F.lit(None).cast("double")).alias(k) for k in ("o", "h", "l", "c", "v", "t")]
    out = df.select(*keys, ts.alias("ts"), *values, *others)
    return out.where("ts is not null") if on_null_ts == "drop" else out


def with_key(df: DataFrame, symbol: str = "?", tf: str = "?") -> DataFrame:
    """The key columns, where they are missing, as constants."""
    for name, value in (("symbol", symbol), ("tf", tf)):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def empty(spark: SparkSession, schema: str = BAR) -> DataFrame:
    return spark.createDataFrame([], schema)


def last_wins(df: DataFrame, seq: Column | str, keys: tuple[str, ...] = (*KEY, "ts")) -> DataFrame:
    """One row per key: the one with the greatest seq. Partial aggregation, no sort."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def iso(ts: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(F.col(ts) if isinstance(ts, str) else ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def by_time() -> WindowSpec:
    """A series' rows by ts."""
    return Window.partitionBy(*KEY).orderBy("ts")


def so_far() -> WindowSpec:
    return by_time().rowsBetween(Window.unboundedPreceding, 0)


def onward() -> WindowSpec:
    return by_time().rowsBetween(0, Window.unboundedFollowing)


def whole_series() -> WindowSpec:
    return Window.partitionBy(*KEY)
