"""The issue log: codes, their registry, and operations on logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code, description, severity, action, level: fixed values.
REGISTRY = [
    ("R01_DUP_TS", "duplicate timestamps", "high", "drop", 1),
    ("R02_TS_FUTURE", "timestamp in the future", "high", "drop", 1),
    ("R03_TS_MISALIGNED", "timestamp not aligned to TF", "medium", "fix", 1),
    ("R10_NEG_PRICE", "non-positive price in OHLC", "crit", "gapify", 2),
    ("R11_NEG_VOL", "negative volume", "medium", "fix", 2),
    ("R12_NAN", "NaN inside OHLC", "high", "gapify", 2),
    ("R13_OHLC_ORDER", "OHLC order violation", "high", "fix", 2),
    ("R14_H_LT_L", "high < low", "high", "fix", 2),
    ("R20_VOL_SPIKE", "abnormal volume spike vs baseline", "low", "flag", 3),
    ("R21_ATR_SPIKE", "abnormal ATR spike vs baseline", "low", "flag", 3),
    ("R22_RET_SPIKE", "abnormal return spike vs baseline", "low", "flag", 3),
    ("R23_ZERO_RUN", "long run of zero volume or flat bars", "low", "flag", 3),
    ("R30_OHLC_MISMATCH", "OHLC mismatch vs 1m aggregation", "high", "flag", 4),
    ("R31_VOL_MISMATCH", "Volume mismatch vs 1m aggregation", "medium", "flag", 4),
    ("R32_RANGE_MISMATCH", "Range outside minute range", "high", "flag", 4),
    ("R33_COUNT_MISMATCH", "Insufficient minute bars in window", "medium", "flag", 4),
]
CODES = [r[0] for r in REGISTRY]
#: Bit of each code in dq_flags: fixed values.
BITS = {
    "R01_DUP_TS": 0, "R02_TS_FUTURE": 1, "R03_TS_MISALIGNED": 2,
    "R10_NEG_PRICE": 10, "R11_NEG_VOL": 11, "R12_NAN": 12, "R13_OHLC_ORDER": 13, "R14_H_LT_L": 14,
    "R20_VOL_SPIKE": 20, "R21_ATR_SPIKE": 21, "R22_RET_SPIKE": 22, "R23_ZERO_RUN": 23,
    "R30_OHLC_MISMATCH": 30, "R31_VOL_MISMATCH": 29, "R32_RANGE_MISMATCH": 28, "R33_COUNT_MISMATCH": 27,
}
#: Other spellings, in the order in which they are tried as parts of a code: fixed values.
ALIASES = [
    ("dup_ts", "R01_DUP_TS"), ("duplicate_ts", "R01_DUP_TS"), ("ts_future", "R02_TS_FUTURE"), ("future", "R02_TS_FUTURE"),
    ("misaligned", "R03_TS_MISALIGNED"), ("ts_misaligned", "R03_TS_MISALIGNED"), ("neg_price", "R10_NEG_PRICE"), ("neg_vol", "R11_NEG_VOL"),
    ("nan", "R12_NAN"), ("ohlc_order", "R13_OHLC_ORDER"), ("h_lt_l", "R14_H_LT_L"), ("vol_spike", "R20_VOL_SPIKE"),
    ("atr_spike", "R21_ATR_SPIKE"), ("ret_spike", "R22_RET_SPIKE"), ("zero_run", "R23_ZERO_RUN"), ("ohlc_mismatch", "R30_OHLC_MISMATCH"),
    ("vol_mismatch", "R31_VOL_MISMATCH"), ("range_mismatch", "R32_RANGE_MISMATCH"), ("count_mismatch", "R33_COUNT_MISMATCH"),
]
#: Names that logs use for the columns: fixed values.
COLUMNS = {
    "ts": ["ts", "timestamp_ms"], "code": ["code", "issue", "err", "error"], "note": ["note", "message", "msg", "reason"],
    "symbol": ["symbol", "sym", "ticker"], "tf": ["tf", "timeframe"],
}


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGISTRY, "code string, desc string, severity string, action string, level int")


def canonical_code(code: Column | str) -> Column:
    """A registered code, else what an alias names (whole, or else as a part), else the upper-case text."""
    code = F.trim(F.col(code) if isinstance(code, str) else code)
    upper = F.upper(code)
    key = F.replace(F.replace(F.lower(code), F.lit(" "), F.lit("")), F.lit("-"), F.lit("_"))
    exact = F.get(F.array(*(F.lit(c) for _, c in ALIASES)), F.array_position(F.array(*(F.lit(a) for a, _ in ALIASES)), key).cast("int") - 1)
    part = F.coalesce(*(F.when(F.contains(key, F.lit(a)), c) for a, c in ALIASES))
    return F.when(code.isNull() | (code == ""), "UNKNOWN").when(upper.isin(CODES), upper).otherwise(F.coalesce(exact, part, upper))


def normalize_issues(log: DataFrame, symbol: str | None = None, tf: str | None = None) -> DataFrame:
    """ts (0 if it is no number), canonical code, note, symbol, tf ('' if missing); distinct rows."""
    at = {c.lower(): c for c in log.columns}
    found = {k: next((at[n] for n in names if n in at), None) for k, names in COLUMNS.items()}
    text = lambda k, default: F.col(found[k]).cast("string") if found[k] else F.lit(default).cast("string")
    ts = F.coalesce(F.col(found["ts"]).try_cast("long"), F.lit(0)) if found["ts"] else F.lit(0)
    return log.select(
        ts.cast("long").alias("ts"), canonical_code(text("code", None)).alias("code"), F.coalesce(text("note", ""), F.lit("")).alias("note"),
        F.coalesce(text("symbol", symbol), F.lit("")).alias("symbol"), F.coalesce(text("tf", tf), F.lit("")).alias("tf"),
    ).distinct()


def summarize_issues(log: DataFrame) -> DataFrame:
    """A row a code: count, first_ts, last_ts, and the registry's words (unknown codes: low, flag, 9)."""
    by_code = log.groupBy("code").agg(F.count("*").alias("count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    known = F.broadcast(registry(log.sparkSession).drop("desc"))  # sixteen rows
    out = by_code.join(known, "code", "left")
    return out.fillna({"severity": "low", "action": "flag", "level": 9}).orderBy("level", "code")


def merge_issues(*logs: DataFrame) -> DataFrame:
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out.distinct().orderBy("ts", "code")


def flags(codes_column: str) -> Column:
    """Aggregate: the bits of all codes of a group."""
    bit = F.lit(0)
    for code, b in BITS.items():
        bit = F.when(F.col(codes_column) == code, F.lit(1 << b)).otherwise(bit)
    return F.bit_or(bit).cast("int")
