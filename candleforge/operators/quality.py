"""Sixteen data-quality rules over bars, as one plan.

Each rule reads the bars as the rules before left them. Hits are collected in an array on the row, so
that flags and the last code need no join; the log is that array, exploded, with the hits of rows that
rules dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleforge.functions.timegrid import MINUTE, floor_ts, parse_tf
from candleforge.operators.islands import in_long_run
from candleforge.operators.issues import BITS
from candleforge.operators.recurrence import ewm
from candleforge.operators.resample import resample_closed_right
from candleforge.schema import KEY, PRICES, by_time, last_wins

_HITS = "array<struct<ord: int, code: string, note: string>>"


@dataclass(frozen=True)
class QualityConfig:
    """Thresholds; the defaults are fixed values of the rules."""

    misaligned_tolerance_seconds: int = 1
    epsilon_rel: float = 1e-6
    vol_window: int = 50
    atr_window: int = 14
    ret_window: int = 50
    z_thr_vol: float = 6.0
    z_thr_atr: float = 6.0
    z_thr_ret: float = 6.0
    q_hi_vol: float = 0.999
    q_hi_atr: float = 0.999
    q_hi_ret: float = 0.999
    zero_run_min_len: int = 5
    emit_r01: bool = False


def _true(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def _hit(df: DataFrame, cond: Column, order: int, code: str, note: Column | str | None = None) -> DataFrame:
    note = note if isinstance(note, Column) else F.lit(note)
    hit = F.struct(F.lit(order).alias("ord"), F.lit(code).alias("code"), note.cast("string").alias("note"))
    return df.withColumn("__hits", F.when(_true(cond), F.concat("__hits", F.array(hit))).otherwise(F.col("__hits")))


def _gapify(df: DataFrame, cond: str) -> DataFrame:
    """Rows with the flag: the price of the close before, as it was before this rule; no volume."""
    before = F.coalesce(F.lag("c").over(by_time()), F.col("c"))
    df = df.withColumn("__prev", before)
    price = {x: F.when(F.col(cond), F.col("__prev")).otherwise(F.col(x)) for x in PRICES}
    zero = {x: F.when(F.col(cond), 0.0).otherwise(F.col(x)) for x in ("v", "t")}
    return df.withColumns(price | zero | {"is_gap": F.col("is_gap") | F.col(cond)}).drop("__prev")


def _time_rules(df: DataFrame, tf_ms: int, now_ms: int, cfg: QualityConfig, repair: bool) -> DataFrame:
    """R02 and R03; dropped rows carry __drop."""
    future = F.col("ts") > now_ms - now_ms % tf_ms
    off = F.pmod("ts", F.lit(tf_ms).cast("long"))
    tolerance = cfg.misaligned_tolerance_seconds * 1000
    df = df.withColumns({"__future": future, "__off": off})
    off = F.col("__off")
    df = df.withColumn("__near", ~F.col("__future") & (off != 0) & ((off <= tolerance) | (tf_ms - off <= tolerance)))
    df = df.withColumn("__hard", ~F.col("__future") & (off != 0) & ~F.col("__near"))
    df = _hit(df, F.col("__future"), 2, "R02_TS_FUTURE")
    df = _hit(df, F.col("__near"), 3, "R03_TS_MISALIGNED", "rounded" if repair else "near")
    df = _hit(df, F.col("__hard"), 4, "R03_TS_MISALIGNED", "dropped")
    if repair:
        df = df.withColumn("ts", F.when(F.col("__near"), floor_ts(F.col("ts") + tf_ms // 2, tf_ms)).otherwise(F.col("ts")))
    return df.withColumn("__drop", F.col("__future") | F.col("__hard")).drop("__future", "__off", "__near", "__hard")


def _value_rules(df: DataFrame, repair: bool) -> DataFrame:
    """R10 to R14."""
    o, h, l, c = (F.col(x) for x in PRICES)
    df = df.withColumn("__bad", _true((o <= 0) | (h <= 0) | (l <= 0) | (c <= 0)))
    df = _hit(df, F.col("__bad"), 5, "R10_NEG_PRICE")
    df = _gapify(df, "__bad") if repair else df
    df = df.withColumn("__bad", _true(F.col("v") < 0))
    df = _hit(df, F.col("__bad"), 6, "R11_NEG_VOL")
    df = df.withColumn("v", F.when(F.col("__bad"), 0.0).otherwise(F.col("v"))) if repair else df
    df = df.withColumn("__bad", o.isNull() | h.isNull() | l.isNull() | c.isNull())
    df = _hit(df, F.col("__bad"), 7, "R12_NAN")
    df = _gapify(df, "__bad") if repair else df
    top, bottom = F.greatest("h", "o", "c"), F.least("l", "o", "c")
    df = df.withColumns({"__top": top, "__bottom": bottom})
    df = df.withColumn("__bad", _true((h < F.col("__top")) | (l > F.col("__bottom"))))
    if repair:
        df = df.withColumns({"h": F.when(F.col("__bad"), F.col("__top")).otherwise(h), "l": F.when(F.col("__bad"), F.col("__bottom")).otherwise(l)})
        df = df.withColumn("__flat", F.col("__bad") & _true(F.col("h") == F.col("l")))
        df = _hit(df, F.col("__flat"), 8, "R13_OHLC_ORDER")
        df = _hit(_gapify(df, "__flat"), F.col("__bad") & ~F.col("__flat"), 9, "R13_OHLC_ORDER").drop("__flat")
    else:
        df = _hit(df, F.col("__bad"), 9, "R13_OHLC_ORDER")
    df = df.withColumn("__bad", _true(F.col("h") < F.col("l")))
    df = _hit(df, F.col("__bad"), 10, "R14_H_LT_L")
    if repair:  # can't happen after R13's repair
        df = df.withColumns({"h": F.when(F.col("__bad"), F.col("l")).otherwise(F.col("h")), "l": F.when(F.col("__bad"), F.col("h")).otherwise(F.col("l"))})
    return df.drop("__bad", "__top", "__bottom")


def _spike(x: str, filled: str, n: int, z_thr: float, q: float) -> Column:
    """|z| over the threshold, or above the window's quantile. Windows count from max(5, n / 5) values on.

    z is of `filled`, the quantile of `x`.
    """
    w, least = by_time().rowsBetween(-(n - 1), 0), max(5, n // 5)
    sd = F.nullif(F.stddev_samp(filled).over(w), F.lit(0.0))
    z = F.when(F.count(filled).over(w) >= least, (F.col(filled) - F.avg(filled).over(w)) / sd)
    high = F.when(F.count(x).over(w) >= least, F.percentile(x, F.lit(q)).over(w))
    return _true(F.abs(z) > z_thr) | _true(F.col(x) > high)


def _statistic_rules(df: DataFrame, tf_ms: int, cfg: QualityConfig) -> DataFrame:
    """R20 to R23: they only flag."""
    before = F.lag("c").over(by_time())
    log = F.ln(F.greatest("c", F.when(F.col("c").isNotNull(), 1e-12)))
    columns = df.columns
    df = df.withColumns({"__v0": F.coalesce("v", F.lit(0.0)), "__log": log, "__tr": F.greatest(F.abs(F.col("h") - F.col("l")), F.abs(F.col("h") - before), F.abs(F.col("l") - before))})
    df = df.withColumn("__ret", F.abs(F.coalesce(F.col("__log") - F.lag("__log").over(by_time()), F.lit(0.0))))
    n = cfg.atr_window
    df = ewm(df, {"__atr": ("__tr", 1 / max(1, n), n)}, tf_ms).withColumn("__atr0", F.coalesce("__atr", F.lit(0.0)))
    df = df.withColumns(
        {
            "__s20": _spike("__v0", "__v0", cfg.vol_window, cfg.z_thr_vol, cfg.q_hi_vol),
            "__s21": _spike("__atr", "__atr0", max(4 * n, 50), cfg.z_thr_atr, cfg.q_hi_atr),
            "__s22": _spike("__ret", "__ret", cfg.ret_window, cfg.z_thr_ret, cfg.q_hi_ret),
            "__still": _true((F.col("h") == F.col("l")) & (F.col("o") == F.col("c")) & (F.col("h") == F.col("c"))) | _true(F.col("v") == 0),
        }
    )
    df = in_long_run(df, "__still", cfg.zero_run_min_len, "__s23")
    for order, code in ((11, "R20_VOL_SPIKE"), (12, "R21_ATR_SPIKE"), (13, "R22_RET_SPIKE"), (14, "R23_ZERO_RUN")):
        df = _hit(df, F.col(f"__s{code[1:3]}"), order, code)
    return df.select(*columns)


def _reference_rules(df: DataFrame, minutes: DataFrame, tf: str, cfg: QualityConfig) -> DataFrame:
    """R30 to R33, against minutes. Where no minute matches, only R33 can hit.

    R30 to R32 compare with windows closed on the right, R33 counts those closed on the left.
    """
    step, eps, columns = parse_tf(tf), cfg.epsilon_rel, df.columns
    ref = resample_closed_right(minutes, tf).select("symbol", "ts", *[F.col(x).alias(f"__ref_{x}") for x in ("o", "h", "l", "c", "v")])
    count = minutes.groupBy("symbol", floor_ts("ts", step).alias("ts")).agg(F.count("*").alias("__minutes"))
    df = df.join(ref, ["symbol", "ts"], "left").join(count, ["symbol", "ts"], "left")
    r = lambda x: F.col(f"__ref_{x}")
    differs = lambda x: F.abs(F.col(x) - r(x)) / F.greatest(F.lit(1.0), F.abs(F.col(x)), F.abs(r(x))) > eps
    slack = lambda x: F.greatest(F.lit(1.0), F.abs(r(x))) * eps
    df = _hit(df, _true(differs("o")) | _true(differs("c")), 15, "R30_OHLC_MISMATCH")
    df = _hit(df, _true(F.col("h") > r("h") + slack("h")) | _true(F.col("l") < r("l") - slack("l")), 16, "R32_RANGE_MISMATCH")
    df = _hit(df, F.abs(F.col("v") - r("v")) > F.greatest(F.lit(1e-6), F.abs(r("v")) * 1e-6), 17, "R31_VOL_MISMATCH")
    df = _hit(df, F.coalesce("__minutes", F.lit(0)) < step // MINUTE, 18, "R33_COUNT_MISMATCH")
    return df.select(*columns)


def validate(
    bars: DataFrame, tf: str, now_ms: int, minutes: DataFrame | None = None, repair: bool = True, cfg: QualityConfig = QualityConfig(), seq: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(bars with dq_flags and dq_notes, the issue log).

    bars: symbol, tf, ts, o, h, l, c, v, t, is_gap; of rows with equal ts the one with the greatest seq
    counts. now_ms is the present, for R02. A clean table has dq_flags 0 and dq_notes ''.
    """
    tf_ms = parse_tf(tf)
    df = bars.withColumns({"is_gap": F.coalesce("is_gap", F.lit(False)), "__hits": F.array().cast(_HITS)})
    if seq:
        if cfg.emit_r01:
            again = F.count("*").over(Window.partitionBy(*KEY, "ts")) > 1
            df = _hit(df, again, 1, "R01_DUP_TS")
        df = last_wins(df, seq).drop(seq)
    timed = _time_rules(df, tf_ms, now_ms, cfg, repair)
    live = _value_rules(timed.where(~F.col("__drop")).drop("__drop"), repair)
    live = _statistic_rules(live, tf_ms, cfg)
    if minutes is not None and tf_ms != MINUTE:
        live = _reference_rules(live, minutes, tf, cfg)
    bit = lambda code: F.coalesce(*(F.when(code == k, F.lit(1 << b)) for k, b in BITS.items()), F.lit(0))
    flagged = F.aggregate("__hits", F.lit(0), lambda acc, x: acc.bitwiseOR(bit(x["code"])))
    note = F.coalesce(F.try_element_at(F.array_sort("__hits"), F.lit(-1))["code"], F.lit(""))
    # rounded rows may share a ts: they share its flags, too
    at_ts = Window.partitionBy(*KEY, "ts")
    clean = live.withColumns({"__flags": flagged, "__last": F.array_max("__hits.ord"), "__note": note})
    clean = clean.withColumns({"dq_flags": F.bit_or("__flags").over(at_ts), "dq_notes": F.coalesce(F.max_by("__note", "__last").over(at_ts), F.lit(""))})
    log = live.select(*KEY, "ts", "__hits").unionByName(timed.where("__drop").select(*KEY, "ts", "__hits"))
    log = log.select(*KEY, "ts", F.explode("__hits").alias("x")).select("ts", "x.code", F.coalesce("x.note", F.lit("")).alias("note"), *KEY).distinct()
    return clean.select(*KEY, "ts", *PRICES, "v", "t", "is_gap", "dq_flags", "dq_notes"), log
