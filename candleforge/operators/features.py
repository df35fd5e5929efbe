"""Technical features of bars: ranges, volatility, trend, momentum, channels, volume and VWAP.

Input: bars with symbol, tf, ts, o, h, l, c, v, t. All windows are one series' rows by ts, so that one
exchange and one sort serve them all; exponential means and KAMA are block scans (see recurrence), which
only the bars and the scans' own inputs and results travel through. Whoever needs a few features names
them: nothing else is computed. A feature is NULL until its window is full, and where it divides by zero.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleforge.functions.timegrid import DAY, parse_tf
from candleforge.operators.recurrence import ewm
from candleforge.schema import KEY, by_time, coerce, iso, with_key

WIDE = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume", "t": "turnover"}


@dataclass(frozen=True)
class FeatureConfig:
    """Window lengths; the defaults are fixed values of the feature set."""

    rv: tuple[int, ...] = (20, 60)
    ema: tuple[int, ...] = (20, 50)
    mom: tuple[int, ...] = (20, 50, 100)
    rsi: int = 14
    adx: int = 14
    donch: tuple[int, ...] = (20, 55)
    z: tuple[int, ...] = (20, 60)
    vwap_roll: int = 96
    updownvol: int = 20
    kama: int = 10
    build_version: str = "C3-Core-1.4"


def over(n: int) -> Window:
    return by_time().rowsBetween(-(n - 1), 0)


def full(n: int, x: Column | str, value: Column) -> Column:
    """value, where the last n rows all have x."""
    return F.when(F.count(x).over(over(n)) >= n, value)


def div(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def zscore(x: str, n: int) -> Column:
    return full(n, x, div(F.col(x) - F.avg(x).over(over(n)), F.stddev_samp(x).over(over(n))))


def true_range() -> Column:
    before = F.lag("c").over(by_time())
    return F.greatest(F.abs(F.col("h") - F.col("l")), F.abs(F.col("h") - before), F.abs(F.col("l") - before))


Lazy = dict[str, Callable[[], Column]]


def _add(df: DataFrame, columns: Lazy, only: set[str] | None) -> DataFrame:
    """Making expressions costs the driver time, so only those that are wanted are made."""
    made = {k: f() for k, f in columns.items() if only is None or k in only}
    return df.withColumns(made) if made else df


def basic(bars: DataFrame, cfg: FeatureConfig, only: set[str] | None = None) -> DataFrame:
    """Returns, ranges, and the steps that others need; all of them, or those of `only`."""
    o, h, l, c, v = (F.col(x) for x in "ohlcv")
    before = lambda x: F.lag(x).over(by_time())
    body = lambda x: F.when(o.isNotNull() & c.isNotNull(), x)
    moves = lambda: (h - before("h"), before("l") - l)
    step, log = F.col("__step"), F.col("__log")
    first: Lazy = {
        "__cf": lambda: F.last("c", ignorenulls=True).over(by_time().rowsBetween(Window.unboundedPreceding, 0)),
        "__log": lambda: F.when(c > 0, F.ln(c)),
        "__step": lambda: c - before("c"),
        "__v0": lambda: F.coalesce(v, F.lit(0.0)),
        "__range": lambda: h - l,
        "__tp": lambda: (h + l + c) / 3,
    }
    second: Lazy = {
        "f_ret1": lambda: div(F.col("__cf"), before("__cf")) - 1,
        "f_logret1": lambda: log - before("__log"),
        "f_range_pct": lambda: div(F.abs(h - l), c),
        "f_body_pct": lambda: div(F.abs(c - o), c),
        "f_wick_upper_pct": lambda: body(div(h - F.greatest(o, c), c)),
        "f_wick_lower_pct": lambda: body(div(F.least(o, c) - l, c)),
        "f_tr": true_range,
        "__up": lambda: F.greatest(step, F.lit(0.0) * step),
        "__down": lambda: F.greatest(-step, F.lit(0.0) * step),
        "__pdm": lambda: (lambda up, down: F.when((up > down) & (up > 0), up).otherwise(0.0))(*moves()),
        "__mdm": lambda: (lambda up, down: F.when((down > up) & (down > 0), down).otherwise(0.0))(*moves()),
    }
    from_first = {"f_ret1": "__cf", "f_logret1": "__log", "__up": "__step", "__down": "__step"}
    early = None if only is None else only | {from_first[k] for k in only if k in from_first}
    return _add(_add(bars, first, early), second, only)


def kama_terms(n: int) -> tuple[dict[str, Column], str, tuple[Column, Column]]:
    """(columns to add first, the column of smoothing constants, the recurrence's terms).

    The constant comes from the efficiency ratio; where that is NULL (too early, or a flat stretch) the
    average is NULL and starts again from the close before.
    """
    path = full(n, "__absstep", F.sum("__absstep").over(over(n)))
    ratio = div(F.abs(F.col("c") - F.lag("c", n).over(by_time())), path)
    fast, slow = 2 / 3, 2 / 31
    smooth = F.pow(ratio * (fast - slow) + slow, F.lit(2.0))
    sc, before = F.col("__sc"), F.col("__c1")
    anew = F.col("__sc1").isNull()
    a = F.when(sc.isNull(), 1.0).when(anew, 0.0).otherwise(1 - sc)
    b = F.when(sc.isNull(), 0.0).when(anew, before + sc * (F.col("c") - before)).otherwise(sc * F.col("c"))
    return {"__sc": smooth}, "__sc", (a, b)


def mean_features(cfg: FeatureConfig) -> dict[str, set[str]]:
    """The features that need exponential means or KAMA, and which of those they need."""
    adx, kama = cfg.adx, f"f_kama_{cfg.kama}"
    atr, lines = f"f_atr_{adx}", {f"f_atr_{adx}", "__wpdm", "__wmdm"}
    out = {f"{x}_{adx}": {atr} for x in ("f_atr", "f_atr_pct", "f_atr_z")}
    out |= {f"f_pdi_{adx}": lines, f"f_mdi_{adx}": lines, f"f_adx_{adx}": lines | {f"f_adx_{adx}"}}
    for n in cfg.ema:
        out |= {f"f_ema_close_{n}": {f"f_ema_close_{n}"}, f"f_ema_slope_{n}": {f"f_ema_close_{n}"}}
    return out | {f"f_rsi_{cfg.rsi}": {"__wup", "__wdown"}, kama: {kama}}


def with_means(df: DataFrame, tf: str, cfg: FeatureConfig, wanted: set[str]) -> DataFrame:
    """df, bars, with the wanted means, directional lines and KAMA."""
    step, n, base = parse_tf(tf), cfg.adx, df.columns
    atr, pdi, mdi, adx, kama = f"f_atr_{n}", f"f_pdi_{n}", f"f_mdi_{n}", f"f_adx_{n}", f"f_kama_{cfg.kama}"
    means = {atr: ("f_tr", 1 / n, n), "__wpdm": ("__pdm", 1 / n, n), "__wmdm": ("__mdm", 1 / n, n)}
    means |= {f"f_ema_close_{k}": ("c", 2 / (k + 1), k) for k in cfg.ema}
    means |= {"__wup": ("__up", 1 / cfg.rsi, cfg.rsi), "__wdown": ("__down", 1 / cfg.rsi, cfg.rsi)}
    means, more = {k: m for k, m in means.items() if k in wanted}, {}
    inputs = {x for x, _, _ in means.values()} - set(base)
    df = basic(df, cfg, inputs | ({"__step"} if kama in wanted else set()))
    if kama in wanted:
        df = df.withColumns({"__absstep": F.abs(F.col("__step")), "__c1": F.lag("c").over(by_time())})
        first, _, more["__kama"] = kama_terms(cfg.kama)
        df = df.withColumns(first).withColumn("__sc1", F.lag("__sc").over(by_time()))
        inputs |= {"__sc", "__sc1", "__c1"}
    if not means and not more:
        return df.select(*base)
    df = ewm(df.select(*base, *sorted(inputs)), means, step, more)
    keep = [*base, *means]
    if kama in wanted:
        df = df.withColumn(kama, F.when(F.col("__sc").isNotNull(), F.col("__kama")))
        keep.append(kama)
    if "__wpdm" in wanted:
        df = df.withColumns({pdi: div(100 * F.col("__wpdm"), F.col(atr)), mdi: div(100 * F.col("__wmdm"), F.col(atr))})
        keep = [c for c in keep if c not in ("__wpdm", "__wmdm")] + [pdi, mdi]
    if adx in wanted:
        df = df.withColumn("__dx", div(100 * F.abs(F.col(pdi) - F.col(mdi)), F.col(pdi) + F.col(mdi)))
        return ewm(df.select(*keep, "__dx"), {adx: ("__dx", 1 / n, n)}, step).select(*keep, adx)
    return df.select(*keep)


def compute_features(bars: DataFrame, tf: str, cfg: FeatureConfig = FeatureConfig(), columns: list[str] | None = None) -> DataFrame:
    """A row a bar: ts, timestamp_ms, start_time_iso, prices by their long names, symbol, tf, f_*.

    bars: see `feature_input`. f_valid_from is the ts of a series' first row without a NULL feature, or
    its first ts if there is none. columns: only those features, without f_valid_from and f_build_version.
    """
    by_mean = mean_features(cfg)
    wanted = set().union(*(needs for f, needs in by_mean.items() if columns is None or f in columns))
    df = with_means(feature_input(bars, tf), tf, cfg, wanted)
    if columns is None:
        return finish(windowed(from_means(basic(df, cfg), cfg), cfg), cfg)
    only = set(columns)
    out = windowed(from_means(basic(df, cfg, only | window_inputs(only)), cfg, only), cfg, only)
    if unknown := only - set(out.columns):
        raise ValueError(f"no such features: {', '.join(sorted(unknown))}")
    return out.select(*_bar_columns(out), *columns)


def window_inputs(only: set[str]) -> set[str]:
    """The columns of `basic` that `windowed` needs for those features."""
    starting = {
        "f_rv_": ["f_logret1"], "f_range_z_": ["__range"], "f_vol_z_": ["__v0"], "f_upvol_": ["__v0", "__step"], "f_downvol_": ["__v0", "__step"],
        "f_vol_balance_": ["__v0", "__step"], "f_obv": ["__v0", "__step"], "f_vwap_": ["__v0", "__tp"],
    }
    return {x for name, inputs in starting.items() if any(f.startswith(name) for f in only) for x in inputs}


def from_means(df: DataFrame, cfg: FeatureConfig, only: set[str] | None = None) -> DataFrame:
    """What derives from the exponential means that df has."""
    atr, out = f"f_atr_{cfg.adx}", {}
    if atr in df.columns:
        out |= {f"f_atr_pct_{cfg.adx}": lambda: div(F.col(atr), F.col("c")), f"f_atr_z_{cfg.adx}": lambda: zscore(atr, cfg.adx)}
    for ema in (f"f_ema_close_{n}" for n in cfg.ema if f"f_ema_close_{n}" in df.columns):
        out[ema.replace("close", "slope")] = lambda ema=ema: (lambda before: div(F.col(ema) - before, before))(F.lag(ema).over(by_time()))
    if "__wup" in df.columns:
        out[f"f_rsi_{cfg.rsi}"] = lambda: 100 - 100 / (1 + div(F.col("__wup"), F.col("__wdown")))
    return _add(df, out, only)


def windowed(df: DataFrame, cfg: FeatureConfig, only: set[str] | None = None) -> DataFrame:
    """What needs windows of rows only; all of it, or what `only` has."""
    c, v0, step = F.col("c"), F.col("__v0"), F.col("__step")
    out: Lazy = {f"f_rv_{n}": lambda n=n: full(n, "f_logret1", F.stddev_samp("f_logret1").over(over(n))) for n in cfg.rv}
    out |= {f"f_mom_{n}": lambda n=n: div(c, F.lag("c", n).over(by_time())) - 1 for n in cfg.mom}
    high = lambda n: full(n, "h", F.max("h").over(over(n)))
    low = lambda n: full(n, "l", F.min("l").over(over(n)))
    for n in cfg.donch:
        out |= {f"f_donch_h_{n}": lambda n=n: high(n), f"f_donch_l_{n}": lambda n=n: low(n), f"f_donch_width_pct_{n}": lambda n=n: div(high(n) - low(n), c)}
        # the window holds the bar itself, so a valid bar never breaks out of it
        out[f"f_donch_break_dir_{n}"] = lambda n=n: F.when(c > high(n), 1.0).when(c < low(n), -1.0).otherwise(0.0)
    for n in cfg.z:
        out |= {f"f_{name}_z_{n}": lambda x=x, n=n: zscore(x, n) for name, x in (("close", "c"), ("range", "__range"), ("vol", "__v0"))}
    n = cfg.updownvol
    moved = lambda on: full(n, "__v0", F.sum(F.when(on, v0).otherwise(0.0)).over(over(n)))
    up, down = (lambda: moved(step > 0)), (lambda: moved(step < 0))
    out |= {f"f_upvol_{n}": up, f"f_downvol_{n}": down, f"f_vol_balance_{n}": lambda: (lambda u, d: div(u - d, u + d))(up(), down())}
    out["f_obv"] = lambda: F.sum(F.coalesce(F.signum(step), F.lit(0.0)) * v0).over(by_time().rowsBetween(Window.unboundedPreceding, 0))
    m, paid = cfg.vwap_roll, F.col("__tp") * v0
    roll = lambda: div(full(m, paid, F.sum(paid).over(over(m))), full(m, "__v0", F.sum(v0).over(over(m))))

    def day() -> Column:
        session = Window.partitionBy(*KEY, F.floor(F.col("ts") / DAY)).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
        return div(F.sum(paid).over(session), F.sum(v0).over(session))

    out |= {f"f_vwap_roll_{m}": roll, f"f_vwap_dev_pct_{m}": lambda: (lambda r: div(c - r, r))(roll()), "f_vwap_session": day, "f_vwap_session_dev_pct": lambda: (lambda d: div(c - d, d))(day())}
    out["f_liq_proxy"] = lambda: F.col("t") if "t" in df.columns else c * F.col("v")
    out["f_spread_proxy"] = lambda: out[f"f_donch_width_pct_{cfg.donch[0]}"]()
    return _add(df, out, only)


def finish(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    features = sorted(x for x in df.columns if x.startswith("f_"))
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull()
    series = Window.partitionBy(*KEY)
    valid = F.coalesce(F.min(F.when(whole, F.col("ts"))).over(series), F.min("ts").over(series))
    return df.select(*_bar_columns(df), *features, valid.alias("f_valid_from"), F.lit(cfg.build_version).alias("f_build_version"))


def _bar_columns(df: DataFrame) -> list[Column | str]:
    prices = [F.col(k).alias(w) for k, w in WIDE.items() if k in df.columns]
    return ["ts", F.col("ts").alias("timestamp_ms"), iso("ts").alias("start_time_iso"), *prices, "symbol", "tf"]


def feature_input(bars: DataFrame, tf: str, symbol: str = "?", repair: bool = False) -> DataFrame:
    """Bars by short or long names, ts from timestamp_ms or else start_time_iso, NULL for no number.

    t stays out if the input has no such column. repair: h and l that are swapped change places, and a
    negative or missing v is 0.
    """
    low = {c.lower(): c for c in bars.columns}
    if not {"ts", "timestamp_ms", "timestamp", "time"} & low.keys() and "start_time_iso" in low:
        bars = bars.withColumn("ts", F.unix_millis(F.to_timestamp(low["start_time_iso"])))
    if not {"v", "volume"} & low.keys():
        bars = bars.withColumn("v", F.lit(None).cast("double"))
    df = with_key(coerce(bars), symbol, tf)
    if not {"t", "turnover", "amount", "quote_volume"} & low.keys():
        df = df.drop("t")
    if repair:
        swapped = F.col("h") < F.col("l")
        df = df.withColumns({"h": F.when(swapped, F.col("l")).otherwise(F.col("h")), "l": F.when(swapped, F.col("h")).otherwise(F.col("l")), "v": F.when(F.col("v") >= 0, F.col("v")).otherwise(0.0)})
    return df


build_features = compute_features


def normalize_and_validate(bars: DataFrame, tf: str, symbol: str = "?") -> DataFrame:
    """The input by its long names, without features."""
    df = feature_input(bars, tf, symbol)
    return df.select(*_bar_columns(df))


def feature_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c.startswith("f_") and c not in ("f_valid_from", "f_build_version"))


REQUIRED = ["ts", "symbol", "tf", "f_valid_from", "f_build_version"]
BASE = ["ts", "timestamp_ms", "start_time_iso", "open", "high", "low", "close", "volume", "turnover", "symbol", "tf"]


def validate_features(df: DataFrame, strict: bool = True, seq: str | None = None) -> DataFrame:
    """Typed, ordered columns; one row per symbol, tf and ts.

    strict: the REQUIRED columns must be there. Otherwise rows without ts go, and a missing
    f_valid_from or f_build_version is ts or an empty string. seq decides between rows of equal key
    (the greatest stays); without it, any of them.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if strict and missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    df = df.withColumn("ts", F.col("ts").try_cast("long"))
    if not strict:
        df = with_key(df.where("ts is not null"))
        if "f_valid_from" in df.columns:
            df = df.withColumn("f_valid_from", F.coalesce(F.col("f_valid_from").try_cast("long"), F.col("ts")))
        else:
            df = df.withColumn("f_valid_from", F.col("ts"))
        if "f_build_version" not in df.columns:
            df = df.withColumn("f_build_version", F.lit(""))
    features = feature_columns(df)
    df = df.withColumns({f: F.col(f).try_cast("double") for f in features})
    kept = F.row_number().over(Window.partitionBy("symbol", "tf", "ts").orderBy(F.col(seq).desc() if seq else F.lit(0)))
    df = df.withColumn("__k", kept).where("__k = 1").drop("__k")
    head = [c for c in BASE if c in df.columns]
    tail = ["f_valid_from", "f_build_version"]
    rest = [c for c in df.columns if c not in {*head, *features, *tail}]
    return df.select(*head, *features, *tail, *rest)
