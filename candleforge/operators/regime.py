"""Market regime: four detectors, confirmation, a vote, and a lock after switches.

Two variants are kept, because they differ in results: "A" is strict about warm-up (no threshold, no
vote) and lets a neutral channel width inherit the sign before it; "B" fills thresholds backwards and
takes a neutral width as a sign of its own. What follows from row to row (rolling quantiles, run lengths,
confirmation, vote, lock) is one pass of kernels over each series' rows (see series); B needs a second, since
its thresholds are filled from rows to come.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleforge.functions.timegrid import DAY
from candleforge.operators.islands import ConfirmedSign, Cooldown, Each, RollingQuantile, RunLength, filled
from candleforge.operators.series import Kernel, by_series
from candleforge.schema import KEY, by_time, iso, number, onward, so_far, whole_series, with_key

OUTPUT = [
    "timestamp_ms", "start_time_iso", "symbol", "tf", "regime", "high_rv", "regime_confidence", "votes_trend", "votes_flat", "det_used",
    "chgpt", "p_bocpd_trend", "p_bocpd_flat", "s_adx", "s_donch", "s_hmm_rv", "hysteresis_state", "build_version",
]


@dataclass(frozen=True)
class RegimeConfig:
    """Thresholds; the defaults are fixed values of the method."""

    vote_K: int = 3
    N_conf: dict = field(default_factory=lambda: {"5m": 5, "15m": 5, "1h": 3})
    N_cooldown: dict = field(default_factory=lambda: {"5m": 10, "15m": 8, "1h": 3})
    T_adx: float = 22.0
    T_di: float = 5.0
    donch_window: int = 20
    q_low: float = 0.0015
    q_high: float = 0.006
    bocpd_lambda: int = 200
    L_min: float = 80.0
    sigma_L: float = 20.0
    stream: str = "logret"
    N_hmm: int = 180
    calm_threshold: float = 0.60
    q_high_rv: float = 0.90
    build_version: str = "C4-Regime-1.2"


def _int(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def _clip(x: Column) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def _pick(df: DataFrame, *names: str) -> Column | None:
    return next((number(n) for n in names if n in df.columns), None)


def regime_input(features: DataFrame, tf: str) -> DataFrame:
    """ts, symbol, tf and the columns that detectors read, whichever spelling the input has."""
    low = {c.lower(): c for c in features.columns}
    ts = next((F.col(low[n]).try_cast("long") for n in ("timestamp_ms", "ts", "timestamp") if n in low), None)
    if ts is None:
        ts = F.unix_millis(F.to_timestamp(low["start_time_iso"]))
    close = next((low[n] for n in ("close", "c") if n in low), None)
    df = features.withColumns({"ts": ts, "close": number(close) if close else F.lit(None).cast("double")})
    return with_key(df, tf=tf).withColumn("tf", F.lit(tf))


def d1_adx(df: DataFrame, cfg: RegimeConfig) -> DataFrame:
    """Adds d1 (1 trend, -1 flat) and s_adx."""
    none = F.lit(None).cast("double")
    adx = _pick(df, "f_adx_14", "f_adx14")
    pdi, mdi = _pick(df, "f_pdi_14", "f_pdi14"), _pick(df, "f_mdi_14", "f_mdi14")
    adx, pdi, mdi = (none if x is None else x for x in (adx, pdi, mdi))
    trend = _int((adx >= cfg.T_adx) & (F.abs(pdi - mdi) >= cfg.T_di))
    return df.withColumns({"d1": 2 * trend - 1, "s_adx": _clip((adx - cfg.T_adx) / 20)})


def d2_donchian(df: DataFrame, cfg: RegimeConfig) -> DataFrame:
    """Adds d2 (1 wide and not narrowing, -1 narrow, else 0) and s_donch."""
    width = _pick(df, f"f_donch_width_pct_{cfg.donch_window}", "f_donch_width_pct_55")
    if width is None:
        raise ValueError("no f_donch_width_pct_* column")
    df = df.withColumn("__w", width)
    change = F.coalesce(F.col("__w") - F.lag("__w").over(by_time()), F.lit(0.0))
    trend, flat = _int((F.col("__w") >= cfg.q_high) & (change >= 0)), _int(F.col("__w") <= cfg.q_low)
    return df.withColumns({"d2": trend - flat, "s_donch": _clip((F.col("__w") - cfg.q_low) / (cfg.q_high - cfg.q_low))}).drop("__w")


def _stream(df: DataFrame, cfg: RegimeConfig, variant: str) -> DataFrame:
    """Adds __x, the series of increments."""
    if cfg.stream == "close_z":
        names = [c for c in df.columns if c.startswith("f_close_z_")]
        if not names:
            raise ValueError("no f_close_z_* column")
        return df.withColumn("__x", number(names[0]))
    df = df.withColumn("__ln", F.when(F.col("close") > 0, F.ln("close"))).withColumn("__own", F.col("__ln") - F.lag("__ln").over(by_time())).drop("__ln")
    given = _pick(df, "f_logret1")
    if given is None:
        x = F.col("__own")
    elif variant == "A":
        x = given
    else:  # a column without a single number is as good as none
        x = F.when(F.count(given).over(whole_series()) == 0, F.col("__own")).otherwise(given)
    return df.withColumn("__x", x).drop("__own")


def _thresholds(cfg: RegimeConfig, variant: str) -> list[Kernel]:
    """__thr, of increments."""
    n, least = (cfg.bocpd_lambda, 10) if variant == "A" else (max(20, cfg.bocpd_lambda), 5)
    return [RollingQuantile("__abs", 0.80, n, max(least, n // 5), "__thr")]


def _calm_thresholds(cfg: RegimeConfig) -> list[Kernel]:
    """__calm and __high, of days' deviations."""
    n, least = cfg.N_hmm, max(10, cfg.N_hmm // 6)
    return [RollingQuantile("__rv", q, n, least, name) for q, name in ((cfg.calm_threshold, "__calm"), (cfg.q_high_rv, "__high"))]


def _increments(df: DataFrame, cfg: RegimeConfig, variant: str) -> DataFrame:
    """Adds __x and __abs; B adds __thr, filled."""
    df = _stream(df, cfg, variant).withColumn("__abs", F.abs("__x"))
    if variant == "A":
        return df
    filled_ = F.coalesce(F.first("__thr", ignorenulls=True).over(onward()), F.last("__thr", ignorenulls=True).over(so_far()), F.percentile("__abs", F.lit(0.5)).over(whole_series()))
    return by_series(df, _thresholds(cfg, variant)).withColumn("__thr", filled_)


def _days(df: DataFrame, cfg: RegimeConfig, variant: str) -> DataFrame:
    """Adds __rv, each row's day's deviation; B adds __calm and __high, filled."""
    if variant == "A":
        return df.withColumn("__rv", daily_rv(df))
    given = _pick(df, "rv_daily", "ctx_rv_daily")
    df = df.withColumn("__rv", daily_rv(df) if given is None else given)
    df = df.withColumn("__rv", F.coalesce(F.last("__rv", ignorenulls=True).over(so_far()), F.lit(0.0)) if given is None else F.coalesce("__rv", F.lit(0.0)))
    fill = lambda c, q: F.coalesce(F.first(c, ignorenulls=True).over(onward()), F.percentile("__rv", F.lit(q)).over(whole_series()))
    return by_series(df, _calm_thresholds(cfg)).withColumns({"__calm": fill("__calm", cfg.calm_threshold), "__high": fill("__high", cfg.q_high_rv)})


@dataclass
class ChangePoint:
    """Adds d3, p_bocpd_trend and chgpt: how long increments have stayed under their threshold."""

    cfg: RegimeConfig
    variant: str

    def __post_init__(self):
        self.reads, self.adds = ["__run"], ["d3", "p_bocpd_trend", "chgpt"]

    def __call__(self, cols, state):
        run, cfg = cols["__run"], self.cfg
        before = np.concatenate([[0.0 if state is None else state], run[:-1]])
        sigma = cfg.sigma_L if self.variant == "A" else max(cfg.sigma_L, 1.0)
        long = run >= cfg.L_min
        p = 1 / (1 + np.exp(-(run - cfg.L_min) / sigma))
        return {"d3": 2.0 * long - 1, "p_bocpd_trend": p, "chgpt": 1.0 * ((before >= cfg.L_min) & (run == 0))}, run[-1]


def _change_points(cfg: RegimeConfig, variant: str) -> list[Kernel]:
    own = _thresholds(cfg, variant) if variant == "A" else []
    return [*own, Each(["__abs", "__thr"], ["__below"], lambda x, t: (1.0 * (x < t),)), RunLength("__below", "__run"), ChangePoint(cfg, variant)]


def _calm(cfg: RegimeConfig, variant: str) -> list[Kernel]:
    """d4, s_hmm_rv (how far the day's volatility is under its calm quantile), high_rv."""

    def judge(rv, calm, high):
        score = np.clip((calm - rv) / np.where(calm == 0, np.nan, calm), 0, 1)
        if variant != "A":
            score = np.nan_to_num(score, nan=0.0)
        return score, 2.0 * (score > 0.5) - 1, 1.0 * (rv > high)

    return [*(_calm_thresholds(cfg) if variant == "A" else []), Each(["__rv", "__calm", "__high"], ["s_hmm_rv", "d4", "high_rv"], judge)]


def _passed(df: DataFrame, kernels: list[Kernel]) -> DataFrame:
    df = by_series(df, kernels)
    ints = [c for c in ("d3", "d4", "chgpt", "high_rv", "votes_trend", "votes_flat") if any(c in k.adds for k in kernels)]
    return df.withColumns({c: F.col(c).cast("int") for c in ints}).drop("__abs", "__thr", "__below", "__run", "__rv", "__calm", "__high")


def d3_run_length(df: DataFrame, cfg: RegimeConfig, variant: str) -> DataFrame:
    """Adds d3, p_bocpd_trend, chgpt: how long increments have stayed under their rolling quantile."""
    return _passed(_increments(df, cfg, variant), _change_points(cfg, variant))


def daily_rv(df: DataFrame, x: str = "__x") -> Column:
    """Each bar's UTC day's deviation of increments; it knows the whole day, also at its first bar."""
    return F.stddev_samp(x).over(Window.partitionBy(*KEY, F.floor(F.col("ts") / DAY)))


def d4_calm(df: DataFrame, cfg: RegimeConfig, variant: str) -> DataFrame:
    """Adds d4, s_hmm_rv (how far the day's volatility is under its calm quantile), high_rv."""
    return _passed(_days(df, cfg, variant), _calm(cfg, variant))


def hmm_calm(rv: np.ndarray, n_iter: int = 100, tol: float = 1e-3) -> np.ndarray:
    """Posterior of the calmer of two Gaussian states, fitted by Baum-Welch to log(1 + centred 5-row medians)."""
    x = np.log1p(pd.Series(rv).rolling(5, center=True, min_periods=1).median().to_numpy())
    mean, var = np.percentile(x, [10, 90]), np.full(2, x.var() + 1e-12)
    start, move = np.full(2, 0.5), np.array([[0.9, 0.1], [0.1, 0.9]])
    gamma, before = np.full((len(x), 2), 0.5), -np.inf
    for _ in range(n_iter):
        emit = np.exp(-((x[:, None] - mean) ** 2) / (2 * var)) / np.sqrt(2 * np.pi * var) + 1e-300
        alpha, scale = np.zeros((len(x), 2)), np.zeros(len(x))
        for t in range(len(x)):
            a = (start if t == 0 else alpha[t - 1] @ move) * emit[t]
            scale[t] = a.sum()
            alpha[t] = a / scale[t]
        beta = np.ones((len(x), 2))
        for t in range(len(x) - 2, -1, -1):
            beta[t] = move @ (emit[t + 1] * beta[t + 1]) / scale[t + 1]
        gamma = alpha * beta
        gamma /= gamma.sum(axis=1, keepdims=True)
        xi = (alpha[:-1, :, None] * move * (emit[1:] * beta[1:])[:, None, :] / scale[1:, None, None]).sum(axis=0)
        start, move = gamma[0], xi / xi.sum(axis=1, keepdims=True)
        mean = (gamma * x[:, None]).sum(axis=0) / gamma.sum(axis=0)
        var = (gamma * (x[:, None] - mean) ** 2).sum(axis=0) / gamma.sum(axis=0) + 1e-12
        now = np.log(scale).sum()
        if now - before < tol:
            break
        before = now
    return gamma[:, mean.argmin()]


def d4_hmm(df: DataFrame, cfg: RegimeConfig) -> DataFrame:
    """The detector's hidden-Markov form, fitted per series in one pandas group each."""
    df = df.withColumn("__rv", F.coalesce(daily_rv(df), F.lit(0.0)))
    narrow = df.select(*KEY, "ts", "__rv")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ts")
        return group.assign(s_hmm_rv=hmm_calm(group["__rv"].to_numpy()))[[*KEY, "ts", "s_hmm_rv"]]

    got = narrow.groupBy(*KEY).applyInPandas(fit, "symbol string, tf string, ts long, s_hmm_rv double")
    df = df.join(got, [*KEY, "ts"])
    df = by_series(df, [RollingQuantile("s_hmm_rv", 1 - cfg.q_high_rv, cfg.N_hmm, max(10, cfg.N_hmm // 6), "__low")])
    low = F.coalesce(F.first("__low", ignorenulls=True).over(onward()), F.percentile("s_hmm_rv", F.lit(1 - cfg.q_high_rv)).over(whole_series()))
    df = df.withColumn("high_rv", _int(F.col("s_hmm_rv") < low))
    return df.withColumn("d4", 2 * _int(F.col("s_hmm_rv") > 0.5) - 1).drop("__rv", "__low")


def _prepared(features: DataFrame, tf: str, cfg: RegimeConfig, variant: str, hmm: bool) -> tuple[DataFrame, list[Kernel]]:
    """What the kernels of the detectors read, and no other column; and those kernels."""
    if variant not in ("A", "B"):
        raise ValueError(f"variant: {variant}")
    df = _increments(d2_donchian(d1_adx(regime_input(features, tf), cfg), cfg), cfg, variant)
    df = d4_hmm(df, cfg) if hmm else _days(df, cfg, variant)
    reads = {"__abs", "__thr", "__rv", "__calm", "__high", "d4", "s_hmm_rv", "high_rv"} & set(df.columns) - ({"__rv"} if hmm else set())
    df = df.select(*KEY, "ts", "d1", "s_adx", "d2", "s_donch", *sorted(reads))
    return df, [*_change_points(cfg, variant), *([] if hmm else _calm(cfg, variant))]


def detectors(features: DataFrame, tf: str, cfg: RegimeConfig = RegimeConfig(), variant: str = "A", hmm: bool = False) -> DataFrame:
    """KEY, ts, d1 to d4 and what they derive from."""
    return _passed(*_prepared(features, tf, cfg, variant, hmm))


def _confirming(tf: str, cfg: RegimeConfig, variant: str) -> list[Kernel]:
    return [ConfirmedSign(f"d{k}", cfg.N_conf.get(tf, 5), f"v{k}", variant == "A") for k in "1234"]


@dataclass
class Vote:
    """Adds votes_trend, votes_flat and signal (1, -1; the one before if neither has enough, 0 at first)."""

    cfg: RegimeConfig

    def __post_init__(self):
        self.reads, self.adds = ["v1", "v2", "v3", "v4"], ["votes_trend", "votes_flat", "signal"]

    def __call__(self, cols, state):
        up, down = (sum(np.where(sign * cols[v] > 0, 1.0, 0.0) for v in self.reads) for sign in (1, -1))
        raw = np.where(up >= self.cfg.vote_K, 1.0, np.where(down >= self.cfg.vote_K, -1.0, np.nan))
        signal = filled(raw, 0.0 if state is None else state)
        return {"votes_trend": up, "votes_flat": down, "signal": signal}, signal[-1]


def confirm(df: DataFrame, tf: str, cfg: RegimeConfig, variant: str) -> DataFrame:
    """Adds v1 to v4: the detectors' signs that have held for the timeframe's number of rows."""
    return by_series(df, _confirming(tf, cfg, variant))


def vote(df: DataFrame, cfg: RegimeConfig) -> DataFrame:
    """Adds votes_trend, votes_flat and signal (1, -1; the one before if neither has enough, 0 at first)."""
    return _passed(df, [Vote(cfg)])


def needed_features(cfg: RegimeConfig = RegimeConfig()) -> list[str]:
    """The features that `infer_regime` reads, by the names that `compute_features` gives."""
    return ["f_adx_14", "f_pdi_14", "f_mdi_14", f"f_donch_width_pct_{cfg.donch_window}", "f_logret1"]


def infer_regime(features: DataFrame, tf: str, cfg: RegimeConfig = RegimeConfig(), variant: str = "A", hmm: bool = False) -> DataFrame:
    """A row a bar with the columns of OUTPUT. features: what compute_features returns, or the like; `needed_features` are enough."""
    df, kernels = _prepared(features, tf, cfg, variant, hmm)
    df = _passed(df, [*kernels, *_confirming(tf, cfg, variant), Vote(cfg), Cooldown("signal", cfg.N_cooldown.get(tf, 5), "hysteresis_state")])
    return df.select(
        F.col("ts").alias("timestamp_ms"), iso("ts").alias("start_time_iso"), "symbol", "tf",
        F.when(F.col("hysteresis_state") > 0, "trend").otherwise("flat").alias("regime"), F.col("high_rv").cast("byte").alias("high_rv"),
        (F.greatest("votes_trend", "votes_flat") / 4.0).alias("regime_confidence"), F.col("votes_trend").cast("short").alias("votes_trend"),
        F.col("votes_flat").cast("short").alias("votes_flat"), F.lit("1111").alias("det_used"), F.col("chgpt").cast("byte").alias("chgpt"),
        "p_bocpd_trend", (1 - F.col("p_bocpd_trend")).alias("p_bocpd_flat"), "s_adx", "s_donch", "s_hmm_rv", "hysteresis_state",
        F.lit(cfg.build_version).alias("build_version"),
    ).select(*OUTPUT)
