"""One hand-made case for each rule, and features and regimes on short series."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from candleforge.operators import features as FT
from candleforge.operators import regime as R
from candleforge.operators.issues import canonical_code, merge_issues, normalize_issues, summarize_issues
from candleforge.operators.quality import validate
from candleforge.schema import BAR
from tests.test_bars import M, T0, line

NOW = T0 + 10**9


def run(spark, rows, repair=True, tf="1m", minutes=None, now=NOW):
    df = spark.createDataFrame([("S", tf, *r, False) for r in rows], BAR)
    clean, log = validate(df, tf, now, minutes, repair)
    return clean.orderBy("ts").collect(), sorted((r.ts, r.code, r.note) for r in log.collect())


def changed(i, **kw):
    rows = [list(r) for r in line(8)]
    for k, v in kw.items():
        rows[i]["tohlcv".index(k) if k != "t" else 6] = v
    return [tuple(r) for r in rows]


def codes(log):
    return {(t - T0) // M: c for t, c, _ in log if c < "R2"}


def test_clean(spark):
    clean, log = run(spark, [(t, 100.0, 101.0, 99.0, 100.0, 1.0, 1.0) for t, *_ in line(8)])
    assert log == [] and {(r.dq_flags, r.dq_notes) for r in clean} == {(0, "")}


def test_future_and_misaligned(spark):
    rows = line(5)
    rows[1] = (rows[1][0] + 500, *rows[1][1:])
    rows[2] = (rows[2][0] + 20_000, *rows[2][1:])
    clean, log = run(spark, rows, now=T0 + 3 * M + 10)
    assert [(r.ts - T0) // M for r in clean] == [0, 1, 3]
    assert [x for x in log if x[1] < "R1"] == [(T0 + M, "R03_TS_MISALIGNED", "rounded"), (T0 + 2 * M + 20_000, "R03_TS_MISALIGNED", "dropped"), (T0 + 4 * M, "R02_TS_FUTURE", "")]
    clean, log = run(spark, rows, repair=False, now=T0 + 3 * M + 10)
    assert (T0 + M + 500, "R03_TS_MISALIGNED", "near") in log and T0 + M + 500 in [r.ts for r in clean]


def test_repairs(spark):
    clean, log = run(spark, changed(3, o=-1.0))
    r = clean[3]
    assert codes(log) == {3: "R10_NEG_PRICE"} and (r.o, r.h, r.c, r.v, r.is_gap, r.dq_flags, r.dq_notes) == (102.5, 102.5, 102.5, 0.0, True, 1 << 10, "R10_NEG_PRICE")
    clean, log = run(spark, changed(3, v=-5.0))
    assert codes(log) == {3: "R11_NEG_VOL"} and clean[3].v == 0
    clean, log = run(spark, changed(3, c=None))
    assert codes(log) == {3: "R12_NAN"} and clean[3].c == 102.5
    clean, log = run(spark, changed(3, h=50.0))
    assert codes(log) == {3: "R13_OHLC_ORDER"} and clean[3].h == 103.5
    clean, log = run(spark, changed(3, h=50.0), repair=False)
    assert {c for _, c, _ in log if c < "R2"} == {"R13_OHLC_ORDER", "R14_H_LT_L"} and clean[3].h == 50


def test_a_run_of_bad_rows_copies_the_raw_close(spark):
    rows = changed(3, c=-2.0)
    rows[4] = (*rows[4][:4], -3.0, *rows[4][5:])
    clean, _ = run(spark, rows)
    assert clean[3].c == 102.5 and clean[4].c == -2.0
    clean, _ = run(spark, changed(0, c=-2.0))
    assert clean[0].o == -2.0


def test_spikes_and_still_bars(spark):
    flat = [(t, 100.0, 100.5, 99.5, 100.0 + 0.01 * (i % 3), 10.0 + i % 4, 1.0) for i, (t, *_) in enumerate(line(80))]
    rows = list(flat)
    rows[70] = (rows[70][0], 100.0, 100.5, 99.5, 100.0, 500.0, 1.0)
    rows[60] = (rows[60][0], 100.0, 140.0, 99.5, 130.0, 10.0, 1.0)
    rows[40:45] = [(t, *rest[:4], 0.0, 1.0) for t, *rest in rows[40:45]]
    _, log = run(spark, rows)
    got = {(c, (t - T0) // M) for t, c, _ in log}
    assert {("R20_VOL_SPIKE", 70), ("R21_ATR_SPIKE", 60), ("R22_RET_SPIKE", 60)} <= got
    assert {i for c, i in got if c == "R23_ZERO_RUN"} == {40, 41, 42, 43, 44}


def test_against_minutes(spark):
    minutes = spark.createDataFrame([("S", "1m", *r, False) for r in line(11, start=T0 + M)], BAR)
    good = (T0, 100.0, 105.0, 99.0, 104.5, 5.0, 10.0)
    bad = (T0 + 5 * M, 1.0, 200.0, 1.0, 110.5, 99.0, 1.0)
    _, log = run(spark, [good, bad, (T0 + 50 * M, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], tf="5m", minutes=minutes)
    got = {(c, (t - T0) // M) for t, c, _ in log if c >= "R30"}
    assert {(c, i) for c, i in got if i == 0} == {("R33_COUNT_MISMATCH", 0)}  # the minute T0 is missing
    assert {c for c, i in got if i == 5} == {"R30_OHLC_MISMATCH", "R31_VOL_MISMATCH", "R32_RANGE_MISMATCH"}
    assert {c for c, i in got if i == 50} == {"R33_COUNT_MISMATCH"}


def test_issue_logs(spark):
    raw = spark.createDataFrame([("7", " vol-spike "), ("x", None), ("8", "r12_nan"), ("8", "R12_NAN"), ("9", "My Future Code"), ("9", "odd one")], "timestamp_ms string, Issue string")
    log = normalize_issues(raw, "S", "1m")
    assert sorted((r.ts, r.code, r.symbol) for r in log.collect()) == [(0, "UNKNOWN", "S"), (7, "R20_VOL_SPIKE", "S"), (8, "R12_NAN", "S"), (9, "ODD ONE", "S"), (9, "R02_TS_FUTURE", "S")]
    s = {r.code: (r["count"], r.severity, r.level) for r in summarize_issues(log).collect()}
    assert s["R12_NAN"] == (1, "high", 2) and s["ODD ONE"] == (1, "low", 9)
    assert merge_issues(log, log).count() == 5
    assert spark.range(1).select(canonical_code(F.lit("")).alias("c")).first().c == "UNKNOWN"


def series(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    c = 100 * np.exp(np.cumsum(rng.normal(0, 0.004, n)))
    o = np.r_[c[0], c[:-1]]
    pdf = pd.DataFrame({"symbol": "S", "tf": "5m", "ts": T0 + 5 * M * np.arange(n), "o": o, "h": np.maximum(o, c) * 1.001, "l": np.minimum(o, c) * 0.999, "c": c, "v": np.abs(rng.normal(100, 10, n)), "t": 1.0})
    pdf.loc[200:215, "c"] = pdf.loc[200, "c"]
    return pdf, spark.createDataFrame(pdf)


def test_features_against_pandas(spark):
    pdf, df = series(spark)
    got = FT.compute_features(df, "5m").orderBy("ts").toPandas()
    c = pdf["c"]
    lr = np.log(c).diff()
    up, down = c.diff().clip(lower=0), (-c.diff()).clip(lower=0)
    mean = lambda x: x.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
    want = {
        "f_rv_20": lr.rolling(20).std(), "f_mom_50": c / c.shift(50) - 1, "f_ema_close_20": c.ewm(span=20, adjust=False, min_periods=20).mean(),
        "f_rsi_14": 100 - 100 / (1 + mean(up) / mean(down)), "f_close_z_60": (c - c.rolling(60).mean()) / c.rolling(60).std(), "f_donch_h_20": pdf["h"].rolling(20).max(),
    }
    for name, w in want.items():
        np.testing.assert_allclose(got[name].to_numpy(float), w.to_numpy(), rtol=1e-9, atol=1e-9, equal_nan=True)
    assert len([x for x in got.columns if x.startswith("f_")]) == 50
    for name, first in (("f_atr_14", 13), ("f_rsi_14", 14), ("f_adx_14", 26), ("f_atr_z_14", 26), ("f_mom_100", 100)):
        assert got[name].first_valid_index() == first
    assert got["f_rsi_14"].dropna().between(0, 100).all() and got["f_vol_balance_20"].dropna().between(-1, 1).all()
    k, prev = [np.nan] * 10, np.nan
    for i in range(10, len(c)):
        path = c.diff().abs()[i - 9 : i + 1].sum()
        er = abs(c[i] - c[i - 10]) / path if path else np.nan
        base = prev if np.isfinite(prev) else c[i - 1]
        prev = base + (er * (2 / 3 - 2 / 31) + 2 / 31) ** 2 * (c[i] - base)
        k.append(prev)
    np.testing.assert_allclose(got["f_kama_10"].to_numpy(float), k, rtol=1e-9, equal_nan=True)


def test_feature_inputs(spark):
    raw = spark.createDataFrame([("2024-01-01T00:00:00Z", 2.0, 1.0, 3.0, 2.5, -1.0)], "start_time_iso string, Open double, High double, low double, close double, volume double")
    r = FT.feature_input(raw, "1m", "S", repair=True).first()
    assert (r.ts, r.h, r.l, r.v) == (T0, 3.0, 1.0, 0.0)
    got = FT.validate_features(spark.createDataFrame([("5", "1.5"), (None, "2")], "ts string, f_a string"), strict=False).collect()
    assert [(r.ts, r.f_a, r.f_valid_from) for r in got] == [(5, 1.5, 5)]


def test_regimes(spark):
    _, df = series(spark)
    features = FT.compute_features(df, "5m")
    for variant in "AB":
        got = R.infer_regime(features, "5m", variant=variant)
        assert got.columns == R.OUTPUT and got.count() == 400
        assert {r.regime for r in got.select("regime").distinct().collect()} <= {"trend", "flat"}
    old = features.selectExpr("ts as timestamp_ms", "symbol", "tf", "close", "f_adx_14 as f_adx14", "f_pdi_14 as f_pdi14", "f_mdi_14 as f_mdi14", "f_donch_width_pct_20")
    cfg = R.RegimeConfig()
    same = lambda x: [r.d1 for r in R.d1_adx(R.regime_input(x, "5m"), cfg).orderBy("ts").collect()]
    assert same(old) == same(features)
    assert R.infer_regime(features, "5m", hmm=True).count() == 400


def test_hidden_markov_states():
    rng = np.random.default_rng(1)
    calm = np.r_[rng.normal(0.01, 0.001, 100), rng.normal(0.08, 0.005, 100)]
    p = R.hmm_calm(np.abs(calm))
    assert p[:95].min() > 0.9 and p[105:].max() < 0.1
