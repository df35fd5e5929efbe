"""Grids, gaps, resampling, recurrences and runs on small frames."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candleforge.functions import timegrid as G
from candleforge.operators.align import align_gaps, missing_report, normalize_bars
from candleforge.operators.islands import confirmed_sign, cooldown, in_long_run, run_length
from candleforge.operators.recurrence import ewm, scan
from candleforge.operators.resample import resample, resample_closed_right
from candleforge.schema import BAR, coerce, last_wins

T0 = 1_704_067_200_000
M = 60_000


def bars(spark, rows, symbol="S", tf="1m"):
    return spark.createDataFrame([(symbol, tf, *r, False) for r in rows], BAR)


def line(n, step=M, start=T0):
    return [(start + i * step, 100.0 + i, 101.0 + i, 99.0 + i, 100.5 + i, 1.0, 2.0) for i in range(n)]


def test_time_grid(spark):
    assert [G.parse_tf(x) for x in ("1m", "60s", "15min", "1h", "60m")] == [M, M, 15 * M, 60 * M, 60 * M]
    with pytest.raises(ValueError):
        G.parse_tf("1w")
    assert G.align_range(61_000, 119_000, "1m") == (60_000, 120_000) and G.align_range(61_000, 61_000, "1m") == (60_000, 60_000)
    assert G.day_bounds(T0 + 5) == (T0, T0 + G.DAY) and G.whole_minutes("5m") and not G.whole_minutes("30s")
    df = spark.createDataFrame([(-1,), (0,), (61_000,)], "ts long").select(G.floor_ts("ts", M), G.ceil_ts("ts", M))
    assert [tuple(r) for r in df.collect()] == [(-M, 0), (0, 0), (M, 2 * M)]


def test_coerce(spark):
    raw = spark.createDataFrame([("5", "1", "2", "0.5", "x", "3", "skip")], "Timestamp string, OPEN string, High string, low string, close string, Volume string, other string")
    r = coerce(raw).first()
    assert (r.ts, r.o, r.c, r.t) == (5, 1.0, None, None) and "other" not in r
    with pytest.raises(ValueError, match="missing columns: v"):
        coerce(raw.drop("Volume"))
    bad = raw.withColumn("Timestamp", F.lit("no"))
    assert coerce(bad, "zero").first().ts == 0 and coerce(bad, "drop").count() == 0
    with pytest.raises(Exception, match="ts is no number"):
        coerce(bad).collect()
    nan = spark.createDataFrame([(1, float("nan"))], "ts long, o double").withColumns({x: F.col("o") for x in "hlcv"})
    assert coerce(nan).first().o is None


def test_align(spark):
    rows = [r for i, r in enumerate(line(10)) if i not in (3, 4, 7)]
    rows[1] = (rows[1][0], None, None, None, None, None, None)
    rows.append((T0 + 30_000, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0))
    got = align_gaps(bars(spark, rows)).orderBy("ts").collect()
    assert [r.ts for r in got] == [T0 + i * M for i in range(10)]
    assert [r.is_gap for r in got] == [i in (3, 4, 7) for i in range(10)]
    assert (got[3].o, got[4].c, got[4].v, got[1].c) == (102.5, 102.5, 0.0, None)


def test_normalize_counts(spark):
    raw = [("S", T0 + 5, 1.0, 1), ("S", T0 + 9, 2.0, 2), ("S", T0 + 2 * M, 3.0, 3)]
    df = spark.createDataFrame(raw, "symbol string, ts long, o double, seq long").withColumns({x: F.col("o") for x in "hlcv"})
    out, stats = normalize_bars(df, "seq")
    assert [(r.c, r.is_gap) for r in out.orderBy("ts").collect()] == [(2.0, False), (2.0, True), (3.0, False)]
    s = stats.first()
    assert (s.rows_in, s.misaligned_fixed, s.dup_removed, s.rows_out, s.gaps) == (3, 2, 1, 3, 1)
    assert abs(s.gap_pct - 100 / 3) < 1e-9
    assert missing_report(out, T0, T0 + 2 * M).first().gap_pct == 0.5


def test_ten_minutes_are_two_bars(spark):
    got = resample(bars(spark, line(10)), "5m").orderBy("ts").collect()
    assert [(r.ts, r.o, r.h, r.l, r.c, r.v, r.is_gap) for r in got] == [(T0, 100.0, 105.0, 99.0, 104.5, 5.0, False), (T0 + 5 * M, 105.0, 110.0, 104.0, 109.5, 5.0, False)]
    assert [r.ts for r in resample(bars(spark, line(10)), "5m", "end").orderBy("ts").collect()] == [T0 + 5 * M, T0 + 10 * M]
    right = resample_closed_right(bars(spark, line(1) + line(1, start=T0 + 16 * M)), "5m").orderBy("ts").collect()
    assert [(r.ts, r.o, r.v) for r in right] == [(T0 - 5 * M, 100.0, 1.0), (T0, None, 0.0), (T0 + 5 * M, None, 0.0), (T0 + 10 * M, None, 0.0), (T0 + 15 * M, 100.0, 1.0)]


def test_last_wins(spark):
    rng = random.Random(1)
    rows = [("S", "1m", rng.randrange(40), float(i), i) for i in range(120)]
    got = last_wins(spark.createDataFrame(rows, "symbol string, tf string, ts long, c double, seq long"), "seq").collect()
    assert {r.ts: r.c for r in got} == {t: c for _, _, t, c, _ in rows}


def test_exponential_mean_equals_pandas(spark):
    rng = np.random.default_rng(1)
    n = 40_000
    x = rng.standard_normal(n)
    x[rng.random(n) < 0.2] = np.nan
    x[:3] = np.nan
    rows = spark.createDataFrame(pd.DataFrame({"symbol": "S", "tf": "1m", "ts": T0 + M * np.arange(n), "x": x})).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    got = ewm(rows, {"y": ("x", 1 / 14, 14)}, M).orderBy("ts").toPandas()["y"].to_numpy(float)
    want = pd.Series(x).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean().to_numpy()
    assert (np.isnan(got) == np.isnan(want)).all() and np.nanmax(np.abs(got - want)) < 1e-12


def test_scan_restarts(spark):
    rng = random.Random(2)
    rows = [("S", "1m", T0 + i * M, rng.choice([0.0, 0.5, 1.0, 0.9]), rng.random()) for i in range(700)]
    got = scan(spark.createDataFrame(rows, "symbol string, tf string, ts long, a double, b double"), {"y": (F.col("a"), F.col("b"))}, M).orderBy("ts").collect()
    y = None
    for r, (_, _, _, a, b) in zip(got, rows, strict=True):
        y = b if a == 0 else None if y is None else a * y + b
        assert r.y == y or abs(r.y - y) < 1e-12


def frame(spark, values, name="x"):
    return spark.createDataFrame([("S", "1m", i, v) for i, v in enumerate(values)], f"symbol string, tf string, ts long, {name} {'boolean' if isinstance(values[0], bool) else 'double'}")


def test_runs(spark):
    flags = [random.Random(i).random() < 0.7 for i in range(300)]
    got = [r.n for r in run_length(frame(spark, flags), "x", "n").orderBy("ts").collect()]
    want = [0.0]
    for f in flags[1:]:
        want.append((want[-1] + 1) * f)
    assert got == want
    long = [r.y for r in in_long_run(frame(spark, [True] * 5 + [False] + [True] * 4), "x", 5, "y").orderBy("ts").collect()]
    assert long == [True] * 5 + [False] * 5


def test_confirmed_sign(spark):
    values = [1.0, 1.0, 0.0, 1.0, -1.0, 0.0, -1.0, -1.0]
    a = [r.y for r in confirmed_sign(frame(spark, values), "x", 3, "y", True).orderBy("ts").collect()]
    b = [r.y for r in confirmed_sign(frame(spark, values), "x", 2, "y", False).orderBy("ts").collect()]
    assert a == [0, 0, 1, 1, 0, 0, -1, -1] and b == [0, 1, 0, 0, 0, 0, 0, -1]


def test_cooldown_equals_the_loop(spark):
    rng = random.Random(3)
    for rows in (0, 1, 3, 10):
        s = [rng.choice([-1.0, 1.0]) for _ in range(400)]
        s[:2] = [0.0, 0.0]
        want, now, left = [], s[0], 0
        for i, v in enumerate(s):
            if i and v != now and not left:
                now, left = v, rows
            else:
                left = max(0, left - 1)
            want.append(now)
        assert [r.y for r in cooldown(frame(spark, s), "x", rows, "y").orderBy("ts").collect()] == want


def test_small_blocks_and_batches_change_nothing(spark, monkeypatch):
    from candleforge.operators import recurrence

    monkeypatch.setattr(recurrence, "BLOCK", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_scan_restarts(spark)
        test_runs(spark)
        test_confirmed_sign(spark)
        test_cooldown_equals_the_loop(spark)
        rng = np.random.default_rng(6)
        x = np.where(rng.random(600) < 0.6, np.nan, rng.standard_normal(600))
        x[100:270] = np.nan  # whole blocks without an observation
        rows = spark.createDataFrame(pd.DataFrame({"symbol": "S", "tf": "1m", "ts": T0 + M * np.arange(600), "x": x})).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
        got = ewm(rows, {"y": ("x", 0.2, 5)}, M).orderBy("ts").toPandas()["y"].to_numpy(float)
        want = pd.Series(x).ewm(alpha=0.2, adjust=False, min_periods=5).mean().to_numpy()
        assert (np.isnan(got) == np.isnan(want)).all() and np.nanmax(np.abs(got - want)) < 1e-12
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_long_alternating_signal_is_linear():
    from candleforge.operators.islands import Cooldown

    out, _ = Cooldown("s", 1, "y")({"s": np.tile([1.0, -1.0], 500_000)}, None)
    assert len(out["y"]) == 1_000_000 and set(out["y"][:4]) == {1.0, -1.0}
