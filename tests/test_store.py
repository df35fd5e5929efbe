"""Store, tails, files, the candle source, streaming and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from candleforge import cli
from candleforge.schema import BAR
from candleforge.sources import files, klines, store
from candleforge.streaming.bars import store_sink, stream_bars
from tests.test_bars import M, T0, line

NOW = T0 + 10**9


def bars(spark, rows, symbol="S", seq=0):
    return spark.createDataFrame([(symbol, "1m", *r, False) for r in rows], BAR).withColumn("seq", F.lit(seq))


def test_upserts(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    store.write_idempotent(spark, root, bars(spark, line(10)), "seq", NOW)
    store.write_idempotent(spark, root, bars(spark, line(3), "Z"), "seq", NOW)
    before = store.digest(store.series(spark, root, "S", "1m"))
    store.write_idempotent(spark, root, bars(spark, line(10)), "seq", NOW)
    assert store.digest(store.series(spark, root, "S", "1m")) == before
    changed = [(t, o + 1, *rest) for t, o, *rest in line(4, start=T0 + 8 * M)]
    store.write_idempotent(spark, root, bars(spark, changed), "seq", NOW)
    got = store.series(spark, root, "S", "1m").orderBy("ts").collect()
    assert [r.ver for r in got] == [1] * 8 + [2, 2, 0, 0] and got[9].o == changed[1][1]
    assert store.list_symbols(spark, root) == ["S", "Z"] and store.list_tfs(spark, root, "S") == ["1m"]
    assert store.latest_ts(spark, root, "S", "1m") == T0 + 11 * M
    info = store.manifest(spark, root, "S", "1m")
    assert info["rows"] == 12 and info["meta"]["rows"] == 12 and info["data_hash"]
    assert store.manifest(spark, root, "none", "1m")["exists"] is False
    assert store.tail_read(spark, root, "S", "1m")["latest_ts_ms"] == T0 + 11 * M
    assert store.tail_update(spark, root, "S", "1m", 5)["latest_ts_ms"] == T0 + 11 * M
    with pytest.raises(ValueError):
        store.tail_update(spark, root, "new", "1m", None)
    assert store.refresh_tail(spark, root, "none", "1m") is None


def test_open_bars_stay_out(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    store.write_idempotent(spark, root, bars(spark, line(10)), "seq", T0 + 5 * M + 1)
    assert store.latest_ts(spark, root, "S", "1m") == T0 + 4 * M
    assert store.write_idempotent(spark, root, bars(spark, line(3, start=NOW)), "seq", T0).count() == 0


def test_months(spark, tmp_path):
    """A write touches only months with new rows; its meta counts all; no month is lost for odd names."""
    root, day = f"file://{tmp_path}/store", 24 * 60 * M
    store.write_idempotent(spark, root, bars(spark, line(60, step=day), "A/B"), "seq", NOW * 2)
    folder = tmp_path / "store" / "symbol=A%2FB" / "tf=1m"
    assert sorted(x.name for x in folder.glob("month=*")) == ["month=202401", "month=202402"]
    first = sorted(x.name for x in (folder / "month=202401").glob("*.parquet"))
    meta = store.write_idempotent(spark, root, bars(spark, line(3, start=T0 + 40 * day, step=day), "A/B"), "seq", NOW * 2, "again").first()
    assert sorted(x.name for x in (folder / "month=202401").glob("*.parquet")) == first
    assert (meta.rows, meta.min_ts, meta.max_ts, meta.source) == (60, T0, T0 + 59 * day, "again")
    whole = store.series_meta(store.months_meta(store._months(spark, root), "again")).first()
    assert whole.data_hash == meta.data_hash == store.read_meta(spark, root, "A/B", "1m")["data_hash"]
    assert store.list_symbols(spark, root) == ["A/B"] and store.manifest(spark, root, "A/B", "1m")["exists"]
    plan = store.read_range(spark, root, "A/B", "1m", T0 + 40 * day, T0 + 41 * day)._jdf.queryExecution().toString()
    assert "(month#" in plan and "202402" in plan
    odd = bars(spark, line(2)).withColumn("symbol", F.when(F.col("ts") == T0, F.lit("")))
    store.write_idempotent(spark, root, odd, "seq", NOW)
    store.write_idempotent(spark, root, odd.where(F.col("ts") == T0), "seq", NOW)
    assert sorted(r.ver for r in store.series(spark, root, "?", "1m").collect()) == [0, 1]
    assert store.read_between(spark, root, "A/B", "1m", -(1 << 60), 1 << 60).count() == 60


def test_a_dead_write_is_finished(spark, tmp_path, monkeypatch):
    """A write that dies while months are put in place, some of them gone already, loses no row."""
    import shutil

    root = f"file://{tmp_path}/store"
    store.write_idempotent(spark, root, bars(spark, line(10)), "seq", NOW)

    def die(*_):
        shutil.rmtree(tmp_path / "store" / "symbol=S")
        raise OSError

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(store, "_put", die)
        store.write_idempotent(spark, root, bars(spark, line(2, start=T0 + 9 * M)), "seq", NOW)
    store.write_idempotent(spark, root, bars(spark, line(1, start=T0 + 20 * M)), "seq", NOW)
    assert sorted((r.ts - T0) // M for r in store.series(spark, root, "S", "1m").collect()) == [*range(11), 20]
    assert store.read_meta(spark, root, "S", "1m")["rows"] == 12 and not list((tmp_path / "store" / "_staging").iterdir())


def test_reads(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    assert store.read(spark, root, "S", "1m").count() == 0
    store.sanitize_and_write(spark, root, bars(spark, [r for i, r in enumerate(line(20)) if i != 7]), "seq", "S", NOW)
    assert store.read_range(spark, root, "S", "1m", T0, T0 + 5 * M).count() == 5
    assert store.read_between(spark, root, "S", "1m", T0, T0 + 5 * M).count() == 6
    assert store.read(spark, root, "S", "1m", ["ts", "extra"]).first().extra is None
    assert store.read_day(spark, root, "S", "1m", "2024-01-01").count() == 20
    assert store.by_day(spark, root, "S", "1m", "2024-01-01", "2024-01-03").groupBy("day_ms").agg(F.count("ts").alias("n")).orderBy("day_ms").toPandas()["n"].tolist() == [20, 0, 0]
    assert store.read_stats(store.read(spark, root, "S", "1m")) == store.ReadStats(20, T0, T0 + 19 * M)
    store.resample_and_write(spark, root, "S", "5m", NOW)
    assert store.read(spark, root, "S", "5m").count() == 4
    plan = store.read_range(spark, root, "S", "1m", T0, T0 + M)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan and "PartitionFilters: [isnotnull(symbol" in plan


def test_tail_window(spark, tmp_path):
    day = 24 * 60 * M
    rows = bars(spark, line(20, step=day))
    assert store.tail_window(rows, 14).count() == 15
    assert store.write_tail(spark, f"file://{tmp_path}", rows, "seq").count() == 15


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "ts long, o string")
    files.dump(df, f"{tmp_path}/a.csv")
    files.dump(df, f"{tmp_path}/a.parquet", "snappy")
    assert files.load(spark, f"{tmp_path}/a.csv").first().ts == "1" and files.load(spark, f"{tmp_path}/a.parquet").first().ts == 1
    with pytest.raises(ValueError):
        files.dump(df, "x", "lzma")


def pages(folder, n):
    for a, b in klines.pages(T0, T0 + n * M, 4):
        rows = [[str(t), "1", "2", "0.5", "1.5", "3", "x"] for t in range(a, b, M)]
        (folder / f"S-{a}.json").write_text(json.dumps({"result": {"list": rows[::-1]}}))


def test_candle_source(spark, tmp_path):
    pages(tmp_path, 10)
    klines.register(spark)
    df = spark.read.format("klines").options(symbol="S", start_ms=str(T0), end_ms=str(T0 + 10 * M), page_size="4", base_url=f"file://{tmp_path}").load()
    assert df.rdd.getNumPartitions() == 3 and df.count() == 10 and df.first().t is None


def test_retries(monkeypatch):
    import urllib.error

    calls, waits = [], []

    def fail(url, timeout):
        calls.append(url)
        raise urllib.error.HTTPError(url, 429, "slow down", {"Retry-After": "7"}, None)

    monkeypatch.setattr("urllib.request.urlopen", fail)
    with pytest.raises(urllib.error.HTTPError):
        klines.get("http://x", 1, 2, waits.append)
    assert len(calls) == 3 and waits == [7.0, 7.0]
    assert klines.wait_seconds(9, None) <= 60


def test_stream(spark, tmp_path):
    src, root = f"{tmp_path}/in", f"file://{tmp_path}/store"
    ticks = spark.createDataFrame([("S", T0 / 1000 + 20 * i, i, 1.0 + i, 2.0) for i in range(30)], "symbol string, s double, seq long, price double, volume double")
    ticks = ticks.select("symbol", F.timestamp_seconds("s").alias("at"), "seq", "price", "volume")
    ticks.write.parquet(src)
    bars_ = stream_bars(spark.readStream.schema(ticks.schema).parquet(src), "1m", "1 minute")
    q = store_sink(bars_, root, f"{tmp_path}/cp", NOW).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = store.series(spark, root, "S", "1m").orderBy("ts").collect()
    want = stream_bars(ticks, "1m").orderBy("ts").collect()
    assert 7 <= len(got) <= 10 and [(r.ts, r.o, r.c, r.v) for r in got] == [(r.ts, r.o, r.c, r.v) for r in want[: len(got)]]


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "session", lambda: spark)
    src = f"{tmp_path}/S_1m.parquet"
    bars(spark, [r for i, r in enumerate(line(120)) if not 20 <= i < 32]).drop("seq").write.parquet(src)
    assert cli.main(["resample", src, "--dst-tf", "5m", "--out", f"{tmp_path}/S_5m.parquet"]) == 0
    assert cli.main(["resample", f"{tmp_path}/S_5m.parquet", "--out", "x"]) == 1
    assert cli.main(["missing-report", src, "--fail-gap-pct", "0.05"]) == 2
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])[0]["gap_pct"] == 0.1
    assert cli.main(["missing-report", src, "--fail-gap-pct", "0.2"]) == 0
    out = f"{tmp_path}/dq"
    assert cli.main(["validate", f"{tmp_path}/S_5m.parquet", "--ref-1m", src, "--out-dir", out, "--now-ms", str(NOW), "--quality-json", f"{tmp_path}/q.json"]) == 0
    assert json.load(open(f"{tmp_path}/q.json"))["issues"][0]["code"]
    assert cli.main(["quality-report", f"{out}/clean.parquet", "--issues", f"{out}/clean.issues.parquet", "--out-md", f"{tmp_path}/q.md"]) == 0
    assert "| code | count |" in open(f"{tmp_path}/q.md").read()
    (tmp_path / "cfg.json").write_text(json.dumps({"rv": 10, "unknown": 1, "ema": [5, 9]}))
    assert cli.main(["features", src, f"{tmp_path}/f.parquet", "--symbol", "S", "--config", f"{tmp_path}/cfg.json"]) == 0
    assert "f_ema_close_9" in spark.read.parquet(f"{tmp_path}/f.parquet").columns
    assert cli.main(["regime", "--features", f"{tmp_path}/f.parquet", "--tf", "5m", "--out", f"{tmp_path}/r.csv"]) == 0
    assert cli.main(["check-latency", src, "--now-ms", str(NOW)]) == 2
    root = f"file://{tmp_path}/store"
    assert cli.main(["update", src, "--symbol", "S", "--store", root, "--now-ms", str(NOW)]) == 0
    span = ["report-missing", "--symbol", "S", "--store", root, "--since-ms", str(T0 - 12 * M), "--until-ms", str(T0 + 108 * M)]
    capsys.readouterr()
    assert cli.main(span) == 0
    got = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (got["symbol"], got["total_minutes"], got["gaps"], round(got["gap_pct"], 9)) == ("S", 120, 24, 20.0)
    assert cli.main([*span, "--fail-gap-pct", "5"]) == 2 and cli.main([*span, "--fail-gap-pct", "25"]) == 0
    assert cli.main(["report-missing", "--symbol", "none", "--store", root, "--fail-gap-pct", "5"]) == 0
    (tmp_path / "rates.csv").write_text("symbol,missing_rate\nA,0.00001\nB,0.5\n")
    assert cli.main(["missing-threshold", f"{tmp_path}/rates.csv"]) == 2 and cli.main(["missing-threshold", f"{tmp_path}/rates.csv", "--threshold", "0.9"]) == 0
    before = spark.read.parquet(f"{tmp_path}/S_5m.parquet").columns
    assert cli.main(["validate", f"{tmp_path}/S_5m.parquet", "--out-dir", f"{tmp_path}/dq2", "--now-ms", str(NOW), "--write-inplace"]) == 0
    assert "dq_flags" in spark.read.parquet(f"{tmp_path}/S_5m.parquet").columns and "dq_flags" not in before
    pages(tmp_path, 10)
    assert cli.main(["backfill", "S", "--store", root, "--since-ms", str(T0), "--until-ms", str(T0 + 10 * M), "--page-size", "4", "--base-url", f"file://{tmp_path}", "--now-ms", str(NOW)]) == 0
    assert cli.main(["backfill", "S", "--store", root, "--since-ms", "0", "--until-ms", "0"]) == 1
