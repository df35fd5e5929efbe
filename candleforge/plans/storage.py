"""Named queries over the store, files, tails, reports and commands, each with the SQL that checks it.

They write into a fresh folder below the shared one and read back what they return.
"""

from __future__ import annotations

import io
import json
from contextlib import redirect_stdout

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge import cli
from candleforge.functions import timegrid as G
from candleforge.operators import features as FT
from candleforge.operators import regime as R
from candleforge.operators.issues import ALIASES, normalize_issues
from candleforge.operators.quality import validate
from candleforge.operators.report import as_json, as_markdown
from candleforge.operators.resample import resample
from candleforge.plans.registry import END, NOW, OHLCV, START, query
from candleforge.plans.registry import rounded_sql as _r
from candleforge.plans.sql import sql
from candleforge.plans.tables import dirty, event_bars, hourly, table
from candleforge.schema import coerce
from candleforge.sources import files, store
from candleforge.sources.fs import new_folder

LATE = 2 * NOW
ONE = "click"  # the series that is read alone
DAY0 = 1_704_758_400_000  # 2024-01-09


def _write(spark: SparkSession, root: str, bars: DataFrame, seq: int = 0) -> None:
    store.write_idempotent(spark, root, bars.withColumn("seq", F.lit(seq)), "seq", LATE, "events")


def _store(spark: SparkSession, sf: str, tf: str = "1h") -> str:
    root = new_folder(spark, "bars")
    _write(spark, root, event_bars(spark, sf, tf))
    return root


def _rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _command(spark: SparkSession, *args: str) -> tuple[int, list]:
    """A command's exit code and what it has printed, read as JSON."""
    a, out = cli.parser().parse_args([str(x) for x in args]), io.StringIO()
    with redirect_stdout(out):
        code = a.run(a, spark)
    return code, [json.loads(x) for x in out.getvalue().splitlines()]


def _file(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = f"{new_folder(spark, 'file')}/{name}"
    files.dump(df, path)
    return path


# The store


@query(sql(f"""SELECT symbol, ts, {_r('c')}, ver FROM (
  SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.ts, b.ts) AS ts, coalesce(b.c2, a.c) AS c, CASE WHEN a.ts IS NOT NULL AND b.ts IS NOT NULL THEN 1 ELSE 0 END AS ver
  FROM (SELECT * FROM bars WHERE ts < {END}) a FULL JOIN (SELECT *, c + 1 AS c2 FROM bars WHERE ts >= {START}) b ON a.symbol = b.symbol AND a.ts = b.ts)"""))
def store_upsert(spark, sf):
    """Two writes that overlap by a week; the second holds each key twice."""
    root, bars = new_folder(spark, "bars"), event_bars(spark, sf)
    _write(spark, root, bars.where(F.col("ts") < END))
    new = bars.where(F.col("ts") >= START)
    twice = new.withColumns({"c": F.col("c") + 1, "seq": F.lit(2)}).unionByName(new.withColumn("seq", F.lit(1)))
    store.write_idempotent(spark, root, twice, "seq", LATE)
    return store.stored(spark, root).select("symbol", "ts", "c", "ver")


@query(sql(f"SELECT symbol, ts, {_r('c')} FROM bars WHERE ts <= {END} - 60000"))
def store_closed_only(spark, sf):
    """A write at END + 59 s leaves out the bar of the minute that is still open."""
    root = new_folder(spark, "bars")
    store.write_idempotent(spark, root, event_bars(spark, sf).withColumn("seq", F.lit(0)), "seq", END + 59_000)
    return store.stored(spark, root).select("symbol", "ts", "c")


@query(sql("SELECT symbol, '1h' AS tf, count(*) AS rows, min(ts) AS min_ts, max(ts) AS max_ts, 'events' AS source, true AS same_hash FROM bars GROUP BY symbol"))
def store_meta(spark, sf):
    """Meta put together from two writes' months equals that of the whole."""
    root, bars = new_folder(spark, "bars"), event_bars(spark, sf)
    _write(spark, root, bars.where(F.col("ts") < END))
    _write(spark, root, bars.where(F.col("ts") >= START))
    whole = store.series_meta(store.months_meta(bars.withColumn("month", F.lit(0)), "")).select("symbol", F.col("data_hash").alias("whole"))
    got = store.all_meta(spark, root).join(whole, "symbol")
    return got.select("symbol", "tf", "rows", "min_ts", "max_ts", "source", (F.col("data_hash") == F.col("whole")).alias("same_hash"))


@query(sql(f"""SELECT symbol, count(*) AS rows, min(ts) AS min_ts, max(ts) AS max_ts, true AS there, true AS meta_agrees FROM bars GROUP BY symbol
  UNION ALL SELECT 'none', 0, NULL, NULL, false, true"""))
def manifest_stats(spark, sf):
    root, out = _store(spark, sf), []
    for s in [*store.list_symbols(spark, root), "none"]:
        m = store.manifest(spark, root, s, "1h")
        out.append((s, m["rows"], m["min_ts"], m["max_ts"], m["exists"], m["meta"].get("rows", 0) == m["rows"] and m["data_hash"] == store.read_meta(spark, root, s, "1h").get("data_hash")))
    return _rows(spark, "symbol string, rows long, min_ts long, max_ts long, there boolean, meta_agrees boolean", out)


@query(sql(f"SELECT ts, {_r(*OHLCV)}, false AS is_gap, NULL::DOUBLE AS absent FROM bars WHERE symbol = '{ONE}' AND ts >= {START} AND ts < {END}"))
def store_range(spark, sf):
    return store.read_range(spark, _store(spark, sf), ONE, "1h", START, END, ["ts", *OHLCV, "is_gap", "absent"])


@query(sql(f"SELECT ts, {_r(*OHLCV)}, false AS is_gap FROM bars WHERE symbol = '{ONE}' AND ts BETWEEN {START} AND {END}"))
def store_between(spark, sf):
    return store.read_between(spark, _store(spark, sf), ONE, "1h", START, END)


@query(sql(f"SELECT ts, {_r(*OHLCV)}, false AS is_gap FROM bars WHERE symbol = '{ONE}'"))
def store_read(spark, sf):
    return store.read(spark, _store(spark, sf), ONE, "1h")


_OF_DAY = f"(SELECT * FROM bars WHERE symbol = '{ONE}' AND ts >= {DAY0} AND ts < {DAY0 + G.DAY})"


@query(sql(f"""SELECT ts, {', '.join(f'round(coalesce({x}, k), 6) AS {x}' for x in 'ohlc')}, round(coalesce(v, 0), 6) AS v, round(coalesce(t, 0), 6) AS t, is_gap FROM (
  SELECT g.ts, d.* EXCLUDE (symbol, ts), d.ts IS NULL AS is_gap, last_value(c IGNORE NULLS) OVER (ORDER BY g.ts) AS k
  FROM (SELECT unnest(range(min(ts), max(ts) + 1, 3600000)) AS ts FROM {_OF_DAY}) g LEFT JOIN {_OF_DAY} d ON g.ts = d.ts)""", "bars"))
def store_day(spark, sf):
    return store.read_day(spark, _store(spark, sf), ONE, "1h", "2024-01-09", align=True)


@query(sql(f"""SELECT d.day_ms, count(b.ts) AS bars, round(sum(b.v), 6) AS v FROM (SELECT unnest(range(1703980800000, 1706832000001, 86400000)) AS day_ms) d
  LEFT JOIN (SELECT * FROM bars WHERE symbol = '{ONE}') b ON b.ts - b.ts % 86400000 = d.day_ms GROUP BY d.day_ms""", "bars"))
def store_days(spark, sf):
    return store.by_day(spark, _store(spark, sf), ONE, "1h", "2023-12-31", "2024-02-02").groupBy("day_ms").agg(F.count("ts").alias("bars"), F.sum("v").alias("v"))


@query(sql("SELECT symbol, '1h' AS tf, max(ts) AS latest FROM bars GROUP BY symbol UNION ALL SELECT symbol, '4h', max(ts - ts % 14400000) FROM bars GROUP BY symbol"))
def store_lists(spark, sf):
    root = _store(spark, sf)
    _write(spark, root, resample(event_bars(spark, sf), "4h"))
    found = [(s, tf, store.latest_ts(spark, root, s, tf)) for s in store.list_symbols(spark, root) for tf in store.list_tfs(spark, root, s)]
    return _rows(spark, "symbol string, tf string, latest long", found)


@query("SELECT * FROM (VALUES ('ts', 'bigint', 0), ('o', 'double', 0), ('h', 'double', 0), ('l', 'double', 0), ('c', 'double', 0), ('v', 'double', 0), ('t', 'double', 0), ('is_gap', 'boolean', 0)) AS r(name, kind, n)")
def store_empty(spark, sf):
    """What isn't there reads as a typed table without rows."""
    df = store.read(spark, new_folder(spark, "none"), ONE, "1h")
    n = df.count()
    return _rows(spark, "name string, kind string, n int", [(name, kind, n) for name, kind in df.dtypes])


_ONE_MINUTES = f"(SELECT ms - ms % 60000 AS ts, last(value ORDER BY event_id) AS p FROM ev WHERE symbol = '{ONE}' GROUP BY 1)"


@query(sql(f"""SELECT ts - ts % 3600000 AS ts, round(first(k ORDER BY ts), 6) AS o, round(max(k), 6) AS h, round(min(k), 6) AS l, round(last(k ORDER BY ts), 6) AS c, round(sum(coalesce(p, 0)), 6) AS v, bool_or(p IS NULL) AS is_gap FROM (
  SELECT g.ts, m.p, last_value(m.p IGNORE NULLS) OVER (ORDER BY g.ts) AS k
  FROM (SELECT unnest(range(min(ts), max(ts) + 1, 60000)) AS ts FROM {_ONE_MINUTES}) g LEFT JOIN {_ONE_MINUTES} m ON g.ts = m.ts) GROUP BY 1""", "ev"))
def store_sanitized(spark, sf):
    """Raw rows of one series, sanitized into the store; from there its minutes as hours."""
    root = new_folder(spark, "bars")
    ev = table(spark, sf, "events").where(F.col("event_type") == ONE)
    raw = ev.select(F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), *[F.col("value").alias(x) for x in ("Open", "HIGH", "low", "close", "volume")], "event_id")
    store.sanitize_and_write(spark, root, raw, "event_id", ONE, LATE)
    store.resample_and_write(spark, root, ONE, "1h", LATE)
    return store.read(spark, root, ONE, "1h").drop("t")


@query("""SELECT event_type AS symbol, CASE WHEN event_id % 50 = 0 THEN 0 ELSE (epoch_us(ts) // 1000) // 60000 * 60000 END AS ts, round(last(value ORDER BY event_id), 6) AS c, 0 AS ver, false AS is_gap
FROM events GROUP BY 1, 2""")
def store_canonical(spark, sf):
    """A table with text for times, some of which are no numbers."""
    ms = G.floor_ts(F.unix_millis(F.col("ts").cast("timestamp")), G.MINUTE).cast("string")
    raw = table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.when(F.col("event_id") % 50 == 0, "x").otherwise(ms).alias("timestamp"), *[F.col("value").cast("string").alias(x) for x in ("o", "h", "l", "c", "v")], "event_id",
    )
    return store.canonicalize(raw, "event_id").select("symbol", "ts", "c", "ver", "is_gap")


# Tails


@query(sql(f"""SELECT b.symbol, b.ts, {_r('c', alias='b.')} FROM bars b JOIN (SELECT symbol, max(ts) AS m FROM bars GROUP BY symbol) x ON b.symbol = x.symbol AND b.ts >= x.m - 14 * 86400000"""))
def tail_bars(spark, sf):
    return store.write_tail(spark, new_folder(spark, "tail"), event_bars(spark, sf).withColumn("seq", F.lit(0)), "seq").select("symbol", "ts", "c")


@query(sql("SELECT symbol, max(ts) AS latest_ts_ms, max(ts) AS refreshed FROM bars GROUP BY symbol UNION ALL SELECT 'none', NULL, NULL"))
def tail_marks(spark, sf):
    """Marks only rise; a series that isn't there has none."""
    root, out = _store(spark, sf), []
    for s in store.list_symbols(spark, root):
        store.tail_update(spark, root, s, "1h", 5)
        out.append((s, store.tail_read(spark, root, s, "1h")["latest_ts_ms"], store.refresh_tail(spark, root, s, "1h")["latest_ts_ms"]))
    out.append(("none", store.tail_read(spark, root, "none", "1h"), store.refresh_tail(spark, root, "none", "1h")))
    return _rows(spark, "symbol string, latest_ts_ms long, refreshed long", out)


# Files


@query(sql(f"SELECT symbol, '1h' AS tf, ts, {_r(*OHLCV)} FROM bars"))
def csv_roundtrip(spark, sf):
    return coerce(files.load(spark, _file(spark, event_bars(spark, sf), "bars.csv")))


@query(sql("SELECT codec, n, c FROM (SELECT unnest(['zstd', 'snappy', 'gzip', 'none']) AS codec) x, (SELECT count(*) AS n, round(sum(c), 6) AS c FROM bars) y"))
def parquet_codecs(spark, sf):
    root, out = new_folder(spark, "codecs"), None
    for codec in ("zstd", "snappy", "gzip", "none"):
        files.dump(event_bars(spark, sf), f"{root}/{codec}.parquet", codec)
        one = files.load(spark, f"{root}/{codec}.parquet").agg(F.lit(codec).alias("codec"), F.count("*").alias("n"), F.sum("c").alias("c"))
        out = one if out is None else out.unionByName(one)
    return out


# Issue logs and reports

#: The code of each other spelling, in the registry's order of spellings: fixed values.
_CODES = """['R01_DUP_TS', 'R01_DUP_TS', 'R02_TS_FUTURE', 'R02_TS_FUTURE', 'R03_TS_MISALIGNED', 'R03_TS_MISALIGNED', 'R10_NEG_PRICE', 'R11_NEG_VOL', 'R12_NAN', 'R13_OHLC_ORDER', 'R14_H_LT_L',
  'R20_VOL_SPIKE', 'R21_ATR_SPIKE', 'R22_RET_SPIKE', 'R23_ZERO_RUN', 'R30_OHLC_MISMATCH', 'R31_VOL_MISMATCH', 'R32_RANGE_MISMATCH', 'R33_COUNT_MISMATCH']"""


@query(f"""SELECT DISTINCT CASE WHEN event_id % 50 = 0 THEN 0 ELSE (epoch_us(ts) // 1000) END AS ts, {_CODES}[event_id % 19 + 1] AS code, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS note, event_type AS symbol, '1m' AS tf
FROM events""")
def issues_normalized(spark, sf):
    """A log under other column names, with all other spellings of codes, whole and as parts."""
    spellings = F.array(*[F.lit(a.upper().replace("_", "-")) for a, _ in ALIASES])
    spelling = F.element_at(spellings, (F.col("event_id") % len(ALIASES) + 1).cast("int"))
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    log = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 50 == 0, "x").otherwise(ms).alias("Timestamp_MS"), F.when(F.col("event_id") % 2 == 0, spelling).otherwise(F.concat(F.lit("x "), spelling)).alias("Err"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("msg"), F.col("event_type").alias("ticker"),
    )
    return normalize_issues(log, tf="1m")


def _validated(spark, sf):
    return validate(dirty(event_bars(spark, sf)), "1h", NOW)


@query(sql("SELECT symbol, count(*) AS bars, min(ts) AS min_ts, round(avg((dq_flags <> 0)::INT), 6) AS flagged_ratio FROM clean GROUP BY symbol"))
def quality_json(spark, sf):
    rows = json.loads(as_json(*_validated(spark, sf)))["series"]
    return _rows(spark, "symbol string, bars long, min_ts long, flagged_ratio double", [(r["symbol"], r["bars"], r["min_ts"], r["flagged_ratio"]) for r in rows])


@query(sql("SELECT '| ' || code || ' | ' || count(*) || ' |' AS line FROM issues GROUP BY code"))
def quality_markdown(spark, sf):
    return _rows(spark, "line string", [(x,) for x in as_markdown(*_validated(spark, sf)).splitlines() if x.startswith("| R")])


# Time


@query("""SELECT s, e, tf, ms::BIGINT AS ms, ms || ' milliseconds' AS step, ms % 60000 = 0 AS whole, s // ms * ms AS low, CASE WHEN e <= s THEN s // ms * ms ELSE (e + ms - 1) // ms * ms END AS high, s // 86400000 * 86400000 AS day, s // 86400000 * 86400000 + 86400000 AS next_day
FROM (SELECT i * 7777777 + 1700000000001 AS s, i * 7777777 + 1700000000001 + (i % 5) * 1000000 AS e, tf, ms FROM (SELECT unnest(range(0, 200)) AS i), (VALUES ('30s', 30000), ('1m', 60000), ('5min', 300000), ('4h', 14400000)) AS x(tf, ms))""")
def time_ranges(spark, sf):
    out = []
    for i in range(200):
        s = i * 7_777_777 + 1_700_000_000_001
        e = s + i % 5 * 1_000_000
        out += [(s, e, tf, G.parse_tf(tf), G.interval(tf), G.whole_minutes(tf), *G.align_range(s, e, tf), *G.day_bounds(s)) for tf in ("30s", "1m", "5min", "4h")]
    return _rows(spark, "s long, e long, tf string, ms long, step string, whole boolean, low long, high long, day long, next_day long", out)


# Commands


@query(sql(f"SELECT symbol, ts, {_r(*OHLCV)} FROM bars"))
def cli_resample(spark, sf):
    src = _file(spark, event_bars(spark, sf, "1m"), "ev_1m.parquet")
    _command(spark, "resample", src, "--dst-tf", "1h", "--out", f"{src}.out", "--compression", "snappy")
    return files.load(spark, f"{src}.out").select("symbol", "ts", *OHLCV)


@query(sql("SELECT symbol, n AS total, n - have AS gaps, round((n - have) / n, 6) AS gap_pct, 2 AS code FROM (SELECT symbol, (max(ts) - min(ts)) // 60000 + 1 AS n, count(*) AS have FROM mins GROUP BY symbol)"))
def cli_missing_report(spark, sf):
    code, printed = _command(spark, "missing-report", _file(spark, event_bars(spark, sf, "1m"), "ev_1m.parquet"), "--fail-gap-pct", 0.01)
    return _rows(spark, "symbol string, total long, gaps long, gap_pct double, code int", [(r["symbol"], r["total"], r["gaps"], r["gap_pct"], code) for r in printed[-1]])


@query(sql(f"""SELECT symbol, n::BIGINT AS total, n - have AS gaps, round((n - have) / n * 100, 6) AS gap_pct, 2 AS code FROM (
  SELECT symbol, {(END - START) // 60000} AS n, count(*) FILTER (ts >= {START} AND ts < {END}) AS have FROM mins GROUP BY symbol)"""))
def cli_report_missing(spark, sf):
    """Minutes of a week that the store lacks."""
    root, out = _store(spark, sf, "1m"), []
    for s in store.list_symbols(spark, root):
        code, printed = _command(spark, "report-missing", "--symbol", s, "--store", root, "--since-ms", START, "--until-ms", END, "--fail-gap-pct", 0.01)
        out.append((s, printed[-1]["total_minutes"], printed[-1]["gaps"], printed[-1]["gap_pct"], code))
    return _rows(spark, "symbol string, total long, gaps long, gap_pct double, code int", out)


@query(sql(f"SELECT symbol, '1h' AS tf, ts, {_r('o', 'c')}, 0 AS ver FROM bars"))
def cli_update(spark, sf):
    root = new_folder(spark, "bars")
    _command(spark, "update", _file(spark, event_bars(spark, sf), "ev_1h.parquet"), "--store", root, "--now-ms", LATE)
    return store.stored(spark, root).select("symbol", "tf", "ts", "o", "c", "ver")


@query(sql(f"SELECT symbol, ts, {_r('c')}, is_gap, dq_flags, dq_notes FROM clean"))
def cli_validate(spark, sf):
    src = _file(spark, dirty(event_bars(spark, sf)), "ev_1h.parquet")
    _command(spark, "validate", src, "--now-ms", NOW, "--out-dir", f"{src}.out", "--write-inplace")
    return files.load(spark, src).select("symbol", "ts", "c", "is_gap", "dq_flags", "dq_notes")


_Z60 = "(PARTITION BY symbol ORDER BY ts ROWS 59 PRECEDING)"


@query(sql(f"SELECT symbol, ts, CASE WHEN rn >= 60 THEN round((c - avg(c) OVER {_Z60}) / nullif(stddev_samp(c) OVER {_Z60}, 0), 6) END AS f_close_z_60, 'b7' AS f_build_version FROM x"))
def cli_features(spark, sf):
    src = _file(spark, hourly(spark, sf), "ev_1h.parquet")
    _command(spark, "features", src, f"{src}.out", "--build-version", "b7")
    return files.load(spark, f"{src}.out").select("symbol", "ts", "f_close_z_60", "f_build_version")


@query(sql("SELECT symbol, ts, CASE WHEN locked > 0 THEN 'trend' ELSE 'flat' END AS regime, votes_trend::BIGINT AS votes_trend FROM a14"))
def cli_regime(spark, sf):
    src = _file(spark, FT.compute_features(hourly(spark, sf), "1h", columns=R.needed_features()), "f_1h.parquet")
    _command(spark, "regime", "--features", src, "--tf", "1h", "--out", f"{src}.csv")
    return files.load(spark, f"{src}.csv").select("symbol", F.col("timestamp_ms").cast("long").alias("ts"), "regime", F.col("votes_trend").cast("long").alias("votes_trend"))


@query(sql(f"SELECT symbol, max(ts) AS max_ts, {LATE} - max(ts) AS lag_ms, 2 AS code FROM bars GROUP BY symbol"))
def cli_check_latency(spark, sf):
    code, printed = _command(spark, "check-latency", _file(spark, event_bars(spark, sf), "ev_1h.parquet"), "--now-ms", LATE)
    return _rows(spark, "symbol string, max_ts long, lag_ms long, code int", [(r["symbol"], r["max_ts"], r["lag_ms"], code) for r in printed[-1]])


@query("SELECT threshold::DOUBLE AS threshold, n_over, code FROM (VALUES (0.1, 2, 2), (0.3, 1, 2), (0.9, 0, 0)) AS r(threshold, n_over, code)")
def cli_missing_threshold(spark, sf):
    """A report of fixed rates against three thresholds."""
    src = _file(spark, _rows(spark, "symbol string, missing_rate double", [("A", 0.00001), ("B", 0.5), ("C", 0.25), ("D", None)]), "rates.csv")
    out = []
    for at in (0.1, 0.3, 0.9):
        code, printed = _command(spark, "missing-threshold", src, "--threshold", at)
        out.append((at, len(printed[-1]), code))
    return _rows(spark, "threshold double, n_over int, code int", out)
