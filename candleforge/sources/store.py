"""The bar store: Parquet by symbol and tf, written so that the last write wins and repeats do no harm.

root/symbol=S/tf=T/month=YYYYMM/*.parquet hold the bars: partition pruning finds a series and the months of a
range, statistics of the sorted ts find the rest. root/_meta/symbol=S/tf=T holds a row a month of the series,
root/_tail a small JSON file a series.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.functions.timegrid import DAY, MINUTE, day_bounds, parse_tf
from candleforge.operators.align import align_gaps, normalize_bars
from candleforge.operators.resample import resample
from candleforge.schema import KEY, STORED, coerce, empty, last_wins, with_key
from candleforge.sources.fs import children, delete, exists, read_json, write_json

COLUMNS = ["ts", "o", "h", "l", "c", "v", "t", "ver", "is_gap"]
READ = ["ts", "o", "h", "l", "c", "v", "t", "is_gap"]


@dataclass(frozen=True)
class ReadStats:
    rows: int
    min_ts: int | None
    max_ts: int | None


def month_of(ts: str = "ts") -> Column:
    """The UTC month as YYYYMM, whatever the session's time zone."""
    day = F.date_from_unix_date(((F.col(ts) - F.pmod(ts, F.lit(DAY).cast("long"))) / DAY).cast("int"))
    return F.year(day) * 100 + F.month(day)


def _month(ms: int) -> int | None:
    """month_of a constant; None where calendars end."""
    try:
        at = datetime.fromtimestamp(ms // 1000, UTC)
    except (OverflowError, OSError, ValueError):
        return None
    return at.year * 100 + at.month


def _months(spark: SparkSession, root: str) -> DataFrame:
    """All bars with their month."""
    if not exists(spark, root):
        return empty(spark, f"{STORED}, month int")
    files = spark.read.schema(f"{STORED}, month int").option("basePath", root).parquet(root)
    return files.select(*KEY, "month", *COLUMNS)


def _in_months(df: DataFrame, low: int | None, high: int | None) -> DataFrame:
    """Only the months that may hold a ts from low to high."""
    if low is not None and (month := _month(low)) is not None:
        df = df.where(F.col("month") >= month)
    if high is not None and (month := _month(high)) is not None:
        df = df.where(F.col("month") <= month)
    return df.drop("month")


def stored(spark: SparkSession, root: str) -> DataFrame:
    """All series."""
    return _months(spark, root).drop("month")


def series(spark: SparkSession, root: str, symbol: str, tf: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """One series; with low or high only the months that may hold such ts are read, whole."""
    own = _months(spark, root).where((F.col("symbol") == symbol) & (F.col("tf") == tf))
    return _in_months(own, low, high)


def _shaped(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Columns that are asked for and missing are NULL (is_gap: false)."""
    df = df.withColumn("is_gap", F.coalesce("is_gap", F.lit(False)))
    have = {c: F.col(c) for c in df.columns}
    return df.select(*[have.get(c, F.lit(None).cast("double")).alias(c) for c in columns or READ])


def read(spark: SparkSession, root: str, symbol: str, tf: str, columns: list[str] | None = None) -> DataFrame:
    """A series in canonical order; columns that are asked for and missing are NULL (is_gap: false)."""
    return _shaped(series(spark, root, symbol, tf), columns)


def half_open(df: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    return df.where((F.col("ts") >= start_ms) & (F.col("ts") < end_ms))


def inclusive(df: DataFrame, ts_from: int | None = None, ts_to: int | None = None) -> DataFrame:
    if ts_from is not None:
        df = df.where(F.col("ts") >= ts_from)
    return df if ts_to is None else df.where(F.col("ts") <= ts_to)


def read_range(spark: SparkSession, root: str, symbol: str, tf: str, start_ms: int, end_ms: int, columns: list[str] | None = None) -> DataFrame:
    """ts in [start, end)."""
    return _shaped(half_open(series(spark, root, symbol, tf, start_ms, end_ms), start_ms, end_ms), columns)


def read_between(spark: SparkSession, root: str, symbol: str, tf: str, ts_from: int | None = None, ts_to: int | None = None) -> DataFrame:
    """ts in [from, to], both inclusive and optional."""
    return _shaped(inclusive(series(spark, root, symbol, tf, ts_from, ts_to), ts_from, ts_to), None)


def read_stats(df: DataFrame) -> ReadStats:
    return ReadStats(*df.agg(F.count("*"), F.min("ts"), F.max("ts")).first())


def _day_ms(day_iso: str) -> int:
    return int(datetime.fromisoformat(day_iso).replace(tzinfo=UTC).timestamp() * 1000)


def read_day(spark: SparkSession, root: str, symbol: str, tf: str, day_iso: str, align: bool = False) -> DataFrame:
    low, high = day_bounds(_day_ms(day_iso))
    df = read_range(spark, root, symbol, tf, low, high)
    return align_gaps(with_key(df, symbol, tf), parse_tf(tf)).select(*READ) if align else df


def days_of(bars: DataFrame, start_day: str, end_day: str) -> DataFrame:
    """bars with day_ms; days of the range without bars have one row of NULLs."""
    days = bars.sparkSession.range(_day_ms(start_day), _day_ms(end_day) + 1, DAY).withColumnRenamed("id", "day_ms")
    return days.join(bars.withColumn("day_ms", F.col("ts") - F.pmod("ts", F.lit(DAY).cast("long"))), "day_ms", "left")


def by_day(spark: SparkSession, root: str, symbol: str, tf: str, start_day: str, end_day: str) -> DataFrame:
    """All days of the range, both ends included, with their bars; a day without bars is one row of NULLs."""
    return days_of(read_range(spark, root, symbol, tf, _day_ms(start_day), _day_ms(end_day) + DAY), start_day, end_day)


def latest_ts(spark: SparkSession, root: str, symbol: str, tf: str) -> int | None:
    return series(spark, root, symbol, tf).agg(F.max("ts")).first()[0]


def _named(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of a partition column, by the folders' names."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return sorted(names.unescapePathName(x.removeprefix(f"{key}=")) for x in children(spark, path) if x.startswith(f"{key}="))


def _path(spark: SparkSession, root: str, symbol: str, tf: str | None = None) -> str:
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    path = f"{root}/symbol={names.escapePathName(symbol)}"
    return path if tf is None else f"{path}/tf={names.escapePathName(tf)}"


def list_symbols(spark: SparkSession, root: str) -> list[str]:
    return _named(spark, root, "symbol")


def list_tfs(spark: SparkSession, root: str, symbol: str) -> list[str]:
    return _named(spark, _path(spark, root, symbol), "tf")


def digest(df: DataFrame, columns: list[str] | None = None) -> str:
    """Of the rows in any order; equal tables have equal ones."""
    cols = columns or [c for c in COLUMNS if c in df.columns and c != "ver"]
    n, x, s = df.agg(F.count("*"), F.bit_xor(F.xxhash64(*cols)), F.sum(F.pmod(F.xxhash64(F.lit(1), *cols), F.lit(1 << 40)))).first()
    return f"{n:x}-{(x or 0) & (1 << 64) - 1:016x}-{s or 0:x}"


def upsert(old: DataFrame, new: DataFrame, seq: str) -> DataFrame:
    """Stored bars after new ones: a new row replaces an old one of its key and counts its version up.

    One aggregation by key: no join. Among new rows of one key the greatest seq wins.
    """
    values = [c for c in COLUMNS if c not in ("ts", "ver")]
    a = old.select(*KEY, "ts", *values, F.coalesce("ver", F.lit(0)).alias("ver"), F.lit(0).alias("__new"), F.lit(0).cast("long").alias("__seq"))
    ver = F.coalesce(F.col("ver").cast("int"), F.lit(0)) if "ver" in new.columns else F.lit(0)
    b = new.select(*KEY, "ts", *values, ver.alias("ver"), F.lit(1).alias("__new"), F.col(seq).cast("long").alias("__seq"))
    rows = a.unionByName(b).groupBy(*KEY, "ts").agg(
        F.max_by(F.struct(*values, "ver"), F.struct("__new", "__seq")).alias("row"), F.max(F.when(F.col("__new") == 0, F.col("ver"))).alias("old_ver"), F.max("__new").alias("has_new")
    )
    ver = F.when((F.col("has_new") == 1) & F.col("old_ver").isNotNull(), F.col("old_ver") + 1).otherwise(F.col("row.ver"))
    return rows.select(*KEY, "ts", *[F.col(f"row.{c}").alias(c) for c in ("o", "h", "l", "c", "v", "t")], ver.cast("int").alias("ver"), F.col("row.is_gap").alias("is_gap"))


def closed_only(df: DataFrame, now_ms: int) -> DataFrame:
    """Without bars after the last closed minute."""
    return df.where(F.col("ts") <= now_ms - now_ms % MINUTE - MINUTE)


def _named_key(df: DataFrame) -> DataFrame:
    """No partition can hold a NULL or empty name: such ones are `?`."""
    return df.withColumns({k: F.when(F.length(k) > 0, F.col(k)).otherwise("?") for k in KEY})


def write_idempotent(spark: SparkSession, root: str, new: DataFrame, seq: str, now_ms: int, source: str = "", compression: str = "zstd", level: int = 7) -> DataFrame:
    """Upsert bars (any number of series) into the store; returns a row per series with its new meta.

    Only months with new rows are read and written. New rows are staged once, as they are used three times; then the
    merged months are, whole, and only when all of them are there do they take the place of the old ones. A write that
    died in between is finished by the next one, so no row is lost. One writer at a time. Without new rows nothing is
    written. A series' meta is put together from its months', so unchanged ones aren't read. Only tails are a driver's
    loop, a small file for each series of the write.
    """
    _recover(spark, root)
    new = _named_key(closed_only(with_key(new), now_ms))
    if "is_gap" not in new.columns:
        new = new.withColumn("is_gap", F.lit(False))
    new = new.select(*KEY, *[c for c in COLUMNS if c in new.columns], F.col(seq).cast("long").alias("__seq_in"))
    staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    new.write.parquet(f"{staging}/new")
    new = spark.read.schema(new.schema).parquet(f"{staging}/new")
    touched = new.select(*KEY, month_of().alias("month")).distinct()
    n = touched.count()
    if not n:
        delete(spark, staging)
        return series_meta(empty(spark, META))
    touched = F.broadcast(touched) if n <= 100_000 else touched
    merged = upsert(_months(spark, root).join(touched, [*KEY, "month"], "left_semi").drop("month"), new, "__seq_in")
    merged.withColumn("month", month_of()).write.parquet(f"{staging}/merged")
    options = {"compression": compression} | ({"parquet.compression.codec.zstd.level": str(level)} if compression == "zstd" else {})
    ready = {"n": n, "source": source, "options": options}
    write_json(spark, f"{staging}/ready.json", ready)
    meta = _put(spark, root, staging, ready)
    delete(spark, staging)
    return meta


def _put(spark: SparkSession, root: str, staging: str, ready: dict) -> DataFrame:
    """Put staged months in place, then their meta and tails. It can be repeated."""
    merged = spark.read.schema(f"{STORED}, month int").parquet(f"{staging}/merged")
    _replace(merged, root, [*KEY, "month"], "ts", ready["options"])
    near = F.broadcast if ready["n"] <= 100_000 else lambda df: df
    touched = near(merged.select(*KEY, "month").distinct())
    names = near(merged.select(*KEY).distinct())
    marks = {"source": F.lit(ready["source"]), "build_signature": F.lit(build_signature())}
    kept = _metas(spark, root).join(names, KEY, "left_semi").join(touched, [*KEY, "month"], "left_anti").withColumns(marks)
    _replace(kept.unionByName(months_meta(merged, ready["source"])), f"{root}/_meta", KEY, "month", {})
    found = series_meta(_metas(spark, root).join(names, KEY, "left_semi"))
    meta = spark.createDataFrame(found.collect(), found.schema)  # a row per series of this write
    for r in meta.collect():
        tail_update(spark, root, r.symbol, r.tf, r.max_ts)
    return meta


def _recover(spark: SparkSession, root: str) -> None:
    """Finish writes that died after their months were staged; drop what others have left."""
    base = f"{root.rstrip('/')}/_staging"
    for name in children(spark, base):
        if ready := read_json(spark, f"{base}/{name}/ready.json"):
            _put(spark, root, f"{base}/{name}", ready)
        delete(spark, f"{base}/{name}")


def _replace(rows: DataFrame, path: str, by: list[str], order: str, options: dict[str, str]) -> None:
    """Write the partitions that rows has; the others stay."""
    rows = rows.repartition(*by).sortWithinPartitions(*by, order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*by).parquet(path)


META = "symbol string, tf string, month int, source string, rows long, min_ts long, max_ts long, hash long, build_signature string"


def build_signature() -> str:
    """Where this build comes from, by the environment."""
    return "|".join(os.environ.get(k, "") for k in ("BUILD_VERSION", "GIT_COMMIT")) or "local"


def months_meta(df: DataFrame, source: str) -> DataFrame:
    """A row a month of a series; hash is of its rows in any order."""
    cols = [c for c in COLUMNS if c != "ver"]
    return df.groupBy(*KEY, "month").agg(
        F.lit(source).alias("source"), F.count("*").alias("rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"),
        F.bit_xor(F.xxhash64(*cols)).alias("hash"), F.lit(build_signature()).alias("build_signature"),
    )


def series_meta(months: DataFrame) -> DataFrame:
    """A row a series, from its months'."""
    mark = F.concat_ws("-", F.hex(F.sum("rows")), F.hex(F.bit_xor("hash")))
    return months.groupBy(*KEY).agg(
        F.max("source").alias("source"), F.sum("rows").alias("rows"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"),
        mark.alias("data_hash"), F.max("build_signature").alias("build_signature"),
    )


def _metas(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/_meta"
    if not exists(spark, path):
        return empty(spark, META)
    return spark.read.schema(META).option("basePath", path).parquet(path).select(*empty(spark, META).columns)


def all_meta(spark: SparkSession, root: str) -> DataFrame:
    return series_meta(_metas(spark, root))


def read_meta(spark: SparkSession, root: str, symbol: str, tf: str) -> dict:
    row = series_meta(_metas(spark, root).where((F.col("symbol") == symbol) & (F.col("tf") == tf))).first()
    return row.asDict() if row else {}


def manifest(spark: SparkSession, root: str, symbol: str, tf: str) -> dict:
    path = _path(spark, root, symbol, tf)
    there = exists(spark, path)
    stats = read_stats(series(spark, root, symbol, tf).select("ts")) if there else ReadStats(0, None, None)
    meta = read_meta(spark, root, symbol, tf)
    return {"path": path, "exists": there, "rows": stats.rows, "min_ts": stats.min_ts, "max_ts": stats.max_ts, "data_hash": meta.get("data_hash"), "meta": meta}


# Tails: the last known ts of a series, and its last days.


def _tail_path(root: str, symbol: str, tf: str) -> str:
    return f"{root}/_tail/{symbol}/{tf}.json"


def tail_read(spark: SparkSession, root: str, symbol: str, tf: str) -> dict | None:
    return read_json(spark, _tail_path(root, symbol, tf))


def tail_update(spark: SparkSession, root: str, symbol: str, tf: str, latest_ts_ms: int | None, now_iso: str | None = None) -> dict:
    """latest_ts_ms only rises; the first update needs one."""
    old = tail_read(spark, root, symbol, tf)
    if latest_ts_ms is None and not old:
        raise ValueError("the first update needs latest_ts_ms")
    latest = max(x for x in (latest_ts_ms, (old or {}).get("latest_ts_ms")) if x is not None)
    info = {"symbol": symbol, "tf": tf, "latest_ts_ms": latest, "updated_at_iso": now_iso or datetime.now(UTC).isoformat()}
    write_json(spark, _tail_path(root, symbol, tf), info)
    return info


def tail_window(bars: DataFrame, days: int = 14) -> DataFrame:
    """Each series' bars from its last ts minus so many days on, that ts included."""
    last = bars.groupBy(*KEY).agg(F.max("ts").alias("__last"))
    return bars.join(last, KEY).where(F.col("ts") >= F.col("__last") - days * DAY).drop("__last")


def write_tail(spark: SparkSession, root: str, bars: DataFrame, seq: str, days: int = 14) -> DataFrame:
    """Write each series' tail below root/_tail_bars and raise the tails; returns what was written."""
    kept = tail_window(last_wins(bars.where("ts is not null"), seq), days)
    path = f"{root}/_tail_bars"
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEY).parquet(path)
    for r in kept.groupBy(*KEY).agg(F.max("ts").alias("ts")).collect():
        tail_update(spark, root, r.symbol, r.tf, r.ts)
    return spark.read.parquet(path)


def refresh_tail(spark: SparkSession, root: str, symbol: str, tf: str) -> dict | None:
    latest = latest_ts(spark, root, symbol, tf)
    return None if latest is None else tail_update(spark, root, symbol, tf, latest)


# Compositions


def sanitize(raw: DataFrame, seq: str, symbol: str) -> DataFrame:
    return normalize_bars(raw, seq, symbol)[0]


def sanitize_and_write(spark: SparkSession, root: str, raw: DataFrame, seq: str, symbol: str, now_ms: int) -> DataFrame:
    clean = sanitize(raw, seq, symbol).withColumn("__seq", F.lit(0).cast("long"))
    return write_idempotent(spark, root, clean, "__seq", now_ms, "sanitize")


def resample_and_write(spark: SparkSession, root: str, symbol: str, tf: str, now_ms: int) -> DataFrame:
    """From the stored minutes."""
    minutes = series(spark, root, symbol, "1m").drop("ver")
    out = resample(minutes, tf).withColumn("__seq", F.lit(0).cast("long"))
    return write_idempotent(spark, root, out, "__seq", now_ms, "resample")


def canonicalize(raw: DataFrame, seq: str, symbol: str = "?", tf: str = "1m") -> DataFrame:
    """Any bar table in store form; a ts that is no number becomes 0."""
    df = with_key(coerce(raw, on_null_ts="zero", extra=("is_gap", "ver", seq)), symbol, tf)
    for name, kind in (("is_gap", "boolean"), ("ver", "int")):
        df = df.withColumn(name, F.coalesce(F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind), F.lit(0).cast(kind)))
    return last_wins(df, seq).drop(seq).select(*KEY, *COLUMNS)
