"""Command line: `python -m candleforge.cli COMMAND ...`. Exit 0: done; 1: nothing to do or wrong use; 2: a gate failed."""

from __future__ import annotations

import argparse
import json
import re
import sys
import time
from dataclasses import fields, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from candleforge.functions.timegrid import parse_tf
from candleforge.operators import regime as R
from candleforge.operators import report
from candleforge.operators.align import align_gaps, missing_report, range_gaps
from candleforge.operators.features import FeatureConfig, compute_features, validate_features
from candleforge.operators.quality import QualityConfig, validate
from candleforge.operators.resample import resample
from candleforge.schema import coerce, with_key
from candleforge.sources import klines, store
from candleforge.sources.files import CODECS, dump, load


def session() -> SparkSession:
    return SparkSession.builder.appName("candleforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def config(cls, text: str | None):
    """cls with the values of a JSON or YAML file; unknown keys are passed over, a number is a tuple of one."""
    base = cls()
    if not text:
        return base
    raw = open(text).read()
    try:
        values = json.loads(raw)
    except ValueError:
        import yaml

        values = yaml.safe_load(raw)
    known = {f.name for f in fields(cls)}
    fit = lambda k, v: (tuple(v) if isinstance(v, list) else (v,)) if isinstance(getattr(base, k), tuple) else v
    return replace(base, **{k: fit(k, v) for k, v in (values or {}).items() if k in known})


def tf_of(path: str, default: str = "1m") -> str:
    """The timeframe that a file's name ends with."""
    m = re.search(r"(\d+(?:m|min|h|s))(?=\.|$)", path.rstrip("/").rsplit("/", 1)[-1])
    return m[1] if m else default


def _bars(spark, path: str, symbol: str, tf: str):
    df = with_key(coerce(load(spark, path), extra=("is_gap",)), symbol, tf)
    return df if "is_gap" in df.columns else df.withColumn("is_gap", F.lit(False))


def do_resample(a, spark) -> int:
    if parse_tf(tf_of(a.src)) != 60_000:
        print("resample starts from 1m bars", file=sys.stderr)
        return 1
    dump(resample(_bars(spark, a.src, a.symbol, "1m"), a.dst_tf), a.out, a.compression)
    return 0


def do_missing(a, spark) -> int:
    rows = missing_report(align_gaps(_bars(spark, a.src, a.symbol, "1m")), a.since_ms, a.until_ms).collect()
    print(json.dumps([r.asDict() for r in rows]))
    return 2 if any(r.gap_pct > a.fail_gap_pct for r in rows) else 0


def do_report_missing(a, spark) -> int:
    """Minutes that the store lacks in [since, until), its edges included; gap_pct is percent."""
    bars = store.series(spark, a.store, a.symbol, "1m").drop("ver")
    row = range_gaps(bars, a.since_ms, a.until_ms).first()
    print(json.dumps({"symbol": a.symbol, **row.asDict()}))
    return 2 if a.fail_gap_pct is not None and row.gap_pct > a.fail_gap_pct else 0


def do_threshold(a, spark) -> int:
    """The rows of a CSV report whose missing_rate is over the threshold."""
    rows = load(spark, a.src)
    bad = rows.where(F.col("missing_rate").try_cast("double") > a.threshold).collect()
    print(json.dumps([r.asDict() for r in bad], default=str))
    return 2 if bad else 0


def do_backfill(a, spark) -> int:
    klines.register(spark)
    options = {"symbol": a.symbol, "start_ms": a.since_ms, "end_ms": a.until_ms, "page_size": a.page_size, "base_url": a.base_url}
    new = spark.read.format("klines").options(**{k: str(v) for k, v in options.items()}).load().withColumn("seq", F.lit(0))
    meta = store.write_idempotent(spark, a.store, new, "seq", a.now_ms or int(time.time() * 1000), "klines").collect()
    print(json.dumps([r.asDict() for r in meta]))
    return 0 if meta else 1


def do_update(a, spark) -> int:
    new = _bars(spark, a.src, a.symbol, tf_of(a.src)).withColumn("seq", F.lit(0))
    meta = store.write_idempotent(spark, a.store, new, "seq", a.now_ms or int(time.time() * 1000), a.src).collect()
    print(json.dumps([r.asDict() for r in meta]))
    return 0


def do_validate(a, spark) -> int:
    tf = a.tf or tf_of(a.src)
    minutes = _bars(spark, a.ref_1m, a.symbol, "1m") if a.ref_1m else None
    clean, log = validate(_bars(spark, a.src, a.symbol, tf), tf, a.now_ms or int(time.time() * 1000), minutes, cfg=config(QualityConfig, a.cfg))
    out = a.out_dir.rstrip("/")
    dump(clean, f"{out}/clean.parquet")
    dump(log, f"{out}/clean.issues.parquet")
    if a.write_inplace:  # from what is written, since a path that is read can't be overwritten
        dump(spark.read.parquet(f"{out}/clean.parquet"), a.src)
    if a.quality_json:
        with open(a.quality_json, "w") as f:
            f.write(report.as_json(spark.read.parquet(f"{out}/clean.parquet"), spark.read.parquet(f"{out}/clean.issues.parquet")))
    return 0


def do_features(a, spark) -> int:
    tf = a.tf or tf_of(a.src)
    cfg = config(FeatureConfig, a.config)
    cfg = replace(cfg, build_version=a.build_version) if a.build_version else cfg
    dump(validate_features(compute_features(with_key(load(spark, a.src), a.symbol, tf), tf, cfg)), a.out)
    return 0


def do_regime(a, spark) -> int:
    dump(R.infer_regime(load(spark, a.features), a.tf, config(R.RegimeConfig, a.config), a.variant), a.out)
    return 0


def do_report(a, spark) -> int:
    clean, log = spark.read.parquet(a.src), spark.read.parquet(a.issues)
    for path, text in ((a.out_json, report.as_json), (a.out_md, report.as_markdown)):
        if path:
            with open(path, "w") as f:
                f.write(text(clean, log))
    return 0


def do_latency(a, spark) -> int:
    late = report.late_series(load(spark, a.src), a.now_ms or int(time.time() * 1000), a.grace).collect()
    print(json.dumps([r.asDict() for r in late]))
    return 2 if late else 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="candleforge")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *args: str, **options):
        c = sub.add_parser(name)
        for x in args:
            c.add_argument(x)
        for k, (kind, default) in options.items():
            c.add_argument("--" + k.replace("_", "-"), type=kind, default=default)
        c.set_defaults(run=run)
        return c

    now, symbol = (int, None), (str, "?")
    command("resample", do_resample, "src", dst_tf=(str, "5m"), out=(str, "out.parquet"), compression=(str, "zstd"), symbol=symbol)
    command("missing-report", do_missing, "src", since_ms=(int, None), until_ms=(int, None), fail_gap_pct=(float, 1.0), symbol=symbol)
    command("report-missing", do_report_missing, symbol=symbol, store=(str, "store"), since_ms=(int, None), until_ms=(int, None), fail_gap_pct=(float, None))
    command("missing-threshold", do_threshold, "src", threshold=(float, 1e-4))
    command("backfill", do_backfill, "symbol", store=(str, "store"), since_ms=(int, 0), until_ms=(int, 0), page_size=(int, 1000), base_url=(str, ""), now_ms=now)
    command("update", do_update, "src", symbol=symbol, store=(str, "store"), now_ms=now)
    check = command("validate", do_validate, "src", tf=(str, None), symbol=symbol, ref_1m=(str, None), out_dir=(str, "."), quality_json=(str, None), cfg=(str, None), now_ms=now)
    check.add_argument("--write-inplace", action="store_true")
    command("features", do_features, "src", "out", symbol=symbol, tf=(str, None), config=(str, None), build_version=(str, None))
    command("regime", do_regime, features=(str, ""), out=(str, "regime.parquet"), tf=(str, "1h"), config=(str, None), variant=(str, "A"))
    command("quality-report", do_report, "src", issues=(str, ""), out_json=(str, None), out_md=(str, None))
    command("check-latency", do_latency, "src", grace=(int, 90), now_ms=now)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if getattr(a, "compression", "zstd") not in CODECS:
        return 1
    return a.run(a, session())


if __name__ == "__main__":
    sys.exit(main())
