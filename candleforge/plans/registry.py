"""Where named queries and the SQL that checks them are listed.

Floats are rounded to six places on both sides, so that the order of sums doesn't show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NOW = 1_706_572_800_000  # 2024-01-30T00:00Z
START, END = 1_704_412_800_000, 1_705_017_600_000  # 2024-01-05 and 2024-01-12
OHLCV = ("o", "h", "l", "c", "v", "t")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[(F.round(c, 6) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def query(oracle: str | None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: _rounded(f(spark, sf_dir))
        if oracle:
            SQL[f.__name__] = oracle
        return f

    return add


def rounded_sql(*columns: str, alias: str = "") -> str:
    return ", ".join(f"round({alias}{c}, 6) AS {c}" for c in columns)
