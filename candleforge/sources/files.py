"""Tables by the suffix of their path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CODECS = ("zstd", "snappy", "gzip", "brotli", "none")


def load(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header, else Parquet. Without a schema, CSV columns are text: operators cast them."""
    if path.lower().endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader).csv(path)
    return spark.read.parquet(path)


def dump(df: DataFrame, path: str, compression: str = "zstd") -> None:
    if compression not in CODECS:
        raise ValueError(f"compression: {compression}")
    if path.lower().endswith(".csv"):
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").option("compression", compression).parquet(path)
