"""Tables and folders that the driver and all executors can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.sources.fs import delete, new_folder, shared_root  # noqa: F401 - for the operators

HOT = 1000


class Spilled:
    """A table written to the shared folder, which cuts the lineage: a lost executor costs a read, not a rerun."""

    def __init__(self, df: DataFrame, label: str):
        self.spark, self.path = df.sparkSession, new_folder(df.sparkSession, label)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete(self.spark, self.path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_hot(rows: DataFrame, keyed: DataFrame, on: list[str], n: str) -> DataFrame:
    """The inner join of rows with keyed, which has one row a key and in n how many of rows have it.

    Keys with over 1/HOT of all rows, of which there are fewer than HOT, are broadcast, so none of their
    rows are shuffled; the others are joined as Spark chooses.
    """
    total = keyed.agg(F.sum(n)).first()[0] or 0
    hot, cold = keyed.where(F.col(n) * HOT > total), keyed.where(F.col(n) * HOT <= total)
    left = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return rows.join(F.broadcast(hot), on).unionByName(left)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written under a temporary name and renamed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    to, tmp = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = to.getFileSystem(conf)
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(to, False)
    if not fs.rename(tmp, to):
        raise OSError(f"can't rename to {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def grouped(batches: Iterator[pa.RecordBatch], n_key: int) -> Iterator[list[tuple]]:
    """Rows that follow each other with the same first columns; groups of one row are left out."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:n_key] != key:
                if len(held) > 1:
                    yield held
                key, held = row[:n_key], []
            held.append(row)
    if len(held) > 1:
        yield held


def local_roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each row the smallest id that the pairs of rows (i, j) reach."""
    root = ids.copy()
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        if (new == root).all():
            return root
        root = new
