"""Line dedup: levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Keys of at least
10 code points that occur in several documents keep their lines only in the document that owns the
key: the one whose batch came first and, within a batch, the smallest id.

Seen keys lie in sorted runs (128-bit hash, owner). A new batch merge-joins the runs one after the other:
keys found there belong to their old owners, the others (the anti-join) are a run of level 0. When a level
has `fanout` runs, they are merged into one sorted run of the next level, so that n batches leave
O(fanout * log n) runs and each key is rewritten O(log n) times.

A run is a table bucketed and sorted by hash, so only a batch's own keys are shuffled: earlier runs are neither
when a batch meets them nor when they are merged. Tables need a catalog; the manifest has what it takes to name
them anew in another session.

A line in over 1/HOT of a batch's documents meets them by a broadcast.

Nulls, ties and odd rows: a null or empty text is one empty line. Rows without an id own no line
and lose none. Rows that repeat an id are one document. Other columns are passed over, so their
names can't clash. An empty table gives an empty table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.llm.shared import Spilled, delete, join_hot, new_folder, parts, read_text, write_text
from candleforge.llm.text import SPACE, shards

MIN_CHARS = 10
_SLICE = 4 << 20
#: A run's columns: fresh rows are its keys; the others, found in earlier runs, serve its own batch only.
_RUN = "h1 BIGINT, h2 BIGINT, owner BIGINT, fresh BOOLEAN, several BOOLEAN, n BIGINT"


def _key(line: bytes) -> bytes | None:
    """A line's key, if it is long enough to count."""
    key = line.strip(SPACE).lower()
    if len(key) < MIN_CHARS or len(key) < 4 * MIN_CHARS and len(key.decode("utf-8", "replace")) < MIN_CHARS:
        return None
    return key


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in shards(batches, "text", _SLICE):
        ids, digests = [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            own = {xxhash.xxh3_128_digest(k) for line in (text or b"").split(b"\n") if (k := _key(line)) is not None}
            digests.extend(own)
            ids += [i] * len(own)
        h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(ids, pa.int64())], ["h1", "h2", "doc_id"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in shards(batches, "text", _SLICE):
        n_lines, n_dropped, kept = [], [], []
        drops = batch.column(2)
        for text, drop in zip(batch.column(1).cast(pa.binary()).to_pylist(), drops, strict=True):
            lines = (text or b"").split(b"\n")
            n_lines.append(len(lines))
            if drop.is_valid:
                h = drop.values
                gone = {a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True) for a, b in zip(h.field(0).to_pylist(), h.field(1).to_pylist(), strict=True)}
                left = [x for x in lines if (k := _key(x)) is None or xxhash.xxh3_128_digest(k) not in gone]
                n_dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            else:
                n_dropped.append(0)
                kept.append(text or b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["key", "n_lines", "n_dropped", "text"],
        )


class LineRuns:
    """The runs in one folder. A manifest names those that count, so a batch that failed leaves no trace.

    The number of buckets is that of shuffle partitions when the folder is new.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.folder = folder or new_folder(spark, "line-runs")
        manifest = json.loads(read_text(spark, f"{self.folder}/manifest.json") or "{}")
        self.levels: list[list[str]] = manifest.get("levels", [])
        self.buckets: int = manifest.get("buckets", parts(spark))

    def _commit(self) -> None:
        write_text(self.spark, f"{self.folder}/manifest.json", json.dumps({"buckets": self.buckets, "levels": self.levels}))

    def _table(self, name: str) -> DataFrame:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_RUN}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
        )
        return self.spark.table(name)

    def _run(self, name: str) -> DataFrame:
        return self._table(name).where("fresh").select("h1", "h2", "owner")

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        to = rows.select("h1", "h2", "owner", "fresh", "several", "n").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        to.format("parquet").option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def _push(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        """Take the runs' names out of the catalog; the files stay."""
        self._forget([n for level in self.levels for n in level])

    def add(self, docs: DataFrame) -> DataFrame:
        """Take in a batch of (doc_id, text); return (doc_id, drops: its documents' lost lines' hashes), written."""
        keys = Spilled(docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(_keys, "h1 long, h2 long, doc_id long"), "line-keys")
        met = keys.df.groupBy("h1", "h2").agg(F.min("doc_id").alias("mine"), (F.min("doc_id") < F.max("doc_id")).alias("several"), F.count("*").alias("n"))
        met = met.withColumn("owner", F.lit(None).cast("long"))
        for name in [n for level in self.levels for n in level]:
            met = met.join(self._run(name).withColumnRenamed("owner", "theirs").hint("merge"), ["h1", "h2"], "left")
            met = met.withColumn("owner", F.coalesce("owner", "theirs")).drop("theirs")
        run = self._write(met.withColumn("fresh", F.col("owner").isNull()).withColumn("owner", F.coalesce("owner", "mine")))
        owners = self._table(run).where("several or not fresh").select("h1", "h2", "owner", "n")
        lost = join_hot(keys.df, owners, ["h1", "h2"], "n").where("owner <> doc_id")
        drops = Spilled(lost.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("drops")), "line-drops")
        self._push(run, 0)
        self._compact()
        keys.drop()
        return drops.df

    def _merged(self, names: list[str]) -> DataFrame:
        """The runs' keys; no key is fresh in two. A filter below the union would cost its partitioning."""
        union = reduce(DataFrame.unionByName, [self._table(n).select("h1", "h2", "owner", "fresh") for n in names])
        return union.groupBy("h1", "h2").agg(F.min("owner").alias("owner"), F.max("fresh").alias("fresh")).where("fresh")

    def _compact(self) -> None:
        level, old = 0, []
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                merged, self.levels[level] = self.levels[level], []
                one = self._merged(merged).withColumns({"several": F.lit(False), "n": F.lit(0).cast("long")})
                self._push(self._write(one), level + 1)
                old += merged
            level += 1
        self._commit()
        self._forget(old)  # their files stay: a reader may have listed them


def dedup_lines(docs: DataFrame, batches: int = 4, fanout: int = 2, folder: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, n_lines, n_dropped and the new text for each row of docs(doc_id, text).

    The table goes in as so many batches of rising ids, equal spans of the ids' range, so that each
    key's owner is the smallest id that holds it.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*keep).alias("key"))
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    runs, drops = LineRuns(spark, folder, fanout), None
    if low is not None:
        span = (high - low) // batches + 1
        for a in range(low, high + 1, span):
            one = runs.add(docs.where(F.col("doc_id").between(a, a + span - 1)))
            drops = one if drops is None else drops.unionByName(one)
        runs.close()
        if folder is None:
            delete(spark, runs.folder)
    if drops is None:
        drops = spark.createDataFrame([], "doc_id long, drops array<struct<h1: long, h2: long>>")
    joined = docs.join(drops, "doc_id", "left").select("key", "text", "drops")
    out = joined.select("key", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), "text")
    return joined.mapInArrow(_strip, out.schema).select("key.*", "n_lines", "n_dropped", "text")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(o.owner <> k.doc_id, false) AS gone
  FROM keyed k LEFT JOIN owners o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
