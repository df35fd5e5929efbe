"""Embedding near-dedup: random-hyperplane sign hashing, exact cosines, connected components.

Two vectors of one label link when their cosine, in double precision, is at least `threshold`. Components
are float or double, as in the input: other types are taken as doubles. Vectors are divided by their greatest
component first, so no square of a very large or small one gets lost. Equal
vectors of a label are one class and travel as one row. Each class gets a signature of `bits` signs
in each of several tables; classes that share a signature in some table are compared. At the
threshold, a pair shares one with probability p**bits a table, p = 1 - acos(threshold) / pi, so the
number of tables is the least that misses at most MISS of such pairs; closer pairs are missed less.
bits grows with the logarithm of the largest label's classes, so that a bucket holds MEAN of them if they lie
evenly, and the number of tables with it: the recall is the same at every size.

Pairs are never rows: a task compares a bucket by one matrix product, counts a pair only in the first
table where its signatures agree, and emits each class's count with one edge towards its bucket's
local component. A bucket with over BLOCK classes is split into blocks, and pairs of blocks are dealt
to different tasks, so that the largest group meets in pieces and still no pair is left out.

Nulls, ties and odd rows: vectors that are null, empty, zero or hold a null or non-finite component,
and rows with a null label, link with nothing. Vectors of different lengths don't link. Rows that
repeat a vec_id are one node of the components; each row's links are counted by its own vector. Rows without vec_id link with nothing;
their component is null. Rows that link with nothing by rule are not shuffled to find their class; classes with
over 1/HOT of the rows are found by a broadcast. Only vec_id, embedding and label are read. Empty in, empty out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.llm.graph import components
from candleforge.llm.shared import Spilled, join_hot, local_roots, parts
from candleforge.llm.text import U, mix

THRESHOLD, MISS, BLOCK, SEED = 0.93, 1e-3, 2048, 11
#: Classes that a bucket holds on average, if vectors lie evenly: more of them need fewer tables.
MEAN = 256
_ROWS, _SLICE = 512, 256


def plan_tables(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bits, tables) for so many classes of the largest label."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, n) / MEAN))))
    p = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(MISS) / math.log(1 - p**bits))


def signatures(v: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Rows x tables: the signs of each table's hyperplanes as a number."""
    planes = np.random.default_rng([SEED, v.shape[1]]).standard_normal((v.shape[1], bits * tables))
    signs = (v @ planes >= 0).reshape(len(v), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1)[:, None]
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def _signed(bits: int, tables: int, wire: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class: its id, copies, label, vector, hash, signatures, and its bucket in each table."""
    small = np.min_scalar_type((1 << bits) - 1)
    for whole in batches:
        for batch in (whole.slice(a, _ROWS) for a in range(0, whole.num_rows, _ROWS)):
            sizes = batch.column(3).value_lengths().to_numpy()
            starts = np.cumsum(sizes) - sizes
            values = batch.column(3).flatten().to_numpy().astype(wire)
            sig = np.zeros((len(sizes), tables), np.int64)
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                sig[own] = signatures(_unit(values[starts[own][:, None] + np.arange(d)].astype(np.float64)), bits, tables)
            label = batch.column(1).to_numpy().astype(U)
            key = mix(mix(label * U(0x9E3779B97F4A7C15) + sizes.astype(U))[:, None] + (np.arange(tables).astype(U) << U(32)) + sig.astype(U))
            buckets = pa.ListArray.from_arrays(np.arange(0, len(sizes) * tables + 1, tables, dtype=np.int32), pa.array(key.ravel().view(np.int64)))
            vec = pa.array([values[a : a + d].tobytes() for a, d in zip(starts, sizes, strict=True)], pa.binary())
            raw = pa.array([x.tobytes() for x in sig.astype(small)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(1), vec, batch.column(4), raw, buckets], ["cls", "copies", "label", "vec", "sub", "sigs", "buckets"]
            )


def _groups(batches: Iterator[pa.RecordBatch], n_key: int) -> Iterator[pa.Table]:
    """Rows that follow each other with the same first columns; groups of one row are left out."""
    last, held = None, []
    for batch in batches:
        keys = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns[:n_key]], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if last is not None and (keys[a] != last).any():
                if sum(h.num_rows for h in held) > 1:
                    yield pa.Table.from_batches(held)
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
    if sum(h.num_rows for h in held) > 1:
        yield pa.Table.from_batches(held)


def _compare(threshold: float, wire: str, small: np.dtype, rows: pa.Table) -> list[np.ndarray] | None:
    """Classes' ids and hashes, links, an id of their component, of one bucket or of two blocks of one."""
    nth, first, second = (rows.column(k)[0].as_py() for k in ("nth", "a", "b"))
    ids, copies, label, own, sub = (rows.column(k).to_numpy() for k in ("cls", "copies", "label", "own", "sub"))
    v = _unit(np.frombuffer(b"".join(rows.column("vec").to_pylist()), wire).reshape(len(ids), -1).astype(np.float64))
    sigs = np.frombuffer(b"".join(rows.column("sigs").to_pylist()), small).reshape(len(ids), -1)[:, :nth]
    left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
    ends = []
    for a in range(0, len(left), _SLICE):
        i, j = np.nonzero(v[left[a : a + _SLICE]] @ v[right].T >= threshold)
        i, j = left[a : a + _SLICE][i], right[j]
        if first == second:
            i, j = i[i < j], j[i < j]
        new = (ids[i] != ids[j]) & (label[i] == label[j]) & ~(sigs[i] == sigs[j]).any(axis=1)
        ends.append((i[new], j[new]))
    i, j = (np.concatenate(e) for e in zip(*ends, strict=True)) if ends else (left, left)
    if not len(i) or not ends:
        return None
    n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    met = n > 0
    return [ids[met], sub[met], n[met].astype(np.int64), local_roots(ids, i, j)[met]]


def _buckets(threshold: float, wire: str, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    small = np.min_scalar_type((1 << bits) - 1)
    for rows in _groups(batches, 5):
        if found := _compare(threshold, wire, small, rows):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["cls", "sub", "links", "root"])


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors(vec_id, embedding, label)."""
    float_ = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind, wire = ("array<float>", "<f4") if float_ else ("array<double>", "<f8")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), F.col("label").cast("long").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    valid = rows.where(sound)
    classes = Spilled(valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("cls"), F.count("*").alias("copies")).select("cls", "label", "copies", "embedding", F.xxhash64("embedding").alias("sub")), "vector-classes")
    most = classes.df.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(most, threshold)
    signed = classes.df.mapInArrow(lambda b: _signed(bits, tables, wire, b), "cls long, copies long, label long, vec binary, sub long, sigs binary, buckets array<long>")
    sizes = signed.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    large = Spilled(sizes.where(F.col("n") > BLOCK).select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large-buckets")
    signed = signed.select("cls", "copies", "label", "vec", "sub", "sigs", F.posexplode("buckets").alias("nth", "bucket")).withColumn("dim", F.octet_length("vec"))
    n_large = large.df.count()
    if n_large:
        size = F.broadcast(large.df) if n_large <= 10_000 else large.df
        own = F.pmod(F.xxhash64("cls", "vec"), F.col("blocks")).cast("int")
        dealt = signed.join(size, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")})
    else:
        dealt = signed.withColumns({"own": F.lit(0), "a": F.lit(0), "b": F.lit(0)})
    dealt = dealt.select("bucket", "nth", "dim", "a", "b", "cls", "copies", "label", "vec", "sigs", "own", "sub")
    met = dealt.repartition(parts(rows.sparkSession), "bucket", "a", "b").sortWithinPartitions("bucket", "nth", "dim", "a", "b")
    found = Spilled(met.mapInArrow(lambda b: _buckets(threshold, wire, bits, b), "cls long, sub long, links long, root long"), "links")
    linked = found.df.groupBy("cls", "sub").agg(F.sum("links").alias("links"))
    groups = components(found.df.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    per_class = classes.df.join(linked, ["cls", "sub"], "left").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    per_class = Spilled(per_class, "vector-groups")
    # a row finds its class by the vector itself
    out = join_hot(valid, per_class.df, ["label", "embedding"], "copies")
    n_links = F.coalesce(F.col("links"), F.lit(0)) + F.col("copies") - 1
    component = F.coalesce("component", "cls")
    out = out.select("vec_id", n_links.cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP1_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND list_bool_and([isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.93),
reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
roots AS (SELECT x, min(y) AS root FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT r.x AS vec_id, coalesce(d.n, 0) AS n_links, r.root AS component_id, r.x = r.root AS kept
FROM roots r LEFT JOIN degree d ON r.x = d.x
"""
