"""Language ID: a blended-spectrum string kernel with Nyström landmarks and kernel ridge regression.

A text's features are the presences of its byte n-grams (1 to 3 bytes, A-Z lower-cased), hashed to
BUCKETS. The kernel of two texts is the number of features they share over the geometric mean of
their numbers of features. Landmark texts Z give Nyström features K(x, Z) K(Z, Z)^-1/2, on which one
ridge regression a language (+1 its own, -1 the rest) is solved. At scoring, landmarks and
coefficients are one matrix (buckets x languages), so a batch of texts is one matrix product. The
score is the best language's margin, mapped from [-1, 1] to [0, 1].

Learning takes at most `n_train` different labelled rows: those with the smallest hashes of their ids
(of rows with one id: of their texts and labels). A number of different ids, estimated by a sketch, says
under which hash about twice as many lie; only those rows are looked at further, so what is sorted is
bounded. Executors turn the rows into bit maps of fixed size, of which the driver gets at most `n_train`.

Nulls, ties and odd rows: a null text, or one without a letter, is `und` with score 0, as is all if
no labelled row is there to learn from. Languages with equal margins: the first by name. Each row is
predicted by itself; ids may repeat or be null. Rows without an id or language teach nothing. Other
columns are passed over. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.llm.text import buffers, shards

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
N_TRAIN, N_LANDMARKS, RIDGE = 4000, 256, 1e-2
_SLICE, _ROWS = 2 << 20, 128

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, np.uint8)
_LETTER[65:91] = _LETTER[97:123] = 1


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x buckets: 1 where the text has an n-gram of the bucket."""
    n = len(offsets) - 1
    out = np.zeros(n * BUCKETS, np.uint8)
    low = _LOWER[data]
    row = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(offsets))
    code = np.zeros(len(data), np.uint32)
    for k in ORDERS:
        m = max(0, len(data) - k + 1)
        code = (code[:m] << np.uint32(8)) | low[k - 1 : k - 1 + m] if k > 1 else low[:m]
        bucket = ((code + np.uint32(k << 24)) * np.uint32(0x9E3779B1)) >> np.uint32(17)
        whole = row[:m] == row[k - 1 : k - 1 + m]
        out[(row[:m] + bucket)[whole]] = 1
    return out.reshape(n, BUCKETS)


def has_letter(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    counts = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int64)])
    out = counts[offsets[1:]] > counts[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)).tolist():
        out[i] = any(c.isalpha() for c in column[i].as_py() or "")
    return out


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages

    def scores(self, x: np.ndarray) -> np.ndarray:
        f = x.astype(np.float32)
        return (f @ self.weights) / np.sqrt(np.maximum(f.sum(axis=1), 1))[:, None]


def _unit(bits: np.ndarray) -> np.ndarray:
    """Rows of presences as floats of length 1; bits: the presences, eight to a byte."""
    f = np.unpackbits(bits, axis=1).astype(np.float32)
    return f / np.sqrt(np.maximum(f.sum(axis=1, keepdims=True), 1))


def fit(bits: np.ndarray, lang: list[str], n_landmarks: int = N_LANDMARKS, ridge: float = RIDGE) -> Model:
    """bits: packed presences of the labelled texts, in a fixed order. Landmarks take turns among the languages."""
    languages = sorted(set(lang))
    seen: dict[str, int] = {}
    nth = []
    for y in lang:
        nth.append(seen.get(y, 0))
        seen[y] = nth[-1] + 1
    chosen = sorted(range(len(lang)), key=lambda i: (nth[i], i))[:n_landmarks]
    z = _unit(bits[chosen])
    value, vector = np.linalg.eigh((z @ z.T).astype(np.float64))
    root = vector / np.sqrt(np.maximum(value, 1e-6 * value[-1]))
    phi = np.concatenate([(_unit(bits[a : a + _ROWS]) @ z.T).astype(np.float64) @ root for a in range(0, len(bits), _ROWS)])
    y = np.where(np.array(lang)[:, None] == np.array(languages)[None], 1.0, -1.0)
    # a language's rows weigh as much as all the rest's
    solved = []
    for k in range(len(languages)):
        own = y[:, k] > 0
        w = np.where(own, 0.5 / own.sum(), 0.5 / max(1, (~own).sum()))[:, None]
        solved.append(np.linalg.solve(phi.T @ (w * phi) + ridge * np.eye(phi.shape[1]) / len(lang), phi.T @ (w[:, 0] * y[:, k])))
    return Model(languages, (z.T.astype(np.float64) @ (root @ np.stack(solved, axis=1))).astype(np.float32))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        column = batch.column(0)
        data, offsets = buffers(column)
        ok = has_letter(column, data, offsets)
        bits = [row.tobytes() for row in np.packbits(presence(data, offsets), axis=1)]
        yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary()), *batch.columns[1:], pa.array(ok)], ["bits", "lang", "place", "own", "ok"])


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in shards(batches, "text", _SLICE):
        for a in range(0, batch.num_rows, _ROWS):
            yield batch.slice(a, _ROWS)


def learn(docs: DataFrame, n_train: int = N_TRAIN) -> Model | None:
    """From docs(doc_id, text, lang) without the held-out fifth."""
    key = F.col("doc_id").cast("string")
    rows = docs.where("lang is not null").where(~held_out()).withColumn("place", F.xxhash64(key))
    n_ids = rows.agg(F.approx_count_distinct("place")).first()[0]
    share = min(1.0, 2 * n_train / max(1, n_ids))
    few = rows.where(F.col("place") <= int((2 * share - 1) * (2**63 - 1))) if share < 1 else rows
    few = few.where("text is not null").withColumn("own", F.xxhash64("text", "lang"))
    first = few.select("place", "own").distinct().orderBy("place", "own").limit(n_train)
    last = first.agg(F.max(F.struct("place", "own")).alias("last")).first()[0]  # an aggregate: the limit is worked out by executors
    if last is None:
        return None
    sample = few.where((F.col("place") < last.place) | ((F.col("place") == last.place) & (F.col("own") <= last.own))).dropDuplicates(["place", "own"])
    got = sample.select("text", "lang", "place", "own").mapInArrow(_bits, "bits binary, lang string, place long, own long, ok boolean").where("ok").collect()
    got = sorted(got, key=lambda r: (r.place, r.own))
    if not got:
        return None
    return fit(np.frombuffer(b"".join(r.bits for r in got), np.uint8).reshape(len(got), -1), [r.lang for r in got])


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _predict(model: Model | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        column = batch.column(1)
        lang, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
        if model is not None:
            data, offsets = buffers(column)
            ok = has_letter(column, data, offsets)
            margins = model.scores(presence(data, offsets))
            best = margins.argmax(axis=1)
            lang[ok] = np.array(model.languages, object)[best[ok]]
            score[ok] = np.clip((margins[np.arange(len(best)), best][ok].astype(float) + 1) / 2, 0, 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), column], ["key", "lang_pred", "score", "text"])


def identify(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), model: Model | None = None) -> DataFrame:
    """docs' columns `keep` and its text, with lang_pred and score; learns from docs unless a model is given."""
    model = model or learn(docs.select("doc_id", "text", "lang"))
    rows = docs.select(F.struct(*keep).alias("key"), "text")
    out = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).select("key", "lang_pred", "score", "text")
    return rows.mapInArrow(lambda b: _predict(model, b), out.schema).select("key.*", "lang_pred", "score", "text")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
