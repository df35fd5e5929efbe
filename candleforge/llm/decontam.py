"""Benchmark decontamination with an FM-index for each shard of the training texts.

Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. A window is 10 consecutive
words of a benchmark item; an item with fewer words is one window. Document words inside any
occurrence of a window are hit; hit words that touch are merged into removal spans.

A shard is a slice of the documents of bounded size. Its words become symbols: a number for each
word of the benchmark, one separator for all others. Runs of words shorter than the shortest window
can't hold one, so they become separators, too. On the rest: the suffix array by prefix doubling, the
Burrows-Wheeler transform in a wavelet matrix (rank in one step a bit), backward search of all
windows at once, and suffix positions sampled at each run's first word and every eighth word, to
which the occurrences walk back. No shuffle; the index lives in one task's memory, in proportion to
the shard.

The benchmark is the stated query set. It goes to the tasks in blocks of at most BLOCK_BYTES of text (or
one item), broadcast up to PASS_BYTES at a time: one pass over the documents handles that much, and the driver and
each executor hold no more. Before a further pass, what was found is written.

Nulls, ties and odd rows: a null or empty text has no words. Items without an id or words are left
out; rows that repeat an item_id add to the same item. Each document row is handled by itself, so
repeated ids and null ids do no harm. Other columns are passed over. Empty tables give empty results,
an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.llm.shared import Spilled
from candleforge.llm.text import U, buffers, shards, word_bounds, words

WINDOW = 10
SAMPLE = 8
BLOCK_BYTES, PASS_BYTES = 16 << 20, 64 << 20
_SHARD, _SLICE = 8 << 20, 1 << 20
_FILTER = (1 << 20) - 1
SPANS = "array<struct<a: int, b: int, from: int, to: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("from", pa.int32()), ("to", pa.int32())]))


class WaveletMatrix:
    """rank(c, i): how often the symbols c occur among the first i, for arrays of c and i."""

    def __init__(self, s: np.ndarray, n_bits: int):
        self.levels = []
        for bit in range(n_bits - 1, -1, -1):
            one = (s >> bit) & 1 == 1
            zeros = np.zeros(len(s) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            s = np.concatenate([s[~one], s[one]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        start, i = np.zeros(len(c), np.int64), i.astype(np.int64)
        for bit, zeros, n in self.levels:
            one = (c >> bit) & 1 == 1
            start = np.where(one, n + start - zeros[start], zeros[start])
            i = np.where(one, n + i - zeros[i], zeros[i])
        return i - start


class FMIndex:
    """Of a text of symbols: 0 ends a run and is never searched, the others are 1 to n_symbols."""

    def __init__(self, s: np.ndarray, n_symbols: int):
        m = len(s)
        # every 0 differs from the others, in order of position, so ties end with a run
        rank = s + m
        zero = np.flatnonzero(s == 0)
        rank[zero] = np.arange(len(zero))
        order = np.argsort(rank, kind="stable")
        k = 1
        while True:
            by = rank[order]
            new = np.zeros(m, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(by[1:] != by[:-1])]) if m else by
            if not m or new[order[-1]] == m - 1:
                break
            after = np.zeros(m, np.int64)
            after[:-k] = new[k:] + 1
            rank = new * (m + 1) + after
            order = np.argsort(rank, kind="stable")
            k *= 2
        self.bwt = s[order - 1]  # the last symbol, a 0, stands before the first
        self.below = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=n_symbols + 1))])
        self.wavelets = WaveletMatrix(self.bwt, max(1, int(n_symbols).bit_length()))
        run_start = np.zeros(m, bool)
        run_start[0:1] = True
        run_start[1:] = s[:-1] == 0
        at = np.arange(m)
        begun = np.maximum.accumulate(np.where(run_start, at, 0))
        self.sampled = ((at - begun) % SAMPLE == 0)[order]
        self.samples = order[self.sampled]
        self.nth = np.cumsum(self.sampled) - 1

    def step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.below[c] + self.wavelets.rank(c, i)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the patterns (one length) that occur, with their ranges of suffixes."""
        which = np.flatnonzero((self.below[patterns + 1] > self.below[patterns]).all(axis=1))
        lo, hi = np.zeros(len(which), np.int64), np.full(len(which), len(self.bwt), np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[which, j]
            lo, hi = self.step(c, lo), self.step(c, hi)
            live = lo < hi
            which, lo, hi = which[live], lo[live], hi[live]
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            rows[open_] = self.step(self.bwt[rows[open_]], rows[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.samples[self.nth[rows]] + steps


class Windows:
    """The windows of a block of benchmark items, as numbers of the block's words."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = pa.array([t for _, t in items], pa.string())
        h, _, at = words(*buffers(texts), "alnum")
        self.vocabulary, symbols = np.unique(h, return_inverse=True)
        symbols = symbols + 1
        self.known = np.zeros(_FILTER + 1, bool)
        self.known[(self.vocabulary & U(_FILTER)).astype(np.int64)] = True
        by_length: dict[int, dict[bytes, set[int]]] = {}
        for (item, _), a, b in zip(items, at[:-1].tolist(), at[1:].tolist(), strict=True):
            n = min(WINDOW, b - a)
            for i in range(a, b - n + 1) if n else ():
                by_length.setdefault(n, {}).setdefault(symbols[i : i + n].astype(np.int64).tobytes(), set()).add(item)
        self.groups = [(n, np.frombuffer(b"".join(found), np.int64).reshape(-1, n), [sorted(x) for x in found.values()]) for n, found in sorted(by_length.items())]
        self.shortest = min(by_length, default=0)

    def symbols(self, h: np.ndarray) -> np.ndarray:
        """For word hashes the symbols, 0 for words that aren't in the block."""
        out = np.zeros(len(h), np.int32)
        maybe = np.flatnonzero(self.known[(h & U(_FILTER)).astype(np.int64)])
        if len(maybe):
            i = np.minimum(np.searchsorted(self.vocabulary, h[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[i] == h[maybe], i + 1, 0)
        return out

    def hits(self, symbols: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """(which words are hit, pairs of text index and item) of a shard's words."""
        hit, pairs = np.zeros(len(symbols) + 1, np.int64), set()
        if not self.groups or not len(symbols):
            return hit[:-1] > 0, []
        known = np.flatnonzero(symbols)
        new = np.ones(len(known), bool)
        new[1:] = (known[1:] != known[:-1] + 1) | (doc[known[1:]] != doc[known[:-1]])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(known)))
        keep = length >= self.shortest
        if not keep.any():
            return hit[:-1] > 0, []
        run = np.repeat(np.cumsum(keep) - 1, length)[np.repeat(keep, length)]
        kept = known[np.repeat(keep, length)]
        to = np.arange(len(kept)) + run  # a 0 after each run
        text = np.zeros(len(kept) + int(run[-1]) + 1, np.int64)
        text[to] = symbols[kept]  # 64 bits from here on
        word = np.zeros(len(text), np.int64)
        word[to] = kept
        index = FMIndex(text, len(self.vocabulary))
        for n, patterns, items in self.groups:
            which, lo, hi = index.search(patterns)
            if not len(which):
                continue
            count = hi - lo
            rows = np.arange(count.sum()) + np.repeat(lo - np.cumsum(count) + count, count)
            at = word[index.locate(rows)]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + n, -1)
            found = np.unique(np.stack([doc[at], np.repeat(which, count)]), axis=1)
            for d, p in found.T.tolist():
                pairs.update((d, item) for item in items[p])
        return np.cumsum(hit)[:-1] > 0, sorted(pairs)


def _scan(block: Windows, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a block's spans and items to those that blocks before have found."""
    for batch in shards(batches, "text", _SHARD):
        n = batch.num_rows
        symbols, counts = [], []
        for part in shards(iter([batch]), "text", _SLICE):
            h, _, ends = words(*buffers(part.column(1)), "alnum")
            symbols.append(block.symbols(h))
            counts.append(np.diff(ends))
        at = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        doc = np.repeat(np.arange(n), np.diff(at))
        hit, pairs = block.hits(np.concatenate(symbols), doc)
        spans, items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        if hit.any():
            data, offsets = buffers(batch.column(1))
            begin, end = word_bounds(data, offsets, "alnum")
            edge = np.zeros(len(hit), bool)
            edge[0] = True
            edge[1:] = (hit[1:] != hit[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(edge)
            after = np.append(first[1:], len(hit))
            first, after = first[hit[first]], after[hit[first]]
            for d, a, b, x, y in zip(doc[first].tolist(), first.tolist(), after.tolist(), begin[first].tolist(), end[after - 1].tolist(), strict=True):
                spans[d].append({"a": a - int(at[d]), "b": b - int(at[d]), "from": x - int(offsets[d]), "to": y - int(offsets[d])})
            for d, item in pairs:
                items[d].append(item)
            for d in set(doc[first].tolist()):
                spans[d], items[d] = merged(spans[d]), sorted(set(items[d]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(at) if n else [], pa.int64()), pa.array(spans, _SPAN_TYPE), pa.array(items, pa.list_(pa.int64()))],
            ["key", "text", "n_words", "spans", "items"],
        )


def merged(spans: list[dict]) -> list[dict]:
    """Sorted spans without overlaps; spans that touch become one."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["a"], s["b"])):
        if out and s["a"] <= out[-1]["b"]:
            if s["b"] > out[-1]["b"]:
                out[-1]["b"], out[-1]["to"] = s["b"], s["to"]
        else:
            out.append(dict(s))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        size += len(text.encode())
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True):
            at, pieces = 0, []
            for s in spans:
                pieces.append(text[at : s["from"]])
                at = s["to"]
            texts.append(b"".join([*pieces, text[at:]]) if text is not None else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), *batch.columns[2:]], batch.schema.names)


def _passes(benchmark: DataFrame) -> Iterator[list[list[tuple[int, str]]]]:
    held, size = [], 0
    for block in _blocks(benchmark):
        held.append(block)
        size += sum(len(t.encode()) for _, t in block)
        if size >= PASS_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _pass(blocks: list[Windows], cut: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks:
        batches = _scan(block, batches)
    return _cut(batches) if cut else batches


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), cut: bool = False) -> DataFrame:
    """docs' columns `keep` and its text, with n_words, spans and items.

    spans: a and b are the first hit word and the one after the last, from and to the same in bytes
    of the text. items: the sorted ids of the items with a window in the text. cut: the text is
    returned without its spans.
    """
    context = docs.sparkSession.sparkContext
    out = docs.select(F.struct(*keep).alias("key"), "text", F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"), F.array().cast("array<long>").alias("items"))
    schema, passes, written = out.schema, _passes(benchmark), None
    now = next(passes, [[]])
    while now is not None:
        after = next(passes, None)
        blocks = context.broadcast([Windows(x) for x in now])
        out = out.mapInArrow(lambda b, blocks=blocks, last=cut and after is None: _pass(blocks.value, last, b), schema)
        if after is not None:
            before, written = written, Spilled(out, "leaks")
            out = written.df
            blocks.destroy()
            if before:
                before.drop()
        now = after
    return out.select("key.*", "text", "n_words", "spans", "items")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


OP8_SQL = r"""
WITH lowered AS (
  SELECT false AS bench, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT true, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT bench, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
items AS (
  SELECT DISTINCT id AS item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM split WHERE bench AND len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM items),
doc_windows AS (
  SELECT id AS doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT s.id, s.w, l.n, unnest(range(1, len(s.w) - l.n + 2)) AS i FROM split s, lengths l WHERE NOT s.bench AND len(s.w) >= l.n)),
found AS (SELECT d.doc_id, d.n, d.i, t.item_id FROM doc_windows d JOIN items t ON d.n = t.n AND d.win = t.win),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY doc_id)
SELECT s.id AS doc_id, len(s.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM split s LEFT JOIN hit h ON s.id = h.doc_id LEFT JOIN named m ON s.id = m.doc_id WHERE NOT s.bench
"""
