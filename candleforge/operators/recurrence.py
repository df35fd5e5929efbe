"""Linear recurrences y = a * y_before + b over each series, as a block scan.

Rows meet by blocks of time, not by series, so one long series is many tasks. A first pass over the blocks
composes each one's rows to what they do to the value before them; these summaries, a row for each block,
are folded in order per series; a second pass over the same shuffled rows gives each row its value. In a block, numpy
composes the maps of rows by doubling, log2 steps over whole columns. a = 0 starts anew, which needs no
division, so restarts and first observations are exact.

df's other columns travel along, so callers should pass the columns they need, not more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from candleforge.operators.series import starts, to_arrow, to_numpy
from candleforge.schema import KEY

#: Steps of time in a block.
BLOCK = 1 << 16


def prefix(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(p, s): after row i, y = p[i] * y_before_all + s[i]."""
    p, s, k = a.copy(), b.copy(), 1
    while k < len(p):
        anew = p[k:] == 0
        s[k:], p[k:] = np.where(anew, s[k:], p[k:] * s[:-k] + s[k:]), np.where(anew, 0.0, p[k:] * p[:-k])
        k *= 2
    return p, s


def _after(p: np.ndarray, s: np.ndarray, y: float) -> np.ndarray:
    return np.where(p == 0, s, p * y + s)


@dataclass
class Linear:
    """Terms in two columns. State: the value."""

    a: str
    b: str
    name: str
    width = 2

    def summary(self, cols: dict[str, np.ndarray]) -> list[float]:
        p, s = prefix(cols[self.a], cols[self.b])
        return [p[-1], s[-1]]

    def start(self) -> list[float]:
        return [np.nan]

    def fold(self, state: list[float], summary: list[float]) -> list[float]:
        p, s = summary
        return [s if p == 0 else p * state[0] + s]

    def values(self, cols: dict[str, np.ndarray], state: list[float]) -> np.ndarray:
        return _after(*prefix(cols[self.a], cols[self.b]), state[0])


@dataclass
class Mean:
    """An exponential mean. State: the value, rows since the last observation, number of observations."""

    x: str
    alpha: float
    least: int
    name: str
    width = 6

    def _terms(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of observations, a, b), from the second observation on."""
        at = np.flatnonzero(~np.isnan(x))
        a, b = np.ones(len(x)), np.zeros(len(x))
        old = (1 - self.alpha) ** np.diff(at)
        a[at[1:]] = old / (old + self.alpha)
        b[at[1:]] = self.alpha * x[at[1:]] / (old + self.alpha)
        return at, a, b

    def _first(self, state: list[float], at: int, x: float) -> float:
        y, gap, n = state
        old = (1 - self.alpha) ** (gap + at + 1)
        return x if not n else (old * y + self.alpha * x) / (old + self.alpha)

    def summary(self, cols: dict[str, np.ndarray]) -> list[float]:
        x = cols[self.x]
        at, a, b = self._terms(x)
        if not len(at):
            return [len(x), 0, 0, 0, 1, 0]
        p, s = prefix(a[at[0] + 1 :], b[at[0] + 1 :])
        return [len(x) - 1 - at[-1], len(at), at[0], x[at[0]], *((p[-1], s[-1]) if len(p) else (1, 0))]

    def start(self) -> list[float]:
        return [np.nan, 0, 0]

    def fold(self, state: list[float], summary: list[float]) -> list[float]:
        gap, n, at, x, p, s = summary
        if not n:
            return [state[0], state[1] + gap, state[2]]
        return [p * self._first(state, int(at), x) + s, gap, state[2] + n]

    def values(self, cols: dict[str, np.ndarray], state: list[float]) -> np.ndarray:
        x = cols[self.x]
        at, a, b = self._terms(x)
        if len(at):
            a[at[0]], b[at[0]] = 0.0, self._first(state, int(at[0]), x[at[0]])
        y = _after(*prefix(a, b), state[0])
        return np.where(state[2] + np.cumsum(~np.isnan(x)) >= self.least, y, np.nan)


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows that follow each other with the same values in the columns, as one batch each."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = [*starts(batch, names).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = tuple(batch.column(c)[a].as_py() for c in names)
            if held and own != key:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _columns(block: pa.RecordBatch, reads: set[str]) -> dict[str, np.ndarray]:
    return {c: to_numpy(block.column(c)) for c in reads}


def _summaries(terms: list, reads: set[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, [*KEY, "__blk"]):
        cols = _columns(block, reads)
        row = [float(v) for t in terms for v in t.summary(cols)]
        yield pa.RecordBatch.from_arrays([*(block.column(c).slice(0, 1) for c in (*KEY, "__blk")), pa.array([row], pa.list_(pa.float64()))], [*KEY, "__blk", "__state"])


def _carries(terms: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states before each block, of summaries in order."""
    last, states = None, []
    for batch in batches:
        rows = []
        for *key, summary in zip(*(batch.column(c).to_pylist() for c in (*KEY, "__state")), strict=True):
            if key != last:
                last, states = key, [t.start() for t in terms]
            rows.append([v for s in states for v in s])
            at = 0
            for i, t in enumerate(terms):
                states[i] = t.fold(states[i], summary[at : at + t.width])
                at += t.width
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, "__blk")), pa.array(rows, pa.list_(pa.float64()))], [*KEY, "__blk", "__carry"])


def _values(terms: list, reads: set[str], keep: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, [*KEY, "__blk"]):
        carry = block.column("__carry")[0].as_py() or [v for t in terms for v in t.start()]  # rows without a key start anew
        cols, at, out = _columns(block, reads), 0, []
        for t in terms:
            n = len(t.start())
            out.append(to_arrow(t.values(cols, carry[at : at + n])))
            at += n
        yield pa.RecordBatch.from_arrays([*(block.column(c) for c in keep), *out], [*keep, *(t.name for t in terms)])


def _scan(df: DataFrame, terms: list, reads: set[str], keep: list[str], tf_ms: int) -> DataFrame:
    block = [*KEY, "__blk"]
    dealt = df.withColumn("__blk", F.floor(F.col("ts") / (BLOCK * tf_ms))).repartition(*block)
    found = dealt.sortWithinPartitions(*block, "ts").mapInArrow(lambda b: _summaries(terms, reads, b), _typed(df, "__state"))
    carry = found.repartition(*KEY).sortWithinPartitions(*block).mapInArrow(lambda b: _carries(terms, b), _typed(df, "__carry"))
    # an inner join would filter its side by keys that aren't null, and the shuffle would be done twice
    ready = dealt.join(carry, block, "left").sortWithinPartitions(*block, "ts")
    schema = StructType([df.schema[c] for c in keep])
    for t in terms:
        schema = schema.add(t.name, DoubleType())
    return ready.mapInArrow(lambda b: _values(terms, reads, keep, b), schema)


def _typed(df: DataFrame, name: str) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in KEY) + f", __blk long, {name} array<double>"


def scan(df: DataFrame, recurrences: dict[str, tuple[Column, Column]], tf_ms: int) -> DataFrame:
    """df with a column for each recurrence (name: a, b). df has KEY and ts, one row for each."""
    return ewm(df, {}, tf_ms, recurrences)


def ewm(df: DataFrame, means: dict[str, tuple[str, float, int]], tf_ms: int, more: dict[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """df with exponential means (name: column, alpha, observations needed), and other recurrences.

    The first observation starts a mean. A NULL leaves it as it is, but its weight keeps falling: after
    k NULLs it is (1 - alpha)**(k + 1) against alpha for the new value.
    """
    columns, terms = df.columns, [Mean(x, alpha, least, name) for name, (x, alpha, least) in means.items()]
    for name, (a, b) in (more or {}).items():
        df = df.withColumns({f"__a_{name}": a.cast("double"), f"__b_{name}": b.cast("double")})
        terms.append(Linear(f"__a_{name}", f"__b_{name}", name))
    reads = {c for t in terms for c in ([t.x] if isinstance(t, Mean) else [t.a, t.b])}
    return _scan(df, terms, reads, columns, tf_ms)
