"""Kernels that read a series' rows in order, in Arrow batches.

A kernel gets columns as numpy arrays (a missing number is NaN) and its state after the rows before, None
at a series' start, and returns new columns (doubles) and its state. Several kernels run in one pass, each
sees the columns of those before it. A series is one task, which holds one batch and the states, so
memory is bounded and time is linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructType

from candleforge.schema import KEY


class Kernel(Protocol):
    reads: list[str]
    adds: list[str]

    def __call__(self, cols: dict[str, np.ndarray], state: Any) -> tuple[dict[str, np.ndarray], Any]: ...


def to_numpy(column: pa.Array) -> np.ndarray:
    if pa.types.is_boolean(column.type):
        column = column.cast(pa.int8())
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def to_arrow(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=np.isnan(values))


def starts(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Where rows begin that differ from the ones before in some of the columns; 0 is always among them."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for name in names:
        codes = batch.column(name).dictionary_encode()
        at = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= at[1:] != at[:-1]
    return np.flatnonzero(new)


def _run(kernels: list[Kernel], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reads = {c for k in kernels for c in k.reads} - {c for k in kernels for c in k.adds}
    adds = [c for k in kernels for c in k.adds]
    last, states = None, [None] * len(kernels)
    for batch in batches:
        if not batch.num_rows:
            continue
        values = {c: to_numpy(batch.column(c)) for c in reads}
        out = {c: np.empty(batch.num_rows) for c in adds}
        cuts = [*starts(batch, KEY).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(batch.column(c)[a].as_py() for c in KEY)
            if key != last:
                last, states = key, [None] * len(kernels)
            cols = {c: v[a:b] for c, v in values.items()}
            for i, kernel in enumerate(kernels):
                new, states[i] = kernel(cols, states[i])
                cols |= new
            for c in adds:
                out[c][a:b] = cols[c]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(to_arrow(out[c]) for c in adds)], [*batch.schema.names, *adds])


def by_series(df: DataFrame, kernels: list[Kernel]) -> DataFrame:
    """df, which has KEY and ts, with the columns that the kernels add."""
    schema = StructType(list(df.schema.fields))
    for name in (c for k in kernels for c in k.adds):
        schema = schema.add(name, DoubleType())
    return df.repartition(*KEY).sortWithinPartitions(*KEY, "ts").mapInArrow(lambda b: _run(kernels, b), schema)
