"""Words and hashes of many texts at a time, from Arrow's string buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: ASCII white space, which separates words and is stripped from lines.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@cache
def letter_codes() -> np.ndarray:
    """A random 64-bit number for each byte, the same for A-Z and a-z."""
    codes = mix(np.arange(1, 257, dtype=U) * U(_ODD))
    codes[65:91] = codes[97:123]
    return codes


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD6E8FEB86659FD93
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, dtype=U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << 20)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least n of each; kept for usual sizes."""
    return _usual_powers() if n <= 1 << 20 else _powers(n)


@cache
def is_word_byte(kind: str) -> np.ndarray:
    """kind 'spaced': all but ASCII white space; 'alnum': 0-9, A-Z, a-z and all bytes beyond ASCII."""
    ok = np.ones(256, dtype=bool)
    if kind == "spaced":
        ok[list(SPACE)] = False
    else:
        ok[:128] = False
        for a, b in ((48, 58), (65, 91), (97, 123)):
            ok[a:b] = True
    return ok


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; a null is empty. The last offset is the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def shards(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most so many bytes in the column, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        i = batch.schema.get_field_index(column)
        _, ends = buffers(batch.column(i))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Where in the bytes each word begins and ends; no word goes over the end of its text."""
    ok = is_word_byte(kind)[data]
    first, last = ok.copy(), ok.copy()
    first[1:] &= ~ok[:-1]
    last[:-1] &= ~ok[1:]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    first[cut] = ok[cut]
    cut = offsets[1:][offsets[1:] > 0] - 1
    last[cut] = ok[cut]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word with A-Z lower-cased, its text's index, where each text's words begin).

    The hash is a polynomial of random byte codes modulo 2**64, mixed with the length.
    """
    n, n_texts = len(data), len(offsets) - 1
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(n_texts + 1, np.int64)
    begin, end = word_bounds(data, offsets, kind)
    up, down = powers(n)
    sums = np.zeros(n + 1, U)
    np.cumsum(letter_codes()[data] * up[:n], out=sums[1:])
    h = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U) * U(_ODD))
    at = np.searchsorted(begin, offsets)
    return h, np.repeat(np.arange(n_texts), np.diff(at)), at


def shingles(h: np.ndarray, at: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of so many words; of all its words if it has fewer."""
    n = len(h)
    odd = [U(2 * pow(_ODD, k + 1, 1 << 62) + 1) for k in range(width)]
    runs = np.zeros(max(0, n - width + 1), U)
    for k in range(width):
        runs += mix(h[k : k + len(runs)] + U(k)) * odd[k]
    runs = mix(runs)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            few = np.array([(b - a) * 0x1F3D5B79], dtype=U)
            for k in range(b - a):
                few = few + mix(h[a + k : a + k + 1] + U(k)) * odd[k]
            out.append(mix(few))
        else:
            out.append(np.zeros(0, U))
    return out
