"""Packing: shortest-pack-first over the histogram of lengths.

A document's tokens are those of a tokenizer with its closing id. Documents longer than a sequence
give full pieces and a rest. The histogram of piece lengths has at most `size` bins, so it goes to
the driver whatever the corpus' size. There, lengths are placed longest first, each batch of equal
pieces into the open pattern with the least content, which only changes counts of
patterns. The patterns then give, for each length, intervals of ranks with their pattern, sequence
number and offset, and pieces find their place by their rank among the pieces of equal length.

Ranks without a sort or a hot group: the scan counts each length within its partition and writes the
pieces (without tokens); the counts of partitions are summed up by length; rank = pieces of that
length in partitions before + rank in its own.

Nulls, ties and odd rows: a null or empty text is its closing id alone. Rows with equal or null ids
are packed one by one. Other columns are passed over. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candleforge.llm.shared import Spilled
from candleforge.llm.text import shards

SIZE = 2048
CLOSING = 1
_CACHE = 1 << 18
_SLICE = 4 << 20


@cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself, if it is a printable
    Latin-1 character other than the space, else the next free one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(free)) for b in range(256)]


@cache
def tokenizer_of(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordTokens(dict):
    """Ids, as little-endian 32-bit numbers, of what stands between white space.

    The tokenizer's pattern never matches across white space, which it drops, so a text's ids are
    its words' ids in a row. Words recur, so most ids come from this table. A new word of lower-case
    letters in normal form is one piece of the pattern and goes to the BPE model at once; one that ends
    with a single mark is two; all else takes the tokenizer's whole way. The table lives as long as its
    task, so that idle workers hold no memory.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer_of(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > _CACHE:
            self.clear()
        text = word.decode()
        if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
            if not text.isascii():
                text = "".join([byte_letters()[b] for b in word])
            out = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
        elif text[-1] in ".,;:!?" and text[:-1].isalpha():
            out = self[word[:-1]] + self[word[-1:]]
        else:
            out = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = out
        return out

    def text(self, text: bytes) -> bytes:
        # The tokenizer lower-cases all but its special tokens, which begin with <|.
        return b"".join([self[w] for w in (text if b"<|" in text else text.lower()).split()])


def _pieces(tokenizer: str, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, seen, part = WordTokens(tokenizer), Counter(), TaskContext.get().partitionId()
    closing = np.array([CLOSING], "<u4").tobytes()
    for batch in shards(batches, "text", _SLICE):
        rows: list[tuple] = []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            ids = tokens.text(text or b"") + closing
            n = len(ids) // 4
            for a in range(0, n, size):
                piece = ids[4 * a : 4 * (a + size)]
                length = len(piece) // 4
                rows.append((i, a, length, zlib.crc32(piece), n, part, seen[length]))
                seen[length] += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"])


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Patterns (how many sequences, their lengths), by shortest-pack-first.

    Lengths go from the longest to the shortest. Each time, the pattern with the least content takes
    a piece, if it fits; of the pattern's sequences as many change as there are pieces.
    """
    open_: list[tuple[int, int, list[int]]] = []  # content, number, lengths: the least content first
    number: dict[int, int] = {}
    done, serial = [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left = counts[length]
        while left:
            if open_ and open_[0][0] + length <= size:
                content, key, lengths = heapq.heappop(open_)
                n = number.pop(key)
                take = min(n, left)
                if take < n:
                    number[key] = n - take
                    heapq.heappush(open_, (content, key, lengths))
                grown, lengths = content + length, [*lengths, length]
            else:
                take, grown, lengths = left, length, [length]
            left -= take
            if grown == size:
                done.append((take, lengths))
            else:
                serial += 1
                number[serial] = take
                heapq.heappush(open_, (grown, serial, lengths))
    return done + [(number[key], lengths) for _, key, lengths in sorted(open_)]


def placements(patterns: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: where its intervals of ranks begin, their first sequence, and the offset there."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for n, lengths in patterns:
        offset = 0
        for length in lengths:
            slots.setdefault(length, []).append((n, base, offset))
            offset += length
        base += n
    out = {}
    for length, of in slots.items():
        n, first, offset = np.array(of, np.int64).T
        out[length] = (np.cumsum(n) - n, first, offset)
    return out


def _place(at: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
            begin, first, offsets = at[int(length[own[0]])]
            k = np.searchsorted(begin, rank[own], "right") - 1
            sequence[own], offset[own] = first[k] + rank[own] - begin[k], offsets[k]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ", ".join(f"{c} long" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"))
    pieces = Spilled(rows.mapInArrow(lambda b: _pieces(tokenizer, size, b), schema), "pieces").df
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = by_part.select("part", "length", "n", F.coalesce(before, F.lit(0)).alias("before"))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    at = placements(pack_histogram(counts, size))
    ranked = pieces.join(ranks.drop("n"), ["part", "length"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"{c} long" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
    return ranked.mapInArrow(lambda b: _place(at, b), schema)


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), word_bpe())
