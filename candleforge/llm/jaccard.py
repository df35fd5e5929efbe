"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

A document's set: its distinct runs of five words (A-Z lower-cased, split at ASCII white space), as
64-bit hashes; all its words as one run if it has fewer; empty without words. Two documents link when
100 * intersection >= percent * union (percent from 75 to 99), and linked documents are one group.

Equal sets are one class, found by a 128-bit digest, and take part once.

Small sets (under the boundary) enumerate subsets of fixed size: a linked pair whose larger set has m
elements shares at least c = ceil(percent * m / 100) of them, so it shares a subset of c elements, and
a set of a elements enumerates those of each c that a partner can ask for.

Large sets scan inverted lists. With the elements of all sets in one order, the first m + 1 common
elements of a linked pair are among the first (1 - percent / 100) * a + 1 + m elements of each (a: its
own size), so lists of those elements find all pairs; with m = a / SPARE, a set that shares fewer of its
own than its smallest partner's m + 1 has no partner and goes. Small sets that a large one can link with are in these
lists, too. The order is: light elements before heavy ones, heavy ones by rising frequency, equals by hash.
Heavy are elements in over HEAVY documents, counted over all documents by 32 bits of their hashes; if
they are more than MOST_HEAVY, which the tasks get as one array, only the most frequent count as
heavy. Any choice of them gives all links; this one keeps lines and passages that many documents
share out of the lists.

The boundary is where the histogram of set sizes makes both ways together cheapest (`boundary`).

Each list's members are candidates. First, each list's smallest id is paired with the others, which
joins most groups by a number of pairs linear in the lists; then, in lists that still have
several components, all pairs across components that weren't yet compared. Before any set travels, a pair's
common lists are counted: with fewer than its sizes ask for (`needed`), it can't be linked. In the second
round that is exact for lists of up to SHORT members, which give rows of pairs. Longer ones, in which
nothing is counted, are cut into blocks of about BLOCK members, each pair of
blocks is one task's work, a product of incidence matrices, and only a spanning forest of its links comes
out. Candidates are verified on whole sets; a set that many are compared with travels once for
each BLOCK of them. So no link between groups is lost, and the pairs within a group are never rows.

Classes and lists that hold over 1/HOT of all rows are joined by a broadcast (there are fewer than HOT).
Tables in between are deleted when the last that reads them is written.

Nulls, ties and odd rows: a null or blank text has an empty set and links with nothing. Rows without
an id link with nothing; their component is null. Rows that repeat an id are one node. Only doc_id and
text are read. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleforge.llm.graph import components
from candleforge.llm.shared import Spilled, grouped, join_hot, local_roots, parts
from candleforge.llm.text import U, buffers, mix, shards, shingles, words

PERCENT = 80
HEAVY, MOST_HEAVY = 4, 1 << 20
#: An entry of an inverted list costs as much as six subsets: who meets there must still be verified,
#: while sets that share a subset of that size are as good as linked.
LIST_COST = 6
#: Ids of documents with candidates are broadcast up to this number, beyond it the texts are shuffled.
MOST_BROADCAST = 1_000_000
SHORT, BLOCK = 24, 512
SPARE = 10
#: A task that counts elements or makes lists gets about so many elements' share.
ELEMENTS_A_TASK = 16_000_000
_SLICE, _FLUSH = 1 << 20, 16 << 20


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    h, _, at = words(*buffers(batch.column(1)), "spaced")
    return shingles(h, at)


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in shards(batches, "text", _SLICE):
        sets = _sets(batch)
        d = [_digest(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in d], pa.int64()), pa.array([b for _, b in d], pa.int64())], ["doc_id", "n_shingles", "d1", "d2"]
        )


def overlaps(a: int, percent: int) -> list[int]:
    """The sizes of subset that a set of a elements shares with a linked one, by the larger one's size."""
    return sorted({-(-percent * m // 100) for m in range(a, 100 * a // percent + 1)} & set(range(a + 1)))


def reach(a: int, percent: int) -> int:
    """How many elements, from the smallest hash on, stand in inverted lists."""
    return min(a, (100 - percent) * a // 100 + 1 + a // SPARE)


def needed(a: F.Column, b: F.Column, x: int, percent: int) -> F.Column:
    """How many lists linked sets of a and b elements share at least.

    Of their k common elements, in order, the i-th is among the first i + a - k of one set and the first
    i + b - k of the other, so it is in both prefixes up to an i that follows from their lengths.
    """
    common = F.ceil(percent * (a + b) / (100 + percent))
    spare = [F.least(s, F.floor((100 - percent) * s / 100) + 1 + F.floor(s / SPARE)) - s + common for s in (a, b)]
    return F.when(F.greatest(a, b) < x, 1).otherwise(F.greatest(F.lit(1), F.least(*spare, common)))


def boundary(sizes: dict[int, int], percent: int, most: int = 16) -> int:
    """The least size of large sets, so that signatures cost least; sizes: number of sets by size."""

    def cost(x: int) -> int:
        total = 0
        for a, n in sizes.items():
            if a < x:
                total += n * sum(comb(a, c) for c in overlaps(a, percent))
            if 100 * a // percent >= x:
                total += n * LIST_COST * reach(a, percent)
        return total

    return min(range(1, most + 1), key=lambda x: (cost(x), x))


def signatures(s: np.ndarray, times: np.ndarray, x: int, percent: int) -> np.ndarray:
    """Of one sorted set with boundary x; times: the frequencies of heavy elements, 0 for light ones."""
    a, out = len(s), []
    if a < x:
        for c in overlaps(a, percent):
            rows = np.array(list(combinations(range(a), c)), np.int64)
            out.append(mix(mix(s)[rows].sum(axis=1, dtype=U) + U(c)))
    if 100 * a // percent >= x:
        out.append(mix(s[np.argsort(times, kind="stable")[: reach(a, percent)]]))
    return np.concatenate(out) if out else np.zeros(0, U)


def _packed(sorted32: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as 16-bit differences; 65535 stands for as much without a number."""
    steps = np.diff(sorted32.astype(np.int64), prepend=0)
    extra = steps // 65535
    out = np.full(len(steps) + int(extra.sum()), 65535, np.uint16)
    out[np.cumsum(extra + 1) - 1] = steps % 65535
    return out.tobytes()


def _unpacked(block: bytes) -> np.ndarray:
    steps = np.frombuffer(block, np.uint16)
    return np.cumsum(steps.astype(np.int64))[steps < 65535].astype(np.uint32)


def _many_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The sets of about _FLUSH bytes of texts at a time."""
    held, size = [], 0
    for batch in shards(batches, "text", _SLICE):
        held += _sets(batch)
        size += batch.column(1).nbytes
        if size >= _FLUSH:
            yield held
            held, size = [], 0
    if held:
        yield held


def _elements(targets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range of hashes the first 32 bits of all documents' elements in it, a number a document."""
    edges = np.array([t * (1 << 32) // targets for t in range(targets + 1)], np.int64)
    for sets in _many_sets(batches):
        every = np.sort((np.concatenate(sets) >> U(32)).astype(np.uint32))
        cut = np.searchsorted(every, edges)
        which = [t for t in range(targets) if cut[t] < cut[t + 1]]
        blocks = [_packed(every[cut[t] : cut[t + 1]] - np.uint32(edges[t])) for t in which]
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(blocks, pa.binary())], ["target", "block"])


def _frequent(targets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(frequency, the hashes of that frequency) of a range of hashes."""
    blocks, base = [], 0
    for batch in batches:
        for t, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            base = t * (1 << 32) // targets
            blocks.append(_unpacked(block))
    if not blocks:
        return
    every = np.sort(np.concatenate(blocks))
    begin = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    n = np.diff(np.append(begin, len(every)))
    hashes, n = every[begin][n > HEAVY], n[n > HEAVY]
    order = np.argsort(n, kind="stable")
    cut = np.flatnonzero(np.diff(n[order])) + 1
    rows = [(int(n[own[0]]), (hashes[own] + np.uint32(base)).tobytes()) for own in np.split(order, cut) if len(own)]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["n", "hashes"])


def heavy_elements(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted first halves of the heavy elements' hashes, their frequencies), at most MOST_HEAVY; found by n tasks."""
    ranges = docs.where("text is not null").mapInArrow(lambda b: _elements(n, b), "target int, block binary")
    found = Spilled(ranges.repartitionById(n, F.col("target")).mapInArrow(lambda b: _frequent(n, b), "n long, hashes binary"), "heavy")
    down = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    totals = found.df.groupBy("n").agg(F.sum(F.octet_length("hashes") / 4).alias("k")).withColumn("k", F.sum("k").over(down))
    least = totals.where(F.col("k") <= MOST_HEAVY).agg(F.min("n")).first()[0]
    rows = found.df.where(F.col("n") >= least).collect() if least is not None else []
    found.drop()
    hashes = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(r.hashes, np.uint32) for r in rows)])
    times = np.concatenate([np.zeros(0, np.int64), *(np.full(len(r.hashes) // 4, r.n) for r in rows)])
    order = np.argsort(hashes)
    return hashes[order], times[order].astype(np.uint32)


def _times(sets: list[np.ndarray], hashes: np.ndarray, times: np.ndarray) -> list[np.ndarray]:
    every = (np.concatenate(sets) >> U(32)).astype(np.uint32)
    out = np.zeros(len(every), np.uint32)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, every), len(hashes) - 1)
        out = np.where(hashes[at] == every, times[at], out)
    return np.split(out, np.cumsum([len(s) for s in sets])[:-1])


def least_linked(percent: int) -> int:
    """A linked pair of different sets has a common part of at least this many elements."""
    return -(-percent // (100 - percent))


def _postings(heavy, x: int, percent: int, targets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each target a block: its documents (digest, size, number of signatures) and their signatures."""
    for sets in _many_sets(batches):
        sets = [s for s in sets if len(s) >= least_linked(percent)]
        if not sets:
            continue
        own = [signatures(s, t, x, percent) for s, t in zip(sets, _times(sets, *heavy.value), strict=True)]
        doc = np.repeat(np.arange(len(sets)), [len(o) for o in own])
        sig = np.concatenate(own)
        digest, size = np.array([_digest(s)[0] for s in sets], np.int64), np.array([len(s) for s in sets], np.int32)
        to = ((sig >> U(40)) % U(targets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cut = np.searchsorted(to[order], np.arange(targets + 1))
        which, blocks = [], []
        for t in range(targets):
            part = order[cut[t] : cut[t + 1]]
            if len(part):
                docs, n = np.unique(doc[part], return_counts=True)  # part is in the order of documents
                low = sig[part]
                head = np.array([len(docs), len(part)], np.int64)
                which.append(t)
                pieces = (head, digest[docs], size[docs], n.astype(np.int32), (low & U(0xFFFFFFFF)).astype(np.uint32), ((low >> U(32)) & U(0xFF)).astype(np.uint8))
                blocks.append(b"".join(p.tobytes() for p in pieces))
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(blocks, pa.binary())], ["target", "block"])


def _opened(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, digests, sizes), a row for each posting."""
    n_docs, n = np.frombuffer(block, np.int64, 2).tolist()
    at = 16
    out = []
    for kind, k in ((np.int64, n_docs), (np.int32, n_docs), (np.int32, n_docs), (np.uint32, n), (np.uint8, n)):
        out.append(np.frombuffer(block, kind, k, at))
        at += out[-1].nbytes
    digest, size, times, low, high = out
    return low.astype(U) | (high.astype(U) << U(32)), np.repeat(digest, times), np.repeat(size, times)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, digest, size, times) of the lists of several classes; equal lists have one name and come once."""
    blocks = [_opened(b) for batch in batches for b in batch.column(1).to_pylist()]
    if not blocks:
        return
    sig, digest, size = (np.concatenate(x) for x in zip(*blocks, strict=True))
    del blocks
    order = np.argsort(sig)
    s = sig[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    order = order[twice]
    order = order[np.lexsort((digest[order], sig[order]))]
    sig, digest, size = sig[order], digest[order], size[order]
    if not len(sig):
        return
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (digest[1:] != digest[:-1])
    sig, digest, size = sig[new], digest[new], size[new]
    begin = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    length = np.diff(np.append(begin, len(sig)))
    name = mix(np.add.reduceat(mix(digest.view(U)), begin) + length.astype(U))
    _, once, n = np.unique(name, return_index=True, return_counts=True)
    times = np.zeros(len(begin), np.int64)
    times[once] = n
    times[length == 1] = 0
    rows = np.repeat(times > 0, length)
    name, digest, size, times = np.repeat(name, length)[rows].view(np.int64), digest[rows], size[rows].astype(np.int64), np.repeat(times, length)[rows]
    for a in range(0, len(name), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 100_000]) for x in (name, digest, size, times)], ["list", "d1", "size", "times"])


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in shards(batches, "text", _SLICE):
        sets = _sets(batch)
        own = [_digest(s)[0] == d for s, d in zip(sets, batch.column(2).to_pylist(), strict=True)]
        rows = [i for i, ok in enumerate(own) if ok]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array([sets[i].tobytes() for i in rows], pa.binary())], ["id", "elements"])


def _verified(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Linked (a, b) of rows (a, part, b, elements) in that order; the row with a null b has the set of a."""
    own = np.zeros(0, U)
    for batch in batches:
        left, right = [], []
        for a, b, block in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            s = np.frombuffer(block.as_buffer(), U)
            if b is None:
                own = s.copy()
                continue
            both = len(np.intersect1d(own, s, assume_unique=True))
            if 100 * both >= percent * (len(own) + len(s) - both):
                left.append(a)
                right.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])


def overlap_matrix(sets: list[np.ndarray], most: int = 4 << 20) -> np.ndarray:
    """Sizes of all intersections, by products of 0-1 matrices of a bounded number of columns."""
    every = np.concatenate(sets)
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[column] > 1  # others are in no intersection
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), np.float32)
    n, width = int(column[-1]) + 1 if len(column) else 0, max(1, most // len(sets))
    for a in range(0, n, width):
        own = slice(*np.searchsorted(column, [a, a + width]))
        x = np.zeros((len(sets), min(width, n - a)), np.float32)
        x[row[own], column[own] - a] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _blocks(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links across components of lists' pairs of blocks, as edges to a local root."""
    for rows in grouped(batches, 3):
        ids, component, own = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5))
        sets = [np.frombuffer(r[6], U) for r in rows]
        size = np.array([len(s) for s in sets], np.int64)
        both = overlap_matrix(sets)
        linked = (100 * both >= percent * (size[:, None] + size[None] - both)) & (component[:, None] != component[None])
        if rows[0][1] != rows[0][2]:
            linked &= own[:, None] != own[None]
        i, j = np.nonzero(np.triu(linked, 1))
        if len(i):
            root = local_roots(ids, i, j)
            other = np.flatnonzero(root != ids)
            yield pa.RecordBatch.from_arrays([pa.array(root[other]), pa.array(ids[other])], ["a", "b"])


def _near_in_size(percent: int, a: str, b: str) -> F.Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs(doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = Spilled(docs.mapInArrow(_digests, "doc_id long, n_shingles long, d1 long, d2 long"), "sets")
    classes = sets.df.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("size"), F.count("*").alias("copies"))
    classes = Spilled(classes, "set-classes")
    sizes = {r["size"]: r.n for r in classes.df.where("size <= 64").groupBy("size").agg(F.count("*").alias("n")).collect()}
    total = sets.df.agg(F.sum("n_shingles")).first()[0] or 0
    x, n = boundary(sizes, percent), max(parts(spark), -(-total // ELEMENTS_A_TASK))
    heavy = spark.sparkContext.broadcast(heavy_elements(docs, n))
    postings = docs.where("doc_id is not null and text is not null").mapInArrow(lambda b: _postings(heavy, x, percent, n, b), "target int, block binary")
    lists = Spilled(postings.repartitionById(n, F.col("target")).mapInArrow(_lists, "list long, d1 long, size long, times long"), "lists")
    shared = F.when(F.col("size") < x, 1).otherwise(F.floor(F.col("size") * percent / (100 * SPARE)) + 1)
    enough = lists.df.groupBy("d1", "size").agg(F.sum("times").alias("all")).where(F.col("all") >= shared).select("d1", "size")
    found = classes.df.select("d1", "id", "size").join(enough, ["d1", "size"])
    named = lists.df.groupBy("list", "d1", "size").agg(F.sum("times").alias("times"))
    members = Spilled(named.join(found, ["d1", "size"]).select("list", "id", "size", "d1", "times"), "members")
    lists.drop()
    hubs = Spilled(members.df.groupBy("list").agg(F.min(F.struct("id", "size")).alias("hub"), F.count("*").alias("n")).where("n > 1"), "hubs")

    def sets_of(ids: DataFrame) -> Spilled:
        ids = Spilled(members.df.select(F.col("id").alias("doc_id"), "d1").distinct().join(ids.distinct(), "doc_id"), "candidates")
        wanted = F.broadcast(ids.df) if ids.df.count() <= MOST_BROADCAST else ids.df
        out = Spilled(docs.join(wanted, "doc_id").select("doc_id", "text", "d1").mapInArrow(_blobs, "id long, elements binary"), "elements")
        ids.drop()
        return out

    def possible(pairs: DataFrame) -> DataFrame:
        """(a, b) of pairs(a, size_a, b, size_b, times) that have enough lists together."""
        counted = pairs.groupBy("a", "size_a", "b", "size_b").agg(F.sum("times").alias("times"))
        return counted.where(F.col("times") >= needed(F.col("size_a"), F.col("size_b"), x, percent)).select("a", "b")

    def verified(pairs: DataFrame, blobs: DataFrame) -> DataFrame:
        cuts = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("cuts"))
        dealt = pairs.join(cuts, "a").select("a", F.pmod(F.xxhash64("b"), "cuts").cast("int").alias("part"), "b")
        own = dealt.select("a", "part").distinct().join(blobs, F.col("a") == F.col("id")).select("a", "part", F.lit(None).cast("long").alias("b"), "elements")
        rows = own.unionByName(dealt.join(blobs, F.col("b") == F.col("id")).select("a", "part", "b", "elements"))
        ordered = rows.repartition(parts(spark), "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        return ordered.mapInArrow(lambda batches: _verified(percent, batches), "a long, b long")

    # the smallest id of each list with the others
    stars = join_hot(members.df.select("list", "id", "size", "times"), hubs.df, ["list"], "n")
    stars = stars.where((F.col("id") > F.col("hub.id")) & _near_in_size(percent, "size", "hub.size"))
    stars = stars.select(F.col("hub.id").alias("a"), F.col("hub.size").alias("size_a"), F.col("id").alias("b"), F.col("size").alias("size_b"), "times")
    first = Spilled(possible(stars), "pairs")
    blobs = sets_of(first.df.select(F.explode(F.array("a", "b")).alias("doc_id")))
    links = Spilled(verified(first.df, blobs.df), "links")
    blobs.drop()
    groups = Spilled(components(links.df), "groups")

    # what still lies across components, in lists of several
    listed = join_hot(members.df.select("list", "id", "size", "times"), hubs.df.select("list", "n"), ["list"], "n")
    placed = listed.join(groups.df, listed["id"] == groups.df["node"], "left").select("list", "n", "id", "size", "times", F.coalesce("component", "id").alias("component"))
    placed = Spilled(placed, "placed")
    open_ = placed.df.groupBy("list").agg((F.min("component") < F.max("component")).alias("open"), F.first("n").alias("held")).where("open").select("list", "held")
    rest = Spilled(join_hot(placed.df, open_, ["list"], "held"), "open-lists")
    placed.drop()
    short = rest.df.where(F.col("n") <= SHORT)
    left = short.select("list", F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("component").alias("component_a"), "times")
    right = short.select("list", F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("component").alias("component_b"))
    across = left.join(right, "list").where((F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b")) & _near_in_size(percent, "size_a", "size_b"))
    second = Spilled(possible(across).join(first.df, ["a", "b"], "left_anti"), "pairs")
    long = rest.df.where(F.col("n") > SHORT)
    blobs = sets_of(second.df.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(long.select(F.col("id").alias("doc_id"))))
    long = long.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    long = long.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    long = long.select("list", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "id", "component", "own").join(blobs.df, "id")
    met = long.select("list", "p", "q", "id", "component", "own", "elements").repartition(n, "list", "p", "q").sortWithinPartitions("list", "p", "q")
    more = Spilled(verified(second.df, blobs.df).unionByName(met.mapInArrow(lambda b: _blocks(percent, b), "a long, b long")), "links")
    for table in (blobs, first, second, rest, members, hubs):
        table.drop()
    if not more.df.isEmpty():
        both = components(links.df.unionByName(more.df))
        groups.drop()
        groups = Spilled(both, "groups")

    # a row for each document again
    class_of = classes.df.join(groups.df.withColumnRenamed("node", "id"), "id", "left").select("d1", "d2", "copies", F.coalesce("component", "id").alias("component"))
    in_class = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    placed = join_hot(sets.df.where(in_class), class_of, ["d1", "d2"], "copies")
    out = placed.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    out = Spilled(out.unionByName(sets.df.where(~F.coalesce(in_class, F.lit(False))).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))), "near-duplicates")
    for table in (sets, classes, groups, links, more):
        table.drop()
    heavy.destroy()
    return out.df


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.root AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT x, min(y) AS root FROM reach GROUP BY x) r ON r.x = d.doc_id
"""
