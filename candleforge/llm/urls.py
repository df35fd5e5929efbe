"""URL filter: rules first, gradient-boosted trees for the rest.

A rule is a host with a path prefix and a verdict; it fits its host and all subdomains where the
url's path starts with the rule's; the longest fitting rule decides. The urls that rules decide are
the labelled ones. From at most `n_train` of them (the smallest hashes of distinct urls, so the same ones
in every run; a sketch of their number says under which hash about twice as many lie, and only those are
sorted), trees are boosted on lexical features: lengths, depth, digit ratio, entropy, counts of
parameters, labels and hyphens, and statistics of the host's suffixes. Suffix statistics (smoothed
share of blocked urls, log count) count all labelled urls of the table: one native aggregation by the
longest suffix, of which the shorter ones' sums are made. They are joined to the urls without
a rule, which get the trees' verdict; suffixes with over 1/HOT of those urls by a broadcast. The urls are halved by hash: the trees learn from one half, with
twice the counts of the other, so that they don't see a statistic of their own label.

Nulls, ties and odd rows: a null url, or one without `://`, has an empty host and path; no rule fits
it, and the trees judge it (their features of an empty string). Rules of equal length: the first in
order of their text. With no or only one kind of label, that label (or allow) is the verdict. Rows are
judged one by one; page_id may be null or repeat. Only page_id and url are read. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.llm.shared import Spilled, join_hot

N_TRAIN = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host, path prefix, verdict: fixed values of this task.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
N_SUFFIX, N_LEXICAL = 3, 10


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path)."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(the longest rule that fits, its verdict); null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def suffixes(host: Column, path: Column) -> list[Column]:
    """The last label; the last two; these and the path's first segment. Each is a prefix of the next by `shorter`."""
    labels = F.split(host, r"\.")
    two = F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), ".")
    segment = F.regexp_extract(path, r"^/*([^/]*)", 1)
    return [F.element_at(labels, -1), two, F.concat(two, F.lit("/"), segment)]


def shorter(longest: Column) -> list[Column]:
    """All three suffixes, from the longest."""
    two = F.substring_index(longest, "/", 1)
    return [F.substring_index(two, ".", -1), two, longest]


def lexical(url: str | None, host: str, path: str) -> list[float]:
    u = url or ""
    raw = u.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=1)
    share = counts[counts > 0] / max(1, len(raw))
    query = u.partition("?")[2].partition("#")[0]
    return [
        len(u), len(host), len(path), len([x for x in path.split("/") if x]), sum(c.isdigit() for c in u) / max(1, len(u)), float(-(share * np.log2(share)).sum()),
        len([x for x in query.split("&") if x]), len(host.split(".")), u.count("-") + u.count("_"), float("#" in u),
    ]


@dataclass
class Boosted:
    """Trees of equal depth as arrays: split feature and bin of each inner node, value of each leaf."""

    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    prior: float = 0.0
    depth: int = 3

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bins(x), np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, n_bins: int = 32, l2: float = 1.0) -> Boosted:
    """Logistic loss, histograms of gradients, level by level. Both kinds of rows weigh the same in sum."""
    model = Boosted([np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(x.shape[1])], [], 0.0, depth)
    share = np.clip(y.mean(), 1 / len(y), 1 - 1 / len(y))
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    b = model.bins(x)
    f = np.full(len(x), model.prior)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(x), np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, n_bins)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.zeros(n)
            for j in range(x.shape[1]):
                key = (node - first) * (n_bins + 1) + b[:, j]
                gs = np.bincount(key, g, n * (n_bins + 1)).reshape(n, -1).cumsum(axis=1)
                hs = np.bincount(key, h, n * (n_bins + 1)).reshape(n, -1).cumsum(axis=1)
                gain = gs**2 / (hs + l2) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + l2) - gs[:, -1:] ** 2 / (hs[:, -1:] + l2)
                at = gain[:, :-1].argmax(axis=1)
                better = gain[np.arange(n), at] > best + 1e-9
                best = np.where(better, gain[np.arange(n), at], best)
                feature[first : first + n] = np.where(better, j, feature[first : first + n])
                cut[first : first + n] = np.where(better, at, cut[first : first + n])
            node = 2 * node + 1 + (b[np.arange(len(x)), feature[node]] > cut[node])
        leaf = node - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2)
        model.trees.append((feature, cut, value))
        f += value[leaf]
    return model


def _matrix(features: list[list[float]], allowed: list, blocked: list, share: float, times: int = 1) -> np.ndarray:
    """Features, smoothed shares of blocked urls and log counts; both kinds of labels weigh the same in sum."""
    x = np.array(features, float).reshape(len(features), N_LEXICAL)
    a, b = (np.array(m, float).reshape(len(features), N_SUFFIX) * times for m in (allowed, blocked))
    a, b = a * (0.5 / (1 - share)), b * (0.5 / share)
    more = np.stack([(b + 2) / (a + b + 4), np.log1p(a + b)], axis=2)
    return np.hstack([x, more.reshape(len(features), 2 * N_SUFFIX)])


@dataclass
class TableModel:
    """Trees, and the share of blocked urls among the labelled ones of the whole table."""

    trees: Boosted | None
    share: float = 0.5
    only: str = "allow"

    def verdicts(self, features: list[list[float]], allowed: list, blocked: list) -> np.ndarray:
        if self.trees is None:
            return np.full(len(features), self.only, object)
        return np.where(self.trees.margin(_matrix(features, allowed, blocked, self.share)) >= 0, "block", "allow").astype(object)


COUNTS = ["a", "b", "ha", "hb"]
A, B = [f"a{i}" for i in range(N_SUFFIX)], [f"b{i}" for i in range(N_SUFFIX)]


def _features(batch: pa.RecordBatch) -> list[list[float]]:
    return [lexical(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("url", "host", "path")), strict=True)]


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_features(batch), pa.list_(pa.float64())), *batch.columns[3:]], ["features", *batch.schema.names[3:]])


def _judge(model: TableModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1) for names in (A, B))
        verdict = model.verdicts(_features(batch), a, b)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path", "rule")), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])


def suffix_counts(parsed: DataFrame) -> Spilled:
    """A row for each longest suffix of parsed(url, host, path, ruled).

    a0 to a2, b0 to b2: how many labelled urls with the suffix, by length, were allowed and blocked;
    ha0, ...: those in the half that the trees don't learn from; open: urls without a rule.
    """
    b, half = F.col("ruled") == "block", ~F.col("learns")
    ruled = F.col("ruled").isNotNull()
    own = parsed.select(suffixes(F.col("host"), F.col("path"))[-1].alias("suffix"), "ruled", "learns")
    sums = own.groupBy("suffix").agg(
        F.count_if(ruled & ~b).alias("a"), F.count_if(ruled & b).alias("b"), F.count_if(ruled & ~b & half).alias("ha"), F.count_if(ruled & b & half).alias("hb"),
        F.count_if(~ruled).alias("open"),
    )
    k0, k1, _ = shorter(F.col("suffix"))
    own = {c: f"{c}2" for c in COUNTS}
    done = Spilled(sums.withColumnsRenamed(own).withColumns({"k0": k0, "k1": k1}), "suffixes")
    for i in range(2):
        summed = done.df.groupBy(f"k{i}").agg(*(F.sum(own[c]).alias(f"{c}{i}") for c in COUNTS), F.count("*").alias("suffixes"))
        before, done = done, Spilled(join_hot(done.df, summed, [f"k{i}"], "suffixes").drop("suffixes"), "suffixes")
        before.drop()
    return done


def learn(parsed: DataFrame, counts: DataFrame, n_train: int = N_TRAIN) -> TableModel:
    """From parsed(url, host, path, ruled, learns), the rows that a rule has decided."""
    n_blocked, n_allowed = counts.agg(F.sum("b2"), F.sum("a2")).first()
    if not n_blocked or not n_allowed:
        return TableModel(None, only="block" if n_blocked else "allow")
    share = n_blocked / (n_blocked + n_allowed)
    rows = parsed.where("ruled is not null and learns").select("url", "host", "path", (F.col("ruled") == "block").alias("blocked"), F.xxhash64("url").alias("place"))
    n_urls = rows.agg(F.approx_count_distinct("url")).first()[0]
    part = min(1.0, 2 * n_train / max(1, n_urls))
    few = rows.where(F.col("place") <= int((2 * part - 1) * (2**63 - 1))) if part < 1 else rows
    first = few.dropDuplicates(["url"]).orderBy("place", "url").limit(n_train).withColumn("suffix", suffixes(F.col("host"), F.col("path"))[-1])
    halves = counts.select("suffix", *(F.col(f"h{c}").alias(c) for c in (*A, *B)))
    seen = first.join(halves, "suffix").select("url", "host", "path", "blocked", "place", *A, *B)
    types = ", ".join(f"{c} long" for c in (*A, *B))
    sample = seen.mapInArrow(_learned, f"features array<double>, blocked boolean, place long, {types}").collect()
    sample = sorted(sample, key=lambda r: (r.place, r.features, r.blocked))
    y = np.array([r.blocked for r in sample], float)
    if len(set(y)) < 2:
        return TableModel(None, only="block" if share >= 0.5 else "allow")
    # a third of the trees' rows are shown as if their suffixes were new, as those of other urls will be
    a, b = ([[r[c] if i % 3 else 0 for c in cs] for i, r in enumerate(sample)] for cs in (A, B))
    return TableModel(boost(_matrix([r.features for r in sample], a, b, share, 2), y), share)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, n_train: int = N_TRAIN) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of pages(page_id, url)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    host, path = split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "url", "host", "path", name.alias("rule"), verdict.alias("ruled"), (F.pmod(F.xxhash64("url", F.lit(1)), F.lit(2)) == 0).alias("learns"))
    counts = suffix_counts(rows).df
    model = learn(rows, counts, n_train)
    open_ = rows.where("ruled is null").select("page_id", "url", "host", "path", "rule", suffixes(F.col("host"), F.col("path"))[-1].alias("suffix"))
    known = join_hot(open_, counts.select("suffix", "open", *A, *B), ["suffix"], "open").drop("suffix", "open")
    judged = known.mapInArrow(lambda b: _judge(model, b), "page_id long, host string, path string, rule string, verdict string")
    return rows.where("ruled is not null").select("page_id", "host", "path", "rule", F.col("ruled").alias("verdict")).unionByName(judged)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
