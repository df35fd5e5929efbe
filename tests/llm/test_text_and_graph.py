import random
import re

import numpy as np
import pyarrow as pa

from candleforge.llm.graph import components
from candleforge.llm.text import buffers, shards, shingles, words

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def test_words_match_the_patterns():
    rng = random.Random(3)
    texts = [None, "", " ", "É", "a"] + ["".join(rng.choice("aAbé 1.\n\t\x85\xa0-Ω") for _ in range(rng.randrange(60))) for _ in range(300)]
    for kind, pattern in (("alnum", ALNUM), ("spaced", SPACED)):
        h, doc, at = words(*buffers(pa.array(texts, pa.string())), kind)
        seen = {}
        for i, t in enumerate(texts):
            found = pattern.findall(lower(t or ""))
            assert len(found) == at[i + 1] - at[i]
            for w, x in zip(found, h[at[i] : at[i + 1]].tolist(), strict=True):
                assert seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen)
        assert (np.diff(doc) >= 0).all()


def test_sliced_columns_and_shards():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa bb", None, "cc", "dd ee ff"])], ["text"])
    h, _, at = words(*buffers(batch.slice(2, 2).column(0)), "spaced")
    assert at.tolist() == [0, 1, 4]
    assert sum(b.num_rows for b in shards(iter([batch]), "text", 3)) == 4


def test_shingles():
    h, _, at = words(*buffers(pa.array(["a b c d e f", "a b c d e a b c d e", "a b", "a b", "", "A B C D E F"])), "spaced")
    s = shingles(h, at)
    assert [len(x) for x in s] == [2, 5, 1, 1, 0, 2]
    assert (s[2] == s[3]).all() and (s[0] == s[5]).all()


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(None, 3), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
