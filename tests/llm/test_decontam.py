import random
import re

import numpy as np

from candleforge.llm import decontam
from candleforge.llm.decontam import FMIndex, find_leaks, merged

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n and i is not None else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def test_index_against_search():
    rng = np.random.default_rng(1)
    for _ in range(30):
        s = rng.integers(0, 4, rng.integers(1, 200))
        s[-1] = 0
        index = FMIndex(s, 3)
        for n in (1, 2, 4):
            patterns = rng.integers(1, 4, (20, n))
            which, lo, hi = index.search(patterns)
            got = {k: sorted(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(which.tolist(), lo, hi, strict=True)}
            want = {k: [i for i in range(len(s) - n + 1) if (s[i : i + n] == p).all()] for k, p in enumerate(patterns)}
            assert got == {k: v for k, v in want.items() if v}


def cases():
    rng = random.Random(7)
    vocabulary = ["a", "B", "ccc", "é", "9", "Zz"]
    say = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 9, 10, 12, 30]))) for i in range(8) if i] + [(20, None), (21, "..."), (None, "a"), (5, say(14))]
    items = [(i, t) for i, t in items if not t or len(WORD.findall(t)) > 2]
    docs = [(i, say(rng.randrange(0, 80))) for i in range(60)]
    docs += [(100 + k, f"{say(5)} {t} {say(3)}") for k, (i, t) in enumerate(items) if t] + [(3, "a"), (None, items[0][1]), (300, None), (301, ""), (302, items[0][1] * 3000)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r.doc_id, r.n_words, sum(s.b - s.a for s in r.spans), r.items) for r in found.collect()]
    assert sorted(got, key=repr) == brute(docs, items)


def test_blocks_change_nothing(spark, monkeypatch):
    docs, items = cases()
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 40)
    monkeypatch.setattr(decontam, "PASS_BYTES", 160)
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r.doc_id, r.n_words, sum(s.b - s.a for s in r.spans), r.items) for r in found.collect()]
    assert sorted(got, key=repr) == brute(docs, items)


def test_cut_and_empty(spark):
    docs = spark.createDataFrame([(1, "é keep. One two three; rest", "x"), (2, None, "y")], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(1, "one TWO three")], "item_id long, text string")
    cut = dict(find_leaks(docs, bench, cut=True).select("doc_id", "text").collect())
    assert cut == {1: "é keep. ; rest", 2: None}
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_merged():
    s = lambda a, b: {"a": a, "b": b, "from": a * 10, "to": b * 10}
    assert merged([s(5, 9), s(0, 3), s(3, 5), s(20, 21)]) == [s(0, 9), s(20, 21)]
