import random
import re

import numpy as np

from candleforge.llm import jaccard
from candleforge.llm.jaccard import _packed, _unpacked, boundary, near_duplicates, overlap_matrix, overlaps

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    out = {}
    for a, (i, _) in enumerate(rows):
        out[i] = (len(sets[a]), None if i is None else min(rows[b][0] for b in range(len(rows)) if find(b) == find(a)))
    return out


def cases():
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = []
    for _ in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 5, 8, 9, 10, 12, 15, 20, 60, 150]))]
        for _ in range(rng.choice([1, 2, 3, 6])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.choice([0, 1])] = [f"e{rng.randrange(10**6)}"] * rng.choice([0, 1])
            rows.append((len(rows), rng.choice([" ", "\n"]).join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    rows += [(1000 + k, passage + " " + " ".join(f"x{k}-{j}" for j in range(k % 9))) for k in range(60)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (None, passage), (2006, "big " * 5000)]
    return rows


def check(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows)


def test_against_brute_force(spark):
    check(spark, cases())


def test_other_orders_and_blocks_change_nothing(spark, monkeypatch):
    for name, value in (("SHORT", 2), ("BLOCK", 7), ("MOST_BROADCAST", 0), ("MOST_HEAVY", 50)):
        monkeypatch.setattr(jaccard, name, value)
    check(spark, cases())


def test_repeats_empty_and_clashes(spark):
    df = spark.createDataFrame([(5, "a b c d e f", 1), (5, "a b c d e f", 2), (4, "a b c d e f", 3)], "doc_id long, text string, id long")
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(df).collect()) == [(4, 4), (5, 4), (5, 4)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_parts():
    assert overlaps(4, 80) == [4] and overlaps(5, 80) == [4, 5] and overlaps(10, 80) == [8, 9, 10]
    assert boundary({5: 10, 9: 10, 30: 1000}, 80) == 12 and 6 <= boundary({5: 10, 9: 10, 10: 500, 30: 1000}, 80) <= 10
    rng = np.random.default_rng(1)
    x = np.sort(rng.integers(0, 1 << 32, 500).astype(np.uint32))
    assert (_unpacked(_packed(x)) == x).all()
    sets = [np.unique(rng.integers(0, 50, 30).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = overlap_matrix(sets, most=60)
    assert all(got[i][j] == want[i][j] for i in range(9) for j in range(9) if i != j)
