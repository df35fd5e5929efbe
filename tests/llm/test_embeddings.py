import numpy as np

from candleforge.llm import embeddings
from candleforge.llm.embeddings import near_vectors, plan_tables


def brute(rows, kind=np.float32):
    out, n = {}, len(rows)
    v = []
    for i, e, label in rows:
        ok = e is not None and label is not None and i is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e)
        v.append(np.array(e, kind).astype(float) if ok else None)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for a in range(n):
        for b in range(n):
            if a != b and v[a] is not None and v[b] is not None and rows[a][2] == rows[b][2] and len(v[a]) == len(v[b]):
                if v[a] @ v[b] / np.sqrt(v[a] @ v[a]) / np.sqrt(v[b] @ v[b]) >= 0.93:
                    links[a] += 1
                    root[max(find(a), find(b))] = min(find(a), find(b))
    for a in range(n):
        members = [rows[b][0] for b in range(n) if find(b) == find(a)]
        c = min(members) if members[0] is not None else None
        out[rows[a][0]] = (links[a], c, rows[a][0] == c)
    return out


def cases():
    rng = np.random.default_rng(1)
    rows = []
    for k in range(60):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 8)):
            rows.append((len(rows), (centre + rng.standard_normal(16) * rng.choice([0, 0.1, 0.3])).astype(np.float32).tolist(), int(k % 3)))
    hub = rng.standard_normal(16)
    rows += [(1000 + i, (hub + rng.standard_normal(16) * 0.05).astype(np.float32).tolist(), 1) for i in range(40)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] + [1.0] * 15, 1), (2003, [None] * 16, 1), (2004, hub.tolist(), None), (2005, hub.tolist()[:8], 1), (2006, [], 1), (2007, [float("inf")] * 16, 1), (None, hub.tolist(), 1)]
    return rows


def check(spark, rows, name="float", kind=np.float32):
    got = near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{name}>, label int"))
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == brute(rows, kind)


def test_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(i, e, label) for i, e, label in cases() if i is not None and i % 3 == 0]
    centre = rng.standard_normal(16)
    for k, scale in enumerate((1e100, 1e-100, 1.0, 3e-50)):  # no floats
        rows += [(5000 + 10 * k + j, (scale * (centre + 0.02 * rng.standard_normal(16))).tolist(), 2) for j in range(4)]
    check(spark, rows, "double", np.float64)
    edge = [[1.7e308, 1.0], [1.7e308, 2.0], [5e-324, 0.0], [0.0, 1e-300]]
    got = near_vectors(spark.createDataFrame([(i, e, 1) for i, e in enumerate(edge)], "vec_id long, embedding array<double>, label int"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (0, 3)}


def test_repeated_ids_and_null_labels(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.99, 0.05, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a, 1), (1, c, 1), (2, b, 1), (3, c, 1), (4, a, None), (4, a, None), (5, a, 2), (None, a, 1), (6, None, 1), (6, None, None)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect())
    assert got == [(0, 0, 0, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (6, 0, 6, True)]


def test_against_brute_force(spark):
    check(spark, cases())


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    check(spark, cases())


def test_recall_bound():
    for n in (10, 10**5, 10**9):
        bits, tables = plan_tables(n)
        p = 1 - np.arccos(0.93) / np.pi
        assert (1 - p**bits) ** tables <= 1e-3


def test_empty_and_clashes(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    df = spark.createDataFrame([(1, [1.0], 1, 5), (2, [1.0], 1, 6)], "vec_id long, embedding array<float>, label int, cls long")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect()) == [(1, 1, 1), (2, 1, 1)]
