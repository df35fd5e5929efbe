import random

import numpy as np
from pyspark.sql import functions as F

from candleforge.llm import urls
from candleforge.llm.urls import N_SUFFIX, RULES, filter_urls, learn, lexical, suffix_counts


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda x: len(x[0]), default=(None, None))


URLS = [
    None, "", "no scheme", "http://", "http://COM/", "http://com", "https://www.Example.com/en/x", "http://a.www.example.com/en/", "http://m.example.com/en/1?x=/es/", "http://example.com/en",
    "http://a.net/es/?q", "http://a.net/fr/#/es/", "http://net/fr/", "http://xnet/fr/", "http://a.org/fr/://b", "http://É.com/ü", "ftp://x.net?/es/", "http://a.com:80/en/", "a://b://c.net/es/", "http://x.com/\n/en/", "http://" + "y" * 9000,
]


def test_hosts_paths_and_rules(spark):
    got = filter_urls(spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")).collect()
    for r in got:
        host, path, (rule, verdict) = brute(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def made(n, seed=1):
    """(url, host, path, kind) of 20 domains of either kind; lexical features tell the kinds."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        bad, k = rng.random() < 0.5, rng.randrange(20)
        host = f"{rng.choice(['spam', 'buy'])}-{rng.randrange(10**6)}.s{k:02d}.net" if bad else f"news{rng.choice('abc')}.g{k:02d}.org"
        path = "/" + "/".join(rng.choice(["a", "item", "page"]) for _ in range(rng.randrange(1, 4)))
        out.append((f"http://{host}{path}" + "?a=1&b=2" * bad, host, path, bad))
    return out


HALF = [r for k in range(10) for r in [(f"s{k:02d}.net", "/", "block"), (f"g{k:02d}.org", "/", "allow")]]


def test_accuracy_on_domains_without_a_rule(spark):
    rows = made(2000)
    got = filter_urls(spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id long, url string"), HALF).where("rule is null").collect()
    assert len(got) > 800 and sum((r.verdict == "block") == rows[r.page_id][3] for r in got) >= 0.95 * len(got)


def walk(model, x):
    """The margin of one row, a node at a time."""
    total = model.prior
    for feature, cut, value in model.trees:
        node = 0
        for _ in range(model.depth):
            j = feature[node]
            node = 2 * node + 1 + int(sum(e < x[j] for e in model.edges[j]) > cut[node])
        total += value[node - 2**model.depth + 1]
    return total


def parts_of(host, path):
    labels = host.split(".")
    first = [x for x in path.split("/") if x][:1]
    return [labels[-1], ".".join(labels[-2:]), ".".join(labels[-2:]) + "/" + "".join(first)]


def test_verdicts_against_a_plain_walk(spark, monkeypatch):
    models = []
    monkeypatch.setattr(urls, "learn", lambda *a: models.append(learn(*a)) or models[-1])
    rows = [(i, r[0], r[1], r[2]) for i, r in enumerate(made(400, 5))]
    got = filter_urls(spark.createDataFrame([(i, u) for i, u, _, _ in rows], "page_id long, url string"), HALF).collect()
    assert len(got) == 400
    rule = {r.page_id: r.verdict if r.rule else None for r in got}
    counts = {}
    for i, _, host, path in rows:
        for k, suffix in enumerate(parts_of(host, path)):
            if rule[i]:
                counts.setdefault((k, suffix), [0, 0])[rule[i] == "block"] += 1
    share = sum(v == "block" for v in rule.values()) / sum(v is not None for v in rule.values())
    open_ = 0
    for r in got:
        if r.rule is None:
            _, url, host, path = rows[r.page_id]
            more = []
            for k, suffix in enumerate(parts_of(host, path)):
                a, b = counts.get((k, suffix), (0, 0))
                a, b = a * 0.5 / (1 - share), b * 0.5 / share
                more += [(b + 2) / (a + b + 4), np.log1p(a + b)]
            assert r.verdict == ("block" if walk(models[0].trees, lexical(url, host, path) + more) >= 0 else "allow")
            open_ += 1
    assert open_ > 100


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "http://a.com/", "z"), (1, "http://a.com/", "z"), (None, None, "q")], "page_id long, url string, rule string")
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in filter_urls(df).collect() if r.page_id) == [(1, "com/", "allow")] * 2
    assert filter_urls(df.limit(0)).count() == 0


def test_suffixes_are_counted_over_all_urls(spark):
    rows = [(h, p, v) for i in range(300) for h, p, v in [(f"a.d{i}.net", "/es/x", "block"), (f"b.d{i}.net", "/fr/x", "block"), (f"c{i}.com", "/", "allow"), (f"e.d{i}.net", "/de/", None)]]
    parsed = spark.createDataFrame([(f"http://{h}{p}", h, p, v, i % 2 == 0) for i, (h, p, v) in enumerate(rows)], "url string, host string, path string, ruled string, learns boolean")
    got = {r.suffix: r for r in suffix_counts(parsed).df.collect()}
    assert all([(r[f"a{k}"], r[f"b{k}"]) for k in range(N_SUFFIX)] == [(0, 600), (0, 2), (0, 0)] and r.open == 1 for i in range(300) for r in [got[f"d{i}.net/de"]])
    assert (got["c5.com/"].a0, got["c5.com/"].a1, got["c5.com/"].hb0) == (300, 1, 0) and got["d0.net/es"].hb2 + got["d1.net/es"].hb2 == 0


def test_hot_suffixes_and_clashing_columns(spark):
    rows = [(i, f"http://u{i}.net/de/", "x", 1) for i in range(3000)] + [(5000 + i, f"http://a.net/{p}/", "x", 1) for i, p in enumerate(["es", "fr"] * 20)] + [(9000 + i, "http://b.com/", "x", 1) for i in range(40)]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string, suffix string, open int"))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and got.count() == len(rows) == got.select("page_id").distinct().count()
    assert got.where(F.col("verdict").isNull()).count() == 0


def test_copies_of_a_url_take_one_place(spark):
    hot = [(i, "http://hot.com/") for i in range(3000)]
    cold = [(3000 + i, f"http://a{i}.net/es/") for i in range(60)] + [(4000 + i, f"http://b{i}.com/") for i in range(60)] + [(5000, "http://a1.net/de/")]
    got = filter_urls(spark.createDataFrame(hot + cold, "page_id long, url string"), n_train=60).where("page_id = 5000").collect()
    assert [r.verdict for r in got] == ["block"]
