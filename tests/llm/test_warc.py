import gzip
import hashlib
import random
from urllib.parse import urlparse

from candleforge.llm.shared import new_folder
from candleforge.llm.warc import parse, read_archives, shard_bounds, write_archives


def pages():
    rng = random.Random(1)
    same, small = "<p>" + "same " * 60, "tiny"
    out = [(i, f"http://h/{i}", rng.choice([same, small, f"<b>{i}</b>" + "é" * rng.randrange(400)])) for i in range(1, 120)]
    return out + [(500, None, None), (501, "http://x/ y\r\nEvil: 1", ""), (None, "http://n", same), (10**12, "u", same), (502, "u", "\r\n\r\nWARC/1.1\r\n" + "z" * 200)]


def test_round_trip(spark):
    data = pages()
    folder = new_folder(spark, "warc-test")
    manifest = write_archives(spark.createDataFrame(data, "page_id long, url string, html string"), folder, shard_bytes=4000, roll_bytes=2000)
    got = {r.page_id: r for r in read_archives(manifest, folder).collect()}
    assert len(got) == len(data) == manifest.groupBy().sum("records").first()[0]
    first = {}
    for i, _, html in sorted((x for x in data if x[0] is not None), key=lambda x: x[0]):
        first.setdefault(html or "", i)
    for i, _, html in data:
        r, body = got[i], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        revisit = len(body) >= 100 and first[html or ""] != i
        assert (r.record_type, r.refers_to) == (("revisit", first[html or ""]) if revisit else ("response", None))
        assert bytes(r.payload or b"") == (b"" if revisit else body)


def test_files_roll_and_are_deterministic(spark):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string")
    a, b = (write_archives(x, new_folder(spark, "warc-test"), 4000, 2000).collect() for x in (df, df.repartition(7)))
    assert sorted(a) == sorted(b) and len(a) > 3
    assert len({r.shard for r in a}) > 1


def test_only_the_manifest_counts(spark):
    folder = new_folder(spark, "warc-test")
    manifest = write_archives(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), folder)
    path = urlparse(folder).path
    name = manifest.first().file
    records = list(parse(gzip.open(f"{path}/{name}")))
    assert [h["WARC-Type"] for h, _ in records] == ["warcinfo", "response"]
    with gzip.open(f"{path}/stray.warc.gz", "wb") as f:
        f.write(b"no archive")
    assert read_archives(manifest, folder).count() == 1


def test_repeats_and_empty(spark):
    folder = new_folder(spark, "warc-test")
    body = "y" * 150
    rows = [(4, "b", body), (4, "a", body), (9, "c", body)]
    manifest = write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    got = sorted((r.page_id, r.url, r.record_type, r.refers_to) for r in read_archives(manifest, folder).collect())
    assert got == [(4, "a", "response", None), (4, "b", "revisit", 4), (9, "c", "revisit", 4)]
    folder = new_folder(spark, "warc-test")
    manifest = write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert read_archives(manifest, folder).count() == 0


def test_large_ids_beside_null_ones(spark):
    big, body = 1 << 60, "<p>" + "word " * 40
    rows = [(big + i, f"u{i}", f"{body}{i // 2}", 7) for i in range(200)] + [(None, "n", body + "0", 7), (None, "m", body + "0", 7), (None, None, None, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, shard long").withColumnRenamed("shard", "digest").coalesce(1)
    folder = new_folder(spark, "warc-test")
    got = read_archives(write_archives(df, folder, shard_bytes=3000), folder).collect()
    assert len(got) == len(rows)
    want = {big + i: None if i % 2 == 0 else big + i - 1 for i in range(200)}
    assert {r.page_id: r.refers_to for r in got if r.page_id} == want
    assert sorted((r.url or "", r.record_type, r.refers_to or 0) for r in got if r.page_id is None) == [("", "response", 0), ("m", "revisit", big), ("n", "revisit", big)]


def test_bounds_are_exact_for_any_ids(spark):
    rows = [(i * i * i, 5 + i % 7) for i in range(30_000)] + [(9, 10_000), (9, 1)]
    heads = spark.createDataFrame(rows, "page_id long, n long")
    at, firsts, total = {}, {}, 0
    for i, n in sorted(rows):
        at.setdefault(i, total)
        total += n
    for i in sorted(at):
        firsts.setdefault(at[i] // 500, i)
    want = sorted(firsts.values())[1:]
    assert len(want) > 400 and shard_bounds(heads.repartition(5), 500) == want


def test_long_html(spark):
    folder = new_folder(spark, "warc-test")
    rows = [(1, "u", "é" * 2_000_000), (2, "v", "é" * 2_000_000), (3, "w", "short")]
    got = {r.page_id: r for r in read_archives(write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder), folder).collect()}
    assert (got[1].payload_bytes, got[2].refers_to, len(got[1].payload), got[3].record_type) == (4_000_000, 1, 4_000_000, "response")
