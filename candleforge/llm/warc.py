"""A deterministic sharded WARC writer, and a reader for its archives.

Records are range-sorted by page id. The ranges are cut where the running sum of payload bytes over the
ids passes a multiple of the shard size (a prefix sum: sums by range of ids, then within each range), not
by a sample, so the same table gives the same shards, files and bytes on any cluster. Shards have
`shard_bytes`, or more where there would be over MOST_SHARDS of them. A task writes its shards' records
as gzip members into files that roll at `roll_bytes` of compressed size. Headers, record ids and digests are made anew from the row; dates
are a parameter.

Of records with equal payloads of at least MIN_REVISIT bytes, the one with the smallest page id holds
the payload; the others are revisit records that name it.

Commit: a file is written under a temporary name and renamed when whole. A task's manifest rows (file,
records, bytes, digest) go through Spark's committer, and readers read what the manifest names, so
that lost or repeated tasks leave nothing that counts.

Nulls, ties and odd rows: a null html is an empty payload; a null url has no target header. Rows
without a page id are written first, without that header, dealt over shards of their own by digest; they are revisits if a row with an id has
their payload, else responses. Of rows that repeat both id and payload the first by url is the
response, if it is one at all. Only page_id, url and html are read. An empty table gives no files and
an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleforge.llm.shared import Spilled, join_hot, new_folder

MIN_REVISIT = 100
SHARD_BYTES, ROLL_BYTES = 16 << 20, 8 << 20
MOST_SHARDS = 100_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "shard long, file string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page/{page_id}/{digest}')}>"


def _member(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    digest = hashlib.sha256(block).hexdigest()
    head = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha256:{digest}"), ("Content-Length", len(block))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _target(url: str | None) -> str | None:
    """Control characters and spaces would end the header: they are percent-encoded."""
    return None if url is None else "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def page_member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [
        ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", _target(url)), ("X-Page-Id", page_id),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", len(payload)), ("Content-Type", "application/http; msgtype=response"),
    ]
    if not revisit:
        return _member("response", headers, head + payload)
    more = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page-Id", refers_to)]
    return _member("revisit", headers + more, head)


class _Files:
    """Rolls one shard's files; each gets its name when it is whole."""

    def __init__(self, folder: str, roll_bytes: int, date: str):
        from pyarrow.fs import FileSystem

        self.fs, self.root = FileSystem.from_uri(folder)
        self.roll_bytes, self.date = roll_bytes, date
        self.out = None
        self.shard = self.n = -1

    def write(self, shard: int, member: bytes) -> Iterator[tuple]:
        if self.out and (shard != self.shard or self.bytes >= self.roll_bytes):
            yield self.close()
        if self.out is None:
            self.n = self.n + 1 if shard == self.shard else 0
            self.shard, self.records, self.bytes, self.sha = shard, 0, 0, hashlib.sha256()
            self.name = f"shard-{shard:06d}-{self.n:05d}.warc.gz"
            self.tmp = f"{self.root}/_tmp/{self.name}.{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.root}/_tmp", recursive=True)
            self.out = self.fs.open_output_stream(self.tmp, compression=None)
            info = f"software: candleforge\r\nformat: WARC File Format 1.1\r\nfile: {self.name}\r\n".encode()
            self._put(_member("warcinfo", [("WARC-Record-ID", _record_id(None, self.name)), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))
        self._put(member)
        self.records += 1

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        to = f"{self.root}/{self.name}"
        from pyarrow.fs import FileType

        if self.fs.get_file_info(to).type != FileType.NotFound:  # of an earlier attempt, with the same bytes
            self.fs.delete_file(to)
        self.fs.move(self.tmp, to)
        return self.shard, self.name, self.records, self.bytes, self.sha.hexdigest()


def _write(folder: str, roll_bytes: int, date: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files, rows = _Files(folder, roll_bytes, date), []
    last, revisits, written = object(), {}, set()
    for batch in batches:
        cols = [c.cast(pa.binary()) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c for c in batch.columns]
        for shard, page_id, is_page, digest, refers_to, url, html in zip(*(c.to_pylist() for c in cols), strict=True):
            if page_id != last:
                last, revisits, written = page_id, {}, set()
            if not is_page:
                revisits[digest] = refers_to
                continue
            payload = html or b""
            at, revisit = revisits.get(digest), digest in revisits
            if not revisit and page_id is not None and len(payload) >= MIN_REVISIT and digest in written:
                at, revisit = page_id, True
            written.add(digest)
            rows += files.write(shard, page_member(page_id, None if url is None else url.decode(), payload, at, revisit, date))
    if files.out:
        rows.append(files.close())
    columns = list(zip(*rows, strict=True)) or [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["shard", "file", "records", "bytes", "sha256"])


def shard_bounds(heads: DataFrame, shard_bytes: int) -> list[int]:
    """The ids, in order, at which the second shard and those after it begin: at most one a shard comes to the driver.

    heads has page_id and n, the bytes. An id is in the shard in which its first byte would be. Which ranges
    Spark makes for the sums has no say in that.
    """
    ranged = heads.where("page_id is not null").groupBy("page_id").agg(F.sum("n").alias("n")).repartitionByRange("page_id")
    ranged = Spilled(ranged.withColumn("part", F.spark_partition_id()), "id-bytes")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    ahead = ranged.df.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("part").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.df.join(F.broadcast(ahead), "part").withColumn("at", F.col("ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    firsts = placed.groupBy(F.floor(F.col("at") / shard_bytes).alias("shard")).agg(F.min("page_id").alias("page_id")).collect()
    ranged.drop()
    return sorted(r.page_id for r in firsts)[1:]


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write pages(page_id, url, html) to the folder; return the manifest."""
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    heads = Spilled(pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("n")), "heads")
    same = heads.df.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1 and refers_to is not null")
    revisits = join_hot(heads.df, same, ["digest"], "copies").where("page_id is null or page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()
    total, without = heads.df.agg(F.sum("n"), F.sum(F.when(F.col("page_id").isNull(), F.col("n")))).first()
    shard_bytes = max(shard_bytes, -(-(total or 0) // MOST_SHARDS))
    bounds = np.array(shard_bounds(heads.df, shard_bytes), np.int64)
    n_null = 0 if without is None else without // shard_bytes + 1  # shards of rows without an id

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), "right"))

    # a null among them would make the ids floats, which know no numbers above 2**53 for sure
    of_id = place(F.coalesce("page_id", F.lit(0).cast("long"))) + n_null
    shard = F.when(F.col("page_id").isNotNull(), of_id).otherwise(F.pmod(F.xxhash64("digest"), F.lit(max(1, n_null))))
    columns = ["page_id", "is_page", "digest", "refers_to", "url", "html"]
    rows = pages.withColumns({"is_page": F.lit(True), "digest": F.sha2(html, 256), "refers_to": F.lit(None).cast("long")}).select(*columns)
    rows = rows.unionByName(revisits.withColumns({"is_page": F.lit(False), "url": F.lit(None).cast("string"), "html": F.lit(None).cast("string")}).select(*columns))
    rows = rows.withColumn("shard", shard).repartitionById(n_null + len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "page_id", "is_page", "digest", "url")
    done = rows.select("shard", *columns).mapInArrow(lambda b: _write(folder, roll_bytes, date, b), MANIFEST)
    done.write.parquet(f"{folder}/manifest")
    heads.drop()
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record here: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            k, _, v = line.decode().partition(": ")
            headers[k] = v
        yield headers, stream.read(int(headers["Content-Length"]))


def _read(folder: str, payloads: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    fs, root = FileSystem.from_uri(folder)
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows, held = [], 0
            with fs.open_input_stream(f"{root}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for h, block in parse(stream):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    if h["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                        raise ValueError(f"{name}: a block's digest is wrong")
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest, n = h["WARC-Payload-Digest"].removeprefix("sha256:"), int(h["X-Payload-Length"])
                    if h["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (n, digest):
                        raise ValueError(f"{name}: a payload's digest or length is wrong")
                    number = lambda k, h=h: int(h[k]) if k in h else None
                    rows.append((number("X-Page-Id"), h.get("WARC-Target-URI"), h["WARC-Type"], n, digest, number("X-Refers-To-Page-Id"), payload if payloads and h["WARC-Type"] == "response" else None))
                    held += len(payload)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files in the manifest. A revisit's payload is null: it lies with refers_to."""
    n = max(1, min(10_000, manifest.count()))
    return manifest.select("file").repartition(n).mapInArrow(lambda b: _read(folder, payloads, b), RECORD)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(manifest, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first IS NULL OR f.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100
"""
