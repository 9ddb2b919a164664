"""WARC archives of pages, and their capture index by external merging.

Pages are written as WARC/1.1 records, each a gzip member of its own; a payload that another record holds
is written as a revisit. Reading the archives back gives each file's captures, sorted, as a run cut into
key ranges. Runs are merged range by range with a loser tree, at most FAN_IN at a time and reading blocks
of each, level on level, until every range is one sequence: the capture history in the order of URL key,
time and page. Files go through pyarrow.fs, so any store it knows will do; only files that a finished
task has reported are ever read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from base64 import b32encode
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.plans.durable import checkpointed, new_folder

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
FAN_IN = 32
#: Key ranges come from a sample of at most this many pages, chosen by hash; each range stands for RANGE_ROWS pages or so.
SAMPLE_ROWS, RANGE_ROWS = 20_000, 10_000
FIRST_TIME = datetime(2024, 1, 1, tzinfo=UTC)
CAPTURE = "range int, position long, url_key string, time string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long"


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host labels reversed, lower case, no scheme, fragment or leading www."""
    try:
        u = urlsplit((url or "").strip())
        host = (u.hostname or "").removeprefix("www.")
        port = f":{u.port}" if u.port and u.port not in (80, 443) else ""
    except ValueError:
        return quote((url or "").lower(), safe=":/?&=#%.,;+~@!*()-_")
    key = ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")
    return quote(key.lower(), safe=":/?&=#%.,;+~@!*()-_")


def capture_time(page_id: int | None) -> datetime:
    """pages has no times: its ids are taken as seconds, in a cycle of some 30 years."""
    return FIRST_TIME + timedelta(seconds=(page_id or 0) % (1 << 30))


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = hashlib.sha1(payload).digest()
    block = head if revisit else head + payload
    fields = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Target-URI: {quote(url or '', safe=':/?&=#%.,;+~@!*()-_[]')}",
        f"WARC-Date: {capture_time(page_id):%Y-%m-%dT%H:%M:%SZ}", f"WARC-Payload-Digest: sha1:{b32encode(digest).decode()}", "Content-Type: application/http; msgtype=response", f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if revisit:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join([*fields, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _archive_writer(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(uri)
        store.create_dir(root, recursive=True)
        out, name, size, n = None, "", 0, 0
        done: list[tuple] = []
        for batch in batches:
            for page, url, html, refers, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, size, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(name, compression=None)
                data = gzip_member(warc_record(page, url, (html or "").encode("utf-8", "replace"), refers, revisit))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((name, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], ["path", "records", "bytes"])

    return run


def gzip_members(read, block: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member; read(n) gives the next n bytes at most."""
    at, rest = 0, b""
    while True:
        d, start, parts = zlib.decompressobj(31), at, []
        while not d.eof:
            data = rest or read(block)
            if not data:
                if parts:
                    raise EOFError("archive ends inside a record")
                return
            parts.append(d.decompress(data))
            rest = d.unused_data
            at += len(data) - len(rest)
        yield start, b"".join(parts)


def parsed_record(data: bytes) -> dict:
    """Fields of a record; of a response, the payload is checked against its digest and length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in (head.decode() + "\r\n").split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(http.rsplit(b"Content-Length: ", 1)[1])
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != n or b32encode(hashlib.sha1(payload).digest()).decode() != told):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    from base64 import b32decode

    number = lambda k: int(fields[k]) if fields.get(k, "").lstrip("-").isdigit() else None
    return {"url": fields.get("WARC-Target-URI", ""), "time": fields["WARC-Date"], "page_id": number("X-Page-Id"), "bytes": n, "digest": b32decode(told).hex(), "type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page")}


def _order(c: list) -> tuple:
    return c[0], c[1], c[2] is not None, c[2] or 0, c[7], c[8]


class LoserTree:
    """Merges k sorted iterators: each inner node keeps the loser of its match, so that the next smallest takes log k comparisons."""

    def __init__(self, sources: Iterable[Iterator], order):
        self.order, self.sources = order, [iter(s) for s in sources]
        k = len(self.sources)
        self.heads = [next(s, None) for s in self.sources]
        self.keys = [self._key(h) for h in self.heads]
        self.losers = [-1] * k
        for i in range(k):
            self._play(i)

    def _key(self, head):
        return (1,) if head is None else (0, self.order(head))

    def _play(self, i: int) -> None:
        """Source i goes up from its leaf; at an empty node it waits for its rival."""
        k, node = len(self.sources), (i + len(self.sources)) // 2
        while node:
            rival = self.losers[node]
            if rival < 0:
                self.losers[node] = i
                return
            if self.keys[rival] < self.keys[i]:
                self.losers[node], i = i, rival
            node //= 2
        if k:
            self.losers[0] = i

    def __iter__(self) -> Iterator:
        while self.sources and self.heads[i := self.losers[0]] is not None:
            yield self.heads[i]
            self.heads[i] = next(self.sources[i], None)
            self.keys[i] = self._key(self.heads[i])
            self._play(i)


def _write_segments(store, name: str, segments: Iterable[tuple[int, Iterable[list]]]) -> list[tuple]:
    """Writes captures of each range, sorted, one compressed piece a range: (range, path, offset, bytes)."""
    done, at = [], 0
    with store.open_output_stream(name, compression=None) as out:
        for r, captures in segments:
            c, start = zlib.compressobj(1), at
            for capture in captures:
                at += out.write(c.compress((json.dumps(capture) + "\n").encode()))
            at += out.write(c.flush())
            done.append((r, name, start, at - start))
    return done


def _read_segment(store, path: str, offset: int, size: int) -> Iterator[list]:
    with store.open_input_file(path) as f:
        f.seek(offset)
        d, tail = zlib.decompressobj(), b""
        while size > 0:
            data = f.read(min(size, 1 << 16))
            size -= len(data)
            *lines, tail = (tail + d.decompress(data)).split(b"\n")
            yield from map(json.loads, lines)


_SEGMENTS = "range int, path string, offset long, bytes long"


def _segment_batch(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], ["range", "path", "offset", "bytes"])


def _run_writer(uri: str, bounds: list[tuple]):
    """Reads whole archives and writes the run of each: its captures in order, cut at the bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(uri)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                captures = []
                with store.open_input_stream(path, compression=None) as f:
                    for offset, data in gzip_members(f.read):
                        r = parsed_record(data)
                        captures.append([url_key(r["url"]), r["time"], r["page_id"], r["bytes"], r["digest"], r["type"], r["refers_to"], path.rsplit("/", 1)[1], offset])
                captures.sort(key=_order)
                by: dict[int, list] = {}
                for c in captures:
                    by.setdefault(bisect_right(bounds, (c[0], c[1])), []).append(c)
                yield _segment_batch(_write_segments(store, f"{root}/{uuid.uuid4().hex}.run", by.items()))

    return run


def _merged(store, parts: list[dict]) -> LoserTree:
    return LoserTree([_read_segment(store, p["path"], p["offset"], p["bytes"]) for p in parts], _order)


def _merge_level(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(uri)
        for batch in batches:
            done = []
            for r, parts in zip(batch.column("range").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                done += _write_segments(store, f"{root}/{uuid.uuid4().hex}.run", [(r, _merged(store, parts))])
            yield _segment_batch(done)

    return run


def _merge_last(uri: str):
    names = [x.split()[0] for x in CAPTURE.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in CAPTURE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _filesystem(uri)
        for batch in batches:
            for r, parts in zip(batch.column("range").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                rows: list[tuple] = []
                for i, c in enumerate(_merged(store, parts)):
                    rows.append((r, i, *c))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def write_archives(pages: DataFrame, uri: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes every row of pages as a WARC record under uri; returns the files: path, records, bytes.

    Payload: the html in UTF-8, null being empty. Of rows whose payloads are equal and REVISIT_BYTES long
    at least, those with the largest id are responses (several, if rows repeat it) and the others revisit
    it; a null id is smaller than any. Shorter payloads are all responses. Very long payloads are records
    like others. Null urls are empty. Other columns of pages, whatever their names, are ignored; an empty table
    gives no files.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), F.when(F.length(payload) >= REVISIT_BYTES, F.sha2(payload, 256)).alias("key"))
    keyed, short = rows.where("key IS NOT NULL"), rows.where("key IS NULL")
    groups = checkpointed(keyed.groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # Short payloads have no key and meet no one: they stay where they are.
    rows = keyed.join(groups, "key", "left").unionByName(short.withColumn("first", F.lit(None).cast("long")))
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    rows = rows.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("first"), revisit.alias("revisit"))
    return checkpointed(rows.mapInArrow(_archive_writer(uri), "path string, records long, bytes long"))


def range_bounds(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> list[tuple]:
    """Keys (URL key, time) between the ranges, from a sample by hash of at most some SAMPLE_ROWS pages."""
    n = pages.count()
    keep = min(1.0, SAMPLE_ROWS / max(n, 1))
    sample = pages.where(F.pmod(F.xxhash64(id_col, url_col), F.lit(1 << 20)) < int(keep * (1 << 20))).select(F.col(id_col).cast("long").alias("i"), F.col(url_col).cast("string").alias("u"))
    keys = sorted((url_key(quote(r.u or "", safe=":/?&=#%.,;+~@!*()-_[]")), f"{capture_time(r.i):%Y-%m-%dT%H:%M:%SZ}") for r in sample.collect())
    ranges = max(1, -(-n // RANGE_ROWS))
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def capture_index(spark: SparkSession, files: DataFrame, uri: str, bounds: list[tuple]) -> DataFrame:
    """All captures of the archives in files, as CAPTURE: ranges ascend, and positions within them, in global order."""
    n = max(1, files.count())
    segments = checkpointed(files.select("path").repartition(n).mapInArrow(_run_writer(uri, bounds), _SEGMENTS))
    part = F.struct("path", "offset", "bytes")
    while True:
        many = segments.groupBy("range").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if many <= FAN_IN:
            break
        groups = segments.withColumn("g", F.pmod(F.xxhash64("path", "offset"), F.lit(-(-many // (FAN_IN // 2))))).groupBy("range", "g").agg(F.collect_list(part).alias("parts"))
        segments = checkpointed(groups.mapInArrow(_merge_level(uri), _SEGMENTS))
    return segments.groupBy("range").agg(F.collect_list(part).alias("parts")).mapInArrow(_merge_last(uri), CAPTURE)


def archived_pages(pages: DataFrame, uri: str | None = None) -> DataFrame:
    """Writes pages to WARC files under uri (default: a new shared folder), reads them back, gives their captures in order."""
    spark = pages.sparkSession
    uri = uri or new_folder(spark, "warc")
    files = write_archives(pages, f"{uri}/archives")
    return capture_index(spark, files, f"{uri}/index", range_bounds(pages))


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Every page as its archive has it."""
    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id != first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id != first THEN first END AS refers_to
FROM m
"""
