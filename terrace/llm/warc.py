"""WARC archives: a deterministic sharded writer and a reader.

Records are put in shards of consecutive page ids, sorted, and written one gzip member
each. A shard's files roll when their compressed size passes `roll_bytes`. Headers and
digests are made anew from the payloads and dates are a parameter, so the same pages give
the same bytes. A file is written under a temporary name and renamed; the manifest, which
Spark commits last, names the files that count. A repeated or lost attempt leaves at most a
temporary file or writes the same file again.

Of records with equal payloads of at least `min_revisit` bytes the smallest page id is the
response and the others are revisits of it. Only digests are grouped for this; the payloads
are shuffled once, into their shards.

Defined results: a NULL html is the empty payload, a NULL url leaves the target header out,
control characters and blanks of a url are percent-encoded. Rows with NULL ids come first
and are responses unless a row with an id has the same payload. Rows that share the
smallest id of a payload are all responses. An empty table gives an empty archive and an
empty manifest. Other columns are not read. A file is read by one task, so a record must
fit in memory.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MANIFEST = "file string, shard long, part int, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
DATE = "2026-01-01T00:00:00Z"


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _member(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One WARC record as a gzip member without a time stamp."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", f"sha256:{_sha256(block)}"), ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", level, mtime=0)


def info_record(name: str, date: str, level: int) -> bytes:
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{name}>"), ("WARC-Date", date)]
    fields += [("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return _member(fields, b"format: WARC File Format 1.1\r\n", level)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, level: int) -> bytes:
    own = f"{ID}{page_id}" if page_id is not None else f"{ID}none:{digest}"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{own}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(fields, http + (payload if refers_to is None else b""), level)


class RollingFiles:
    """The files of one shard, each renamed into place when it is full."""

    def __init__(self, root: str, shard: int, roll_bytes: int, date: str, level: int):
        self.files, self.root = fs.FileSystem.from_uri(root)
        self.files.create_dir(self.root, recursive=True)
        self.shard, self.roll_bytes, self.date, self.level = shard, roll_bytes, date, level
        self.part, self.out, self.done = 0, None, []

    def _open(self) -> None:
        self.name = f"part-{self.shard:06d}-{self.part:05d}.warc.gz"
        self.temporary = f"{self.root}/_tmp-{uuid.uuid4().hex}-{self.name}"
        self.out = self.files.open_output_stream(self.temporary, compression=None)
        self.size, self.records, self.sha256 = 0, 0, hashlib.sha256()
        self._put(info_record(self.name, self.date, self.level))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha256.update(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        if self.out is None:
            self._open()
        self._put(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.move(self.temporary, f"{self.root}/{self.name}")
            self.done.append((self.name, self.shard, self.part, self.records, self.size, self.sha256.hexdigest()))
            self.out, self.part = None, self.part + 1


def _revisits(pages: DataFrame, min_revisit: int) -> DataFrame:
    """page_id, digest, refers_to of the records that repeat an earlier payload."""
    digests = pages.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n"))
    digests = digests.filter(F.col("n") >= min_revisit)
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
    # A payload may have most of the rows: AQE splits that side of the join.
    both = digests.join(first.filter("copies > 1 AND refers_to IS NOT NULL"), "digest")
    return both.filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def _shards(pages: DataFrame, shard_bytes: int, spans: int) -> tuple[int, int, list[tuple[int, int]]]:
    """Smallest id, width of a span of ids, and (span, shard): spans are merged in order
    until a shard has `shard_bytes`. At most `spans` sums come to the driver."""
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    if low is None:
        return 0, 1, [(-1, 0)]
    width = (high - low) // spans + 1
    span = F.coalesce(F.floor((F.col("page_id") - low) / width).cast("long"), F.lit(-1))
    sizes = pages.groupBy(span.alias("span")).agg(F.sum(F.octet_length("payload") + 500)).orderBy("span").collect()
    out, total = [], 0
    for number, size in sizes:
        out.append((number, total // shard_bytes))
        total += size
    shards = {s: k for k, s in enumerate(sorted({s for _, s in out}))}
    return low, width, [(number, shards[s]) for number, s in out]


def write_warc(pages: DataFrame, root: str, min_revisit: int = 100, roll_bytes: int = 16 << 20, shard_bytes: int = 32 << 20, spans: int = 16_384, date: str = DATE, level: int = 4) -> DataFrame:
    """Writes page_id, url and html below `root` and returns the manifest."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    low, width, spans_to_shards = _shards(pages, shard_bytes, spans)
    n_shards = spans_to_shards[-1][1] + 1
    # At most `spans` rows, so it may be broadcast.
    shard_of = F.broadcast(spark.createDataFrame(spans_to_shards, "span long, shard long"))
    span = F.coalesce(F.floor((F.col("page_id") - low) / width).cast("long"), F.lit(-1))
    kinds = _revisits(pages, min_revisit).unionByName(pages, allowMissingColumns=True)
    rows = kinds.withColumn("span", span).join(shard_of, "span").select("shard", "page_id", "digest", "refers_to", "url", "payload")
    rows = rows.repartitionById(n_shards, F.col("shard").cast("int"))
    # The revisits of an id come before its pages.
    rows = rows.sortWithinPartitions("shard", "page_id", F.col("digest").isNull(), "url", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, revisits, at = None, {}, None
        done = []
        for batch in batches:
            for shard, page_id, digest, refers_to, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or out.shard != shard:
                    if out is not None:
                        out.close()
                        done += out.done
                    out, at, revisits = RollingFiles(root, shard, roll_bytes, date, level), None, {}
                if at != page_id or not revisits and digest is not None:
                    at, revisits = page_id, {}
                if digest is not None:
                    revisits[digest] = refers_to
                else:
                    own = _sha256(payload)
                    out.add(page_record(page_id, url, payload, own, revisits.get(own), date, level))
        if out is not None:
            out.close()
            done += out.done
        types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names)

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{root}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")


def _members(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The contents of the gzip members, fed in small pieces so that what follows a member
    is not copied over and over."""
    view, at = memoryview(data), 0
    while at < len(data):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(data):
                raise ValueError("the archive breaks off inside a record")
            piece = view[at : at + step]
            parts.append(inflate.decompress(piece))
            at += len(piece)
        at -= len(inflate.unused_data)
        yield b"".join(parts)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; sizes and block digests are verified."""
    for record in _members(data):
        head, _, rest = record.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        block = rest[: int(fields["Content-Length"])]
        if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha256:{_sha256(block)}":
            raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
        yield fields, block


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{ID}(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def read_warc(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """The page records of the files that the manifest names; `payload` is NULL for
    revisits. Digests of payloads are computed from them, those of revisits are read."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(root)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(manifest.select("file"), "file", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [f.split()[0] for f in RECORDS.split(", ")]
        if with_payload:
            types, names = [*types, pa.binary()], [*names, "payload"]
        for batch in batches:
            for k in range(batch.num_rows):
                rows, size = [], 0
                for fields, block in parse_records(batch.column(0)[k].as_py()):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and (len(payload) != n or _sha256(payload) != digest):
                        raise ValueError(f"broken payload {fields['WARC-Record-ID']}")
                    row = (_page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, n, digest, _page_of(fields.get("WARC-Refers-To")))
                    rows.append((*row, payload if kind == "response" else None)[: len(types)])
                    size += len(payload) if with_payload else 200
                    if size >= 4 << 20:
                        yield _batch(rows, types, names)
                        rows, size = [], 0
                yield _batch(rows, types, names)

    return files.select("content").mapInArrow(read, RECORDS + (", payload binary" if with_payload else ""))


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
