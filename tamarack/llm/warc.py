"""WARC archives compressed record by record with a Zstandard dictionary that the archive carries itself.

An archive begins with a skippable frame (magic 0x184D2A5D, length, dictionary); each record is a Zstandard frame of its own
that needs that dictionary, so any record can be read by its offset. The dictionary is built from the archive's own records:
from the first of them up to SAMPLE_BYTES, a documented bound that doesn't decide what is written, only how small.

Payloads of at least MIN_REVISIT bytes that are equal (SHA-1 and length) are stored once: the row with the largest page_id is
the response, the others are revisit records that refer to it. Which row that is comes from an aggregate by digest, so a
payload that a third of all pages share is one row before anything is joined.

Archives are written under a name of the attempt and then moved, so that a task that runs again leaves the same file; the
folder has to be reachable by pyarrow.

Defined results: a null html is an empty payload; a null page_id never is the largest, and rows without page_id that share a
payload with no numbered row are all responses; rows that repeat the largest page_id with its payload are all responses; an
empty table writes no archive and returns no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, table

MIN_REVISIT = 1000
SKIPPABLE = 0x184D2A5D
DICT_BYTES, SAMPLE_BYTES, LEVEL = 64 << 10, 4 << 20, 3
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = MIN_REVISIT) -> DataFrame:
    """id, url, payload (binary), digest (hex SHA-1), refers_to (the response's id for a revisit, else null)."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("__n", F.length("payload"))
    best = rows.where(f"__n >= {least}").groupBy(F.col("digest").alias("__d"), F.col("__n").alias("__m")).agg(F.max("id").alias("__best"), F.count(F.lit(1)).alias("__rows")).where("__rows > 1")
    # only payloads that repeat can be revisits; the wide side is matched by the digest
    rows = rows.join(best, (F.col("digest") == F.col("__d")) & (F.col("__n") == F.col("__m")), "left")
    other = F.col("__best").isNotNull() & ~F.col("id").eqNullSafe(F.col("__best"))
    return rows.select("id", "url", "payload", "digest", F.when(other, F.col("__best")).alias("refers_to"))


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record: response with the HTTP message, or revisit without its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    name = "" if page is None else str(page)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    block = http + payload
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        block = http
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = data.partition(CRLF * 2)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(CRLF * 2)[2]


def build_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A Zstandard dictionary; with too few samples for one, their beginning as raw content."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes each partition of rows (as with_revisits returns them) as an archive; number, path and records of each. An
    action on the result writes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (record(*(c[i].as_py() for c in b.columns)) for b in batches for i in range(b.num_rows))
        first, held = [], 0
        for r in records:
            first.append(r)
            held += len(r)
            if held >= SAMPLE_BYTES:
                break
        if not first:
            return
        raw = build_dictionary(first)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True)
        fs, base = _fs(folder)
        fs.create_dir(base, recursive=True)
        number, n = TaskContext.get().partitionId(), 0
        temp, final = f"{base}/.{uuid.uuid4().hex}", f"{base}/pages-{number:06d}.warc.zst"
        with fs.open_output_stream(temp, compression=None) as f:
            f.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
            for part in (first, records):
                for r in part:
                    f.write(press.compress(r))
                    n += 1
        fs.move(temp, final)
        yield pa.RecordBatch.from_pydict({"number": [number], "path": [final], "n": [n]})

    return rows.mapInArrow(write, "number bigint, path string, n bigint")


def read_archive(f) -> Iterator[bytes]:
    """The records of an archive (a file object), one at a time."""
    magic, size = struct.unpack("<II", f.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the start")
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(f.read(size)))
    held, ended = b"", False
    while True:
        one, out = plain.decompressobj(), []
        while not one.eof:
            if not held:
                held = f.read(1 << 20)
                if not held:
                    ended = True
                    break
            out.append(one.decompress(held))
            held = one.unused_data if one.eof else b""
        if ended:
            if any(out):
                raise ValueError("the archive ends inside a record")
            return
        yield b"".join(out)


def read_archives(spark: SparkSession, folder: str, paths: list[str]) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record. The payload of a response is held
    against its digest. paths has an entry for each archive, not for each page."""

    def number(urn: str | None) -> int | None:
        return int(x) if urn and (x := urn[len("<urn:page:") : -1]) else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _fs(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for path in (p for b in batches for p in b.column(0).to_pylist()):
            out: list[tuple] = []
            with fs.open_input_stream(path, compression=None) as f:
                for data in read_archive(f):
                    h, payload = parse(data)
                    n, digest, kind = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"]
                    if kind == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{path}: a payload differs from its digest")
                    out.append((number(h["WARC-Record-ID"]), n, digest, kind, number(h.get("WARC-Refers-To"))))
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    frame = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return frame.mapInArrow(read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    made = write_archives(with_revisits(table(spark, sf_dir, "pages")), folder).collect()
    return read_archives(spark, folder, sorted(r["path"] for r in made))
