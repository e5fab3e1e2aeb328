"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; every bundle ends in a
seek table (a skippable frame, in the public seekable format) that gives each
frame's compressed and decompressed size, so any record is reached by one small
read of the footer and one read of its frame.  ``write_archives`` returns the
index: record identifier -> bundle, frame, offset inside the decompressed frame,
length.  Bundles are written beside their final name and renamed; their names
come from the task attempt, so a repeated task never touches another's file and
only files named by the committed index count.

Defined cases: a null or empty html is an empty payload; a null url is written as
``urn:page:<id>``; payloads under ``min_payload`` bytes are never deduplicated;
repeated page ids keep all their rows: each gets a record of its own, and those of
equal payload and smallest id are all responses; a very long page is a frame of its own;
columns other than page_id, url and html, whatever their names, are not read; an empty
table gives an empty index.  A null page_id is a record with an empty identifier
and is read back with a null id.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bound_batches, materialise, shared_path

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
MIN_PAYLOAD = 100
_SKIP, _SEEK = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, bundle string, frame int, frame_at long, frame_bytes long, inner long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class BundleWriter:
    """One bundle file: frames, then the seek table."""

    def __init__(self, uri: str, level: int = 3):
        self.uri, self.level = uri, level
        self.fs, self.path = _open(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path + ".part")
        self.frames: list[tuple[int, int]] = []
        self.at, self.buf = 0, bytearray()
        self.pending: list[tuple] = []

    def add(self, key, record: bytes) -> Iterator[tuple]:
        """Rows of the index for records whose frame has just been closed."""
        self.pending.append((key, len(self.buf), len(record)))
        self.buf += record
        if len(self.buf) >= FRAME_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if not self.pending:
            return
        packed = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(bytes(self.buf))
        self.out.write(packed)
        for key, inner, n in self.pending:
            yield key, self.uri, len(self.frames), self.at, len(packed), inner, n
        self.frames.append((len(packed), len(self.buf)))
        self.at += len(packed)
        self.buf, self.pending = bytearray(), []

    def close(self) -> Iterator[tuple]:
        yield from self.flush()
        body = b"".join(struct.pack("<II", c, d) for c, d in self.frames) + struct.pack("<IBI", len(self.frames), 0, _SEEK)
        self.out.write(struct.pack("<II", _SKIP, len(body)) + body)
        self.out.close()
        self.fs.move(self.path + ".part", self.path)


def seek_table(handle) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of every frame, from the footer."""
    size = handle.size()
    handle.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", handle.read(9))
    if magic != _SEEK:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    handle.seek(size - 9 - n * width)
    body, at, out = handle.read(n * width), 0, []
    for i in range(n):
        c, d = struct.unpack_from("<II", body, i * width)
        out.append((at, c, d))
        at += c
    return out


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no block, but names its payload's digest and size."""
    revisit = refers_to is not None
    key = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{key}>",
            f"WARC-Target-URI: {_line(url) or f'urn:page:{key}'}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Payload-Length: {len(payload)}"]
    block = b"" if revisit else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(text) -> str:
    return "" if text is None else " ".join(str(text).split())


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in a decompressed frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record at byte {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        n = int(head["Content-Length"])
        yield head, data[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def _key(text: str | None) -> int | None:
    body = "" if text is None else text.removeprefix("<urn:page:").removesuffix(">")
    return int(body) if body else None


def read_record(uri: str, frame: int, inner: int, length: int) -> tuple[dict[str, str], bytes]:
    """Random access: footer, one frame, one record."""
    fs, path = _open(uri)
    with fs.open_input_file(path) as f:
        at, c, d = seek_table(f)[frame]
        f.seek(at)
        raw = zstandard.ZstdDecompressor().decompress(f.read(c), max_output_size=d)
    return next(parse_records(raw[inner : inner + length]))


def plan_records(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """page_id, url, payload, digest, refers_to: which rows become revisits.

    First occurrences come from a partial aggregation on (digest, size); payloads
    seen once leave it again, so the join's other side has only repeated payloads.
    The join may be split by AQE where one payload is hot: its build side has one
    row a key.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    firsts = (p.where(F.length("payload") >= min_payload).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select(F.col("digest").alias("d"), "first_id"))
    refers = F.when(F.col("page_id") > F.col("first_id"), F.col("first_id")).alias("refers_to")
    return p.join(firsts, F.col("digest") == F.col("d"), "left").select("page_id", "url", "payload", "digest", refers)


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Write every planned record; returns the materialised index (INDEX)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows = None, []

        def out():
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            types = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
            names = ["page_id", "bundle", "frame", "frame_at", "frame_bytes", "inner", "length"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

        for batch in batches:
            for pid, url, payload, digest, refers in zip(*(batch.column(j).to_pylist() for j in range(5)), strict=True):
                if writer is None:
                    writer = BundleWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                rows += writer.add(pid, record_bytes(pid, url, payload, digest, refers))
                if writer.at >= BUNDLE_BYTES:
                    rows += writer.close()
                    writer = None
            if len(rows) >= 10_000:
                yield out()
                rows = []
        if writer is not None:
            rows += writer.close()
        yield out()

    bound_batches(planned.sparkSession)
    return materialise(planned.mapInArrow(write, INDEX), "warc-index")


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the bundles that the index names (RECORD), frame by frame.

    Bundles are split into frames by their own seek tables, not by the index; the
    digest and size of a response are computed from the bytes read.
    """
    spark = index.sparkSession
    bundles = index.groupBy("bundle").agg(F.count(F.lit(1)).alias("records"))
    names = [x.strip().split(" ")[0] for x in RECORD.split(",")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = _open(uri)
                with fs.open_input_file(path) as f:
                    for at, c, d in seek_table(f):
                        f.seek(at)
                        rows = []
                        for head, block in parse_records(unpack.decompress(f.read(c), max_output_size=d)):
                            kind = head["WARC-Type"]
                            if kind == "revisit":
                                n, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                            else:
                                n, digest = len(block), hashlib.sha256(block).hexdigest()
                                if head["WARC-Payload-Digest"] != f"sha256:{digest}":
                                    raise ValueError(f"damaged record {head['WARC-Record-ID']} in {uri}")
                            rows.append((_key(head["WARC-Record-ID"]), head["WARC-Target-URI"], n, digest, kind,
                                         _key(head.get("WARC-Refers-To")), block if with_payload else None))
                        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bundles.repartition(n).mapInArrow(read, RECORD)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to bundles in the shared folder and read the bundles back."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages), folder), with_payload=False)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = {"op3_warc": """
with p as (select page_id, coalesce(html, '') h from pages),
q as (select page_id, octet_length(encode(h)) n, sha256(h) d from p),
r as (select *, min(page_id) over (partition by d, n) f from q)
select page_id, cast(n as bigint) as payload_bytes, d as payload_digest,
  case when n >= 100 and page_id > f then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id > f then f end as refers_to
from r"""}
