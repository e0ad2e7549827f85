"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed each for itself; after
them stands a seek table in a skippable frame, with the sizes of all frames
and a footer.  A manifest maps each record to its bundle, its frame and its
offset in the frame, so reading a record decompresses one frame.

Bundles are files in a folder that driver and executors share.  A task writes
under a name of its own and the manifest lists only what finished tasks wrote,
so a task that runs again after an executor is lost leaves at most a file that
nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, map_arrow, materialize, work_path

#: Fixed values of the formats.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Payload bytes from which equal payloads are stored once; uncompressed
#: bytes of a frame and of a bundle.
LEAST, FRAME, BUNDLE = 1000, 256 << 10, 31 << 20


class BundleWriter:
    """Appends records to frames; finish() gives the bytes with the seek table."""

    def __init__(self, level: int = 3, frame: int = FRAME) -> None:
        import zstandard

        self.frame, self.size = frame, 0
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._open, self._used, self._done, self._table = [], 0, [], []

    def add(self, record: bytes) -> tuple[int, int]:
        """The record's frame and its offset there."""
        if self._open and self._used + len(record) > self.frame:
            self._close()
        place = (len(self._table), self._used)
        self._open.append(record)
        self._used += len(record)
        self.size += len(record)
        return place

    def _close(self) -> None:
        data = b"".join(self._open)
        packed = self._zstd.compress(data)
        self._done.append(packed)
        self._table.append((len(packed), len(data)))
        self._open, self._used = [], 0

    def finish(self) -> bytes:
        if self._open:
            self._close()
        entries = b"".join(struct.pack("<II", *x) for x in self._table)
        footer = struct.pack("<IBI", len(self._table), 0, SEEKABLE)
        return b"".join([*self._done, struct.pack("<II", SKIPPABLE, len(entries) + len(footer)), entries, footer])


class BundleReader:
    """Frames of a bundle by number, each read and decompressed for itself."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        file.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        entry = 12 if descriptor & 0x80 else 8
        file.seek(size - 9 - n * entry)
        raw = file.read(n * entry)
        self.frames, at = [], 0
        for i in range(n):
            packed, plain = struct.unpack_from("<II", raw, i * entry)
            self.frames.append((at, packed, plain))
            at += packed

    def read(self, frame: int) -> bytes:
        import zstandard

        at, packed, plain = self.frames[frame]
        self.file.seek(at)
        out = zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)
        if len(out) != plain:
            raise ValueError("a frame has not the length of its table")
        return out


def record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}:{digest}')}>"


def make_record(page: object, url: str | None, payload: bytes, digest: str, refers_to: object) -> bytes:
    """A response record, or a revisit record without the payload."""
    revisit = refers_to is not None
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, digest)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if revisit:
        head += [("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Profile", PROFILE)]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of the record at an offset."""
    cut = data.index(b"\r\n\r\n", at)
    lines = data[at:cut].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record at this offset")
    head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = data[cut + 4 : cut + 4 + int(head["content-length"])]
    return head, block[block.index(b"\r\n\r\n") + 4 :]


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST) -> DataFrame:
    """Write a record for each row to bundles in folder; the manifest:
    (key, digest, refers_to, bundle, frame, offset).

    Of records with equal payloads of `least` bytes or more, those with the
    largest key are responses and the others revisit it.  A null payload is an
    empty one; a null url has no target header; a row with a null key is a
    response; repeated rows are records each; an empty table gives an empty
    manifest.  Other columns are not stored.
    """
    raw = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key), F.col(url).alias("_url"), raw.alias("_payload"))
    rows = rows.withColumns({"_digest": F.sha1("_payload"), "_bytes": F.octet_length("_payload")})
    same = (
        pages.select(F.col(key), raw.alias("_payload")).select(key, F.sha1("_payload").alias("_digest"), F.octet_length("_payload").alias("_bytes"))
        .filter(F.col("_bytes") >= least).groupBy("_digest", "_bytes").agg(F.max(key).alias("_last"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    )
    # Written, the few repeated digests have a size that the planner knows: if
    # it is small they are sent to the payloads, not the payloads to them.
    rows = rows.join(materialize(same, "repeated"), ["_digest", "_bytes"], "left").select(key, "_url", "_payload", "_digest", F.when(F.col(key) < F.col("_last"), F.col("_last")).alias("_refers"))
    kind = pages.schema[key].dataType.simpleString()

    names = [key, "digest", "refers_to", "bundle", "frame", "offset"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        writer, held, places = BundleWriter(), [], []

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(writer.finish())
            frames, offsets = zip(*places, strict=True)
            keys, digests, refers = (pa.concat_arrays([b.column(i) for b in held]) for i in (0, 3, 4))
            return pa.RecordBatch.from_arrays([keys, digests, refers, pa.array([name] * len(places)), pa.array(frames, pa.int32()), pa.array(offsets, pa.int32())], names)

        for b in chunks(batches, "_payload", 1 << 20):
            for page, link, data, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                places.append(writer.add(make_record(page, link, data, digest, refers)))
            held.append(b)
            if writer.size >= BUNDLE:
                yield close()
                writer, held, places = BundleWriter(), [], []
        if places:
            yield close()

    return materialize(map_arrow(rows, run, f"{key} {kind}, digest string, refers_to {kind}, bundle string, frame int, offset int"), "manifest")


def read_archives(manifest: DataFrame, folder: str, key: str = "page_id", with_payload: bool = False) -> DataFrame:
    """(key, record_type, refers_to, payload_bytes, payload_digest[, payload])
    of the manifest's records, read from the bundles.

    Length and digest are those of the payload as read; a revisit's are those
    of the response that it refers to, found by the identifiers of records.
    The manifest is dealt by bundle, whose size is bounded, to a number of
    partitions that follows the number of bundles: its own bytes would not
    tell how much there is to read.
    """
    lots = min(20_000, max(1, manifest.select("bundle").distinct().count()))
    kind = manifest.schema[key].dataType.simpleString()
    names = [key, "record_type", "record_id", "refers_id", "refers_to", "payload_bytes", "payload_digest", *["payload"] * with_payload]

    def run(batches) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        bundle = frame = reader = data = None
        for b in batches:
            out = []
            for name, number, offset in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if name != bundle:
                    bundle, frame, reader = name, None, BundleReader(fs.open_input_file(f"{base}/{name}"))
                if number != frame:
                    frame, data = number, reader.read(number)
                head, payload = parse_record(data, offset)
                digest = hashlib.sha1(payload).hexdigest()  # noqa: S324  the format's digest
                told = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                revisit = head["warc-type"] == "revisit"
                if not revisit and digest != told:
                    raise ValueError(f"payload of {head['warc-record-id']} is not what was written")
                out.append((head["warc-type"], head["warc-record-id"], head.get("warc-refers-to"), None if revisit else len(payload), told, *[None if revisit else payload] * with_payload))
            cols = list(zip(*out, strict=True)) or [()] * (5 + with_payload)
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
            a = [pa.array(c, k) for c, k in zip(cols, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), *a[:3], b.column(1), *a[3:]], names)

    dealt = manifest.select(key, "refers_to", "bundle", "frame", "offset").repartition(lots, "bundle").sortWithinPartitions("bundle", "frame", "offset")
    read = materialize(map_arrow(dealt, run, f"{key} {kind}, record_type string, record_id string, refers_id string, refers_to {kind}, payload_bytes long, payload_digest string" + ", payload binary" * with_payload), "records")
    value = ["payload_bytes", "payload_digest", *["payload"] * with_payload]
    # Only responses that a revisit names take part, and once each.
    named = read.filter("refers_id IS NOT NULL").select(F.col("refers_id").alias("record_id")).distinct()
    source = read.filter("record_type = 'response'").join(named, "record_id").dropDuplicates(["record_id"]).select(F.col("record_id").alias("refers_id"), *(F.col(v).alias("_" + v) for v in value))
    out = read.filter("record_type = 'revisit'").join(source, "refers_id").select(key, "record_type", "refers_to", *(F.col("_" + v).alias(v) for v in value))
    return read.filter("record_type = 'response'").select(key, "record_type", "refers_to", *value).unionByName(out)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "warc")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM s
"""
