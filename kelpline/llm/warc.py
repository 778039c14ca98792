"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that are compressed independently; a bundle is a file of
frames that ends in a seek table (a skippable frame with the sizes of all frames and a footer), so
that any Zstandard reader reads the whole and a reader that knows the table opens one frame.
An index maps every record to its bundle, frame, and offset and length inside the frame.

Records with equal payloads (same SHA-1 and length) are stored once: the one with the largest id is a
``response``, the others ``revisit`` it by a header and carry no payload.

Defined results: a null payload is an empty one; a null id is the record id ``urn:kelp:null`` and
is read back as null; rows that repeat an id are records of their own, and if their payload is that of
the response, each of them is a response; an empty table gives no bundles and no rows; columns other than
the named ones are ignored whatever their names. A payload of any length is one record in one frame; a task
holds one Arrow batch and one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.llm.files import NewFile, open_folder
from kelpline.llm.tables import staged
from kelpline.operators.lookups import lookup_join
from kelpline.session import scratch_folder, ship_package

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 64 * 1024 * 1024
LEVEL = 3

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
HEADER = struct.Struct("<II")

RECORD_PREFIX = "urn:kelp:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "record_id string, bundle string, frame long, offset long, length long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_record(record_id: str, uri: str, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit has no block; the length of the payload it stands for is kept in an
    extension header."""
    block = payload if refers_to is None else b""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not the start of a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than its header says")
    return fields, rest[:size]


class BundleWriter:
    """Bundles of one task attempt."""

    def __init__(self, folder: str, stem: str, frame_bytes: int, bundle_bytes: int):
        self.system, self.folder = open_folder(folder)
        self.stem, self.frame_bytes, self.bundle_bytes = stem, frame_bytes, bundle_bytes
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.file: NewFile | None = None
        self.count = 0
        self.frames: list[tuple[int, int]] = []
        self.pending: list[bytes] = []
        self.size = 0

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        """Bundle name, frame, offset in the frame, and length of the record."""
        if self.file is None:
            name = f"{self.stem}-{self.count:05d}.warc.zst"
            self.file, self.name, self.frames = NewFile(self.system, self.folder, name), name, []
            self.count += 1
        place = (self.name, len(self.frames), self.size, len(record))
        self.pending.append(record)
        self.size += len(record)
        if self.size >= self.frame_bytes:
            self._frame()
            if self.file.size >= self.bundle_bytes:
                self.close()
        return place

    def _frame(self) -> None:
        if self.pending:
            packed = self.packer.compress(b"".join(self.pending))
            self.file.write(packed)
            self.frames.append((len(packed), self.size))
            self.pending, self.size = [], 0

    def close(self) -> None:
        """End the bundle with its seek table."""
        if self.file is None:
            return
        self._frame()
        table = b"".join(ENTRY.pack(*sizes) for sizes in self.frames) + FOOTER.pack(len(self.frames), 0, SEEKABLE_MAGIC)
        self.file.write(HEADER.pack(SKIPPABLE_MAGIC, len(table)) + table)
        self.file.close()
        self.file = None


class BundleReader:
    """One bundle, opened by its seek table."""

    def __init__(self, folder: str, name: str):
        system, inner = open_folder(folder)
        self.file = system.open_input_file(f"{inner}/{name}")
        size = self.file.size()
        count, _, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{name} has no seek table")
        table = self._at(size - FOOTER.size - count * ENTRY.size, count * ENTRY.size)
        self.places, start = [], 0
        for packed, plain in ENTRY.iter_unpack(table):
            self.places.append((start, packed, plain))
            start += packed
        self.unpacker = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        start, packed, plain = self.places[number]
        return self.unpacker.decompress(self._at(start, packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def _bundler(folder: str, frame_bytes: int, bundle_bytes: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the index that is committed names the files that count
        stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        writer = BundleWriter(folder, stem, frame_bytes, bundle_bytes)
        for batch in batches:
            rows = []
            ids, uris, targets = (batch[c].to_pylist() for c in ("_id", "_uri", "_target"))
            for record_id, uri, payload, target in zip(ids, uris, batch["_payload"], targets):
                name, body = f"{RECORD_PREFIX}{'null' if record_id is None else record_id}", payload.as_py() or b""
                refers = None if target is None else f"{RECORD_PREFIX}{target}"
                record = write_record(name, uri, body, payload_digest(body), len(body), refers)
                rows.append((name, *writer.add(record)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["record_id", "bundle", "frame", "offset", "length"])
        writer.close()

    def non_empty(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from write(b for b in batches if b.num_rows)

    return non_empty


def write_bundles(
    pages: DataFrame,
    folder: str,
    record_id: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write a record per row and return the index, staged: a bundle counts only if the index names it.

    Payloads below ``min_bytes`` are always responses. Digests are grouped before anything is joined,
    so equal payloads of any number become one row; only digests that occur twice are joined back.
    """
    spark = pages.sparkSession
    ship_package(spark)
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    # control characters would end a header line
    address = F.regexp_replace(F.coalesce(F.col(uri).cast("string"), F.lit("")), "[\\x00-\\x1F\\x7F]", " ")
    rows = pages.select(F.col(record_id).alias("_id"), address.alias("_uri"), body.alias("_payload"))
    long_enough = F.length("_payload") >= min_bytes
    rows = rows.withColumn("_digest", F.when(long_enough, F.concat(F.sha1("_payload"), F.lit("-"), F.length("_payload"))))
    groups = rows.where("_digest is not null").groupBy("_digest").agg(F.max("_id").alias("_kept"), F.count("*").alias("_n"))
    repeated = staged(groups.where("_n > 1").select("_digest", "_kept"))
    joined = lookup_join(rows, repeated, ["_digest"])
    other = F.col("_kept").isNotNull() & ~F.col("_kept").eqNullSafe(F.col("_id"))
    marked = joined.select("_id", "_uri", "_payload", F.when(other, F.col("_kept")).alias("_target"))
    return staged(marked.mapInArrow(_bundler(folder, frame_bytes, bundle_bytes), INDEX_SCHEMA))


def _record_reader(folder: str):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, BundleReader] | None = None
        held: tuple[int, bytes] | None = None
        for batch in batches:
            out = {"record_id": [], "record_type": [], "refers_to": [], "uri": [], "digest": [], "size": [], "payload": []}
            for bundle, frame, offset, length in zip(*(batch[c].to_pylist() for c in ("bundle", "frame", "offset", "length"))):
                if opened is None or opened[0] != bundle:
                    if opened:
                        opened[1].close()
                    opened, held = (bundle, BundleReader(folder, bundle)), None
                if held is None or held[0] != frame:
                    held = (frame, opened[1].frame(frame))
                fields, block = parse_record(held[1][offset : offset + length])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and payload_digest(block) != digest:
                    raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one its digest names")
                out["record_id"].append(fields["WARC-Record-ID"][1:-1])
                out["record_type"].append(fields["WARC-Type"])
                out["refers_to"].append(fields["WARC-Refers-To"][1:-1] if revisit else None)
                out["uri"].append(fields["WARC-Target-URI"])
                out["digest"].append(digest)
                out["size"].append(int(fields["X-Payload-Length"]) if revisit else len(block))
                out["payload"].append(None if revisit else block)
            yield pa.RecordBatch.from_pydict(out, schema=_RECORDS)
        if opened:
            opened[1].close()

    return read


RECORD_SCHEMA = "record_id string, record_type string, refers_to string, uri string, digest string, size long, payload binary"
_RECORDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("uri", pa.string()),
        ("digest", pa.string()),
        ("size", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of index rows, through the seek tables. ``index`` may be a selection: only the frames
    that its rows name are opened, each once per task."""
    ship_package(index.sparkSession)
    rows = index.select("bundle", "frame", "offset", "length")
    # a few bytes of index stand for a whole frame: the number of tasks must not follow the index's size
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_frame = rows.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return by_frame.mapInArrow(_record_reader(folder), RECORD_SCHEMA)


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages written to bundles in the shared folder and read back: a row per record, without payloads."""
    folder = scratch_folder(pages.sparkSession)
    index = write_bundles(pages, folder, min_bytes=min_bytes)
    number = lambda c: F.expr(f"try_cast(substring({c}, {len(RECORD_PREFIX) + 1}) as bigint)")
    return read_records(index, folder).select(
        number("record_id").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
