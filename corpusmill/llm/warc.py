"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a seek table in a
skippable frame at the end gives the sizes of all frames, so a reader decodes
only the frame it needs. The index maps record ids to bundle, frame and offset
within the frame.

Records with equal payloads: the one with the smallest id is a ``response``, the
others are ``revisit`` records, which refer to it and have no payload. Who
revisits whom is found from ids and digests alone; payloads move at most once, by
id, so copies of one payload gather nowhere.

Defined results: a null payload is the empty payload; rows that repeat an id are
all written, and those with equal payloads are all responses or all revisits; a
null id is written as ``none``, read back as null, revisits the smallest id with
its payload, and is a response if only null ids have that; equal payloads shorter
than ``min_bytes`` are not made revisits; an empty table gives no bundles; other
columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from .common import join_keyed, materialize, shared_dir, shuffle_partitions, small_batches

# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
#: Bytes of records before a frame, and before a bundle, is closed.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
LEVEL = 3

INDEX = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("bundle", T.StringType()),
        T.StructField("frame", T.IntegerType()),
        T.StructField("offset", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(record_id: int | None) -> str:
    return f"<urn:record:{'none' if record_id is None else record_id}>"


def _number(urn: str) -> int | None:
    name = urn[len("<urn:record:") : -1]
    return None if name == "none" else int(name)


def record(record_id: int | None, url: str | None, payload: bytes | None, sha: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; without a payload it is a revisit of ``refers_to``."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(record_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{sha}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: {_urn(refers_to)}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[tuple, int]:
    """The record at an offset, as ``RECORD`` has it, and where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines)
    start = end + 4
    stop = start + int(head["Content-Length"])
    body = data.index(b"\r\n\r\n", start) + 4
    kind, sha = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = data[body:stop] if kind == "response" else None
    if payload is None:
        http = data[start:body].decode("ascii")
        size = int(http.split("Content-Length: ")[1].split("\r\n")[0])
        refers = _number(head["WARC-Refers-To"])
    else:
        size, refers = len(payload), None
        if digest(payload) != sha:
            raise ValueError("the payload does not match its digest")
    return (_number(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), kind, sha, size, refers, payload), stop + 4


class BundleWriter:
    """Writes frames to a binary file object and the seek table at the end."""

    def __init__(self, out):
        self.out, self.frames, self.open, self.size, self.written = out, [], [], 0, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, data: bytes) -> tuple[int, int]:
        """Append a record; gives its frame and the offset within it."""
        if self.size and self.size + len(data) > FRAME_BYTES:
            self._flush()
        place = (len(self.frames), self.size)
        self.open.append(data)
        self.size += len(data)
        return place

    def _flush(self) -> None:
        packed = self.packer.compress(b"".join(self.open))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.written += len(packed)
        self.open, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)


class BundleReader:
    """Reads single frames of a seekable file by its seek table."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, 2)
        file.seek(end - 9)
        count, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        file.seek(end - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", file.read(8 * count)))
        self.places, at = [], 0
        for packed, size in sizes:
            self.places.append((at, packed, size))
            at += packed
        self.unpacker = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.places)

    def frame(self, number: int) -> bytes:
        at, packed, size = self.places[number]
        self.file.seek(at)
        return self.unpacker.decompress(self.file.read(packed), max_output_size=size)


def plan(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """Give each record its digest, size, the record it revisits, if any, and else its payload.

    Ids and digests are grouped with partial minima first. Only ids that revisit
    are joined back, by id and digest, so no key of a join is shared by many rows.
    """
    base = pages.select(
        F.col(key).cast("long").alias("record_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    own = base.where(F.octet_length("payload") >= min_bytes).select("record_id", "sha")
    own = materialize(own, "warc-digests")
    firsts = own.groupBy("sha").agg(F.min("record_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = materialize(firsts.where("n > 1 and first is not null"), "warc-firsts")
    copies = join_keyed(own, firsts, "sha", "n").where("record_id is null or first < record_id").distinct()
    copies = materialize(copies.select(F.col("record_id").alias("id"), F.col("sha").alias("digest"), "first"), "warc-revisits")
    same = F.col("record_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("digest"))
    return base.join(copies, same, "left").select(
        "record_id",
        "url",
        F.octet_length("payload").cast("long").alias("size"),
        F.col("first").alias("refers_to"),
        F.when(F.col("first").isNull(), F.col("payload")).alias("payload"),
        "sha",
    )


def write(planned: DataFrame, folder: str) -> DataFrame:
    """Write bundles below ``folder``, which executors share; gives the index.

    Every attempt of a task writes files of its own and the index names those of
    the attempt that counted, so lost or repeated tasks do no harm.
    """

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        writer, out, name = None, None, ""
        for batch in batches:
            rows = []
            cols = [batch.column(k) for k in ("record_id", "url", "size", "refers_to", "payload", "sha")]
            for cells in zip(*cols):  # one payload at a time becomes a Python object
                number, url, size, refers, payload, sha = (c.as_py() for c in cells)
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    writer = BundleWriter(out)
                sha = base64.b32encode(bytes.fromhex(sha)).decode()
                data = record(number, url, payload, sha, size, refers)
                rows.append((number, name, *writer.add(data), len(data)))
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    out.close()
                    writer = None
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=INDEX.names
                )
        if writer is not None:
            writer.close()
            out.close()

    return materialize(planned.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the bundles that an index names, read frame by frame."""
    spark = index.sparkSession
    bundles = index.groupBy("bundle").agg(F.max("frame").alias("last"))
    pieces = bundles.select("bundle", F.explode(F.sequence(F.lit(0), "last")).alias("frame"))
    schema = RECORD if with_payload else T.StructType(RECORD.fields[:-1])
    small_batches(spark)

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        name, file, reader = None, None, None
        for batch in batches:
            for bundle, number in zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist()):
                if bundle != name:
                    if file:
                        file.close()
                    name, file = bundle, files.open_input_file(f"{root}/{bundle}")
                    reader = BundleReader(file)
                data, at, rows = reader.frame(number), 0, []
                while at < len(data):
                    row, at = parse(data, at)
                    rows.append(row if with_payload else row[:-1])
                yield _records(rows, with_payload)
                del data, rows
        if file:
            file.close()

    return pieces.repartition(shuffle_partitions(spark), "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(run, schema)


def lookup(index: DataFrame, folder: str) -> DataFrame:
    """Only the records of the given index rows; decodes the frames they lie in."""

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        name, file, reader, held, data = None, None, None, None, b""
        for batch in batches:
            rows = []
            cols = [batch.column(k).to_pylist() for k in ("bundle", "frame", "offset")]
            for bundle, number, offset in zip(*cols):
                if bundle != name:
                    if file:
                        file.close()
                    name, file, held = bundle, files.open_input_file(f"{root}/{bundle}"), None
                    reader = BundleReader(file)
                if number != held:
                    data, held = reader.frame(number), number
                rows.append(parse(data, offset)[0])
            if rows:
                yield _records(rows, True)
        if file:
            file.close()

    return index.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, RECORD)


def _records(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = RECORD.names if with_payload else RECORD.names[:-1]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
