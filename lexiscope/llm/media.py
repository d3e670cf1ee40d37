"""Media columns: content-addressed payloads in tar shards, and rows that carry digest, offset and length.

A task streams its payloads into tar shards in the shared folder. A payload is stored as an 8-bit
greyscale PNG of 64 samples a row (lossless, compressed), named by the digest of its stored form; a
shard holds equal payloads once. Metadata columns are filled by reading a payload's head alone, a
range of a few bytes at its offset; features by reading the range of the whole payload.

Tar members have the plain ustar head; a shard ends with two empty blocks, so any tar reader opens
it.

Payloads that are equal in several tasks lie in each one's shards, as bringing texts together would cost
a shuffle of all of them; their rows carry the same digest.

Defined cases: a null text is empty; an empty payload is one row of zeros. Rows that repeat share a
payload where one task stores them. doc_id is cast to long. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import fresh_dir, staged
from lexiscope.llm.files import new_file, open_folder

WIDTH = 64
SHARD_BYTES = 64_000_000
PNG = b"\x89PNG\r\n\x1a\n"
#: Signature, length, IHDR, width, height, depth and kind: all that metadata needs.
HEAD_BYTES = 33


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def padded(data: bytes) -> bytes:
    """data with bytes 0 up to a positive multiple of WIDTH."""
    return data + bytes(-len(data) % WIDTH if data else WIDTH)


def encode_png(payload: bytes) -> bytes:
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)  # each row begins with filter 0
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + _chunk(b"IEND", b"")


def read_head(head: bytes) -> tuple[int, int, int]:
    """(width, height, bits a sample) from the first HEAD_BYTES."""
    if head[:8] != PNG or head[12:16] != b"IHDR":
        raise ValueError("no PNG")
    return struct.unpack(">IIB", head[16:25])


def decode_png(data: bytes) -> bytes:
    width, height, _ = read_head(data)
    at, packed = 8, []
    while at < len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        if data[at + 4 : at + 8] == b"IDAT":
            packed.append(data[at + 8 : at + 8 + n])
        at += n + 12
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("a row is filtered")
    return rows[:, 1:].tobytes()


def tar_head(name: str, size: int) -> bytes:
    big = f"{size:011o}".encode() + b"\0" if size < 8**11 else b"\x80" + size.to_bytes(11, "big")
    h = name.encode().ljust(100, b"\0") + b"0000644\0" + b"0000000\0" * 2 + big + b"00000000000\0" + b" " * 8 + b"0"
    h = h.ljust(257, b"\0") + b"ustar\x0000"
    h = h.ljust(512, b"\0")
    return h[:148] + f"{sum(h):06o}\0 ".encode() + h[156:]


class ShardWriter:
    def __init__(self, folder: str):
        files, self.path = new_file(folder, ".tar")
        self.out, self.at, self.known = files.open_output_stream(self.path), 0, {}

    def put(self, digest: str, data: bytes) -> tuple[int, int]:
        """(offset, length) of the stored form, written unless the shard has it."""
        if digest not in self.known:
            head = tar_head(f"{digest}.png", len(data))
            self.out.write(head + data + bytes(-len(data) % 512))
            self.known[digest] = self.at + 512, len(data)
            self.at += 512 + len(data) + -len(data) % 512
        return self.known[digest]

    def close(self) -> None:
        self.out.write(bytes(1024))
        self.out.close()


STORED = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"


def _store(folder: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                png = encode_png(padded(data))
                digest = hashlib.sha256(png).hexdigest()
                if shard is None or shard.at >= shard_bytes:
                    if shard:
                        shard.close()
                    shard = ShardWriter(folder)
                out.append((doc, len(data), digest, shard.path, *shard.put(digest, png)))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in STORED.split(", ")])
        if shard:
            shard.close()

    return run


def store_texts(docs: DataFrame, shard_bytes: int = SHARD_BYTES, folder: str | None = None) -> tuple[DataFrame, str]:
    """(rows of doc_id, n_bytes, digest, shard, offset, length as a written table; the shards' folder)."""
    folder = folder or fresh_dir(docs.sparkSession, "media")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_store(folder, shard_bytes), STORED)
    return staged(rows, "media-rows"), folder


class _Ranges:
    """Byte ranges of shards; one shard is open at a time."""

    def __init__(self, folder: str):
        self.files, _ = open_folder(folder)
        self.path, self.file = None, None

    def read(self, path: str, offset: int, n: int) -> bytes:
        if path != self.path:
            if self.file:
                self.file.close()
            self.path, self.file = path, self.files.open_input_file(path)
        return self.file.read_at(n, offset)


def _with_metadata(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = _Ranges(folder)
        for batch in batches:
            heads = [read_head(ranges.read(p, o, HEAD_BYTES)) for p, o in zip(batch["shard"].to_pylist(), batch["offset"].to_pylist(), strict=True)]
            new = [pa.array([h[k] for h in heads], pa.int64()) for k in range(3)]
            yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, "width", "height", "depth"])

    return run


def fill_metadata(rows: DataFrame, folder: str) -> DataFrame:
    """rows with width, height and depth, from the heads of the payloads alone."""
    return rows.mapInArrow(_with_metadata(folder), STORED + ", width long, height long, depth long")


def feature_of(samples: bytes) -> str:
    """64 bits: for 64 equal stretches of the samples, whether their mean is over the mean of all; and the mean, in hex."""
    x = np.frombuffer(samples, np.uint8)
    sums = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    cut = np.arange(65) * len(x) // 64
    over = np.diff(sums[cut]) * len(x) > sums[-1] * np.diff(cut)
    return np.packbits(over).tobytes().hex() + f"-{int(sums[-1] * 256 // len(x)):04x}"


READ = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, feature string, width long, height long"
)


def _features(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, last, found = _Ranges(folder), None, ()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if (r["shard"], r["offset"]) != last:
                    last = r["shard"], r["offset"]
                    png = ranges.read(*last, r["length"])
                    payload = decode_png(png)
                    found = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(png), hashlib.sha256(png).hexdigest(), feature_of(payload))
                rows.append((r["doc_id"], r["n_bytes"], *found, r["width"], r["height"]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in READ.split(", ")])

    return run


def dealt(rows: DataFrame, task_bytes: int = SHARD_BYTES // 4) -> DataFrame:
    """rows in as many tasks as their payloads have task_bytes, those of one stretch of a shard together (descriptors are small, so their files' sizes say nothing)."""
    total = rows.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(100_000, -(-total // task_bytes)))
    return rows.repartition(tasks, "shard", F.floor(F.col("offset") / task_bytes)).sortWithinPartitions("shard", "offset")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of op2, from the stored bytes."""
    rows, folder = store_texts(docs)
    return fill_metadata(dealt(rows), folder).mapInArrow(_features(folder), READ)
