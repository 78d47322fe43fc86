"""Media columns: content-addressed payloads in tar shards.

A text's payload is stored as an 8-bit grey PNG, 192 samples wide, under the SHA-256 of
the stored bytes.  Tasks append to tar shards of their own in the shared folder, a
payload once a shard; rows carry digest, shard, offset and length.  An object's first
place, by shard name and offset, stands for it.  Metadata columns are filled by range
reads of the image header alone; payload features by range reads of whole objects.

Copies never meet in a task: a row finds its object by the place that its own task wrote,
and only the stored objects, one for each shard at most, are matched by digest.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import make_dir, open_fs, product, table, text_batches

WIDTH = 192
SHARD_BYTES = 256 << 20
#: The PNG signature and the layout of its first chunk are fixed by the format.
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_IHDR = struct.Struct(">II5B")
HEADER_BYTES = len(_SIGNATURE) + 8 + _IHDR.size


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 of a text with spaces up to a positive multiple of WIDTH, and its own length."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, -(-len(raw) // WIDTH)) * WIDTH
    return raw.ljust(size, b" "), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, level: int = 6) -> bytes:
    """A grey 8-bit PNG whose rows are the payload's."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    head = _IHDR.pack(WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def header(data: bytes) -> tuple[int, int, int]:
    """Width, height and bits of an image from its first HEADER_BYTES bytes."""
    if data[: len(_SIGNATURE)] != _SIGNATURE:
        raise ValueError("not a PNG")
    return _IHDR.unpack_from(data, len(_SIGNATURE) + 8)[:3]


def from_png(data: bytes) -> np.ndarray:
    """Samples of an image that to_png has made, as rows."""
    width, height, _ = header(data)
    at, packed = len(_SIGNATURE), []
    while at < len(data):
        (size,) = struct.unpack_from(">I", data, at)
        if data[at + 4 : at + 8] == b"IDAT":
            packed.append(data[at + 8 : at + 8 + size])
        at += size + 12
    return np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)[:, 1:]


def feature_of(samples: np.ndarray) -> str:
    """Mean, variance and an 8 x 8 average hash of the samples, as text.

    The hash has a bit for each cell of an 8 x 8 grid, row by row: whether its mean is
    above the mean of all cells.  Rows of an image of fewer than eight stand for several.
    """
    high = np.arange(8) * len(samples) // 8
    wide = np.arange(0, WIDTH, WIDTH // 8)
    sums = np.add.reduceat(np.add.reduceat(samples, high, axis=0, dtype=np.int64), wide, axis=1)
    rows = np.maximum(np.diff(np.append(high, len(samples))), 1)
    means = sums / (rows[:, None] * (WIDTH // 8))
    bits = np.packbits(means > means.mean())
    counts = np.zeros(256, np.int64)
    for a in range(0, len(samples), 8192):
        counts += np.bincount(samples[a : a + 8192].ravel(), minlength=256)
    n, s = samples.size, int((counts * np.arange(256)).sum())
    squares = int((counts * np.arange(256) ** 2).sum())
    return f"mean={s / n:.3f};var={squares / n - (s / n) ** 2:.3f};hash={bits.tobytes().hex()}"


def store(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes payloads to tar shards; doc_id, n_bytes, digest, shard, offset, length for every row."""
    make_dir(docs.sparkSession, path)
    text_batches(docs.sparkSession)

    def stored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, where = open_fs(path)
        out, name, there = None, "", {}
        try:
            for pdf in batches:
                rows = []
                for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                    payload, n = payload_of(text)
                    key = hashlib.sha256(payload).digest()
                    if out is not None and key not in there and out.tell() > SHARD_BYTES:
                        out.write(bytes(1024))
                        out.close()
                        out = None
                    if out is None:
                        name = f"{uuid.uuid4().hex[:16]}.tar"
                        out, there = fs.open_output_stream(f"{where}/{name}"), {}
                    if key not in there:
                        image = to_png(payload)
                        digest = hashlib.sha256(image).digest()
                        info = tarfile.TarInfo(f"{digest.hex()}.png")
                        info.size = len(image)
                        out.write(info.tobuf(tarfile.USTAR_FORMAT))
                        there[key] = (digest, out.tell(), len(image))
                        out.write(image + bytes(-len(image) % 512))
                    digest, offset, length = there[key]
                    rows.append((doc_id, n, digest, name, offset, length))
                yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        finally:
            if out is not None:
                out.write(bytes(1024))
                out.close()

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    placed = rows.mapInPandas(stored, "doc_id string, n_bytes long, digest binary, shard string, offset long, length long")
    return table(placed.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)), "media-rows")


def objects(rows: DataFrame) -> DataFrame:
    """One place for each digest: digest, shard, offset, length."""
    place = F.min(F.struct("shard", "offset", "length")).alias("p")
    return rows.groupBy("digest").agg(place).select("digest", "p.*")


def read_payload(path: str, shard: str, offset: int, length: int) -> bytes:
    """The payload of one stored object, by a range read of its shard in a folder."""
    fs, where = open_fs(path)
    with fs.open_input_file(f"{where}/{shard}") as stream:
        return from_png(stream.read_at(length, offset)).tobytes()


def _ranges(placed: DataFrame, path: str, names: list[str], kind: str, size: int | None, of) -> DataFrame:
    """Runs ``of(bytes)`` on each object, or its first ``size`` bytes, shard by shard."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, where = open_fs(path)
        shard, stream = None, None
        for pdf in batches:
            rows = []
            for digest, name, offset, length in zip(pdf["digest"], pdf["shard"], pdf["offset"], pdf["length"]):
                if name != shard:
                    if stream is not None:
                        stream.close()
                    shard, stream = name, fs.open_input_file(f"{where}/{name}")
                rows.append((digest, *of(stream.read_at(min(length, size or length), offset), digest)))
            yield pd.DataFrame(rows, columns=["digest", *names])
        if stream is not None:
            stream.close()

    return placed.repartition("shard").sortWithinPartitions("shard", "offset").mapInPandas(read, kind)


def with_metadata(placed: DataFrame, path: str) -> DataFrame:
    """digest, width, height, bits of objects, from their headers alone."""
    return _ranges(placed, path, ["width", "height", "bits"], "digest binary, width int, height int, bits int", HEADER_BYTES, lambda data, _: header(data))


def _described(data: bytes, digest: bytes) -> tuple:
    if hashlib.sha256(data).digest() != digest:
        raise ValueError(f"object {digest.hex()} is not what was stored")
    samples = from_png(data)
    payload = samples.tobytes()
    return len(payload), hashlib.sha256(payload).digest(), zlib.crc32(payload[-16:]), len(data), feature_of(samples)


def with_features(placed: DataFrame, path: str) -> DataFrame:
    """digest and the payload columns of objects, from their stored bytes, which are held to the digest."""
    names = ["payload_bytes", "payload_sha", "tail_crc32", "media_bytes", "feature"]
    return _ranges(placed, path, names, "digest binary, payload_bytes long, payload_sha binary, tail_crc32 long, media_bytes long, feature string", None, _described)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, payload and media columns, width, height, bits and the object's place for every row of docs.

    The place is folder, shard, offset and length; the digest is media_sha256.  path: the
    shards' folder, which stays; a fresh one in the shared folder if not given.  Null and
    empty texts have a payload of one row of spaces; a long text is one object, held whole
    by one task at a time.  Equal texts share one object; repeated rows are each returned;
    other columns of docs are not.  An empty table gives no rows.
    """
    path = path or product(docs.sparkSession, "media-shards")
    rows = store(docs, path, id_col, text_col)
    stored = rows.select("digest", "shard", "offset", "length").distinct()
    placed = table(objects(stored), "media-objects")
    known = placed.join(with_features(placed, path), "digest").join(with_metadata(placed, path), "digest")
    at = stored.select("digest", F.col("shard").alias("own_shard"), F.col("offset").alias("own_offset")).join(known, "digest")
    own = rows.select("doc_id", "n_bytes", F.col("shard").alias("own_shard"), F.col("offset").alias("own_offset"))
    text = lambda c: F.lower(F.hex(c))
    return own.join(at, ["own_shard", "own_offset"]).select(
        "doc_id", "n_bytes", "payload_bytes", text("payload_sha").alias("payload_sha256"), "tail_crc32", "media_bytes", text("digest").alias("media_sha256"), "feature",
        "width", "height", "bits", F.lit(path).alias("folder"), "shard", "offset", "length",
    )
