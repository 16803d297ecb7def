"""Media columns: payloads stored as lossless WebP, read back as pixel arrays.

Four payload bytes are one pixel (blue, green, red, alpha); images are 16 pixels
wide, or a multiple of that where more than 16,384 rows would be needed.  Each file
uses the transform, colour cache and back-references that pay in it (see
``webp.encode_samples``).

Edge cases: a null or empty text is one block of 64 zero bytes; equal texts give
equal files; a text of over a gibibyte doesn't fit an image and raises; repeated
rows are stored each; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import lean, table
from .webp import decode, encode_samples

BLOCK = 64
TALLEST = 16_384
IMAGES = 8192
SAMPLES = 24_000_000


def payload(text: bytes) -> bytes:
    """``text`` with zero bytes up to a positive multiple of ``BLOCK``."""
    return text + b"\0" * (max(BLOCK, -(-len(text) // BLOCK) * BLOCK) - len(text))


def to_file(data: bytes) -> bytes:
    """``data``, a multiple of ``BLOCK`` bytes, as a WebP file."""
    rows = len(data) // BLOCK
    wide = -(-rows // TALLEST)
    height = -(-rows // wide)
    return encode_samples(data + b"\0" * (height * wide * BLOCK - len(data)), 16 * wide, height)


def average_hash(data: np.ndarray) -> str:
    """64 bits: which of 64 stretches are brighter than the whole."""
    edges = np.arange(64) * len(data) // 64
    sums = np.add.reduceat(data.astype(np.int64), edges)
    sizes = np.diff(np.append(edges, len(data)))
    bits = np.packbits(sums * len(data) > int(data.sum(dtype=np.int64)) * sizes)
    return bits.tobytes().hex()


STORED = "doc_id long, n_bytes long, payload_bytes long, media binary"
READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, height int, width int"


def store(docs: DataFrame) -> DataFrame:
    """Each text of ``docs`` (doc_id, text) as a WebP file in ``media``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, padded, files = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                raw = text.as_py() or b""
                data = payload(raw)
                sizes.append(len(raw))
                padded.append(len(data))
                files.append(to_file(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(padded, pa.int64()), pa.array(files, pa.binary())],
                names=["doc_id", "n_bytes", "payload_bytes", "media"],
            )

    return docs.select("doc_id", "text").mapInArrow(lean(run), STORED)


def samples_of(files: list[bytes], sizes: list[int]) -> Iterator[tuple[np.ndarray, tuple[int, int]]]:
    """The 8-bit samples of each file, cut to its size, and (height, width)."""
    at = 0
    while at < len(files):
        n, total = 0, 0
        while at + n < len(files) and n < IMAGES and (not n or total + sizes[at + n] <= SAMPLES):
            total += sizes[at + n]
            n += 1
        for pixels, size in zip(decode(files[at : at + n]), sizes[at : at + n], strict=True):
            yield pixels.astype("<u4").view(np.uint8).ravel()[:size], pixels.shape
        at += n


def read_back(stored: DataFrame) -> DataFrame:
    """Digests and a feature of each payload, from the stored files alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, sizes = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            rows = []
            for file, (data, shape) in zip(files, samples_of(files, sizes), strict=True):
                raw = data.tobytes()
                rows.append((hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-BLOCK:]), len(file), hashlib.sha256(file).hexdigest(), average_hash(data), *shape))
            names = [x.split()[0] for x in READ.split(", ")]
            types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32())
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=names)

    return stored.mapInArrow(lean(run), READ)


def op5_lossless_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's payload stored as lossless WebP and read back."""
    return read_back(store(table(spark, sf_dir, "documents")))
