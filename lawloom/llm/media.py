"""Texts as grey PNG images in binary columns.

The encoder writes 8-bit grey PNG with one zlib stream split over chunks of
bounded size; the decoder checks every chunk's checksum, inflates and reverses
the row filters in numpy, and a hash of the low cosine frequencies describes the
picture.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm.encode import text_blocks
from lawloom.llm.scratch import new_path

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
CHUNK = 1 << 16
_k, _i = np.meshgrid(np.arange(8), np.arange(32), indexing="ij")
COSINES = np.cos(np.pi * _k * (2 * _i + 1) / 64)


def padded(raw: bytes, unit: int = WIDTH) -> bytes:
    """``raw`` with bytes 0 up to a positive multiple of ``unit``."""
    return raw + bytes(max(unit, -(-len(raw) // unit) * unit) - len(raw))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def row_filters(pixels: np.ndarray) -> np.ndarray:
    """For each row the filter that pays: left or up where over half of its differences vanish and more than without a filter, else none.

    Letters compress worse as differences than as they are, so the usual rule of least sums would
    enlarge texts by half. These three filters are reversed in numpy without a loop over pixels.
    """
    left, up = pixels.copy(), pixels.copy()
    left[:, 1:] -= pixels[:, :-1]
    up[1:] -= pixels[:-1]
    zeros = np.stack([(x == 0).sum(axis=1) for x in (pixels, left, up)])
    zeros[0] = np.maximum(zeros[0], pixels.shape[1] // 2)
    return np.argmax(zeros, axis=0).astype(np.uint8)


def encode_png(pixels: np.ndarray, filters: np.ndarray | int = 0, level: int = 6) -> bytes:
    """Rows of 8-bit samples as a grey PNG; ``filters`` is the filter type 0 to 4 of all rows or of each."""
    rows, cols = pixels.shape
    kind = np.broadcast_to(np.asarray(filters, np.uint8), rows)
    body = pixels
    if kind.any():
        x = pixels if kind.max() <= 2 else pixels.astype(np.int16)
        left, up = np.zeros_like(x), np.zeros_like(x)
        left[:, 1:], up[1:] = x[:, :-1], x[:-1]
        guesses = [left, up]
        if kind.max() > 2:
            corner = np.zeros_like(x)
            corner[1:, 1:] = x[:-1, :-1]
            guesses += [(left + up) // 2, _paeth(left, up, corner)]
        guess = np.select([(kind == t)[:, None] for t in range(1, len(guesses) + 1)], guesses, 0)
        body = (x - guess).astype(np.uint8)
    data = zlib.compress(np.concatenate([kind[:, None], body], axis=1).tobytes(), level)
    head = _chunk(b"IHDR", struct.pack(">IIBBBBB", cols, rows, 8, 0, 0, 0, 0))
    return SIGNATURE + head + b"".join(_chunk(b"IDAT", data[at : at + CHUNK]) for at in range(0, len(data), CHUNK)) + _chunk(b"IEND", b"")


def _paeth(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    p = a + b - c
    da, db, dc = abs(p - a), abs(p - b), abs(p - c)
    return np.where((da <= db) & (da <= dc), a, np.where(db <= dc, b, c))


def decode_png(content: bytes) -> np.ndarray:
    """Pixels of an 8-bit grey PNG without interlace. ValueError for another form, a wrong checksum or missing data."""
    if content[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, shape, data, ended = 8, None, [], False
    while at + 12 <= len(content) and not ended:
        n, kind = struct.unpack_from(">I4s", content, at)
        body = content[at + 8 : at + 8 + n]
        if at + 12 + n > len(content) or zlib.crc32(kind + body) != struct.unpack_from(">I", content, at + 8 + n)[0]:
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            cols, rows, *form = struct.unpack(">IIBBBBB", body)
            if form != [8, 0, 0, 0, 0]:
                raise ValueError("only 8-bit grey without interlace")
            shape = rows, cols
        elif kind == b"IDAT":
            data.append(body)
        ended = kind == b"IEND"
        at += 12 + n
    if shape is None or not ended:
        raise ValueError("incomplete")
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if raw.size != shape[0] * (shape[1] + 1):
        raise ValueError("wrong amount of data")
    raw = raw.reshape(shape[0], shape[1] + 1)
    return unfiltered(raw[:, 0], raw[:, 1:])


def unfiltered(kind: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Reverse the row filters. Where rows use the average or Paeth filter, pixels are done along diagonals."""
    if (kind > 4).any():
        raise ValueError("unknown filter")
    if not kind.any():
        return body.copy()
    if (kind <= 2).all():
        x = np.where((kind == 1)[:, None], np.cumsum(body, axis=1, dtype=np.uint8), body)
        if (kind == 2).any():  # a run of such rows adds up from the row above it
            up = kind == 2
            sums = np.cumsum(np.where(up[:, None], body, 0), axis=0, dtype=np.uint8)
            base = np.maximum.accumulate(np.where(up, -1, np.arange(len(kind))))
            above = np.where((base >= 0)[:, None], x[base] - sums[base], 0).astype(np.uint8)
            x = np.where(up[:, None], sums + above, x)
        return x
    rows, cols = body.shape
    x = np.zeros((rows + 1, cols + 1), np.int16)
    delta = body.astype(np.int16)
    for d in range(rows + cols - 1):
        r = np.arange(max(0, d - cols + 1), min(rows, d + 1))
        c, t = d - r, kind[r]
        a, b, e = x[r + 1, c], x[r, c + 1], x[r, c]
        guess = np.select([t == 1, t == 2, t == 3, t == 4], [a, b, (a + b) // 2, _paeth(a, b, e)], 0)
        x[r + 1, c + 1] = (delta[r, c] + guess) & 255
    return x[1:, 1:].astype(np.uint8)


def cosine_hash(pixels: np.ndarray) -> str:
    """64 bits: which of the 8 by 8 lowest cosine frequencies of the picture, shrunk to 32 by 32, lie above their median; the constant one counts as 0."""

    def shrink(x: np.ndarray) -> np.ndarray:
        n = len(x)
        if n < 32:
            return x[np.arange(32) * n // 32]
        edge = np.arange(33) * n // 32
        sums = np.add.reduceat(x, edge[:-1], axis=0)
        return sums / np.diff(edge)[:, None]

    small = shrink(shrink(pixels.astype(np.float64)).T).T
    low = np.round(COSINES @ small @ COSINES.T, 6).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes().hex()


def _images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in text_blocks(b):
            media, n = [], []
            for x in part.column("text"):
                raw = x.as_py().encode()
                n.append(len(raw))
                pixels = np.frombuffer(padded(raw), np.uint8).reshape(-1, WIDTH)
                media.append(encode_png(pixels, row_filters(pixels)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def text_images(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every whole text (null: empty) as UTF-8 in a PNG 64 samples wide, filled up with 0, each row with the filter that ``row_filters`` chooses."""
    return docs.select("doc_id", "text").mapInArrow(_images, "doc_id long, n_bytes long, media binary")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for x in b.column("media"):
            content = x.as_py()
            pixels = decode_png(content)
            raw = pixels.tobytes()
            rows.append((len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(content), hashlib.sha256(content).hexdigest(), cosine_hash(pixels)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)


def image_features(images: DataFrame) -> DataFrame:
    """Digests and the cosine hash of each stored picture, from its decoded samples. Equal texts have equal values."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return images.select("doc_id", "n_bytes", "media").mapInArrow(_features, schema)


def media_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pictures of ``docs`` as a table and read it back."""
    spark: SparkSession = docs.sparkSession
    path = path or new_path(spark, "media")
    text_images(docs).write.option("compression", "uncompressed").parquet(path)
    return spark.read.schema("doc_id long, n_bytes long, media binary").parquet(path).select(F.col("doc_id"), F.col("n_bytes"), F.col("media"))
