"""Media columns: Netpbm and BMP bytes to numpy arrays, area resize by integral images, NPY tiles and difference hashes.

Supported: Netpbm P1 to P6 (text or binary, bitmaps, samples of 8 or 16 bits) and uncompressed BMP of 1, 4, 8 (palette), 24 and 32 bits,
bottom-up or top-down. Null, empty, broken, zero-sized or unsupported media give null features. Texts are stored losslessly as pictures
by ``pack_payload`` (null text: as an empty one) and read back by ``decode``. Pictures are summed up band by band, so that what a task
holds beside the media is bounded by a few rows of pixels. Rows are judged one by one: repeated rows give equal results, there are no
ties, and an empty table gives no rows. Only doc_id and text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import crc32, map_texts

#: A payload is a multiple of this many bytes, so that rows of 24 grey or 8 RGB pixels fill it, each a multiple of four bytes as BMP rows are.
BLOCK = 576
ROW_BYTES = 24
FORMATS = ("P5", "P6", "BM8", "BM24")


def padded(data: bytes) -> bytes:
    """Appends bytes 255 up to a positive multiple of BLOCK."""
    return data + b"\xff" * (-len(data) % BLOCK if data else BLOCK)


def pack_payload(payload: bytes) -> bytes:
    """A picture that holds the payload as 8-bit samples; the payload's crc32 picks the format, so equal payloads give equal media."""
    rows = len(payload) // ROW_BYTES
    kind = FORMATS[crc32(payload) % len(FORMATS)]
    if kind == "P5":
        return b"P5\n%d %d\n255\n" % (ROW_BYTES, rows) + payload
    if kind == "P6":
        return b"P6\n%d %d\n255\n" % (ROW_BYTES // 3, rows) + payload
    samples = np.frombuffer(payload, np.uint8)
    if kind == "BM8":
        palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).copy()
        palette[:, 3] = 0
        return _bmp(ROW_BYTES, rows, 8, palette.tobytes(), samples.reshape(rows, ROW_BYTES)[::-1].tobytes())
    pixels = samples.reshape(rows, ROW_BYTES // 3, 3)[::-1, :, ::-1]  # bottom-up, blue first
    return _bmp(ROW_BYTES // 3, rows, 24, b"", pixels.tobytes())


def _bmp(width: int, height: int, depth: int, palette: bytes, pixels: bytes) -> bytes:
    start = 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", start + len(pixels), 0, 0, start)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, depth, 0, len(pixels), 2835, 2835, len(palette) // 4, 0)
    return head + info + palette + pixels


@dataclass(frozen=True)
class Picture:
    """height x width (grey) or height x width x 3 (RGB) samples of uint8 or uint16, and the value of full light."""

    samples: np.ndarray
    most: int = 255


_GAP = rb"(?:\s|#[^\n\r]*[\n\r])+"
_PNM = re.compile(rb"P([1-6])" + _GAP + rb"(\d{1,9})" + _GAP + rb"(\d{1,9})")
_MOST = re.compile(_GAP + rb"(\d{1,5})")


def decode(media: bytes) -> Picture:
    """The picture of Netpbm or BMP bytes. ValueError if they are none of the supported forms."""
    if m := _PNM.match(media):
        return _netpbm(media, int(m[1]), int(m[2]), int(m[3]), m.end())
    if media[:2] == b"BM" and len(media) >= 54:
        return _bitmap(media)
    raise ValueError("neither Netpbm nor BMP")


def _netpbm(media: bytes, form: int, width: int, height: int, at: int) -> Picture:
    if not width or not height:
        raise ValueError("an empty picture")
    bits, text = form in (1, 4), form <= 3
    most = 1
    if not bits:
        m = _MOST.match(media, at)
        if not m or not 0 < int(m[1]) < 65536:
            raise ValueError("no greatest value")
        most, at = int(m[1]), m.end()
    shape = (height, width, 3) if form in (3, 6) else (height, width)
    size = height * width * (3 if form in (3, 6) else 1)
    if text:
        body = re.sub(rb"#[^\n\r]*", b"", media[at:])
        values = np.frombuffer(body, np.uint8)[np.isin(np.frombuffer(body, np.uint8), (48, 49))] - 48 if bits else _whole_numbers(body.split()[:size])
        if len(values) < size or (values[:size] > most).any() or (values[:size] < 0).any():
            raise ValueError("too few samples, or ones out of range")
        samples = values[:size].astype(np.uint8 if most < 256 else np.uint16).reshape(shape)
        return Picture(1 - samples if bits else samples, most)
    at += 1  # one white-space character
    wide = 2 if most > 255 else 1
    stride = (width + 7) // 8 if bits else size // height * wide
    if len(media) < at + stride * height:
        raise ValueError("too few samples")
    if bits:
        rows = np.frombuffer(media, np.uint8, stride * height, at).reshape(height, stride)
        return Picture(1 - np.unpackbits(rows, axis=1)[:, :width], 1)  # 1 is black
    samples = np.frombuffer(media, np.uint8 if wide == 1 else ">u2", size, at).reshape(shape)
    if most not in (255, 65535) and (samples > most).any():
        raise ValueError("samples out of range")
    return Picture(samples, most)


def _whole_numbers(words: list[bytes]) -> np.ndarray:
    try:
        return np.array(words, np.int64)
    except OverflowError:
        raise ValueError("samples out of range") from None


def _bitmap(media: bytes) -> Picture:
    start, (head, width, height, _, depth, packed) = struct.unpack_from("<I", media, 10)[0], struct.unpack_from("<IiiHHI", media, 14)
    if packed or depth not in (1, 4, 8, 24, 32) or head < 40:
        raise ValueError("only uncompressed BMP of 1, 4, 8, 24 or 32 bits")
    if width <= 0 or not height:
        raise ValueError("an empty picture")
    tall, stride = abs(height), (width * depth + 31) // 32 * 4
    if len(media) < start + stride * tall:
        raise ValueError("too few samples")
    rows = np.frombuffer(media, np.uint8, stride * tall, start).reshape(tall, stride)
    rows = rows[::-1] if height > 0 else rows
    if depth >= 24:
        return Picture(rows[:, : width * depth // 8].reshape(tall, width, depth // 8)[:, :, 2::-1])  # blue comes first
    n = min(struct.unpack_from("<I", media, 46)[0] or 1 << depth, 1 << depth)
    if len(media) < 14 + head + 4 * n:
        raise ValueError("too few colours")
    colours = np.zeros((256, 3), np.uint8)
    colours[:n] = np.frombuffer(media, np.uint8, 4 * n, 14 + head).reshape(n, 4)[:, 2::-1]
    if depth < 8:
        parts = 8 // depth
        rows = (rows[:, :, None] >> np.arange(8 - depth, -1, -depth, dtype=np.uint8) & ((1 << depth) - 1)).reshape(tall, stride * parts)
    rows = rows[:, :width]
    if (colours[:, :1] != colours).any():
        return Picture(colours[rows])
    return Picture(rows if (colours[:, 0] == np.arange(256)).all() else colours[rows, 0])


#: Pixels of a band whose integral image is held at a time (one row at least).
BAND_PIXELS = 1 << 18


def area_resize(picture: Picture, *sizes: tuple[int, int]) -> list[np.ndarray]:
    """For each (height, width) the means of the target cells' areas in grey from 0 to 255, fractions of pixels included.

    The integral image is made band by band; of each band only its values at the targets' edges are kept.
    """
    samples = picture.samples
    h, w = samples.shape[:2]
    edges = []
    for height, width in sizes:
        ys, xs = np.linspace(0, h, height + 1), np.linspace(0, w, width + 1)
        y, x = np.minimum(ys.astype(np.int64), h - 1), np.minimum(xs.astype(np.int64), w - 1)
        edges.append((y, (ys - y)[:, None], x, xs - x))
    corners = [np.zeros((height + 1, width + 1)) for height, width in sizes]
    above = [np.zeros(width + 1) for _, width in sizes]
    band = max(1, BAND_PIXELS // w)
    for top in range(0, h, band):
        part = samples[top : top + band]
        light = part.mean(axis=2) if part.ndim == 3 else part
        table = np.zeros((len(part) + 1, w + 1))
        np.cumsum(light, axis=0, dtype=np.float64, out=table[1:, 1:])
        np.cumsum(table[1:, 1:], axis=1, out=table[1:, 1:])
        for k, (y, dy, x, dx) in enumerate(edges):
            at_x = above[k] + table[:, x] * (1 - dx) + table[:, x + 1] * dx
            here = np.flatnonzero((y >= top) & (y < top + len(part)))
            corners[k][here] = at_x[y[here] - top] * (1 - dy[here]) + at_x[y[here] - top + 1] * dy[here]
            above[k] = at_x[-1]
    return [(c[1:, 1:] - c[:-1, 1:] - c[1:, :-1] + c[:-1, :-1]) / (h / height * w / width) * (255 / picture.most) for c, (height, width) in zip(corners, sizes, strict=True)]


#: Side of a tile; rows and columns that a difference hash compares.
TILE, HASH = 32, (8, 9)


def difference_hash(cells: np.ndarray) -> str:
    """64 bits: whether each of 8 x 9 resized cells is darker than its right neighbour."""
    return np.packbits(cells[:, :-1] + 1e-9 < cells[:, 1:]).tobytes().hex()


def npy(cells: np.ndarray) -> bytes:
    """Resized cells as the bytes of an NPY file of uint8."""
    out = io.BytesIO()
    np.lib.format.write_array(out, np.rint(cells).clip(0, 255).astype(np.uint8), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def read_npy(tile: bytes) -> np.ndarray:
    return np.lib.format.read_array(io.BytesIO(tile), allow_pickle=False)


MEDIA_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("media", T.BinaryType()),
    ]
)


def texts_to_media(docs: DataFrame) -> DataFrame:
    """The media column: each text (null: empty) as one picture, with its unpadded length."""

    def rows(ids, texts):
        raw = [(t or "").encode() for t in texts]
        return ids, [len(r) for r in raw], [pack_payload(padded(r)) for r in raw]

    return map_texts(docs, rows, MEDIA_SCHEMA)


FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("media_bytes", T.LongType()),
        T.StructField("media_sha256", T.StringType()),
        T.StructField("tile", T.BinaryType()),
        T.StructField("dhash", T.StringType()),
    ]
)


def features_of(data: bytes | None, keep_payload: bool) -> tuple:
    """(samples, length, sha256, NPY tile, difference hash) of a picture's bytes."""
    if data is None:
        return None, None, None, None, None
    size, digest = len(data), hashlib.sha256(data).hexdigest()
    try:
        picture = decode(data)
    except ValueError:
        return None, size, digest, None, None
    tile, cells = area_resize(picture, (TILE, TILE), HASH)
    return picture.samples.tobytes() if keep_payload else None, size, digest, npy(tile), difference_hash(cells)


def media_features(media: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Decodes a media column (doc_id, n_bytes, media) and returns its samples, an NPY tile and a difference hash; nulls for null or broken media."""
    import pyarrow as pa

    from .common import pa_schema, slices

    def run(batches):
        schema = pa_schema(FEATURE_SCHEMA)
        for whole in batches:
            for batch in slices(whole, 2):
                rows = [(i, n, *features_of(data, keep_payload)) for i, n, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
                columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURE_SCHEMA)


def write_tiles(media: DataFrame, path: str) -> None:
    """Writes (doc_id, tile, dhash) of a media column as Parquet; a tile is a whole NPY file."""
    media_features(media, keep_payload=False).where("tile is not null").select("doc_id", "tile", "dhash").write.parquet(path)
