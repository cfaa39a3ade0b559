"""Operator 1, media columns: Netpbm and BMP as numpy arrays, area-resized by integral images, NPY tiles, difference hashes.

`decode_images` takes any DataFrame with an id and a binary column and adds what it finds in the image;
`store_texts` is the digest query over documents, which keeps each text as the samples of an image, in a table of the
shared folder that is read again for the features; `write_tiles` keeps the tiles as a table of NPY files.

Defined results: a null or undecodable image, one without pixels and one with samples above its maximum have null results; a null text is the empty one; equal bytes have
equal results; no rows have no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, utf8

UNIT = 576
BAND_SAMPLES = 1 << 20
TILE = 32
#: Fixed values of the two formats: Netpbm magic numbers (plain and raw) and the 54-byte BMP header.
NETPBM = {b"P1": ("bit", 1, True), b"P2": ("gray", 1, True), b"P3": ("rgb", 3, True), b"P4": ("bit", 1, False), b"P5": ("gray", 1, False), b"P6": ("rgb", 3, False)}
BMP_HEADER = "<2sIHHIIiiHHIIiiII"


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 as (height, width, channels) uint8, or uint16 for a maximum over 255; bitmaps are 0 black, 255 white."""
    kind, channels, plain = NETPBM[data[:2]]
    fields, at = [], 2
    while len(fields) < (2 if kind == "bit" else 3):
        m = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*(\d+)").match(data, at)
        if not m:
            raise ValueError("netpbm header")
        fields.append(int(m[1]))
        at = m.end()
    width, height = fields[:2]
    top = fields[2] if len(fields) > 2 else 1
    if not (width and height and 0 < top < 1 << 16):
        raise ValueError("netpbm sizes")
    if plain:
        body = re.sub(rb"#[^\n\r]*", b"", data[at:])
        flat = np.array([int(x) for x in (re.findall(rb"[01]", body) if kind == "bit" else body.split())[: width * height * channels]], np.int64)
    elif kind == "bit":
        rows = np.frombuffer(data, np.uint8, (width + 7) // 8 * height, at + 1).reshape(height, -1)
        flat = np.unpackbits(rows, axis=1)[:, :width].reshape(-1).astype(np.uint16)
    else:
        flat = np.frombuffer(data, ">u2" if top > 255 else np.uint8, width * height * channels, at + 1)
    if flat.size != width * height * channels:
        raise ValueError("netpbm samples")
    if flat.max() > top:
        raise ValueError("a sample is above the maximum")
    if kind == "bit":
        flat = (1 - flat) * 255
    return flat.astype(np.uint16 if top > 255 else np.uint8).reshape(height, width, channels)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed 8-bit palette and 24- or 32-bit BMP, bottom-up or top-down, as (height, width, 1 or 3) uint8."""
    head = struct.unpack_from(BMP_HEADER, data)
    offset, size, width, rows, bits, packed, used = head[4], head[5], head[6], head[7], head[9], head[10], head[14]
    if head[0] != b"BM" or packed or bits not in (8, 24, 32) or width < 1 or not rows:
        raise ValueError("bmp kind")
    height, stride = abs(rows), (width * bits // 8 + 3) // 4 * 4
    lines = np.frombuffer(data, np.uint8, stride * height, offset).reshape(height, stride)[:, : width * bits // 8]
    image = lines.reshape(height, width, bits // 8)
    if bits == 8:
        colours = np.frombuffer(data, np.uint8, 4 * (used or 256), 14 + size).reshape(-1, 4)[:, 2::-1]
        image = colours[image[:, :, 0]]
        image = image[:, :, :1] if (colours == colours[:, :1]).all() else image
    else:
        image = image[:, :, 2::-1]
    return np.ascontiguousarray(image[::-1] if rows > 0 else image)


def decode(data: bytes) -> np.ndarray:
    if data[:2] == b"BM":
        return decode_bmp(data)
    if data[:2] in NETPBM:
        return decode_netpbm(data)
    raise ValueError("unknown image")


def encode_netpbm(image: np.ndarray) -> bytes:
    height, width, channels = image.shape
    return b"P%d\n%d %d\n255\n" % (5 if channels == 1 else 6, width, height) + image.astype(np.uint8).tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    """24 bits, bottom-up."""
    height, width, _ = image.shape
    pad = -width * 3 % 4
    rows = np.pad(image[::-1, :, ::-1].reshape(height, width * 3), ((0, 0), (0, pad))).tobytes()
    return struct.pack(BMP_HEADER, b"BM", 54 + len(rows), 0, 0, 54, 40, width, height, 1, 24, 0, len(rows), 2835, 2835, 0, 0) + rows


def area_resize(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each cell of a (height, width) grid, fractional borders included, from the integral image.

    Only the integral's rows next to a cell border are kept; the running one goes on by bands, so memory does
    not follow the image's height.
    """
    rows, cols = gray.shape
    ys, xs = np.arange(height + 1) * rows / height, np.arange(width + 1) * cols / width
    need = np.unique(np.concatenate([np.floor(ys), np.ceil(ys)]).astype(int))
    kept, running, at = {0: np.zeros(cols + 1)}, np.zeros(cols + 1), 0
    step = max(1, BAND_SAMPLES // max(1, cols))
    while at < rows:
        band = gray[at : at + step].astype(np.float64)
        integral = np.zeros((band.shape[0], cols + 1))
        np.cumsum(np.cumsum(band, axis=0), axis=1, out=integral[:, 1:])
        integral += running
        for y in need[(need > at) & (need <= at + band.shape[0])]:
            kept[int(y)] = integral[y - at - 1].copy()
        running, at = integral[-1].copy(), at + band.shape[0]
    low, high = np.floor(xs).astype(int), np.ceil(xs).astype(int)
    across = []
    for y in ys:
        a, b = kept[int(np.floor(y))], kept[int(np.ceil(y))]
        line = a + (b - a) * (y - np.floor(y))
        across.append(line[low] + (line[high] - line[low]) * (xs - low))
    sums = np.diff(np.diff(np.array(across), axis=0), axis=1)
    return sums / (rows / height * cols / width)


def luma(image: np.ndarray) -> np.ndarray:
    """Integer luminance by the fixed weights 299, 587, 114; one channel stays as it is."""
    if image.shape[2] == 1:
        return image[:, :, 0]
    return ((image @ np.array([299, 587, 114])) // 1000).astype(image.dtype)


def difference_hash(gray: np.ndarray) -> int:
    """64 bits: each cell of an 8 by 9 area-resized image against its right neighbour."""
    cells = np.rint(area_resize(gray, 8, 9) * 256).astype(np.int64)
    return int.from_bytes(np.packbits(cells[:, 1:] > cells[:, :-1]).tobytes(), "big")


def npy_tile(gray: np.ndarray, side: int = TILE) -> bytes:
    """The area-resized square tile as a whole NPY file."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(area_resize(gray, side, side)), 0, 65535).astype(np.uint16 if gray.dtype.itemsize > 1 else np.uint8))
    return out.getvalue()


IMAGE_SCHEMA = "height long, width long, channels int, dhash string, tile binary"


def decode_images(images: DataFrame, id_column: str, data_column: str, side: int = TILE) -> DataFrame:
    """(id, height, width, channels, dhash, tile): what each row's image holds; nulls where it can't be decoded."""
    kind = images.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column(1).to_pylist():
                try:
                    image = decode(data)
                    gray = luma(image)
                    rows.append((*image.shape, f"{difference_hash(gray):016x}", npy_tile(gray, side)))
                except (ValueError, TypeError, KeyError, struct.error, IndexError, OverflowError):
                    rows.append((None,) * 5)
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [id_column, "height", "width", "channels", "dhash", "tile"])

    return images.select(id_column, data_column).mapInArrow(run, f"`{id_column}` {kind}, {IMAGE_SCHEMA}")


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = utf8(text)
    return len(raw), raw + b"\xff" * (UNIT - len(raw) % UNIT if len(raw) % UNIT or not raw else 0)


def pack_payload(payload: bytes) -> bytes:
    """The payload as an image of whole 24-byte rows: PGM, PPM or BMP, as its checksum says."""
    kind = zlib.crc32(payload) % 3
    samples = np.frombuffer(payload, np.uint8)
    if kind == 0:
        return encode_netpbm(samples.reshape(-1, 24, 1))
    return (encode_netpbm if kind == 1 else encode_bmp)(samples.reshape(-1, 8, 3))


def encode_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text kept losslessly as the samples of an image file."""

    def run(batches):
        for batch in batches:
            made = [(n, pack_payload(p)) for n, p in map(payload_of, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.large_binary()).cast(pa.binary())], ["doc_id", "n_bytes", "media"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def store_texts(documents: DataFrame) -> DataFrame:
    """One row for each document: the media column is written and read back, its samples are digested, and the NPY tiles
    are written and read back too. `feature`: difference hash and checksum of the stored tile."""

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(7)]
            for media in batch.column("media").to_pylist():
                image = decode(media)
                payload, gray = image.tobytes(), luma(image)
                for k, v in enumerate((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), f"{difference_hash(gray):016x}", npy_tile(gray))):
                    out[k].append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(v, t) for v, t in zip(out, kinds, strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "dhash", "tile"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, dhash string, tile binary"
    tiles = materialise(materialise(encode_texts(documents), "media").mapInArrow(run, schema), "tiles")
    checksum = F.lpad(F.lower(F.hex(F.crc32("tile"))), 8, "0")
    return tiles.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.concat_ws("-", "dhash", checksum).alias("feature"), "tile")


def write_tiles(rows: DataFrame, path: str, id_column: str = "doc_id", hash_column: str = "feature") -> None:
    """The tiles that rows of `store_texts` or `decode_images` have, with their ids and hashes, as a table at `path`."""
    rows.filter("tile is not null").select(id_column, hash_column, "tile").write.option("compression", "zstd").parquet(path)
