import hashlib
import io
import zlib

import numpy as np
import pytest

from codegraph.llm import media

RNG = np.random.default_rng(1)


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 1), (4, 7, 3), (2, 8, 3)])
def test_images_come_back_as_they_were(shape):
    image = RNG.integers(0, 256, shape).astype(np.uint8)
    assert (media.decode(media.encode_netpbm(image)) == image).all()
    if shape[2] == 3:
        assert (media.decode(media.encode_bmp(image)) == image).all()


def test_plain_bitmap_and_deep_netpbm():
    assert media.decode(b"P2 # note\n2 2\n9\n1 2\n# more\n3 4").tolist() == [[[1], [2]], [[3], [4]]]
    assert media.decode(b"P3\n1 1\n255\n1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P1\n3 2\n101\n0 1 0").tolist() == [[[0], [255], [0]], [[255], [0], [255]]]
    assert media.decode(b"P4\n3 2\n" + bytes([0b10100000, 0b01000000])).tolist() == [[[0], [255], [0]], [[255], [0], [255]]]
    assert media.decode(b"P5\n1 2\n65535\n" + b"\x01\x00\x00\x02").tolist() == [[[256]], [[2]]]


def test_palette_and_top_down_bmp():
    palette = bytes([0, 0, 0, 0, 1, 2, 3, 0]) + bytes(254 * 4)
    import struct

    head = struct.pack(media.BMP_HEADER, b"BM", 0, 0, 0, 54 + 1024, 40, 2, -1, 1, 8, 0, 0, 0, 0, 0, 0)
    assert media.decode(head + palette + bytes([1, 0, 0, 0])).tolist() == [[[3, 2, 1], [0, 0, 0]]]


def resized(gray, height, width):
    """Overlap-weighted means, cell by cell."""
    rows, cols = gray.shape
    out = np.zeros((height, width))
    for i in range(height):
        for j in range(width):
            a, b, c, d = i * rows / height, (i + 1) * rows / height, j * cols / width, (j + 1) * cols / width
            total = 0.0
            for y in range(int(a), int(np.ceil(b))):
                for x in range(int(c), int(np.ceil(d))):
                    total += gray[y, x] * (min(b, y + 1) - max(a, y)) * (min(d, x + 1) - max(c, x))
            out[i, j] = total / ((b - a) * (d - c))
    return out


@pytest.mark.parametrize("shape", [(1, 1), (5, 3), (17, 24), (9, 8)])
def test_area_resize(shape, monkeypatch):
    gray = RNG.integers(0, 256, shape).astype(np.uint8)
    for band in (1 << 20, 24):
        monkeypatch.setattr(media, "BAND_SAMPLES", band)
        assert np.allclose(media.area_resize(gray, 8, 9), resized(gray, 8, 9))


def test_tiles_are_npy_files():
    tile = np.load(io.BytesIO(media.npy_tile(RNG.integers(0, 256, (50, 70)).astype(np.uint8))))
    assert tile.shape == (32, 32) and tile.dtype == np.uint8


def test_texts(spark, odd):
    rows = media.store_texts(odd).collect()
    assert len(rows) == odd.count()
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    for r in rows:
        raw = next(t for i, t in texts if i == r.doc_id and len((t or "").encode()) == r.n_bytes)
        raw = (raw or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert len({(r.media_sha256, r.feature) for r in rows if r.doc_id in (2, 3)}) == 1
    assert media.store_texts(odd.limit(0)).count() == 0


def test_features_by_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = ["short", "", None, *("".join(map(chr, rng.integers(32, 500, n))) for n in (300, 700, 900, 1500))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in media.store_texts(rows).collect():
        gray = media.luma(media.decode(media.pack_payload(media.payload_of(texts[r.doc_id])[1]))).astype(float)
        cells, tile = np.rint(resized(gray, 8, 9) * 256), np.load(io.BytesIO(r.tile))
        bits = "".join("1" if b > a else "0" for row in cells for a, b in zip(row[:-1], row[1:], strict=True))
        assert r.feature == f"{int(bits, 2):016x}-{zlib.crc32(r.tile):08x}"
        assert np.abs(tile - resized(gray, 32, 32)).max() <= 0.5 + 1e-6


@pytest.mark.parametrize("data", [b"P2 1 1 255 70000", b"P2 1 1 255 300", b"P3 1 1 255 1 2 300", b"P2 99999999999999999999 99999999999999999999 255 1", b"P5 0 0 255 ", b"P5 0 5 255 ", b"P5 1 1 0 A", b"P5 1 1 70000 AB", b"P5 4000000000 4000000000 255 A", b"P2 1 1 255 x", b"BM", b"P7 1 1", b"", b"BM" + bytes(60)])
def test_broken_images_have_nulls(spark, data):
    row = media.decode_images(spark.createDataFrame([(1, bytearray(data))], "n int, data binary"), "n", "data").first()
    assert (row.height, row.width, row.channels, row.dhash, row.tile) == (None,) * 5


def test_tiles_are_written(spark, odd, tmp_path):
    media.write_tiles(media.store_texts(odd), str(tmp_path / "tiles"))
    rows = spark.read.parquet(str(tmp_path / "tiles")).collect()
    assert len(rows) == odd.count() and all(np.load(io.BytesIO(r.tile)).shape == (32, 32) for r in rows)


def test_other_columns_and_broken_images(spark):
    rows = media.decode_images(spark.createDataFrame([(1, bytearray(b"P5 1 1 255 A"), 5), (2, bytearray(b"no image"), 6), (3, None, 7)], "n int, data binary, height int"), "n", "data").collect()
    assert [(r.n, r.height) for r in rows] == [(1, 1), (2, None), (3, None)]
