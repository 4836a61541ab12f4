"""Heightmaps as 16-bit grey PNG images, packed by tasks: images of tiles, or bands of one image that are joined in order."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from urbanframe.operators.staging import remove, written

#: The format's first bytes, the last block of a deflate stream without data, and the modulus of its checksum.
SIGNATURE, END_BLOCK, MODULUS = b"\x89PNG\r\n\x1a\n", b"\x03\x00", 65521
#: Bytes of pixels that one task packs at a time.
BAND_BYTES = 4 << 20
MOST_SIDE = (1 << 31) - 1


def _part(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _head(height: int, width: int) -> bytes:
    """All that stands before the pixels: 16 bits, grey, and the header of the compressed stream."""
    return SIGNATURE + _part(b"IHDR", struct.pack(">IIBBBBB", width, height, 16, 0, 0, 0, 0)) + _part(b"IDAT", b"\x78\x9c")


def _tail(checksum: int) -> bytes:
    return _part(b"IDAT", END_BLOCK + struct.pack(">I", checksum)) + _part(b"IEND", b"")


def _packed(rows: pd.DataFrame, height: int, width: int) -> tuple[bytes, int, int]:
    """(image data, checksum, bytes before packing) of rows (r, c, pixel) counted from 0; pixels without a row are 0."""
    grid = np.zeros((height, width), ">u2")
    grid[rows["r"], rows["c"]] = rows["pixel"]
    raw = np.empty((height, 1 + 2 * width), np.uint8)
    raw[:, 0] = 1  # each byte is stored less the one of the pixel to its left
    raw[:, 1:] = grid.view(np.uint8)
    raw[:, 3:] -= grid.view(np.uint8)[:, :-2]
    data = raw.tobytes()
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    return _part(b"IDAT", packer.compress(data) + packer.flush(zlib.Z_FULL_FLUSH)), zlib.adler32(data), len(data)


def joined_checksum(parts: Iterator[tuple[int, int]]) -> int:
    """The Adler-32 of bytes in a row from (checksum, bytes) of each part."""
    low, high = 1, 0
    for checksum, size in parts:
        high = (high + (checksum >> 16) + size * (low - 1)) % MODULUS
        low = (low + (checksum & 0xFFFF) - 1) % MODULUS
    return high << 16 | low


def _known(pixels: DataFrame) -> DataFrame:
    """The last of equal places would depend on the order of rows, so the greatest pixel of each stays."""
    kept = pixels.filter("row IS NOT NULL AND col IS NOT NULL AND pixel BETWEEN 0 AND 65535")
    return kept.groupBy(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")).agg(F.max("pixel").cast("int").alias("pixel"))


def tile_images(pixels: DataFrame, size: int) -> DataFrame:
    """(tile_row, tile_col, image): a PNG of size by size pixels for each tile with a pixel of (row, col, pixel), others ignored.

    A task packs one tile at a time. Places without a pixel are 0, as are those with null or out of 16 bits; of repeated
    places the greatest pixel counts; rows with a null place are left out. Tables without rows give no tile.
    """
    at = _known(pixels).select(F.floor(F.col("row") / size).alias("tile_row"), F.floor(F.col("col") / size).alias("tile_col"), F.pmod("row", F.lit(size)).alias("r"), F.pmod("col", F.lit(size)).alias("c"), "pixel")

    def image(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        data, checksum, _ = _packed(rows, size, size)
        return pd.DataFrame([(*key, _head(size, size) + data + _tail(checksum))], columns=["tile_row", "tile_col", "image"])

    return at.groupBy("tile_row", "tile_col").applyInPandas(image, "tile_row long, tile_col long, image binary")


def image_bands(pixels: DataFrame, height: int, width: int, band_bytes: int = BAND_BYTES) -> DataFrame:
    """(band, data, checksum, bytes) of one image's rows, as many rows in a band as band_bytes hold, one at least.

    The data of all bands in order, between head and tail, are the image. Pixels (row, col, pixel) outside of it are
    ignored; for the rest see tile_images. Bands without a pixel are packed too.
    """
    if not (0 < height <= MOST_SIDE and 0 < width <= MOST_SIDE):
        raise ValueError(f"an image has 1 to {MOST_SIDE} rows and columns")
    deep = min(height, max(1, band_bytes // (2 * width + 1)))
    bands = -(-height // deep)
    at = _known(pixels).filter(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
    at = at.select(F.floor(F.col("row") / deep).alias("band"), F.pmod("row", F.lit(deep)).alias("r"), "col", "pixel")
    none = pixels.sparkSession.range(bands).select(F.col("id").alias("band"), F.lit(0).cast("long").alias("r"), F.lit(None).cast("long").alias("col"), F.lit(None).cast("int").alias("pixel"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.dropna().astype({"col": "int64", "pixel": "int64"}).rename(columns={"col": "c"})
        data, checksum, size = _packed(rows, min(deep, height - key[0] * deep), width)
        return pd.DataFrame([(*key, data, checksum, size)], columns=["band", "data", "checksum", "bytes"])

    return at.unionByName(none).groupBy("band").applyInPandas(pack, "band long, data binary, checksum long, bytes long")


def write_image(pixels: DataFrame, height: int, width: int, path: str, band_bytes: int = BAND_BYTES) -> None:
    """One PNG file at path, a Hadoop path, which must not exist; it gets its name once it is whole.

    Tasks pack the bands and write them as a table. One file has one writer: the driver appends the packed bands, and holds
    one of them at a time. tile_images has no such step.
    """
    spark = pixels.sparkSession
    bands = written(image_bands(pixels, height, width, band_bytes), "image-bands", "none")
    folders = spark._jvm.org.apache.hadoop.fs
    target, part = folders.Path(path), folders.Path(f"{path}.part")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        raise ValueError(f"{path} is there already")
    sizes = ((r.checksum, r.bytes) for r in bands.select("band", "checksum", "bytes").orderBy("band").toLocalIterator())
    tail = _tail(joined_checksum(sizes))
    out = files.create(part, True)
    try:
        out.write(bytearray(_head(height, width)))
        for r in bands.select("band", "data").orderBy("band").toLocalIterator():
            out.write(r.data)
        out.write(bytearray(tail))
    finally:
        out.close()
    if not files.rename(part, target):
        raise OSError(f"{path} could not be named")
    remove(bands)


def decoded(image: bytes) -> np.ndarray:
    """The pixels of an image that this module made; each part's checksum is compared."""
    if image[:8] != SIGNATURE:
        raise ValueError("no PNG image")
    at, packed, shape = 8, [], None
    while at < len(image):
        (size,) = struct.unpack_from(">I", image, at)
        kind, data = image[at + 4 : at + 8], image[at + 8 : at + 8 + size]
        if image[at : at + 12 + size] != _part(kind, data):
            raise ValueError("a part of the image is damaged")
        if kind == b"IHDR":
            width, height, *form = struct.unpack(">IIBBBBB", data)
            if form != [16, 0, 0, 0, 0]:
                raise ValueError("not 16-bit grey")
            shape = height, width
        packed += [data] if kind == b"IDAT" else []
        at += 12 + size
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(shape[0], 1 + 2 * shape[1])
    if not (raw[:, 0] == 1).all():
        raise ValueError("another filter of rows")
    sums = np.cumsum(raw[:, 1:].reshape(*shape, 2), axis=1, dtype=np.uint8)
    return np.ascontiguousarray(sums).view(">u2")[:, :, 0]


def tile_pixels(images: DataFrame) -> DataFrame:
    """(tile_row, tile_col, r, c, pixel) of the images (tile_row, tile_col, image), a row for each place."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, col, image in zip(batch["tile_row"], batch["tile_col"], batch["image"], strict=True):
                grid = decoded(image)
                r, c = np.indices(grid.shape)
                yield pd.DataFrame({"tile_row": row, "tile_col": col, "r": r.ravel(), "c": c.ravel(), "pixel": grid.ravel().astype("int64")})

    return images.select("tile_row", "tile_col", "image").mapInPandas(rows, "tile_row long, tile_col long, r long, c long, pixel long")
