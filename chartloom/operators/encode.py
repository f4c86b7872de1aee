"""Tile images as bytes, and files of them.

PNG and JPEG are written here. No WebP encoder is at hand, so WebP raises an
error that says so unless an encoder is given.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.mercator import TILE
from chartloom.functions.text import ENDINGS, tile_path
from chartloom.operators.jpeg import encode_jpeg


def png(rgba: bytes, width: int = TILE, height: int = TILE) -> bytes:
    """8-bit RGBA, level 6, no filter, not interlaced."""
    row = width * 4
    lines = b"".join(b"\0" + rgba[i : i + row] for i in range(0, height * row, row))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def png_pixels(image: bytes) -> bytes:
    """The RGBA bytes of a PNG as ``png`` writes it."""
    at, data, width = 8, b"", struct.unpack(">I", image[16:20])[0]
    while at < len(image):
        size, kind = struct.unpack(">I4s", image[at : at + 8])
        if zlib.crc32(image[at + 4 : at + 8 + size]) != struct.unpack(">I", image[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a chunk of the PNG is damaged")
        data += image[at + 8 : at + 8 + size] if kind == b"IDAT" else b""
        at += 12 + size
    lines, step = zlib.decompress(data), 1 + 4 * width
    return b"".join(lines[i + 1 : i + step] for i in range(0, len(lines), step))


def encoder(fmt: str, given: dict[str, Callable] | None = None) -> Callable[[bytes], bytes]:
    known = {"png": png, "jpeg": encode_jpeg} | (given or {})
    if fmt not in ENDINGS:
        raise ValueError(f"unknown tile format {fmt!r}; choose from {', '.join(ENDINGS)}")
    if fmt not in known:
        raise NotImplementedError(f"no {fmt} encoder is installed; give one")
    return known[fmt]


def encode_tiles(tiles: DataFrame, fmt: str = "png", given: dict[str, Callable] | None = None) -> DataFrame:
    """``image``: the encoded bytes of each tile's rgba."""
    encode = encoder(fmt, given)

    @F.udf("binary", useArrow=True)
    def image(rgba):
        return None if rgba is None else encode(rgba)

    return tiles.withColumn("image", image("rgba"))


def write_tiles(tiles: DataFrame, root: str, fmt: str = "png") -> DataFrame:
    """Writes each tile's image to root/tile_path/z/x/y.ending from the executors; (path, bytes) of what was written.

    Each task writes its tiles in order of zoom, column and row.

    root is a folder that all executors share, or the URI of a store that Arrow opens (``s3://``, ``hdfs://``, ``gs://``,
    ``file://``). A file is written beside its place and then moved, so a task that is done again leaves whole files.
    """

    def write(batches):
        import os

        import pandas as pd
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        made = set()
        for pdf in batches:
            for path, image in zip(pdf.path, pdf.image, strict=True):
                place = f"{base.rstrip('/')}/{path}"
                folder = place.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{place}.{os.getpid()}.part"
                with store.open_output_stream(part) as f:
                    f.write(image)
                store.move(part, place)
            yield pd.DataFrame({"path": [f"{root.rstrip('/')}/{path}" for path in pdf.path], "bytes": pdf.image.map(len)})

    placed = tiles.sortWithinPartitions("tile_path", "z", "x", "y")
    return placed.select(tile_path("tile_path", "z", "x", "y", fmt).alias("path"), "image").mapInPandas(write, "path string, bytes long")


def existing_tiles(spark, root: str, fmt: str = "png") -> DataFrame:
    """(tile_path, z, x, y) of the tile files below a folder; only their names are read."""
    ending = ENDINGS[fmt]
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "tile_path string, z int, x int, y int")
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ending}").option("recursiveFileLookup", "true").load(root).select("path")
    below = re.escape(path.toUri().getPath().rstrip("/"))
    part = lambda i: F.regexp_extract("path", rf"{below}/(.+)/(\d+)/(\d+)/(\d+)\.{ending}$", i)
    found = files.select(part(1).alias("tile_path"), *[part(i).try_cast("int").alias(c) for i, c in ((2, "z"), (3, "x"), (4, "y"))])
    return found.filter("z IS NOT NULL")
