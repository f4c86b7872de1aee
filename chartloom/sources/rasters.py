"""Rasters in ZIP archives: members without unpacking, GeoTIFF metadata and pixels.

Archives are read as binary rows, so any store that Spark reads will do; each
archive is opened in the task that holds it.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 16: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def archive_members(spark: SparkSession, path: str, ending: str = ".tif") -> DataFrame:
    """(archive, member, data) of all ZIP files below a path; members whose names begin with ``._`` are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return unzip(files.select(F.col("path").alias("archive"), "content"), ending)


def unzip(archives: DataFrame, ending: str = ".tif") -> DataFrame:
    """Members of archives (archive, content). What cannot be unpacked has no row, so a join with what is wanted tells."""

    def read(batches):
        import pandas as pd

        for pdf in batches:
            for archive, content in zip(pdf.archive, pdf.content, strict=True):
                try:
                    whole = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                with whole as z:
                    for name in z.namelist():
                        if name.lower().endswith(ending) and not name.rsplit("/", 1)[-1].startswith("._"):
                            try:
                                data = z.read(name)
                            except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, EOFError):
                                continue
                            yield pd.DataFrame({"archive": [archive], "member": [name], "data": [data]})

    return archives.mapInPandas(read, "archive string, member string, data binary")


def tags(data: bytes) -> dict[int, tuple]:
    """Tags of a TIFF's first directory."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    if struct.unpack(order + "H", data[2:4])[0] != 42:
        raise ValueError("not a classic TIFF")
    at = struct.unpack(order + "I", data[4:8])[0]
    out = {}
    for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        tag, kind, n = struct.unpack(order + "HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
        size = _SIZES.get(kind, 1) * n
        place = at + 10 + 12 * i
        raw = data[place : place + size] if size <= 4 else data[(p := struct.unpack(order + "I", data[place : place + 4])[0]) : p + size]
        out[tag] = (raw.rstrip(b"\0").decode("latin-1"),) if kind == 2 else struct.unpack(f"{order}{n}{_CODES.get(kind, 'B')}", raw[:size]) if kind != 5 else (raw,)
    return out


def metadata(data: bytes) -> tuple:
    """(width, height, band_count, gt, epsg) of a GeoTIFF; gt and epsg are None where it has none."""
    t = tags(data)
    gt = None
    if 33550 in t and 33922 in t:
        (sx, sy), (i, j, _, x, y, _) = t[33550][:2], t[33922][:6]
        gt = [x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy]
    elif 34264 in t:
        a = t[34264]
        gt = [a[3], a[0], a[1], a[7], a[4], a[5]]
    keys = t.get(34735, ())
    epsg = next((keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k] in (3072, 2048) and keys[k + 1] == 0), None)
    return t[256][0], t[257][0], t.get(277, (1,))[0], gt, epsg


def system(data: bytes):
    """The reference system of a GeoTIFF: 4326, 3857, a Lambert, or None. NAD83 counts as WGS 84."""
    from chartloom.operators.warp import Lambert

    t = tags(data)
    keys, doubles = t.get(34735, ()), t.get(34736, ())
    found = {}
    for k in range(4, len(keys) - 3, 4):
        name, place, n, value = keys[k : k + 4]
        if place == 0:
            found[name] = value
        elif place == 34736 and n == 1:
            found[name] = doubles[value]
    if found.get(3072) == 3857:
        return 3857
    if found.get(3075) in (8, 9):  # Lambert conformal conic with two standard parallels or one
        first = lambda *names: next((float(found[n]) for n in names if n in found), 0.0)
        lat0, lon0 = first(3085, 3081), first(3084, 3080)
        lat1 = first(3078) if 3078 in found else lat0
        lat2 = first(3079) if 3079 in found else lat1
        a, inverse = first(2057) or 6378137.0, first(2059) or (298.257223563 if found.get(2048) == 4326 else 298.257222101)
        return Lambert(lat0, lon0, lat1, lat2, first(3086, 3082), first(3087, 3083), a, 1 / inverse)
    if 3072 not in found and found.get(2048) in (4326, 4269):
        return 4326
    if 3072 in found or 2048 in found:
        raise ValueError(f"reference system {found.get(3072, found.get(2048))} is not read")
    return None


def pixels(data: bytes):
    """Array (band, row, column) of an 8-bit TIFF in strips or tiles: plain, deflated or packed; and its palette or None."""
    import numpy as np

    t = tags(data)
    width, height, bands = t[256][0], t[257][0], t.get(277, (1,))[0]
    if any(b != 8 for b in t.get(258, (8,))):
        raise ValueError("only 8-bit rasters are read")
    how = t.get(259, (1,))[0]
    tiled = 322 in t
    w, h = (t[322][0], t[323][0]) if tiled else (width, min(height, t.get(278, (height,))[0]))
    offsets, sizes = (t[324], t[325]) if tiled else (t[273], t[279])
    apart = t.get(284, (1,))[0] == 2 and bands > 1
    out = np.zeros((bands, height, width), "u1")
    across = -(-width // w)
    per_band = across * -(-height // h)
    for i, (offset, size) in enumerate(zip(offsets, sizes, strict=True)):
        raw = _unpack(data[offset : offset + size], how)
        band, k = divmod(i, per_band) if apart else (0, i)
        y, x = k // across * h, k % across * w
        n = 1 if apart else bands
        rows = h if tiled else min(h, height - y)
        block = np.frombuffer(raw, "u1", rows * w * n).reshape(rows, w, n)
        if t.get(317, (1,))[0] == 2:
            block = np.cumsum(block, 1, dtype="u1")
        part = block[: height - y, : width - x].transpose(2, 0, 1)
        out[band : band + n, y : y + part.shape[1], x : x + part.shape[2]] = part
    palette = np.array(t[320]).reshape(3, -1).T // 257 if 320 in t else None
    return out, palette


def _unpack(raw: bytes, how: int) -> bytes:
    if how == 1:
        return raw
    if how in (8, 32946):
        return zlib.decompress(raw)
    if how == 5:
        return lzw(raw)
    if how == 32773:
        out, at = bytearray(), 0
        while at < len(raw):
            n = raw[at]
            if n < 128:
                out += raw[at + 1 : at + 2 + n]
                at += 2 + n
            else:
                out += raw[at + 1 : at + 2] * (257 - n if n > 128 else 0)
                at += 2
        return bytes(out)
    raise ValueError(f"TIFF compression {how} is not read")


def lzw(raw: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, most significant bit first; 256 clears, 257 ends."""
    table: list[bytes] = []
    out, last, bits, held, width = bytearray(), b"", 0, 0, 9
    for byte in raw:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 256:
            table, last, width = [bytes([i]) for i in range(256)] + [b"", b""], b"", 9
            continue
        if code == 257:
            break
        word = table[code] if code < len(table) else last + last[:1]
        out += word
        if last:
            table.append(last + word[:1])
        last = word
        width = min(12, (len(table) + 1).bit_length()) if len(table) >= 511 else 9
    return bytes(out)


def raster_metadata(members: DataFrame) -> DataFrame:
    """members with width, height, band_count, gt and epsg; unreadable ones have nulls."""

    @F.udf("struct<width:int,height:int,band_count:int,gt:array<double>,epsg:int>", useArrow=True)
    def meta(data):
        try:
            return metadata(data)
        except (ValueError, KeyError, IndexError, struct.error):
            return None

    return members.withColumn("__m", meta("data")).select(*members.columns, "__m.*")


def raster_blocks(members: DataFrame, side: int = 256) -> DataFrame:
    """(archive, member, band, bx, by, w, h, data): square blocks of the pixels, so no row holds a whole raster."""
    schema = "archive string, member string, band int, bx int, by int, w int, h int, data binary"

    def cut(batches):
        import pandas as pd

        for pdf in batches:
            for archive, member, data in zip(pdf.archive, pdf.member, pdf.data, strict=True):
                grid, _ = pixels(data)
                rows = []
                for band in range(grid.shape[0]):
                    for y in range(0, grid.shape[1], side):
                        for x in range(0, grid.shape[2], side):
                            part = grid[band, y : y + side, x : x + side]
                            rows.append((archive, member, band, x // side, y // side, part.shape[1], part.shape[0], part.tobytes()))
                yield pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])

    return members.select("archive", "member", "data").mapInPandas(cut, schema)


def geotiff(grid, gt: list[float], epsg=3857, overviews: tuple = ()) -> bytes:
    """A tiled, deflated GeoTIFF of an array (band, row, column) of bytes; north-up geotransforms only.

    epsg may be a Lambert or None. Overviews are arrays like the grid, each smaller, and become further directories.
    """
    out = _directory(grid, gt, epsg, 8, bool(overviews))
    data = b"II*\0" + struct.pack("<I", 8) + out
    for i, level in enumerate(overviews):
        data += _directory(level, None, None, len(data), i + 1 < len(overviews), 1)
    return data


def _directory(grid, gt, epsg, start: int, more: bool, kind_of: int = 0) -> bytes:
    """One directory with its values and blocks, for a place in the file; its last entry points behind itself if there are more."""
    from chartloom.operators.warp import Lambert

    import numpy as np

    bands, height, width = grid.shape
    side = 256
    blocks = []
    for y in range(0, height, side):
        for x in range(0, width, side):
            block = np.zeros((side, side, bands), "u1")
            part = grid[:, y : y + side, x : x + side].transpose(1, 2, 0)
            block[: part.shape[0], : part.shape[1]] = part
            blocks.append(zlib.compress(block.tobytes(), 6))
    sizes = [len(b) for b in blocks]
    doubles: tuple = ()
    if isinstance(epsg, Lambert):
        doubles = (epsg.lat1, epsg.lat2, epsg.lon0, epsg.lat0, epsg.x0, epsg.y0, epsg.a, 1 / epsg.f if epsg.f else 0.0)
        named = (2057, 2059, 3078, 3079, 3084, 3085, 3086, 3087)
        place = {3078: 0, 3079: 1, 3084: 2, 3085: 3, 3086: 4, 3087: 5, 2057: 6, 2059: 7}
        simple = {1024: 1, 1025: 1, 3072: 32767, 3075: 8}
        listed = sorted([(k, 0, 1, v) for k, v in simple.items()] + [(k, 34736, 1, place[k]) for k in named])
        keys = (1, 1, 0, len(listed), *(v for entry in listed for v in entry))
    else:
        model = 2 if epsg == 4326 else 1
        keys = (1, 1, 0, 3, 1024, 0, 1, model, 1025, 0, 1, 1, 2048 if model == 2 else 3072, 0, 1, epsg)
    entries = [
        *([(254, "I", (kind_of,))] if kind_of else []),
        (256, "I", (width,)), (257, "I", (height,)), (258, "H", (8,) * bands), (259, "H", (8,)), (262, "H", (2 if bands >= 3 else 1,)),
        (277, "H", (bands,)), (284, "H", (1,)), (322, "I", (side,)), (323, "I", (side,)), (324, "I", None), (325, "I", sizes),
        *([(338, "H", (2,))] if bands in (2, 4) else []), *([(33550, "d", (gt[1], -gt[5], 0.0)), (33922, "d", (0.0, 0.0, 0.0, gt[0], gt[3], 0.0))] if gt else []),
        *([(34735, "H", keys)] if epsg else []), *([(34736, "d", doubles)] if doubles else []),
    ]
    kinds = {"H": 3, "I": 4, "d": 12}
    at = start + 2 + 12 * len(entries) + 4
    extra, offsets_at = [], at
    for _, kind, values in entries:  # space of the values that do not fit into an entry
        n = len(sizes) if values is None else len(values)
        if (size := n * struct.calcsize("<" + kind)) > 4:
            offsets_at += size
    starts = [offsets_at + sum(sizes[:i]) for i in range(len(sizes))]
    head = struct.pack("<H", len(entries))
    for tag, kind, values in entries:
        values = starts if values is None else values
        raw = struct.pack(f"<{len(values)}{kind}", *values)
        head += struct.pack("<HHI", tag, kinds[kind], len(values))
        if len(raw) <= 4:
            head += raw.ljust(4, b"\0")
        else:
            head += struct.pack("<I", at)
            extra.append(raw)
            at += len(raw)
    body = b"".join(extra) + b"".join(blocks)
    pad = b"\0" * ((start + len(head) + 4 + len(body)) % 2)  # directories begin at even places
    after = start + len(head) + 4 + len(body) + len(pad) if more else 0
    return head + struct.pack("<I", after) + body + pad
