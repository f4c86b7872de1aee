"""Rasters as rows of square blocks: masks, ground control, reprojection, overviews and tiles without a row for each pixel.

A block is a row (dataset, level, bx, by, w, h, rgba): SIDE by SIDE pixels as
compressed bytes. What a target block or tile needs is a short list of source
blocks, computed from the geometry alone, so every step is an equality join on
(dataset, level, bx, by) and a group of a few blocks.

Colours are weighted by alpha wherever pixels are mixed, so pixels outside of a
mask lend no colour. Kernels and their reach are those of ``pyramid``.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions import mercator as m
from chartloom.operators.pyramid import check_method
from chartloom.operators.warp import Lambert

SIDE = 256
BLOCK = "dataset string, level int, bx int, by int, w int, h int, rgba binary"
#: Target grid of a dataset: north-west corner and pixel size in metres of Web Mercator, size in pixels.
GRID = "dataset string, min_x double, max_y double, res double, width int, height int"
REACH = {"nearest": 0, "bilinear": 1, "cubic": 2, "cubicspline": 2, "lanczos": 3, "average": 1, "mode": 1}


# --- places


def to_degrees(system, x, y):
    """Longitude and latitude of places in a reference system: 4326, 3857 or a Lambert."""
    if isinstance(system, Lambert):
        n, scale, rho0 = system.constants()
        dx, dy = x - system.x0, rho0 + system.y0 - y
        sign = math.copysign(1.0, n)
        t = (sign * np.hypot(dx, dy) / (system.a * scale)) ** (1 / n)
        phi = np.pi / 2 - 2 * np.arctan(t)
        for _ in range(6 if system.e else 0):
            s = system.e * np.sin(phi)
            phi = np.pi / 2 - 2 * np.arctan(t * ((1 - s) / (1 + s)) ** (system.e / 2))
        return np.degrees(np.arctan2(dx * sign, dy * sign) / n) + system.lon0, np.degrees(phi)
    if system == 4326:
        return x, y
    if system == 3857:
        return np.degrees(x / m.EARTH_RADIUS), np.degrees(2 * np.arctan(np.exp(y / m.EARTH_RADIUS)) - np.pi / 2)
    raise ValueError(f"unknown coordinate system {system!r}")


def from_degrees(system, lon, lat):
    if isinstance(system, Lambert):
        n, scale, rho0 = system.constants()
        phi = np.radians(lat)
        s = system.e * np.sin(phi)
        rho = system.a * scale * (np.tan(np.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (system.e / 2)) ** n
        theta = np.radians(lon - system.lon0) * n
        return rho * np.sin(theta) + system.x0, rho0 + system.y0 - rho * np.cos(theta)
    if system == 4326:
        return lon, lat
    if system == 3857:
        lat = np.clip(lat, -m.LAT_LIMIT, m.LAT_LIMIT)
        return np.radians(lon) * m.EARTH_RADIUS, np.log(np.tan(np.pi / 4 + np.radians(lat) / 2)) * m.EARTH_RADIUS
    raise ValueError(f"unknown coordinate system {system!r}")


def fit_control(points: list[tuple], system) -> list[float]:
    """The affine geotransform that fits (px, py, lon, lat) best, in the reference system itself."""
    p = np.array(points, "f8")
    x, y = from_degrees(system, p[:, 2], p[:, 3])
    a = np.column_stack([np.ones(len(p)), p[:, 0], p[:, 1]])
    if len(p) < 3 or np.linalg.matrix_rank(a - [0, *a[:, 1:].mean(0)]) < 3:
        raise ValueError("ground control needs three points that are not on a line")
    return [*np.linalg.lstsq(a, x, rcond=None)[0].tolist(), *np.linalg.lstsq(a, y, rcond=None)[0].tolist()]


def target_grid(window: tuple, gt: list[float], system, resolution: float, bounds: tuple) -> tuple | None:
    """(min_x, max_y, res, width, height): Web Mercator pixels that show a window (x, y, w, h) of a raster.

    resolution is that of the equator; it is made coarser by 1 / cos(latitude of the window's middle), so that charts
    far north are not enlarged. bounds: (lon_min, lat_min, lon_max, lat_max), each may be None. None if nothing is left.
    """
    x0, y0, w, h = window
    ground = lambda px, py: (gt[0] + px * gt[1] + py * gt[2], gt[3] + px * gt[4] + py * gt[5])
    _, lat = to_degrees(system, *ground(np.array([x0 + w / 2]), np.array([y0 + h / 2])))
    if not abs(lat[0]) <= m.POLE_LIMIT:
        raise ValueError("the middle of the raster has no latitude")
    res = resolution / math.cos(math.radians(lat[0]))
    px, py = np.meshgrid(np.linspace(x0, x0 + w, 41), np.linspace(y0, y0 + h, 41))
    mx, my = from_degrees(3857, *to_degrees(system, *ground(px, py)))
    min_x, max_x, min_y, max_y = mx.min(), mx.max(), my.min(), my.max()
    width, height = (max(1, int((b - a) / res + 0.5)) for a, b in ((min_x, max_x), (min_y, max_y)))
    # the clip keeps whole pixels; a bound that is not there is the grid's own
    corner = lambda lon, lat: [float(v[0]) for v in from_degrees(3857, np.array([lon or 0.0]), np.array([lat or 0.0]))]
    (west, south), (east, north) = corner(*bounds[:2]), corner(*bounds[2:])
    first = lambda v, most: int(np.clip(math.floor(v / res + 1e-3), 0, most))
    last = lambda v, most: int(np.clip(math.ceil(v / res - 1e-3), 0, most))
    left = 0 if bounds[0] is None else first(west - min_x, width)
    bottom = height if bounds[1] is None else last(max_y - south, height)
    right = width if bounds[2] is None else last(east - min_x, width)
    top = 0 if bounds[3] is None else first(max_y - north, height)
    if right <= left or bottom <= top:
        return None
    return float(min_x + left * res), float(max_y - top * res), float(res), right - left, bottom - top


def places_in_source(grid: tuple, gt: list[float], system, px, py):
    """Places in the source raster (pixels) of places on the grid."""
    min_x, max_y, res, _, _ = grid
    gx, gy = from_degrees(system, *to_degrees(3857, min_x + px * res, max_y - py * res))
    det = gt[1] * gt[5] - gt[2] * gt[4]
    dx, dy = gx - gt[0], gy - gt[3]
    return (dx * gt[5] - dy * gt[2]) / det, (dy * gt[1] - dx * gt[4]) / det


# --- pixels


def in_rings(rings: list, x0: int, y0: int, w: int, h: int) -> np.ndarray:
    """Which pixel centres of a window are within rings, by the even-odd rule; a row of pixels at a time."""
    edges = np.array([(*a, *b) for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)], "f8").reshape(-1, 4)
    out, centres = np.zeros((h, w), bool), x0 + np.arange(w) + 0.5
    for i in range(h):
        y = y0 + i + 0.5
        e = edges[(edges[:, 1] <= y) != (edges[:, 3] <= y)]
        at = np.sort(e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1]))
        out[i] = (len(at) - np.searchsorted(at, centres, "right")) % 2 == 1
    return out


def _kernel(method: str, d: np.ndarray) -> np.ndarray:
    a = np.abs(d)
    if method == "bilinear":
        return np.maximum(1 - a, 0)
    if method == "cubic":
        return np.where(a < 1, (1.5 * a - 2.5) * a * a + 1, np.where(a < 2, ((-0.5 * a + 2.5) * a - 4) * a + 2, 0))
    if method == "cubicspline":
        return np.where(a < 1, (4 - 6 * a * a + 3 * a**3) / 6, np.where(a < 2, (2 - a) ** 3 / 6, 0))
    return np.where(a < 3, np.sinc(a) * np.sinc(a / 3), 0)


def sample(pixels: np.ndarray, sx: np.ndarray, sy: np.ndarray, method: str, step: float = 1.0) -> np.ndarray:
    """RGBA at places (sx, sy) of an array (h, w, 4): nearest, a kernel, or the average or mode of ``step`` pixels around."""
    h, w = pixels.shape[:2]
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.zeros((*sx.shape, 4), "u1")
    if not inside.any():
        return out
    px, py = sx[inside], sy[inside]
    if method == "nearest" or method in ("mode", "average") and step <= 1:
        out[inside] = pixels[np.floor(py).astype("i4"), np.floor(px).astype("i4")]
        return out
    if method == "mode":
        n = int(math.ceil(step))
        offsets = (np.arange(n) + 0.5) / n * step - step / 2
        every = np.stack([pixels[np.clip(np.floor(py + oy).astype("i4"), 0, h - 1), np.clip(np.floor(px + ox).astype("i4"), 0, w - 1)] for oy in offsets for ox in offsets], 1)
        packed = every.astype("u4") @ np.array([1 << 24, 1 << 16, 1 << 8, 1], "u4")
        best, most = np.zeros(len(packed), "u4"), np.zeros(len(packed), "i4")
        for k in range(packed.shape[1]):
            n_ = (packed == packed[:, k : k + 1]).sum(1)
            better = (n_ > most) | (n_ == most) & (packed[:, k] < best)
            best, most = np.where(better, packed[:, k], best), np.where(better, n_, most)
        out[inside] = np.stack([best >> 24, best >> 16 & 255, best >> 8 & 255, best & 255], 1)
        return out
    if method == "average":
        n = int(math.ceil(step))
        ks = [((o + 0.5) / n * step - step / 2, (p + 0.5) / n * step - step / 2, None) for o in range(n) for p in range(n)]
    else:
        reach = REACH[method]
        ks = [(a, b, True) for a in range(1 - reach, reach + 1) for b in range(1 - reach, reach + 1)]
    colour, alpha, total = np.zeros((len(px), 3)), np.zeros(len(px)), np.zeros(len(px))
    bx, by = np.floor(px - 0.5).astype("i4"), np.floor(py - 0.5).astype("i4")
    for oy, ox, kernel in ks:
        if kernel:
            x, y = bx + ox, by + oy
            weight = _kernel(method, px - 0.5 - x) * _kernel(method, py - 0.5 - y)
        else:
            x, y = np.floor(px + ox).astype("i4"), np.floor(py + oy).astype("i4")
            weight = np.ones(len(px))
        weight = np.where((x >= 0) & (x < w) & (y >= 0) & (y < h), weight, 0)
        v = pixels[np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)].astype("f8")
        colour += (weight * v[:, 3])[:, None] * v[:, :3]
        alpha += weight * v[:, 3]
        total += weight
    mixed = np.zeros((len(px), 4))
    some = alpha > 1e-9
    mixed[some, :3] = colour[some] / alpha[some, None]
    mixed[:, 3] = np.where(np.abs(total) > 1e-9, alpha / np.where(np.abs(total) > 1e-9, total, 1), 0)
    out[inside] = np.clip(np.floor(mixed + 0.5), 0, 255)
    return out


def halved(pixels: np.ndarray) -> np.ndarray:
    """Averages of two by two pixels; an odd last row or column stands alone."""
    h, w = pixels.shape[:2]
    p = np.zeros((h + h % 2, w + w % 2, 4))
    p[:h, :w] = pixels
    n = np.zeros(p.shape[:2])
    n[:h, :w] = 1
    four = lambda a: a[::2, ::2] + a[1::2, ::2] + a[::2, 1::2] + a[1::2, 1::2]
    alpha = four(p[..., 3])
    colour = four(p[..., :3] * p[..., 3:])
    out = np.zeros((*alpha.shape, 4))
    out[..., :3] = colour / np.maximum(alpha, 1e-9)[..., None]
    out[..., 3] = alpha / four(n)
    return np.clip(np.floor(out + 0.5), 0, 255).astype("u1")


# --- blocks


def packed(pixels: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(pixels, "u1").tobytes(), 1)


def opened(data: bytes, w: int, h: int) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "u1").reshape(h, w, 4)


def cut(pixels: np.ndarray, dataset: str, level: int = 0, first: tuple[int, int] = (0, 0)) -> pd.DataFrame:
    """Blocks of an array whose first pixel is ``first`` (a multiple of SIDE); those that are all clear are left out."""
    rows = []
    for y in range(0, pixels.shape[0], SIDE):
        for x in range(0, pixels.shape[1], SIDE):
            part = pixels[y : y + SIDE, x : x + SIDE]
            if part[..., 3].any():
                rows.append((dataset, level, (first[0] + x) // SIDE, (first[1] + y) // SIDE, part.shape[1], part.shape[0], packed(part)))
    return pd.DataFrame(rows, columns=[f.split()[0] for f in BLOCK.split(", ")])


def joined(rows: pd.DataFrame) -> tuple[np.ndarray, int, int]:
    """The array that some blocks of one dataset and level make up, and the place of its first pixel."""
    bx, by = int(rows.bx.min()), int(rows.by.min())
    out = np.zeros(((int(rows.by.max()) - by + 1) * SIDE, (int(rows.bx.max()) - bx + 1) * SIDE, 4), "u1")
    for r in rows.itertuples():
        y, x = (r.by - by) * SIDE, (r.bx - bx) * SIDE
        out[y : y + r.h, x : x + r.w] = opened(r.rgba, r.w, r.h)
    # where the last blocks are cut short, the picture ends
    bottom, right = (rows.by * SIDE + rows.h).max() - by * SIDE, (rows.bx * SIDE + rows.w).max() - bx * SIDE
    return out[:bottom, :right], bx * SIDE, by * SIDE


def from_pixels(pixels: DataFrame) -> DataFrame:
    """Blocks of rows (dataset, px, py, r, g, b, a)."""

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        bx, by = int(pdf.bx.iloc[0]), int(pdf.by.iloc[0])
        x, y = pdf.px.to_numpy() - bx * SIDE, pdf.py.to_numpy() - by * SIDE
        grid = np.zeros((int(y.max()) + 1, int(x.max()) + 1, 4), "u1")
        grid[y, x] = pdf[["r", "g", "b", "a"]].to_numpy()
        return cut(grid, pdf.dataset.iloc[0], 0, (bx * SIDE, by * SIDE))

    cell = lambda c: F.floor(F.col(c) / SIDE).cast("int")
    return pixels.withColumns({"bx": cell("px"), "by": cell("py")}).groupBy("dataset", "bx", "by").applyInPandas(make, BLOCK)


def warped(blocks: DataFrame, rasters: DataFrame, method: str = "bilinear") -> DataFrame:
    """Blocks of the target grids. rasters: (dataset, gt, system, *GRID), one row each; system is what ``system_of`` reads."""
    check_method(method)
    columns = ["dataset", "gt", "system", "min_x", "max_y", "res", "width", "height"]
    reach = REACH[method] + 2

    def needs(batches):
        """(dataset, tx, ty, bx, by): the source blocks of each target block."""
        for pdf in batches:
            for r in pdf.itertuples():
                grid, system = (r.min_x, r.max_y, r.res, r.width, r.height), system_of(r.system)
                edge = np.linspace(0, 1, 17)
                for ty in range(-(-r.height // SIDE)):
                    rows = []
                    for tx in range(-(-r.width // SIDE)):
                        w, h = min(SIDE, r.width - tx * SIDE), min(SIDE, r.height - ty * SIDE)
                        sx, sy = places_in_source(grid, list(r.gt), system, *np.meshgrid(tx * SIDE + edge * w, ty * SIDE + edge * h))
                        span = np.hypot(np.ptp(sx) / w, np.ptp(sy) / h) + reach
                        for bx in range(max(0, int((sx.min() - span) // SIDE)), int((sx.max() + span) // SIDE) + 1):
                            for by in range(max(0, int((sy.min() - span) // SIDE)), int((sy.max() + span) // SIDE) + 1):
                                rows.append((r.dataset, tx, ty, bx, by))
                    yield pd.DataFrame(rows, columns=["dataset", "tx", "ty", "bx", "by"])

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        w, h = min(SIDE, r.width - r.tx * SIDE), min(SIDE, r.height - r.ty * SIDE)
        pixels, x0, y0 = joined(pdf)
        px, py = np.meshgrid(r.tx * SIDE + np.arange(w) + 0.5, r.ty * SIDE + np.arange(h) + 0.5)
        sx, sy = places_in_source((r.min_x, r.max_y, r.res, r.width, r.height), list(r.gt_), system_of(r.system_), px, py)
        step = max(np.ptp(sx) / max(1, w - 1), np.ptp(sy) / max(1, h - 1))
        return cut(sample(pixels, sx - x0, sy - y0, method, step), r.dataset, 0, (int(r.tx) * SIDE, int(r.ty) * SIDE))

    wanted = rasters.select(*columns)
    pairs = wanted.mapInPandas(needs, "dataset string, tx int, ty int, bx int, by int")
    placed = pairs.join(blocks.select("dataset", "bx", "by", "w", "h", "rgba"), ["dataset", "bx", "by"]).join(wanted.withColumnsRenamed({"gt": "gt_", "system": "system_"}), "dataset")
    return placed.groupBy("dataset", "tx", "ty").applyInPandas(draw, BLOCK)


def system_of(text: str):
    """A reference system from its text: an EPSG number, or the numbers of a Lambert."""
    parts = text.split(",")
    return int(parts[0]) if len(parts) == 1 else Lambert(*map(float, parts))


def text_of(system) -> str:
    if isinstance(system, Lambert):
        return ",".join(repr(float(v)) for v in (system.lat0, system.lon0, system.lat1, system.lat2, system.x0, system.y0, system.a, system.f))
    return str(system)


def overview_levels(base: DataFrame, steps: int = 3) -> DataFrame:
    """Blocks of the next ``steps`` levels (each half as wide) above blocks of one level: 8 by 8 blocks make them all."""

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pixels, x, y = joined(pdf)
        # groups begin at multiples of 2 ** steps blocks
        gx, gy = int(pdf.bx.iloc[0]) >> steps << steps, int(pdf.by.iloc[0]) >> steps << steps
        whole = np.zeros((y - gy * SIDE + pixels.shape[0], x - gx * SIDE + pixels.shape[1], 4), "u1")
        whole[y - gy * SIDE :, x - gx * SIDE :] = pixels
        out = []
        for k in range(1, steps + 1):
            whole = halved(whole)
            out.append(cut(whole, pdf.dataset.iloc[0], int(pdf.level.iloc[0]) + k, (gx * SIDE >> k, gy * SIDE >> k)))
        return pd.concat(out, ignore_index=True).astype({"dataset": object})

    group = [F.shiftright(c, steps).alias(f"g{c}") for c in ("bx", "by")]
    return base.groupBy("dataset", *group).applyInPandas(make, BLOCK)


def tile_parts(blocks: DataFrame, wanted: DataFrame, method: str = "bilinear") -> DataFrame:
    """(dataset, z, x, y, rgba): what one dataset shows of a tile, compressed.

    wanted: (dataset, z, x, y, min_x, max_y, res, width, height, levels), distinct tiles of each dataset's grid; blocks
    are read from the coarsest of its ``levels`` whose pixels are not larger than the tile's.
    """
    check_method(method)
    reach = REACH[method] + 1
    unit = m.resolution("z")
    level = F.least(F.greatest(F.floor(F.log2(unit / F.col("res") + 1e-9)), F.lit(0)), F.col("levels")).cast("int")
    tile = m.tile_bounds("z", "x", "y")
    leveled = wanted.withColumn("level", level).withColumn("px", F.col("res") * F.pow(F.lit(2.0), F.col("level")))
    step = unit / F.col("px")
    at = {"left": (tile["min_x"] - F.col("min_x")) / F.col("px"), "top": (F.col("max_y") - tile["max_y"]) / F.col("px")}
    sized = leveled.withColumns({**at, "step": step})
    last = lambda size: F.ceil(F.col(size) / F.pow(F.lit(2.0), F.col("level")) / SIDE).cast("int") - 1
    cell = lambda v, size: F.least(F.greatest(F.floor(v / SIDE).cast("int"), F.lit(0)), last(size))
    span = F.col("step") * m.TILE + F.col("step") + reach
    spread = sized.withColumn("bx", F.explode(F.sequence(cell(F.col("left") - F.col("step") - reach, "width"), cell(F.col("left") + span, "width"))))
    spread = spread.withColumn("by", F.explode(F.sequence(cell(F.col("top") - F.col("step") - reach, "height"), cell(F.col("top") + span, "height"))))

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        pixels, x0, y0 = joined(pdf)
        # the dataset ends where its grid does
        n = 2 ** int(r.level)
        pixels = pixels[: max(0, -(-int(r.height) // n) - y0), : max(0, -(-int(r.width) // n) - x0)]
        centre = (np.arange(m.TILE) + 0.5) * r.step
        sx, sy = np.meshgrid(r.left + centre - x0, r.top + centre - y0)
        got = sample(pixels, sx, sy, method, r.step)
        if not got[..., 3].any():
            return pd.DataFrame(columns=["dataset", "z", "x", "y", "rgba"])
        return pd.DataFrame({"dataset": [r.dataset], "z": [r.z], "x": [r.x], "y": [r.y], "rgba": [packed(got)]})

    found = spread.join(blocks, ["dataset", "level", "bx", "by"])
    return found.groupBy("dataset", "z", "x", "y").applyInPandas(draw, "dataset string, z int, x int, y int, rgba binary")


def compose(parts: DataFrame, by: list[str]) -> DataFrame:
    """(by, rgba): the parts of each tile painted in order of ``layer``; pixels of later ones cover where they are not clear."""

    def paint(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((m.TILE, m.TILE, 4), "u1")
        for data in pdf.sort_values("layer").rgba:
            top = opened(data, m.TILE, m.TILE)
            out[top[..., 3] > 0] = top[top[..., 3] > 0]
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in by}, "rgba": [out.tobytes()]})

    kinds = dict(parts.dtypes)
    return parts.groupBy(*by).applyInPandas(paint, ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", rgba binary")


def to_pixels(tiles: DataFrame, by: list[str]) -> DataFrame:
    """(by, px, py, r, g, b, a): the pixels of tiles (by, rgba) that are not clear."""
    kinds = dict(tiles.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", px int, py int, r int, g int, b int, a int"

    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                grid = np.frombuffer(row.rgba, "u1").reshape(m.TILE, m.TILE, 4)
                py, px = np.nonzero(grid[..., 3])
                seen = grid[py, px]
                yield pd.DataFrame({**{c: [getattr(row, c)] * len(px) for c in by}, "px": px, "py": py} | {c: seen[:, i] for i, c in enumerate("rgba")})

    return tiles.select(*by, "rgba").mapInPandas(run, schema)
