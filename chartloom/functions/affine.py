"""Affine geotransforms as Columns: (x0, dx/dcol, dx/drow, y0, dy/dcol, dy/drow)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.mercator import TILE, col, lat_of, lon_of


def apply(gt: list, px, py) -> tuple[Column, Column]:
    """Pixel to ground."""
    x = col(gt[0]) + col(px) * col(gt[1]) + col(py) * col(gt[2])
    y = col(gt[3]) + col(px) * col(gt[4]) + col(py) * col(gt[5])
    return x, y


def shift_window(gt: list, off_x, off_y) -> list[Column]:
    """The geotransform of a window whose first pixel is (off_x, off_y)."""
    x, y = apply(gt, off_x, off_y)
    return [x, col(gt[1]), col(gt[2]), y, col(gt[4]), col(gt[5])]


def rotated_bounds(gt: list, off_x, off_y, width, height) -> dict[str, Column]:
    """Bounds of a window, turned or not: the extremes of its four corners."""
    corners = [apply(gt, col(off_x) + dx, col(off_y) + dy) for dx in (F.lit(0), col(width)) for dy in (F.lit(0), col(height))]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    return {"min_x": F.least(*xs), "min_y": F.least(*ys), "max_x": F.greatest(*xs), "max_y": F.greatest(*ys)}


def degree_bounds(gt: list, width, height) -> dict[str, Column]:
    """Longitudes and latitudes of a raster in Web Mercator, from its geotransform and size."""
    box = rotated_bounds(gt, F.lit(0), F.lit(0), width, height)
    return {"lon_min": lon_of(box["min_x"]), "lat_min": lat_of(box["min_y"]), "lon_max": lon_of(box["max_x"]), "lat_max": lat_of(box["max_y"])}


def read_window(tile: dict, raster: dict, pixel_x, pixel_y, width, height) -> dict[str, Column]:
    """The raster's pixels that a tile shows, and where in the tile they go.

    tile and raster are bounds; pixel sizes are positive. Offsets are cut to
    whole pixels, sizes rounded half up and one at least.
    """
    tile = {k: col(v) for k, v in tile.items()}
    raster = {k: col(v) for k, v in raster.items()}
    px, py = col(pixel_x), col(pixel_y)
    west, east = F.greatest(tile["min_x"], raster["min_x"]), F.least(tile["max_x"], raster["max_x"])
    south, north = F.greatest(tile["min_y"], raster["min_y"]), F.least(tile["max_y"], raster["max_y"])
    unit = (tile["max_x"] - tile["min_x"]) / float(TILE)
    size = lambda a, unit_, most: F.least(F.greatest(F.floor(a / unit_ + 0.5), F.lit(1)), most)
    src_x = F.floor((west - raster["min_x"]) / px)
    src_y = F.floor((raster["max_y"] - north) / py)
    dst_x = F.floor((west - tile["min_x"]) / unit)
    dst_y = F.floor((tile["max_y"] - north) / unit)
    return {
        "src_x": src_x,
        "src_y": src_y,
        "src_w": size(east - west, px, col(width) - src_x),
        "src_h": size(north - south, py, col(height) - src_y),
        "dst_x": dst_x,
        "dst_y": dst_y,
        "dst_w": size(east - west, unit, F.lit(TILE) - dst_x),
        "dst_h": size(north - south, unit, F.lit(TILE) - dst_y),
    }
