"""Web Mercator tile arithmetic as Columns.

Every function takes and gives Columns (or names), so all of it runs inside
whole-stage code. Tile rows are XYZ (row 0 in the north) unless a name says TMS.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0
ORIGIN = math.pi * EARTH_RADIUS  # half the side of the Web Mercator square, in metres
TILE = 256
LAT_LIMIT = 85.0
#: Beyond this latitude the Mercator square ends.
POLE_LIMIT = 85.06


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def clamp(x, low, high) -> Column:
    return F.greatest(F.least(col(x), col(high)), col(low))


def resolution(z) -> Column:
    """Metres for a pixel at the equator."""
    return F.lit(2 * ORIGIN / TILE) / F.pow(F.lit(2.0), col(z))


def tile_x(lon, z) -> Column:
    n = F.pow(F.lit(2.0), col(z))
    return clamp(F.floor((col(lon) + 180.0) / 360.0 * n), F.lit(0), (n - 1).cast("bigint")).cast("int")


def tile_y(lat, z) -> Column:
    n = F.pow(F.lit(2.0), col(z))
    up = F.asinh(F.tan(F.radians(col(lat)))) / math.pi
    return clamp(F.floor((1.0 - up) / 2.0 * n), F.lit(0), (n - 1).cast("bigint")).cast("int")


def flip_row(y, z) -> Column:
    """XYZ row to TMS row, or back."""
    return (F.pow(F.lit(2.0), col(z)) - 1 - col(y)).cast("int")


def tile_bounds(z, x, y) -> dict[str, Column]:
    """West, south, east and north of a tile in metres."""
    side = resolution(z) * TILE
    north = F.lit(ORIGIN) - col(y) * side
    west = col(x) * side - ORIGIN
    return {"min_x": west, "min_y": north - side, "max_x": west + side, "max_y": north}


def lon_of(mx) -> Column:
    return col(mx) * 180.0 / ORIGIN


def lat_of(my) -> Column:
    return F.degrees(F.atan(F.sinh(col(my) * math.pi / ORIGIN)))


def mx_of(lon) -> Column:
    return col(lon) * ORIGIN / 180.0


def my_of(lat) -> Column:
    return F.asinh(F.tan(F.radians(col(lat)))) * EARTH_RADIUS


def pixels_to_meters(px, z) -> Column:
    return col(px) * resolution(z) - ORIGIN


def meters_to_pixels(m, z) -> Column:
    return (col(m) + ORIGIN) / resolution(z)


def pixels_to_tile(px) -> Column:
    return (F.ceil(col(px) / float(TILE)) - 1).cast("int")


def meters_to_tile(m, z) -> Column:
    """TMS column or row of a coordinate in metres."""
    return pixels_to_tile(meters_to_pixels(m, z))


def zoom_for_pixel_size(size, most: int = 32) -> Column:
    """The zoom below the first whose pixels are smaller than ``size`` (0 at least, most - 1 if none is)."""
    first = F.get(F.filter(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: col(size) > resolution(i)), F.lit(0))
    return F.when(first.isNull(), F.lit(most - 1)).otherwise(F.greatest(first - 1, F.lit(0))).cast("int")


def ground_resolution(z, lat) -> Column:
    """Resolution made larger by 1 / cos(latitude); null beyond the Mercator square."""
    return F.when(F.abs(col(lat)) <= POLE_LIMIT, resolution(z) / F.cos(F.radians(col(lat))))


def pack_tile(x, y) -> Column:
    """Both in one integer of 64 bits, so that all zooms fit."""
    return F.shiftleft(col(x).cast("bigint"), 16).bitwiseOR(col(y).cast("bigint"))


def unpack_tile(key) -> tuple[Column, Column]:
    return F.shiftrightunsigned(col(key), 16).cast("int"), col(key).bitwiseAND(F.lit(0xFFFF)).cast("int")


def center_latitude(min_y, max_y) -> Column:
    """Latitude of the middle of two northings; null where it is not one."""
    lat = lat_of((col(min_y) + col(max_y)) / 2)
    return F.when(F.abs(lat) <= 90, lat)
