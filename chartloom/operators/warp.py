"""Coordinate systems and reprojection.

Geographic, Web Mercator and Lambert conformal conic (two standard parallels,
on the sphere or an ellipsoid) are closed forms of Columns. Other systems are
an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions import mercator as m
from chartloom.operators import pyramid


@dataclass(frozen=True)
class Lambert:
    """Lambert conformal conic: degrees and metres; flattening 0 is a sphere."""

    lat0: float
    lon0: float
    lat1: float
    lat2: float
    x0: float = 0.0
    y0: float = 0.0
    a: float = 6378137.0
    f: float = 1 / 298.257222101

    @property
    def e(self) -> float:
        return math.sqrt(self.f * (2 - self.f))

    def _m(self, lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (self.e * math.sin(lat)) ** 2)

    def _t(self, lat: float) -> float:
        s = self.e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    def constants(self) -> tuple[float, float, float]:
        """n, F and rho0 of the projection's usual formulas."""
        p0, p1, p2 = (math.radians(x) for x in (self.lat0, self.lat1, self.lat2))
        if abs(p1 - p2) < 1e-12:
            n = math.sin(p1)
        else:
            n = (math.log(self._m(p1)) - math.log(self._m(p2))) / (math.log(self._t(p1)) - math.log(self._t(p2)))
        scale = self._m(p1) / (n * self._t(p1) ** n)
        return n, scale, self.a * scale * self._t(p0) ** n


def lambert_forward(p: Lambert, lon, lat) -> tuple[Column, Column]:
    n, scale, rho0 = p.constants()
    phi = F.radians(m.col(lat))
    s = F.sin(phi) * p.e
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(p.e / 2))
    rho = F.pow(t, F.lit(n)) * (p.a * scale)
    theta = F.radians(m.col(lon) - p.lon0) * n
    return rho * F.sin(theta) + p.x0, F.lit(rho0 + p.y0) - rho * F.cos(theta)


def lambert_inverse(p: Lambert, x, y, rounds: int = 6) -> tuple[Column, Column]:
    n, scale, rho0 = p.constants()
    dx, dy = m.col(x) - p.x0, F.lit(rho0 + p.y0) - m.col(y)
    sign = math.copysign(1.0, n)
    rho = F.sqrt(dx * dx + dy * dy) * sign
    t = F.pow(rho / (p.a * scale), F.lit(1 / n))
    phi = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(rounds if p.e else 0):
        s = F.sin(phi) * p.e
        phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(p.e / 2)))
    return F.degrees(F.atan2(dx * sign, dy * sign) / n) + p.lon0, F.degrees(phi)


def to_lon_lat(crs, x, y) -> tuple[Column, Column]:
    if isinstance(crs, Lambert):
        return lambert_inverse(crs, x, y)
    if crs == 4326:
        return m.col(x), m.col(y)
    if crs == 3857:
        return m.lon_of(x), m.lat_of(y)
    raise ValueError(f"unknown coordinate system {crs!r}")


def from_lon_lat(crs, lon, lat) -> tuple[Column, Column]:
    if isinstance(crs, Lambert):
        return lambert_forward(crs, lon, lat)
    if crs == 4326:
        return m.col(lon), m.col(lat)
    if crs == 3857:
        return m.mx_of(lon), m.my_of(lat)
    raise ValueError(f"unknown coordinate system {crs!r}")


def transform(src, dst, x, y) -> tuple[Column, Column]:
    lon, lat = to_lon_lat(src, x, y)
    return from_lon_lat(dst, lon, lat)


def target_grid(areas: DataFrame, by: list[str], res, src_crs, dst_crs, src_gt: list) -> DataFrame:
    """(by, x, y, sx, sy): pixels of each area (min_x, min_y, max_x, max_y in dst_crs) and their places in the source.

    src_gt is a north-up or turned geotransform; it is inverted as a 2 by 2.
    """
    res = m.col(res)
    n = lambda a, b: F.greatest(F.ceil((F.col(b) - F.col(a)) / res - 1e-9).cast("int"), F.lit(1))
    grid = areas.withColumn("x", F.explode(F.sequence(F.lit(0), n("min_x", "max_x") - 1)))
    grid = grid.withColumn("y", F.explode(F.sequence(F.lit(0), n("min_y", "max_y") - 1)))
    gx, gy = F.col("min_x") + (F.col("x") + 0.5) * res, F.col("max_y") - (F.col("y") + 0.5) * res
    ux, uy = transform(dst_crs, src_crs, gx, gy)
    x0, a, b, y0, c, d = map(m.col, src_gt)
    det = a * d - b * c
    return grid.select(*by, "x", "y", (((ux - x0) * d - (uy - y0) * b) / det).alias("sx"), (((uy - y0) * a - (ux - x0) * c) / det).alias("sy"))


def warp(pixels: DataFrame, grid: DataFrame, by: list[str], value: str, method: str = "bilinear") -> DataFrame:
    """Source pixels on a target grid: nearest, or a kernel around each place."""
    pyramid.check_method(method)
    if method in ("average", "mode"):
        raise ValueError(f"{method} gathers the source pixels of each target pixel; use gather()")
    if method == "nearest":
        return pyramid.resample_nearest(grid, pixels, by, value)
    return pyramid.resample_kernel(grid, pixels, by, value, method)


def gather(pixels: DataFrame, areas: DataFrame, by: list[str], value: str, res, src_crs, dst_crs, src_gt: list, method: str = "average") -> DataFrame:
    """(by, x, y, value): the average or mode of the source pixels whose centres fall into each target pixel.

    areas: (by, min_x, min_y, max_x, max_y) in dst_crs. One pass over the source, without a join of pixels.
    """
    if method not in ("average", "mode"):
        raise ValueError(f"{method} is no gathering method")
    res = m.col(res)
    cx, cy = F.col("px") + 0.5, F.col("py") + 0.5
    x0, a, b, y0, c, d = map(m.col, src_gt)
    gx, gy = transform(src_crs, dst_crs, x0 + cx * a + cy * b, y0 + cx * c + cy * d)
    at = pixels.join(areas, by).withColumns({"__gx": gx, "__gy": gy})
    inside = (F.col("__gx") >= F.col("min_x")) & (F.col("__gx") < F.col("max_x")) & (F.col("__gy") > F.col("min_y")) & (F.col("__gy") <= F.col("max_y"))
    at = at.filter(inside & F.col(value).isNotNull())
    cell = {"x": F.floor((F.col("__gx") - F.col("min_x")) / res).cast("int"), "y": F.floor((F.col("max_y") - F.col("__gy")) / res).cast("int")}
    at = at.select(*by, *[e.alias(k) for k, e in cell.items()], value)
    if method == "average":
        return at.groupBy(*by, "x", "y").agg(F.avg(value).alias(value))
    counts = at.groupBy(*by, "x", "y", value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*by, "x", "y").agg(F.max_by(value, F.struct("__n", -F.col(value))).alias(value))
