"""Which tiles exist: zooms, covers, the manifest, and which datasets a tile shows.

A range join of tiles and datasets would be a nested loop. Here each dataset
lists the cells it touches (two ``explode``\\ s of sequences), so the rest is
equality on (z, x, y).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions import mercator as m

#: Edges on a tile's border overlap by rounding noise; less than this many metres is none.
TOUCH = 1e-6


def zoom_cross(datasets: DataFrame, zoom_max) -> DataFrame:
    """One row for each dataset and zoom up to its max_lod and zoom_max."""
    return datasets.withColumn("z", F.explode(F.sequence(F.lit(0), F.least(F.col("max_lod"), m.col(zoom_max)))))


def split_antimeridian(bounds: DataFrame) -> DataFrame:
    """Boxes whose west is greater than their east, as two boxes."""
    west, east = F.col("lon_min"), F.col("lon_max")
    box = lambda a, b: F.struct(a.cast("double").alias("lon_min"), b.cast("double").alias("lon_max"))
    parts = F.when(west > east, F.array(box(west, F.lit(180.0)), box(F.lit(-180.0), east))).otherwise(F.array(box(west, east)))
    return bounds.withColumn("__p", F.explode(parts)).withColumns({"lon_min": F.col("__p.lon_min"), "lon_max": F.col("__p.lon_max")}).drop("__p")


def cover(bounds: DataFrame) -> DataFrame:
    """x, y of each tile (z given) that a box touches, borders included. Longitudes and latitudes are clamped on both sides."""
    west, east = m.clamp("lon_min", -180.0, 180.0), m.clamp("lon_max", -180.0, 180.0)
    south, north = m.clamp("lat_min", -m.LAT_LIMIT, m.LAT_LIMIT), m.clamp("lat_max", -m.LAT_LIMIT, m.LAT_LIMIT)
    ranged = bounds.withColumns({"__x0": m.tile_x(west, "z"), "__x1": m.tile_x(east, "z"), "__y0": m.tile_y(north, "z"), "__y1": m.tile_y(south, "z")})
    columns = ranged.withColumn("x", F.explode(F.sequence("__x0", "__x1")))
    return columns.withColumn("y", F.explode(F.sequence("__y0", "__y1"))).drop("__x0", "__x1", "__y0", "__y1")


def manifest(datasets: DataFrame, zoom_max, by: list[str] | None = None) -> DataFrame:
    """Distinct (by, z, x, y) over all datasets."""
    by = by or []
    boxes = datasets.select(*by, "lon_min", "lat_min", "lon_max", "lat_max", "max_lod", *([zoom_max] if isinstance(zoom_max, str) else []))
    return cover(split_antimeridian(zoom_cross(boxes, zoom_max))).select(*by, "z", "x", "y").distinct()


def summary(tiles: DataFrame) -> DataFrame:
    """Tiles of each zoom, and of all (z is null)."""
    return tiles.rollup("z").agg(F.count("*").alias("tiles"))


def output_folders(tiles: DataFrame) -> DataFrame:
    return tiles.select("z", "x").distinct()


def with_meters(datasets: DataFrame) -> DataFrame:
    """Bounds in metres beside those in degrees."""
    return datasets.withColumns(
        {"min_x": m.mx_of("lon_min"), "max_x": m.mx_of("lon_max"), "min_y": m.my_of("lat_min"), "max_y": m.my_of("lat_max")}
    )


def overlaps(a: dict, b: dict, touch: float = TOUCH):
    """Boxes that share more than a border."""
    return (
        (m.col(a["min_x"]) < m.col(b["max_x"]) - touch)
        & (m.col(a["max_x"]) > m.col(b["min_x"]) + touch)
        & (m.col(a["min_y"]) < m.col(b["max_y"]) - touch)
        & (m.col(a["max_y"]) > m.col(b["min_y"]) + touch)
    )


def tile_pairs(datasets: DataFrame, zoom_max) -> DataFrame:
    """(z, x, y, id): tiles and the datasets they show, by strict overlap in metres. Boxes across the antimeridian are two."""
    own = {k: F.col(k) for k in ("min_x", "min_y", "max_x", "max_y")}
    cells = cover(zoom_cross(with_meters(split_antimeridian(datasets)), zoom_max))
    return cells.filter(overlaps(own, m.tile_bounds("z", "x", "y"))).select("z", "x", "y", "id").distinct()


def bounds_tiles(rasters: DataFrame, zoom) -> DataFrame:
    """TMS tiles of one zoom that a box in metres touches."""
    most = F.pow(F.lit(2.0), m.col(zoom)) - 1
    cell = lambda v: m.clamp(m.meters_to_tile(v, zoom), F.lit(0), most).cast("int")
    columns = rasters.withColumn("x", F.explode(F.sequence(cell("min_x"), cell("max_x"))))
    return columns.withColumn("tms_y", F.explode(F.sequence(cell("min_y"), cell("max_y"))))


def missing(tiles: DataFrame, existing: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Tiles that are not there yet. A tile that is there is never made again, even if its sources changed."""
    return tiles.join(existing, [*(by or []), "z", "x", "y"], "left_anti")


def with_mosaic(tiles: DataFrame, mosaics: DataFrame) -> DataFrame:
    """Tiles of the zooms that have a mosaic (z); others are skipped."""
    return tiles.join(mosaics.select("z").distinct(), "z", "left_semi")


def in_order(tiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Tiles by zoom, column and row, for a sink."""
    return tiles.orderBy(*(by or []), "z", "x", "y")
