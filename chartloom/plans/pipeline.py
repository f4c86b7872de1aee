"""The whole way from a configuration and archives of rasters to tiles, and the command line.

Each step is a table of blocks in the staging folder (see ``operators.blocks``):
source blocks (palette, mask, ground control), reprojected blocks with their
overviews, tiles. Datasets in several tilesets are processed once, datasets that
fail are rows of ``failures``, and tiles that exist are left alone.
"""

from __future__ import annotations

import argparse
import math
import struct
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions import mercator as m
from chartloom.functions.text import ENDINGS
from chartloom.operators import blocks, encode, manifest, pyramid
from chartloom.operators import tilesets as ts
from chartloom.sources import config, rasters, web

#: The configuration that is read if none is named.
CONFIG = "chartloom.conf.json"


@dataclass(frozen=True)
class Options:
    config_path: str
    zip_dir: str | None = None
    staging_dir: str | None = None
    out_dir: str | None = None
    tilesets: tuple[str, ...] | None = None
    dataset: str | None = None
    fmt: str = "png"
    tile_resampling: str = "bilinear"
    reuse: bool = False
    cleanup: bool = False
    reproject_resampling: str = "bilinear"
    epsg: int = 3857

    def __post_init__(self):
        if self.fmt not in ENDINGS:
            raise ValueError(f"unknown tile format {self.fmt!r}")
        pyramid.check_method(self.tile_resampling)
        pyramid.check_method(self.reproject_resampling)
        if self.epsg != 3857:
            raise ValueError(f"tiles are drawn in EPSG 3857, not {self.epsg}")


def selected(spark: SparkSession, o: Options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(datasets, tilesets, members) that the options ask for."""
    datasets, tilesets = config.load(spark, o.config_path)
    tilesets = ts.select(tilesets, list(o.tilesets) if o.tilesets else None)
    if o.dataset:
        tilesets = tilesets.filter(F.array_contains("datasets", o.dataset))
        datasets = datasets.filter(F.col("name") == o.dataset)
    return datasets, tilesets, ts.members(config.membership(tilesets), datasets)


STAGED = (
    "dataset string, error string, gt array<double>, system string, min_x double, max_y double, res double, width int, height int, "
    "bx int, by int, w int, h int, rgba binary"
)


def source_blocks(spark: SparkSession, datasets: DataFrame, zip_dir: str) -> DataFrame:
    """Blocks of each dataset's own pixels with its geotransform, reference system and target grid (``STAGED``).

    Palettes become colours, pixels outside of the mask become clear, ground control points give the geotransform, and
    the grid's resolution is that of max_lod at the raster's latitude, cut to the geographic bounds. A dataset has a row
    without a block; that of one that cannot be read or placed has the error, and no other rows.
    """
    members = rasters.archive_members(spark, zip_dir).withColumn("__zip", F.regexp_extract("archive", r"([^/]+)\.zip$", 1))
    wanted = datasets.select("name", F.regexp_replace("zip_file", r"\.zip$", "").alias("__zip"), F.col("input_file").alias("member"), "mask", "gcps", "max_lod", "lon_min", "lat_min", "lon_max", "lat_max")
    found = wanted.dropDuplicates(["name"]).join(members.select("__zip", "member", "data"), ["__zip", "member"], "left").drop("__zip", "member")

    def read(batches):
        import numpy as np
        import pandas as pd

        names = [f.split()[0] for f in STAGED.split(", ")]
        none = lambda v: None if v is None or v != v else float(v)

        def one(r):
            if r.data is None:
                raise ValueError("the archive or its member is not there, or cannot be unpacked")
            grid, palette = rasters.pixels(r.data)
            system, gt = rasters.system(r.data), rasters.metadata(r.data)[3]
            if r.gcps is not None and len(r.gcps):
                system = 4326 if system is None else system
                gt = blocks.fit_control([(g["px"], g["py"], g["lon"], g["lat"]) for g in r.gcps], system)
            if gt is None:
                raise ValueError("the raster has no geotransform and no ground control points")
            if system is None:
                raise ValueError("the raster has no reference system")
            if palette is not None:
                grid = palette[grid[0]].transpose(2, 0, 1)
            height, width = grid.shape[1:]
            rings = [[(v["x"], v["y"]) for v in ring] for ring in r.mask] if r.mask is not None and len(r.mask) else None
            x0, y0, w, h = 0, 0, width, height
            if rings:
                xs, ys = ([int(v[i]) for v in rings[0]] for i in (0, 1))
                x0, y0 = (min(max(min(v), 0), most) for v, most in ((xs, width), (ys, height)))
                w, h = (min(max(max(v) + 1, 0), most) - first for v, most, first in ((xs, width, x0), (ys, height, y0)))
                if w <= 0 or h <= 0:
                    raise ValueError("the mask lies outside of the raster")
            area = blocks.target_grid((x0, y0, w, h), gt, system, 2 * m.ORIGIN / m.TILE / 2.0 ** int(r.max_lod), tuple(none(v) for v in (r.lon_min, r.lat_min, r.lon_max, r.lat_max)))
            if area is None:
                raise ValueError("nothing of the raster is within its bounds")
            # blocks keep the places of the whole raster, so ground control points hold for a window, too
            fx, fy = x0 // blocks.SIDE * blocks.SIDE, y0 // blocks.SIDE * blocks.SIDE
            held = [r.name, None, gt, blocks.text_of(system), *area]
            yield [*held, *[None] * 5]
            for top in range(fy, y0 + h, blocks.SIDE):
                rows = slice(top, min(top + blocks.SIDE, y0 + h))
                strip = np.zeros((rows.stop - rows.start, x0 + w - fx, 4), "u1")
                for i in range(3):
                    strip[..., i] = grid[i if i < grid.shape[0] and grid.shape[0] > 2 else 0, rows, fx : x0 + w]
                strip[..., 3] = grid[-1, rows, fx : x0 + w] if grid.shape[0] in (2, 4) else 255
                if rings:
                    strip[..., 3] *= blocks.in_rings(rings, fx, top, x0 + w - fx, rows.stop - rows.start)
                for b in blocks.cut(strip, r.name, 0, (fx, top)).itertuples():
                    yield [*held, b.bx, b.by, b.w, b.h, b.rgba]

        for pdf in batches:
            for r in pdf.itertuples():
                try:
                    for row in one(r):
                        yield pd.DataFrame([row], columns=names)
                except (ValueError, KeyError, IndexError, TypeError, OverflowError, MemoryError, struct.error, zlib.error) as e:
                    yield pd.DataFrame([[r.name, f"{type(e).__name__}: {e}", *[None] * (len(names) - 2)]], columns=names)

    return found.mapInPandas(read, STAGED)


def failures(staged: DataFrame) -> DataFrame:
    """(dataset, error) of the datasets that could not be read or placed."""
    return staged.filter("error IS NOT NULL").select("dataset", "error")


def grids(staged: DataFrame) -> DataFrame:
    """(dataset, gt, system, min_x, max_y, res, width, height) of the others."""
    return staged.filter("error IS NULL AND bx IS NULL").select("dataset", "gt", "system", "min_x", "max_y", "res", "width", "height")


def reprojected(staged: DataFrame, method: str = "bilinear") -> DataFrame:
    """Blocks of the datasets in Web Mercator, level 0. Datasets with an error have none."""
    broken = failures(staged).select("dataset").distinct()
    own = staged.filter("bx IS NOT NULL").join(broken, "dataset", "left_anti")
    return blocks.warped(own, grids(staged).join(broken, "dataset", "left_anti"), method)


def tiles(levels: DataFrame, areas: DataFrame, members: DataFrame, zooms: DataFrame, n_levels: int, existing: DataFrame | None = None, method: str = "bilinear") -> DataFrame:
    """(tileset, tile_path, z, x, y, rgba): each tileset's tiles from the blocks of its datasets and their overviews.

    What a dataset shows of a tile is drawn once for all tilesets; then the painter's rule holds.
    """
    box = {"lon_min": m.lon_of("min_x"), "lon_max": m.lon_of(F.col("min_x") + F.col("res") * F.col("width")), "lat_max": m.lat_of("max_y"), "lat_min": m.lat_of(F.col("max_y") - F.col("res") * F.col("height"))}
    layers = ts.layer_order(members).select("tileset", "tile_path", "dataset", "layer", "max_lod").join(zooms, "tileset")
    placed = areas.join(layers, "dataset").withColumn("z", F.explode(F.sequence("zoom_min", F.least("zoom_max", "max_lod")))).withColumns(box)
    cells = manifest.cover(placed)
    own = {"min_x": F.col("min_x"), "max_x": F.col("min_x") + F.col("res") * F.col("width"), "max_y": F.col("max_y"), "min_y": F.col("max_y") - F.col("res") * F.col("height")}
    cells = cells.filter(manifest.overlaps(own, m.tile_bounds("z", "x", "y")))
    if existing is not None:
        cells = manifest.missing(cells, existing, ["tile_path"])
    wanted = cells.select("dataset", "z", "x", "y", "min_x", "max_y", "res", "width", "height", F.lit(n_levels).alias("levels")).distinct()
    parts = blocks.tile_parts(levels, wanted, method)
    named = cells.select("tileset", "tile_path", "z", "x", "y", "dataset", "layer").join(parts, ["dataset", "z", "x", "y"])
    return blocks.compose(named, ["tileset", "tile_path", "z", "x", "y"])


def build(spark: SparkSession, o: Options) -> DataFrame:
    """Draws and writes all tiles that are missing; (path, bytes) of what was written. Without out_dir, only the datasets are processed."""
    if not o.zip_dir and not o.reuse or not o.staging_dir:
        raise ValueError("zip_dir and staging_dir are needed to process datasets")
    datasets, tilesets, members = selected(spark, o)
    at = {k: f"{o.staging_dir}/{k}" for k in ("source", "blocks")}
    used = datasets.join(members.select(F.col("dataset").alias("name")).distinct(), "name", "left_semi")
    if not o.reuse:
        source_blocks(spark, used, o.zip_dir).write.mode("overwrite").parquet(at["source"])
        staged = spark.read.parquet(at["source"])
        reprojected(staged, o.reproject_resampling).write.mode("overwrite").partitionBy("level").parquet(at["blocks"])
    staged = spark.read.parquet(at["source"])
    areas = grids(staged).join(failures(staged).select("dataset").distinct(), "dataset", "left_anti").select("dataset", "min_x", "max_y", "res", "width", "height")
    finest = areas.agg(F.min("res")).first()[0]
    steps = 0 if finest is None else max(0, -(-int(math.log2(max(1.0, 2 * m.ORIGIN / m.TILE / finest))) // 3))
    if not o.reuse:
        for k in range(steps):
            below = spark.read.schema(blocks.BLOCK).parquet(at["blocks"]).filter(F.col("level") == 3 * k)
            blocks.overview_levels(below).write.mode("append").partitionBy("level").parquet(at["blocks"])
    if not o.out_dir:
        return failures(staged)
    levels = spark.read.schema(blocks.BLOCK).parquet(at["blocks"])
    drawn = tiles(levels, areas, members, ts.zoom_range(tilesets, members), 3 * steps, encode.existing_tiles(spark, o.out_dir, o.fmt), o.tile_resampling)
    return encode.write_tiles(encode.encode_tiles(drawn, o.fmt), o.out_dir, o.fmt)


def download(argv: list[str] | None = None) -> int:
    """The command that fetches what index pages link to, if it is newer than what is there."""
    p = argparse.ArgumentParser(description="Archives that index pages link to.")
    p.add_argument("-o", "--outpath", required=True, help="a folder that all executors share")
    p.add_argument("-p", "--page", action="append", default=[], required=True, help="URL of an index page, and = and the ids of its sections with commas between")
    p.add_argument("-l", "--list", action="store_true", help="only list the URLs")
    p.add_argument("-q", "--quiet", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("chartloom").getOrCreate()
    pages = [(url, [x for x in ids.split(",") if x]) for url, _, ids in (x.rpartition("=") for x in a.page)]
    found = web.linked(spark, pages)
    if a.list:
        for row in found.select("url").toLocalIterator():
            print(row.url)
        return 0
    done = web.fetch(found.select("url"), a.outpath).collect()  # a row for each archive
    bad = [r for r in done if r.status == "failed"]
    if not a.quiet:
        print(f"{len(done) - len(bad)} archives fetched or current, {len(bad)} failed")
    return 1 if bad else 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Raster archives to map tiles.")
    p.add_argument("-c", "--config", default=CONFIG)
    p.add_argument("-z", "--zippath")
    p.add_argument("-t", "--tmppath", help="staging folder; that of spark.checkpoint.dir by default")
    p.add_argument("-o", "--outpath")
    p.add_argument("-s", "--tilesets", default="all")
    p.add_argument("-l", "--list", action="store_true")
    p.add_argument("-C", "--cleanup", action="store_true")
    p.add_argument("-T", "--tile-only", "--existing", action="store_true", dest="reuse")
    p.add_argument("--single")
    p.add_argument("-R", "--reproject-resampling", default="bilinear", choices=pyramid.METHODS)
    p.add_argument("-S", "--tile-resampling", default="bilinear", choices=pyramid.METHODS)
    p.add_argument("-e", "--epsg", type=int, default=3857)
    p.add_argument("-f", "--format", default="png", choices=sorted(ENDINGS))
    p.add_argument("-q", "--quiet", action="store_true")
    a = p.parse_args(argv)
    names = tuple(x.strip() for x in a.tilesets.split(",") if x.strip())
    spark = SparkSession.builder.appName("chartloom").getOrCreate()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    staging = a.tmppath or (f"{shared}/chartloom-build" if shared else None)
    o = Options(a.config, a.zippath, staging, a.outpath, None if "all" in names else names, a.single, a.format, a.tile_resampling, a.reuse, a.cleanup, a.reproject_resampling, a.epsg)
    if a.list:
        _, tilesets, members = selected(spark, o)
        for row in ts.listing(tilesets, members).orderBy("tileset").toLocalIterator():
            print(row.line)
        return 0
    n = build(spark, o).count()
    failed = failures(spark.read.parquet(f"{staging}/source")).collect()  # a row for each dataset that failed
    for r in failed:
        print(f"{r.dataset}: {r.error}")
    if not a.quiet:
        print(f"{n} tiles written" if o.out_dir else "datasets processed")
    if o.cleanup:
        path = spark._jvm.org.apache.hadoop.fs.Path(o.staging_dir)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return 1 if failed else 0
