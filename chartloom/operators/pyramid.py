"""Overviews, resampling and mosaics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FACTORS = (2, 4, 8, 16, 32, 64)
METHODS = ("nearest", "average", "mode", "bilinear", "cubic", "cubicspline", "lanczos")


def overviews(pixels: DataFrame, by: list[str], values: list[str], factors=FACTORS) -> DataFrame:
    """Averages over squares of each factor.

    All factors come from one pass: pixels are summed for the least factor first,
    and larger squares are sums of those, so rows are multiplied only once they
    are few.
    """
    least = min(factors)
    sums = [F.sum(v).cast("double").alias(f"__{v}") for v in values] + [F.count("*").alias("__n")]
    base = pixels.groupBy(*by, F.floor(F.col("px") / least).cast("int").alias("px"), F.floor(F.col("py") / least).cast("int").alias("py")).agg(*sums)
    spread = base.withColumn("factor", F.explode(F.array(*map(F.lit, factors))))
    again = [F.sum(f"__{v}").alias(f"__{v}") for v in values] + [F.sum("__n").alias("__n")]
    place = lambda c: F.floor(F.col(c) * least / F.col("factor")).cast("int").alias(c)
    out = spread.groupBy(*by, "factor", place("px"), place("py")).agg(*again)
    return out.select(*by, "factor", "px", "py", *[(F.col(f"__{v}") / F.col("__n")).alias(v) for v in values])


def check_method(method: str) -> str:
    if method not in METHODS:
        raise ValueError(f"unknown resampling {method!r}; choose from {', '.join(METHODS)}")
    return method


def resample_average(pixels: DataFrame, by: list[str], value: str, factor: int) -> DataFrame:
    return pixels.groupBy(*by, *_cell(factor)).agg(F.avg(value).alias(value))


def _cell(factor: int):
    return [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("px", "py")]


def resample_mode(pixels: DataFrame, by: list[str], value: str, factor: int) -> DataFrame:
    """The most frequent value; of several, the least."""
    counts = pixels.groupBy(*by, *_cell(factor), value).agg(F.count("*").alias("__n"))
    best = F.max_by(value, F.struct("__n", -F.col(value)))
    return counts.groupBy(*by, "px", "py").agg(best.alias(value))


def resample_nearest(grid: DataFrame, pixels: DataFrame, by: list[str], value: str) -> DataFrame:
    """grid: (by, x, y, sx, sy) target pixels with places in the source; the pixel that a place falls into."""
    at = grid.withColumns({"px": F.floor("sx").cast("int"), "py": F.floor("sy").cast("int")})
    return at.join(pixels, [*by, "px", "py"]).select(*by, "x", "y", value)


def _weights(method: str, d):
    """Kernel weight at a distance in source pixels."""
    a = F.abs(d)
    if method == "bilinear":
        return F.greatest(1 - a, F.lit(0.0))
    if method == "cubic":  # Catmull-Rom
        near, far = 1.5 * a * a * a - 2.5 * a * a + 1, -0.5 * a * a * a + 2.5 * a * a - 4 * a + 2
        return F.when(a < 1, near).when(a < 2, far).otherwise(0.0)
    if method == "cubicspline":
        near, far = (4 - 6 * a * a + 3 * a * a * a) / 6, (2 - a) * (2 - a) * (2 - a) / 6
        return F.when(a < 1, near).when(a < 2, far).otherwise(0.0)
    pa = a * 3.141592653589793
    return F.when(a < 1e-9, 1.0).when(a < 3, 3 * F.sin(pa) * F.sin(pa / 3) / (pa * pa)).otherwise(0.0)


_REACH = {"bilinear": 1, "cubic": 2, "cubicspline": 2, "lanczos": 3}


def resample_kernel(grid: DataFrame, pixels: DataFrame, by: list[str], value: str, method: str = "bilinear") -> DataFrame:
    """Weighted mean of the pixels around each place: bilinear, cubic, cubicspline or lanczos.

    Each place lists its few neighbours and joins by equality; weights of absent
    or null neighbours are left out of the mean.
    """
    reach = _REACH[check_method(method)]
    around = F.array(*map(F.lit, range(1 - reach, reach + 1)))
    base = lambda c: F.floor(F.col(c) - 0.5).cast("int")
    near = grid.withColumns({"px": F.explode(F.transform(around, lambda k: base("sx") + k))})
    near = near.withColumns({"py": F.explode(F.transform(around, lambda k: base("sy") + k))})
    weight = _weights(method, F.col("sx") - 0.5 - F.col("px")) * _weights(method, F.col("sy") - 0.5 - F.col("py"))
    joined = near.withColumn("__w", weight).filter("__w != 0").join(pixels.filter(F.col(value).isNotNull()), [*by, "px", "py"])
    total = F.sum("__w")
    mean = F.when(F.abs(total) > 1e-12, F.sum(F.col("__w") * F.col(value)) / total)
    return joined.groupBy(*by, "x", "y").agg(mean.alias(value)).filter(F.col(value).isNotNull())


def present(rasters: DataFrame, files: DataFrame, name: str = "name") -> DataFrame:
    """Rasters whose file is there (files: the same column), so that a mosaic names no others."""
    return rasters.join(files.select(name).distinct(), name, "left_semi")


def mosaic_extent(rasters: DataFrame, by: list[str]) -> DataFrame:
    """Extent, finest resolution and size of each group; n_crs and n_bands tell whether its rasters agree."""
    g = rasters.groupBy(*by).agg(
        F.min("min_x").alias("min_x"),
        F.min("min_y").alias("min_y"),
        F.max("max_x").alias("max_x"),
        F.max("max_y").alias("max_y"),
        F.min("res_x").alias("res_x"),
        F.min("res_y").alias("res_y"),
        F.count_distinct("crs").alias("n_crs"),
        F.count_distinct("band_count").alias("n_bands"),
    )
    size = lambda a, b, r: F.floor((F.col(b) - F.col(a)) / F.col(r) + 0.5).cast("bigint")
    return g.withColumns({"width": size("min_x", "max_x", "res_x"), "height": size("min_y", "max_y", "res_y")})


def mosaic_files(rasters: DataFrame, by: list[str]) -> DataFrame:
    """Each raster's place (in pixels of the mosaic) and order, background first. Rasters that disagree raise an error."""
    extent = mosaic_extent(rasters, by)
    same = F.assert_true((F.col("n_crs") <= 1) & (F.col("n_bands") <= 1), "rasters of a mosaic need one reference system and number of bands")
    extent = extent.filter(same.isNull()).select(*by, F.col("min_x").alias("__x"), F.col("max_y").alias("__y"), F.col("res_x").alias("__rx"), F.col("res_y").alias("__ry"))
    at = lambda v: F.floor(v + 0.5).cast("bigint")
    order = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("max_lod").desc(), "ordinal"))
    return rasters.join(extent, by).select(
        *by,
        "name",
        order.alias("layer"),
        at((F.col("min_x") - F.col("__x")) / F.col("__rx")).alias("dst_x"),
        at((F.col("__y") - F.col("max_y")) / F.col("__ry")).alias("dst_y"),
        at((F.col("max_x") - F.col("min_x")) / F.col("__rx")).alias("dst_w"),
        at((F.col("max_y") - F.col("min_y")) / F.col("__ry")).alias("dst_h"),
    )


def mosaic_xml(files: DataFrame, by: list[str]) -> DataFrame:
    """An XML description of each mosaic (a few hundred rasters each)."""
    part = F.format_string('  <raster name="%s" x="%d" y="%d" width="%d" height="%d"/>', "name", "dst_x", "dst_y", "dst_w", "dst_h")
    rows = files.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("layer", part.alias("xml")))).alias("__r"))
    body = F.array_join(F.transform("__r", lambda r: r["xml"]), "\n")
    return rows.select(*by, F.concat(F.lit("<mosaic>\n"), body, F.lit("\n</mosaic>")).alias("xml"))


def zoom_mosaics(rasters: DataFrame, most: int) -> DataFrame:
    """rasters for each zoom ``z`` up to ``most`` that they are detailed enough for: the members of each zoom's mosaic."""
    return rasters.withColumn("z", F.explode(F.sequence(F.lit(0), F.least(F.col("max_lod"), F.lit(most)))))


#: What the bands of a mosaic show, by their number.
COLOURS = {1: ("Gray",), 2: ("Gray", "Alpha"), 3: ("Red", "Green", "Blue"), 4: ("Red", "Green", "Blue", "Alpha")}


def mosaic_vrt(rasters: DataFrame, by: list[str]) -> DataFrame:
    """(by, vrt): each mosaic as a virtual raster that tile tools read: extent, bands, and each raster's place in order.

    rasters: (by, name, crs, band_count, bounds, res_x, res_y, max_lod, ordinal). Pixels are bytes; overlapping rasters blend by their mask.
    """
    extent = mosaic_extent(rasters, by).withColumnsRenamed({c: f"__{c}" for c in ("min_x", "max_y", "res_x", "res_y", "width", "height")})
    about = rasters.groupBy(*by).agg(F.first("crs").alias("crs"), F.first("band_count").alias("bands"))
    size = lambda a, b, r: F.floor((F.col(b) - F.col(a)) / F.col(r) + 0.5).cast("bigint")
    own = rasters.select(*by, "name", size("min_x", "max_x", "res_x").alias("w"), size("min_y", "max_y", "res_y").alias("h"))
    placed = mosaic_files(rasters, by).join(own, [*by, "name"])
    source = F.format_string(
        "    <ComplexSource>\n      <SourceFilename>%s</SourceFilename>\n      <SourceBand>@</SourceBand>\n      <SourceProperties RasterXSize=\"%d\" RasterYSize=\"%d\" DataType=\"Byte\" />\n"
        "      <SrcRect xOff=\"0\" yOff=\"0\" xSize=\"%d\" ySize=\"%d\" />\n      <DstRect xOff=\"%d\" yOff=\"%d\" xSize=\"%d\" ySize=\"%d\" />\n      <UseMaskBand>true</UseMaskBand>\n    </ComplexSource>",
        F.replace(F.replace("name", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), "w", "h", "w", "h", "dst_x", "dst_y", "dst_w", "dst_h",
    )
    listed = placed.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("layer", source.alias("xml")))), lambda r: r["xml"]), "\n").alias("sources"))
    colours = F.create_map(*[F.lit(x) for n, names in COLOURS.items() for x in (n, ",".join(names))])
    bands = F.transform(
        F.split(colours[F.col("bands")], ","),
        lambda c, i: F.concat(
            F.format_string("  <VRTRasterBand dataType=\"Byte\" band=\"%d\">\n    <ColorInterp>%s</ColorInterp>\n", i + 1, c), F.replace("sources", F.lit("@"), (i + 1).cast("string")), F.lit("\n  </VRTRasterBand>\n")
        ),
    )
    head = F.format_string(
        "<VRTDataset rasterXSize=\"%d\" rasterYSize=\"%d\">\n  <SRS>%s</SRS>\n  <GeoTransform>%.6f, %.6f, 0.0, %.6f, 0.0, %.6f</GeoTransform>\n", "__width", "__height", "crs", "__min_x", "__res_x", "__max_y", -F.col("__res_y")
    )
    return extent.join(about, by).join(listed, by).select(*by, F.concat(head, F.array_join(bands, ""), F.lit("</VRTDataset>")).alias("vrt"))
