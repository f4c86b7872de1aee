"""The registered queries and their SQL.

Each query composes operators on views of the driver's tables; its SQL is
written apart, on the same tables, and outputs are cast and rounded alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions import affine, jsons, text
from chartloom.functions import mercator as m
from chartloom.operators import blocks, composite, encode, ingest, jobs, manifest, pyramid, raster, warp
from chartloom.operators import tilesets as ts
from chartloom.plans import pipeline as build
from chartloom.plans import views as v
from chartloom.plans.views import METERS, O_, ZOOMED, Tables, cover, res, tx, ty, with_

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of Tables under its name."""

    def add(f: Callable[[Tables], DataFrame]):
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r(c, n: int = 6) -> Column:
    return F.round(m.col(c), n)


def rounded(columns: dict[str, Column], n: int = 4) -> list[Column]:
    return [F.round(c, n).alias(k) for k, c in columns.items()]


def integers(columns: dict[str, Column]) -> list[Column]:
    return [c.cast("int").alias(k) for k, c in columns.items()]


# --- tile arithmetic


@query(f"SELECT z::INT AS z, round({res('z')}, 6) AS resolution FROM range(0, 23) r(z)")
def zoom_resolution(t):
    return t.spark.range(23).select(F.col("id").cast("int").alias("z"), r(m.resolution("id")).alias("resolution"))


@query(with_("pt") + f" SELECT event_id, z, {tx('lon', 'z')} AS x, {ty('lat', 'z')} AS y FROM (SELECT *, unnest([6, 12, 18])::INT AS z FROM pt)")
def tile_at_zoom(t):
    return v.points(t).withColumn("z", F.explode(F.array(*map(F.lit, (6, 12, 18))))).select("event_id", "z", m.tile_x("lon", "z").alias("x"), m.tile_y("lat", "z").alias("y"))


_CELL = f"SELECT event_id, 10 AS z, {tx('lon', '10')} AS x, {ty('lat', '10')} AS y FROM pt"


def _cells(t, z: int = 10) -> DataFrame:
    return v.points(t).withColumn("z", F.lit(z)).select("event_id", "z", m.tile_x("lon", "z").alias("x"), m.tile_y("lat", "z").alias("y"))


@query(
    with_("pt")
    + f", c AS ({_CELL}), s AS (SELECT *, {res('z')} * 256 AS side FROM c) SELECT event_id, round(x * side - {O_}, 4) AS min_x, round({O_} - y * side - side, 4) + 0.0 AS min_y,"
    f" round(x * side - {O_} + side, 4) AS max_x, round({O_} - y * side, 4) AS max_y FROM s"
)
def tile_bounds(t):
    return _cells(t).select("event_id", *rounded(m.tile_bounds("z", "x", "y")))


@query(with_("pt") + f", c AS ({_CELL}) SELECT event_id, y, (pow(2.0, z) - 1 - y)::INT AS tms_y FROM c")
def tms_flip(t):
    return _cells(t).select("event_id", "y", m.flip_row("y", "z").alias("tms_y"))


@query(
    with_("pt") + f" SELECT event_id, round(mx * 180.0 / {O_}, 6) AS lon, round(degrees(atan(sinh(my * pi() / {O_}))), 6) AS lat"
    f" FROM (SELECT event_id, lon * {O_} / 180.0 AS mx, lat * 100000.0::DOUBLE AS my FROM pt)"
)
def inverse_mercator(t):
    return v.points(t).select("event_id", r(m.lon_of(m.mx_of("lon"))).alias("lon"), r(m.lat_of(F.col("lat") * 100000.0)).alias("lat"))


@query(with_("pt") + f" SELECT event_id, round((lon * 100000.0 + {O_}) / {res('8')}, 4) AS px, round((event_id % 65536) * {res('8')} - {O_}, 4) AS meters FROM pt")
def meters_pixels(t):
    return v.points(t).select(
        "event_id", r(m.meters_to_pixels(F.col("lon") * 100000.0, F.lit(8)), 4).alias("px"), r(m.pixels_to_meters(F.col("event_id") % 65536, F.lit(8)), 4).alias("meters")
    )


@query(
    with_("pt") + f" SELECT event_id, (ceil((lon * 100000.0 + {O_}) / {res('8')} / 256.0) - 1)::INT AS tx, (ceil((lat * 100000.0 + {O_}) / {res('8')} / 256.0) - 1)::INT AS ty FROM pt"
)
def meters_to_tile(t):
    return v.points(t).select("event_id", m.meters_to_tile(F.col("lon") * 100000.0, F.lit(8)).alias("tx"), m.meters_to_tile(F.col("lat") * 100000.0, F.lit(8)).alias("ty"))


@query(
    f"SELECT p_partkey, CASE WHEN min(i) IS NULL THEN 31 ELSE greatest(min(i) - 1, 0) END::INT AS zoom FROM part LEFT JOIN range(0, 32) r(i) ON p_retailprice * p_retailprice / 1000 > {res('i')} GROUP BY p_partkey"
)
def zoom_for_pixel_size(t):
    return t.part.select("p_partkey", m.zoom_for_pixel_size(F.col("p_retailprice") * F.col("p_retailprice") / 1000).alias("zoom"))


@query(with_("ds") + f" SELECT id, round({res('max_lod')} / cos(radians(lat_min + 2.625)), 6) AS ground FROM ds")
def lat_resolution(t):
    return v.datasets(t).select("id", r(m.ground_resolution("max_lod", F.col("lat_min") + 2.625)).alias("ground"))


@query(with_("ds") + f", q AS (SELECT id, {METERS} FROM ds) SELECT id, round(degrees(atan(sinh((min_y + max_y) / 2 * pi() / {O_}))), 6) AS center FROM q")
def center_latitude(t):
    return manifest.with_meters(v.datasets(t)).select("id", r(m.center_latitude("min_y", "max_y")).alias("center"))


@query(with_("pt") + f", c AS ({_CELL}) SELECT event_id, (x::BIGINT << 16) | y::BIGINT AS key FROM c")
def pack_tile(t):
    return _cells(t).select("event_id", m.pack_tile("x", "y").alias("key"))


def _gt() -> list:
    return ["lon_min", F.lit(0.01), F.lit(0.002), "lat_max", F.lit(-0.003), F.lit(-0.01)]


@query(
    with_("ds") + " SELECT id, round(lon_min + (id % 50) * 0.01::DOUBLE + (id % 30) * 0.002::DOUBLE, 6) AS gt0, round(lat_max + (id % 50) * -0.003::DOUBLE + (id % 30) * -0.01::DOUBLE, 6) AS gt3 FROM ds"
)
def window_geotransform(t):
    gt = affine.shift_window(_gt(), F.col("id") % 50, F.col("id") % 30)
    return v.datasets(t).select("id", r(gt[0]).alias("gt0"), r(gt[3]).alias("gt3"))


def _corner_sql() -> str:
    xs = [f"lon_min + (id % 50 + {dx}) * 0.01::DOUBLE + (id % 30 + {dy}) * 0.002::DOUBLE" for dx in (0, 200) for dy in (0, 100)]
    ys = [f"lat_max + (id % 50 + {dx}) * -0.003::DOUBLE + (id % 30 + {dy}) * -0.01::DOUBLE" for dx in (0, 200) for dy in (0, 100)]
    parts = [("least", xs, "min_x"), ("least", ys, "min_y"), ("greatest", xs, "max_x"), ("greatest", ys, "max_y")]
    return ", ".join(f"round({f}({', '.join(c)}), 6) AS {n}" for f, c, n in parts)


@query(with_("ds") + f" SELECT id, {_corner_sql()} FROM ds")
def rotated_bounds(t):
    return v.datasets(t).select("id", *rounded(affine.rotated_bounds(_gt(), F.col("id") % 50, F.col("id") % 30, F.lit(200), F.lit(100)), 6))


_PAIRS = f"""q AS (SELECT id, max_lod, lon_min, lat_min, lon_max, lat_max, {METERS} FROM ds),
cc AS {cover("(SELECT *, unnest(range(0, least(max_lod, 8) + 1))::INT AS z FROM q)", "id, min_x, min_y, max_x, max_y")},
tb AS (SELECT *, {res("z")} * 256 AS side FROM cc),
pr AS (SELECT *, x * side - {O_} AS tx0, {O_} - y * side - side AS ty0, x * side - {O_} + side AS tx1, {O_} - y * side AS ty1 FROM tb),
tp AS (SELECT * FROM pr WHERE min_x < tx1 - 1e-6 AND max_x > tx0 + 1e-6 AND min_y < ty1 - 1e-6 AND max_y > ty0 + 1e-6)"""


@query(
    with_("ds")
    + f""",
{_PAIRS},
w AS (SELECT *, (max_x - min_x) / 850 AS px, (max_y - min_y) / 525 AS py, (tx1 - tx0) / 256.0 AS u, greatest(tx0, min_x) AS we, least(tx1, max_x) AS ea, greatest(ty0, min_y) AS so, least(ty1, max_y) AS no FROM tp WHERE z = 5),
s AS (SELECT *, floor((we - min_x) / px) AS sx, floor((max_y - no) / py) AS sy, floor((we - tx0) / u) AS dx, floor((ty1 - no) / u) AS dy FROM w)
SELECT id, z, x, y, sx::INT AS src_x, sy::INT AS src_y, least(greatest(floor((ea - we) / px + 0.5), 1), 850 - sx)::INT AS src_w, least(greatest(floor((no - so) / py + 0.5), 1), 525 - sy)::INT AS src_h,
dx::INT AS dst_x, dy::INT AS dst_y, least(greatest(floor((ea - we) / u + 0.5), 1), 256 - dx)::INT AS dst_w, least(greatest(floor((no - so) / u + 0.5), 1), 256 - dy)::INT AS dst_h FROM s"""
)
def tile_read_window(t):
    d = manifest.with_meters(v.datasets(t))
    cells = manifest.cover(d.filter("max_lod >= 5").withColumn("z", F.lit(5)))
    own = {k: F.col(k) for k in ("min_x", "min_y", "max_x", "max_y")}
    tile = m.tile_bounds("z", "x", "y")
    windows = affine.read_window(tile, own, (F.col("max_x") - F.col("min_x")) / 850, (F.col("max_y") - F.col("min_y")) / 525, F.lit(850), F.lit(525))
    return cells.filter(manifest.overlaps(own, tile)).select("id", "z", "x", "y", *integers(windows))


# --- tilesets and datasets


@query(with_("ds", "mb") + " SELECT tileset, dataset, ordinal, id, max_lod FROM mb JOIN ds ON name = dataset")
def tileset_members(t):
    return ts.members(v.membership(t), v.datasets(t)).select("tileset", "dataset", "ordinal", "id", "max_lod")


@query(with_("ds", "mb") + " SELECT tileset, dataset, ordinal FROM mb WHERE NOT EXISTS (SELECT 1 FROM ds WHERE name = dataset AND id % 7 <> 0)")
def unknown_members(t):
    return ts.unknown_members(v.membership(t), v.datasets(t).filter("id % 7 <> 0")).select("tileset", "dataset", "ordinal")


@query("SELECT r_name AS name, lower(r_name) AS tile_path FROM region WHERE r_name IN ('ASIA') OR lower(r_name) IN ('europe')")
def tileset_lookup(t):
    return ts.select(v.tilesets(t), ["ASIA", "europe"])


@query(
    with_("ds", "mb")
    + " SELECT r_name AS tileset, 0 AS zoom_min, CASE WHEN max(max_lod) > 0 THEN max(max_lod) ELSE 12 END::INT AS zoom_max FROM region LEFT JOIN mb ON tileset = r_name LEFT JOIN ds ON name = dataset GROUP BY r_name"
)
def tileset_zoom_range(t):
    return ts.zoom_range(v.tilesets(t), ts.members(v.membership(t), v.datasets(t)))


@query(with_("ds") + " SELECT id, name, max_lod FROM ds WHERE max_lod >= 7")
def datasets_for_zoom(t):
    return ts.for_zoom(v.datasets(t), 7).select("id", "name", "max_lod")


@query(with_("ds", "mb") + " SELECT tileset, id, row_number() OVER (PARTITION BY tileset ORDER BY max_lod DESC, ordinal)::INT AS layer FROM mb JOIN ds ON name = dataset")
def layer_order(t):
    return ts.layer_order(ts.members(v.membership(t), v.datasets(t))).select("tileset", "id", "layer")


@query(with_("ds", "mb") + " SELECT tileset, printf('%-40s (%s, zoom 0-%d)', tileset, tile_path, max(max_lod)::INT) AS line FROM mb JOIN ds ON name = dataset GROUP BY tileset, tile_path")
def tileset_listing(t):
    known = ts.members(v.membership(t), v.datasets(t)).select("tileset", "dataset", "max_lod")
    return ts.listing(v.tilesets(t), known).join(known.select("tileset").distinct(), "tileset", "left_semi")


@query(with_("ds") + " SELECT id, abs(round(lon_min * lat_min, 4)) AS work, row_number() OVER (ORDER BY abs(lon_min * lat_min) DESC, name)::INT AS place FROM ds")
def job_order(t):
    jobs = v.datasets(t).withColumn("work", F.abs(F.col("lon_min") * F.col("lat_min")))
    return ts.job_order(jobs).select("id", r("work", 4).alias("work"), "place")


@query(with_("mb") + " SELECT count(*)::BIGINT AS memberships, count(DISTINCT dataset)::BIGINT AS datasets FROM mb")
def tileset_totals(t):
    return ts.totals(v.membership(t))


@query(with_("ds") + " SELECT zip_file, arg_min(name, id) AS name, min(id) AS id FROM ds GROUP BY zip_file")
def first_named(t):
    return ts.first_named(v.datasets(t).select("zip_file", "name", "id"), "zip_file", "id")


# --- manifest


@query(with_("ds") + f" SELECT id, z FROM {ZOOMED}")
def zoom_cross(t):
    return manifest.zoom_cross(v.datasets(t), F.lit(8)).select("id", "z")


@query(with_("ds") + f" SELECT id, x, y FROM {cover('(SELECT *, 6 AS z FROM ds)', 'id')}")
def tile_cover(t):
    return manifest.cover(v.datasets(t).withColumn("z", F.lit(6))).select("id", "x", "y")


@query(
    with_("ds")
    + f""", wr AS (SELECT id, CASE WHEN id % 10 = 0 THEN 176.0 ELSE lon_min END AS w, CASE WHEN id % 10 = 0 THEN -176.0 ELSE lon_max END AS e, lat_min, lat_max, 4 AS z FROM ds),
bx AS (SELECT id, w AS lon_min, 180.0 AS lon_max, lat_min, lat_max, z FROM wr WHERE w > e UNION ALL SELECT id, -180.0, e, lat_min, lat_max, z FROM wr WHERE w > e UNION ALL SELECT id, w, e, lat_min, lat_max, z FROM wr WHERE w <= e)
SELECT DISTINCT id, x, y FROM {cover('bx', 'id')}"""
)
def antimeridian_cover(t):
    return manifest.cover(manifest.split_antimeridian(v.wrapped(t).withColumn("z", F.lit(4)))).select("id", "x", "y").distinct()


@query(with_("ds") + f" SELECT DISTINCT z, x, y FROM {cover(ZOOMED, 'id')}")
def tile_manifest(t):
    return manifest.manifest(v.datasets(t), F.lit(8))


@query(with_("ds") + f" SELECT coalesce(z::VARCHAR, 'all') AS zoom, count(*)::BIGINT AS tiles FROM (SELECT DISTINCT z, x, y FROM {cover(ZOOMED, 'id')}) GROUP BY ROLLUP (z)")
def manifest_summary(t):
    counts = manifest.summary(manifest.manifest(v.datasets(t), F.lit(8)))
    return counts.select(F.coalesce(F.col("z").cast("string"), F.lit("all")).alias("zoom"), "tiles")


@query(with_("ds") + f" SELECT DISTINCT z, x FROM {cover(ZOOMED, 'id')}")
def output_folders(t):
    return manifest.output_folders(manifest.manifest(v.datasets(t), F.lit(8)))


def _tms(c: str) -> str:
    return f"greatest(least(ceil(({c} + {O_}) / {res('5')} / 256.0) - 1, 31), 0)::INT"


@query(
    with_("ds")
    + f", q AS (SELECT id, {METERS} FROM ds) SELECT id, x, unnest(range(y0, y1 + 1))::INT AS tms_y FROM (SELECT id, {_tms('min_y')} AS y0, {_tms('max_y')} AS y1, unnest(range({_tms('min_x')}, {_tms('max_x')} + 1))::INT AS x FROM q)"
)
def bounds_tiles(t):
    return manifest.bounds_tiles(manifest.with_meters(v.datasets(t)), F.lit(5)).select("id", "x", "tms_y")


_PROBES = ((-100.0, 20.0, -60.0, 50.0), (0.0, 0.0, 45.0, 45.0), (60.0, -40.0, 120.0, 10.0))


@query(
    with_("ds")
    + " SELECT id, probe FROM ds JOIN (VALUES "
    + ", ".join(f"({i}, {a}, {b}, {c}, {d})" for i, (a, b, c, d) in enumerate(_PROBES))
    + ") p(probe, w, s, e, n) ON lon_min < e - 1e-6 AND lon_max > w + 1e-6 AND lat_min < n - 1e-6 AND lat_max > s + 1e-6"
)
def bbox_overlap(t):
    probe = F.array(*[F.struct(F.lit(i).alias("probe"), *[F.lit(x).alias(k) for k, x in zip("wsen", p, strict=True)]) for i, p in enumerate(_PROBES)])
    rows = v.datasets(t).withColumn("p", F.explode(probe)).select("*", "p.*")
    own = {"min_x": "lon_min", "min_y": "lat_min", "max_x": "lon_max", "max_y": "lat_max"}
    return rows.filter(manifest.overlaps(own, {"min_x": "w", "min_y": "s", "max_x": "e", "max_y": "n"})).select("id", "probe")


@query(with_("ds") + f",\n{_PAIRS} SELECT z, x, y, id FROM tp")
def tile_dataset_pairs(t):
    return manifest.tile_pairs(v.datasets(t), F.lit(8))


@query(
    with_("ds")
    + ", two AS (SELECT id, max_lod, lat_min, lat_max, w AS lon_min, e AS lon_max FROM (SELECT *, CASE WHEN id % 10 = 0 THEN 176.0 ELSE lon_min END AS w0, CASE WHEN id % 10 = 0 THEN -176.0 ELSE lon_max END AS e0 FROM ds) d,"
    " LATERAL (SELECT w0 AS w, CASE WHEN w0 > e0 THEN 180.0 ELSE e0 END AS e UNION ALL SELECT -180.0, e0 WHERE w0 > e0) b)"
    + f",\n{_PAIRS.replace('FROM ds)', 'FROM two)', 1)} SELECT DISTINCT z, x, y, id FROM tp"
)
def wrapped_pairs(t):
    return manifest.tile_pairs(v.wrapped(t), F.lit(8))


_TILES = f"(SELECT DISTINCT z, x, y FROM {cover(ZOOMED, 'id')})"


@query(with_("ds") + f" SELECT z, x, y FROM {_TILES} WHERE z % 2 = 0")
def mosaic_zooms(t):
    mosaics = t.spark.range(0, 9, 2).select(F.col("id").cast("int").alias("z"))
    return manifest.in_order(manifest.with_mosaic(manifest.manifest(v.datasets(t), F.lit(8)), mosaics))


@query(with_("ds") + f" SELECT z, x, y FROM {_TILES} WHERE (x + y) % 3 <> 0")
def skip_existing(t):
    tiles = manifest.manifest(v.datasets(t), F.lit(8))
    return manifest.missing(tiles, tiles.filter((F.col("x") + F.col("y")) % 3 == 0))


@query(with_("ds") + f" SELECT 'base/' || z || '/' || x || '/' || y || '.jpg' AS path FROM {_TILES}")
def tile_paths(t):
    return manifest.manifest(v.datasets(t), F.lit(8)).select(text.tile_path(F.lit("base"), "z", "x", "y", "jpeg").alias("path"))


# --- rasters


def _ring(points, dx: Column, dy: Column) -> Column:
    return F.array(*[F.struct((F.lit(x) + dx).alias("x"), (F.lit(y) + dy).alias("y")) for x, y in points])


@query(
    "WITH s AS (SELECT s_suppkey AS id, (s_suppkey % 13) * 1.7::DOUBLE - 5 AS dx, (s_suppkey % 7) * 2.3::DOUBLE - 4 AS dy FROM supplier),"
    " b AS (SELECT id, greatest(least(trunc(0 + dx), 16), 0) AS x0, greatest(least(trunc(10 + dx), 16), 0) AS x1, greatest(least(trunc(0 + dy), 12), 0) AS y0, greatest(least(trunc(10 + dy), 12), 0) AS y1 FROM s)"
    " SELECT id, x0::INT AS x, y0::INT AS y, (x1 - x0)::INT AS w, (y1 - y0)::INT AS h FROM b"
)
def mask_bbox(t):
    k = F.col("s_suppkey")
    ring = _ring(v.RING, (k % 13) * 1.7 - 5, (k % 7) * 2.3 - 4)
    return t.supplier.select(k.alias("id"), *integers(raster.ring_bbox(ring, F.lit(16), F.lit(12))))


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN 0.0 ELSE 10.0 * (10.0 + s_suppkey % 3) END::DOUBLE AS work FROM supplier")
def estimate_work(t):
    k = F.col("s_suppkey")
    stretch = F.array(*[F.struct(F.lit(x).alias("x"), F.when(F.lit(y) == 10.0, F.lit(y) + k % 3).otherwise(F.lit(y)).alias("y")) for x, y in v.RING])
    return t.supplier.select(k.alias("id"), raster.estimated_work(F.when(k % 4 != 0, stretch)).alias("work"))


def _edges(*rings) -> list[tuple]:
    return [(*a, *b) for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]


@query(
    "WITH e(x1, y1, x2, y2) AS (VALUES "
    + ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for a, b, c, d in _edges(v.RING, v.HOLE))
    + "), p AS (SELECT DISTINCT (l_orderkey % 16)::INT AS px, (l_partkey % 16)::INT AS py FROM lineitem)"
    " SELECT px, py, CASE WHEN count(x1) % 2 = 1 THEN 255 ELSE 0 END AS a FROM p LEFT JOIN e ON ((y1 <= py + 0.5) <> (y2 <= py + 0.5)) AND x1 + (py + 0.5 - y1) * (x2 - x1) / (y2 - y1) > px + 0.5 GROUP BY px, py"
)
def mask_alpha(t):
    places = v.pixels(t).select("px", "py").distinct()
    edges = t.spark.createDataFrame(_edges(v.RING, v.HOLE), "x1 double, y1 double, x2 double, y2 double")
    return raster.mask_alpha(places, edges)


@query(
    with_("ds")
    + " SELECT id, round(greatest(lon_min, coalesce(CASE WHEN id % 3 <> 0 THEN -90.0 END, lon_min)), 6) AS lon_min, round(greatest(lat_min, coalesce(CASE WHEN id % 4 <> 0 THEN 0.0 END, lat_min)), 6) AS lat_min,"
    " round(least(lon_max, coalesce(CASE WHEN id % 5 <> 0 THEN 100.0 END, lon_max)), 6) AS lon_max, round(lat_max, 6) AS lat_max FROM ds"
)
def geo_clip(t):
    bound = lambda n, value: F.when(F.col("id") % n != 0, F.lit(value))
    clipped = raster.clip_bounds(
        {k: k for k in ("lon_min", "lat_min", "lon_max", "lat_max")}, {"lon_min": bound(3, -90.0), "lat_min": bound(4, 0.0), "lon_max": bound(5, 100.0), "lat_max": F.lit(None).cast("double")}
    )
    return v.datasets(t).select("id", *rounded(clipped, 6))


@query(with_("pal") + " SELECT l_orderkey, l_linenumber, r, g, b FROM lineitem JOIN pal ON idx = (l_partkey % 256)::INT")
def palette_expand(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 256).cast("int").alias("idx"))
    return raster.palette_expand(rows, v.palette(t)).select("l_orderkey", "l_linenumber", "r", "g", "b")


@query(
    with_("gcp")
    + """ SELECT ds, round(avg(lon) - xa * avg(px) - xb * avg(py), 6) + 0.0 AS x0, round(xa, 6) + 0.0 AS xa, round(xb, 6) + 0.0 AS xb, round(avg(lat) - ya * avg(px) - yb * avg(py), 6) + 0.0 AS y0, round(ya, 6) + 0.0 AS ya, round(yb, 6) + 0.0 AS yb FROM gcp
 JOIN (SELECT ds, (cxl * vy - cyl * cxy) / (vx * vy - cxy * cxy) AS xa, (cyl * vx - cxl * cxy) / (vx * vy - cxy * cxy) AS xb, (cxt * vy - cyt * cxy) / (vx * vy - cxy * cxy) AS ya, (cyt * vx - cxt * cxy) / (vx * vy - cxy * cxy) AS yb FROM
 (SELECT ds, var_pop(px) AS vx, var_pop(py) AS vy, covar_pop(px, py) AS cxy, covar_pop(px, lon) AS cxl, covar_pop(py, lon) AS cyl, covar_pop(px, lat) AS cxt, covar_pop(py, lat) AS cyt FROM gcp GROUP BY ds)) USING (ds) GROUP BY ds, xa, xb, ya, yb"""
)
def gcp_affine(t):
    fit = raster.gcp_affine(v.gcps(t))
    return fit.select("ds", *[(F.round(c, 6) + 0.0).alias(c) for c in fit.columns if c != "ds"])


@query("SELECT l_orderkey, l_linenumber, (l_orderkey % 100 - 20)::INT AS px, (l_partkey % 100 - 30)::INT AS py FROM lineitem WHERE l_orderkey % 100 >= 20 AND l_orderkey % 100 < 70 AND l_partkey % 100 >= 30 AND l_partkey % 100 < 55")
def pixel_window(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 100).cast("int").alias("px"), (F.col("l_partkey") % 100).cast("int").alias("py"))
    return raster.window(rows, F.lit(20), F.lit(30), F.lit(50), F.lit(25))


@query(with_("px") + " SELECT px, py, v, a, ds FROM px WHERE a > 0 QUALIFY row_number() OVER (PARTITION BY px, py ORDER BY lod, ds DESC, l_orderkey DESC, l_linenumber DESC) = 1")
def painter_composite(t):
    return composite.painter(v.pixels(t), ["px", "py"], ["v", "ds"], order=["ds", "l_orderkey", "l_linenumber"]).select("px", "py", "v", "a", "ds")


@query(with_("px") + " SELECT ds, px FROM px GROUP BY ds, px HAVING max(a) > 0")
def nonempty_tiles(t):
    return composite.nonempty(v.pixels(t), ["ds", "px"])


@query(
    "WITH p AS (SELECT (l_suppkey % 7)::INT AS ds, (l_orderkey % 512)::INT AS px, (l_partkey % 512)::INT AS py, floor(l_quantity) AS v FROM lineitem)"
    " SELECT ds, f AS factor, floor(px / f)::INT AS px, floor(py / f)::INT AS py, round(avg(v), 6) AS v FROM p, (VALUES (2), (4), (8), (16), (32), (64)) x(f) GROUP BY ALL"
)
def overview_avg(t):
    rows = t.lineitem.select(
        (F.col("l_suppkey") % 7).cast("int").alias("ds"), (F.col("l_orderkey") % 512).cast("int").alias("px"), (F.col("l_partkey") % 512).cast("int").alias("py"), F.floor("l_quantity").alias("v")
    )
    out = pyramid.overviews(rows, ["ds"], ["v"])
    return out.withColumn("v", F.round("v", 6))


_GRID = "(SELECT ds, x::INT AS x, y::INT AS y, (x + 0.5) * 1.6::DOUBLE AS sx, (y + 0.5) * 1.6::DOUBLE AS sy FROM (SELECT DISTINCT ds FROM rs), range(0, 10) a(x), range(0, 10) b(y))"


def _grid(t) -> DataFrame:
    cells = v.raster(t).select("ds").distinct()
    cells = cells.withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(9))))
    return cells.select("ds", "x", "y", ((F.col("x") + 0.5) * 1.6).alias("sx"), ((F.col("y") + 0.5) * 1.6).alias("sy"))


@query(with_("rs") + f" SELECT g.ds, x, y, v FROM {_GRID} g JOIN rs ON rs.ds = g.ds AND px = floor(sx)::INT AND py = floor(sy)::INT")
def resample_nearest(t):
    return pyramid.resample_nearest(_grid(t), v.raster(t), ["ds"], "v")


@query(with_("rs") + " SELECT ds, floor(px / 4)::INT AS px, floor(py / 4)::INT AS py, round(avg(v), 6) AS v FROM rs GROUP BY ALL")
def resample_average(t):
    return pyramid.resample_average(v.raster(t), ["ds"], "v", 4).withColumn("v", F.round("v", 6))


@query(
    with_("rs") + ", c AS (SELECT ds, floor(px / 4)::INT AS cx, floor(py / 4)::INT AS cy, v, count(*) AS n FROM rs GROUP BY ALL)"
    " SELECT ds, cx AS px, cy AS py, v FROM c QUALIFY row_number() OVER (PARTITION BY ds, cx, cy ORDER BY n DESC, v) = 1"
)
def resample_mode(t):
    return pyramid.resample_mode(v.raster(t), ["ds"], "v", 4)


def _kernel_sql(reach: int, weight: Callable[[str], str]) -> str:
    near = f"range({1 - reach}, {reach + 1})"
    return (
        with_("rs")
        + f""", n AS (SELECT ds, x, y, sx, sy, (floor(sx - 0.5) + i)::INT AS px, (floor(sy - 0.5) + j)::INT AS py FROM {_GRID}, {near} a(i), {near} b(j)),
 w AS (SELECT n.*, ({weight("abs(sx - 0.5 - px)")}) * ({weight("abs(sy - 0.5 - py)")}) AS w FROM n)
 SELECT w.ds, x, y, round(sum(w * v) / sum(w), 8) + 0.0 AS v FROM w JOIN rs USING (ds, px, py) WHERE w <> 0 GROUP BY w.ds, x, y HAVING abs(sum(w)) > 1e-12"""
    )


def _kernel(t, method: str) -> DataFrame:
    return pyramid.resample_kernel(_grid(t), v.raster(t), ["ds"], "v", method).withColumn("v", F.round("v", 8) + 0.0)


@query(_kernel_sql(1, lambda d: f"greatest(1 - {d}, 0)"))
def resample_bilinear(t):
    return _kernel(t, "bilinear")


@query(_kernel_sql(2, lambda d: f"CASE WHEN {d} < 1 THEN 1.5 * {d} * {d} * {d} - 2.5 * {d} * {d} + 1 WHEN {d} < 2 THEN -0.5 * {d} * {d} * {d} + 2.5 * {d} * {d} - 4 * {d} + 2 ELSE 0 END"))
def resample_cubic(t):
    return _kernel(t, "cubic")


@query(_kernel_sql(2, lambda d: f"CASE WHEN {d} < 1 THEN (4 - 6 * {d} * {d} + 3 * {d} * {d} * {d}) / 6 WHEN {d} < 2 THEN (2 - {d}) * (2 - {d}) * (2 - {d}) / 6 ELSE 0 END"))
def resample_cubicspline(t):
    return _kernel(t, "cubicspline")


@query(_kernel_sql(3, lambda d: f"CASE WHEN {d} < 1e-9 THEN 1 WHEN {d} < 3 THEN 3 * sin(pi() * {d}) * sin(pi() * {d} / 3) / (pi() * {d} * pi() * {d}) ELSE 0 END"))
def resample_lanczos(t):
    return _kernel(t, "lanczos")


def _rasters(t) -> DataFrame:
    rows = manifest.with_meters(v.datasets(t)).join(v.membership(t).select(F.col("dataset").alias("name"), "tileset", "ordinal"), "name")
    return rows.withColumns({"res_x": m.resolution("max_lod"), "res_y": m.resolution("max_lod"), "crs": F.lit("EPSG:3857"), "band_count": F.lit(4)})


_RASTERS = f"q AS (SELECT tileset, ordinal, name, max_lod, {METERS}, {res('max_lod')} AS rs FROM ds JOIN mb ON name = dataset)"


@query(
    with_("ds", "mb")
    + f", {_RASTERS}, e AS (SELECT tileset, min(min_x) AS min_x, min(min_y) AS min_y, max(max_x) AS max_x, max(max_y) AS max_y, min(rs) AS rs FROM q GROUP BY tileset)"
    " SELECT tileset, round(min_x, 3) AS min_x, round(min_y, 3) AS min_y, round(max_x, 3) AS max_x, round(max_y, 3) AS max_y, floor((max_x - min_x) / rs + 0.5)::BIGINT AS width, floor((max_y - min_y) / rs + 0.5)::BIGINT AS height FROM e"
)
def mosaic_extent(t):
    e = pyramid.mosaic_extent(_rasters(t), ["tileset"])
    return e.select("tileset", *[F.round(c, 3).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")], "width", "height")


@query(
    with_("ds", "mb")
    + f", {_RASTERS}, e AS (SELECT tileset, min(min_x) AS x, max(max_y) AS y, min(rs) AS s FROM q GROUP BY tileset)"
    " SELECT tileset, name, row_number() OVER (PARTITION BY tileset ORDER BY max_lod DESC, ordinal)::INT AS layer, floor((min_x - x) / s + 0.5)::BIGINT AS dst_x, floor((y - max_y) / s + 0.5)::BIGINT AS dst_y,"
    " floor((max_x - min_x) / s + 0.5)::BIGINT AS dst_w, floor((max_y - min_y) / s + 0.5)::BIGINT AS dst_h FROM q JOIN e USING (tileset)"
)
def mosaic_files(t):
    return pyramid.mosaic_files(_rasters(t), ["tileset"])


@query(
    with_("ds", "mb")
    + f", {_RASTERS}, e AS (SELECT tileset, min(min_x) AS x, max(max_y) AS y, min(rs) AS s FROM q GROUP BY tileset),"
    " f AS (SELECT tileset, name, row_number() OVER (PARTITION BY tileset ORDER BY max_lod DESC, ordinal) AS layer, floor((min_x - x) / s + 0.5)::BIGINT AS dx, floor((y - max_y) / s + 0.5)::BIGINT AS dy,"
    " floor((max_x - min_x) / s + 0.5)::BIGINT AS dw, floor((max_y - min_y) / s + 0.5)::BIGINT AS dh FROM q JOIN e USING (tileset))"
    " SELECT tileset, '<mosaic>' || chr(10) || string_agg(printf('  <raster name=\"%s\" x=\"%d\" y=\"%d\" width=\"%d\" height=\"%d\"/>', name, dx, dy, dw, dh), chr(10) ORDER BY layer) || chr(10) || '</mosaic>' AS xml FROM f GROUP BY tileset"
)
def mosaic_xml(t):
    return pyramid.mosaic_xml(pyramid.mosaic_files(_rasters(t), ["tileset"]), ["tileset"])


def _vrt_sql(band: int, colour: str) -> str:
    source = (
        "    <ComplexSource>\n      <SourceFilename>%s</SourceFilename>\n      <SourceBand>{0}</SourceBand>\n      <SourceProperties RasterXSize=\"%d\" RasterYSize=\"%d\" DataType=\"Byte\" />\n"
        "      <SrcRect xOff=\"0\" yOff=\"0\" xSize=\"%d\" ySize=\"%d\" />\n      <DstRect xOff=\"%d\" yOff=\"%d\" xSize=\"%d\" ySize=\"%d\" />\n      <UseMaskBand>true</UseMaskBand>\n    </ComplexSource>"
    ).format(band)
    start, end = f'  <VRTRasterBand dataType="Byte" band="{band}">\n    <ColorInterp>{colour}</ColorInterp>\n', "\n  </VRTRasterBand>\n"
    return f"'{start}' || string_agg(printf('{source}', name, w, h, w, h, dx, dy, dw, dh), chr(10) ORDER BY layer) || '{end}'"


@query(
    with_("ds", "mb")
    + f", {_RASTERS}, e AS (SELECT tileset, min(min_x) AS x, min(min_y) AS y0, max(max_x) AS x1, max(max_y) AS y, min(rs) AS s FROM q GROUP BY tileset),"
    " f AS (SELECT *, row_number() OVER (PARTITION BY tileset ORDER BY max_lod DESC, ordinal) AS layer, floor((min_x - x) / s + 0.5)::BIGINT AS dx, floor((y - max_y) / s + 0.5)::BIGINT AS dy,"
    " floor((max_x - min_x) / s + 0.5)::BIGINT AS dw, floor((max_y - min_y) / s + 0.5)::BIGINT AS dh, floor((max_x - min_x) / rs + 0.5)::BIGINT AS w, floor((max_y - min_y) / rs + 0.5)::BIGINT AS h FROM q JOIN e USING (tileset))"
    " SELECT tileset, printf('<VRTDataset rasterXSize=\"%d\" rasterYSize=\"%d\">', floor((any_value(x1) - any_value(x)) / any_value(s) + 0.5)::BIGINT, floor((any_value(y) - any_value(y0)) / any_value(s) + 0.5)::BIGINT) || chr(10) || '  <SRS>EPSG:3857</SRS>' || chr(10)"
    " || printf('  <GeoTransform>%.6f, %.6f, 0.0, %.6f, 0.0, %.6f</GeoTransform>', any_value(x), any_value(s), any_value(y), -any_value(s)) || chr(10) || "
    + " || ".join(_vrt_sql(i + 1, c) for i, c in enumerate(pyramid.COLOURS[4]))
    + " || '</VRTDataset>' AS vrt FROM f GROUP BY tileset"
)
def mosaic_vrt(t):
    return pyramid.mosaic_vrt(_rasters(t), ["tileset"])


@query(
    with_("ds", "mb")
    + f", {_RASTERS} SELECT tileset, z::INT AS z, count(*)::BIGINT AS rasters, round(min(min_x), 3) AS min_x, floor((max(max_x) - min(min_x)) / min(rs) + 0.5)::BIGINT AS width FROM (SELECT *, unnest(range(0, least(max_lod, 8) + 1)) AS z FROM q) GROUP BY tileset, z"
)
def zoom_mosaics(t):
    own = pyramid.zoom_mosaics(_rasters(t), 8)
    counts = own.groupBy("tileset", "z").agg(F.count("*").alias("rasters"))
    return pyramid.mosaic_extent(own, ["tileset", "z"]).join(counts, ["tileset", "z"]).select("tileset", "z", "rasters", r("min_x", 3).alias("min_x"), "width")


def _drawn(t) -> DataFrame:
    rows = t.lineitem.select(
        (F.col("l_suppkey") % 4).cast("int").alias("x"), (F.col("l_orderkey") % 256).cast("int").alias("px"), (F.col("l_partkey") % 256).cast("int").alias("py"), F.floor("l_quantity").cast("int").alias("r"), "l_orderkey", "l_linenumber"
    )
    rows = rows.withColumns({"g": F.col("r") * 3 % 256, "b": F.lit(255) - F.col("r"), "a": F.lit(255), "lod": F.lit(5)})
    return composite.painter(rows, ["x", "px", "py"], ["r", "g", "b"], order=["l_orderkey", "l_linenumber", "r"])


@query(
    "WITH d AS (SELECT (l_suppkey % 4)::INT AS x, (l_orderkey % 256)::INT AS px, (l_partkey % 256)::INT AS py, arg_max(floor(l_quantity)::INT, l_orderkey * 100000 + l_linenumber * 1000 + floor(l_quantity)::INT) AS r FROM lineitem GROUP BY ALL),"
    " every AS (SELECT x, px::INT AS px, py::INT AS py FROM (SELECT DISTINCT x FROM d), range(0, 256) a(px), range(0, 256) b(py))"
    " SELECT x, sha256(unhex(string_agg(CASE WHEN r IS NULL THEN '00000000' ELSE printf('%02x%02x%02xff', r, r * 3 % 256, 255 - r) END, '' ORDER BY py, px))) AS pixels_sha256 FROM every LEFT JOIN d USING (x, px, py) GROUP BY x"
)
def encode_png(t):
    """Pixels as they come back from the encoded tiles."""
    tiles = encode.encode_tiles(composite.rgba(_drawn(t), ["x"]))
    return tiles.select("x", F.sha2(F.udf(encode.png_pixels, "binary", useArrow=True)("image"), 256).alias("pixels_sha256"))


@query()
def encode_jpeg(t):
    tiles = composite.rgba(_drawn(t), ["x"])
    return encode.encode_tiles(tiles, "jpeg").select("x", F.length("image").alias("bytes"), F.hex(F.substring("image", 1, 2)).alias("start"))


_WARP = "(SELECT ds, x::INT AS x, y::INT AS y, -1000000.0 + (x + 0.5) * 200000.0 AS gx, 2200000.0 - (y + 0.5) * 200000.0 AS gy FROM (SELECT DISTINCT ds FROM rs), range(0, 16) a(x), range(0, 11) b(y))"


@query(
    with_("rs")
    + f" SELECT g.ds, x, y, v FROM (SELECT ds, x, y, (gx * 180.0 / {O_} + 9.0) / 1.2::DOUBLE AS sx, (degrees(atan(sinh(gy * pi() / {O_}))) - 19.0) / -1.2::DOUBLE AS sy FROM {_WARP}) g JOIN rs ON rs.ds = g.ds AND px = floor(sx)::INT AND py = floor(sy)::INT"
)
def warp_mercator(t):
    area = v.raster(t).select("ds").distinct().select("ds", F.lit(-1000000.0).alias("min_x"), F.lit(0.0).alias("min_y"), F.lit(2200000.0).alias("max_x"), F.lit(2200000.0).alias("max_y"))
    gt = [F.lit(x) for x in (-9.0, 1.2, 0.0, 19.0, 0.0, -1.2)]
    grid = warp.target_grid(area, ["ds"], F.lit(200000.0), 4326, 3857, gt)
    return warp.warp(v.raster(t), grid, ["ds"], "v", "nearest")


@query(
    with_("rs")
    + f""", g AS (SELECT ds, v, (-9.0 + (px + 0.5) * 1.2::DOUBLE) * {O_} / 180.0 AS gx, asinh(tan(radians(19.0 - (py + 0.5) * 1.2::DOUBLE))) * 6378137.0 AS gy FROM rs)
 SELECT ds, floor((gx + 1000000.0) / 500000.0)::INT AS x, floor((2200000.0 - gy) / 500000.0)::INT AS y, round(avg(v), 6) AS v FROM g WHERE gx >= -1000000 AND gx < 2200000 AND gy > 0 AND gy <= 2200000 GROUP BY ALL"""
)
def warp_average(t):
    area = v.raster(t).select("ds").distinct().select("ds", F.lit(-1000000.0).alias("min_x"), F.lit(0.0).alias("min_y"), F.lit(2200000.0).alias("max_x"), F.lit(2200000.0).alias("max_y"))
    gt = [F.lit(x) for x in (-9.0, 1.2, 0.0, 19.0, 0.0, -1.2)]
    return warp.gather(v.raster(t), area, ["ds"], "v", F.lit(500000.0), 4326, 3857, gt).withColumn("v", F.round("v", 6))


_E = math.sqrt(warp.Lambert(0, 0, 0, 0).f * (2 - warp.Lambert(0, 0, 0, 0).f))
_T = lambda lat: f"(tan(pi() / 4 - radians({lat}) / 2) / pow((1 - {_E} * sin(radians({lat}))) / (1 + {_E} * sin(radians({lat}))), {_E} / 2))"
_M = lambda lat: f"(cos(radians({lat})) / sqrt(1 - pow({_E} * sin(radians({lat})), 2)))"


@query(
    with_("pt")
    + f", k AS (SELECT (ln({_M('33.0')}) - ln({_M('45.0')})) / (ln({_T('33.0')}) - ln({_T('45.0')})) AS n), f AS (SELECT n, {_M('33.0')} / (n * pow({_T('33.0')}, n)) AS f FROM k),"
    f" p AS (SELECT event_id, n * radians(lon + 96.0) AS th, 6378137.0 * f * pow({_T('lat')}, n) AS rho, 6378137.0 * f * pow({_T('38.0')}, n) AS rho0 FROM pt, f WHERE lat > 0 AND lon < 0)"
    " SELECT event_id, round(rho * sin(th), 3) AS lx, round(rho0 - rho * cos(th), 3) AS ly, true AS same_lon, true AS same_lat FROM p"
)
def lambert_round_trip(t):
    p = warp.Lambert(lat0=38.0, lon0=-96.0, lat1=33.0, lat2=45.0)
    x, y = warp.lambert_forward(p, F.col("lon"), F.col("lat"))
    xy = v.points(t).filter("lat > 0 AND lon < 0").withColumns({"lx": x, "ly": y})
    lon, lat = warp.lambert_inverse(p, "lx", "ly")
    return xy.select("event_id", r("lx", 3).alias("lx"), r("ly", 3).alias("ly"), (F.abs(lon - F.col("lon")) < 1e-7).alias("same_lon"), (F.abs(lat - F.col("lat")) < 1e-7).alias("same_lat"))


@query(
    "SELECT s_suppkey AS id, round(w * 180.0 / %s, 9) AS lon_min, round(degrees(atan(sinh((n - 40.0 * res) * pi() / %s))), 9) AS lat_min, round((w + 60.0 * res) * 180.0 / %s, 9) AS lon_max, round(degrees(atan(sinh(n * pi() / %s))), 9) AS lat_max"
    " FROM (SELECT s_suppkey, (s_suppkey * 37 %% 300 - 150)::DOUBLE * 100000 AS w, (s_suppkey * 17 %% 100 - 50)::DOUBLE * 100000 AS n, 1000.0::DOUBLE + s_suppkey %% 5 AS res FROM supplier)" % (O_, O_, O_, O_)
)
def raster_degrees(t):
    k = F.col("s_suppkey")
    res_ = F.lit(1000.0) + k % 5
    gt = [(k * 37 % 300 - 150).cast("double") * 100000, res_, F.lit(0.0), (k * 17 % 100 - 50).cast("double") * 100000, F.lit(0.0), -res_]
    box = affine.degree_bounds(gt, F.lit(60), F.lit(40))
    return t.supplier.select(k.alias("id"), *[F.round(c, 9).alias(n) for n, c in box.items()])


@query(with_("gcp") + " SELECT ds, px - 5 AS px, py - 7 AS py, round(lon, 9) AS lon FROM gcp")
def gcp_offset(t):
    return raster.shifted_gcps(v.gcps(t), 5, 7).select("ds", "px", "py", r("lon", 9).alias("lon"))


@query(with_("ds", "mb") + f", {_RASTERS} SELECT tileset, name FROM q WHERE ordinal % 3 <> 0")
def mosaic_present(t):
    files = v.membership(t).filter("ordinal % 3 <> 0").select("tileset", F.col("dataset").alias("name"))
    return pyramid.present(_rasters(t), files).select("tileset", "name")


#: Rasters of the build: seven of 16 by 16 pixels, side by side in Web Mercator metres.
_PLACE = (1_000_000.0, 1_500_000.0, 160.0)


def _build_grids(t) -> DataFrame:
    rows = []
    for ds in range(7):
        x0, y0, size = _PLACE[0] + 1900.0 * ds, _PLACE[1] - 700.0 * ds, _PLACE[2]
        gt, lod = [x0, size, 0.0, y0, 0.0, -size], 9 + ds % 2
        grid = blocks.target_grid((0, 0, 16, 16), gt, 3857, 2 * m.ORIGIN / m.TILE / 2.0**lod, (None,) * 4)
        rows.append((str(ds), gt, "3857", *grid, lod))
    return t.spark.createDataFrame(rows, "dataset string, gt array<double>, system string, min_x double, max_y double, res double, width int, height int, max_lod int")


_BUILD = f"""g0 AS (SELECT d AS ds, {_PLACE[0]}::DOUBLE + 1900.0 * d AS x0, {_PLACE[1]}::DOUBLE - 700.0 * d AS y0, 9 + d % 2 AS lod FROM range(0, 7) r(d)),
g1 AS (SELECT *, {res('lod')} / cos(atan(sinh((y0 - 8 * {_PLACE[2]}) * pi() / {O_}))) AS rs FROM g0),
g AS (SELECT *, floor(16 * {_PLACE[2]} / rs + 0.5)::INT AS n FROM g1),
mid AS (SELECT ds, i, j, x0, y0, rs, lod, floor((i + 0.5) * rs / {_PLACE[2]})::INT AS px, floor((j + 0.5) * rs / {_PLACE[2]})::INT AS py FROM (SELECT *, unnest(range(0, n))::INT AS i FROM g) a, range(0, 20) b(j) WHERE j < n),
val AS (SELECT mid.*, v FROM mid JOIN rs ON rs.ds = mid.ds AND rs.px = mid.px AND rs.py = mid.py),
zs AS (SELECT g.*, z, {res('z')} AS rz FROM g, (VALUES (9), (10)) t(z) WHERE z <= lod),
cand AS (SELECT ds, z, rz, rs, x0, y0, lod, n, (floor((x0 + {O_}) / rz) + a)::BIGINT AS gx, (floor(({O_} - y0) / rz) + b)::BIGINT AS gy FROM zs, range(-1, 20) p(a), range(-1, 20) q(b)),
hit AS (SELECT ds, z, gx, gy, lod, floor(((gx + 0.5) * rz - {O_} - x0) / rs)::INT AS i, floor((y0 - ({O_} - (gy + 0.5) * rz)) / rs)::INT AS j FROM cand)"""


@query(
    with_("rs")
    + f", {_BUILD} SELECT z::INT AS z, (gx // 256)::INT AS x, (gy // 256)::INT AS y, (gx % 256)::INT AS px, (gy % 256)::INT AS py, arg_max(v::INT, hit.ds - 100 * hit.lod) AS r FROM hit JOIN val ON val.ds = hit.ds AND val.i = hit.i AND val.j = hit.j GROUP BY ALL"
)
def build_tiles(t):
    """Blocks, reprojection, tiles and the painter's rule with the nearest pixel."""
    value = F.col("v").cast("int")
    pixels = v.raster(t).select(F.col("ds").cast("string").alias("dataset"), "px", "py", value.alias("r"), value.alias("g"), value.alias("b"), F.lit(255).alias("a"))
    grids = _build_grids(t)
    base = blocks.warped(blocks.from_pixels(pixels), grids, "nearest")
    members = grids.select(F.lit("T").alias("tileset"), F.lit("t").alias("tile_path"), "dataset", F.col("dataset").cast("int").alias("ordinal"), "max_lod")
    zooms = t.spark.createDataFrame([("T", 9, 10)], "tileset string, zoom_min int, zoom_max int")
    areas = grids.select("dataset", "min_x", "max_y", "res", "width", "height")
    return blocks.to_pixels(build.tiles(base, areas, members, zooms, 0, method="nearest"), ["z", "x", "y"]).select("z", "x", "y", "px", "py", "r")


# --- lists


@query(r"""SELECT page_id, (i - 1)::INT AS ordinal, h[i] AS href, x[i] AS text FROM (SELECT page_id, h, x, unnest(range(1, len(h) + 1)) AS i FROM
 (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS x FROM pages))""")
def html_links(t):
    return t.pages.select("page_id", F.explode(ingest.anchors("html")).alias("a")).select("page_id", "a.ordinal", "a.href", "a.text")


@query(
    "SELECT page_id, 'vfr' AS section, 0::INT AS ordinal, '/f' || page_id || '.zip' AS href FROM pages"
    " UNION ALL SELECT page_id, 'vfr', 1::INT, '/second.zip' FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT page_id, 'ifr', 0::INT, '/ifr' || page_id || '.zip' FROM pages WHERE page_id % 3 = 0"
)
def table_links(t):
    k = F.col("page_id").cast("string")
    row = lambda href, label: F.concat(F.lit('<tr><td><a href="/first.zip">Geo-TIFF</a></td><td><a href="/other">PDF</a><a href="'), href, F.lit('">'), label, F.lit("</a></td></tr>"))
    second = F.when(F.col("page_id") % 2 == 0, F.lit("<b>GEO-</b>TIFF")).otherwise(F.lit("Geo-TIFF chart"))
    vfr = F.concat(F.lit('<div id="vfr"><table>'), row(F.concat(F.lit("/f"), k, F.lit(".zip")), F.lit(" geo-tiff ")), row(F.lit("/second.zip"), second), F.lit("</table></div>"))
    name = F.when(F.col("page_id") % 3 == 0, "ifr").otherwise("more")
    ifr = F.concat(F.lit('<div id="'), name, F.lit('"><table>'), row(F.concat(F.lit("/ifr"), k, F.lit(".zip")), F.lit("Geo-TIFF")), F.lit("</table></div>"))
    return ingest.table_links(t.pages.select("page_id", F.concat(vfr, ifr, "html").alias("html")), ["vfr", "ifr"])


@query(r"""SELECT page_id, trim(lower(url)) = 'http://ththre.example.com/fr/825?page=2&ref=x' AS same FROM pages""")
def text_match(t):
    return t.pages.select("page_id", text.text_matches("url", "HTTP://THTHRE.example.com/fr/825?page=2&ref=x").alias("same"))


_SPLIT = r"nullif(regexp_extract(url, '^(.*?/[0-9]{2}-[0-9]{2}-[0-9]{4})(/.*)$', %d), '')"


@query(with_("ur") + f" SELECT ordinal, {_SPLIT % 1} AS prefix, {_SPLIT % 2} AS suffix FROM ur")
def url_date_split(t):
    return ingest.dated(v.urls(t)).select("ordinal", "prefix", "suffix")


_VOTE = f"""vt AS (SELECT grp, prefix, count(*)::BIGINT AS votes FROM (SELECT grp, ordinal, {_SPLIT % 1} AS prefix FROM ur) WHERE prefix IS NOT NULL GROUP BY grp, prefix
 QUALIFY row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, min(ordinal)) = 1)"""


@query(with_("ur") + f", {_VOTE} SELECT grp, prefix, votes FROM vt")
def url_vote(t):
    return ingest.vote(v.urls(t))


@query(
    with_("ur")
    + f", {_VOTE}, s AS (SELECT *, {_SPLIT % 2} AS suffix FROM ur) SELECT s.grp, ordinal, url, CASE WHEN suffix IS NULL THEN url ELSE prefix || suffix END AS repaired, suffix IS NOT NULL AS valid FROM s LEFT JOIN vt USING (grp)"
)
def url_repair(t):
    return ingest.repair(v.urls(t))


@query(with_("ur") + " SELECT ordinal, string_split(url, '/')[-1] AS file FROM ur")
def url_basename(t):
    return v.urls(t).select("ordinal", text.url_basename("url").alias("file"))


@query(with_("ft") + " SELECT file_id, strftime(remote_mtime, '%a, %d %b %Y %H:%M:%S GMT') AS http_date FROM ft")
def http_date(t):
    return v.fetches(t).select("file_id", text.http_date("remote_mtime").alias("http_date"))


@query(with_("ft") + " SELECT file_id, CASE WHEN local_mtime IS NULL OR remote_mtime > local_mtime THEN 'get' ELSE 'skip' END AS action FROM ft")
def conditional_fetch(t):
    return ingest.fetch_plan(v.fetches(t)).select("file_id", "action")


@query("SELECT user_id, count(*) FILTER (WHERE event_type <> 'error')::BIGINT AS completed, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS failed FROM events GROUP BY user_id")
def status_counts(t):
    jobs = t.events.select("user_id", F.when(F.col("event_type") == "error", 1).otherwise(0).alias("status"))
    return ingest.status_counts(jobs, ["user_id"])


@query("SELECT event_id, (props->>'$.k')::INT AS k FROM events")
def json_props(t):
    return t.events.select("event_id", jsons.get("props", "$.k", "int").alias("k"))


@query(
    "SELECT event_id, (props->>'$.k')::INT + 1 AS replaced, '[1,' || to_json(event_type) || ',' || event_id || ']' AS made, 2::INT AS depth, true AS near, (props->>'$.k')::INT AS first FROM events"
)
def json_edit(t):
    k = jsons.get("props", "$.k", "int")
    replaced = jsons.replaced_key("props", "K", (k + 1).cast("string"), any_case=True)
    made = jsons.create("array", [jsons.create("number", F.lit(1)), jsons.create("string", "event_type"), jsons.create("raw", "event_id")])
    deep = jsons.create("object", {"a": made})
    near = jsons.near_equal(jsons.create("number", k + F.lit(0.1) + F.lit(0.2)), jsons.create("number", k + F.lit(0.3)))
    item = jsons.replaced_item(made, 0, jsons.create("number", k))
    return t.events.select(
        "event_id", jsons.get(replaced, "$.k", "int").alias("replaced"), made.alias("made"), jsons.depth(deep).cast("int").alias("depth"), near.alias("near"), jsons.get(item, "$[0]", "int").alias("first")
    )


@query("SELECT event_id, json_type(props) = 'OBJECT' AS is_object, len(json_keys(props))::INT AS keys, json_exists(props, '$.k') AS has_k FROM events")
def json_shape(t):
    return t.events.select("event_id", (jsons.kind("props") == "object").alias("is_object"), jsons.size("props").cast("int").alias("keys"), jsons.has("props", "$.k").alias("has_k"))


@query("SELECT count(*) FILTER (WHERE o_orderkey % 4 <> 0)::BIGINT AS completed, count(*) FILTER (WHERE o_orderkey % 4 = 0)::BIGINT AS failed FROM orders")
def job_results(t):
    def work(row):
        if row["job_index"] % 8 == 0:
            raise ValueError("no such raster")
        return row["job_index"] % 4 == 0

    return ingest.status_counts(jobs.run_jobs(t.orders.select(F.col("o_orderkey").alias("job_index")), work))
