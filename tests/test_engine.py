"""Goldens, properties and brute-force versions of the tiling engine's operators."""

import io
import json
import math
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.functions import affine, jsons, text
from chartloom.functions import mercator as m
from chartloom.operators import blocks, composite, encode, ingest, manifest, pyramid, raster, warp
from chartloom.operators import tilesets as ts
from chartloom.operators.warp import Lambert
from chartloom.plans import pipeline
from chartloom.sources import config, rasters, web
from chartloom.streaming import upsert


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- tile arithmetic


def test_zoom_0_is_one_tile_and_bounds_tile_the_square(spark):
    df = spark.range(1).select(*[c.alias(k) for k, c in m.tile_bounds(F.lit(0), F.lit(0), F.lit(0)).items()])
    assert rows(df)[0] == pytest.approx((-m.ORIGIN, -m.ORIGIN, m.ORIGIN, m.ORIGIN))
    z2 = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    b = z2.select("x", "y", *[c.alias(k) for k, c in m.tile_bounds(F.lit(2), "x", "y").items()]).toPandas()
    area = ((b.max_x - b.min_x) * (b.max_y - b.min_y)).sum()
    assert area == pytest.approx((2 * m.ORIGIN) ** 2)


def test_tile_of_a_tiles_centre_is_that_tile(spark):
    random.seed(1)
    cases = [(z, random.randrange(1 << z), random.randrange(1 << z)) for z in range(1, 19) for _ in range(5)]
    df = spark.createDataFrame(cases, "z int, x int, y int")
    b = m.tile_bounds("z", "x", "y")
    df = df.withColumns({"lon": m.lon_of((b["min_x"] + b["max_x"]) / 2), "lat": m.lat_of((b["min_y"] + b["max_y"]) / 2)})
    assert df.filter((m.tile_x("lon", "z") != F.col("x")) | (m.tile_y("lat", "z") != F.col("y"))).count() == 0


def test_known_tiles(spark):
    def plain(lon, lat, z):
        n = 2**z
        y = (1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n
        return max(0, min(n - 1, int((lon + 180) / 360 * n))), max(0, min(n - 1, int(y)))

    cases = [(13.4, 52.5, 10), (-122.4, 37.8, 12), (180.0, 85.0, 4), (-180.0, -85.0, 4), (0.0, 0.0, 18)]
    df = spark.createDataFrame(cases, "lon double, lat double, z int").select("lon", "lat", "z", m.tile_x("lon", "z"), m.tile_y("lat", "z"))
    for lon, lat, z, x, y in rows(df):
        assert (x, y) == plain(lon, lat, z)


def test_pack_zoom_above_16_and_ground_resolution_at_the_pole(spark):
    df = spark.createDataFrame([(100_000, 65_000)], "x long, y long").withColumn("k", m.pack_tile("x", "y"))
    x, y = m.unpack_tile("k")
    assert rows(df.select(x, y)) == [(100_000, 65_000)]
    assert rows(spark.range(1).select(m.ground_resolution(F.lit(3), F.lit(90.0)))) == [(None,)]


def test_zoom_for_pixel_size(spark):
    sizes = [1e9, 156543.04, 100000.0, 1.0, 1e-9]
    res = [2 * m.ORIGIN / 256 / 2**i for i in range(32)]
    want = [next((max(0, i - 1) for i in range(32) if s > res[i]), 31) for s in sizes]
    got = spark.createDataFrame([(s,) for s in sizes], "s double").select(m.zoom_for_pixel_size("s"))
    assert [r[0] for r in rows(got)] == want


# --- covers and manifests

BOX = "id long, lon_min double, lat_min double, lon_max double, lat_max double, max_lod int"


def test_longitudes_beyond_180_end_and_latitudes_are_clamped(spark):
    df = spark.createDataFrame([(1, 181.0, 0.0, 185.0, 1.0, 3), (2, -185.0, -90.0, -181.0, 90.0, 3)], BOX)
    tiles = manifest.cover(df.withColumn("z", F.lit(3))).select("id", "x", "y")
    assert {r[1] for r in rows(tiles.filter("id = 1"))} == {7}
    assert {r[2] for r in rows(tiles.filter("id = 2"))} == set(range(8))


def test_antimeridian_is_two_boxes(spark):
    df = spark.createDataFrame([(1, 176.0, -1.0, -176.0, 1.0, 4)], BOX).withColumn("z", F.lit(4))
    assert {r[1] for r in rows(manifest.cover(manifest.split_antimeridian(df)).select("id", "x"))} == {0, 15}


def test_parents_and_overlaps_are_in_the_manifest(spark):
    random.seed(3)
    boxes = []
    for i in range(40):
        lon, lat = random.uniform(-179, 170), random.uniform(-80, 75)
        boxes.append((i, lon, lat, lon + random.uniform(0.1, 9), lat + random.uniform(0.1, 9), random.randrange(2, 8)))
    df = spark.createDataFrame(boxes, BOX)
    tiles = manifest.manifest(df, F.lit(7)).cache()
    parents = tiles.filter("z > 0").select((F.col("z") - 1).alias("z"), F.floor(F.col("x") / 2).cast("int").alias("x"), F.floor(F.col("y") / 2).cast("int").alias("y"))
    assert parents.distinct().join(tiles, ["z", "x", "y"], "left_anti").count() == 0
    assert manifest.tile_pairs(df, F.lit(7)).select("z", "x", "y").distinct().join(tiles, ["z", "x", "y"], "left_anti").count() == 0
    assert manifest.missing(tiles, tiles).count() == 0
    total = {r[0]: r[1] for r in rows(manifest.summary(tiles))}
    assert total[None] == tiles.count() == sum(n for z, n in total.items() if z is not None)


def test_pairs_join_by_equality(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 5.0, 5)], BOX)
    plan = manifest.tile_pairs(df, F.lit(5))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- configuration

CONFIG = {
    "datasets": {
        "a": {"zip_file": "z.zip", "mask": [[[0, 0], [4, 0], [4, 4]], [[1, 1], [2, 1], [2, 2]]], "geobound": [None, 0.0, 10, None], "gcps": [[0, 0, 1, 2]], "max_lod": 9, "odd": 1},
        "b": {"zip_file": "z.zip", "input_file": "x.tif", "mask": [], "gcps": []},
    },
    "tilesets": {"T": {"tile_path": "t", "datasets": ["a", "nowhere", "b"], "zoom": [10, 12]}, "U": {"tile_path": "u", "datasets": ["b"]}, "E": {"tile_path": "e", "datasets": []}},
}


def test_config(spark):
    d, t = config.parse(spark.createDataFrame([(json.dumps(CONFIG),)], "value string"))
    a, b = d.orderBy("name").collect()
    assert (a.input_file, b.input_file, a.max_lod, b.max_lod, a.tmp_file) == ("a.tif", "x.tif", 9, 12, "_a.tif")
    assert (a.lon_min, a.lat_min, a.lon_max, a.lat_max) == (None, 0.0, 10.0, None)
    assert len(a.mask) == 2 and a.mask[0][1].x == 4.0 and b.mask is None and b.gcps is None and a.gcps[0].lat == 2.0
    member = config.membership(t)
    assert rows(ts.unknown_members(member, d).select("dataset")) == [("nowhere",)]
    known = ts.members(member, d)
    assert rows(ts.zoom_range(t, known), "tileset") == [("E", 0, 12), ("T", 0, 12), ("U", 0, 12)]
    assert [(r.dataset, r.layer) for r in ts.layer_order(known).filter("tileset = 'T'").orderBy("layer").collect()] == [("b", 1), ("a", 2)]
    assert rows(ts.select(t, ["u"]).select("name")) == [("U",)]
    with pytest.raises(Exception, match="datasets and tilesets"):
        config.parse(spark.createDataFrame([('{"datasets": {}}',)], "value string"))[0].collect()
    with pytest.raises(Exception):
        config.parse(spark.createDataFrame([("{",)], "value string"))[0].collect()


# --- rasters


def ray(x, y, rings):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                inside = not inside
    return inside


def test_mask_alpha_with_a_hole(spark):
    rings = [[(0, 0), (12, 1), (10, 11), (5, 4), (1, 12)], [(3, 1), (8, 2), (7, 3.5)]]
    places = spark.createDataFrame([(x, y) for x in range(-1, 14) for y in range(-1, 14)], "px int, py int")
    edges = spark.createDataFrame([tuple(map(float, (*a, *b))) for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)], "x1 double, y1 double, x2 double, y2 double")
    for x, y, a in rows(raster.mask_alpha(places, edges).select("px", "py", "a")):
        assert (a == 255) == ray(x + 0.5, y + 0.5, rings), (x, y)


def test_mask_bbox_truncates_and_clamps(spark):
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((-3.7, 2.9), (8.9, 2.2), (5.5, 99.0))])
    got = spark.range(1).select(*[c.alias(k) for k, c in raster.ring_bbox(ring, F.lit(20), F.lit(30)).items()])
    assert rows(got) == [(0, 2, 8, 28)]


def test_affine_fit_recovers_an_exact_affine_and_windows(spark):
    random.seed(5)
    pts = [(0, float(x), float(y), 10 + 0.5 * x - 0.25 * y, -3 + 0.1 * x + 0.75 * y) for x, y in ((random.randrange(99), random.randrange(99)) for _ in range(12))]
    pts += [(1, float(i), float(i), 1.0, 1.0) for i in range(4)]
    fit = raster.gcp_affine(spark.createDataFrame(pts, "ds int, px double, py double, lon double, lat double"))
    a, b = rows(fit, "ds")
    assert a[1:] == pytest.approx((10, 0.5, -0.25, -3, 0.1, 0.75))
    assert b[1:] == (None,) * 6
    gt = [F.lit(float(v)) for v in (100, 2, 0.5, 200, -0.25, -2)]
    box = spark.range(1).select(*[c.alias(k) for k, c in affine.rotated_bounds(gt, F.lit(3), F.lit(4), F.lit(10), F.lit(20)).items()])
    corners = [(100 + 2 * x + 0.5 * y, 200 - 0.25 * x - 2 * y) for x in (3, 13) for y in (4, 24)]
    xs, ys = zip(*corners, strict=True)
    assert rows(box)[0] == pytest.approx((min(xs), min(ys), max(xs), max(ys)))


def test_null_bound_is_none_and_zero_is_one(spark):
    df = spark.createDataFrame([(-5.0, -5.0, 5.0, 5.0, None, 0.0, 0.0, None)], "a double, b double, c double, d double, e double, f double, g double, h double")
    names = ("lon_min", "lat_min", "lon_max", "lat_max")
    out = raster.clip_bounds(dict(zip(names, "abcd", strict=True)), dict(zip(names, "efgh", strict=True)))
    assert rows(df.select(*[c.alias(k) for k, c in out.items()])) == [(-5.0, 0.0, 0.0, 5.0)]


def test_painter_against_loops_and_order(spark):
    random.seed(7)
    px = [(random.randrange(4), random.randrange(4), random.randrange(256), random.choice((0, 255)), random.randrange(4, 7), i) for i in range(300)]
    best = {}
    for x, y, v, a, lod, i in sorted(px, key=lambda p: (-p[4], p[5])):
        if a:
            best[x, y] = v
    schema = "px int, py int, v int, a int, lod int, ordinal int"
    for order in (px, px[::-1]):
        top = composite.painter(spark.createDataFrame(order, schema), ["px", "py"], ["v"], order=["ordinal"])
        assert {(x, y): v for x, y, v, _ in rows(top)} == best


def test_overviews_against_numpy(spark):
    rng = np.random.default_rng(1)
    grid = rng.integers(0, 255, (64, 64))
    df = spark.createDataFrame([(0, x, y, int(grid[y, x])) for y in range(64) for x in range(64)], "ds int, px int, py int, v int")
    for ds, f, x, y, v in rows(pyramid.overviews(df, ["ds"], ["v"])):
        assert v == pytest.approx(grid[y * f : y * f + f, x * f : x * f + f].mean())


def test_kernels_keep_a_plane_and_reject_unknown_names(spark):
    df = spark.createDataFrame([(0, x, y, 2.0 * x + 3.0 * y) for x in range(12) for y in range(12)], "ds int, px int, py int, v double")
    grid = spark.createDataFrame([(0, i, 0, 4.2 + 0.3 * i, 5.7) for i in range(8)], "ds int, x int, y int, sx double, sy double")
    for method in ("bilinear", "cubic", "cubicspline"):
        for _, x, _, v in rows(pyramid.resample_kernel(grid, df, ["ds"], "v", method)):
            assert v == pytest.approx(2 * (4.2 + 0.3 * x - 0.5) + 3 * 5.2, abs=1e-6)
    with pytest.raises(ValueError):
        pyramid.resample_kernel(grid, df, ["ds"], "v", "nearest-ish")


def test_mode_takes_the_least_of_several(spark):
    df = spark.createDataFrame([(0, 0, 0, 5.0), (0, 0, 1, 3.0), (0, 1, 0, 3.0), (0, 1, 1, 5.0)], "ds int, px int, py int, v double")
    assert rows(pyramid.resample_mode(df, ["ds"], "v", 2)) == [(0, 0, 0, 3.0)]


def test_lambert_round_trip_and_origin(spark):
    p = warp.Lambert(38, -96, 33, 45)
    df = spark.createDataFrame([(-96.0, 38.0), (-120.5, 47.25), (-70.0, 25.0)], "lon double, lat double")
    x, y = warp.lambert_forward(p, "lon", "lat")
    df = df.withColumns({"x": x, "y": y})
    lon, lat = warp.lambert_inverse(p, "x", "y")
    got = rows(df.select("lon", "lat", lon, lat, "x", "y"))
    for a, b, c, d, *_ in got:
        assert (c, d) == pytest.approx((a, b), abs=1e-8)
    assert got[0][4:] == pytest.approx((0, 0), abs=1e-6)
    with pytest.raises(ValueError):
        warp.to_lon_lat(1234, F.lit(0), F.lit(0))


# --- codecs and archives


def test_png_opens_in_spark(spark, tmp_path):
    rgba = np.random.default_rng(2).integers(0, 256, (256, 256, 4), "u1")
    rgba[..., 3] = 255
    (tmp_path / "t.png").write_bytes(encode.png(rgba.tobytes()))
    image = spark.read.format("image").load(str(tmp_path)).select("image.*").first()
    got = np.frombuffer(image.data, "u1").reshape(256, 256, -1)
    assert (got[..., 2::-1][..., :3] == rgba[..., :3]).all()
    with pytest.raises(NotImplementedError):
        encode.encoder("webp")
    with pytest.raises(ValueError):
        encode.encoder("bmp")


def lzw_pack(data: bytes) -> bytes:
    bits, n, out = 0, 0, bytearray()

    def put(code, width):
        nonlocal bits, n
        bits, n = bits << width | code, n + width
        while n >= 8:
            n -= 8
            out.append(bits >> n & 255)
            bits &= (1 << n) - 1

    table, width = {bytes([i]): i for i in range(256)}, 9
    put(256, 9)
    w = b""
    for c in data:
        if w + bytes([c]) in table:
            w += bytes([c])
            continue
        put(table[w], width)
        table[w + bytes([c])] = len(table) + 2
        if len(table) + 2 >= 4094:
            put(256, width)
            table, width = {bytes([i]): i for i in range(256)}, 9
        else:
            width = max(9, (len(table) + 2).bit_length())
        w = bytes([c])
    if w:
        put(table[w], width)
    put(257, width)
    return bytes(out) + (bytes([bits << (8 - n) & 255]) if n else b"")


def test_lzw():
    rng = random.Random(4)
    for data in (b"a", b"abababababab" * 50, bytes(rng.randrange(4) for _ in range(3000)), bytes(rng.randrange(256) for _ in range(300))):
        assert rasters.lzw(lzw_pack(data)) == data


def test_geotiff_in_a_zip(spark, tmp_path):
    grid = np.random.default_rng(3).integers(0, 256, (3, 300, 270), "u1")
    tif = rasters.geotiff(grid, [1000.0, 2.0, 0.0, 5000.0, 0.0, -2.0])
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("x.tif", tif)
        z.writestr("._x.tif", b"junk")
        z.writestr("bad.tif", b"II*\0junk")
    members = rasters.archive_members(spark, str(tmp_path)).cache()
    meta = {r.member: r for r in rasters.raster_metadata(members).collect()}
    assert set(meta) == {"x.tif", "bad.tif"} and meta["bad.tif"].width is None
    x = meta["x.tif"]
    assert (x.width, x.height, x.band_count, x.gt, x.epsg) == (270, 300, 3, [1000.0, 2.0, 0.0, 5000.0, 0.0, -2.0], 3857)
    back = np.zeros_like(grid)
    for b in rasters.raster_blocks(members.filter("member = 'x.tif'")).collect():
        back[b.band, b.by * 256 : b.by * 256 + b.h, b.bx * 256 : b.bx * 256 + b.w] = np.frombuffer(b.data, "u1").reshape(b.h, b.w)
    assert (back == grid).all()


def test_build_draws_masks_and_skips(spark, tmp_path):
    (tmp_path / "zip").mkdir()
    res = 2 * m.ORIGIN / 256 / 4
    for name, value in (("a", 200), ("b", 90)):
        grid = np.full((3, 64, 64), value, "u1")
        with zipfile.ZipFile(tmp_path / "zip" / f"{name}.zip", "w") as z:
            z.writestr(f"{name}.tif", rasters.geotiff(grid, [0.0, res, 0.0, 64 * res, 0.0, -res]))
    conf = {
        "datasets": {"a": {"zip_file": "a", "max_lod": 2}, "b": {"zip_file": "b", "max_lod": 1, "mask": [[[0, 0], [32, 0], [32, 64], [0, 64]]]}},
        "tilesets": {"T": {"tile_path": "t", "datasets": ["a", "b"]}},
    }
    (tmp_path / "c.json").write_text(json.dumps(conf))
    o = pipeline.Options(str(tmp_path / "c.json"), str(tmp_path / "zip"), str(tmp_path / "stage"), str(tmp_path / "out"))
    assert pipeline.build(spark, o).count() == 3
    files = sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*.png"))
    assert files == ["t/0/0/0.png", "t/1/1/0.png", "t/2/2/1.png"]
    data = (tmp_path / "out/t/1/1/0.png").read_bytes()
    at = data.index(b"IDAT") - 4
    raw = zlib.decompress(data[at + 8 : at + 8 + struct.unpack(">I", data[at : at + 4])[0]])
    pixels = np.frombuffer(raw, "u1").reshape(256, 1025)[:, 1:].reshape(256, 256, 4)
    assert set(pixels[..., 0].ravel().tolist()) == {0, 200, 90}  # b is on top within its mask, a beside it
    assert pipeline.build(spark, o).count() == 0
    # the same tiles by the URI of a store
    far = pipeline.Options(o.config_path, o.zip_dir, o.staging_dir, f"file://{tmp_path}/far", reuse=True)
    assert sorted(r.path for r in pipeline.build(spark, far).collect()) == [f"file://{tmp_path}/far/{p}" for p in files]
    assert (tmp_path / "far/t/1/1/0.png").read_bytes() == data and pipeline.build(spark, far).count() == 0


# --- lists

PAGE = """<html><div id="other"><table><tr><td>1</td><td><a href="/no.zip">Geo-TIFF</a></td></tr></table></div>
<div id="vfr"><table><tr><th>h</th></tr><tr><td><a href="/first.zip">Geo-TIFF</a></td><td>x <a href="/a.zip"> GEO-tiff </a><br><a href="/pdf">PDF</a><a>Geo-TIFF</a></td></tr>
<tr><td>only</td></tr><tr><td>n</td><td><table><tr><td>i</td><td><a href="/in.zip">Geo-TIFF</a></td></tr></table></td><td><a href="/third.zip">Geo-TIFF</a></td></tr></table></div>
<div><table><tr><td>1</td><td><a href="/after.zip">Geo-TIFF</a></td></tr></table></div></html>"""


def zipped(folder, name, data):
    with zipfile.ZipFile(folder / f"{name}.zip", "w") as z:
        z.writestr(f"{name}.tif", data)


def test_build_keeps_failures_as_rows(spark, tmp_path):
    """Datasets that cannot be read or placed are rows with their error; the others are built."""
    res = 2 * m.ORIGIN / 256 / 4
    good = np.full((3, 40, 40), 50, "u1")
    zipped(tmp_path, "good", rasters.geotiff(good, [0.0, res, 0.0, 40 * res, 0.0, -res]))
    zipped(tmp_path, "other", rasters.geotiff(good, [0.0, 1.0, 0.0, 4.0, 0.0, -1.0], 2154))
    zipped(tmp_path, "placeless", rasters.geotiff(good, None, None))
    zipped(tmp_path, "junk", b"II*\0junk")
    zipped(tmp_path, "outside", rasters.geotiff(good, [0.0, res, 0.0, 40 * res, 0.0, -res]))
    names = ["good", "other", "placeless", "junk", "absent", "outside"]
    conf = {"datasets": {n: {"zip_file": n, "max_lod": 2} for n in names}, "tilesets": {"T": {"tile_path": "t/u", "datasets": names}}}
    conf["datasets"]["outside"]["geobound"] = [-100.0, -60.0, -90.0, -50.0]
    (tmp_path / "c.json").write_text(json.dumps(conf))
    o = pipeline.Options(str(tmp_path / "c.json"), str(tmp_path), str(tmp_path / "stage"), str(tmp_path / "out"))
    assert {r.path.split("/out/")[1] for r in pipeline.build(spark, o).collect()} == {"t/u/0/0/0.png", "t/u/1/1/0.png", "t/u/2/2/1.png"}
    bad = {r.dataset: r.error for r in pipeline.failures(spark.read.parquet(str(tmp_path / "stage/source"))).collect()}
    assert set(bad) == set(names[1:]) and "2154" in bad["other"] and "geotransform" in bad["placeless"] and "not there" in bad["absent"] and "bounds" in bad["outside"]


def test_gcps_and_lambert_place_rasters(spark, tmp_path):
    """The same ground three times: in Lambert, by control points without any reference, and by its window in a mask."""
    lambert = Lambert(38.5, -98.0, 33.0, 45.0, 0.0, 0.0)
    gt = [-300_000.0, 1500.0, 0.0, 250_000.0, 0.0, -1500.0]
    y, x = np.mgrid[0:300, 0:400]
    grid = np.stack([x % 256, y % 256, np.full_like(x, 77)]).astype("u1")
    zipped(tmp_path, "lcc", rasters.geotiff(grid, gt, lambert))
    zipped(tmp_path, "window", rasters.geotiff(grid, gt, lambert))
    # control points in lon/lat, fitted in Lambert metres; the file itself has the system but no geotransform
    zipped(tmp_path, "gcp", rasters.geotiff(grid, None, lambert))
    corners = [(px, py, *blocks.to_degrees(lambert, np.array([gt[0] + px * 1500.0]), np.array([gt[3] - py * 1500.0]))) for px in (0, 400) for py in (0, 150, 300)]
    gcps = [[px, py, float(lon[0]), float(lat[0])] for px, py, lon, lat in corners]
    ring = [[50, 40], [350, 40], [350, 260], [50, 260]]
    conf = {"datasets": {"lcc": {"zip_file": "lcc", "max_lod": 7}, "gcp": {"zip_file": "gcp", "max_lod": 7, "gcps": gcps}, "window": {"zip_file": "window", "max_lod": 7, "gcps": gcps, "mask": [ring]}}}
    conf["tilesets"] = {n: {"tile_path": n, "datasets": [n]} for n in conf["datasets"]}
    (tmp_path / "c.json").write_text(json.dumps(conf))
    o = pipeline.Options(str(tmp_path / "c.json"), str(tmp_path), str(tmp_path / "stage"), tile_resampling="nearest", reproject_resampling="nearest")
    assert pipeline.build(spark, o).count() == 0  # no failures, and no tiles without an output folder
    staged = spark.read.parquet(str(tmp_path / "stage/source"))
    found = {r.dataset: r for r in pipeline.grids(staged).collect()}
    assert found["lcc"].gt == pytest.approx(found["gcp"].gt, abs=1e-3) and found["lcc"].width == found["gcp"].width
    # resolution of zoom 7 at the latitude of the middle
    assert found["lcc"].res == pytest.approx(2 * m.ORIGIN / 256 / 2**7 / math.cos(math.radians(38.5 + (25 / 111))), rel=5e-3)
    base = spark.read.parquet(str(tmp_path / "stage/blocks")).filter("level = 0").toPandas()
    shown = {}
    for name, r in found.items():
        pixels, x0, y0 = blocks.joined(base[base.dataset == name])
        lon, lat = np.meshgrid(np.linspace(-100.0, -96.5, 9), np.linspace(37.6, 39.8, 9))
        mx, my = blocks.from_degrees(3857, lon, lat)
        px, py = ((mx - r.min_x) / r.res - x0).astype(int), ((r.max_y - my) / r.res - y0).astype(int)
        shown[name] = pixels[py, px]
        lx, ly = blocks.from_degrees(lambert, lon, lat)
        sx, sy = (lx - gt[0]) / 1500, (gt[3] - ly) / 1500
        assert np.abs(shown[name][..., 0].astype(int) - np.floor(sx) % 256).max() <= 1.01 * r.res / 1500 + 1
        assert np.abs(shown[name][..., 1].astype(int) - np.floor(sy) % 256).max() <= 1.01 * r.res / 1500 + 1
        assert (shown[name][..., 2] == 77).all()
    assert (shown["lcc"] == shown["gcp"]).all()
    drawn = pipeline.Options(o.config_path, o.zip_dir, o.staging_dir, str(tmp_path / "out"), reuse=True)
    assert pipeline.build(spark, drawn).count() > 3


def test_no_holes_above_the_resolution_of_the_source(spark, tmp_path):
    """Each kernel fills the whole box at twice the source's resolution, and the constant colour stays."""
    res = 2 * m.ORIGIN / 256 / 2**3
    zipped(tmp_path, "a", rasters.geotiff(np.full((1, 16, 16), 120, "u1"), [0.0, 2 * res, 0.0, 32 * res, 0.0, -2 * res]))
    conf = {"datasets": {"a": {"zip_file": "a", "max_lod": 3}}, "tilesets": {"T": {"tile_path": "t", "datasets": ["a"]}}}
    (tmp_path / "c.json").write_text(json.dumps(conf))
    for method in pyramid.METHODS:
        o = pipeline.Options(str(tmp_path / "c.json"), str(tmp_path), str(tmp_path / "stage"), reproject_resampling=method, tile_resampling=method)
        pipeline.build(spark, o)
        _, tilesets, members = pipeline.selected(spark, o)
        areas = pipeline.grids(spark.read.parquet(str(tmp_path / "stage/source"))).select("dataset", "min_x", "max_y", "res", "width", "height")
        drawn = pipeline.tiles(spark.read.schema(blocks.BLOCK).parquet(str(tmp_path / "stage/blocks")), areas, members, ts.zoom_range(tilesets, members), 3, method=method)
        tile = np.frombuffer(drawn.filter("z = 3").first().rgba, "u1").reshape(256, 256, 4)
        assert (tile[-30:, :30, :3] == 120).all() and (tile[-30:, :30, 3] == 255).all(), method
        assert not tile[:-34, :, 3].any() and not tile[:, 34:, 3].any()


def test_blocks_are_averaged_as_one_picture(spark):
    """Overviews of blocks against halving the whole picture."""
    grid = np.random.default_rng(6).integers(0, 256, (700, 1300, 4)).astype("u1")
    base = spark.createDataFrame(blocks.cut(grid, "d"), blocks.BLOCK)
    over = blocks.overview_levels(base).toPandas()
    whole = grid
    for level in (1, 2, 3):
        whole = blocks.halved(whole)
        got, x, y = blocks.joined(over[over.level == level])
        assert (x, y) == (0, 0) and (got[: whole.shape[0], : whole.shape[1]] == whole).all()


def test_rings_and_kernels_by_loops():
    rings = [[(1.2, 0.7), (9.4, 2.1), (7.7, 9.2), (2.1, 7.9)], [(4, 4), (6, 4), (6, 6), (4, 6)]]
    got = blocks.in_rings(rings, 0, 0, 11, 10)
    for y in range(10):
        for x in range(11):
            n = 0
            for ring in rings:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
                    n += (y1 <= y + 0.5) != (y2 <= y + 0.5) and x1 + (y + 0.5 - y1) * (x2 - x1) / (y2 - y1) > x + 0.5
            assert got[y, x] == n % 2
    pixels = np.random.default_rng(1).integers(0, 256, (12, 12, 4)).astype("u1")
    pixels[..., 3] = 255
    for method in ("bilinear", "cubic", "cubicspline", "lanczos"):
        sx, sy = np.array([5.3]), np.array([6.8])
        total, mean = 0.0, 0.0
        for y in range(12):
            for x in range(12):
                w = float(blocks._kernel(method, np.array(sx[0] - 0.5 - x)) * blocks._kernel(method, np.array(sy[0] - 0.5 - y)))
                total, mean = total + w, mean + w * pixels[y, x, 0]
        assert blocks.sample(pixels, sx, sy, method)[0, 0] == np.clip(np.floor(mean / total + 0.5), 0, 255)


def test_geotiff_with_overviews_and_lambert():
    grid = np.random.default_rng(3).integers(0, 256, (3, 301, 270), "u1")
    p = Lambert(38.5, -98.0, 33.0, 45.0, 10.0, -20.0)
    tif = rasters.geotiff(grid, [1.0, 2.0, 0.0, 5.0, 0.0, -2.0], p, (grid[:, ::2, ::2], grid[:, ::4, ::4]))
    assert rasters.system(tif) == p or np.allclose([getattr(rasters.system(tif), k) for k in ("lat0", "lon0", "lat1", "lat2", "x0", "y0", "a", "f")], [getattr(p, k) for k in ("lat0", "lon0", "lat1", "lat2", "x0", "y0", "a", "f")])
    assert (rasters.pixels(tif)[0] == grid).all()
    at, sizes = 4, []
    while at := struct.unpack("<I", tif[at : at + 4])[0]:
        n = struct.unpack("<H", tif[at : at + 2])[0]
        entries = {e[0]: e for e in struct.iter_unpack("<HHII", tif[at + 2 : at + 2 + 12 * n])}
        sizes.append((entries[256][3], entries[257][3], entries.get(254, (0, 0, 0, 0))[3]))
        at += 2 + 12 * n
    assert sizes == [(270, 301, 0), (135, 151, 1), (68, 76, 1)]


def test_links_of_second_cells():
    assert ingest.section_links(PAGE, "vfr") == ["/a.zip", "/in.zip"]
    assert ingest.section_links("", "vfr") == [] and ingest.section_links(None, "vfr") == []


def test_vote_ties_go_to_the_first_and_undated_urls_stay(spark):
    urls = [("g", 0, "h/02-02-2025/b.zip"), ("g", 1, "h/01-01-2025/a.zip"), ("g", 2, "h/none.zip"), ("g", 3, "h/03-03-2025")]
    df = spark.createDataFrame(urls, "grp string, ordinal int, url string")
    assert rows(ingest.vote(df)) == [("g", "h/02-02-2025", 1)]
    assert [(r.repaired, r.valid) for r in ingest.repair(df).orderBy("ordinal").collect()] == [
        ("h/02-02-2025/b.zip", True), ("h/02-02-2025/a.zip", True), ("h/none.zip", False), ("h/03-03-2025", False)]


def test_text(spark):
    df = spark.range(1).select(text.name_list(F.lit(" a, b ,,c")), text.tile_path(F.lit("t"), F.lit(1), F.lit(2), F.lit(3), "jpeg", "out"), text.http_date(F.lit("2025-03-20 01:02:03").cast("timestamp")))
    assert rows(df) == [(["a", "b", "c"], "out/t/1/2/3.jpg", "Thu, 20 Mar 2025 01:02:03 GMT")]
    with pytest.raises(ValueError):
        text.tile_path(F.lit("t"), F.lit(1), F.lit(2), F.lit(3), "gif")


def test_status_counts_with_nulls(spark):
    df = spark.createDataFrame([(0,), (1,), (None,), (0,)], "status int")
    assert rows(ingest.status_counts(df)) == [(2, 1)]


# --- streaming


def test_stream_appends_new_tiles_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    row = lambda i, lon: (i, f"d{i}", lon, 1.0, lon + 3.0, 4.0, 4)
    spark.createDataFrame([row(1, 0.0)], upsert.DATASET).write.parquet(src)
    upsert.upsert_tiles(upsert.read_datasets(spark, src), out, check, 4).awaitTermination()
    first = spark.read.parquet(out).count()
    spark.createDataFrame([row(2, 0.5), row(3, 90.0)], upsert.DATASET).write.mode("append").parquet(src)
    upsert.upsert_tiles(upsert.read_datasets(spark, src), out, check, 4).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.distinct().count() > first
    want = manifest.manifest(spark.read.schema(upsert.DATASET).parquet(src), F.lit(4))
    assert got.join(want, ["z", "x", "y"], "left_anti").count() == 0 and want.count() == got.count()


def test_a_png_written_here_is_well_formed():
    data = encode.png(bytes(4 * 4), 2, 2)
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and data[-8:-4] == b"IEND" and io.BytesIO(data).read(4) == b"\x89PNG"


# --- JSON and jobs


def test_json(spark):
    from chartloom.functions import jsons

    texts = ['{"b": [1, 2], "a": "x // y"}', "[1, null]", "null", "1.5", '"s"', "true", "{", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = rows(df.select(jsons.kind("t"), jsons.size("t"), jsons.has("t", "$.b"), jsons.get("t", "$.b[1]", "int")))
    assert [r[0] for r in got] == ["object", "array", "null", "number", "string", "boolean", None, None]
    assert [r[1] for r in got] == [2, 2, None, None, None, None, None, None]
    assert got[0][2:] == (True, 2) and got[1][2:] == (False, None)
    one = lambda c: rows(spark.range(1).select(c))[0][0]
    assert one(jsons.minify(F.lit('{ "a // b" : 1, /* x */ "c": 2 } // end'))) == '{"a // b":1,"c":2}'
    assert one(jsons.equal(F.lit('{"a":1,"b":[1,2]}'), F.lit('{"b":[1,2],"a":1}'))) is True
    assert one(jsons.equal(F.lit("[1,2]"), F.lit("[2,1]"))) is False
    assert one(jsons.with_key(F.lit('{"a":1}'), "b", F.lit("[true]"))) == '{"a":1,"b":[true]}'
    assert one(jsons.without_key(F.lit('{"a":1,"b":2}'), "a")) == '{"b":2}'
    assert one(jsons.with_item(F.lit("[1,3]"), F.lit("2"), 1)) == "[1,2,3]" and one(jsons.without_item(F.lit("[1,2,3]"), 0)) == "[2,3]"


def test_jobs_fail_as_rows(spark):
    from chartloom.operators import jobs

    df = spark.createDataFrame([(i,) for i in range(6)], "job_index long")
    got = rows(jobs.run_jobs(df, lambda row: 1 // row["job_index"] and 0, parts=2), "job_index")
    assert [r[1] for r in got] == [1, 0, 0, 0, 0, 0] and "zero" in got[0][2]

    def broken():
        raise RuntimeError("no licence")

    assert {tuple(r)[1:] for r in jobs.run_jobs(df, lambda row: 0, broken).collect()} == {(1, "init: no licence")}


@pytest.mark.parametrize("size", [(256, 256), (40, 23), (8, 8)])
def test_jpeg_opens_in_spark(spark, tmp_path, size):
    from chartloom.operators.jpeg import encode_jpeg

    w, h = size
    y, x = np.mgrid[0:h, 0:w]
    rgba = np.stack([x * 255 // w, y * 255 // h, 128 + 60 * np.sin(x / 9) * np.cos(y / 7), np.full_like(x, 255)], -1).astype("u1")
    rgba[: h // 4, : w // 4, :3] = 255
    (tmp_path / "t.jpg").write_bytes(encode_jpeg(rgba.tobytes(), w, h))
    image = spark.read.format("image").load(str(tmp_path)).select("image.*").first()
    assert (image.width, image.height) == size
    got = np.frombuffer(image.data, "u1").reshape(h, w, 3)[..., ::-1].astype(int)
    assert np.abs(got - rgba[..., :3]).mean() < 6
    (tmp_path / "t.jpg").write_bytes(encode_jpeg(np.random.default_rng(1).integers(0, 256, (h, w, 4), "u1").tobytes(), w, h, 98))
    assert spark.read.format("image").load(str(tmp_path)).count() == 1


def test_gather_takes_average_and_mode(spark):
    df = spark.createDataFrame([(0, x, y, float(v)) for (x, y), v in {(0, 0): 1, (1, 0): 1, (0, 1): 4, (1, 1): 9, (2, 0): 5, (3, 0): 7}.items()], "ds int, px int, py int, v double")
    area = spark.createDataFrame([(0, 0.0, -4.0, 4.0, 0.0)], "ds int, min_x double, min_y double, max_x double, max_y double")
    gt = [F.lit(float(v)) for v in (0, 1, 0, 0, 0, -1)]
    take = lambda method: {(r.x, r.y): r.v for r in warp.gather(df, area, ["ds"], "v", F.lit(2.0), 4326, 4326, gt, method).collect()}
    assert take("average") == {(0, 0): 3.75, (1, 0): 6.0} and take("mode") == {(0, 0): 1.0, (1, 0): 5.0}
    with pytest.raises(ValueError):
        warp.warp(df, area, ["ds"], "v", "mode")


# --- the web and the command line


@pytest.fixture
def site(tmp_path):
    """A site of this machine with index pages and archives; gives its address and the list of what was asked."""
    import email.utils
    import http.server
    import threading

    asked = []
    index = '<div id="a"><table>' + "".join(f'<tr><td>x</td><td><a href="/{d}/{n}.zip">Geo-TIFF</a></td></tr>' for d, n in (("03-20-2025", "p"), ("01-23-2025", "q"), ("03-20-2025", "r"))) + "</table></div>"

    class Site(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append((self.path, self.headers.get("If-Modified-Since")))
            if self.path == "/index":
                body = index.encode()
            elif self.path.startswith("/03-20-2025/") and not self.path.endswith("r.zip"):
                body = b"archive" + self.path.encode()
            else:
                return self.send_error(404)
            since = self.headers.get("If-Modified-Since")
            if since and email.utils.parsedate_to_datetime(since).timestamp() > 1e9:
                self.send_response(304)
                return self.end_headers()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def test_links_are_repaired_and_fetched_once(spark, site, tmp_path):
    address, asked = site
    links = web.linked(spark, [(f"{address}/index", ["a", "none"])]).orderBy("ordinal").collect()
    assert [r.url for r in links] == [f"{address}/03-20-2025/{n}.zip" for n in "pqr"]  # the outvoted date is repaired
    folder = str(tmp_path / "got")
    urls = spark.createDataFrame([(r.url,) for r in links], "url string")
    status = lambda: {r.url[-5]: r.status for r in web.fetch(urls, folder).collect()}
    assert status() == {"p": "got", "q": "got", "r": "failed"}
    assert (tmp_path / "got/p.zip").read_bytes() == b"archive/03-20-2025/p.zip" and sorted(p.name for p in (tmp_path / "got").iterdir()) == ["p.zip", "q.zip"]
    assert status() == {"p": "skipped", "q": "skipped", "r": "failed"}
    assert any(since for path, since in asked if path.endswith("p.zip"))


def test_command_lines(spark, site, tmp_path, capsys):
    address, _ = site
    out = str(tmp_path / "zips")
    assert pipeline.download(["-o", out, "-p", f"{address}/index=a", "-l"]) == 0
    assert capsys.readouterr().out.split() == [f"{address}/03-20-2025/{n}.zip" for n in "pqr"]
    assert pipeline.download(["-o", out, "-p", f"{address}/index=a"]) == 1 and "2 archives fetched or current, 1 failed" in capsys.readouterr().out
    res = 2 * m.ORIGIN / 256 / 4
    zipped(tmp_path, "a", rasters.geotiff(np.full((3, 40, 40), 50, "u1"), [0.0, res, 0.0, 40 * res, 0.0, -res]))
    (tmp_path / "c.json").write_text(json.dumps({"datasets": {"a": {"zip_file": "a", "max_lod": 2}, "b": {"zip_file": "b", "max_lod": 1}}, "tilesets": {"T": {"tile_path": "t", "datasets": ["a"]}, "U": {"tile_path": "u", "datasets": ["b"]}}}))
    common = ["-c", str(tmp_path / "c.json"), "-z", str(tmp_path), "-t", str(tmp_path / "stage"), "-o", str(tmp_path / "tiles")]
    assert pipeline.main([*common, "-l"]) == 0 and "(t, zoom 0-2)" in capsys.readouterr().out
    assert pipeline.main([*common, "-s", "T", "-R", "cubic", "-S", "average", "-e", "3857", "-C"]) == 0
    assert "3 tiles written" in capsys.readouterr().out and not (tmp_path / "stage").exists()
    assert pipeline.main([*common, "-q"]) == 1 and "b: ValueError" in capsys.readouterr().out
    with pytest.raises(ValueError, match="4326"):
        pipeline.main([*common, "-e", "4326"])


def test_json_texts_are_made_and_changed(spark):
    row = spark.range(1).select(
        jsons.create("string", F.lit('a"b\\c\n')).alias("s"), jsons.create("number", F.lit(2.5)).alias("n"), jsons.create("number", F.lit(float("nan"))).alias("nan"), jsons.create("null").alias("z"),
        jsons.create("object", {"k": jsons.create("array", [F.lit("1"), F.lit("true")])}).alias("o"), jsons.replaced_key(F.lit('{"A":1,"b":2}'), "a", F.lit("[3]"), any_case=True).alias("r"),
        jsons.replaced_item(F.lit("[1,2,3]"), 1, F.lit('"x"')).alias("i"), jsons.near_equal(F.lit("0.30000000000000004"), F.lit("0.3")).alias("near"), jsons.near_equal(F.lit("0.3"), F.lit("0.31")).alias("far"),
        jsons.depth(F.lit('{"a":[[1],"]]"]}')).alias("d"), jsons.within_limits(F.lit("[" * 1001 + "]" * 1001)).alias("deep"), jsons.within_limits(F.lit("1")).alias("flat"),
    ).first()
    assert (json.loads(row.s), row.n, row.nan, row.z, json.loads(row.o)) == ('a"b\\c\n', "2.5", "null", "null", {"k": [1, True]})
    assert json.loads(row.r) == {"A": [3], "b": 2} and json.loads(row.i) == [1, "x", 3]
    assert (row.near, row.far, row.d, row.deep, row.flat) == (True, False, 3, False, True)
