"""Views of the driver's tables as rasters, datasets, pixels and lists; each in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.mercator import ORIGIN

RING = ((0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 4.0), (0.0, 10.0))
HOLE = ((2.0, 1.0), (8.0, 1.0), (8.0, 3.0), (2.0, 3.0))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def points(t: Tables) -> DataFrame:
    lon = (F.col("event_id") * 37 % 36000) / F.lit(100.0) - 180.0
    lat = (F.col("event_id") * 17 % 17000) / F.lit(100.0) - 85.0
    return t.events.select("event_id", lon.alias("lon"), lat.alias("lat"))


def datasets(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    lon, lat = (k * 37 % 340 - 170).cast("double"), (k * 17 % 140 - 70).cast("double")
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("zip_file"))
    return t.supplier.join(nation, "s_nationkey").select(
        k.alias("id"),
        F.col("s_name").alias("name"),
        "zip_file",
        (4 + k % 5).cast("int").alias("max_lod"),
        lon.alias("lon_min"),
        lat.alias("lat_min"),
        (lon + 8.5).alias("lon_max"),
        (lat + 5.25).alias("lat_max"),
    )


def wrapped(t: Tables) -> DataFrame:
    across = F.col("id") % 10 == 0
    return datasets(t).withColumns(
        {"lon_min": F.when(across, 176.0).otherwise(F.col("lon_min")), "lon_max": F.when(across, -176.0).otherwise(F.col("lon_max"))}
    )


def tilesets(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_name").alias("name"), F.lower("r_name").alias("tile_path"))


def membership(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    rows = t.supplier.join(nation, "s_nationkey").join(t.region, "r_regionkey")
    order = F.row_number().over(Window.partitionBy("r_name").orderBy("s_suppkey"))
    return rows.select(F.col("r_name").alias("tileset"), F.lower("r_name").alias("tile_path"), F.col("s_name").alias("dataset"), order.alias("ordinal"))


def pixels(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("ds"),
        (F.col("l_orderkey") % 16).cast("int").alias("px"),
        (F.col("l_partkey") % 16).cast("int").alias("py"),
        F.floor("l_quantity").cast("int").alias("v"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(255).alias("a"),
        (4 + F.col("l_suppkey") % 5).cast("int").alias("lod"),
        "l_orderkey",
        "l_linenumber",
    )


def raster(t: Tables) -> DataFrame:
    """One value for each (ds, px, py), ds being l_suppkey mod 7."""
    return t.lineitem.groupBy(
        (F.col("l_suppkey") % 7).cast("int").alias("ds"), (F.col("l_orderkey") % 16).cast("int").alias("px"), (F.col("l_partkey") % 16).cast("int").alias("py")
    ).agg(F.max(F.floor("l_quantity")).cast("double").alias("v"))


def palette(t: Tables) -> DataFrame:
    idx = (F.col("p_partkey") % 256).cast("int").alias("idx")
    first = t.part.groupBy(idx).agg(F.min_by("p_size", "p_partkey").alias("s"))
    return first.select("idx", (F.col("s") * 5 % 256).cast("int").alias("r"), ((F.col("s") + F.col("idx")) % 256).cast("int").alias("g"), (F.lit(255) - F.col("idx")).alias("b"))


def gcps(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    px, py = (n * 13 % 97).cast("double"), (n * 29 % 89).cast("double")
    every = F.explode(F.sequence(F.lit(0), F.lit(9)))
    return t.nation.select("n_nationkey", every.alias("ds")).select(
        "ds", px.alias("px"), py.alias("py"), (F.col("ds") + 0.01 * px + 0.002 * py - 120).alias("lon"), (F.lit(40.0) + F.col("ds") - 0.003 * px - 0.01 * py).alias("lat")
    )


def urls(t: Tables) -> DataFrame:
    k = F.col("page_id")
    date = F.when(k % 5 == 0, F.lit("01-23-2025")).otherwise(F.lit("03-20-2025"))
    url = F.when(k % 11 == 3, F.concat(F.lit("https://host/undated/f"), k.cast("string"), F.lit(".zip"))).otherwise(F.concat(F.lit("https://host/charts/"), date, F.lit("/f"), k.cast("string"), F.lit(".zip")))
    return t.pages.select(F.when(k % 2 == 0, F.lit("vfr")).otherwise(F.lit("ifr")).alias("grp"), k.cast("int").alias("ordinal"), url.alias("url"))


def fetches(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    remote = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + (k % 3 - 1) * 86400)
    return t.orders.select(k.alias("file_id"), F.when(k % 10 != 0, F.col("o_orderdate").cast("timestamp")).alias("local_mtime"), remote.alias("remote_mtime"))


O_ = repr(ORIGIN)

SQL = {
    "pt": "pt AS (SELECT event_id, (event_id * 37 % 36000) / 100.0::DOUBLE - 180.0::DOUBLE AS lon, (event_id * 17 % 17000) / 100.0::DOUBLE - 85.0::DOUBLE AS lat FROM events)",
    "ds": """ds AS (SELECT s_suppkey AS id, s_name AS name, n_name AS zip_file, (4 + s_suppkey % 5)::INT AS max_lod, (s_suppkey * 37 % 340 - 170)::DOUBLE AS lon_min,
 (s_suppkey * 17 % 140 - 70)::DOUBLE AS lat_min, (s_suppkey * 37 % 340 - 170)::DOUBLE + 8.5 AS lon_max, (s_suppkey * 17 % 140 - 70)::DOUBLE + 5.25 AS lat_max
 FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    "mb": """mb AS (SELECT r_name AS tileset, lower(r_name) AS tile_path, s_name AS dataset, row_number() OVER (PARTITION BY r_name ORDER BY s_suppkey)::INT AS ordinal
 FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "px": """px AS (SELECT l_suppkey AS ds, (l_orderkey % 16)::INT AS px, (l_partkey % 16)::INT AS py, floor(l_quantity)::INT AS v, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 255 END AS a,
 (4 + l_suppkey % 5)::INT AS lod, l_orderkey, l_linenumber FROM lineitem)""",
    "rs": "rs AS (SELECT (l_suppkey % 7)::INT AS ds, (l_orderkey % 16)::INT AS px, (l_partkey % 16)::INT AS py, max(floor(l_quantity))::DOUBLE AS v FROM lineitem GROUP BY ALL)",
    "pal": """pal AS (SELECT idx, (s * 5 % 256)::INT AS r, ((s + idx) % 256)::INT AS g, (255 - idx)::INT AS b FROM
 (SELECT (p_partkey % 256)::INT AS idx, arg_min(p_size, p_partkey) AS s FROM part GROUP BY 1))""",
    "gcp": """gcp AS (SELECT ds::INT AS ds, px, py, ds + 0.01::DOUBLE * px + 0.002::DOUBLE * py - 120 AS lon, 40.0::DOUBLE + ds - 0.003::DOUBLE * px - 0.01::DOUBLE * py AS lat
 FROM (SELECT (n_nationkey * 13 % 97)::DOUBLE AS px, (n_nationkey * 29 % 89)::DOUBLE AS py FROM nation), range(0, 10) r(ds))""",
    "ur": """ur AS (SELECT CASE WHEN page_id % 2 = 0 THEN 'vfr' ELSE 'ifr' END AS grp, page_id::INT AS ordinal, CASE WHEN page_id % 11 = 3 THEN 'https://host/undated/f' || page_id || '.zip'
 ELSE 'https://host/charts/' || CASE WHEN page_id % 5 = 0 THEN '01-23-2025' ELSE '03-20-2025' END || '/f' || page_id || '.zip' END AS url FROM pages)""",
    "ft": """ft AS (SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate::TIMESTAMP END AS local_mtime, o_orderdate::TIMESTAMP + (o_orderkey % 3 - 1) * INTERVAL 1 DAY AS remote_mtime FROM orders)""",
}


def with_(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names)


def res(z: str) -> str:
    return f"({2 * ORIGIN / 256!r}::DOUBLE / pow(2.0::DOUBLE, {z}))"


def tx(lon: str, z: str) -> str:
    return f"greatest(least(floor(({lon} + 180.0::DOUBLE) / 360.0::DOUBLE * pow(2.0::DOUBLE, {z})), pow(2.0::DOUBLE, {z}) - 1), 0)::INT"


def ty(lat: str, z: str) -> str:
    return f"greatest(least(floor((1.0::DOUBLE - asinh(tan(radians({lat}))) / pi()) / 2.0::DOUBLE * pow(2.0::DOUBLE, {z})), pow(2.0::DOUBLE, {z}) - 1), 0)::INT"


def cover(source: str, keep: str) -> str:
    """Cells of boxes (with z) in SQL."""
    x0, x1 = tx("greatest(least(lon_min, 180), -180)", "z"), tx("greatest(least(lon_max, 180), -180)", "z")
    y0, y1 = ty("greatest(least(lat_max, 85), -85)", "z"), ty("greatest(least(lat_min, 85), -85)", "z")
    return f"(SELECT *, unnest(range(y0, y1 + 1))::INT AS y FROM (SELECT {keep}, z::INT AS z, {y0} AS y0, {y1} AS y1, unnest(range({x0}, {x1} + 1))::INT AS x FROM {source}))"


ZOOMED = "(SELECT *, unnest(range(0, least(max_lod, 8) + 1))::INT AS z FROM ds)"
METERS = f"lon_min * {O_} / 180 AS min_x, lon_max * {O_} / 180 AS max_x, asinh(tan(radians(lat_min))) * 6378137.0 AS min_y, asinh(tan(radians(lat_max))) * 6378137.0 AS max_y"
