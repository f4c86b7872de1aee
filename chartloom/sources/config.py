"""The configuration document: datasets and tilesets as DataFrames.

The document is one JSON object with maps ``datasets`` and ``tilesets``. Keys
are case-sensitive, of repeated keys the last counts, unknown keys are ignored.
A missing ``max_lod`` is 12, a missing ``input_file`` the name with ``.tif``; a
null bound means no bound, and 0.0 is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.functions.text import staged_name

DEFAULT_MAX_LOD = 12

_DATASET = T.StructType(
    [
        T.StructField("zip_file", T.StringType()),
        T.StructField("input_file", T.StringType()),
        T.StructField("mask", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))),
        T.StructField("geobound", T.ArrayType(T.DoubleType())),
        T.StructField("gcps", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("max_lod", T.IntegerType()),
    ]
)
_TILESET = T.StructType([T.StructField("tile_path", T.StringType()), T.StructField("datasets", T.ArrayType(T.StringType()))])
SCHEMA = T.StructType(
    [T.StructField("datasets", T.MapType(T.StringType(), _DATASET)), T.StructField("tilesets", T.MapType(T.StringType(), _TILESET))]
)


def parse(documents: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(datasets, tilesets) of rows that each hold one document. A malformed one, or one without both maps, is an error."""
    read = documents.select(F.from_json(value, SCHEMA, {"mode": "FAILFAST"}).alias("c"))
    whole = F.assert_true(F.col("c.datasets").isNotNull() & F.col("c.tilesets").isNotNull(), "the configuration needs datasets and tilesets")
    read = read.filter(whole.isNull())
    vertex = lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))
    point = lambda g: F.struct(g[0].alias("px"), g[1].alias("py"), g[2].alias("lon"), g[3].alias("lat"))
    bound = lambda i, name: F.get(F.col("d.geobound"), F.lit(i)).alias(name)
    datasets = read.select(F.explode("c.datasets").alias("name", "d")).select(
        "name",
        "d.zip_file",
        F.coalesce("d.input_file", F.concat("name", F.lit(".tif"))).alias("input_file"),
        staged_name("name").alias("tmp_file"),
        F.when(F.size("d.mask") > 0, F.transform("d.mask", lambda ring: F.transform(ring, vertex))).alias("mask"),
        bound(0, "lon_min"),
        bound(1, "lat_min"),
        bound(2, "lon_max"),
        bound(3, "lat_max"),
        F.when(F.size("d.gcps") > 0, F.transform("d.gcps", point)).alias("gcps"),
        F.coalesce("d.max_lod", F.lit(DEFAULT_MAX_LOD)).alias("max_lod"),
    )
    tilesets = read.select(F.explode("c.tilesets").alias("name", "t")).select("name", "t.tile_path", "t.datasets")
    return datasets, tilesets


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse(spark.read.text(path, wholetext=True))


def membership(tilesets: DataFrame) -> DataFrame:
    """(tileset, tile_path, dataset, ordinal): the members of each tileset in order."""
    return tilesets.select(F.col("name").alias("tileset"), "tile_path", F.posexplode("datasets").alias("ordinal", "dataset"))
