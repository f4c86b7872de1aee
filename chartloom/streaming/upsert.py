"""Tiles of arriving datasets, as a stream.

New dataset rows become the tiles that they touch; a tile that is already in the
output is not made again. Each micro-batch is one anti-join and one append, and
the checkpoint makes a batch that is done again find its own tiles there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartloom.operators import manifest

DATASET = "id long, name string, lon_min double, lat_min double, lon_max double, lat_max double, max_lod int"
TILE = "z int, x int, y int"


def read_datasets(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(DATASET).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def upsert_tiles(datasets: DataFrame, output: str, checkpoint: str, zoom_max: int = 12) -> StreamingQuery:
    """Appends the tiles of each batch that output does not hold yet; ends when all that is there is done."""

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        tiles = manifest.manifest(rows, F.lit(zoom_max))
        new = manifest.missing(tiles, existing(spark, output))
        new.write.mode("append").parquet(output)

    return datasets.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def existing(spark: SparkSession, output: str) -> DataFrame:
    """Tiles of the output so far; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(output)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(TILE).parquet(output) if there else spark.createDataFrame([], TILE)
