"""Datasets and tilesets: membership, selection, zoom ranges and layer order.

Dimension tables here hold hundreds of rows, but none is broadcast by hand: the
size decides, at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.sources.config import DEFAULT_MAX_LOD


def members(membership: DataFrame, datasets: DataFrame) -> DataFrame:
    """Membership with the datasets' columns; names that no dataset has are left out."""
    return membership.join(datasets.withColumnRenamed("name", "dataset"), "dataset")


def unknown_members(membership: DataFrame, datasets: DataFrame) -> DataFrame:
    return membership.join(datasets.select(F.col("name").alias("dataset")), "dataset", "left_anti")


def select(tilesets: DataFrame, names: list[str] | None) -> DataFrame:
    """Tilesets of the given names or paths; all for None or a name ``all``."""
    if names is None or "all" in names:
        return tilesets
    return tilesets.filter(F.col("name").isin(names) | F.col("tile_path").isin(names))


def zoom_range(tilesets: DataFrame, membered: DataFrame) -> DataFrame:
    """(tileset, zoom_min, zoom_max): the greatest max_lod of resolvable members, 12 if there is none above 0."""
    top = membered.groupBy("tileset").agg(F.max("max_lod").alias("top"))
    best = F.when(F.col("top") > 0, F.col("top")).otherwise(F.lit(DEFAULT_MAX_LOD))
    return tilesets.select(F.col("name").alias("tileset")).join(top, "tileset", "left").select("tileset", F.lit(0).alias("zoom_min"), best.alias("zoom_max"))


def for_zoom(datasets: DataFrame, z) -> DataFrame:
    """Datasets that are detailed enough for a zoom."""
    return datasets.filter(F.col("max_lod") >= z)


def layer_order(membered: DataFrame) -> DataFrame:
    """``layer``: from background to foreground, by max_lod descending, then the order in the tileset."""
    w = Window.partitionBy("tileset").orderBy(F.col("max_lod").desc(), "ordinal")
    return membered.withColumn("layer", F.row_number().over(w))


def job_order(jobs: DataFrame, work: str = "work") -> DataFrame:
    """``place``: longest job first. For reports; Spark's scheduler needs no such order."""
    return jobs.withColumn("place", F.row_number().over(Window.orderBy(F.col(work).desc(), "name")))


def listing(tilesets: DataFrame, membered: DataFrame) -> DataFrame:
    """A line of text for each tileset: its name, path and zooms."""
    zooms = zoom_range(tilesets, membered)
    both = tilesets.withColumnRenamed("name", "tileset").join(zooms, "tileset")
    return both.select("tileset", F.format_string("%-40s (%s, zoom %d-%d)", "tileset", "tile_path", "zoom_min", "zoom_max").alias("line"))


def totals(membered: DataFrame) -> DataFrame:
    """(memberships, datasets): members of all tilesets, and how many datasets these are; one row."""
    return membered.agg(F.count("*").alias("memberships"), F.count_distinct("dataset").alias("datasets"))


def first_named(rows: DataFrame, name: str = "name", order: str = "ordinal") -> DataFrame:
    """Of rows that repeat a name, the first by ``order``; one pass with partial aggregation."""
    own = F.struct(*rows.columns)
    return rows.groupBy(name).agg(F.min_by(own, F.col(order)).alias("__r")).select(*[F.col(f"__r.{c}").alias(c) for c in rows.columns])
