"""Painting layers into tiles, and what becomes of empty ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.mercator import TILE


def painter(pixels: DataFrame, by: list[str], bands: list[str], alpha: str = "a", lod: str = "lod", order: list[str] | None = None) -> DataFrame:
    """The pixel that ends on top: the last painted of those not transparent.

    Layers are painted by max_lod descending, then in order, so the top is the
    one of least lod and greatest order. It is an aggregate with partial sums,
    so a hot place costs one row for each task.
    """
    rank = F.struct((-F.col(lod)).alias("__l"), *[F.col(c) for c in order or []])
    value = F.struct(*[F.col(c) for c in [*bands, alpha]])
    top = pixels.filter(F.col(alpha) > 0).groupBy(*by).agg(F.max_by(value, rank).alias("__v"))
    return top.select(*by, *[F.col(f"__v.{c}").alias(c) for c in [*bands, alpha]])


def nonempty(pixels: DataFrame, by: list[str], alpha: str = "a") -> DataFrame:
    """Tiles with a pixel that is not transparent."""
    return pixels.groupBy(*by).agg(F.max(alpha).alias("__a")).filter("__a > 0").drop("__a")


def rgba(pixels: DataFrame, by: list[str], x: str = "px", y: str = "py", size: int = TILE) -> DataFrame:
    """(by, rgba): pixels (r, g, b, a) of each tile as bytes, row by row; absent pixels are transparent.

    A tile has size * size pixels at most, so a group is bounded.
    """

    def build(pdf):
        import numpy as np
        import pandas as pd

        out = np.zeros((size, size, 4), "u1")
        keep = pdf[(pdf[x] >= 0) & (pdf[x] < size) & (pdf[y] >= 0) & (pdf[y] < size)]
        out[keep[y], keep[x]] = keep[["r", "g", "b", "a"]]
        return pd.DataFrame([[*pdf[by].iloc[0], out.tobytes()]], columns=[*by, "rgba"])

    kinds = dict(pixels.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in by) + ", rgba binary"
    return pixels.select(*by, x, y, "r", "g", "b", "a").groupBy(*by).applyInPandas(build, schema)
