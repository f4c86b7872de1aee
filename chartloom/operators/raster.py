"""Pixels of one dataset: window, palette, mask, ground control and clipping.

Pixels are rows (dataset, px, py, ...); geometry is small and joins by equality
on the dataset, or is a constant of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.mercator import clamp, col


def ring_bbox(ring: Column, width, height) -> dict[str, Column]:
    """The window of whole pixels that a ring needs: vertices cut to integers, then kept within the picture."""
    xs = F.transform(ring, lambda v: v["x"].cast("int"))
    ys = F.transform(ring, lambda v: v["y"].cast("int"))
    x0, y0 = clamp(F.array_min(xs), 0, width), clamp(F.array_min(ys), 0, height)
    x1, y1 = clamp(F.array_max(xs), 0, width), clamp(F.array_max(ys), 0, height)
    return {"x": x0, "y": y0, "w": x1 - x0, "h": y1 - y0}


def estimated_work(ring: Column) -> Column:
    """Area of a ring's box; 0 without a ring."""
    box = lambda part: F.array_max(F.transform(ring, part)) - F.array_min(F.transform(ring, part))
    return F.coalesce(box(lambda v: v["x"]) * box(lambda v: v["y"]), F.lit(0.0))


def window(pixels: DataFrame, x, y, w, h) -> DataFrame:
    """Pixels of a window, with places from its corner."""
    inside = (F.col("px") >= col(x)) & (F.col("px") < col(x) + col(w)) & (F.col("py") >= col(y)) & (F.col("py") < col(y) + col(h))
    return pixels.filter(inside).withColumns({"px": F.col("px") - col(x), "py": F.col("py") - col(y)})


def palette_expand(pixels: DataFrame, palette: DataFrame, index: str = "idx") -> DataFrame:
    """Pixels with their palette's colours (a palette has 256 entries at most)."""
    return pixels.join(palette, index)


def mask_alpha(pixels: DataFrame, edges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``a``: 255 for pixels whose centre is within the rings by the even-odd rule (so holes are out), else 0.

    edges: (x1, y1, x2, y2) of all rings, and the columns ``by`` that tell datasets apart. Each edge meets the rows of pixels it
    crosses, so edges and pixels join by row; crossings to the right are counted.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    # centre rows y + 0.5 with low <= y + 0.5 < high
    first, last = F.ceil(low - 0.5).cast("int"), (F.ceil(high - 0.5) - 1).cast("int")
    rows = edges.filter(F.col("y1") != F.col("y2")).withColumns({"__a": first, "__b": last}).filter(F.col("__a") <= F.col("__b"))
    rows = rows.withColumn("py", F.explode(F.sequence("__a", "__b")))
    at = F.col("x1") + (F.col("py") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    key = [*(by or []), "py"]
    crossings = rows.groupBy(*key).agg(F.collect_list(at).alias("__at"))
    right = F.size(F.filter(F.col("__at"), lambda v: v > F.col("px") + 0.5))
    hit = F.coalesce(right, F.lit(0)) % 2 == 1
    return pixels.join(crossings, key, "left").withColumn("a", F.when(hit, 255).otherwise(0)).drop("__at")


def shifted_gcps(points: DataFrame, off_x, off_y) -> DataFrame:
    """Ground control points (px, py) of a window whose first pixel is (off_x, off_y)."""
    return points.withColumns({"px": F.col("px") - col(off_x), "py": F.col("py") - col(off_y)})


def gcp_affine(points: DataFrame, by: str = "ds") -> DataFrame:
    """The least-squares affine (x0, xa, xb, y0, ya, yb) of each group's (px, py, lon, lat).

    Sums are taken around the means, so that the normal equations are two by two
    and well conditioned; groups on one line give nulls.
    """
    mean = points.groupBy(by).agg(*[F.avg(c).alias(f"m_{c}") for c in ("px", "py", "lon", "lat")])
    d = points.join(mean, by).select(by, *[(F.col(c) - F.col(f"m_{c}")).alias(c) for c in ("px", "py", "lon", "lat")])
    s = d.groupBy(by).agg(*[F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in (("px", "px"), ("px", "py"), ("py", "py"), ("px", "lon"), ("py", "lon"), ("px", "lat"), ("py", "lat"))])
    det = F.col("s_px_px") * F.col("s_py_py") - F.col("s_px_py") ** 2
    ok = det > 1e-9 * F.col("s_px_px") * F.col("s_py_py")
    out = [F.col(by)]
    for axis, p in (("lon", "x"), ("lat", "y")):
        a = F.when(ok, (F.col(f"s_px_{axis}") * F.col("s_py_py") - F.col(f"s_py_{axis}") * F.col("s_px_py")) / det)
        b = F.when(ok, (F.col(f"s_py_{axis}") * F.col("s_px_px") - F.col(f"s_px_{axis}") * F.col("s_px_py")) / det)
        out += [(F.col(f"m_{axis}") - a * F.col("m_px") - b * F.col("m_py")).alias(f"{p}0"), a.alias(f"{p}a"), b.alias(f"{p}b")]
    return s.join(mean, by).select(*out)


def clip_bounds(data: dict, bound: dict) -> dict[str, Column]:
    """Bounds cut to a geographic bound whose sides may be null (no bound); 0.0 is a bound."""
    low = lambda k: F.greatest(col(data[k]), F.coalesce(col(bound[k]), col(data[k])))
    high = lambda k: F.least(col(data[k]), F.coalesce(col(bound[k]), col(data[k])))
    return {"lon_min": low("lon_min"), "lat_min": low("lat_min"), "lon_max": high("lon_max"), "lat_max": high("lat_max")}
