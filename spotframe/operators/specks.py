"""Dust specks: bright connected areas replaced by the plane's own level; projections around the sharpest slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotframe.functions.ranks import median_and_mad, medians
from spotframe.operators.channels import lock_z
from spotframe.operators.focus import peak_z
from spotframe.operators.labels import components
from spotframe.operators.thresholds import GAUSSIAN_MAD
from spotframe.session import cut_lineage

#: Steps to the side or up and down that the surroundings of a speck reach.
RING = 5


def mask_specks(planes: DataFrame, min_px: int, k: float = 50.0, replacement: str = "median") -> tuple[DataFrame, DataFrame]:
    """(planes with specks replaced, pixels replaced per image).

    planes (image, y, x, v) is one plane per image; a speck is a connected area of at least ``min_px``
    pixels above median + k * 1.4826 * MAD. They take the plane median, or with 'local' the median of the
    pixels that surround the specks of the image within five steps, where there are any.
    """
    if replacement not in ("median", "local"):
        raise ValueError("replacement is 'median' or 'local'")
    level = median_and_mad(planes, "v", ["image"])
    high = planes.join(level, "image").where((F.col("mad") > 0) & (F.col("v") > F.col("med") + k * GAUSSIAN_MAD * F.col("mad")))
    parts = components(high.select("image", "y", "x"), 8)
    big = parts.groupBy("image", "component").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_px)
    specks = cut_lineage(parts.join(big, ["image", "component"], "left_semi").select("image", "y", "x"))
    if replacement == "local":
        level = level.join(_ring_median(planes, specks), "image", "left").withColumn("med", F.coalesce("_ring", "med"))
    marked = planes.join(specks.withColumn("_hit", F.lit(True)), ["image", "y", "x"], "left").join(level.select("image", "med"), "image")
    cleaned = marked.withColumn("v", F.when(F.col("_hit"), F.col("med")).otherwise(F.col("v"))).drop("_hit", "med")
    counts = planes.select("image").distinct().join(specks.groupBy("image").agg(F.count(F.lit(1)).alias("n_masked")), "image", "left").fillna(0)
    return cleaned, counts


def _ring_median(planes: DataFrame, specks: DataFrame) -> DataFrame:
    """(image, _ring): median of the pixels within RING steps of a speck that are in none."""
    steps = [(dy, dx) for dy in range(-RING, RING + 1) for dx in range(-RING, RING + 1) if 0 < abs(dy) + abs(dx) <= RING]
    offsets = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in steps])
    around = specks.select("image", "y", "x", F.explode(offsets).alias("o")).select("image", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"))
    ring = planes.join(around.distinct(), ["image", "y", "x"], "left_semi").join(specks, ["image", "y", "x"], "left_anti")
    return medians(ring, "v", ["image"], "_ring")


def windowed_max(plane_rows: DataFrame, scores: DataFrame, frac: float = 0.5) -> DataFrame:
    """Maximum projection of a central share of the stack, centred on the sharpest central slice."""
    peak = peak_z(scores, central_fraction=frac)
    span = F.col("hi") - F.col("lo") + 1
    n = F.greatest(F.lit(1), F.rint(span * frac).cast("int"))
    start = F.greatest(F.col("lo"), F.least(F.col("peak_z") - F.floor(n / 2).cast("int"), F.col("hi") - n + 1))
    window = peak.select("image", start.alias("z_start"), (start + n - 1).alias("z_end"))
    return lock_z(plane_rows, window, "max")
