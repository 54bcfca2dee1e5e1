"""Plane tables in their two forms and the joins that touch only the pixels that matter.

``plane_rows`` (image, channel, z, y, vals ARRAY<DOUBLE>) holds one array per image row and is the form
to store; ``planes`` (image, channel, y, x, v) is the flat form. Functions here take either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.functions.stencils import spans

PIXEL = ["image", "y", "x"]


def is_rows(planes: DataFrame) -> bool:
    return "vals" in planes.columns


def flat(planes: DataFrame) -> DataFrame:
    """One row per pixel."""
    if not is_rows(planes):
        return planes
    keep = [c for c in planes.columns if c != "vals"]
    return planes.select(*keep, F.posexplode("vals").alias("x", "v")).withColumn("x", F.col("x").cast("long"))


def pixels_in(planes: DataFrame, regions: DataFrame) -> DataFrame:
    """Pixels covered by ``regions`` (image, y, x, ...) with the region columns and the value v.

    In row form the regions are gathered per image row, at most one frame width each, so that arrays
    travel through the shuffle and only covered pixels are unpacked.
    """
    if not is_rows(planes):
        return planes.join(regions, PIXEL)
    tags = [c for c in regions.columns if c not in PIXEL]
    rows = regions.groupBy("image", "y").agg(F.collect_list(F.struct("x", *tags)).alias("_cells"))
    keep = [c for c in planes.columns if c != "vals"]
    return (
        planes.join(rows, ["image", "y"])
        .select(*keep, "vals", F.explode("_cells").alias("_c"))
        .select(*keep, F.col("_c.x").alias("x"), *[F.col(f"_c.{t}").alias(t) for t in tags], F.get("vals", F.col("_c.x").cast("int")).alias("v"))
    )


def two_channels(plane_rows: DataFrame, first: str | int, second: str | int) -> DataFrame:
    """Row form of a channel pair: (image, y, vals, vals2)."""
    wanted = plane_rows.where(F.col("channel").isin(first, second))
    return (
        wanted.groupBy("image", "y")
        .agg(
            F.max(F.when(F.col("channel") == first, F.col("vals"))).alias("vals"),
            F.max(F.when(F.col("channel") == second, F.col("vals"))).alias("vals2"),
        )
        .where(F.col("vals").isNotNull() & F.col("vals2").isNotNull())
    )


def pair_pixels_in(plane_rows: DataFrame, first: str | int, second: str | int, regions: DataFrame) -> DataFrame:
    """(image, y, x, region columns, a, b): both channels at the pixels of ``regions``."""
    pair = two_channels(plane_rows, first, second)
    tags = [c for c in regions.columns if c not in PIXEL]
    rows = regions.groupBy("image", "y").agg(F.collect_list(F.struct("x", *tags)).alias("_cells"))
    at = F.col("_c.x").cast("int")
    return (
        pair.join(rows, ["image", "y"])
        .select("image", "y", "vals", "vals2", F.explode("_cells").alias("_c"))
        .select("image", "y", F.col("_c.x").alias("x"), *[F.col(f"_c.{t}").alias(t) for t in tags], F.get("vals", at).alias("a"), F.get("vals2", at).alias("b"))
    )


def _neighbour_rows(plane_rows: DataFrame, reach: int, clip: bool) -> DataFrame:
    """Add r{dy} columns: the row array dy rows below; past the frame the edge row (clip) or NULL."""
    plane = [c for c in ("image", "channel", "z") if c in plane_rows.columns]
    w = Window.partitionBy(*plane).orderBy("y")
    out = plane_rows.withColumn("r0", F.col("vals"))
    for d in range(1, reach + 1):
        above, below = F.lag("vals", d).over(w), F.lead("vals", d).over(w)
        out = out.withColumn(f"r-{d}", above).withColumn(f"r{d}", below)
    if clip:
        for d in range(1, reach + 1):
            nearer_up = [F.col(f"`r-{i}`") for i in range(d, 0, -1)]
            nearer_down = [F.col(f"r{i}") for i in range(d, 0, -1)]
            out = out.withColumn(f"c-{d}", F.coalesce(*nearer_up, F.col("vals"))).withColumn(f"c{d}", F.coalesce(*nearer_down, F.col("vals")))
        for d in range(1, reach + 1):
            out = out.drop(f"r-{d}", f"r{d}").withColumnRenamed(f"c-{d}", f"r-{d}").withColumnRenamed(f"c{d}", f"r{d}")
    return out


def stencil_mean_rows(plane_rows: DataFrame, offsets: Sequence[tuple[int, int]]) -> DataFrame:
    """Mean over a pixel stencil at every pixel, offsets clipped to the frame, in row form.

    Rows of the same plane meet in a window over y, so a stencil costs one shuffle of row arrays
    instead of one shuffled row per pixel and offset.
    """
    by_row = spans(offsets)
    reach = max(abs(dy) for dy in by_row)
    near = _neighbour_rows(plane_rows, reach, clip=True)
    keep = [c for c in plane_rows.columns if c != "vals"]

    def at(x: Column) -> Column:
        last = F.size("vals") - 1
        total = None
        for dy, dxs in by_row.items():
            row = F.col(f"`r{dy}`")
            for dx in dxs:
                v = F.get(row, F.greatest(F.lit(0), F.least(x + dx, last)))
                total = v if total is None else total + v
        return total / F.lit(float(len(offsets)))

    means = F.transform(F.sequence(F.lit(0), F.size("vals") - 1), at)
    return near.select(*keep, means.alias("vals"))


def value_at(points: DataFrame, plane_rows: DataFrame, y: str, x: str, name: str) -> DataFrame:
    """Look up one value per point, position clipped to the frame; plane_rows is one plane per image."""
    rows = plane_rows.select("image", F.col("y").alias("_row"), F.col("vals").alias("_vals"))
    heights = plane_rows.groupBy("image").agg(F.max("y").alias("_last"))
    return (
        points.join(heights, "image")
        .withColumn("_row", F.greatest(F.lit(0).cast("long"), F.least(F.col(y).cast("long"), F.col("_last"))))
        .join(rows, ["image", "_row"])
        .withColumn(name, F.get("_vals", F.greatest(F.lit(0), F.least(F.col(x).cast("int"), F.size("_vals") - 1))))
        .drop("_row", "_vals", "_last")
    )
