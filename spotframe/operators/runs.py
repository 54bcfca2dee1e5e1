"""Masks as horizontal runs: (image, y, x0, x1, id), one row for each unbroken stretch of a label in an image row.

A mask may be given in three forms: runs, label rows (image, y, ids ARRAY, 0 off every label), or pixels
(image, y, x, id). Rows become runs where they stand; only pixels have to be gathered per image row first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _id_column(mask: DataFrame, keys: Sequence[str]) -> str:
    """The one column that is neither key nor place."""
    left = [c for c in mask.columns if c not in (*keys, "y", "x", "x0", "x1")]
    if len(left) != 1:
        raise ValueError(f"a mask has its keys, its place and one id column; these are left: {left}")
    return left[0]


def to_runs(mask: DataFrame, keys: Sequence[str] = ("image",)) -> DataFrame:
    """(keys, y, x0, x1, id) of a mask in any form; ids of 0 and NULL are background."""
    keys = list(keys)
    if {"x0", "x1"} <= set(mask.columns):
        return mask.select(*keys, "y", "x0", "x1", F.col(_id_column(mask, keys)).alias("id"))
    if "ids" in mask.columns:
        # outside the row get() gives NULL, so its ends are edges as well
        edges = F.filter(F.sequence(F.lit(0), F.size("ids")), lambda i: ~F.get("ids", i - 1).eqNullSafe(F.get("ids", i)))
        cut = mask.select(*keys, "y", "ids", edges.alias("_e"))
        between = F.zip_with("_e", F.slice("_e", 2, F.size("_e")), lambda a, b: F.struct(a.alias("x0"), (b - 1).alias("x1"), F.get("ids", a).alias("id")))
        runs = cut.select(*keys, "y", F.explode(F.filter(between, lambda r: r["id"] > 0)).alias("_r"))
        return runs.select(*keys, "y", F.col("_r.x0").cast("long").alias("x0"), F.col("_r.x1").cast("long").alias("x1"), F.col("_r.id").alias("id"))
    name = _id_column(mask, keys)
    w = Window.partitionBy(*keys, "y", name).orderBy("x")
    numbered = mask.where(F.col(name) > 0).select(*keys, "y", "x", name).distinct().withColumn("_g", F.col("x") - F.row_number().over(w))
    return numbered.groupBy(*keys, "y", name, "_g").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).select(*keys, "y", "x0", "x1", F.col(name).alias("id"))


def run_pixels(runs: DataFrame, name: str, keys: Sequence[str] = ("image",)) -> DataFrame:
    """(keys, y, x, name): the pixels of runs."""
    return runs.select(*keys, "y", F.explode(F.sequence("x0", "x1")).alias("x"), F.col("id").alias(name))


def rows_of_runs(masks: Sequence[DataFrame], keys: Sequence[str] = ("image",)) -> DataFrame:
    """(keys, y, cells): for each image row the runs of all masks, cells being ARRAY<STRUCT<x0, x1, mask, id>> sorted by place.

    mask is the number of the mask in the list. A row holds at most as many runs as the frame is wide.
    """
    tagged = None
    for number, mask in enumerate(masks):
        runs = to_runs(mask, keys).select(*keys, "y", F.struct(F.col("x0").cast("long").alias("x0"), F.col("x1").cast("long").alias("x1"), F.lit(number).alias("mask"), F.col("id").cast("long").alias("id")).alias("cell"))
        tagged = runs if tagged is None else tagged.unionByName(runs)
    return tagged.groupBy(*keys, F.col("y").cast("long").alias("y")).agg(F.sort_array(F.collect_list("cell")).alias("cells"))


def id_at(cells: Column, x: Column, mask: int) -> Column:
    """The label of one mask at a column of an image row, NULL off it; of several the one whose run begins first."""
    return F.get(F.filter(cells, lambda c: (c["mask"] == mask) & (c["x0"] <= x) & (c["x1"] >= x)), F.lit(0))["id"]
