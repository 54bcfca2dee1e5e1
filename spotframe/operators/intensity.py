"""Per-compartment intensity, morphology-free: sums, means, thresholded and above-floor signal."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotframe.functions.ranks import medians, quantiles
from spotframe.functions.scalars import ratio
from spotframe.operators.frames import PIXEL, pixels_in

KEY = ["image", "nucleus_id"]


def compartments(labels: DataFrame, cyto: DataFrame) -> DataFrame:
    """One row per labelled pixel: (image, y, x, nucleus_id, compartment).

    ``cyto`` holds no pixel of a nucleus, which is how label expansion writes it.
    """
    nuc = labels.select(*PIXEL, "nucleus_id", F.lit("nuc").alias("compartment"))
    rim = cyto.select(*PIXEL, F.col("cyto_id").alias("nucleus_id"), F.lit("cyto").alias("compartment"))
    return nuc.unionByName(rim)


def nuclei_of(labels: DataFrame) -> DataFrame:
    return labels.groupBy(*KEY).agg(F.count(F.lit(1)).alias("area_px"))


def compartment_intensity(planes: DataFrame, labels: DataFrame, cyto: DataFrame) -> DataFrame:
    """Mean, sum and area of nucleus and cytoplasm per (image, nucleus, channel)."""
    joined = pixels_in(planes, compartments(labels, cyto))
    nuc, rim = F.col("compartment") == "nuc", F.col("compartment") == "cyto"
    return joined.groupBy(*KEY, "channel").agg(
        F.sum(F.when(nuc, 1).otherwise(0)).alias("nuc_area_px"),
        F.sum(F.when(nuc, F.col("v"))).alias("nuc_sum"),
        F.avg(F.when(nuc, F.col("v"))).alias("nuc_mean"),
        F.sum(F.when(rim, 1).otherwise(0)).alias("cyto_area_px"),
        F.coalesce(F.sum(F.when(rim, F.col("v"))), F.lit(0.0)).alias("cyto_sum"),
        F.avg(F.when(rim, F.col("v"))).alias("cyto_mean"),
    )


def nc_ratios(nuclei: DataFrame) -> DataFrame:
    """Nuclear to cytoplasmic ratios of means and totals, nuclear share and whole-cell totals."""
    total = F.col("nuc_sum") + F.col("cyto_sum")
    return (
        nuclei.withColumn("nc_ratio_mean", ratio(F.col("nuc_mean"), F.col("cyto_mean")))
        .withColumn("nc_ratio_total", ratio(F.col("nuc_sum"), F.col("cyto_sum")))
        .withColumn("nuclear_fraction", ratio(F.col("nuc_sum"), total))
        .withColumn("cell_total", total)
        .withColumn("cell_area_px", F.col("nuc_area_px") + F.col("cyto_area_px"))
    )


def thresholded_intensity(planes: DataFrame, labels: DataFrame, cyto: DataFrame, floor: float | None) -> DataFrame:
    """Raw signal of the pixels at or above a floor, per (image, nucleus, channel).

    Without a usable floor, or for an empty compartment, totals are NULL and the area is 0.
    """
    joined = pixels_in(planes, compartments(labels, cyto))
    usable = floor is not None and floor > 0
    cols = []
    for name in ("nuc", "cyto"):
        inside = F.col("compartment") == name
        keep = inside & (F.col("v") >= F.lit(float(floor))) if usable else F.lit(False)
        size = F.sum(F.when(inside, 1).otherwise(0))
        area = F.sum(F.when(keep, 1).otherwise(0))
        total = F.sum(F.when(keep, F.col("v")).otherwise(0.0))
        cols += [
            (F.when(size > 0, total) if usable else F.lit(None).cast("double")).alias(f"{name}_thresh_total"),
            F.avg(F.when(keep, F.col("v"))).alias(f"{name}_thresh_mean"),
            area.alias(f"{name}_thresh_area_px"),
            F.when(size > 0, area / size).alias(f"{name}_thresh_fraction"),
        ]
    return joined.groupBy(*KEY, "channel").agg(*cols)


def above_floor_intensity(planes: DataFrame, labels: DataFrame, cyto: DataFrame, floor: float) -> DataFrame:
    """Signal above a floor, summed per compartment, with nuclear ratio and share."""
    excess = F.greatest(F.col("v") - F.lit(float(floor)), F.lit(0.0))
    nuc, rim = F.col("compartment") == "nuc", F.col("compartment") == "cyto"
    sums = (
        pixels_in(planes, compartments(labels, cyto))
        .groupBy(*KEY, "channel")
        .agg(
            F.sum(F.when(nuc, excess)).alias("nuc_above"),
            F.coalesce(F.sum(F.when(rim, excess)), F.lit(0.0)).alias("cyto_above"),
        )
    )
    return sums.withColumn("nc_ratio_above", ratio(F.col("nuc_above"), F.col("cyto_above"))).withColumn(
        "nuclear_fraction_above", ratio(F.col("nuc_above"), F.col("nuc_above") + F.col("cyto_above"))
    )


def chromatin(planes: DataFrame, labels: DataFrame, nucleoli: DataFrame) -> DataFrame:
    """DAPI texture per nucleus: level, spread, dense share and nucleolus share."""
    holes = nucleoli.where(F.col("nucleolus_id") > 0).select(*PIXEL, F.lit(True).alias("hole"))
    pixels = pixels_in(planes, labels.select(*PIXEL, "nucleus_id").join(holes, PIXEL, "left"))
    levels = quantiles(pixels, "v", KEY, {"dapi_median": 0.5, "dapi_p10": 0.1, "dapi_p90": 0.9})
    outside = F.col("hole").isNull()
    stats = (
        pixels.join(levels, KEY)
        .groupBy(*KEY, "dapi_median", "dapi_p10", "dapi_p90")
        .agg(
            F.count(F.lit(1)).alias("area_px"),
            F.avg("v").alias("dapi_mean"),
            F.stddev_pop("v").alias("dapi_std"),
            F.avg(F.when(F.col("v") >= 1.5 * F.col("dapi_median"), 1.0).otherwise(0.0)).alias("heterochromatin_fraction"),
            F.sum(F.when(outside, 0).otherwise(1)).alias("nucleolus_area_px"),
            F.avg(F.when(outside, F.col("v"))).alias("dapi_mean_outside_nucleolus"),
        )
    )
    return stats.withColumn("dapi_cv", ratio(F.col("dapi_std"), F.col("dapi_mean"))).withColumn(
        "nucleolus_fraction", F.col("nucleolus_area_px") / F.col("area_px")
    )


def nuclear_dominance(planes: DataFrame, thresholds: DataFrame, signal: str, dapi: str, lo: float, hi: float) -> DataFrame:
    """Median signal inside and outside the DAPI-positive area, raw and scaled to a display range.

    ``thresholds`` holds the DAPI cut per image: (image, thr).
    """
    inside = (
        planes.where(F.col("channel") == dapi)
        .join(thresholds, "image")
        .select(*PIXEL, (F.col("v") >= F.col("thr")).alias("inside"))
    )
    tagged = planes.where(F.col("channel") == signal).join(inside, PIXEL)
    med = medians(tagged, "v", ["image", "inside"])
    wide = med.groupBy("image").agg(
        F.max(F.when(F.col("inside"), F.col("median"))).alias("nuc_med"),
        F.max(F.when(~F.col("inside"), F.col("median"))).alias("cyt_med"),
    )

    def shown(c: str):
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(c) - lo) / max(hi - lo, 1e-6)))

    return wide.withColumn("nuc_disp", shown("nuc_med")).withColumn("cyt_disp", shown("cyt_med"))
