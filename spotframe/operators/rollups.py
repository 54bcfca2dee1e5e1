"""Spot tables rolled up to nuclei and nuclei rolled up to images."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from spotframe.functions.ranks import median_table
from spotframe.functions.scalars import disk_area, finite, ratio, sphere_volume

KEY = ["image", "nucleus_id"]


def spot_rollup(
    spots: DataFrame, nuclei: DataFrame, voxel_xy_um: float = 0.13, channels: Sequence[str] = ("rna1", "rna2")
) -> DataFrame:
    """Counts, brightness and pairing per (image, nucleus, channel); nuclei without spots stay with zeros.

    ``nuclei`` carries (image, nucleus_id, area_px).
    """
    owned = spots.where(F.col("nucleus_id") > 0)
    has_pairs = "paired" in spots.columns
    nn = F.col("nn_distance_um") if "nn_distance_um" in spots.columns else F.lit(None).cast("double")
    counts = owned.groupBy(*KEY, "channel").agg(
        F.count(F.lit(1)).alias("n_spots"),
        F.sum(F.col("in_nucleus").cast("int")).alias("nuclear_spots"),
        F.sum(F.col("in_cytoplasm").cast("int")).alias("cyto_spots"),
        F.avg("peak").alias("mean_peak"),
        F.sum("peak").alias("total_peak"),
        F.stddev_samp("peak").alias("_sd"),
        (F.sum("paired") if has_pairs else F.lit(0)).cast("long").alias("paired_count"),
    )
    meds = median_table(owned.withColumn("_nn", nn), {"median_peak": "peak", "median_nn_um": finite(F.col("_nn"))}, [*KEY, "channel"])
    every = nuclei.select(*KEY, "area_px", F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"))
    area_um2 = F.col("area_px") * (voxel_xy_um * voxel_xy_um)
    return (
        every.join(counts, [*KEY, "channel"], "left")
        .join(meds, [*KEY, "channel"], "left")
        .fillna(0, ["n_spots", "nuclear_spots", "cyto_spots", "paired_count"])
        .withColumn("nuclear_spot_fraction", ratio(F.col("nuclear_spots"), F.col("n_spots")))
        .withColumn("density_per_um2", F.when((F.col("n_spots") > 0) & (area_um2 > 0), F.col("n_spots") / area_um2))
        .withColumn("peak_cv", ratio(F.col("_sd"), F.col("mean_peak")))
        .withColumn("paired_fraction", ratio(F.col("paired_count"), F.col("n_spots")))
        .drop("_sd")
    )


def active_and_mature(spots: DataFrame, nuclei: DataFrame) -> DataFrame:
    """Per channel: nuclear spots with a partner nearby, and cytoplasmic spots."""
    active = F.col("in_nucleus") & (F.col("paired") == 1)
    counts = spots.where(F.col("nucleus_id") > 0).groupBy(*KEY).agg(
        *[
            F.sum(F.when(cond & (F.col("channel") == channel), 1).otherwise(0)).alias(f"{name}_{channel}")
            for channel in ("rna1", "rna2")
            for name, cond in (("n_active", active), ("n_mature", F.col("in_cytoplasm")))
        ]
    )
    return nuclei.join(counts, KEY, "left").fillna(0)


def spot_size_rollup(spots: DataFrame, nuclei: DataFrame, default_um: float, voxel_xy_um: float = 0.13) -> DataFrame:
    """Spot size per nucleus; the nominal diameter stands in where no spot was measured."""
    measured = F.when(F.col("diameter_um") > 0, F.col("diameter_um"))
    rows = spots.where(F.col("nucleus_id") > 0).withColumn("_d", finite(measured)).where(F.col("_d").isNotNull())
    fwhm = F.col("_d") / voxel_xy_um
    sizes = rows.groupBy(*KEY).agg(
        F.avg("_d").alias("mean_diameter_um"),
        F.avg(fwhm).alias("mean_fwhm_px"),
        F.avg(disk_area(fwhm)).alias("mean_area_px"),
    )
    meds = median_table(rows, {"median_fwhm_px": fwhm}, KEY)
    nominal_px = F.lit(default_um / voxel_xy_um)
    return (
        nuclei.join(sizes, KEY, "left")
        .join(meds, KEY, "left")
        .withColumn("mean_diameter_um", F.coalesce("mean_diameter_um", F.lit(default_um)))
        .withColumn("mean_fwhm_px", F.coalesce("mean_fwhm_px", nominal_px))
        .withColumn("median_fwhm_px", F.coalesce("median_fwhm_px", nominal_px))
        .withColumn("mean_area_px", F.coalesce("mean_area_px", disk_area(nominal_px)))
        .withColumn("nominal_volume_um3", sphere_volume(F.lit(default_um)))
    )


def partner_enrichment(spots: DataFrame, nuclei: DataFrame) -> DataFrame:
    """Mean partner signal at the spots of a nucleus over the nucleus mean of the partner channel.

    ``spots`` carries partner_mean; ``nuclei`` carries (image, nucleus_id, channel, nuc_mean).
    """
    partner = F.when(F.col("channel") == "rna1", F.lit("rna2")).otherwise(F.lit("rna1"))
    local = (
        spots.where(F.col("nucleus_id") > 0)
        .withColumn("_p", finite(F.col("partner_mean")))
        .groupBy(*KEY, "channel")
        .agg(F.avg("_p").alias("local_mean"))
        .withColumn("partner", partner)
    )
    background = nuclei.select(*KEY, F.col("channel").alias("partner"), "nuc_mean")
    return (
        local.join(background, [*KEY, "partner"], "left")
        .withColumn("enrichment", ratio(F.col("local_mean"), F.col("nuc_mean")))
        .drop("nuc_mean")
    )


def association(spots: DataFrame, footprints: DataFrame, partner: DataFrame, nuclei: DataFrame, floor: float | None = None) -> DataFrame:
    """Footprint enrichment of a nucleus' spots: continuous, gated by a floor, and over the pixel union.

    spots (image, nucleus_id, spot_id, footprint_mean); footprints (image, y, x) pixels with repeats;
    partner: nuclear pixels (image, y, x, nucleus_id, v); nuclei: (image, nucleus_id, nuc_mean).
    """
    means = nuclei.select(*KEY, "nuc_mean")
    gated_in = F.col("footprint_mean") >= F.lit(floor) if floor is not None else F.lit(True)
    per_spot = (
        spots.where(F.col("nucleus_id") > 0)
        .join(means, KEY)
        .withColumn("enr", finite(ratio(F.col("footprint_mean"), F.col("nuc_mean"))))
    )
    ratios = per_spot.groupBy(*KEY).agg(
        F.avg("enr").alias("assoc_continuous"),
        F.avg(F.when(F.col("enr").isNotNull(), F.when(gated_in, F.col("enr")).otherwise(0.0))).alias("assoc_gated"),
    )
    union = (
        partner.join(union_mask(footprints), ["image", "y", "x"], "left_semi")
        .groupBy(*KEY)
        .agg(F.avg("v").alias("_foci"))
    )
    return (
        means.join(ratios, KEY, "left")
        .join(union, KEY, "left")
        .withColumn("foci_enrichment", ratio(F.col("_foci"), F.col("nuc_mean")))
        .drop("_foci", "nuc_mean")
    )


def union_mask(footprints: DataFrame) -> DataFrame:
    return footprints.select("image", "y", "x").distinct()


def capacity(spots: DataFrame, nuclei: DataFrame, default_um: float, voxel_xy_um: float = 0.13) -> DataFrame:
    """Partner signal held in the footprints of nuclear spots, spot mass, and their nuclear share.

    ``spots`` carries footprint_mean and footprint_area_px; ``nuclei`` carries partner_total.
    """
    diameter = F.coalesce(finite(F.when(F.col("diameter_um") > 0, F.col("diameter_um"))), F.lit(default_um))
    sums = (
        spots.where(F.col("in_nucleus") & (F.col("nucleus_id") > 0))
        .groupBy(*KEY)
        .agg(
            F.sum(finite(F.col("footprint_mean") * F.col("footprint_area_px"))).alias("associated_signal"),
            F.sum(finite(F.col("peak") * disk_area(diameter / voxel_xy_um))).alias("spot_mass"),
        )
    )
    return (
        nuclei.join(sums, KEY, "left")
        .withColumn("capacity", ratio(F.col("associated_signal"), F.col("partner_total")))
    )


def foci_bands(spots: DataFrame, nuclei: DataFrame, floors: Sequence[float] = (0, 5000, 8000, 10000, 12000, 15000)) -> tuple[DataFrame, DataFrame]:
    """(per-nucleus counts of nuclear spots at or above each floor, group means per floor)."""
    names = [f"foci_ge{int(f)}" for f in floors]
    counts = spots.where(F.col("in_nucleus")).groupBy(*KEY).agg(
        *[F.sum(F.when(F.col("peak") >= f, 1).otherwise(0)).alias(n) for f, n in zip(floors, names)]
    )
    wide = nuclei.join(counts, KEY, "left").fillna(0, names)
    bands = (
        wide.select("group", F.explode(F.array(*[F.struct(F.lit(float(f)).alias("floor"), F.col(n).alias("c")) for f, n in zip(floors, names)])).alias("s"))
        .groupBy("group", "s.floor")
        .agg(F.round(F.avg("s.c"), 3).alias("foci_per_nucleus"))
    )
    return wide, bands


def per_image_summary(nuclei: DataFrame, spots: DataFrame, metrics: Sequence[str] = ("mean_peak", "total_peak")) -> DataFrame:
    """One row per (image, channel) from the per-nucleus table and the stratified spot table.

    Per-nucleus metrics are summarised over nuclei with at least one spot. Paired totals count all
    detected spots while their fraction divides by in-cell spots.
    """
    keys = ["image", "channel"]
    n, m = F.col("n_spots"), F.avg("n_spots")
    expressing = F.col("n_spots") > 0
    shares = [F.round(F.avg(F.when(n >= k, 1.0).otherwise(0.0)), 4).alias(f"frac_nuclei_ge{k}") for k in (1, 5, 10)]
    per_metric = []
    for c in metrics:
        v = F.when(expressing, F.col(c))
        per_metric += [F.avg(v).alias(f"{c}_mean"), ratio(F.stddev_samp(v), F.avg(v)).alias(f"{c}_cv")]
    by_nucleus = nuclei.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_nuclei"),
        m.alias("spots_per_nucleus_mean"),
        ratio(F.stddev_samp("n_spots"), m).alias("spots_per_nucleus_cv"),
        F.sum("nuclear_spots").alias("nuclear_spots"),
        F.sum("cyto_spots").alias("cyto_spots"),
        *shares,
        *per_metric,
    )
    median_cols: Mapping[str, object] = {
        "spots_per_nucleus_median": "n_spots",
        **{f"{c}_median": F.when(expressing, F.col(c)) for c in metrics},
    }
    nuc_meds = median_table(nuclei, median_cols, keys)
    in_cell = F.col("in_nucleus") | F.col("in_cytoplasm")
    by_spot = spots.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_spots_raw"),
        F.sum(in_cell.cast("int")).alias("n_spots"),
        F.sum("paired").alias("paired_count"),
    )
    nn = median_table(spots, {"median_nn_um": finite(F.col("nn_distance_um"))}, keys)
    return (
        by_nucleus.join(nuc_meds, keys, "left")
        .join(by_spot, keys, "left")
        .join(nn, keys, "left")
        .fillna(0, ["n_spots_raw", "n_spots", "paired_count"])
        .withColumn("n_floaters", F.col("n_spots_raw") - F.col("n_spots"))
        .withColumn("frac_nuclear", ratio(F.col("nuclear_spots"), F.col("n_spots")))
        .withColumn("paired_fraction", ratio(F.col("paired_count"), F.col("n_spots")))
    )
