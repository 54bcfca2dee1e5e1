"""Analysis modes: named functions from input tables to result tables, built from the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F

from spotframe.operators import coloc, fov, intensity, lookup, neighbours, nulls, ranges, rollups, sampling, spotfilters
from spotframe.operators.channels import relabel_channel
from spotframe.operators.frames import flat, pair_pixels_in
from spotframe.plans.plate_run import plate_run
from spotframe.session import cut_lineage

Tables = dict[str, DataFrame]
MODES: dict[str, Callable[[Mapping[str, DataFrame], Mapping[str, Any]], Tables]] = {}


def register(name: str):
    def add(fn):
        MODES[name] = fn
        return fn

    return add


def run_mode(name: str, inputs: Mapping[str, DataFrame], **params: Any) -> Tables:
    if name not in MODES:
        raise KeyError(f"unknown mode {name!r}; known modes are {sorted(MODES)}")
    return MODES[name](inputs, params)


def _prepared(inputs: Mapping[str, DataFrame], params: Mapping[str, Any]) -> DataFrame:
    spots = inputs["spots"]
    if "floors" in inputs:
        spots = spotfilters.floor_spots(spots, inputs["floors"])
    return lookup.stratify_spots(spots, inputs["labels"], inputs["cyto"], inputs["images"])


def _pixel_table(inputs: Mapping[str, DataFrame]) -> DataFrame:
    return intensity.nc_ratios(intensity.compartment_intensity(inputs["plane_rows"], inputs["labels"], inputs["cyto"]))


@register("rna_only")
def rna_only(inputs: Mapping[str, DataFrame], params: Mapping[str, Any]) -> Tables:
    """One channel: spots in compartments, nuclei and images. Secondary-only images carry no spots unless asked."""
    marked = dict(inputs)
    meta = inputs["images"].select("image", "secondary_only")
    asked = bool(params.get("detect_in_secondary", False))
    spots = inputs["spots"].where(F.col("channel") == "rna1").join(meta, "image")
    marked["spots"] = spotfilters.spots_to_detect(spots, two_channel=False, detect_in_secondary=asked).drop("secondary_only")
    strat = _prepared(marked, params).withColumn("paired", F.lit(0)).withColumn("nn_distance_um", F.lit(None).cast("double"))
    strat = cut_lineage(strat)
    nuclei = rollups.spot_rollup(strat, intensity.nuclei_of(inputs["labels"]), channels=["rna1"])
    return {"spot_metrics": strat, "nuclei_metrics": nuclei, "per_image_summary": rollups.per_image_summary(nuclei, strat)}


@register("rna_rna")
def rna_rna(inputs: Mapping[str, DataFrame], params: Mapping[str, Any]) -> Tables:
    """Two channels: pairing, pixel colocalization and, on request, the position null besides the spot tables.

    Per-nucleus numbers come before the speck and floater filters, the spot table after them.
    """
    paired = neighbours.pair_spots(neighbours.nearest_between_channels(_prepared(inputs, params)), params.get("pair_um", 0.3), "paired")
    spots = cut_lineage(paired)
    labels = inputs["labels"]
    nuclei = cut_lineage(rollups.spot_rollup(spots, intensity.nuclei_of(labels)))
    shown = spotfilters.drop_specks(spots, params.get("max_peak_over_p95_ratio", 0.0))
    if params.get("drop_floater_spots", False):
        shown = spotfilters.drop_floaters(shown)
    tables = {
        "spot_metrics": shown,
        "nuclei_metrics": nuclei,
        "per_image_summary": rollups.per_image_summary(nuclei, spots),
        "intensity": _pixel_table(inputs),
    }
    if "thresholds" in inputs:
        pairs = pair_pixels_in(inputs["plane_rows"], "rna1", "rna2", labels)
        tables["coloc"] = coloc.coloc_metrics(pairs, inputs["thresholds"], ["image", "nucleus_id"], ["image"])
    if params.get("position_null", 0):
        partner = inputs["plane_rows"].where(F.col("channel") == "rna2")
        first = spots.where(F.col("channel") == "rna1")
        draws, obs = nulls.position_null(first, partner, labels, inputs.get("nucleoli"), n=params["position_null"], seed=params.get("seed", 0))
        tables["null_summary"] = nulls.null_summary(draws, obs)
        tables["coloc_null_draws"], tables["coloc_null"] = nulls.pool_draws(draws, obs)
    return tables


@register("rna_protein")
def rna_protein(inputs: Mapping[str, DataFrame], params: Mapping[str, Any]) -> Tables:
    """The two-channel run with its second channel shown as protein."""
    return {name: relabel_channel(df) for name, df in rna_rna(inputs, params).items()}


# Three names of which a run only does the one-channel analysis.
for _name in ("ab_ab", "protein_only", "pub_images"):
    MODES[_name] = rna_only


@register("if_intensity")
def if_intensity(inputs: Mapping[str, DataFrame], params: Mapping[str, Any]) -> Tables:
    """Plate run. With files, plate, plane_rows and labels all of its tables (see ``plate_run``); with `fields` that are
    already quantified their correction, tests and exposure check."""
    if "files" in inputs:
        tables = {k: inputs.get(k) for k in ("files", "plate", "plane_rows", "labels", "exposures", "ring")}
        return plate_run(**tables, **params)
    fields, wells = fov.secondary_correct(inputs["fields"], params.get("n_pixels", 2304 * 2304))
    wells = cut_lineage(wells)
    return {
        "per_fov": fields,
        "per_well": wells,
        "stats": fov.plate_stats(wells),
        "exposure": fov.exposure_check(inputs["fields"], params.get("exposure_tol", 1e-6)),
    }


def footprint_tables(inputs: Mapping[str, DataFrame], spots: DataFrame, default_um: float = 0.3) -> Tables:
    """Half-maximum footprints of the first channel on the second, with association and capacity per nucleus."""
    rows = inputs["plane_rows"]
    a, b = (rows.where(F.col("channel") == c).select("image", "y", "vals") for c in ("rna1", "rna2"))
    marked, pixels = sampling.footprint(spots.where(F.col("channel") == "rna1"), a, b, default_um=default_um)
    marked = cut_lineage(marked)
    partner = flat(b).join(inputs["labels"], ["image", "y", "x"])
    nuclei = partner.groupBy("image", "nucleus_id").agg(F.avg("v").alias("nuc_mean"), F.sum("v").alias("partner_total"))
    return {
        "spots": marked,
        "association": rollups.association(marked, pixels, partner, nuclei),
        "capacity": rollups.capacity(marked, nuclei, default_um),
    }


def quality_tables(per_image: DataFrame, planes: DataFrame, focus: DataFrame, **limits: Any) -> DataFrame:
    return ranges.flag_outliers(ranges.qc_flags(per_image, planes, focus, **limits))
