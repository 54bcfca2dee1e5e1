"""Null models added to a finished run from its stored masks and spots, without running detection again.

Images are dealt into shards by a hash of their name. A shard is recomputed whole, its partition of every
result table is replaced, and its rows in the gate table are written last: they are what says that the
shard is done. A run that was stopped anywhere therefore goes on where a shard has no gate row, and a run
that is complete changes nothing. Results are read through ``backfilled``, which shows only images whose
gate row is there, so a half-written shard is never seen.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from spotframe.functions.scalars import ratio
from spotframe.operators import focus, labels as masks, lookup, nulls, sampling
from spotframe.session import co_partitioned, cut_lineage
from spotframe.sources.tables import read_run

GATE = "coloc_gate"
#: Result tables of each family of nulls.
RESULTS = {
    "position": ("coloc_null_draws", "coloc_null_summary"),
    "radial": ("coloc_radial_profile",),
    "rotation": ("coloc_rotation_null_draws", "coloc_rotation_null_summary"),
    "patch": ("coloc_mean_patch",),
}
#: Half the side of a mean patch in pixels.
PATCH_HALF = 10
# Names under which a run stores its pooled numbers, {} being the name of the partner channel.
STORED = {
    "obs": "{}_pooled_obs_at_rna1_spots",
    "null_mean": "{}_pooled_null_mean_at_rna1_spots",
    "enrichment": "{}_pooled_enrichment_vs_null_at_rna1_spots",
}


def _stored(spark: SparkSession, run: str, table: str) -> DataFrame | None:
    """A table of the run, None where it was never written."""
    try:
        return read_run(spark, run, table)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _replace(df: DataFrame, run: str, table: str) -> None:
    """Write the shards that df holds over those stored; other shards stay as they are. Pooled images become draws where they are written."""
    dealt = df.repartition("shard")
    writer = (_draw_rows(dealt) if "values" in df.columns else dealt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("shard").parquet(f"{run}/{table}")


def image_status(per_image: DataFrame, labels: DataFrame, plane_rows: DataFrame, partner: str) -> DataFrame:
    """(image, condition, status, height, width) of every image of the run.

    status is 'no plane' or 'no mask' where the partner's pixels or the label mask are missing, 'shape' where
    the mask reaches out of the plane, else 'ok'.
    """
    frame = plane_rows.where(F.col("channel") == partner).groupBy("image").agg((F.max("y") + 1).alias("height"), F.max(F.size("vals")).cast("long").alias("width"))
    mask = labels.groupBy("image").agg(F.max("y").alias("_y"), F.max("x").alias("_x"))
    known = per_image.where(F.col("image").isNotNull()).groupBy("image").agg(F.min("condition").alias("condition"))
    status = (
        F.when(F.col("height").isNull(), "no plane")
        .when(F.col("_y").isNull(), "no mask")
        .when((F.col("_y") >= F.col("height")) | (F.col("_x") >= F.col("width")), "shape")
        .otherwise("ok")
    )
    return known.join(frame, "image", "left").join(mask, "image", "left").select("image", "condition", status.alias("status"), "height", "width")


def analysis_planes(plane_rows: DataFrame, channels: Sequence[str], z_start: int | None = None, z_end: int | None = None, intensity_weighted: bool = False) -> DataFrame:
    """Rows of the named channels at each image's sharpest slice of the first one.

    A window bound beyond the stack is brought back to it, as the run did it.
    """
    rows = plane_rows.where(F.col("channel").isin(*channels))
    if "z" not in rows.columns:
        return rows
    stack = rows.where(F.col("channel") == channels[0])
    depth = stack.groupBy("image").agg(F.min("z").alias("_lo"), F.max("z").alias("_hi"))
    low, high = F.col("_lo"), F.col("_hi")
    if z_start is not None:
        low = F.when(F.lit(z_start) > F.col("_hi"), F.col("_lo")).otherwise(F.greatest(F.col("_lo"), F.lit(z_start)))
    if z_end is not None:
        high = F.least(F.col("_hi"), F.lit(z_end))
    inside = stack.join(depth, "image").where((F.col("z") >= low) & (F.col("z") <= high)).drop("_lo", "_hi")
    best = focus.best_plane(focus.focus_scores(inside, intensity_weighted=intensity_weighted), ("image",))
    return rows.join(best, ["image", "z"]).drop("z")


def _pooled(pooled: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(summary of pooled images under the run's column names, the plain summary)."""
    draws = nulls.image_draws(pooled)
    plain = cut_lineage(nulls.null_summary(draws, None, ["image"]).join(pooled.select("image", F.col("n_nuclei").alias("n_nuclei_used")), "image"))
    summary = plain.select(
        "image", F.col("obs").alias("pooled_obs"), F.col("null_mean").alias(f"pooled_{prefix}null_mean"), F.col("null_sd").alias(f"pooled_{prefix}null_sd"),
        F.col("enrichment").alias(f"pooled_{prefix}{'' if prefix else 'null_'}enrichment"), F.col("z").alias(f"pooled_{prefix}null_z"),
        F.col("p").alias(f"pooled_{prefix}{'' if prefix else 'null_'}p_empirical"), "n_nuclei_used",
    )
    return summary, plain


def _draw_rows(images: DataFrame) -> DataFrame:
    """The draws of pooled images under the run's column names, with iterations from 0."""
    out = nulls.image_draws(images)
    keep = [c for c in out.columns if c not in ("iter", "value", "obs")]
    return out.select(*keep, (F.col("iter") - 1).alias("iter"), F.col("value").alias("pooled_null_value"), F.col("obs").alias("pooled_obs"))


def _in_run(summary: DataFrame) -> DataFrame:
    """The run's stored pooled numbers under the names that the gate reads; missing ones are NULL."""
    names = {f"{p}_{field}": name.format(p) for field, name in STORED.items() for p in ("protein", "rna2")}
    return summary.select("image", *[(F.col(old) if old in summary.columns else F.lit(None)).cast("double").alias(new) for new, old in names.items()])


def backfill(
    spark: SparkSession,
    run: str,
    plane_rows: DataFrame | None = None,
    families: Sequence[str] = ("position", "radial"),
    channels: tuple[str, str, str] = ("dapi", "rna1", "rna2"),
    n: int = 1000,
    disk_px: float = 3.0,
    bins_um: Sequence[float] = (0.25, 0.5, 0.75, 1.0),
    voxel_xy_um: float = 0.13,
    z_window: tuple[int | None, int | None] = (None, None),
    intensity_weighted: bool = False,
    exclude_nucleoli: bool = True,
    nucleolus: Mapping[str, Any] | None = None,
    min_retention: float = 0.5,
    seed: int = 0,
    tol_rel: float = 0.02,
    shards: int = 64,
    wave: int = 16,
) -> dict[str, int]:
    """Add the null models to the run stored below ``run`` and hold them against its own numbers.

    The run has the tables ``per_image_summary`` (image, condition, pooled numbers), ``spot_metrics`` (image,
    channel, spot_id, nucleus_id, y_px, x_px) and ``labels`` (image, y, x, nucleus_id), and ``plane_rows``
    unless it is given; a stored table ``nucleoli`` is used where it is there, else nucleoli are found again
    on the analysis plane. Images without pixels or mask, or with a mask that does not fit, are
    recorded with their status and left out; they are taken up once their input is there. Other settings make a
    shard be computed again. Work goes wave by wave, so many shards each; a lost run repeats one wave at most.

    Returns counts: images of the run, images computed now, images that pass and fail the gate.
    """
    if unknown := set(families) - set(RESULTS):
        raise ValueError(f"unknown null families {sorted(unknown)}; known are {sorted(RESULTS)}")
    settings = json.dumps(
        {"families": sorted(families), "channels": channels, "n": n, "disk_px": disk_px, "bins_um": list(bins_um), "voxel_xy_um": voxel_xy_um, "z": z_window,
         "intensity_weighted": intensity_weighted, "exclude_nucleoli": exclude_nucleoli, "nucleolus": dict(nucleolus or {}), "min_retention": min_retention,
         "seed": seed, "tol_rel": tol_rel, "shards": shards}, sort_keys=True,
    )
    # every join of a backfill has the image among its keys
    with co_partitioned(spark):
        return _run_waves(spark, run, plane_rows, families, channels, n, disk_px, bins_um, voxel_xy_um, z_window, intensity_weighted, exclude_nucleoli, nucleolus, min_retention, seed, tol_rel, shards, wave, settings)


def _run_waves(spark, run, plane_rows, families, channels, n, disk_px, bins_um, voxel_xy_um, z_window, intensity_weighted, exclude_nucleoli, nucleolus, min_retention, seed, tol_rel, shards, wave, settings) -> dict[str, int]:
    dapi, first, partner = channels
    per_image, spots, labels = (read_run(spark, run, t) for t in ("per_image_summary", "spot_metrics", "labels"))
    planes = read_run(spark, run, "plane_rows") if plane_rows is None else plane_rows
    found = _stored(spark, run, "nucleoli")
    shard = F.pmod(F.xxhash64("image"), F.lit(shards)).cast("int")
    status = cut_lineage(image_status(per_image, labels, planes, partner).withColumn("shard", shard))

    done = _stored(spark, run, GATE)
    if done is None:
        pending = status
    else:
        done = done.where(F.col("settings") == settings).select("image", "status")
        pending = status.join(done, ["image", "status"], "left_anti")
    # at most as many rows as there are shards
    todo = sorted(r[0] for r in pending.select("shard").distinct().collect())
    computed = 0
    for at in range(0, len(todo), wave):
        mine = cut_lineage(status.where(F.col("shard").isin(todo[at : at + wave])))
        ready = mine.where(F.col("status") == "ok").select("image", "height", "width")
        here = lambda df: df.join(ready.select("image"), "image", "left_semi")
        again = exclude_nucleoli and found is None
        chosen = analysis_planes(here(planes), (dapi, partner), *z_window, intensity_weighted)
        chosen = cut_lineage(chosen if again else chosen.where(F.col("channel") == partner))
        # whole images, so that the nuclei of an image are cut out and added up in one task
        plane = chosen.where(F.col("channel") == partner).select("image", "y", "vals").repartition("image")
        nuclei = here(labels)
        holes = None
        if exclude_nucleoli:
            stain = chosen.where(F.col("channel") == dapi).select("image", "y", "vals")
            holes = cut_lineage(masks.detect_nucleoli(stain, nuclei, ready, voxel_xy_um, **(nucleolus or {}))) if again else here(found)
        inside = nuclei.select("image", "nucleus_id").distinct()
        own = cut_lineage(here(spots).where((F.col("channel") == first) & (F.col("nucleus_id") >= 1)).join(inside, ["image", "nucleus_id"], "left_semi"))
        named = mine.select("image", "condition", "shard")
        recomputed = None
        for family, frame in _families(families, own, plane, nuclei, holes, n, disk_px, bins_um, voxel_xy_um, min_retention, seed):
            for table, df in frame.items():
                if table == "plain":
                    recomputed = df if family == "position" else recomputed
                else:
                    _replace(named.join(df, "image"), run, table)
        _replace(_gate(mine, per_image, recomputed, tol_rel, settings), run, GATE)
        computed += ready.count()
    counts = read_run(spark, run, GATE).agg(F.count(F.lit(1)), F.count(F.when(F.col("passed"), 1)), F.count(F.when(~F.col("passed"), 1))).first()
    return {"images": counts[0], "computed": computed, "passed": counts[1], "failed": counts[2]}


def _families(families, spots, plane, labels, holes, n, disk_px, bins_um, voxel_xy_um, min_retention, seed):
    """(family, {table: rows}) one after the other, so that a family is written before the next is planned."""
    if "position" in families:
        pooled = nulls.pooled_position_null(spots, plane, labels, holes, n, disk_px, seed)
        summary, plain = _pooled(pooled, "")
        yield "position", {"coloc_null_draws": pooled, "coloc_null_summary": summary, "plain": plain}
    if "radial" in families:
        radial = nulls.radial_null(spots, plane, labels, holes, n, bins_um, voxel_xy_um, seed)
        yield "radial", {"coloc_radial_profile": nulls.pool_radial(radial).select("image", "ring_um", "obs_mean", "null_mean", "null_sd", "enrichment", "z", "n_spots")}
    if "rotation" in families:
        pooled = nulls.pooled_rotation_null(spots, plane, labels, holes, n, disk_px, min_retention, seed=seed)
        yield "rotation", {"coloc_rotation_null_draws": pooled, "coloc_rotation_null_summary": _pooled(pooled, "rotation_")[0]}
    if "patch" in families:
        seen = nulls.observed_spots(spots, plane, holes)
        there = nulls.matched_random(seen, nulls.sampling_region(labels, holes), seed).select(*nulls.KEY, F.col("y").alias("cy"), F.col("x").alias("cx"))
        kinds = [sampling.mean_patch(points, plane, labels, PATCH_HALF).withColumn("kind", F.lit(kind)) for kind, points in (("spots", seen), ("random", there))]
        yield "patch", {"coloc_mean_patch": kinds[0].unionByName(kinds[1]).select("image", "kind", "dy", "dx", "value", "n")}


def _gate(mine: DataFrame, per_image: DataFrame, recomputed: DataFrame | None, tol_rel: float, settings: str) -> DataFrame:
    """One row per image of the wave; passed is NULL where there is nothing to hold against the run."""
    rows = mine.select("image", "condition", "status", "shard").withColumn("settings", F.lit(settings))
    fields = ("obs", "null_mean", "enrichment")
    if recomputed is None:
        return rows.withColumns({f"{kind}{f}": F.lit(None).cast("double") for f in fields for kind in ("", "stored_", "d_")}).withColumn("passed", F.lit(None).cast("boolean"))
    held = lookup.gate(recomputed, _in_run(per_image), tol_rel)
    return rows.join(held.select("image", *[f"{kind}{f}" for f in fields for kind in ("", "stored_", "d_")], "passed"), "image", "left")


def backfilled(spark: SparkSession, run: str, table: str) -> DataFrame:
    """A result table of the run: the rows of images whose shard is complete."""
    ready = read_run(spark, run, GATE)
    if table == GATE:
        return ready.drop("shard", "settings")
    return read_run(spark, run, table).drop("shard").join(ready.where(F.col("status") == "ok").select("image"), "image", "left_semi")


def pooled_patch(patches: DataFrame) -> DataFrame:
    """(kind, dy, dx, value, n): mean patches of all images, weighted by their spots."""
    weight = F.col("n")
    return patches.groupBy("kind", "dy", "dx").agg(ratio(F.sum(F.col("value") * weight), F.sum(weight)).alias("value"), F.sum(weight).alias("n"))
