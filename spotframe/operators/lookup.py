"""Point lookups and attachments: spots to labels, extra columns to nuclei, plates to wells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.operators.runs import id_at, rows_of_runs


def _clamp(c: Column, size: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(c.cast("long"), size.cast("long") - 1))


def _over_rows(spots: DataFrame, masks: Sequence[DataFrame], images: DataFrame, y: Column, x: Column) -> DataFrame:
    """spots with _x and the runs of the masks in their image row (_cells); positions are clamped into the frame."""
    frame = images.select("image", "height", "width")
    placed = spots.join(frame, "image").withColumn("_y", _clamp(y, F.col("height"))).withColumn("_x", _clamp(x, F.col("width"))).drop("height", "width")
    rows = rows_of_runs(masks).select("image", F.col("y").alias("_y"), F.col("cells").alias("_cells"))
    return placed.join(rows, ["image", "_y"], "left").drop("_y")


def stratify_spots(spots: DataFrame, labels: DataFrame, cyto: DataFrame, images: DataFrame) -> DataFrame:
    """Nucleus under each spot, else the nucleus owning the cytoplasm under it.

    Positions are truncated to a pixel and clamped into the frame. nucleus_id is 0 off every cell. Masks may be
    runs, label rows or pixels (see ``runs``); nuclei and rims of an image row meet its spots in one join.
    """
    over = _over_rows(spots, [labels, cyto], images, F.col("y_px"), F.col("x_px"))
    found = over.withColumn("_nuc", id_at(F.col("_cells"), F.col("_x"), 0)).withColumn("_cyto", id_at(F.col("_cells"), F.col("_x"), 1))
    in_nucleus = F.coalesce(F.col("_nuc"), F.lit(0)) > 0
    in_cyto = ~in_nucleus & (F.coalesce(F.col("_cyto"), F.lit(0)) > 0)
    return (
        found.withColumn("nucleus_id", F.when(in_nucleus, F.col("_nuc")).when(in_cyto, F.col("_cyto")).otherwise(F.lit(0)))
        .withColumn("in_nucleus", in_nucleus)
        .withColumn("in_cytoplasm", in_cyto)
        .drop("_nuc", "_cyto", "_cells", "_x")
    )


def classify_nucleolus(spots: DataFrame, nucleoli: DataFrame, images: DataFrame) -> DataFrame:
    """Whether a spot sits in a nucleolus; positions are rounded half-even here."""
    over = _over_rows(spots, [nucleoli], images, F.rint("y_px"), F.rint("x_px"))
    return (
        over.withColumn("in_nucleolus", id_at(F.col("_cells"), F.col("_x"), 0).isNotNull())
        .withColumn("in_nucleus_excluding_nucleolus", F.col("in_nucleus") & ~F.col("in_nucleolus"))
        .drop("_cells", "_x")
    )


def attach(nuclei: DataFrame, extra: DataFrame, keys: Sequence[str], fill: Mapping[str, float] | None = None) -> DataFrame:
    """Left join of extra per-key columns; listed columns are filled where no row matches."""
    out = nuclei.join(extra, list(keys), "left")
    return out.fillna(dict(fill)) if fill else out


def join_plate(manifest: DataFrame, plate: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files of wells on the plate with its columns, files of unknown wells)."""
    return manifest.join(plate, "well"), manifest.join(plate, "well", "left_anti")


def gate(recomputed: DataFrame, stored: DataFrame, tol_rel: float = 0.02) -> DataFrame:
    """Relative error of recomputed pooled values against stored ones, per image.

    Stored tables name the partner channel 'protein' or 'rna2'; the first present value wins.
    """
    fields = ("obs", "null_mean", "enrichment")

    def stored_value(field: str) -> Column:
        names = [f"{prefix}_{field}" for prefix in ("protein", "rna2") if f"{prefix}_{field}" in stored.columns]
        return F.coalesce(*[F.col(n) for n in names])

    kept = stored.select("image", *[stored_value(f).alias(f"stored_{f}") for f in fields])
    joined = recomputed.select("image", *fields).join(kept, "image")
    out = joined
    for f in fields:
        error = F.when(F.col(f"stored_{f}") != 0, F.abs(F.col(f) - F.col(f"stored_{f}")) / F.abs(F.col(f"stored_{f}")))
        out = out.withColumn(f"d_{f}", error)
    ok = [F.coalesce(F.col(f"d_{f}") <= tol_rel, F.lit(False)) for f in fields]
    return out.withColumn("passed", ok[0] & ok[1] & ok[2])
