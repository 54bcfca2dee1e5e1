"""Row filters on spots and nuclei."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.functions.ranks import quantiles


def floor_spots(spots: DataFrame, floors: DataFrame) -> DataFrame:
    """Keep peaks at or above their channel's floor; a NULL or non-positive floor keeps all.

    Floors are one row per channel, so they are sent to the spots: shuffled by channel, a task would hold a whole channel.
    """
    open_floor = F.col("floor").isNull() | (F.col("floor") <= 0)
    return spots.join(F.broadcast(floors), "channel", "left").where(open_floor | (F.col("peak") >= F.col("floor"))).drop("floor")


def drop_specks(spots: DataFrame, max_peak_over_p95_ratio: float = 0.0) -> DataFrame:
    """Drop peaks far above the 95th percentile of their image and channel; ratio 0 keeps all."""
    if max_peak_over_p95_ratio <= 0:
        return spots
    keys = ["image", "channel"]
    p95 = quantiles(spots, "peak", keys, {"_p95": 0.95})
    kept = F.col("peak").isNotNull() & (F.col("peak") <= F.col("_p95") * max_peak_over_p95_ratio + 1e-9)
    return spots.join(p95, keys).where(kept).drop("_p95")


def drop_floaters(spots: DataFrame) -> DataFrame:
    return spots.where(F.col("in_nucleus") | F.col("in_cytoplasm"))


def drop_ghosts(
    nuclei: DataFrame, labels: DataFrame, spots: DataFrame, max_cv: float = 0.12, min_area: float = 6000
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remove large, flat, spotless nuclei with their label pixels and spots.

    A nucleus with an unknown DAPI variation is kept.
    """
    ghost = (F.col("n_spots") == 0) & (F.col("area_px") >= min_area) & (F.col("dapi_cv") <= max_cv)
    ghosts = nuclei.where(ghost).select("image", "nucleus_id")
    key = ["image", "nucleus_id"]
    return (
        nuclei.where(~F.coalesce(ghost, F.lit(False))),
        labels.join(ghosts, key, "left_anti"),
        spots.join(ghosts, key, "left_anti"),
    )


def drop_secondary(df: DataFrame, flag_col: str = "secondary_only", condition_col: str = "condition") -> DataFrame:
    """Leave out secondary-only rows: by the flag column where present, else by the label."""
    if flag_col in df.columns:
        return df.where(~F.coalesce(F.col(flag_col), F.lit(False)))
    return df.where(~F.coalesce(F.lower(condition_col).contains("sec"), F.lit(False)))


def spots_to_detect(spots: DataFrame, two_channel: bool, detect_in_secondary: bool = False) -> DataFrame:
    """Single-channel runs skip secondary-only images unless asked; two-channel runs never skip them."""
    return spots if two_channel or detect_in_secondary else drop_secondary(spots)


def mask_below(planes: DataFrame, thr: float | Column) -> DataFrame:
    return planes.withColumn("v", F.when(F.col("v") >= thr, F.col("v")).otherwise(F.lit(0.0)))


def above_floor(planes: DataFrame, floor: float | Column) -> DataFrame:
    return planes.withColumn("v", F.greatest(F.col("v") - floor, F.lit(0.0)))


def positive_mask(planes: DataFrame, thr: float | Column) -> DataFrame:
    return planes.withColumn("positive", F.col("v") >= thr)


def stretch(planes: DataFrame, lo: float | None, hi: float | None) -> DataFrame:
    """Intensities scaled to [0, 1]; a missing bound is the image's own extreme."""
    keys = ["image", "channel"]
    out = planes
    if lo is None or hi is None:
        bounds = planes.groupBy(*keys).agg(F.min("v").alias("_min"), F.max("v").alias("_max"))
        out = planes.join(bounds, keys)
    low = F.lit(lo) if lo is not None else F.col("_min")
    high = F.lit(hi) if hi is not None else F.col("_max")
    scaled = F.when(high > low, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("v") - low) / (high - low)))).otherwise(F.lit(0.0))
    return out.withColumn("v", scaled).drop("_min", "_max")


def stretch_guarded(planes: DataFrame, lo: float, hi: float, fallback: tuple[float, float] = (0.02, 0.995)) -> DataFrame:
    """As ``stretch``; where hi <= lo the image's own percentiles are used instead."""
    keys = ["image", "channel"]
    if hi > lo:
        return stretch(planes, lo, hi)
    bounds = quantiles(planes, "v", keys, {"_lo": fallback[0], "_hi": fallback[1]})
    span = F.col("_hi") - F.col("_lo")
    scaled = F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("v") - F.col("_lo")) / span))).otherwise(F.lit(0.0))
    return planes.join(bounds, keys).withColumn("v", scaled).drop("_lo", "_hi")
