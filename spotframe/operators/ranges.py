"""Display ranges (floor, ceiling) pooled over images, and quality flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.functions.ranks import median_and_mad, quantiles, quantiles_of_counts, value_counts
from spotframe.operators.thresholds import GAUSSIAN_MAD
from spotframe.session import cut_lineage


def _guarded(lo: Column, hi: Column) -> Column:
    return F.when(hi <= lo, lo + 1.0).otherwise(hi)


def pooled_range(
    pixels: DataFrame, floor_pct: float, ceil_pct: float, bump_pct: float = 0.0, dapi: tuple[float, float] = (10.0, 99.9)
) -> DataFrame:
    """(channel, lo, hi) over the pixels of all images; signal floors may be raised by a percentage."""
    is_dapi = F.col("channel") == "dapi"
    marked = pixels.withColumn("_f", F.when(is_dapi, dapi[0] / 100).otherwise(floor_pct / 100)).withColumn(
        "_c", F.when(is_dapi, dapi[1] / 100).otherwise(ceil_pct / 100)
    )
    q = quantiles(marked, "v", ["channel", "_f", "_c"], {"lo": "_f", "hi": "_c"})
    raised = F.when(~is_dapi & (F.col("lo") > 0), F.col("lo") * (1.0 + bump_pct / 100.0)).otherwise(F.col("lo"))
    out = q.withColumn("lo", raised).withColumn("hi", _guarded(F.col("lo"), F.col("hi")))
    return out.where(F.col("channel").isNotNull()).select("channel", "lo", "hi")


def reference_range(pixels: DataFrame, floor_region: str, ceil_region: str, floor_pct: float, ceil_pct: float) -> DataFrame:
    """(channel, lo, hi) from one reference image's regions.

    pixels (channel, region, v) with region 'nucleus', 'cytoplasm' or 'background'. A ceiling not above
    the floor falls back to the whole image's 99.9th percentile where that clears the floor by a fifth,
    then to the maximum. A channel with an empty region is left out.
    """
    # pixels are read once; where they were joined to their regions image by image, they are counted where they stand
    counts = cut_lineage(value_counts(pixels, "v", ["channel", "region"]), True)

    def of(region: str) -> DataFrame:
        mine = counts if region == "all" else counts.where(F.col("region") == region)
        return mine.groupBy("channel", "v").agg(F.sum("n").alias("n"))

    lo = quantiles_of_counts(of(floor_region), ["channel"], {"lo": floor_pct / 100})
    hi = quantiles_of_counts(of(ceil_region), ["channel"], {"hi": ceil_pct / 100})
    whole = quantiles_of_counts(of("all"), ["channel"], {"p999": 0.999, "top": 1.0})
    ceiling = F.when(F.col("hi") > F.col("lo"), F.col("hi")).when(F.col("p999") > 1.2 * F.col("lo"), F.col("p999")).otherwise(F.col("top"))
    return lo.join(hi, "channel").join(whole, "channel").select("channel", "lo", ceiling.alias("hi"))


def manual_range(bounds: DataFrame) -> DataFrame:
    """Given (channel, lo, hi) rows; incomplete ones are dropped and hi kept above lo."""
    complete = bounds.where(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    return complete.withColumn("hi", _guarded(F.col("lo"), F.col("hi")))


def scoped_value(mapping: Mapping[str, float], secondary: Column, source: str) -> Column:
    """Value for a secondary; a 'secondary:source' entry wins over a bare one."""
    exact = F.lit(None).cast("double")
    bare = F.lit(None).cast("double")
    for key, value in mapping.items():
        name, _, scope = key.partition(":")
        if scope == source:
            exact = F.when(secondary == name, F.lit(float(value))).otherwise(exact)
        elif not scope:
            bare = F.when(secondary == name, F.lit(float(value))).otherwise(bare)
    return F.coalesce(exact, bare)


def shared_range(
    pixels: DataFrame,
    source: str = "window",
    ceil_pct: float = 99.5,
    floor_pct: float = 99.0,
    floors: Mapping[str, float] | None = None,
    ceilings: Mapping[str, float] | None = None,
) -> DataFrame:
    """(secondary, lo, hi): ceiling from primary wild-type wells, floor from secondary-only wells.

    pixels (secondary, arm, genotype, v). Explicit bounds win. An inverted range becomes the wild-type
    2nd and 99.5th percentiles.
    """
    wt = pixels.where((F.col("arm") == "primary") & (F.col("genotype") == "WT"))
    sec = pixels.where(F.col("arm") == "seconly")
    top = quantiles(wt, "v", ["secondary"], {"hi": ceil_pct / 100, "p1": 0.01, "p2": 0.02, "p995": 0.995})
    bottom = quantiles(sec, "v", ["secondary"], {"sec_lo": floor_pct / 100})
    which = F.col("secondary")
    given_lo, given_hi = scoped_value(floors or {}, which, source), scoped_value(ceilings or {}, which, source)
    lo, hi = F.coalesce(given_lo, "sec_lo", "p1"), F.coalesce(given_hi, "hi")
    inverted = hi <= lo
    return top.join(bottom, "secondary", "left").select(
        "secondary", F.when(inverted, F.col("p2")).otherwise(lo).alias("lo"), F.when(inverted, F.col("p995")).otherwise(hi).alias("hi")
    )


def dapi_range(pixels: DataFrame, floor: float | None = None, ceiling: float | None = None) -> DataFrame:
    """(image, lo, hi) of the nuclear stain: a fixed bound where one is given, else the image's own; its own range where they cross.

    pixels (image, v).
    """
    own = pixels.groupBy("image").agg(F.min("v").alias("_a"), F.max("v").alias("_b"))
    lo = F.col("_a") if floor is None else F.lit(float(floor))
    hi = F.col("_b") if ceiling is None else F.lit(float(ceiling))
    crossed = hi <= lo
    return own.select("image", F.when(crossed, F.col("_a")).otherwise(lo).alias("lo"), F.when(crossed, F.col("_b")).otherwise(hi).alias("hi"))


def per_image_ceiling(pixels: DataFrame, lo: DataFrame, ceil_pct: float = 99.5) -> DataFrame:
    """(image, lo, hi): each image's own percentile above its secondary's floor, with the usual guards."""
    q = quantiles(pixels, "v", ["image", "secondary"], {"own": ceil_pct / 100, "p999": 0.999})
    joined = q.join(lo.select("secondary", "lo"), "secondary")
    hi = F.when(F.col("own") > F.col("lo"), F.col("own")).when(F.col("p999") > F.col("lo"), F.col("p999")).otherwise(F.col("lo") + 1.0)
    return joined.select("image", "lo", hi.alias("hi"))


def qc_flags(
    per_image: DataFrame,
    planes: DataFrame,
    focus: DataFrame,
    full_scale: float = 65535.0,
    saturated: float = 0.01,
    min_focus: float = 0.0,
    min_nuclei: int = 5,
    max_spots_per_nucleus: float = 300.0,
) -> DataFrame:
    """Per-image quality columns and the ordered, comma-joined list of raised flags.

    per_image (image, n_nuclei, n_spots, spots_per_nucleus); planes (image, channel, v); focus (image, focus_score).
    """
    roles = ("dapi", "rna1", "rna2")
    bright = planes.groupBy("image").agg(
        *[
            F.avg(F.when(F.col("channel") == r, F.when(F.col("v") >= 0.999 * full_scale, 1.0).otherwise(0.0))).alias(f"qc_frac_saturated_{r}")
            for r in roles
        ]
    )
    out = per_image.join(bright, "image", "left").join(focus.withColumnRenamed("focus_score", "qc_focus_score"), "image", "left")
    spots_per = F.coalesce(F.col("spots_per_nucleus"), F.when(F.col("n_nuclei") > 0, F.col("n_spots") / F.col("n_nuclei")))
    out = out.withColumn("qc_rna1_spots_per_nucleus", spots_per)
    flags = [F.when(F.col(f"qc_frac_saturated_{r}") > saturated, F.lit(f"saturated_{r}")) for r in roles]
    if min_focus > 0:
        flags.append(F.when(F.col("qc_focus_score") < min_focus, F.lit("low_focus")))
    flags += [
        F.when(F.col("n_nuclei") < min_nuclei, F.lit("low_nuclei")),
        F.when(F.col("n_spots") == 0, F.lit("zero_spot")),
    ]
    if max_spots_per_nucleus > 0:
        flags.append(F.when(F.col("qc_rna1_spots_per_nucleus") > max_spots_per_nucleus, F.lit("overdetect_rna1")))
    return out.withColumn("qc_flags", F.concat_ws(",", *flags)).withColumn("qc_pass", F.col("qc_flags") == "")


def flag_outliers(per_image: DataFrame, v: str = "qc_rna1_spots_per_nucleus", k: float = 5.0, floor: float = 50.0) -> DataFrame:
    """Flag images far above the run's median; needs three values and a positive MAD."""
    level = median_and_mad(per_image, v, []).withColumn("_one", F.lit(1))
    n = per_image.agg(F.count(v).alias("_n")).withColumn("_one", F.lit(1))
    limits = level.join(n, "_one").where((F.col("_n") >= 3) & (F.col("mad") > 0)).select("_one", (F.col("med") + k * GAUSSIAN_MAD * F.col("mad")).alias("_cut"))
    # one row of limits for the whole run
    joined = per_image.withColumn("_one", F.lit(1)).join(F.broadcast(limits), "_one", "left")
    hit = F.coalesce((F.col(v) > F.col("_cut")) & (F.col(v) > floor), F.lit(False))
    tag = F.lit("overdetect_rna1_outlier")
    flags = F.when(hit, F.concat_ws(",", F.when(F.col("qc_flags") != "", F.col("qc_flags")), tag)).otherwise(F.col("qc_flags"))
    return (
        joined.withColumn("run_outlier", hit)
        .withColumn("qc_flags", flags)
        .withColumn("qc_pass", F.col("qc_pass") & ~F.col("run_outlier"))
        .drop("_one", "_cut")
    )
