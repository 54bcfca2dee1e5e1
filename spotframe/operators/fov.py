"""Field and well tables of plate runs: quantification, background correction, tests, exposure and conflict checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.functions.scalars import ratio
from spotframe.operators.frames import flat, pixels_in
from spotframe.operators.stats import long_table, welch
from spotframe.sources.manifest import normal_secondary

FIELD = ["image"]


def quantify_fov(plane_rows: DataFrame, labels: DataFrame, ring: DataFrame, signal: str, dapi: str) -> tuple[DataFrame, DataFrame]:
    """(field table, nucleus table): whole-field and per-nucleus signal, ring signal and their ratio."""
    px = flat(plane_rows)
    whole = px.groupBy("image").agg(
        *[f(F.when(F.col("channel") == c, F.col("v"))).alias(f"{n}_{k}") for c, k in ((signal, "signal"), (dapi, "dapi")) for f, n in ((F.avg, "mean"), (F.sum, "total"))]
    )
    sig = plane_rows.where(F.col("channel") == signal).drop("channel")
    key = ["image", "nucleus_id"]
    nuc = pixels_in(sig, labels.select("image", "y", "x", "nucleus_id")).groupBy(*key).agg(F.count(F.lit(1)).alias("area_px"), F.avg("v").alias("mean"), F.sum("v").alias("integrated"))
    rim = pixels_in(sig, ring.select("image", "y", "x", F.col("cyto_id").alias("nucleus_id"))).groupBy(*key).agg(F.avg("v").alias("cyto_mean"))
    nuclei = nuc.join(rim, key, "left").withColumn("nuc_over_cyto", F.when(F.col("cyto_mean") != 0, F.col("mean") / F.col("cyto_mean")))
    per = nuclei.groupBy("image").agg(
        F.count(F.lit(1)).alias("nucleus_count"), F.avg("mean").alias("nuc_mean"), F.avg("integrated").alias("nuc_integrated"),
        F.avg("cyto_mean").alias("cyto_mean"), F.avg("nuc_over_cyto").alias("nuc_over_cyto"),
    )
    fields = whole.join(per, "image", "left").fillna(0, ["nucleus_count"]).withColumn("ratio", ratio(F.col("mean_signal"), F.col("mean_dapi")))
    return fields, nuclei


def secondary_pool(fov: DataFrame, n_pixels: int) -> DataFrame:
    """(genotype, channel): mean secondary-only signal and its per-nucleus base."""
    sec = fov.where(F.col("arm") == "seconly")
    counted = F.col("nucleus_count") > 0
    base = F.sum(F.when(counted, F.col("qki_mean"))) * n_pixels / F.sum(F.when(counted, F.col("nucleus_count")))
    return sec.groupBy("genotype", "channel").agg(
        F.avg("qki_mean").alias("sec_qki_mean"), F.avg("ratio").alias("sec_ratio"), base.alias("sec_m1_base")
    )


def secondary_correct(fov: DataFrame, n_pixels: int) -> tuple[DataFrame, DataFrame]:
    """(fields with background-corrected and fold columns, well means with the fold over matching secondary-only wells).

    fov (well, fov, genotype, arm, secondary, channel, qki_mean, dapi_mean, ratio, nucleus_count).
    """
    pool = secondary_pool(fov, n_pixels)
    fields = (
        fov.join(pool, ["genotype", "channel"], "left")
        .withColumn("m1_pn", ratio((F.col("qki_mean") - F.col("sec_qki_mean")) * n_pixels, F.col("nucleus_count")))
        .withColumn("ratio_bgcorr", F.col("ratio") - F.col("sec_ratio"))
        .withColumn("fold_qki_mean", F.when(F.col("sec_qki_mean") != 0, F.col("qki_mean") / F.col("sec_qki_mean")))
        .withColumn("fold_ratio", F.when(F.col("sec_ratio") != 0, F.col("ratio") / F.col("sec_ratio")))
    )
    metrics = ["qki_mean", "dapi_mean", "ratio", "nucleus_count", "m1_pn", "ratio_bgcorr", "fold_qki_mean", "fold_ratio"]
    wells = fields.groupBy("well", "genotype", "arm", "secondary", "channel").agg(F.count(F.lit(1)).alias("n_fov"), *[F.avg(m).alias(m) for m in metrics])
    matched = wells.where(F.col("arm") == "seconly").groupBy("genotype", "secondary").agg(F.avg("qki_mean").alias("_q"), F.avg("ratio").alias("_r"))
    primary = F.col("arm") == "primary"
    wells = (
        wells.join(matched, ["genotype", "secondary"], "left")
        .withColumn("wellfold_qki_mean", F.when(primary, ratio(F.col("qki_mean"), F.col("_q"))))
        .withColumn("wellfold_ratio", F.when(primary, ratio(F.col("ratio"), F.col("_r"))))
        .drop("_q", "_r")
    )
    return fields, wells


def plate_stats(wells: DataFrame, raw: Sequence[str] = ("qki_mean", "ratio", "m1_pn"), folds: Sequence[str] = ("wellfold_qki_mean", "wellfold_ratio"), with_p: bool = True) -> DataFrame:
    """Welch tests over wells: WT against KO per secondary, primary against secondary-only, and pooled folds."""
    keys = ["analysis", "secondary", "genotype", "metric"]
    every = lambda df, name, sec, geno: df.select(F.lit(name).alias("analysis"), sec.alias("secondary"), geno.alias("genotype"), "metric", F.col("side"), "v")
    primary = wells.where(F.col("arm") == "primary")
    a = long_table(primary.withColumn("side", F.col("genotype")), raw, ["secondary", "side"])
    b = long_table(wells.withColumn("side", F.when(F.col("arm") == "primary", "WT").otherwise("KO")), list(raw)[:2], ["secondary", "genotype", "side"])
    c = long_table(primary.withColumn("side", F.col("genotype")), folds, ["side"])
    rows = (
        every(a, "per_secondary_raw", F.col("secondary"), F.lit("both"))
        .unionByName(every(b, "primary_vs_seconly", F.col("secondary"), F.col("genotype")))
        .unionByName(every(c, "pooled_fold", F.lit("pooled"), F.lit("both")))
    )
    return welch(rows, "v", "side", "WT", "KO", keys, with_p)


def exposure_check(fov: DataFrame, tol: float = 1e-6, dapi: str = "dapi") -> DataFrame:
    """(channel, lowest, highest, n_fov, exposures, status): exposures of a channel agree within a tolerance.

    With a column exp_dapi_s the nuclear stain of all fields is one more row, named <dapi>(DAPI). ``exposures`` lists the
    different settings of a plate's channel, in order.
    """

    def agree(rows: DataFrame, channel: Column, exposure: str) -> DataFrame:
        lo, hi = F.min(exposure), F.max(exposure)
        return rows.groupBy(channel.alias("channel")).agg(
            lo.alias("lowest"), hi.alias("highest"), F.count(F.lit(1)).alias("n_fov"), F.sort_array(F.collect_set(exposure)).alias("exposures"),
            F.when(lo.isNull() | (hi - lo <= tol), "OK").otherwise("MISMATCH").alias("status"),
        )

    out = agree(fov, F.col("channel"), "exp_qki_s")
    return out.unionByName(agree(fov, F.lit(f"{dapi}(DAPI)"), "exp_dapi_s")) if "exp_dapi_s" in fov.columns else out


def conflict_check(fov: DataFrame, plate: DataFrame, channels: Sequence[str], overrides: Mapping[int, str], channel_map: Mapping[str, str]) -> DataFrame:
    """Per override well: the brighter signal channel, the reference secondary-only wells and the verdict.

    fov carries mean_<channel> per field.
    """
    names = [f"mean_{c}" for c in channels]
    means = fov.groupBy("well").agg(*[F.avg(n).alias(n) for n in names])
    carrier: dict[str, str] = {}
    for key, channel in channel_map.items():
        carrier.setdefault(channel, key)
    wells = means.where(F.col("well").isin(*overrides)) if overrides else means.where(F.lit(False))
    top = F.array_max(F.array(*[F.struct(F.col(f"mean_{c}").alias("m"), F.lit(-i).alias("o"), F.lit(c).alias("c")) for i, c in enumerate(channels)]))["c"]
    given = F.lit(None).cast("string")
    for well, secondary in overrides.items():
        given = F.when(F.col("well") == int(well), normal_secondary(F.lit(secondary))).otherwise(given)
    found = F.lit("?")
    for channel, key in carrier.items():
        found = F.when(F.col("higher") == channel, normal_secondary(F.lit(key))).otherwise(found)
    out = wells.withColumn("higher", top).withColumn("override", given).withColumn("found", found)
    reference = plate.where((F.col("arm") == "seconly") & (F.col("genotype") == "WT")).where(~F.col("well").isin(*overrides) if overrides else F.lit(True))
    first = reference.groupBy("channel").agg(F.min("well").alias("ref_well")).withColumnRenamed("channel", "higher")
    return out.join(first, "higher", "left").withColumn("verdict", F.when(F.col("found") == F.col("override"), "consistent").otherwise("conflicts")).drop("found")
