"""A whole plate run: from the files of wells, their pixels and masks to field, nucleus, well and test tables.

Pixels are read once. Every image row meets the mask runs of its row, and what is left of it is its sum and the
sums of the stretches under each nucleus and rim; that small table is stored and everything else is made from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.functions.scalars import ratio
from spotframe.operators import fov
from spotframe.operators.labels import expand_labels
from spotframe.operators.runs import rows_of_runs, run_pixels, to_runs
from spotframe.operators.stats import long_table, welch
from spotframe.session import cut_lineage

META = ["well", "genotype", "arm", "secondary", "qki_channel", "file", "fov_seq"]
#: Field columns that a well averages.
WELL_METRICS = (
    "qki_mean", "dapi_mean", "total_qki", "ratio_qki_over_dapi", "nuc_mean_qki", "nuc_integrated_qki", "cyto_mean_qki", "nuc_over_cyto",
    "nucleus_count", "M1_pn", "ratio_bgcorr", "nuc_mean_bgcorr", "fold_qki_mean", "fold_ratio", "fold_nuc_mean",
)
#: Well folds by the column they come from.
WELL_FOLDS = {"nuc_mean_qki": "wellfold_nuc_mean", "ratio_qki_over_dapi": "wellfold_ratio", "qki_mean": "wellfold_qki_mean"}
RAW_METRICS = ("nuc_mean_qki", "ratio_qki_over_dapi", "M1_pn", "nuc_integrated_qki")
TABLES = ("per_nucleus", "per_fov", "per_well", "stats", "exposure", "seconly", "conflict", "per_image_summary", "nuclei_metrics", "rejected")


def _row_sums(plane_rows: DataFrame, masks: Sequence[DataFrame]) -> DataFrame:
    """(image, channel, s, n, parts ARRAY<STRUCT<mask, id, s, n>>): one row per image row and channel."""
    met = plane_rows.select("image", "channel", "y", "vals").join(rows_of_runs(masks), ["image", "y"], "left")
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    part = lambda c: F.struct(c["mask"].alias("mask"), c["id"].alias("id"), total(F.slice("vals", (c["x0"] + 1).cast("int"), (c["x1"] - c["x0"] + 1).cast("int"))).alias("s"), (c["x1"] - c["x0"] + 1).alias("n"))
    return met.select("image", "channel", total(F.col("vals")).alias("s"), F.size("vals").cast("long").alias("n"), F.transform("cells", part).alias("parts"))


def _fields(rows: DataFrame, files: DataFrame, exposures: DataFrame | None, signals: Sequence[str], dapi: str) -> DataFrame:
    """(image, META, whole-field numbers, exposures) of every field with pixels."""
    channels = list(dict.fromkeys([*signals, dapi]))
    whole = rows.groupBy("image").agg(
        *[F.sum(F.when(F.col("channel") == c, F.col(v))).alias(f"_{k}_{c}") for c in channels for v, k in (("s", "s"), ("n", "n"))]
    )
    shot = None
    if exposures is not None:
        shot = exposures.groupBy("image").agg(*[F.max(F.when(F.col("channel") == c, F.col("exposure"))).alias(f"exp_{c}_s") for c in channels])
    joined = files.join(whole, "image")
    joined = joined.join(shot, "image", "left") if shot is not None else joined.withColumns({f"exp_{c}_s": F.lit(None).cast("double") for c in channels})

    def routed(name) -> Column:
        """The column of the channel that the well's stain goes to."""
        return reduce(lambda other, c: F.when(F.col("qki_channel") == c, F.col(name(c))).otherwise(other), reversed(channels), F.lit(None).cast("double"))

    total, pixels = routed(lambda c: f"_s_{c}"), routed(lambda c: f"_n_{c}")
    means = {f"mean_{c}": F.col(f"_s_{c}") / F.col(f"_n_{c}") for c in channels}
    out = joined.withColumns({"total_qki": total, "qki_mean": total / pixels, "total_dapi": F.col(f"_s_{dapi}"), "dapi_mean": F.col(f"_s_{dapi}") / F.col(f"_n_{dapi}"), "_px": F.col(f"_n_{dapi}"), "exp_qki_s": routed(lambda c: f"exp_{c}_s"), "exp_dapi_s": F.col(f"exp_{dapi}_s"), **means})
    out = out.withColumn("ratio_qki_over_dapi", ratio(F.col("qki_mean"), F.col("dapi_mean")))
    keep = ["image", *META, "qki_mean", "dapi_mean", "total_qki", "total_dapi", "ratio_qki_over_dapi", *means, "exp_qki_s", "exp_dapi_s", *[f"exp_{c}_s" for c in signals], "_px"]
    return out.select(*list(dict.fromkeys(keep)))


def _nuclei(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(image, nucleus_label, area_px, nuc_mean_qki, nuc_integrated_qki, cyto_mean_qki, nuc_over_cyto) in each field's own channel."""
    mine = rows.join(files.select("image", F.col("qki_channel").alias("channel")), ["image", "channel"]).select("image", F.explode("parts").alias("p"))
    of = lambda mask, v: F.sum(F.when(F.col("p.mask") == mask, F.col(f"p.{v}")))
    sums = mine.groupBy("image", F.col("p.id").alias("nucleus_label")).agg(of(0, "n").alias("area_px"), of(0, "s").alias("nuc_integrated_qki"), (of(1, "s") / of(1, "n")).alias("cyto_mean_qki"))
    mean = F.col("nuc_integrated_qki") / F.col("area_px")
    over = F.when(F.col("cyto_mean_qki") != 0, F.col("nuc_mean_qki") / F.col("cyto_mean_qki"))
    return sums.where(F.col("area_px") > 0).withColumn("nuc_mean_qki", mean).withColumn("nuc_over_cyto", over)


def _corrected(fields: DataFrame, n_pixels: int) -> tuple[DataFrame, DataFrame]:
    """(pool of secondary-only fields per genotype and channel, fields with corrected and fold columns)."""
    counted = F.col("nucleus_count") > 0
    base = F.sum(F.when(counted, F.col("qki_mean"))) * n_pixels / F.sum(F.when(counted, F.col("nucleus_count")))
    pool = fields.where(F.col("arm") == "seconly").groupBy("genotype", "qki_channel").agg(
        F.avg("qki_mean").alias("qki_mean"), F.avg("ratio_qki_over_dapi").alias("ratio"), F.avg("nuc_mean_qki").alias("nuc_mean"), base.alias("m1_base"), F.count(F.lit(1)).alias("n_fov")
    )
    pool = cut_lineage(pool)
    names = {"qki_mean": "sec_qki_mean_pooled", "ratio": "sec_ratio_pooled", "nuc_mean": "sec_nuc_mean_pooled", "m1_base": "sec_m1_base"}
    met = fields.join(pool.select("genotype", "qki_channel", *[F.col(a).alias(b) for a, b in names.items()]), ["genotype", "qki_channel"], "left")
    less = lambda v, s: F.col(v) - F.col(s)
    fold = lambda v, s: F.when(F.col(s) != 0, F.col(v) / F.col(s))
    out = met.withColumns(
        {
            "M1_pn": F.when(counted, less("qki_mean", "sec_qki_mean_pooled") * n_pixels / F.col("nucleus_count")),
            "ratio_bgcorr": less("ratio_qki_over_dapi", "sec_ratio_pooled"), "nuc_mean_bgcorr": less("nuc_mean_qki", "sec_nuc_mean_pooled"),
            "fold_qki_mean": fold("qki_mean", "sec_qki_mean_pooled"), "fold_ratio": fold("ratio_qki_over_dapi", "sec_ratio_pooled"), "fold_nuc_mean": fold("nuc_mean_qki", "sec_nuc_mean_pooled"),
        }
    )
    return pool, out


def _wells(fields: DataFrame) -> DataFrame:
    """Means of fields per well, and folds of primary wells over the wells of their genotype and secondary without primary."""
    wells = fields.groupBy("well", "genotype", "arm", "secondary", "qki_channel").agg(F.count(F.lit(1)).alias("n_fov"), *[F.avg(m).alias(m) for m in WELL_METRICS])
    floor = wells.where(F.col("arm") == "seconly").groupBy("genotype", "secondary").agg(*[F.avg(m).alias(f"_{m}") for m in WELL_FOLDS])
    met = wells.join(floor, ["genotype", "secondary"], "left")
    folds = {name: F.when(F.col("arm") == "primary", ratio(F.col(m), F.col(f"_{m}"))) for m, name in WELL_FOLDS.items()}
    return met.withColumns(folds).drop(*[f"_{m}" for m in WELL_FOLDS])


def plate_tests(wells: DataFrame, with_p: bool = True) -> DataFrame:
    """Welch and Student tests over wells, with the floors of secondary-only wells.

    per_secondary_raw: WT against KO primary wells of a secondary, with floor_WT and floor_KO; primary_vs_seconly: per
    secondary and genotype; pooled_fold_n3: well folds of all secondaries together. Secondaries without a
    primary well are left out.
    """
    primary, floors = wells.where(F.col("arm") == "primary"), wells.where(F.col("arm") == "seconly")
    tested = primary.select("secondary").distinct()
    keys = ["analysis", "secondary", "genotype", "metric"]
    part = lambda df, name, secondary, genotype: df.select(F.lit(name).alias("analysis"), secondary.alias("secondary"), genotype.alias("genotype"), "metric", "side", "v")
    raw = part(long_table(primary.withColumn("side", F.col("genotype")), RAW_METRICS, ["secondary", "side"]), "per_secondary_raw", F.col("secondary"), F.lit("both"))
    arms = wells.join(tested, "secondary", "left_semi").withColumn("side", F.when(F.col("arm") == "primary", "WT").otherwise("KO"))
    arms = part(long_table(arms, RAW_METRICS[:2], ["secondary", "genotype", "side"]), "primary_vs_seconly", F.col("secondary"), F.col("genotype"))
    folds = part(long_table(primary.withColumn("side", F.col("genotype")), list(WELL_FOLDS.values()), ["side"]), "pooled_fold_n3", F.lit("pooled"), F.lit("both"))
    tests = welch(raw.unionByName(arms).unionByName(folds), "v", "side", "WT", "KO", keys, with_p)
    floor = long_table(floors, RAW_METRICS, ["secondary", "genotype"]).groupBy("secondary", "metric").agg(
        *[F.avg(F.when(F.col("genotype") == g, F.col("v"))).alias(f"floor_{g}") for g in ("WT", "KO")]
    )
    held = floor.withColumn("analysis", F.lit("per_secondary_raw"))
    ids = primary.groupBy().agg(*[F.array_join(F.transform(F.sort_array(F.collect_set(F.when(F.col("genotype") == g, F.col("well")))), lambda w: w.cast("string")), ",").alias(f"_{g}") for g in ("WT", "KO")])
    named = tests.join(held, ["analysis", "secondary", "metric"], "left").join(F.broadcast(ids))  # one row
    analysis = F.col("analysis")
    side = lambda g, other: F.when(analysis == "primary_vs_seconly", F.concat("genotype", F.lit(other))).when(analysis == "pooled_fold_n3", F.concat(F.lit(f"{g}_primary("), F.col(f"_{g}"), F.lit(")"))).otherwise(f"{g}_primary")
    return named.withColumn("group_A", side("WT", "_primary")).withColumn("group_B", side("KO", "_seconly")).drop("_WT", "_KO")


def plate_run(
    files: DataFrame,
    plate: DataFrame,
    plane_rows: DataFrame,
    labels: DataFrame,
    exposures: DataFrame | None = None,
    ring: DataFrame | None = None,
    channel_map: Mapping[str, str] | None = None,
    dapi: str = "dapi",
    overrides: Mapping[int, str] | None = None,
    drop_conflicts: bool = False,
    ring_px: int = 80,
    n_pixels: int | None = None,
    exposure_tol: float = 1e-6,
    pixel_size_um: float = 0.2167,
    with_p: bool = True,
) -> dict[str, DataFrame]:
    """All tables of a plate run, see TABLES.

    files (image, well, file, fov_seq); plate (well, genotype, arm, secondary, channel) as ``plate_layout`` gives it;
    plane_rows (image, channel, y, vals); labels and ring are masks in any form of ``runs`` (without a ring the
    pixels within ring_px of a nucleus are one); exposures (image, channel, exposure); channel_map gives the channel
    of each secondary label. Files of wells that are not on the plate, and images without pixels, are `rejected` and
    left out; with drop_conflicts so are wells whose override the pixels contradict.
    """
    channel_map = channel_map or {}
    signals = list(dict.fromkeys(channel_map.values())) or [r[0] for r in plate.select("channel").distinct().orderBy("channel").collect()]
    on_plate = cut_lineage(files.join(plate.withColumnRenamed("channel", "qki_channel"), "well"))
    rejected = files.join(plate.select("well"), "well", "left_anti").select("image", "well", "file", F.lit("not on the plate").alias("reason"))
    wanted = plane_rows.where(F.col("channel").isin(*signals, dapi)).join(on_plate.select("image"), "image", "left_semi")
    if ring is None:
        frame = plane_rows.groupBy("image").agg((F.max("y") + 1).alias("height"), F.max(F.size("vals")).alias("width"))
        ring = expand_labels(run_pixels(to_runs(labels), "nucleus_id"), frame, ring_px)
    rows = cut_lineage(_row_sums(wanted, [labels, ring]))
    fields = cut_lineage(_fields(rows, on_plate, exposures, signals, dapi))
    gone = on_plate.join(fields.select("image"), "image", "left_anti")
    rejected = rejected.unionByName(gone.select("image", "well", "file", F.lit("no pixels").alias("reason")))
    conflict = cut_lineage(fov.conflict_check(fields, plate, signals, overrides or {}, channel_map))
    if drop_conflicts:
        bad = conflict.where(F.col("verdict") == "conflicts").select("well")
        rejected = rejected.unionByName(fields.join(bad, "well", "left_semi").select("image", "well", "file", F.lit("conflicting override").alias("reason")))
        fields = cut_lineage(fields.join(bad, "well", "left_anti"))
    nuclei = cut_lineage(fields.select("image", *META).join(_nuclei(rows, fields), "image"))
    per = nuclei.groupBy("image").agg(F.count(F.lit(1)).alias("nucleus_count"), *[F.avg(c).alias(c) for c in ("nuc_mean_qki", "nuc_integrated_qki", "cyto_mean_qki", "nuc_over_cyto")])
    fields = cut_lineage(fields.join(per, "image", "left").fillna(0, ["nucleus_count"]))
    size = n_pixels or (fields.agg(F.max("_px")).first()[0] or 0)
    pool, per_fov = _corrected(fields.drop("_px"), size)
    per_fov = cut_lineage(per_fov)
    per_well = cut_lineage(_wells(per_fov))
    condition = F.concat_ws(" ", "genotype", "arm", "secondary").alias("condition")
    basis = [F.col("file").alias("image"), condition, (F.col("arm") == "seconly").alias("secondary_only")]
    values = ["nuc_mean_qki", "nuc_integrated_qki", "cyto_mean_qki", "nuc_over_cyto"]
    numbers = [c for c in per_fov.columns if c not in ("image", *META)]
    return {
        "per_nucleus": nuclei.select(*META, "nucleus_label", "area_px", *values),
        "per_fov": per_fov.select(*META, *numbers),
        "per_well": per_well,
        "stats": plate_tests(per_well, with_p),
        "exposure": fov.exposure_check(per_fov.withColumnRenamed("qki_channel", "channel"), exposure_tol, dapi),
        "seconly": pool,
        "conflict": conflict,
        "per_image_summary": per_fov.select(*basis, F.col("nucleus_count").alias("nuclei_analyzed"), F.lit(round(pixel_size_um * 1000.0, 6)).alias("voxel_xy_nm"), F.lit(1).alias("n_z"), *META, *numbers),
        "nuclei_metrics": nuclei.select(*basis, F.col("nucleus_label").alias("nucleus_id"), F.col("area_px").alias("nucleus_area_px"), *META, *values),
        "rejected": rejected,
    }
