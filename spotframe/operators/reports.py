"""Condition reports: comparison and focus tables, dose response, matched bins, well tests, stain checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.functions.ranks import median_table, quantiles
from spotframe.functions.scalars import is_control, ratio, split_replicate
from spotframe.operators.ordering import pick_groups
from spotframe.operators.stats import distribution, kruskal, long_table, mann_whitney, quantile_bin, replicate_test, spearman
from spotframe.session import cut_lineage

# Count bins of the abundance axis, as right-closed (low, high] edges, and their labels.
COUNT_EDGES = (0.0, 2.0, 5.0, 10.0, 20.0, 40.0, 1e9)
COUNT_LABELS = ("1-2", "3-5", "6-10", "11-20", "21-40", "40+")
COUNT_AXIS_MAX = 200
MATCHED_MIN = 5
STRUCTURAL = (
    "image", "condition", "secondary_only", "experiment_id", "nucleus_id", "z_mode", "z_range",
    "cyto_estimation_method", "n_voxels", "n_pix", "n_z_slices", "voxel_xy_um", "voxel_z_um", "single_slice",
)  # fixed values: identifier columns that are never metrics


def two_group_rows(long: DataFrame, keys: Sequence[str], a: str, b: str, min_n: int = 2, with_p: bool = True) -> DataFrame:
    """Per key: mean, SEM and n of both conditions, U test, Cliff's delta and the direction."""
    v = F.col("v")
    per_side = []
    for side, name in (("a", a), ("b", b)):
        value = F.when(F.col("condition") == name, v)
        n = F.count(value)
        per_side += [F.avg(value).alias(f"{side}_mean"), (F.stddev_samp(value) / F.sqrt(n)).alias(f"{side}_sem"), n.alias(f"{side}_n")]
    rows = long.where(F.col("condition").isin(a, b))
    test = mann_whitney(rows, "v", "condition", a, b, keys, with_p)
    tested = (F.col("a_n") >= min_n) & (F.col("b_n") >= min_n)
    out = rows.groupBy(*keys).agg(*per_side).join(test.drop("n_a", "n_b", "ties"), list(keys), "left")
    for c in ["u", "cliffs_delta"] + (["p"] if with_p else []):
        out = out.withColumn(c, F.when(tested, F.col(c)))
    delta, gap = F.col("cliffs_delta"), F.col("a_mean") - F.col("b_mean")
    by_delta = F.when(F.abs(delta) < 1e-9, "=").when(delta > 0, f"up {a}").otherwise(f"up {b}")
    by_mean = F.when(gap.isNull(), "").when(gap > 0, f"up {a}").when(gap < 0, f"up {b}").otherwise("=")
    return out.withColumn("direction", F.when(delta.isNotNull(), by_delta).otherwise(by_mean))


def comparison_table(
    nuclei: DataFrame, per_image: DataFrame, metrics: Sequence[str], a: str = "WT", b: str = "KO", with_p: bool = True
) -> DataFrame:
    """One row per metric: both conditions over nuclei, and the secondary-only mean over images."""
    rows = long_table(nuclei.where(~F.col("secondary_only")), metrics, ["condition"])
    table = two_group_rows(rows, ["metric"], a, b, with_p=with_p)
    sec = (
        long_table(per_image.where(F.col("secondary_only")), metrics, [])
        .groupBy("metric")
        .agg(F.avg("v").alias("sec_mean"), F.count("v").alias("sec_n"))
    )
    return table.join(sec, "metric", "left").fillna(0, ["sec_n"])


def focus_report(
    nuclei: DataFrame, spots: DataFrame, above: DataFrame, a: str = "WT", b: str = "KO", with_p: bool = True
) -> DataFrame:
    """Sections A to G, one row per (section, metric).

    nuclei (image, nucleus_id, channel, condition, secondary_only, n_spots, nuclear_spots, cyto_spots,
    nuclear_spot_fraction, paired_fraction, total_peak, n_active); spots with condition, secondary_only,
    in_nucleolus; above (image, nucleus_id, channel, condition, secondary_only, nuc_above, cyto_above,
    nc_ratio_above). Spot means per image feed sections C and D, per nucleus section F.
    """
    nuclei, spots, above = (df.where(~F.col("secondary_only")) for df in (nuclei, spots, above))

    def section(df: DataFrame, letter: str, cols: Sequence[str]) -> DataFrame:
        rows = long_table(df, cols, ["channel", "condition"])
        return rows.select(F.lit(letter).alias("section"), F.concat_ws(" ", "channel", "metric").alias("metric"), "condition", "v")

    split = {
        "nuclear": F.col("in_nucleus"),
        "cytoplasmic": F.col("in_cytoplasm"),
    }
    where = {"any": F.lit(True), **split}
    image_means = spots.groupBy("image", "channel", "condition").agg(
        *[F.avg(F.when(cond, F.col(col))).alias(f"{name}_{part}") for part, cond in split.items() for name, col in (("peak", "peak"), ("diameter", "diameter_um"))]
    ).withColumn("peak_ratio", ratio(F.col("peak_nuclear"), F.col("peak_cytoplasmic")))
    owned = spots.where(F.col("nucleus_id") > 0)
    cell_means = owned.groupBy("image", "nucleus_id", "channel", "condition").agg(
        *[F.avg(F.when(cond, F.col("peak"))).alias(f"peak_{part}") for part, cond in where.items()],
        F.sum(F.col("in_nucleolus").cast("int")).alias("nucleolar_spots"),
        ratio(F.sum((F.col("in_nucleolus") & F.col("in_nucleus")).cast("int")), F.sum(F.col("in_nucleus").cast("int"))).alias("nucleolar_fraction"),
    )
    parts = [
        section(nuclei, "A", ["n_spots", "nuclear_spots", "cyto_spots", "n_active"]),
        section(above, "B", ["nuc_above", "cyto_above", "nc_ratio_above"]),
        section(image_means, "C", ["peak_nuclear", "peak_cytoplasmic", "peak_ratio"]),
        section(image_means, "D", ["diameter_nuclear", "diameter_cytoplasmic"]),
        section(nuclei, "E", ["nuclear_spot_fraction", "paired_fraction"]),
        section(cell_means, "F", ["peak_any", "peak_nuclear", "peak_cytoplasmic"]),
        section(nuclei, "F", ["total_peak"]),
        section(cell_means, "G", ["nucleolar_spots", "nucleolar_fraction"]),
    ]
    return two_group_rows(reduce(DataFrame.unionByName, parts), ["section", "metric"], a, b, min_n=3, with_p=with_p)


def executive_counts(per_image: DataFrame, nuclei: DataFrame, spots: DataFrame) -> DataFrame:
    """Images, nuclei, spots per channel and mean spots per nucleus for each condition."""
    images = per_image.groupBy("condition").agg(F.count(F.lit(1)).alias("n_images"))
    cells = nuclei.groupBy("condition").agg(F.count(F.lit(1)).alias("n_nuclei"), F.avg("n_spots").alias("spots_per_nucleus"))
    found = spots.groupBy("condition").agg(
        *[F.sum(F.when(F.col("channel") == c, 1).otherwise(0)).alias(f"n_{c}") for c in ("rna1", "rna2")]
    )
    return images.join(cells, "condition", "left").join(found, "condition", "left")


def discover_metrics(df: DataFrame, structural: Sequence[str] = STRUCTURAL, min_n: int = 8) -> list[str]:
    """Numeric, non-structural columns with enough values and more than one distinct value."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    names = [n for n, t in df.dtypes if n not in structural and (t in numeric or t.startswith("decimal"))]
    if not names:
        return []
    # min < max says "more than one distinct value" without counting them
    checks = [((F.count(n) >= min_n) & (F.min(n) < F.max(n))).alias(n) for n in names]
    row = df.agg(*checks).first()
    return [n for n in names if row[n]]


def abundance_bins(nuclei: DataFrame, abundance: str) -> DataFrame:
    """Add ``bin``: count bins for small whole-number axes, else five quantile bins; right-closed."""
    a = F.col(abundance).cast("double")
    top = nuclei.where(a > 0).agg(F.max(a).alias("top"), F.max(F.abs(a - F.rint(a))).alias("off")).first()
    if top["top"] is not None and top["top"] <= COUNT_AXIS_MAX and top["off"] <= 1e-8 + 1e-5 * top["top"]:
        edges, labels = list(COUNT_EDGES), list(COUNT_LABELS)
    else:
        names = {f"q{i}": i / 5 for i in range(6)}
        q = quantiles(nuclei.where(a > 0), a, [], names).first()
        edges = sorted({q[n] for n in names if q is not None and q[n] is not None})
        if len(edges) < 3:
            low, high = (edges[0], edges[-1]) if edges else (0.0, 1.0)
            edges = [low + (high - low) * i / 3 for i in range(4)]
        labels = [f"{lo:.3g}-{hi:.3g}" for lo, hi in zip(edges, edges[1:])]
    label = F.lit(None).cast("string")
    for lo, hi, name in reversed(list(zip(edges, edges[1:], labels))):
        label = F.when((a > lo) & (a <= hi), F.lit(name)).otherwise(label)
    return nuclei.withColumn("bin", label)


def _scopes(df: DataFrame, a: str, b: str) -> DataFrame:
    """Each row once for the pool and once for its own group."""
    own = F.when(F.col("group") == a, F.lit("A")).when(F.col("group") == b, F.lit("B"))
    return df.withColumn("scope", F.explode(F.array(F.lit("pool"), own))).where(F.col("scope").isNotNull())


def dose_response(nuclei: DataFrame, abundance: str, metrics: Sequence[str], a: str, b: str, with_p: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rank correlation of each metric with abundance, binned mean / SEM / n) for the pool, A and B."""
    binned = abundance_bins(nuclei, abundance).withColumn("_abund", F.col(abundance).cast("double"))
    rows = _scopes(long_table(binned, metrics, ["group", "bin", "_abund"]).where(F.col("v").isNotNull()), a, b)
    rho = spearman(rows.where(F.col("metric") != abundance), "_abund", "v", ["metric", "scope"], with_p=with_p)
    n = F.count("v")
    means = (
        rows.where(F.col("bin").isNotNull())
        .groupBy("metric", "scope", "bin")
        .agg(n.alias("n"), F.avg("v").alias("mean"), (F.stddev_samp("v") / F.sqrt(n)).alias("sem"))
    )
    return rho, means


def matched_bins(nuclei: DataFrame, abundance: str, metrics: Sequence[str], a: str, b: str, with_p: bool = True) -> DataFrame:
    """A against B inside each abundance bin; the U test needs five values on both sides."""
    rows = long_table(abundance_bins(nuclei, abundance).where(F.col("bin").isNotNull()), metrics, ["group", "bin"])
    keys = ["metric", "bin"]
    out = mann_whitney(rows, "v", "group", a, b, keys, with_p)
    means = rows.where(F.col("group").isin(a, b)).groupBy(*keys).agg(
        *[F.avg(F.when(F.col("group") == g, F.col("v"))).alias(f"mean_{s}") for s, g in (("a", a), ("b", b))]
    )
    enough = (F.col("n_a") >= MATCHED_MIN) & (F.col("n_b") >= MATCHED_MIN)
    for c in ["u"] + (["p"] if with_p else []):
        out = out.withColumn(c, F.when(enough, F.col(c)))
    return out.join(means, keys).drop("ties", "cliffs_delta")


def tertile_test(nuclei: DataFrame, abundance: str, metrics: Sequence[str], group: str, with_p: bool = True) -> tuple[DataFrame, DataFrame]:
    """Perturbed cells split into thirds of their own abundance: (per-third summary, Kruskal-Wallis)."""
    cells = long_table(
        nuclei.where((F.col("group") == group) & (F.col(abundance) >= 1)).withColumn("_abund", F.col(abundance).cast("double")),
        metrics, ["_abund"],
    ).where(F.col("v").isNotNull())
    sizes = cells.groupBy("metric").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= 9)
    thirds = quantile_bin(cells.join(sizes, "metric", "left_semi"), "_abund", 3, ["metric"], "third").where(F.col("third").isNotNull())
    thirds = cut_lineage(thirds)  # read by the summary and twice by the test
    n = F.count("v")
    summary = (
        thirds.groupBy("metric", "third")
        .agg(n.alias("n"), F.avg("v").alias("mean"), (F.stddev_samp("v") / F.sqrt(n)).alias("sem"))
        .join(median_table(thirds, {"abund_median": "_abund"}, ["metric", "third"]), ["metric", "third"])
    )
    big = summary.where(F.col("n") >= 3).select("metric", "third")
    return summary, kruskal(thirds.join(big, ["metric", "third"], "left_semi"), "v", "third", ["metric"], with_p)


def distribution_table(nuclei: DataFrame, metrics: Sequence[str], a: str, b: str, with_p: bool = True) -> tuple[DataFrame, DataFrame]:
    """(shape of each metric per group, Welch test across replicate means)."""
    rows = long_table(nuclei.where(F.col("group").isin(a, b)), metrics, ["group", "rep"])
    return distribution(rows, "v", ["metric", "group"]), replicate_test(rows, "v", "group", a, b, "rep", ["metric"], with_p)


def saturation(nuclei: DataFrame, abundance: str, fraction: str, usable: str, with_p: bool = True) -> DataFrame:
    """Rank correlation of associated count and fraction with abundance, from one and from three spots on."""
    ok = nuclei.where(F.col(usable) & F.col(fraction).isNotNull() & (F.col(abundance) >= 1)).withColumn("_count", F.col(fraction) * F.col(abundance))
    tiers = ok.withColumn(
        "tier", F.explode(F.when(F.col(abundance) >= 3, F.array(F.lit("ge1"), F.lit("ge3"))).otherwise(F.array(F.lit("ge1"))))
    )
    rows = long_table(tiers.withColumn("_x", F.col(abundance).cast("double")).withColumnRenamed("_count", "assoc_count").withColumnRenamed(fraction, "assoc_fraction"), ["assoc_count", "assoc_fraction"], ["tier", "_x"])
    return spearman(rows, "_x", "v", ["tier", "metric"], with_p=with_p)


def with_groups(nuclei: DataFrame) -> DataFrame:
    """Add group and rep from the condition label; the image is the replicate where the label has none."""
    group, rep = split_replicate(F.col("condition"), F.col("image"))
    return nuclei.withColumn("group", group).withColumn("rep", rep)


def well_welch(nuclei: DataFrame, metrics: Sequence[str], a: str | None = None, b: str | None = None, with_p: bool = True) -> DataFrame:
    """Welch test of well means, control against perturbation, for every metric with more than four values."""
    if a is None or b is None:
        a, b = pick_groups(nuclei.where(F.col("group") != "Sec"), "group", a, b)
    rows = long_table(nuclei, metrics, ["group", "well"])
    filled = rows.groupBy("metric").agg(F.count("v").alias("_n")).where(F.col("_n") > 4)
    out = replicate_test(rows.join(filled, "metric", "left_semi"), "v", "group", a, b, "well", ["metric"], with_p)
    return out.withColumn("b_minus_a", F.col("mean_b") - F.col("mean_a"))


def stain_qc(nuclei: DataFrame, index: str, group: str = "group", secondary: str = "Sec") -> DataFrame:
    """Mean index per group; secondary-only rows are flagged when they reach 90 % of the real ones."""
    means = nuclei.groupBy(group).agg(F.avg(index).alias("_m"))
    real = nuclei.where(F.col(group) != secondary).agg(F.avg(index).alias("real")).withColumn(group, F.lit(secondary))
    technical: Column = (F.col(group) == secondary) & (F.col("real") != 0) & (F.round("_m", 3) >= 0.9 * F.col("real"))
    return means.join(real, group, "left").select(
        group, F.round("_m", 3).alias("index_mean"), F.coalesce(technical, F.lit(False)).alias("likely_technical")
    )


def control_groups(df: DataFrame, group: str) -> DataFrame:
    return df.select(group).distinct().withColumn("control", is_control(F.col(group)))
