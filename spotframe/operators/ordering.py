"""Orders, representatives and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.functions.draws import PRIME, draw, stream
from spotframe.functions.ranks import cumulate, value_counts
from spotframe.functions.scalars import is_control


def condition_rank(condition: Column, secondary: Column) -> Column:
    c = F.upper(condition)
    return F.when(secondary, 2).when(c.isin("WT", "NT"), 0).when(c.isin("KO", "KD"), 1).otherwise(3)


def order_conditions(df: DataFrame, *extra: str) -> DataFrame:
    """WT / NT, then KO / KD, then secondary-only (relabelled), then the rest."""
    sec = F.coalesce(F.col("secondary_only"), F.lit(False))
    shown = df.withColumn("condition", F.when(sec, F.lit("sec-only")).otherwise(F.col("condition")))
    return shown.orderBy(condition_rank(F.col("condition"), sec), F.upper("condition"), *extra)


def control_first(df: DataFrame, condition: str, *order: str) -> DataFrame:
    return df.orderBy(F.when(is_control(F.col(condition)), 0).otherwise(1), *order)


def secondary_last(df: DataFrame, *order: str) -> DataFrame:
    return df.orderBy(F.col("secondary_only"), *order)


def representative(nuclei: DataFrame, v: str, n: int = 1) -> DataFrame:
    """Per image the n nuclei nearest to the upper median of ``v``; ties go to the smaller id."""
    ranked = cumulate(value_counts(nuclei, v, ["image"]), ["image"])
    middle = F.expr("total div 2")
    upper = ranked.groupBy("image").agg(
        F.max(F.when((F.col("before") <= middle) & (middle < F.col("before") + F.col("n")), F.col("v"))).alias("_mid")
    )
    near = nuclei.where(F.col(v).isNotNull()).join(upper, "image").withColumn("distance", F.abs(F.col(v) - F.col("_mid")))
    return top_n(near, ["image"], [F.col("distance").asc(), F.col("nucleus_id").asc()], n).drop("_mid")


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows per key; Spark keeps n rows per key and task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_nuclei_samples(spots: DataFrame, labels: DataFrame, n_nuclei: int = 6, k: int = 8, seed: int = 0) -> DataFrame:
    """For the nuclei with most spots: k spots and as many random nucleus pixels, in a seeded order.

    (image, nucleus_id, kind, y, x, pick); spots (image, nucleus_id, spot_id, y, x).
    """
    key = ["image", "nucleus_id"]
    counts = spots.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    best = top_n(counts, ["image"], [F.col("n").desc(), F.col("nucleus_id").asc()], n_nuclei)
    state = stream(seed, F.col("image"), F.col("nucleus_id"))

    def pick(df: DataFrame, kind: str, size: Column, *ids: str) -> DataFrame:
        chosen = df.join(best.select(*key, "n"), key).withColumn("_size", size)
        mixed = draw(state, *[F.col(i) % PRIME for i in ids])
        w = Window.partitionBy(*key).orderBy(mixed, *[F.col(i) for i in ids])
        return (
            chosen.withColumn("pick", F.row_number().over(w))
            .where((F.col("pick") <= k) & (F.col("pick") <= F.col("_size")))
            .select(*key, F.lit(kind).alias("kind"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), "pick")
        )

    return pick(spots, "spot", F.col("n"), "spot_id").unionByName(pick(labels, "random", F.col("n"), "y", "x"))


def densest_fov(fov: DataFrame) -> DataFrame:
    """Per well the field with most nuclei, the smallest field number among equals; without counts the middle field.

    A well has few fields, so they are ordered as one array.
    """
    known = F.col("nucleus_count").isNotNull()
    best = F.max_by(F.when(known, F.col("fov")), F.when(known, F.struct(F.col("nucleus_count"), (-F.col("fov")).alias("_o"))))
    fields = F.sort_array(F.collect_list("fov"))
    middle = F.get(fields, F.floor(F.size(fields) / 2).cast("int"))
    return fov.groupBy("well").agg(F.coalesce(best, middle).alias("fov"), F.max("nucleus_count").alias("nucleus_count"))


def comparison_groups(plate: DataFrame) -> DataFrame:
    """(secondary, genotype, well, n_primary): primary wells per secondary, largest secondary first, then the pool."""
    primary = plate.where(F.col("arm") == "primary").select("secondary", "genotype", "well")
    sizes = primary.groupBy("secondary").agg(F.count(F.lit(1)).alias("n_primary"))
    per = primary.join(sizes, "secondary")
    pooled = primary.withColumn("secondary", F.lit("pooled")).withColumn("n_primary", F.lit(0).cast("long"))
    return per.unionByName(pooled).orderBy(F.col("n_primary").desc(), "secondary", F.col("genotype").desc(), "well")


def pick_groups(nuclei: DataFrame, group: str = "group", a: str | None = None, b: str | None = None) -> tuple[str | None, str | None]:
    """Control and perturbation labels: given ones, else control-like against the rest, else by size.

    Only the two labels come back to the driver.
    """
    if a is not None and b is not None:
        return a, b
    sizes = nuclei.groupBy(group).agg(F.count(F.lit(1)).alias("n")).withColumn("control", is_control(F.col(group)))
    by_size = [F.col("n").desc(), F.col(group).asc()]
    if a is None:
        row = sizes.where(~F.col(group).eqNullSafe(F.lit(b))).orderBy(F.col("control").desc(), *by_size).first()
        a = row[group] if row else None
    if b is None and a is not None:
        row = sizes.where(F.col(group) != a).orderBy(F.col("control").asc(), *by_size).first()
        b = row[group] if row else None
    return a, b
