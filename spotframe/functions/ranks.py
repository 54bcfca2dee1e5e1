"""Exact ranks, quantiles and medians, in two forms chosen by the caller's keys.

A group is first collapsed to its distinct values with counts. Keys that name an image are bounded by its frame or its
spots: their values are ranked by a running sum over the group, after one shuffle by the keys. Pooled keys (a channel, a
condition, none at all) grow with the run: their distinct values are stored once, cut at bucket edges taken from a hash
sample, and ranked inside a bucket and offset by the bucket totals, so that no task holds a whole group.
The edges decide only how work is spread: any edges give the same ranks. The hash sample is a pure
function of the values, so a recomputed task agrees with the first run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.session import cut_lineage

SAMPLE_ONE_IN = 1024
BUCKETS = 256


def _bucketed(distinct: DataFrame, keys: Sequence[str]) -> DataFrame:
    cuts = [i / BUCKETS for i in range(1, BUCKETS)]
    edges = (
        distinct.where(F.pmod(F.xxhash64("v"), F.lit(SAMPLE_ONE_IN)) == 0)
        .groupBy(*keys)
        .agg(F.percentile_approx("v", cuts, 100 * BUCKETS).alias("edges"))
    )
    bucket = F.when(F.col("edges").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("edges", lambda e: e < F.col("v")))
    )
    return distinct.join(edges, list(keys), "left").withColumn("bucket", bucket).drop("edges")


def value_counts(
    df: DataFrame, value: str | Column, keys: Sequence[str], counts: Mapping[str, Column] | None = None
) -> DataFrame:
    """(keys, v, n, extra counts): one row per distinct non-NULL value."""
    v = F.col(value) if isinstance(value, str) else value
    extra = [F.sum(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in (counts or {}).items()]
    return (
        df.withColumn("v", v.cast("double"))
        .where(F.col("v").isNotNull())
        .groupBy(*keys, "v")
        .agg(F.count(F.lit(1)).alias("n"), *extra)
    )


def is_bounded(keys: Sequence[str]) -> bool:
    """Whether groups of these keys are as small as an image."""
    return "image" in keys


def cumulate(distinct: DataFrame, keys: Sequence[str], bounded: bool | None = None) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` to a (keys, v, n) table.

    ``bounded`` states that a group fits one task; by default the keys tell, see ``is_bounded``.
    """
    if not keys:
        return cumulate(distinct.withColumn("_all", F.lit(1)), ["_all"], False).drop("_all")
    if is_bounded(keys) if bounded is None else bounded:
        group = Window.partitionBy(*keys)
        smaller = group.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        return distinct.withColumn("before", F.coalesce(F.sum("n").over(smaller), F.lit(0))).withColumn("total", F.sum("n").over(group))
    spread = _bucketed(cut_lineage(distinct), keys)
    across = Window.partitionBy(*keys)
    sizes = (
        spread.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("bn"))
        .withColumn(
            "offset",
            F.coalesce(F.sum("bn").over(across.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("total", F.sum("bn").over(across))
        .drop("bn")
    )
    inside = Window.partitionBy(*keys, "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    return (
        spread.join(sizes, [*keys, "bucket"])
        .withColumn("before", F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .drop("offset", "bucket")
    )


def value_ranks(
    df: DataFrame, value: str | Column, keys: Sequence[str], counts: Mapping[str, Column] | None = None
) -> DataFrame:
    """(keys, v, n, before, total, rank): average-tie rank of every distinct value."""
    return cumulate(value_counts(df, value, keys, counts), keys).withColumn(
        "rank", F.col("before") + (F.col("n") + 1) / F.lit(2.0)
    )


def quantiles(df: DataFrame, value: str | Column, keys: Sequence[str], wanted: Mapping[str, float | str]) -> DataFrame:
    """Exact quantiles per key, linear interpolation; ``wanted`` maps a column name to p in [0, 1].

    A string p names a key column that carries the fraction.
    """
    return quantiles_of_counts(value_counts(df, value, keys), keys, wanted)


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], wanted: Mapping[str, float | str]) -> DataFrame:
    """The same from a (keys, v, n) table."""
    ranked = cumulate(counts, keys)
    aggs = []
    for name, p in wanted.items():
        fraction = F.lit(float(p)) if not isinstance(p, str) else F.col(p)
        position = fraction * (F.col("total") - 1)
        low, high = F.floor(position), F.ceil(position)

        def at(index: Column) -> Column:
            hit = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
            return F.max(F.when(hit, F.col("v")))

        aggs += [at(low).alias(f"{name}__lo"), at(high).alias(f"{name}__hi"), F.max(position - low).alias(f"{name}__w")]
    out = ranked.groupBy(*keys).agg(*aggs)
    cols = []
    for name in wanted:
        lo, hi, w = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__w")
        cols.append((lo + (hi - lo) * w).alias(name))
    return out.select(*keys, *cols)


def medians(df: DataFrame, value: str | Column, keys: Sequence[str], name: str = "median") -> DataFrame:
    return quantiles(df, value, keys, {name: 0.5})


def median_table(df: DataFrame, columns: Mapping[str, str | Column], keys: Sequence[str]) -> DataFrame:
    """Medians of several columns in one pass: the columns are stacked and ranked together."""
    names = list(columns)
    cells = [
        F.struct(F.lit(name).alias("_m"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("_v"))
        for name, c in columns.items()
    ]
    stacked = df.select(*keys, F.explode(F.array(*cells)).alias("_s")).select(*keys, "_s._m", "_s._v")
    med = medians(stacked, "_v", [*keys, "_m"])
    return med.groupBy(*keys).agg(*[F.max(F.when(F.col("_m") == m, F.col("median"))).alias(m) for m in names])


def median_and_mad(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """(keys, med, mad): median and unscaled median absolute deviation about it."""
    if not keys:
        return median_and_mad(df.withColumn("_all", F.lit(1)), value, ["_all"]).drop("_all")
    return median_and_mad_of_counts(value_counts(df, value, keys), keys)


def median_and_mad_of_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same from a (keys, v, n) table."""
    if is_bounded(keys):
        group = Window.partitionBy(*keys)
        ranked = cumulate(counts, keys, True).withColumn("med", _middle(lambda hit: F.max(F.when(hit, F.col("v"))).over(group)))
        nearer = group.orderBy("off").rowsBetween(Window.unboundedPreceding, -1)
        by_off = ranked.withColumn("off", F.abs(F.col("v") - F.col("med"))).withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
        return by_off.groupBy(*keys).agg(F.max("med").alias("med"), _middle(lambda hit: F.max(F.when(hit, F.col("off")))).alias("mad"))
    counts = cut_lineage(counts)
    med = _weighted_median(counts, keys, "med")
    off = F.abs(F.col("v") - F.col("med"))
    deviations = counts.join(med, list(keys)).withColumn("v", off).groupBy(*keys, "v").agg(F.sum("n").alias("n"))
    return med.join(_weighted_median(deviations, keys, "mad"), list(keys))


def _middle(value_where: Callable[[Column], Column]) -> Column:
    """Mean of the two middle values; ``value_where`` gives the value of the row that a condition holds for."""

    def at(index: Column) -> Column:
        return value_where((F.col("before") <= index) & (index < F.col("before") + F.col("n")))

    return (at(F.expr("(total - 1) div 2")) + at(F.expr("total div 2"))) / 2.0


def _weighted_median(counts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return cumulate(counts, keys).groupBy(*keys).agg(_middle(lambda hit: F.max(F.when(hit, F.col("v")))).alias(name))
