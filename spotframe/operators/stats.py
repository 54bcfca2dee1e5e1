"""Group statistics as aggregates: rank tests, t tests, correlations, distribution summaries.

Every test is one ranked or one grouped pass over a long table, for any number of keys at once, and
ends in a small table of statistics. Ranks come from ``spotframe.functions.ranks``, so pooled tests
over whole runs do not gather a metric in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.functions.ranks import cumulate, median_table, quantiles, value_counts, value_ranks
from spotframe.functions.scalars import stars
from spotframe.functions.tails import chi2_p, rho_p, t_p, u_p


def long_table(df: DataFrame, metrics: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep..., metric, v): the listed numeric columns stacked."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics]
    return df.select(*keep, F.explode(F.array(*cells)).alias("_s")).select(*keep, "_s.metric", "_s.v")


def avg_rank(df: DataFrame, v: str, keys: Sequence[str]) -> DataFrame:
    """``df`` with its average-tie rank inside ``keys``."""
    ranks = value_ranks(df, v, keys).select(*keys, F.col("v").alias("_v"), "rank")
    return df.withColumn("_v", F.col(v).cast("double")).join(ranks, [*keys, "_v"], "left").drop("_v")


def mean_sem_n(df: DataFrame, v: str, keys: Sequence[str]) -> DataFrame:
    n = F.count(v)
    return df.groupBy(*keys).agg(F.avg(v).alias("mean"), (F.stddev_samp(v) / F.sqrt(n)).alias("sem"), n.alias("n"))


def mann_whitney(df: DataFrame, v: str, group: str, a: str, b: str, keys: Sequence[str] = (), with_p: bool = True) -> DataFrame:
    """U of group a against b, tie term, and Cliff's delta; NULL where a side has fewer than two values."""
    ranks = value_ranks(
        df.where(F.col(group).isin(a, b)), v, keys, {"n_a": F.col(group) == a, "n_b": F.col(group) == b}
    )
    n = F.col("n").cast("double")
    sums = ranks.groupBy(*keys).agg(
        F.sum("n_a").alias("n_a"),
        F.sum("n_b").alias("n_b"),
        F.sum(F.col("n_a") * F.col("rank")).alias("_r"),
        F.sum(n * n * n - n).alias("ties"),
    )
    enough = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    u = F.col("_r") - F.col("n_a") * (F.col("n_a") + 1) / 2.0
    out = sums.withColumn("u", F.when(enough, u)).withColumn("cliffs_delta", 2.0 * F.col("u") / (F.col("n_a") * F.col("n_b")) - 1.0)
    if with_p:
        out = out.withColumn("p", u_p("u", "n_a", "n_b", "ties"))
    return out.drop("_r")


def cliffs_delta(df: DataFrame, v: str, group: str, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    return mann_whitney(df, v, group, a, b, keys, with_p=False).select(*keys, "n_a", "n_b", "cliffs_delta")


def welch(df: DataFrame, v: str, group: str, a: str, b: str, keys: Sequence[str] = (), with_p: bool = True) -> DataFrame:
    """Welch and Student t of a against b with Cohen's d; tests need two values on each side."""
    value = F.col(v).cast("double")
    sides = {"a": F.when(F.col(group) == a, value), "b": F.when(F.col(group) == b, value)}
    aggs = []
    for s, c in sides.items():
        aggs += [F.count(c).alias(f"n_{s}"), F.avg(c).alias(f"mean_{s}"), F.stddev_samp(c).alias(f"sd_{s}")]
    rows = df.where(F.col(group).isin(a, b))
    out = rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)
    return _t_columns(out, with_p)


def _t_columns(out: DataFrame, with_p: bool) -> DataFrame:
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    va, vb = F.col("sd_a") * F.col("sd_a"), F.col("sd_b") * F.col("sd_b")
    diff = F.col("mean_a") - F.col("mean_b")
    enough = (na >= 2) & (nb >= 2)
    se2 = va / na + vb / nb
    pooled = ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
    welch_df = se2 * se2 / ((va / na) * (va / na) / (na - 1) + (vb / nb) * (vb / nb) / (nb - 1))
    out = (
        out.withColumn("t", F.when(enough & (se2 > 0), diff / F.sqrt(se2)))
        .withColumn("df", F.when(enough & (se2 > 0), welch_df))
        .withColumn("student_t", F.when(enough & (pooled > 0), diff / F.sqrt(pooled * (1.0 / na + 1.0 / nb))))
        .withColumn("cohens_d", F.when(enough & (va + vb > 0), diff / F.sqrt((va + vb) / 2.0)))
        .withColumn("direction", F.when(F.col("mean_a") > F.col("mean_b"), "A>B").otherwise("B>A"))
    )
    if with_p:
        out = (
            out.withColumn("welch_p", t_p("t", "df"))
            .withColumn("student_p", t_p("student_t", F.col("n_a") + F.col("n_b") - F.lit(2.0)))
            .withColumn("sig", F.when(enough, stars(F.col("welch_p"))).otherwise(F.lit("n/a (n<2)")))
        )
    return out


def kruskal(df: DataFrame, v: str, group: str, keys: Sequence[str] = (), with_p: bool = True) -> DataFrame:
    """H over all groups of a key, tie-corrected, with the number of groups."""
    ranks = value_ranks(df, v, keys)
    ties = ranks.groupBy(*keys).agg(
        F.sum(F.col("n").cast("double") * F.col("n") * F.col("n") - F.col("n")).alias("ties"), F.max("total").alias("n")
    )
    per_group = (
        value_counts(df, v, [*keys, group])
        .withColumnRenamed("n", "_n")
        .join(ranks.select(*keys, "v", "rank"), [*keys, "v"])
        .groupBy(*keys, group)
        .agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") * F.col("rank")).alias("_r"))
    )
    sums = per_group.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("_r") * F.col("_r") / F.col("_n")).alias("_s")
    )
    n = F.col("n").cast("double")
    raw = 12.0 / (n * (n + 1)) * F.col("_s") - 3.0 * (n + 1)
    correction = 1.0 - F.col("ties") / (n * n * n - n)
    joined = sums.join(ties, list(keys)) if keys else sums.withColumn("_k", F.lit(1)).join(ties.withColumn("_k", F.lit(1)), "_k").drop("_k")
    out = joined.withColumn("h", F.when((F.col("k") >= 2) & (n > 1) & (correction > 0), raw / correction)).drop("_s")
    return out.withColumn("p", chi2_p("h", (F.col("k") - 1).cast("double"))) if with_p else out


def spearman(
    df: DataFrame, x: str | Column, y: str | Column, keys: Sequence[str] = (), min_n: int = 8, with_p: bool = True
) -> DataFrame:
    """(keys, n, rho): rank correlation over rows where both values exist; NULL below ``min_n`` or if constant."""
    xs = F.col(x) if isinstance(x, str) else x
    ys = F.col(y) if isinstance(y, str) else y
    pairs = (
        df.select(*keys, xs.cast("double").alias("x"), ys.cast("double").alias("y"))
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy(*keys, "x", "y")
        .agg(F.count(F.lit(1)).alias("_m"))
    )

    def side(c: str) -> DataFrame:
        counts = pairs.groupBy(*keys, F.col(c).alias("v")).agg(F.sum("_m").alias("n"))
        centred = F.col("before") + (F.col("n") + 1) / 2.0 - (F.col("total") + 1) / 2.0
        return cumulate(counts, keys).select(*keys, F.col("v").alias(c), centred.alias(f"r{c}"))

    ranked = pairs.join(side("x"), [*keys, "x"]).join(side("y"), [*keys, "y"])
    m, rx, ry = F.col("_m"), F.col("rx"), F.col("ry")
    sums = ranked.groupBy(*keys).agg(
        F.sum("_m").alias("n"), F.sum(m * rx * ry).alias("_xy"), F.sum(m * rx * rx).alias("_xx"), F.sum(m * ry * ry).alias("_yy")
    )
    defined = (F.col("n") >= min_n) & (F.col("_xx") > 0) & (F.col("_yy") > 0)
    rho = F.col("_xy") / (F.sqrt("_xx") * F.sqrt("_yy"))
    out = sums.withColumn("rho", F.when(defined, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho)))).drop("_xy", "_xx", "_yy")
    return out.withColumn("p", rho_p(F.col("rho"), F.col("n"))) if with_p else out


def distribution(df: DataFrame, v: str, keys: Sequence[str]) -> DataFrame:
    """n, mean, median, sd, CV and population skew per key."""
    value = F.col(v).cast("double")
    rows = df.where(value.isNotNull())
    n = F.count(value)
    stats = rows.groupBy(*keys).agg(
        n.alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.when((n > 2) & (F.var_pop(value) > 0), F.skewness(value)).alias("skew"),
    )
    return (
        stats.join(median_table(rows, {"median": v}, keys), list(keys))
        .withColumn("cv", F.when((F.col("n") > 1) & (F.col("mean") != 0), F.col("sd") / F.col("mean")))
    )


def replicate_test(df: DataFrame, v: str, group: str, a: str, b: str, replicate: str, keys: Sequence[str] = (), with_p: bool = True) -> DataFrame:
    """Means per replicate, then Welch across replicates and the percent change of b over a."""
    means = df.where(F.col(group).isin(a, b)).groupBy(*keys, group, replicate).agg(F.avg(F.col(v).cast("double")).alias("_m"))
    out = welch(means.where(F.col("_m").isNotNull()), "_m", group, a, b, keys, with_p)
    change = F.when(F.col("mean_a") != 0, 100.0 * (F.col("mean_b") - F.col("mean_a")) / F.col("mean_a"))
    return out.withColumn("pct_change", change)


def replicate_tests(df: DataFrame, v: str, group: str, groups: Sequence[str], replicate: str, keys: Sequence[str] = (), with_p: bool = True) -> DataFrame:
    """``replicate_test`` of every further group against the first, with the group in column ``against``."""
    first, *others = groups
    return reduce(DataFrame.unionByName, [replicate_test(df, v, group, first, other, replicate, keys, with_p).withColumn("against", F.lit(other)) for other in others])


def quantile_edges(df: DataFrame, v: str, parts: int, keys: Sequence[str]) -> DataFrame:
    """(keys, edges): interpolated quantile edges with repeats removed."""
    names = {f"q{i}": i / parts for i in range(parts + 1)}
    q = quantiles(df, v, keys, names)
    return q.select(*keys, F.array_distinct(F.array(*list(names))).alias("edges"))


def quantile_bin(df: DataFrame, v: str, parts: int, keys: Sequence[str], name: str = "bin") -> DataFrame:
    """0-based quantile bin of each row: right-closed intervals, the lowest edge included."""
    edges = quantile_edges(df, v, parts, keys)
    above = F.size(F.filter("edges", lambda e: e < F.col(v).cast("double")))
    inside = F.greatest(above - 1, F.lit(0))
    joined = df.join(edges, list(keys), "left") if keys else df.withColumn("_k", F.lit(1)).join(F.broadcast(edges.withColumn("_k", F.lit(1))), "_k", "left").drop("_k")
    return joined.withColumn(name, F.when(F.col(v).isNotNull() & (F.size("edges") > 1), inside)).drop("edges")


