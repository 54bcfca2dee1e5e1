"""Pixel colocalization of two channels per key, from two grouped passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.operators.stats import spearman

MIN_PIXELS = 10


def _or_zero(ok: Column, value: Column) -> Column:
    return F.when(ok, value).otherwise(F.lit(0.0))


def spearman_by(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """(keys, rho), 0 where a side is constant."""
    out = spearman(df, x, y, keys, min_n=1, with_p=False)
    return out.select(*keys, F.coalesce("rho", F.lit(0.0)).alias("rho"))


def coloc_metrics(pixels: DataFrame, thresholds: DataFrame, keys: Sequence[str], threshold_keys: Sequence[str]) -> DataFrame:
    """Correlation, overlap and threshold metrics of channel values ``a`` and ``b``.

    pixels (keys, a, b); thresholds (threshold_keys, thr_a, thr_b). Keys with fewer than ten pixels get
    zeros. Means come first, so that centred products are summed rather than differenced.
    """
    means = pixels.groupBy(*keys).agg(F.avg("a").alias("a_mean"), F.avg("b").alias("b_mean"))
    a, b = F.col("a"), F.col("b")
    da, db = a - F.col("a_mean"), b - F.col("b_mean")
    apos, bpos = a >= F.col("thr_a"), b >= F.col("thr_b")

    def count(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("double")

    def total(value: Column, cond: Column | None = None) -> Column:
        return F.sum(value if cond is None else F.when(cond, value).otherwise(0.0))

    s = (
        pixels.join(means, list(keys))
        .join(thresholds, list(threshold_keys), "left")
        .groupBy(*keys, "a_mean", "b_mean", "thr_a", "thr_b")
        .agg(
            F.count(F.lit(1)).alias("n_pix"),
            total(a).alias("sum_a"), total(b).alias("sum_b"), total(a * b).alias("sum_product"),
            total(da * db).alias("dab"), total(da * da).alias("daa"), total(db * db).alias("dbb"),
            total(a * a).alias("aa"), total(b * b).alias("bb"), total(F.least(a, b)).alias("sum_min"),
            count(da * db > 0).alias("same"), count(apos).alias("na"), count(bpos).alias("nb"), count(apos & bpos).alias("both"),
            total(a, bpos).alias("a_in_b"), total(b, apos).alias("b_in_a"),
        )
    )
    n = F.col("n_pix").cast("double")
    na, nb, both = F.col("na"), F.col("nb"), F.col("both")
    c = F.col
    enough = c("n_pix") >= MIN_PIXELS
    b_hi, b_lo = _or_zero(na > 0, c("b_in_a") / na), _or_zero(n - na > 0, (c("sum_b") - c("b_in_a")) / (n - na))
    a_hi, a_lo = _or_zero(nb > 0, c("a_in_b") / nb), _or_zero(n - nb > 0, (c("sum_a") - c("a_in_b")) / (n - nb))

    def enrichment(hi: Column, lo: Column) -> Column:
        return F.when(lo > 0, hi / lo).when(hi > 0, hi).otherwise(F.lit(0.0))

    union = na + nb - both
    metrics = {
        "pearson_r": _or_zero((c("daa") > 0) & (c("dbb") > 0), c("dab") / F.sqrt(c("daa") * c("dbb"))),
        "cosine_overlap": _or_zero((c("aa") > 0) & (c("bb") > 0), c("sum_product") / F.sqrt(c("aa") * c("bb"))),
        "li_icq": c("same") / n - 0.5,
        "manders_m1": _or_zero(c("sum_a") > 0, c("a_in_b") / c("sum_a")),
        "manders_m2": _or_zero(c("sum_b") > 0, c("b_in_a") / c("sum_b")),
        "jaccard": _or_zero(union > 0, both / union),
        "dice": _or_zero(na + nb > 0, 2.0 * both / (na + nb)),
        "both_frac": both / n,
        "a_frac_above": na / n,
        "b_frac_above": nb / n,
        "b_enrich_in_a_high": enrichment(b_hi, b_lo),
        "a_enrich_in_b_high": enrichment(a_hi, a_lo),
        "min_frac_a": _or_zero(c("sum_a") > 0, c("sum_min") / c("sum_a")),
        "min_frac_b": _or_zero(c("sum_b") > 0, c("sum_min") / c("sum_b")),
        "a_mean": c("a_mean"), "b_mean": c("b_mean"), "sum_a": c("sum_a"), "sum_b": c("sum_b"),
        "sum_product": c("sum_product"), "sum_min": c("sum_min"),
    }
    return s.select(
        *keys, "n_pix",
        *[F.when(enough, F.col(t)).alias(t) for t in ("thr_a", "thr_b")],
        *[_or_zero(enough, expr).alias(name) for name, expr in metrics.items()],
    )
