"""Mixing sources to target weights: whole copies, then Pareto order sampling of the remainder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.llm.common import WORD, save, text_or_empty

#: Order slices per source. A slice holds this share of a source at most, whatever its size.
SLICES = 4096
#: Documents of a source that may change sides at the cut, one after the other.
SWAPS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source.

    Sources by code point, null last, take the weights in turn and share the total. A target stops at
    cap times its source; what lies above is shared again by weight. That ends at the water level: the
    smallest L with sum(min(cap * size, L * weight)) = total, found by prefix sums over the sources in
    the order in which they fill up.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1).cast("long")
    named = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(cap))
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        named.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("level", F.col("left").cast("double") / F.col("open"))
        .withColumn("stop", F.col("level") * F.col("w") <= F.col("cap"))
    )
    # the first source, in filling order, that the level does not fill fixes the level of all after it
    fixed = levels.withColumn("level", F.min(F.when(F.col("stop"), F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("w"))
    extra = [c for c in sizes.columns if c not in ("source", "source_size")]
    return fixed.select("source", "source_size", target.alias("target"), *extra)


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: int = 17,
    propensity: Column | None = None,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken): one row per input row.

    A document of a source with ratio r = target / size is expected r * p times, p its propensity
    (default: 1 for every document; it is scaled to mean 1 by size inside its source). The whole part of
    the expectation is allocated for certain. The fraction f is its inclusion probability for one more
    copy; documents are ranked by the odds of their random number over the odds of f (Pareto order
    sampling) and taken in that order up to the words the source still lacks. The sample is fixed in
    words instead of documents because documents differ in length. The order leaves less than one
    document open; up to SWAPS documents of a source are then put in or left out where that brings it nearer
    to its target. No document is taken more than `cap` times.

    Defined cases: null texts have size 0 and take 0; a null source is a source of its own, last in order;
    ties in the random number (a repeated id) fall in order of size; rows that are equal in all of
    these are interchangeable; sources without words get target 0; an empty table gives no rows.
    """
    p = (F.lit(1.0) if propensity is None else F.greatest(F.coalesce(propensity.cast("double"), F.lit(0.0)), F.lit(0.0))).alias("_p")
    rows = save(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), p))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("_p")).alias("_ps"))
    targets = source_targets(sums, weights, cap)
    plan = save(targets.withColumn("_scale", F.when(F.col("_ps") > 0, F.col("source_size") / F.col("_ps")).otherwise(1.0)).drop("_ps").withColumnRenamed("source", "_s"))
    # one row per source: bounded by the number of sources, never by the number of documents
    same_source = rows["source"].eqNullSafe(plan["_s"])
    expected = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size") * F.col("_p") * F.col("_scale"))).otherwise(0.0)
    odds = lambda x: x / (1 - x)
    u, f = uniform(F.col("_id"), seed), F.col("_f")
    drawn = (
        rows.join(plan, same_source)
        .withColumn("_whole", F.floor(expected).cast("long"))
        .withColumn("_f", expected - F.floor(expected))
        .withColumn("_q", F.when((f > 0) & (F.col("size") > 0), odds(u) / odds(f)))
        # a monotonic image of the rank in [0, 1): where a document stands inside its source
        .withColumn("_slice", F.floor(F.col("_q") / (1 + F.col("_q")) * SLICES).cast("int"))
    )
    drawn = save(drawn)
    whole = drawn.groupBy("_s").agg(F.sum(F.col("_whole") * F.col("size")).alias("_certain"))
    slices = drawn.where(F.col("_q").isNotNull()).groupBy("_s", "_slice").agg(F.sum("size").alias("_words"))
    running = Window.partitionBy("_s").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_s", "_slice", F.coalesce(F.sum("_words").over(running), F.lit(0)).alias("_offset"))
    a, b, c = drawn.alias("a"), offsets.alias("b"), whole.alias("c")
    inside = Window.partitionBy("_s", "_slice").orderBy("_q", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        a.join(b, F.expr("a._s <=> b._s AND a._slice = b._slice"), "left")
        .join(c, F.expr("a._s <=> c._s"))
        .select("a.*", "_offset", (F.col("target") - F.col("_certain")).alias("_need"))
        .withColumn("_upto", F.when(F.col("_q").isNotNull(), F.col("_offset") + F.sum("size").over(inside)))
        .withColumn("_place", F.row_number().over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_in", F.coalesce(F.col("_upto") <= F.col("_need"), F.lit(False)))
    )
    ranked = save(ranked.drop("_offset"))
    for _ in range(SWAPS):
        ranked = _closer(ranked)
    copies = F.col("_whole") + F.col("_in").cast("long")
    return ranked.select(F.col("_id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _closer(ranked: DataFrame) -> DataFrame:
    """ranked with one document of each source put in or left out, where that brings the source nearer to its target.

    The document whose size comes nearest to the gap is chosen, the first in the drawn order among equals.
    """
    gaps = ranked.groupBy(F.col("_s").alias("_gs")).agg((F.first("_need") - F.coalesce(F.sum(F.when(F.col("_in"), F.col("size"))), F.lit(0))).alias("_gap"))
    change = F.when(F.col("_in"), -F.col("size")).otherwise(F.col("size"))
    off = F.abs(F.col("_gap") - change)
    best = (
        ranked.join(gaps, F.expr("_s <=> _gs"))
        .where(F.col("_q").isNotNull() & (off < F.abs("_gap")))
        .groupBy("_gs")
        .agg(F.min(F.struct(off.alias("off"), F.col("_slice").alias("slice"), F.col("_place").alias("place"))).alias("_b"))
        .select("_gs", F.col("_b.slice").alias("_bs"), F.col("_b.place").alias("_bp"))
    )
    flipped = ranked.join(save(best), F.expr("_s <=> _gs AND _slice = _bs AND _place = _bp"), "left")
    return flipped.withColumn("_in", F.col("_in") != F.col("_bp").isNotNull()).drop("_gs", "_bs", "_bp")
