"""Sharpness of slices and the choice of planes and z windows."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.functions.ranks import median_and_mad, quantiles
from spotframe.functions.scalars import ratio
from spotframe.operators.distance import morph
from spotframe.operators.frames import _neighbour_rows
from spotframe.operators.thresholds import otsu
from spotframe.session import cut_lineage

GAUSSIAN_MAD = 1.4826
SLICE = ["image", "channel", "z"]
# 3 x 3 weights, as (dy, dx): weight.
LAPLACE = {(-1, 0): 1.0, (0, -1): 1.0, (0, 0): -4.0, (0, 1): 1.0, (1, 0): 1.0}
SOBEL_Y = {(-1, -1): -1.0, (-1, 0): -2.0, (-1, 1): -1.0, (1, -1): 1.0, (1, 0): 2.0, (1, 1): 1.0}
SOBEL_X = {(-1, -1): -1.0, (0, -1): -2.0, (1, -1): -1.0, (-1, 1): 1.0, (0, 1): 2.0, (1, 1): 1.0}


def _weighted(weights: dict[tuple[int, int], float], x: Column) -> Column:
    last = F.size("vals") - 1
    terms = [F.get(F.col(f"`r{dy}`"), F.greatest(F.lit(0), F.least(x + dx, last))) * w for (dy, dx), w in weights.items()]
    return reduce(lambda a, b: a + b, terms)


def focus_scores(
    plane_rows: DataFrame, metric: str = "variance_of_laplacian", intensity_weighted: bool = False, mask: DataFrame | None = None, min_intensity: float = 0.0
) -> DataFrame:
    """(image, channel, z, score, mean): sharpness of each slice; 0 where its mean is not positive.

    A pixel past the edge repeats the edge pixel. With ``mask`` (image, y, x) only its pixels count towards mean and score,
    while filters still see their real neighbours; slices of images outside the mask score 0. Slices dimmer
    than ``min_intensity`` times the brightest of their stack score 0.
    """

    def values(rows: DataFrame, of: Column | str, name: str) -> DataFrame:
        if mask is None:
            return rows.select(*SLICE, F.explode(of).alias(name))
        return rows.select(*SLICE, "y", F.posexplode(of).alias("x", name)).join(mask.select("image", "y", "x"), ["image", "y", "x"], "left_semi")

    flat = values(plane_rows, "vals", "v")
    level = flat.groupBy(*SLICE).agg(F.avg("v").alias("mean"), F.var_pop("v").alias("_var"))
    if metric == "normalized_variance":
        scored = level.withColumn("score", F.col("_var") / F.when(F.col("mean") > 0, F.col("mean") * F.col("mean")))
    else:
        near = _neighbour_rows(plane_rows, 1, clip=True)
        xs = F.sequence(F.lit(0), F.size("vals") - 1)
        if metric == "variance_of_laplacian":
            value, total = F.transform(xs, lambda x: _weighted(LAPLACE, x)), F.var_pop("e")
            scale = F.col("mean") * F.col("mean")
        elif metric == "tenengrad":
            value = F.transform(xs, lambda x: _weighted(SOBEL_Y, x) * _weighted(SOBEL_Y, x) + _weighted(SOBEL_X, x) * _weighted(SOBEL_X, x))
            total, scale = F.sum("e"), F.col("mean") * F.col("mean")
        else:
            raise ValueError(f"unknown metric {metric}")
        # both filters are linear, so dividing by the mean beforehand equals scaling the result
        raw = values(near, value, "e").groupBy(*SLICE).agg(total.alias("_raw"))
        scored = level.join(raw, SLICE).withColumn("score", F.col("_raw") / F.when(F.col("mean") > 0, scale))
    if mask is not None:
        scored = plane_rows.select(*SLICE).distinct().join(scored, SLICE, "left").fillna(0.0, ["mean"])
    score = F.coalesce("score", F.lit(0.0))
    out = scored.select(*SLICE, (score * F.col("mean") if intensity_weighted else score).alias("score"), "mean")
    if min_intensity <= 0:
        return out
    dim = F.col("mean") < F.max("mean").over(Window.partitionBy("image", "channel")) * min_intensity
    return out.withColumn("score", F.when(dim, 0.0).otherwise(F.col("score")))


def best_plane(scores: DataFrame, keys: tuple[str, ...] = ("image", "channel")) -> DataFrame:
    """(keys, z): the highest score, the lowest slice among equals."""
    return scores.groupBy(*keys).agg(F.max_by("z", F.struct("score", -F.col("z"))).alias("z"))


def peak_z(scores: DataFrame, lo: int | None = None, hi: int | None = None, central_fraction: float = 0.0, min_intensity_frac: float = 0.0) -> DataFrame:
    """(image, lo, hi, peak_z, peak_score): best slice in the middle of the range, dim slices left out."""
    bounds = scores.groupBy("image").agg(F.min("z").alias("_a"), F.max("z").alias("_b"), F.max("mean").alias("_top"))
    low = F.greatest("_a", F.lit(lo)) if lo is not None else F.col("_a")
    high = F.least("_b", F.lit(hi)) if hi is not None else F.col("_b")
    ranged = bounds.select("image", low.alias("lo"), high.alias("hi"), "_top")
    span = F.col("hi") - F.col("lo") + 1
    if 0.0 < central_fraction < 1.0:
        keep = F.greatest(F.lit(1), F.rint(span * central_fraction).cast("int"))
        margin = F.floor((span - keep) / 2).cast("int")
        first, last = F.col("lo") + margin, F.col("hi") - (span - keep - margin)
    else:
        first, last = F.col("lo"), F.col("hi")
    rows = scores.join(ranged.withColumn("_p0", first).withColumn("_p1", last), "image")
    dim = F.col("mean") < F.col("_top") * min_intensity_frac if min_intensity_frac > 0 else F.lit(False)
    rows = rows.withColumn("score", F.when(dim, F.lit(float("-inf"))).otherwise(F.col("score")))
    inside = rows.where((F.col("z") >= F.col("_p0")) & (F.col("z") <= F.col("_p1")))
    best = inside.groupBy("image", "lo", "hi").agg(F.max_by("z", F.struct("score", -F.col("z"))).alias("peak_z"), F.max("score").alias("peak_score"))
    return best


def fixed_window(peak: DataFrame, n: int) -> DataFrame:
    """(image, z_start, z_end, shifted, shrunk): n slices about the peak, slid into bounds, cut only if n spans them."""
    span = F.col("hi") - F.col("lo") + 1
    start = F.col("peak_z") - n // 2
    slid = F.greatest(F.col("lo"), F.least(start, F.col("hi") - (n - 1)))
    whole = F.lit(n) >= span
    return peak.select(
        "image",
        F.when(whole, F.col("lo")).otherwise(slid).alias("z_start"),
        F.when(whole, F.col("hi")).otherwise(slid + (n - 1)).alias("z_end"),
        (~whole & (slid != start)).alias("shifted"),
        whole.alias("shrunk"),
    )


def focus_window(scores: DataFrame, peak: DataFrame, frac: float = 0.5, min_slices: int = 3, max_slices: int = 0) -> DataFrame:
    """(image, z_start, z_end, expanded, clipped): the unbroken run of good slices around the peak."""
    rows = scores.join(peak, "image").where((F.col("z") >= F.col("lo")) & (F.col("z") <= F.col("hi")))
    low = F.col("score") < F.col("peak_score") * frac
    z, at = F.col("z"), F.col("peak_z")
    runs = rows.groupBy("image", "lo", "hi", "peak_z").agg(
        F.coalesce(F.max(F.when(low & (z < at), z)) + 1, F.first("lo")).alias("ws"),
        F.coalesce(F.min(F.when(low & (z > at), z)) - 1, F.first("hi")).alias("we"),
    )
    lo, hi = F.col("lo"), F.col("hi")

    def grow(w: Column, _: Column) -> Column:
        left, right = w["s"] - lo, hi - w["e"]
        full = (w["e"] - w["s"] + 1 >= max(1, min_slices)) | ((left == 0) & (right == 0))
        go_left = (left >= right) & (left > 0)
        return F.struct(
            F.when(~full & go_left, w["s"] - 1).otherwise(w["s"]).alias("s"), F.when(~full & ~go_left, w["e"] + 1).otherwise(w["e"]).alias("e")
        )

    start = F.struct(F.col("ws").alias("s"), F.col("we").alias("e"))
    grown = runs.withColumn("_g", F.aggregate(F.array(*[F.lit(i) for i in range(max(1, min_slices))]), start, grow))
    s, e = F.col("_g.s"), F.col("_g.e")
    clipped = (e - s + 1 > max_slices) if max_slices > 0 else F.lit(False)
    cut_start = F.greatest(lo, F.least(F.greatest(lo, at - max_slices // 2), hi - (max_slices - 1)))
    return grown.select(
        "image",
        F.when(clipped, cut_start).otherwise(s).alias("z_start"),
        F.when(clipped, F.least(cut_start + (max_slices - 1), hi)).otherwise(e).alias("z_end"),
        ((s != F.col("ws")) | (e != F.col("we"))).alias("expanded"),
        clipped.alias("clipped"),
    )


def joint_score(scores: DataFrame, reduce_by: str = "product") -> DataFrame:
    """(image, z, score) over channels, each scaled to its own peak; a channel without a positive score decides nothing."""
    peak = F.max("score").over(Window.partitionBy("image", "channel"))
    scaled = scores.withColumn("_s", F.when(peak > 0, F.coalesce(ratio(F.col("score"), peak), F.lit(0.0))).otherwise(1.0))
    logs = F.when(F.min("_s") > 0, F.exp(F.sum(F.when(F.col("_s") > 0, F.log("_s"))))).otherwise(0.0)
    how = {
        "product": logs,
        "geomean": F.when(F.min("_s") > 0, F.exp(F.avg(F.when(F.col("_s") > 0, F.log("_s"))))).otherwise(0.0),
        "min": F.min("_s"),
    }
    return scaled.groupBy("image", "z").agg(how[reduce_by].alias("score"))


def joint_plane(scores: DataFrame, reduce_by: str = "product") -> DataFrame:
    return best_plane(joint_score(scores, reduce_by), ("image",))


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    """Weights of a sampled gaussian from -reach to reach, which add up to 1."""
    reach = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)]
    return [w / sum(raw) for w in raw]


def _smooth_batches(batches: Iterator[pa.RecordBatch], weights: list[float]) -> Iterator[pa.RecordBatch]:
    """Replace vals by the smoothed values: down the rows of `_rows`, then along x. A missing value leaves its reach empty."""
    reach = len(weights) // 2
    for batch in batches:
        rows = batch.column("_rows").flatten()
        v = rows.flatten().to_numpy(zero_copy_only=False)
        missing = rows.flatten().is_null().to_numpy(zero_copy_only=False)
        sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, len(weights))
        starts = np.concatenate(([0], np.cumsum(sizes.ravel())[:-1])).reshape(sizes.shape)
        widths = batch.column("vals").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(widths)))
        out, empty = np.zeros(ends[-1]), np.zeros(ends[-1], dtype=bool)
        for width in np.unique(widths[widths > 0]):
            of, xs = np.flatnonzero(widths == width), np.arange(width)
            mirrored = (xs[:, None] + np.arange(-reach, reach + 1)) % (2 * width)
            mirrored = np.where(mirrored < width, mirrored, 2 * width - 1 - mirrored)
            down, lost = np.zeros((len(of), width)), np.zeros((len(of), width), dtype=bool)
            for d, w in enumerate(weights):
                there = xs < sizes[of, d][:, None]
                at = np.where(there, starts[of, d][:, None] + xs, 0)
                down += v[at] * w
                lost |= ~there | missing[at]
            along, gone = np.zeros_like(down), np.zeros_like(lost)
            for d, w in enumerate(weights):
                along += down[:, mirrored[:, d]] * w
                gone |= lost[:, mirrored[:, d]]
            to = ends[of][:, None] + xs
            out[to], empty[to] = along, gone
        vals = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out, mask=empty))
        yield pa.RecordBatch.from_arrays([vals if n == "vals" else batch.column(n) for n in batch.schema.names if n != "_rows"], [n for n in batch.schema.names if n != "_rows"])


def gaussian_rows(plane_rows: DataFrame, sigma: float) -> DataFrame:
    """A plane smoothed by a gaussian, the frame being mirrored at its edges (the edge pixel repeated).

    Two passes of one dimension over row arrays: each row with the rows within reach in one window over y, then
    each row along x, both in numpy over batches of rows. Rows of a plane are numbered from 0 without gaps.
    """
    weights = gaussian_weights(sigma)
    reach = len(weights) // 2
    plane = [c for c in ("image", "channel", "z") if c in plane_rows.columns]

    def mirrored(i: Column, n: Column) -> Column:
        # ... 1 0 | 0 1 ... n-1 | n-1 n-2 ...
        at = F.pmod(i, 2 * n)
        return F.when(at < n, at).otherwise(2 * n - 1 - at).cast("int")

    whole = Window.partitionBy(*plane)
    # a frame lower than the reach is mirrored more than once, so rows farther away may be needed
    near = whole.orderBy("y").rowsBetween(-2 * reach, 2 * reach)
    rows = plane_rows.withColumn("_h", F.max("y").over(whole) + 1).withColumn("_near", F.collect_list("vals").over(near)).withColumn("_from", F.greatest(F.col("y") - 2 * reach, F.lit(0)))
    picked = F.array(*[F.get("_near", (mirrored(F.col("y") + d, F.col("_h")) - F.col("_from")).cast("int")) for d in range(-reach, reach + 1)])
    picked_rows = rows.withColumn("vals", F.col("vals").cast("array<double>")).select(*plane_rows.columns, picked.cast("array<array<double>>").alias("_rows"))
    return picked_rows.mapInArrow(lambda batches: _smooth_batches(batches, weights), picked_rows.drop("_rows").schema)


def brightest_rows(plane_rows: DataFrame) -> DataFrame:
    """(image, y, vals): the largest value over the slices at each pixel, in row form."""
    at = F.sequence(F.lit(0), F.size(F.get("_v", F.lit(0))) - 1)
    stacked = plane_rows.groupBy("image", "y").agg(F.collect_list("vals").alias("_v"))
    return stacked.select("image", "y", F.transform(at, lambda x: F.array_max(F.transform("_v", lambda row: F.get(row, x)))).alias("vals"))


def _in_window(plane_rows: DataFrame, z_start: int | None, z_end: int | None) -> DataFrame:
    """Slices within the bounds; the whole stack of an image where the bounds leave none of it."""
    if z_start is None and z_end is None:
        return plane_rows
    inside = (F.col("z") >= F.lit(z_start if z_start is not None else -(1 << 31))) & (F.col("z") <= F.lit(z_end if z_end is not None else (1 << 31) - 1))
    some = plane_rows.groupBy("image").agg(F.max(inside).alias("_some"))
    return plane_rows.join(some, "image").where(inside | ~F.col("_some")).drop("_some")


def nuclear_mask(dapi_rows: DataFrame, sigma: float = 1.5, min_coverage: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """(mask (image, y, x), coverage (image, coverage, used)) of stacks (image, z, y, vals).

    The brightest value over z is smoothed, cut by Otsu's threshold, opened and closed with a cross; pixels beyond the
    frame count as unset throughout. A mask that is empty or covers less than min_coverage of the frame is not used: its
    pixels are left out and `used` is false.
    """
    smooth = cut_lineage(gaussian_rows(brightest_rows(dapi_rows), sigma))
    frame = smooth.groupBy("image").agg((F.max("y") + 1).alias("height"), F.max(F.size("vals")).alias("width"), F.sum(F.size("vals")).alias("_px"))
    pixels = smooth.select("image", "y", F.posexplode("vals").alias("x", "v"))
    bright = pixels.join(otsu(pixels, "v", ["image"]), "image").where(F.col("v") > F.col("thr")).select("image", "y", "x")
    mask = cut_lineage(morph(bright, frame, "clean", 1, outside=False))
    share = F.coalesce(F.col("_n"), F.lit(0)) / F.col("_px")
    coverage = frame.join(mask.groupBy("image").agg(F.count(F.lit(1)).alias("_n")), "image", "left").select("image", share.alias("coverage"))
    coverage = cut_lineage(coverage.withColumn("used", (F.col("coverage") > 0) & (F.col("coverage") >= min_coverage)))
    return mask.join(coverage.where("used").select("image"), "image", "left_semi"), coverage


def joint_focus(
    plane_rows: DataFrame,
    channels: Sequence[str | int],
    reduce_by: str = "product",
    z_start: int | None = None,
    z_end: int | None = None,
    intensity_weighted: bool = False,
    central_fraction: float = 0.0,
    min_intensity: float = 0.0,
    masked: bool = False,
) -> DataFrame:
    """(image, lo, hi, z, joint_score, mask_used, coverage): the slice at which all channels are in focus together.

    channels begins with the DAPI channel. Each channel's scores within lo .. hi are scaled to their own peak; only
    the central part of the window may be chosen where central_fraction is between 0 and 1; of equal slices the
    lowest wins. `masked` scores focus inside the nuclear mask; images whose mask is not used are scored whole.
    """
    rows = _in_window(plane_rows.where(F.col("channel").isin(*channels)), z_start, z_end)
    score = lambda df, mask: focus_scores(df, intensity_weighted=intensity_weighted, mask=mask, min_intensity=min_intensity)
    if masked:
        rows = cut_lineage(rows)
        mask, coverage = nuclear_mask(rows.where(F.col("channel") == channels[0]).select("image", "z", "y", "vals"))
        used = coverage.where("used").select("image")
        scores = score(rows.join(used, "image", "left_semi"), mask).unionByName(score(rows.join(used, "image", "left_anti"), None))
    else:
        scores, coverage = score(rows, None), None
    joint = cut_lineage(joint_score(cut_lineage(scores), reduce_by)).withColumn("mean", F.lit(0.0))
    best = peak_z(joint, central_fraction=central_fraction).select("image", "lo", "hi", F.col("peak_z").alias("z"), F.col("peak_score").alias("joint_score"))
    if coverage is None:
        return best.withColumns({"mask_used": F.lit(False), "coverage": F.lit(0.0)})
    return best.join(coverage.withColumnRenamed("used", "mask_used"), "image")


def plane_quality(planes: DataFrame, keys: Sequence[str] = ("image",)) -> DataFrame:
    """(keys, median, mad, p999, quality): how far the brightest pixels stand above the noise of a plane.

    quality is (p999 - median) / (1.4826 * MAD); without spread it is infinite where a bright tail exists, else 0.
    """
    level = median_and_mad(planes, "v", keys).join(quantiles(planes, "v", keys, {"p999": 0.999}), list(keys))
    above, noise = F.col("p999") - F.col("med"), F.col("mad") * GAUSSIAN_MAD
    quality = F.when(noise > 0, above / noise).when(above > 0, F.lit(float("inf"))).otherwise(0.0)
    return level.select(*keys, F.col("med").alias("median"), "mad", "p999", quality.alias("quality"))


def anchor_plane(scores: DataFrame, quality: DataFrame, minimum: float = 3.0) -> DataFrame:
    """(image, z, anchor): the RNA plane where its quality suffices, else the DAPI plane.

    scores (image, channel, z, score) with channels 'dapi' and 'rna'; quality (image, quality).
    """
    best = best_plane(scores).groupBy("image").agg(
        *[F.max(F.when(F.col("channel") == c, F.col("z"))).alias(c) for c in ("dapi", "rna")]
    )
    good = F.coalesce(F.col("quality") >= minimum, F.lit(False)) & F.col("rna").isNotNull()
    return best.join(quality, "image", "left").select(
        "image", F.when(good, F.col("rna")).otherwise(F.col("dapi")).alias("z"), F.when(good, "rna").otherwise("dapi").alias("anchor")
    )
