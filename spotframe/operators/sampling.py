"""Sampling planes around spots: disks, rings, windows, spot size, half-maximum footprints, spot finding."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.functions.scalars import FWHM_PER_SIGMA
from spotframe.functions.stencils import disk, rings, spans, square
from spotframe.operators.frames import _neighbour_rows, pixels_in, stencil_mean_rows, value_at
from spotframe.session import cut_lineage


def _sums_over(points: DataFrame, plane_rows: DataFrame, offsets: Sequence[tuple[int, int]], key: Sequence[str]) -> DataFrame:
    """Sum and count of the in-frame stencil pixels of every point, from one lookup per stencil row.

    ``key`` identifies a point and includes its image.
    """
    by_row = spans(offsets)
    reach = F.array(*[F.struct(F.lit(dy).alias("dy"), F.array(*[F.lit(d) for d in dxs]).alias("dxs")) for dy, dxs in by_row.items()])
    rows = plane_rows.select("image", F.col("y").alias("_row"), F.col("vals").alias("_vals"))
    cx = F.col("_cx")
    picked = F.transform("_dxs", lambda d: F.when(cx + d >= 0, F.get("_vals", F.greatest(cx + d, F.lit(0)))))
    seen = F.filter(picked, lambda v: v.isNotNull())
    spread = points.select(*key, "_cy", "_cx", F.explode(reach).alias("_o")).select(
        *key, "_cx", (F.col("_cy") + F.col("_o.dy")).alias("_row"), F.col("_o.dxs").alias("_dxs")
    )
    return (
        spread.join(rows, ["image", "_row"])
        .select(*key, F.aggregate(seen, F.lit(0.0), lambda a, v: a + v).alias("_s"), F.size(seen).alias("_n"))
        .groupBy(*key)
        .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    )


def _centred(points: DataFrame, y: str, x: str) -> DataFrame:
    return points.withColumn("_cy", F.rint(y).cast("long")).withColumn("_cx", F.rint(x).cast("int"))


def disk_mean_inbounds(spots: DataFrame, plane_rows: DataFrame, radius_px: float, key: Sequence[str] = ("image", "channel", "spot_id"), name: str = "partner_mean") -> DataFrame:
    """Mean of the disk pixels inside the frame; NULL where the whole disk is outside."""
    sums = _sums_over(_centred(spots, "y_px", "x_px"), plane_rows, disk(radius_px), key)
    means = sums.select(*key, F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).alias(name))
    return spots.join(means, list(key), "left")


def disk_mean_clipped(points: DataFrame, plane_rows: DataFrame, radius_px: float = 3.0, y: str = "y_px", x: str = "x_px", name: str = "disk_mean") -> DataFrame:
    """Mean over the disk with every offset clipped to the frame, so edge pixels may count repeatedly.

    The disk mean of every pixel is computed once per plane, after which a point is one lookup.
    """
    means = stencil_mean_rows(plane_rows, disk(radius_px))
    return value_at(_centred(points, y, x), means, "_cy", "_cx", name).drop("_cy", "_cx")


def annulus_mean(points: DataFrame, plane_rows: DataFrame, bins_px: Sequence[float], y: str = "y_px", x: str = "x_px") -> DataFrame:
    """One row per point and ring with the clipped mean of that ring; empty rings are NULL."""
    out = _centred(points, y, x)
    names = []
    for i, offsets in enumerate(rings(bins_px)):
        names.append(f"_ring{i}")
        out = value_at(out, stencil_mean_rows(plane_rows, offsets), "_cy", "_cx", f"_ring{i}") if offsets else out.withColumn(f"_ring{i}", F.lit(None).cast("double"))
    cells = [F.struct(F.lit(i).alias("ring"), F.col(n).alias("mean")) for i, n in enumerate(names)]
    return out.select(*points.columns, F.explode(F.array(*cells)).alias("_r")).select(*points.columns, "_r.ring", "_r.mean")


def windows(points: DataFrame, plane_rows: DataFrame, half: Column, key: Sequence[str], name: str = "win") -> DataFrame:
    """Per point the window rows around (_cy, _cx): array of (y, x0, vals), clipped to the frame."""
    dys = F.sequence(-half, half)
    rows = plane_rows.select("image", F.col("y").alias("_row"), F.col("vals").alias("_vals"))
    x0 = F.greatest(F.lit(0), F.col("_cx") - F.col("_half"))
    x1 = F.least(F.size("_vals") - 1, F.col("_cx") + F.col("_half"))
    return (
        points.withColumn("_half", half)
        .select(*key, "_cy", "_cx", "_half", F.explode(dys).alias("_d"))
        .withColumn("_row", F.col("_cy") + F.col("_d"))
        .join(rows, ["image", "_row"])
        .where(x1 >= x0)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct(F.col("_row").alias("y"), x0.alias("x0"), F.slice("_vals", x0 + 1, x1 - x0 + 1).alias("v")))).alias(name))
    )


def _fwhm_batches(batches: Iterator[pd.DataFrame], key: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Width in pixels from the second moment of each window above its tenth percentile."""
    for batch in batches:
        widths = []
        for win in batch["win"]:
            crop = np.array([np.asarray(r["v"], float) for r in win])
            signal = np.clip(crop - np.percentile(crop, 10), 0, None)
            total = signal.sum()
            if min(crop.shape) < 3 or total <= 0:
                widths.append(None)
                continue
            ys, xs = np.indices(crop.shape)
            my, mx = (ys * signal).sum() / total, (xs * signal).sum() / total
            var = (((ys - my) ** 2 + (xs - mx) ** 2) * signal).sum() / total
            widths.append(FWHM_PER_SIGMA * math.sqrt(max(var / 2.0, 0.25)))
        yield batch[list(key)].assign(fwhm_px=pd.Series(widths, dtype=float, index=batch.index))


def spot_fwhm(
    spots: DataFrame, plane_rows: DataFrame, voxel_xy_um: float = 0.13, half: int = 4, fallback_um: float | None = None,
    key: Sequence[str] = ("image", "channel", "spot_id"),
) -> DataFrame:
    """Add diameter_um: full width at half maximum from the second moment of the window above its p10."""
    win = windows(_centred(spots, "y_px", "x_px"), plane_rows, F.lit(half), key)
    kinds = dict(win.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in key], "fwhm_px double"])
    sized = win.mapInPandas(lambda it: _fwhm_batches(it, key), schema)
    nominal = fallback_um if fallback_um else 2.0 * voxel_xy_um
    width = F.coalesce(F.nanvl("fwhm_px", F.lit(None).cast("double")) * voxel_xy_um, F.lit(nominal))
    return spots.drop("diameter_um").join(sized, list(key), "left").withColumn("diameter_um", width).drop("fwhm_px")


#: Spots of an image that travel with its plane in one row.
SPOTS = 4096


def _grow(high: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Per window the 8-connected set pixels that reach the seed; windows are (n, height, width), seeds flat positions."""
    grown = np.zeros_like(high)
    grown.reshape(len(high), -1)[np.arange(len(high)), seed] = True
    live = np.arange(len(high))
    while live.size:
        old, open_ = grown[live], high[live]
        tall = old.copy()
        tall[:, 1:] |= old[:, :-1]
        tall[:, :-1] |= old[:, 1:]
        wide = tall.copy()
        wide[:, :, 1:] |= tall[:, :, :-1]
        wide[:, :, :-1] |= tall[:, :, 1:]
        wide &= open_
        more = (wide != old).any(axis=(1, 2))
        live, wide = live[more], wide[more]
        grown[live] = wide
    return grown


def _areas(a: np.ndarray, cy: np.ndarray, cx: np.ndarray, fwhm_px: np.ndarray, half_max: float, bg_pct: float) -> np.ndarray:
    """Footprints in windows of one shape (n, height, width), cy and cx being the places of the spots in them."""
    n, h, w = a.shape
    dy, dx = np.arange(h)[None, :, None] - cy[:, None, None], np.arange(w)[None, None, :] - cx[:, None, None]
    radius = np.maximum(1.0, fwhm_px / 2.0)
    areas = dy * dy + dx * dx <= (radius * radius)[:, None, None]
    if min(h, w) < 3:
        return areas
    flat = a.reshape(n, -1)
    seed = np.where((np.abs(dy) <= 1) & (np.abs(dx) <= 1), a, -np.inf).reshape(n, -1).argmax(axis=1)
    peak, background = flat[np.arange(n), seed], np.percentile(flat, bg_pct, axis=1)
    cut = background + half_max * (peak - background)
    found = np.flatnonzero((peak > background) & (peak >= cut))
    areas[found] = _grow(a[found] >= cut[found][:, None, None], seed[found])
    return areas


class _Planes:
    """Planes of a batch, one list of rows each: their values one after the other and where each row begins."""

    def __init__(self, column: pa.ListArray) -> None:
        self.first = column.offsets.to_numpy()
        vals = column.values.field("vals")
        self.start, self.flat = vals.offsets.to_numpy(), vals.values.to_numpy(zero_copy_only=False)
        self.known = vals.values.is_valid().to_numpy(zero_copy_only=False)
        self.size, self.y = np.diff(self.start), column.values.field("y").to_numpy()

    def at(self, of: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row is there, pixel is there, value) for pixels of the planes ``of``; the rows of a plane are sorted."""
        place = np.full(len(y), -1)
        for plane in np.unique(of):
            mine, rows = of == plane, self.y[self.first[plane] : self.first[plane + 1]]
            if rows.size:
                found = np.searchsorted(rows, y[mine]).clip(max=rows.size - 1)
                place[mine] = np.where(rows[found] == y[mine], self.first[plane] + found, -1)
        row = place >= 0
        inside = row & (x < np.where(row, self.size[place], 0))
        index = np.where(inside, self.start[place] + x, 0)
        inside &= self.known[index] if self.known.size else False
        return row, inside, self.flat[index] if self.flat.size else np.zeros(len(y))


FOOTPRINTS = "image long, channel string, spot_id long, ys array<long>, xs array<long>, total double, area long"


def _footprint_batches(batches: Iterator[pa.RecordBatch], half_max: float, bg_pct: float) -> Iterator[pa.RecordBatch]:
    """Windows of like shape are worked on together, over all images of a batch."""
    for batch in batches:
        spots = batch.column("spots")
        of = np.repeat(np.arange(batch.num_rows), spots.value_lengths().to_numpy(zero_copy_only=False))
        values = spots.flatten()
        cy, cx, half, fwhm_px = (values.field(f).to_numpy(zero_copy_only=False) for f in ("cy", "cx", "half", "fwhm_px"))
        planes, others = _Planes(batch.column("rows_a")), _Planes(batch.column("rows_b"))
        low, high = planes.y[planes.first[:-1]][of], planes.y[planes.first[1:] - 1][of]
        width, base = planes.size[planes.first[:-1]][of], planes.start[planes.first[:-1]][of]
        y0, y1 = np.maximum(cy - half, low), np.minimum(cy + half, high)
        x0, x1 = np.maximum(cx - half, 0), np.minimum(cx + half, width - 1)
        shapes = np.stack((y1 - y0 + 1, x1 - x0 + 1), axis=1)
        kinds, kind_of = np.unique(shapes, axis=0, return_inverse=True)
        which, ys, xs = [], [], []
        for number, (h, w) in enumerate(kinds):
            mine = np.flatnonzero(kind_of.ravel() == number)
            corner = base[mine] + (y0[mine] - low[mine]) * width[mine] + x0[mine]
            index = corner[:, None, None] + np.arange(h)[None, :, None] * width[mine][:, None, None] + np.arange(w)[None, None, :]
            areas = _areas(planes.flat[index], cy[mine] - y0[mine], cx[mine] - x0[mine], fwhm_px[mine], half_max, bg_pct)
            i, dy, dx = np.nonzero(areas)
            which.append(mine[i])
            ys.append(y0[mine][i] + dy)
            xs.append(x0[mine][i] + dx)
        which, ys, xs = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (which, ys, xs))
        order = np.argsort(which, kind="stable")
        which, ys, xs = which[order], ys[order], xs[order]
        row, inside, seen = others.at(of[which], ys, xs)
        # a row of the footprint that reaches past the other plane gives no sum, only its pixels
        line = np.cumsum(np.append(True, (which[1:] != which[:-1]) | (ys[1:] != ys[:-1]))) - 1 if which.size else which
        whole = np.bincount(line, ~inside) == 0 if which.size else np.zeros(0, bool)
        counted = whole[line] & row
        n = len(of)
        area, good = np.bincount(which[row], minlength=n), np.bincount(which[counted], minlength=n)
        total = np.bincount(which[counted], seen[counted], minlength=n)
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(which, minlength=n))), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int64))) for v in (ys, xs)]
        image = batch.column("image").take(pa.array(of))
        yield pa.RecordBatch.from_arrays(
            [image, values.field("channel"), values.field("spot_id"), *lists, pa.array(total, mask=good == 0), pa.array(area.astype(np.int64))],
            ["image", "channel", "spot_id", "ys", "xs", "total", "area"],
        )


def footprint(
    spots: DataFrame,
    rows_a: DataFrame,
    rows_b: DataFrame,
    voxel_xy_um: float = 0.13,
    default_um: float = 0.3,
    half_max: float = 0.5,
    bg_pct: float = 10.0,
    half_range: tuple[int, int] = (4, 12),
) -> tuple[DataFrame, DataFrame]:
    """(spots with footprint_mean and footprint_area_px, footprint pixels per spot).

    The footprint is the connected area around the local maximum above half of the background-subtracted
    peak, in a window that scales with the spot; otherwise a disk of the spot's radius. Planes are whole frames of
    one width. They travel once for every ``SPOTS`` spots of an image, so no window and no pixel of a footprint is
    shuffled; areas grow in Python, windows of like shape side by side.
    """
    key = ["image", "channel", "spot_id"]
    diameter = F.col("diameter_um")
    fwhm = F.when(diameter > 0, diameter).otherwise(F.lit(default_um)) / voxel_xy_um
    half = F.greatest(F.lit(half_range[0]), F.least(F.lit(half_range[1]), F.rint(fwhm).cast("int") + 2))
    size = rows_a.groupBy("image").agg(F.max("y").alias("_last"), F.max(F.size("vals")).alias("_w"))
    points = (
        spots.join(size, "image")
        .withColumn("_cy", F.greatest(F.lit(0).cast("long"), F.least(F.rint("y_px").cast("long"), F.col("_last"))))
        .withColumn("_cx", F.greatest(F.lit(0), F.least(F.rint("x_px").cast("int"), F.col("_w") - 1)))
    )
    spot = F.struct("channel", "spot_id", F.col("_cy").alias("cy"), F.col("_cx").cast("long").alias("cx"), half.cast("long").alias("half"), fwhm.alias("fwhm_px"))
    count = Window.partitionBy("image")
    dealt = points.select("image", spot.alias("_s"), F.count(F.lit(1)).over(count).alias("_n"))
    part = F.pmod(F.xxhash64("_s.channel", "_s.spot_id"), F.expr(f"(_n + {SPOTS - 1}) div {SPOTS}"))
    packs = dealt.groupBy("image", part.alias("_part")).agg(F.collect_list("_s").alias("spots"))

    def whole(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("image").agg(F.sort_array(F.collect_list(F.struct(F.col("y").cast("long").alias("y"), "vals"))).alias(name))

    other = whole(rows_b, "rows_b")
    none = F.array().cast(other.schema["rows_b"].dataType)
    ready = packs.join(whole(rows_a, "rows_a"), "image").join(other, "image", "left").select("image", "spots", "rows_a", F.coalesce("rows_b", none).alias("rows_b"))
    grown = cut_lineage(ready.mapInArrow(lambda it: _footprint_batches(it, half_max, bg_pct), FOOTPRINTS), True)
    pixels = grown.select(*key, F.explode(F.arrays_zip("ys", "xs")).alias("_p")).select(*key, F.col("_p.ys").alias("y"), F.col("_p.xs").alias("x"))
    seen = grown.where(F.col("area") > 0)
    sums = seen.select(*key, (F.col("total") / F.col("area")).alias("footprint_mean"), F.col("area").alias("footprint_area_px"))
    return spots.join(sums, key, "left").fillna(0, ["footprint_area_px"]), pixels


def log_kernel(sigma: float, truncate: float = 4.0) -> dict[tuple[int, int], float]:
    """Negative Laplacian-of-Gaussian weights, zero-sum, on a square of half-width truncate * sigma."""
    reach = max(1, int(truncate * sigma + 0.5))
    s2 = sigma * sigma
    gauss = {(y, x): math.exp(-(y * y + x * x) / (2 * s2)) for y, x in square(reach)}
    norm = sum(gauss.values())
    raw = {o: -((o[0] ** 2 + o[1] ** 2 - 2 * s2) / (s2 * s2)) * g / norm for o, g in gauss.items()}
    shift = sum(raw.values()) / len(raw)
    return {o: w - shift for o, w in raw.items()}


def weighted_rows(plane_rows: DataFrame, weights: dict[tuple[int, int], float]) -> DataFrame:
    """Weighted stencil sum at every pixel, edge pixels repeated outwards, in row form."""
    by_row = spans(list(weights))
    near = _neighbour_rows(plane_rows, max(abs(dy) for dy in by_row), clip=True)
    last = F.size("vals") - 1

    def at(x: Column) -> Column:
        total = F.lit(0.0)
        for dy, dxs in by_row.items():
            for dx in dxs:
                total = total + F.get(F.col(f"`r{dy}`"), F.greatest(F.lit(0), F.least(x + dx, last))) * weights[(dy, dx)]
        return total

    keep = [c for c in plane_rows.columns if c != "vals"]
    return near.select(*keep, F.transform(F.sequence(F.lit(0), last), at).alias("vals"))


def detect_spots(plane_rows: DataFrame, sigma: float, threshold: float | None = None, auto_threshold: float | None = None, multiplier: float = 1.0) -> DataFrame:
    """Local maxima of the filtered plane at or above a threshold: (image, channel, z, y_px, x_px, response, peak).

    The threshold is explicit, or an automatic one times a multiplier and at least 1. A maximum is not
    below any of its eight neighbours; of equal neighbours the first in reading order stays.
    """
    if threshold is None:
        if auto_threshold is None:
            raise ValueError("give threshold or auto_threshold")
        threshold = max(1.0, auto_threshold * multiplier)
    plane = [c for c in ("image", "channel", "z") if c in plane_rows.columns]
    response = weighted_rows(plane_rows, log_kernel(sigma)).withColumnRenamed("vals", "resp")
    both = response.join(plane_rows, [*plane, "y"]).withColumnRenamed("vals", "raw").withColumnRenamed("resp", "vals")
    near = _neighbour_rows(both, 1, clip=False)
    x = F.col("x")
    before = [(-1, -1), (-1, 0), (-1, 1), (0, -1)]
    after = [(0, 1), (1, -1), (1, 0), (1, 1)]
    # an index before the first column is outside the frame, as is one past the last
    def value(o: tuple[int, int]) -> Column:
        return F.when(x + o[1] >= 0, F.get(F.col(f"`r{o[0]}`"), F.greatest(x + o[1], F.lit(0))))

    peak = F.lit(True)
    for o in before:
        peak = peak & F.coalesce(value(o) < F.col("response"), F.lit(True))
    for o in after:
        peak = peak & F.coalesce(value(o) <= F.col("response"), F.lit(True))
    cells = near.select(*plane, "y", "raw", "`r-1`", "r0", "r1", F.posexplode("vals").alias("x", "response")).where(F.col("response") >= threshold)
    return cells.where(peak).select(*plane, F.col("y").alias("y_px"), x.cast("long").alias("x_px"), "response", F.get("raw", x).alias("peak"))


def mean_patch(points: DataFrame, plane_rows: DataFrame, region: DataFrame, half_px: int, keys: Sequence[str] = ("image",)) -> DataFrame:
    """(keys, dy, dx, value, n): average crop around the points in units of their nucleus' mean.

    points (image, nucleus_id, cy, cx); ``region`` holds the nucleus pixels that set the mean. Offsets off
    the frame take the image minimum.
    """
    rows = plane_rows.select("image", F.col("y").alias("_row"), F.col("vals").alias("_vals"))
    floor = plane_rows.groupBy("image").agg(F.min(F.array_min("vals")).alias("_low"))
    level = pixels_in(plane_rows.select("image", "y", "vals"), region).groupBy("image", "nucleus_id").agg(F.avg("v").alias("_mean"))
    steps = F.sequence(F.lit(-half_px), F.lit(half_px))
    spread = (
        points.join(level.where(F.col("_mean") > 0), ["image", "nucleus_id"])
        .join(floor, "image")
        .select(*keys, *([] if "image" in keys else ["image"]), "cx", "_mean", "_low", F.col("cy"), F.explode(steps).alias("dy"))
        .withColumn("_row", F.col("cy") + F.col("dy"))
        .join(rows, ["image", "_row"], "left")
    )
    at = F.col("cx").cast("int")
    cells = F.transform(
        steps, lambda d: F.coalesce(F.when(at + d >= 0, F.get("_vals", F.greatest(at + d, F.lit(0)))), F.col("_low")) / F.col("_mean")
    )
    return (
        spread.select(*keys, "dy", F.posexplode(cells).alias("_i", "_v"))
        .groupBy(*keys, "dy", (F.col("_i") - half_px).alias("dx"))
        .agg(F.avg("_v").alias("value"), F.count(F.lit(1)).alias("n"))
    )


def central_mean(patch: DataFrame, keys: Sequence[str] = ("image",), radius_px: float = 3.0) -> DataFrame:
    """Mean of a patch over its central disk."""
    dy, dx = F.col("dy"), F.col("dx")
    return patch.where(dy * dy + dx * dx <= radius_px * radius_px).groupBy(*keys).agg(F.avg("value").alias("central_mean"))
