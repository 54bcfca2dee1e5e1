"""Label and mask tables: size and border filters, morphology, components, expansion, shape."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.functions.ranks import quantiles
from spotframe.functions.scalars import ratio
from spotframe.functions.stencils import literal
from spotframe.operators.distance import morph
from spotframe.operators.frames import pixels_in
from spotframe.operators.thresholds import otsu
from spotframe.session import cut_lineage

KEY = ["image", "nucleus_id"]
PIXEL = ["image", "y", "x"]


def filter_area(labels: DataFrame, min_px: float = 10000, max_px: float = 1e12) -> DataFrame:
    """Labels whose pixel count lies in [min_px, max_px]."""
    kept = labels.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") >= min_px) & (F.col("_n") <= max_px))
    return labels.join(kept.select(*KEY), KEY, "left_semi")


def drop_border(labels: DataFrame, images: DataFrame, margin: int = 5) -> DataFrame:
    """Leave out labels whose bounding box reaches into the margin; the rest are numbered 1, 2, ... per image."""
    m = margin if margin > 0 else 1
    box = labels.groupBy(*KEY).agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    near = (F.col("y0") < m) | (F.col("x0") < m) | (F.col("y1") + 1 > F.col("height") - m) | (F.col("x1") + 1 > F.col("width") - m)
    inner = box.join(images.select("image", "height", "width"), "image").where(~near)
    fresh = inner.select(*KEY, F.row_number().over(Window.partitionBy("image").orderBy("nucleus_id")).cast("long").alias("_new"))
    return labels.join(fresh, KEY).withColumn("nucleus_id", F.col("_new")).drop("_new")


def _run_batches(batches, keys: Sequence[str], reach: int):
    """Horizontal runs of the words of a band with the smallest run their component has inside the band.

    A batch holds whole bands (one row each), and all of them are labelled side by side.
    """
    for batch in batches:
        words = batch.column("words").flatten()
        band = np.repeat(np.arange(batch.num_rows), batch.column("words").value_lengths().to_numpy(zero_copy_only=False))
        y, at, bits = (words.field(f).to_numpy(zero_copy_only=False) for f in ("y", "w", "bits"))
        on = (bits.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        word, bit = np.nonzero(on)
        band, y, x = band[word], y[word], at[word] * 64 + bit
        order = np.lexsort((x, y, band))
        band, y, x = band[order], y[order], x[order]
        new = np.ones(len(x), dtype=bool)
        new[1:] = (band[1:] != band[:-1]) | (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(x)])) - 1 if len(x) else first
        band, y, a, b = band[first], y[first], x[first], x[last]
        # rows get numbers two apart where they do not follow each other, so that only neighbours meet
        follows = (band[1:] == band[:-1]) & (y[1:] - y[:-1] <= 1)
        line = np.concatenate(([0], np.cumsum(np.where(follows, y[1:] - y[:-1], 2)))) if len(y) else y
        low = a.min() if len(a) else 0
        width = (b.max() - low + 4) if len(b) else 1
        left, right = line * width + (a - low), line * width + (b - low)
        lo = np.searchsorted(right, left + width - reach)
        hi = np.searchsorted(left, right + width + reach, side="right")
        n = np.maximum(hi - lo, 0)
        one = np.repeat(np.arange(len(a)), n)
        other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        root = np.arange(len(a))
        while True:
            least = np.minimum(root[one], root[other])
            fresh = root.copy()
            # the roots of both ends, and so all that points to them, hear of the smaller one
            for end in (root[one], root[other], one, other):
                np.minimum.at(fresh, end, least)
            fresh = fresh[fresh]
            if np.array_equal(fresh, root):
                break
            root = fresh
        run = (y << 31) + a
        yield pa.RecordBatch.from_arrays(
            [batch.column(k).take(pa.array(band)) for k in keys] + [pa.array(v) for v in (y, a, b, run[root])], [*keys, "y", "a", "b", "id"]
        )


def components(mask: DataFrame, connectivity: int = 4, keys: Sequence[str] = ("image",)) -> DataFrame:
    """``mask`` (keys, y, x) with a component id, the smallest pixel of its component in reading order.

    Pixels travel as words of 64 bits and meet in bands of rows, where they are merged into horizontal runs and
    labelled. Components that touch over the edge of a band then exchange their smallest id, and
    each id is replaced by the id it points to, until nothing changes. Repeated pixels count once; pixels without a
    position are left out.
    """
    keys = list(keys)
    reach = 1 if connectivity == 8 else 0
    x = F.col("x").cast("long")
    words = (
        mask.where(F.col("y").isNotNull() & F.col("x").isNotNull())
        .groupBy(*keys, F.col("y").cast("long").alias("y"), F.floor(x / 64).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(cast(x AS long), 64) AS int))")).alias("bits"))
    )
    bands = words.groupBy(*keys, F.floor(F.col("y") / BAND).alias("_band")).agg(F.collect_list(F.struct("y", "w", "bits")).alias("words"))
    schema = words.select(*keys, "y", F.col("y").alias("a"), F.col("y").alias("b"), F.col("y").alias("id")).schema
    runs = cut_lineage(bands.select(*keys, "words").mapInArrow(lambda batches: _run_batches(batches, keys, reach), schema))
    upper = runs.where(F.pmod("y", F.lit(BAND)) == BAND - 1)
    lower = runs.where(F.pmod("y", F.lit(BAND)) == 0).select(*keys, (F.col("y") - 1).alias("y"), F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("id").alias("other"))
    touch = upper.join(lower, [*keys, "y"]).where((F.col("a") <= F.col("b2") + reach) & (F.col("a2") <= F.col("b") + reach))
    pairs = touch.select(*keys, F.col("id").alias("run"), "other").distinct()
    edges = cut_lineage(pairs.unionByName(pairs.select(*keys, F.col("other").alias("run"), F.col("run").alias("other"))))
    named = runs
    if not edges.isEmpty():
        named = runs.withColumnRenamed("id", "run").join(_smallest_ids(edges, keys), [*keys, "run"], "left").withColumn("id", F.coalesce("id", "run"))
    return named.select(*keys, "y", F.explode(F.sequence("a", "b")).alias("x"), F.col("id").alias("component"))


def _smallest_ids(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, run, id): the smallest run that can be reached by edges (keys, run, other), which are there in both directions."""
    ids = edges.select(*keys, "run").distinct().withColumn("id", F.col("run"))
    while True:
        heard = edges.join(ids.select(*keys, F.col("run").alias("other"), F.col("id").alias("theirs")), [*keys, "other"]).groupBy(*keys, "run").agg(F.min("theirs").alias("theirs"))
        lowered = ids.join(heard, [*keys, "run"], "left").select(*keys, "run", F.col("id").alias("old"), F.least("id", "theirs").alias("id"))
        root = lowered.select(*keys, F.col("run").alias("id"), F.col("id").alias("_up"))
        step = cut_lineage(lowered.join(root, [*keys, "id"]).select(*keys, "run", "old", F.least("id", "_up").alias("id")))
        changed = step.where(F.col("id") != F.col("old")).limit(1).count()
        ids = step.select(*keys, "run", "id")
        if changed == 0:
            return ids


def otsu_labels(planes: DataFrame, images: DataFrame, min_px: float = 10000, max_px: float = 1e12, margin: int = 5, connectivity: int = 4) -> DataFrame:
    """Nuclei of a DAPI plane (image, y, x, v): Otsu cut, components, size and border filters."""
    cut = otsu(planes, "v", ["image"])
    mask = planes.join(cut, "image").where(F.col("v") > F.col("thr")).select(*PIXEL)
    found = components(mask, connectivity).withColumnRenamed("component", "nucleus_id")
    return drop_border(filter_area(found, min_px, max_px), images, margin)


def smooth_labels(labels: DataFrame, images: DataFrame, radius: float) -> DataFrame:
    """Close, then open each label with a disk; no label enters another, the lowest wins free pixels.

    A label that vanishes keeps its original pixels where no other has taken them.
    """
    if radius <= 0:
        return labels
    keys = ["image", "nucleus_id"]
    smooth = morph(labels, images, "smooth", radius, keys)
    owner = labels.select(*PIXEL, F.col("nucleus_id").alias("_own"))
    allowed = smooth.join(owner, PIXEL, "left").where(F.col("_own").isNull() | (F.col("_own") == F.col("nucleus_id")))
    claimed = allowed.groupBy(*PIXEL).agg(F.min("nucleus_id").alias("nucleus_id"))
    lost = labels.select(*keys).distinct().join(claimed.select(*keys).distinct(), keys, "left_anti")
    restored = labels.select(*PIXEL, "nucleus_id").join(lost, keys, "left_semi").join(claimed.select(*PIXEL), PIXEL, "left_anti")
    return claimed.unionByName(restored)


BAND = 256


def _nearest_in_band(pdf: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Nearest label of every free pixel of one band: best row per column, then best column per row."""
    image, band = int(pdf["image"].iloc[0]), int(pdf["band"].iloc[0])
    height, width = int(pdf["height"].iloc[0]), int(pdf["width"].iloc[0])
    top = band * BAND - distance
    ids = np.zeros((BAND + 2 * distance, width), dtype=np.int64)
    ids[pdf["y"].to_numpy() - top, pdf["x"].to_numpy()] = pdf["nucleus_id"].to_numpy()
    far = np.int64(1) << 40
    core = slice(distance, distance + BAND)
    d2 = np.full((BAND, width), far)
    who = np.zeros((BAND, width), dtype=np.int64)

    def take(dist: np.ndarray, label: np.ndarray, into_d: np.ndarray, into_l: np.ndarray) -> None:
        better = (label > 0) & ((dist < into_d) | ((dist == into_d) & (label < into_l)))
        into_d[better], into_l[better] = dist[better], label[better]

    for dy in range(-distance, distance + 1):
        rows = ids[distance + dy : distance + dy + BAND]
        take(np.full(rows.shape, np.int64(dy * dy)), rows, d2, who)
    best_d, best_l = np.full((BAND, width), far), np.zeros((BAND, width), dtype=np.int64)
    for dx in range(-distance, distance + 1):
        a, b = max(0, -dx), min(width, width - dx)
        if a < b:
            take(d2[:, a + dx : b + dx] + dx * dx, who[:, a + dx : b + dx], best_d[:, a:b], best_l[:, a:b])
    ys, xs = np.nonzero((best_l > 0) & (best_d <= distance * distance) & (ids[core] == 0))
    keep = ys + band * BAND < height
    ys, xs = ys[keep], xs[keep]
    return pd.DataFrame({"image": image, "y": ys + band * BAND, "x": xs, "cyto_id": best_l[ys, xs]}).astype("int64")


def expand_labels(labels: DataFrame, images: DataFrame, distance: int = 80) -> DataFrame:
    """(image, y, x, cyto_id): free pixels within ``distance`` of a label, owned by the nearest (lowest id on ties).

    Frames are cut into bands of rows that carry a margin of ``distance`` rows, so a task holds one band.
    """
    y = F.col("y")
    bands = F.sequence(F.greatest(F.lit(0).cast("long"), F.floor((y - distance) / BAND)), F.least(F.floor((y + distance) / BAND), F.floor((F.col("height") - 1) / BAND)))
    spread = labels.select(*PIXEL, "nucleus_id").join(images.select("image", "height", "width"), "image").withColumn("band", F.explode(bands))
    return spread.groupBy("image", "band").applyInPandas(
        lambda pdf: _nearest_in_band(pdf, distance), "image long, y long, x long, cyto_id long"
    )


def detect_nucleoli(
    planes: DataFrame, labels: DataFrame, images: DataFrame, voxel_xy_um: float = 0.13, pct: float = 25.0, min_um2: float = 1.0,
    max_frac: float = 0.6, closing: int = 2, border: int = 5,
) -> DataFrame:
    """(image, y, x, nucleolus_id): dark areas well inside a nucleus, sized, closed one by one and clipped to it.

    planes is the DAPI plane; the id is that of the nucleus. A nucleus must hold twice the smallest area. "Well
    inside" is away from the edge of all nuclei together, so touching nuclei keep their common border; a nucleus
    that has no such pixel is searched whole.
    """
    min_px = max(1, round(min_um2 / (voxel_xy_um * voxel_xy_um)))
    area = labels.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_area")).where(F.col("_area") >= 2 * min_px)
    inside = labels.select(*PIXEL, "nucleus_id").join(area, KEY)
    pixels = pixels_in(planes, inside)
    dark = pixels.join(quantiles(pixels, "v", KEY, {"_cut": pct / 100}), KEY).where(F.col("v") <= F.col("_cut")).select(*PIXEL, "nucleus_id", "_area")
    if border > 0:
        interior = cut_lineage(morph(labels, images, "erode", border).join(labels.select(*PIXEL, "nucleus_id"), PIXEL))
        whole = area.select(*KEY).join(interior.select(*KEY).distinct(), KEY, "left_anti")
        dark = dark.join(interior, [*PIXEL, "nucleus_id"], "left_semi").unionByName(dark.join(whole, KEY, "left_semi"))
    seeds = cut_lineage(dark)
    keys = [*KEY, "component"]
    parts = components(seeds.select(*KEY, "y", "x"), keys=KEY).join(area, KEY)
    sized = parts.groupBy(*keys, "_area").agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") >= min_px) & (F.col("_n") <= F.floor(max_frac * F.col("_area"))))
    kept = parts.join(sized.select(*keys), keys, "left_semi").select(*keys, "y", "x")
    if closing > 0:
        kept = morph(kept, images, "close", closing, keys)
    clipped = kept.select(*PIXEL, "nucleus_id").distinct().join(labels.select(*PIXEL, "nucleus_id"), [*PIXEL, "nucleus_id"], "left_semi")
    return clipped.select(*PIXEL, F.col("nucleus_id").alias("nucleolus_id"))


# Perimeter weights by the pattern of border neighbours (10 per diagonal, 2 per side).
PERIMETER_WEIGHTS = {1.0: (5, 7, 15, 17, 25, 27), math.sqrt(2.0): (21, 33), (1.0 + math.sqrt(2.0)) / 2.0: (13, 23)}


def _perimeter(labels: DataFrame) -> DataFrame:
    """Border pixels (a side neighbour missing) weighted by how their border neighbours lie."""
    cross, corners = [(-1, 0), (1, 0), (0, -1), (0, 1)], [(-1, -1), (-1, 1), (1, -1), (1, 1)]

    def spread(df: DataFrame, offsets, weight: int) -> DataFrame:
        return df.select(*KEY, "y", "x", F.explode(literal(offsets)).alias("_o")).select(
            *KEY, (F.col("y") + F.col("_o.dy")).alias("y"), (F.col("x") + F.col("_o.dx")).alias("x"), F.lit(weight).alias("_w")
        )

    own = labels.select(*KEY, "y", "x")
    sides = spread(own, cross, 1).groupBy(*KEY, "y", "x").agg(F.sum("_w").alias("_n"))
    border = own.join(sides, [*KEY, "y", "x"], "left").where(F.coalesce("_n", F.lit(0)) < 4).select(*KEY, "y", "x")
    pattern = spread(border, cross, 2).unionByName(spread(border, corners, 10)).groupBy(*KEY, "y", "x").agg(F.sum("_w").alias("_p"))
    code = F.coalesce("_p", F.lit(0)) + 1
    weight = F.lit(0.0)
    for value, codes in PERIMETER_WEIGHTS.items():
        weight = F.when(code.isin(*codes), F.lit(value)).otherwise(weight)
    return border.join(pattern, [*KEY, "y", "x"], "left").groupBy(*KEY).agg(F.sum(weight).alias("perimeter_px"))


def _hull(ends: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Corners of the convex hull of a label's pixel squares, from (y, first x, last x) of its rows, in half pixels.

    A row touches the hull with the middles of the outer sides of its first and last pixel, and with the middles of their
    sides above and below: so the ends of each line of half pixels make the two chains.
    """
    lines: dict[int, tuple[int, int]] = {}
    for y, a, b in ends:
        for at, lo, hi in ((2 * y - 1, 2 * a, 2 * b), (2 * y, 2 * a - 1, 2 * b + 1), (2 * y + 1, 2 * a, 2 * b)):
            old = lines.get(at)
            lines[at] = (lo, hi) if old is None else (min(lo, old[0]), max(hi, old[1]))

    def chain(side: int, sign: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for y in sorted(lines):
            x = lines[y][side]
            while len(out) > 1:
                (y0, x0), (y1, x1) = out[-2], out[-1]
                if sign * ((x1 - x0) * (y - y0) - (x - x0) * (y1 - y0)) < 0:
                    break
                out.pop()
            out.append((y, x))
        return out

    return [*chain(0, 1), *reversed(chain(1, -1))]


def _hull_batches(batches):
    """Hull area and longest diameter from the first and last pixel of every row of a nucleus."""
    for batch in batches:
        areas, ferets = [], []
        for ends in batch["ends"]:
            corners = _hull([(r["y"], r["a"], r["b"]) for r in ends])
            twice = sum(y0 * x1 - y1 * x0 for (y0, x0), (y1, x1) in zip(corners, corners[1:] + corners[:1], strict=True))
            at = np.array(corners, dtype=np.float64) / 2.0
            apart = at[:, None, :] - at[None, :, :]
            areas.append(abs(twice) / 8.0)
            ferets.append(float(np.sqrt(np.einsum("ijk,ijk->ij", apart, apart).max())))
        yield batch[KEY].assign(hull_area_px=areas, feret_max_px=ferets)


def morphology(labels: DataFrame, voxel_xy_um: float = 0.13) -> DataFrame:
    """Area, centre, perimeter, circularity, axes from second moments, hull solidity and diameter per nucleus."""
    y, x = F.col("y").cast("double"), F.col("x").cast("double")
    m = labels.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("area_px"), F.avg(y).alias("centroid_y"), F.avg(x).alias("centroid_x"),
        F.var_pop(y).alias("_vy"), F.var_pop(x).alias("_vx"), F.covar_pop(y, x).alias("_c"),
    )
    # a pixel is a unit square, which adds 1/12 to each variance
    vy, vx, c = F.col("_vy") + 1.0 / 12.0, F.col("_vx") + 1.0 / 12.0, F.col("_c")
    spread = F.sqrt((vy - vx) * (vy - vx) + 4.0 * c * c)
    m = m.withColumn("major_px", 4.0 * F.sqrt((vy + vx + spread) / 2.0)).withColumn("minor_px", 4.0 * F.sqrt(F.greatest((vy + vx - spread) / 2.0, F.lit(0.0))))
    ends = labels.groupBy(*KEY, "y").agg(F.min("x").alias("a"), F.max("x").alias("b")).groupBy(*KEY).agg(F.collect_list(F.struct("y", "a", "b")).alias("ends"))
    hull = ends.mapInPandas(_hull_batches, "image long, nucleus_id long, hull_area_px double, feret_max_px double")
    out = m.join(_perimeter(labels), KEY, "left").join(hull, KEY, "left")
    area, perimeter = F.col("area_px"), F.col("perimeter_px")
    return out.select(
        *KEY, "area_px", (area * voxel_xy_um * voxel_xy_um).alias("area_um2"), "centroid_y", "centroid_x",
        (perimeter * voxel_xy_um).alias("perimeter_um"),
        ratio(4.0 * math.pi * area, perimeter * perimeter).alias("circularity"),
        (F.col("major_px") * voxel_xy_um).alias("major_axis_um"), (F.col("minor_px") * voxel_xy_um).alias("feret_min_um"),
        F.sqrt(1.0 - (F.col("minor_px") / F.col("major_px")) * (F.col("minor_px") / F.col("major_px"))).alias("eccentricity"),
        ratio(F.col("major_px"), F.col("minor_px")).alias("aspect_ratio"),
        ratio(4.0 * area, math.pi * F.col("major_px") * F.col("major_px")).alias("roundness"),
        ratio(area, F.col("hull_area_px")).alias("solidity"),
        (F.col("feret_max_px") * voxel_xy_um).alias("feret_max_um"),
    )
