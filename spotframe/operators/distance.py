"""Mask morphology by exact distance: a pixel belongs to a dilation when its distance to the mask is within the radius.

Squared distances take two passes over a frame of row arrays: along rows, how far the next mask pixel is,
then down columns, the lowest of the parabolas that the rows within reach raise. A frame, or the box of one
label with a margin, is the unit of work; its size does not depend on the number of images. A mask is one row
of words, and boxes of like size are worked on side by side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spotframe.functions.stencils import usable_radius

FAR = np.int32(1) << 14
#: Pixels of an image row that travel as the bits of one number.
WORD = 64


def squared_distance(mask: np.ndarray, reach: int) -> np.ndarray:
    """Squared distance of every pixel to the nearest set pixel, exact up to ``reach``; larger ones come out as larger.

    The last two axes are those of an image; masks before them do not see each other.
    """
    height, width = mask.shape[-2:]
    at = np.arange(width, dtype=np.int32)
    left = np.maximum.accumulate(np.where(mask, at, -FAR), axis=-1)
    right = np.minimum.accumulate(np.where(mask, at, at[-1] + FAR)[..., ::-1], axis=-1)[..., ::-1]
    along = np.minimum(np.minimum(at - left, right - at), FAR) ** 2
    best = along.copy()
    for dy in range(1, min(reach, height - 1) + 1):
        np.minimum(best[..., dy:, :], along[..., :-dy, :] + dy * dy, out=best[..., dy:, :])
        np.minimum(best[..., :-dy, :], along[..., dy:, :] + dy * dy, out=best[..., :-dy, :])
    return best


def dilated(mask: np.ndarray, radius: float, there: np.ndarray | bool = True) -> np.ndarray:
    """Pixels of the frame (``there``) within the radius of a set pixel."""
    return (squared_distance(mask, math.floor(radius)) <= radius * radius) & there


def eroded(mask: np.ndarray, radius: float, outside: bool = True, there: np.ndarray | bool = True) -> np.ndarray:
    """Pixels farther than the radius from every unset pixel; `outside` says whether what lies beyond the frame counts as set."""
    reach = math.floor(radius)
    if outside:
        return (squared_distance(~mask & there, reach) > radius * radius) & there
    sides = [(0, 0)] * (mask.ndim - 2) + [(reach, reach)] * 2
    inner = (..., *(slice(reach, reach + n) for n in mask.shape[-2:]))
    return (squared_distance(~np.pad(mask, sides), reach) > radius * radius)[inner]


STEPS: dict[str, tuple[Callable[..., np.ndarray], ...]] = {
    "dilate": (dilated,), "erode": (eroded,), "close": (dilated, eroded), "open": (eroded, dilated),
    "smooth": (dilated, eroded, eroded, dilated), "clean": (eroded, dilated, dilated, eroded),
}


#: Pixels of the boxes that are worked on at once, and the raster that their sides are rounded up to.
TOGETHER, RASTER = 1 << 20, 8


def _stacks(shapes: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of boxes of one rounded shape (rows of ``shapes``), so many that their pixels are about ``TOGETHER``."""
    kinds, of = np.unique(shapes, axis=0, return_inverse=True)
    order = np.argsort(of.ravel(), kind="stable")
    for kind, mine in zip(kinds, np.split(order, np.cumsum(np.bincount(of.ravel()))[:-1])):
        many = max(1, TOGETHER // int(kind.prod()))
        for at in range(0, len(mine), many):
            yield mine[at : at + many]


def _morph_batches(batches: Iterator[pa.RecordBatch], keys: Sequence[str], op: str, radius: float, outside: bool) -> Iterator[pa.RecordBatch]:
    """Masks, each one row with its words, cut to their boxes and a margin in which every step can end."""
    steps = STEPS[op]
    margin = sum(step is dilated for step in steps) * math.floor(radius) + 1
    for batch in batches:
        words = batch.column("words").flatten()
        of_word = np.repeat(np.arange(batch.num_rows), batch.column("words").value_lengths().to_numpy(zero_copy_only=False))
        row, word, bits = (words.field(f).to_numpy(zero_copy_only=False) for f in ("y", "_word", "_bits"))
        height, width = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("height", "width"))
        at, bit = np.nonzero(np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        of, ys, xs = of_word[at], row[at], word[at] * WORD + bit
        here = xs < width[of]
        of, ys, xs = of[here], ys[here], xs[here]
        if not of.size:
            continue
        # the words of a mask stand together, so its pixels do
        masks, first = np.unique(of, return_index=True)
        low = lambda v: np.maximum(np.minimum.reduceat(v, first) - margin, 0)
        high = lambda v, n: np.minimum(np.maximum.reduceat(v, first) + margin + 1, n[masks])
        y0, x0, y1, x1 = low(ys), low(xs), high(ys, height), high(xs, width)
        counts = np.diff(np.append(first, of.size))
        rounded = -(-np.stack((y1 - y0, x1 - x0), axis=1) // RASTER) * RASTER
        for chosen in _stacks(rounded):
            h, w = rounded[chosen[0]]
            n = counts[chosen]
            mine = np.repeat(np.arange(len(chosen)), n)
            pixel = np.repeat(first[chosen] - np.cumsum(n) + n, n) + np.arange(n.sum())
            mask = np.zeros((len(chosen), h, w), bool)
            mask[mine, ys[pixel] - y0[chosen][mine], xs[pixel] - x0[chosen][mine]] = True
            # a side of the box that is not rounded up may be one of the frame, beyond which there is nothing
            there = (np.arange(h)[None, :, None] < (y1 - y0)[chosen][:, None, None]) & (np.arange(w)[None, None, :] < (x1 - x0)[chosen][:, None, None])
            for step in steps:
                mask = step(mask, radius, outside, there) if step is eroded else step(mask, radius, there)
            which, y, x = np.nonzero(mask)
            for start in range(0, len(which), TOGETHER):
                part = slice(start, start + TOGETHER)
                box = chosen[which[part]]
                named = pa.array(masks[box])
                yield pa.RecordBatch.from_arrays([batch.column(k).take(named) for k in keys] + [pa.array(y[part] + y0[box]), pa.array(x[part] + x0[box])], [*keys, "y", "x"])


def morph(mask: DataFrame, images: DataFrame, op: str, radius: float, keys: Sequence[str] = ("image",), outside: bool = True) -> DataFrame:
    """'dilate', 'erode', 'open', 'close', 'smooth' (close, then open) or 'clean' (open, then close) each mask (keys, y, x) with a disk.

    Keys name a mask and include image; masks of different keys do not see each other. A pixel outside the frame
    counts as unset for dilation and, unless `outside` is False, as set for erosion. Pixels of images without a frame, and outside it, are
    left out; repeated pixels count once. Pixels are packed into words of bits before they are shuffled.
    """
    if op not in STEPS:
        raise ValueError(f"unknown operation {op!r}; known are {sorted(STEPS)}")
    keys, radius = list(keys), usable_radius(radius)
    placed = mask.select(*keys, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("_x")).where((F.col("y") >= 0) & (F.col("_x") >= 0))
    bit = F.expr(f"shiftleft(1L, cast(_x % {WORD} as int))")
    words = placed.groupBy(*keys, "y", F.expr(f"_x div {WORD}").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    framed = words.join(images.select("image", F.col("height").cast("long").alias("height"), F.col("width").cast("long").alias("width")), "image")
    inside = framed.where((F.col("y") < F.col("height")) & (F.col("_word") * WORD < F.col("width"))).select(*keys, "y", "_word", "_bits", "height", "width")
    masks = inside.groupBy(*keys).agg(F.collect_list(F.struct("y", "_word", "_bits")).alias("words"), F.max("height").alias("height"), F.max("width").alias("width"))
    types = {f.name: f.dataType.simpleString() for f in inside.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in [*keys, "y"]) + ", x bigint"
    return masks.mapInArrow(lambda batches: _morph_batches(batches, keys, op, radius, outside), schema)
