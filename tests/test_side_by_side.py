"""Masks and windows that are worked on side by side give what each of them gives alone."""

import numpy as np
import pyarrow as pa
import pytest

from spotframe.operators import distance, sampling


def _near(mask, radius):
    """Brute force: whether a set pixel lies within the radius."""
    ys, xs = np.nonzero(mask)
    yy, xx = np.mgrid[: mask.shape[0], : mask.shape[1]]
    return (((yy[..., None] - ys) ** 2 + (xx[..., None] - xs) ** 2) <= radius * radius).any(axis=-1) if ys.size else np.zeros_like(mask)


def _alone(mask, op, radius, outside):
    reach = int(radius)
    for step in distance.STEPS[op]:
        if step is distance.dilated:
            mask = _near(mask, radius)
        else:
            inner = np.pad(mask, reach, constant_values=outside)
            mask = ~_near(~inner, radius)[reach : reach + mask.shape[0], reach : reach + mask.shape[1]]
    return mask


def _row(mask, key):
    words = []
    for y in np.flatnonzero(mask.any(axis=1)):
        for word in range(-(-mask.shape[1] // 64)):
            bits = sum(1 << i for i, v in enumerate(mask[y, word * 64 : word * 64 + 64]) if v)
            if bits:
                words.append({"y": int(y), "_word": word, "_bits": bits - (1 << 64) if bits >= 1 << 63 else bits})
    return {"image": key, "words": words, "height": mask.shape[0], "width": mask.shape[1]}


@pytest.mark.parametrize("outside", [True, False])
@pytest.mark.parametrize("op", sorted(distance.STEPS))
def test_boxes_of_all_sizes_and_at_all_edges(op, outside, monkeypatch):
    monkeypatch.setattr(distance, "TOGETHER", 3000)
    rng = np.random.default_rng(1)
    masks = []
    for i in range(24):
        mask = np.zeros((40, 70 if i % 2 else 30), bool)
        y, x = rng.integers(0, 34), rng.integers(0, mask.shape[1] - 5)
        mask[y : y + rng.integers(2, 20), x : x + rng.integers(2, 30)] = True
        masks.append(mask & (rng.random(mask.shape) > 0.15))
    masks.append(np.ones((40, 70), bool))
    kinds = pa.schema([("image", pa.int64()), ("words", pa.list_(pa.struct([("y", pa.int64()), ("_word", pa.int64()), ("_bits", pa.int64())]))), ("height", pa.int64()), ("width", pa.int64())])
    batch = pa.RecordBatch.from_pylist([_row(m, k) for k, m in enumerate(masks)], kinds)
    got = [np.zeros_like(m) for m in masks]
    for out in distance._morph_batches(iter([batch]), ["image"], op, 2.5, outside):
        for k, y, x in zip(*(out.column(c).to_pylist() for c in ("image", "y", "x"))):
            assert not got[k][y, x]
            got[k][y, x] = True
    for k, mask in enumerate(masks):
        assert (got[k] == _alone(mask, op, 2.5, outside)).all(), k


def _alone_area(a, cy, cx, fwhm):
    near = np.full_like(a, -np.inf)
    sl = np.s_[max(cy - 1, 0) : cy + 2, max(cx - 1, 0) : cx + 2]
    near[sl] = a[sl]
    seed = np.unravel_index(int(np.argmax(near)), a.shape)
    low, peak = np.percentile(a, 10), a[seed]
    yy, xx = np.mgrid[: a.shape[0], : a.shape[1]]
    if not peak > low:
        return (yy - cy) ** 2 + (xx - cx) ** 2 <= max(1.0, fwhm / 2.0) ** 2
    high, grown = a >= low + 0.5 * (peak - low), {seed}
    while more := {(y + j, x + i) for y, x in grown for j in (-1, 0, 1) for i in (-1, 0, 1) if 0 <= y + j < a.shape[0] and 0 <= x + i < a.shape[1] and high[y + j, x + i]} - grown:
        grown |= more
    out = np.zeros_like(high)
    out[tuple(zip(*grown))] = True
    return out


def test_areas_grow_in_their_own_windows():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 40, (60, 9, 8)).astype(float)
    a[:5] = 7.0  # flat windows give a disk
    cy, cx, fwhm = rng.integers(0, 9, 60), rng.integers(0, 8, 60), rng.uniform(0.5, 5, 60)
    got = sampling._areas(a, cy, cx, fwhm, 0.5, 10.0)
    for i in range(60):
        assert (got[i] == _alone_area(a[i], cy[i], cx[i], fwhm[i])).all(), i
