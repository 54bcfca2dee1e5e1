"""Runs, exact-distance morphology and the mask operators built on them, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotframe.functions.stencils import disk
from spotframe.operators import distance, labels, lookup, runs


def frame(spark, height, width, images=(1,)):
    return spark.createDataFrame([(i, height, width) for i in images], "image long, height int, width int")


def table(spark, masks, name="nucleus_id"):
    """masks: image -> 2-D array of ids."""
    rows = [(i, int(y), int(x), int(a[y, x])) for i, a in masks.items() for y, x in np.argwhere(a > 0)]
    return spark.createDataFrame(rows, f"image long, y long, x long, {name} long")


def dilate(mask, radius):
    out = np.zeros_like(mask)
    for y, x in np.argwhere(mask):
        for dy, dx in disk(radius):
            if 0 <= y + dy < mask.shape[0] and 0 <= x + dx < mask.shape[1]:
                out[y + dy, x + dx] = True
    return out


def erode(mask, radius):
    return ~dilate(~mask, radius)


PLAIN = {"dilate": (dilate,), "erode": (erode,), "close": (dilate, erode), "open": (erode, dilate), "smooth": (dilate, erode, erode, dilate)}


def plain(op, mask, radius):
    for step in PLAIN[op]:
        mask = step(mask, radius)
    return mask


@pytest.mark.parametrize("radius", [1, 2.5, 10, 0.5])
def test_squared_distance_is_exact_within_reach(radius):
    rng = np.random.default_rng(3)
    for shape in ((1, 1), (1, 30), (30, 1), (37, 23)):
        for share in (0.0, 0.02, 0.5, 1.0):
            mask = rng.random(shape) < share
            got = distance.squared_distance(mask, int(radius) + 1)
            spots = np.argwhere(mask)
            for y in range(shape[0]):
                for x in range(shape[1]):
                    want = min((int((y - a) ** 2 + (x - b) ** 2) for a, b in spots), default=10**9)
                    assert got[y, x] == want if want <= (int(radius) + 1) ** 2 else got[y, x] > (int(radius) + 1) ** 2
            for op in PLAIN:
                now = mask
                for step in distance.STEPS[op]:
                    now = step(now, max(radius, 1e-9))
                if radius >= 1:
                    assert (now == plain(op, mask, radius)).all(), (op, shape, share)


@pytest.mark.parametrize("op", list(PLAIN))
@pytest.mark.parametrize("radius", [1, 2.5, 10])
def test_morph_of_masks_by_key(spark, op, radius):
    rng = np.random.default_rng(5)
    blob = np.zeros((40, 33), bool)
    blob[5:30, 2:20] = rng.random((25, 18)) < 0.8
    masks = {(1, 0): blob, (1, 1): np.ones((40, 33), bool), (2, 0): rng.random((40, 33)) < 0.97, (2, 1): np.eye(40, 33, dtype=bool)}
    rows = [(i, k, int(y), int(x)) for (i, k), m in masks.items() for y, x in np.argwhere(m)]
    rows += rows[:50] + [(1, 0, -1, 3), (1, 0, 40, 3), (9, 0, 1, 1)]  # repeated, outside the frame, without a frame
    got = labels.morph(spark.createDataFrame(rows, "image long, plane int, y long, x long"), frame(spark, 40, 33, (1, 2)), op, radius, ["image", "plane"]).collect()
    want = {(i, k, int(y), int(x)) for (i, k), m in masks.items() for y, x in np.argwhere(plain(op, m, radius))}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_morph_rejects_and_keeps_empty(spark):
    nothing = spark.createDataFrame([], "image long, y long, x long")
    assert labels.morph(nothing, frame(spark, 8, 8), "close", 2).count() == 0
    with pytest.raises(ValueError, match="unknown operation"):
        labels.morph(nothing, frame(spark, 8, 8), "shrink", 2)


def test_runs_of_all_forms_agree(spark):
    rng = np.random.default_rng(7)
    masks = {i: np.repeat(rng.integers(0, 4, (9, 12)), rng.integers(1, 4, 12), axis=1)[:, :12] for i in (1, 2)}
    masks[1][0] = 0
    masks[2][3] = 2
    pixels = table(spark, masks)
    rows = spark.createDataFrame([(i, y, [int(v) if v else (None if x % 2 else 0) for x, v in enumerate(a[y])]) for i, a in masks.items() for y in range(9)] + [(3, 0, [])], "image long, y long, ids array<long>")
    want = set()
    for i, a in masks.items():
        for y in range(9):
            x = 0
            while x < 12:
                e = x
                while e + 1 < 12 and a[y, e + 1] == a[y, x]:
                    e += 1
                if a[y, x]:
                    want.add((i, y, x, e, int(a[y, x])))
                x = e + 1
    for form in (pixels, rows, runs.to_runs(rows).withColumnRenamed("id", "nucleus_id")):
        got = runs.to_runs(form)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    back = runs.run_pixels(runs.to_runs(rows), "nucleus_id")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pixels.collect()))
    with pytest.raises(ValueError, match="one id column"):
        runs.to_runs(pixels.withColumn("more", F.lit(1)))


@pytest.mark.parametrize("form", ["pixels", "runs"])
def test_spots_meet_runs(spark, form):
    rng = random.Random(2)
    nuclei, rims = np.zeros((12, 15), int), np.zeros((12, 15), int)
    nuclei[2:6, 1:5], nuclei[2:6, 5:9] = 3, 4  # touching
    rims[1:7, 0:10], rims[8:12, 10:15] = 4, 7
    n, r = table(spark, {1: nuclei}), table(spark, {1: rims}, "cyto_id")
    if form == "runs":
        n, r = runs.to_runs(n), runs.to_runs(r)
    places = [(1, f"{k}", rng.uniform(-3, 14), rng.uniform(-3, 18)) for k in range(200)] + [(1, "edge", 11.9, 14.9), (2, "other", 3.0, 3.0), (1, "same", 3.0, 3.0), (1, "same", 3.0, 3.0)]
    spots = spark.createDataFrame(places, "image long, spot_id string, y_px double, x_px double")
    got = sorted((r["spot_id"], r["nucleus_id"], r["in_nucleus"], r["in_cytoplasm"]) for r in lookup.stratify_spots(spots, n, r, frame(spark, 12, 15, (1, 2))).collect())
    want = []
    for i, name, y, x in places:
        y, x = min(max(int(y), 0), 11), min(max(int(x), 0), 14)
        nucleus, rim = (nuclei[y, x], rims[y, x]) if i == 1 else (0, 0)
        want.append((name, int(nucleus or rim), bool(nucleus), bool(rim and not nucleus)))
    assert got == sorted(want)


def test_lookup_shuffles_no_label_pixels(spark):
    rows = spark.range(64).select(F.lit(1).cast("long").alias("image"), F.col("id").alias("y"), F.array_repeat(F.lit(5).cast("long"), 64).alias("ids"))
    spots = spark.createDataFrame([(1, 3, 3)], "image long, y_px long, x_px long")
    joined = runs.rows_of_runs([rows, rows])
    assert joined.count() == 64 and joined.selectExpr("max(size(cells))").first()[0] == 2  # a row of 64 pixels travels as one run of each mask
    assert lookup.stratify_spots(spots, rows, rows, frame(spark, 64, 64)).first()["nucleus_id"] == 5


def test_nucleoli_close_one_by_one_and_small_nuclei_are_searched_whole(spark):
    # nucleus 1: two dark bars with a gap of one pixel; closing them together would fill the gap
    ids, dapi = np.zeros((30, 60), int), np.full((30, 60), 100.0)
    ids[2:28, 2:28] = 1
    dapi[10:16, 8:11], dapi[10:16, 12:15] = 5, 5
    ids[10:14, 40:44] = 2  # too narrow for an interior at a border of 5
    dapi[11:13, 41:43] = 5
    planes = spark.createDataFrame([(1, y, [float(v) for v in dapi[y]]) for y in range(30)], "image long, y long, vals array<double>")
    got = labels.detect_nucleoli(planes, table(spark, {1: ids}), frame(spark, 30, 60), voxel_xy_um=1.0, pct=5.0, min_um2=4.0, max_frac=0.6, closing=1, border=5)
    found = {(r["y"], r["x"]): r["nucleolus_id"] for r in got.collect()}
    dark = {(y, x): int(ids[y, x]) for y, x in np.argwhere(dapi < 50)}
    assert found == dark and got.count() == len(dark)


def test_components_by_key(spark):
    rows = [(1, z, y, x) for z in (0, 1) for y, x in ((0, 0), (1, 1), (2, 2), (5, 5))]
    mask = spark.createDataFrame(rows, "image long, z int, y long, x long")
    got = {(r["z"], r["y"], r["x"]): r["component"] for r in labels.components(mask, 8, ["image", "z"]).collect()}
    assert got == {(z, y, x): 0 if y < 5 else 5 * 2**31 + 5 for _, z, y, x in rows}


def test_hull_corners_of_rows_in_any_order_with_gaps():
    from spotframe.operators.labels import _hull

    assert set(_hull([(3, 5, 5)])) == {(5, 10), (7, 10), (6, 9), (6, 11)}
    # an L whose notch lies inside the hull, its rows out of order and one missing
    corners = _hull([(4, 0, 6), (0, 0, 0), (1, 0, 0), (3, 0, 0)])
    assert set(corners) == {(-1, 0), (0, -1), (8, -1), (9, 0), (9, 12), (8, 13), (7, 12)}
