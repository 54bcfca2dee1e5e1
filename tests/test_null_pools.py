"""Nulls whose iterations stay in the task that draws them, against the forms that give every iteration away."""

import os

import numpy as np
import pytest

from spotframe.operators import nulls
from spotframe.operators.runs import to_runs
from spotframe.session import checkpoint_folder

SPOTS = [((10, 10), 300), ((10, 30), 5), ((30, 10), 2), ((30, 30), 6)]  # around the middles of four nuclei; the first is crowded


@pytest.fixture(scope="module")
def inputs(spark):
    rng = np.random.default_rng(3)
    yy, xx = np.mgrid[:40, :40]
    label, spots = np.zeros((40, 40), dtype=int), []
    for number, ((y, x), count) in enumerate(SPOTS, 1):
        label[(yy - y) ** 2 + (xx - x) ** 2 <= 49] = number
        spots += [(image, number, 1000 * number + i, float(a), float(b)) for image in (1, 2, 3) for i, (a, b) in enumerate(rng.integers(-6, 7, (count, 2)) + (y, x)) if image != 3 or number > 1]
    rows = [(image, y, [float(v) for v in rng.integers(0, 900, 40)]) for image in (1, 2, 3) for y in range(40)]
    labels = [(image, y, [int(v) for v in label[y]]) for image in (1, 2, 3) for y in range(40)]
    return (
        spark.createDataFrame(spots, "image long, nucleus_id long, spot_id long, y_px double, x_px double"),
        spark.createDataFrame(rows, "image long, y long, vals array<double>"),
        spark.createDataFrame(labels, "image long, y long, ids array<long>"),
    )


def _values(pooled):
    return {(r["image"], r["iter"]): (r["value"], r["obs"]) for r in nulls.image_draws(pooled).collect()}


def test_pooled_positions_are_those_of_all_nuclei(inputs):
    draws, observed = nulls.position_null(*inputs, n=40)
    want = {(r["image"], r["iter"]): (r["value"], r["obs"]) for r in nulls.pool_draws(draws, observed)[0].collect()}
    pooled = nulls.pooled_position_null(*inputs, n=40)
    got = _values(pooled)
    assert len(want) == 120 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert {r["image"]: (r["n_spots"], r["n_nuclei"]) for r in pooled.collect()} == {1: (313, 4), 2: (313, 4), 3: (13, 3)}


def test_pooled_rotations_are_those_of_usable_nuclei(inputs):
    draws, nuclei, observed = nulls.rotation_null(*inputs, n=30, min_retention=0.9)
    usable = nuclei.where("usable").select(*nulls.KEY)
    assert 0 < usable.count() < nuclei.count()
    want = nulls.pool_draws(*(df.join(usable, nulls.KEY, "left_semi") for df in (draws, observed)))[0]
    want = {(r["image"], r["iter"]): (r["value"], r["obs"]) for r in want.collect()}
    got = _values(nulls.pooled_rotation_null(*inputs, n=30, min_retention=0.9))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_share_of_spots_is_that_of_chunks(inputs, monkeypatch):
    def shares():
        return {(r["image"], r["nucleus_id"]): (r["threshold"], r["fraction"]) for r in nulls.association_fraction(*inputs, n=50).where("nucleus_id > 1").collect()}

    whole = shares()
    monkeypatch.setattr(nulls, "CHUNK", 2)  # only the driver cuts smaller chunks: every value then goes by the stored arrays
    chunks = shares()
    assert len(whole) == 9 and chunks.keys() == whole.keys() and all(chunks[k] == pytest.approx(whole[k]) for k in whole)


def test_iterations_are_not_stored(spark, inputs):
    few = [inputs[0].where("nucleus_id > 1"), *inputs[1:]]

    def stored():
        return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(checkpoint_folder(spark).removeprefix("file:")) for f in files)

    before = stored()
    assert nulls.radial_null(*few, n=20000).count() == 36
    # four rings of nine nuclei with 20000 iterations of 8 bytes would be 5.8 MB
    assert stored() - before < 1_000_000


def test_row_labels_become_runs(spark):
    rows = spark.createDataFrame([(1, 0, [0, 3, 3, 2, None, 2]), (1, 1, []), (1, 2, [5]), (1, 3, None)], "image long, y long, ids array<long>")
    assert sorted(map(tuple, to_runs(rows).collect())) == [(1, 0, 1, 2, 3), (1, 0, 3, 3, 2), (1, 0, 5, 5, 2), (1, 2, 0, 0, 5)]


def test_reference_range_reads_its_pixels_once(spark):
    from spotframe.operators import ranges

    rows = [("a", ("nucleus", "cytoplasm", "background")[i % 3], float(i * 37 % 101)) for i in range(300)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    pixels = spark.createDataFrame(rows, "channel string, region string, v double").mapInArrow(counted, "channel string, region string, v double")
    got = ranges.reference_range(pixels, "cytoplasm", "nucleus", 60.0, 99.5).first()
    assert read.value == 300
    want = [np.percentile([v for _, r, v in rows if r == region], p) for region, p in (("cytoplasm", 60), ("nucleus", 99.5))]
    assert (got["lo"], got["hi"]) == pytest.approx(tuple(want)) and read.value == 300
