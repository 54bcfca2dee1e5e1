"""Cases that the registered tables do not contain: missing coordinates, dead channels, extreme statistics."""

import math

import numpy as np
from pyspark.sql import functions as F

from spotframe.functions.scalars import prettify
from spotframe.functions.tails import _exact_u, t_p, u_p
from spotframe.operators.channels import autodetect_channels
from spotframe.operators.focus import focus_scores, joint_plane, joint_score, plane_quality
from spotframe.operators.neighbours import nearest_partner
from spotframe.operators.ordering import densest_fov
from spotframe.operators.specks import mask_specks
from spotframe.operators.stats import replicate_test, replicate_tests
from spotframe.operators.thresholds import costes


def test_partner_search_ends_on_missing_coordinates(spark):
    schema = "image long, spot_id long, x_px double, y_px double, z_slice double"
    nan, inf = float("nan"), float("inf")
    a = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0), (1, 2, None, 0.0, 0.0), (1, 3, nan, 0.0, 0.0), (1, 4, inf, 0.0, 0.0), (2, 5, 0.0, 0.0, 0.0)], schema)
    b = spark.createDataFrame([(1, 1, 10.0, 0.0, 0.0), (1, 2, 1.0, None, 0.0), (2, 3, None, None, None), (2, 4, inf, 0.0, 0.0)], schema)
    got = {r["spot_id"]: r["nn_distance_um"] for r in nearest_partner(a, b, 1.0, 1.0).collect()}
    assert got == {1: 10.0, 2: None, 3: None, 4: None, 5: None}


def test_partner_search_across_two_far_clusters(spark):
    schema = "image long, spot_id long, x_px double, y_px double, z_slice double"
    a = spark.createDataFrame([(1, i, i / 10.0, 0.0, 0.0) for i in range(30)], schema)
    b = spark.createDataFrame([(1, i, 5000.0 + i / 10.0, 0.0, 0.0) for i in range(30)], schema)
    got = {r["spot_id"]: r["nn_distance_um"] for r in nearest_partner(a, b, 1.0, 1.0).collect()}
    assert all(abs(got[i] - (5000.0 - i / 10.0)) < 1e-9 for i in range(30))


def test_dead_channel_does_not_decide_the_joint_plane(spark):
    rows = [("i", "a", z, s) for z, s in enumerate((1.0, 4.0, 2.0))] + [("i", "b", z, 0.0) for z in range(3)]
    scores = spark.createDataFrame(rows, "image string, channel string, z long, score double")
    for how in ("product", "geomean", "min"):
        assert joint_plane(scores, how).first()["z"] == 1
    assert {r["z"]: r["score"] for r in joint_score(scores).collect()} == {0: 0.25, 1: 1.0, 2: 0.5}


def test_exact_u_tail():
    assert math.isclose(_exact_u(8 * 2000, 8, 2000), 2 / math.comb(2008, 8), rel_tol=1e-12)
    assert math.isclose(_exact_u(0, 3, 4), 2 / math.comb(7, 3), rel_tol=1e-12)
    assert _exact_u(6, 3, 4) == 1.0


def test_tails_at_large_degrees_of_freedom(spark):
    df = spark.createDataFrame([(2.0, 1e10), (2.0, 1e7), (None, 5.0)], "t double, df double")
    got = [r[0] for r in df.select(t_p("t", "df")).collect()]
    normal = math.erfc(2.0 / math.sqrt(2.0))
    assert abs(got[0] - normal) < 1e-9 and abs(got[1] - normal) < 1e-7 and got[2] is None


def test_costes_is_the_same_far_from_zero(spark):
    rows = [(1, float(i % 97), float((i % 97) // 2 + (i * 7) % 11)) for i in range(2000)]
    near = spark.createDataFrame(rows, "k long, a double, b double")
    far = near.withColumn("a", F.col("a") + 2.0**40).withColumn("b", F.col("b") + 2.0**40)
    low, high = costes(near, "a", "b", ["k"]).first(), costes(far, "a", "b", ["k"]).first()
    assert math.isclose(high["thr_a"] - 2.0**40, low["thr_a"], abs_tol=1e-3)


def test_channel_words_are_literal_and_late_channels_stay(spark):
    names = [("i", c, f"plain {c}", 1.0) for c in range(1500)] + [("i", 1500, "Far.Red (x", 2.0)]
    df = spark.createDataFrame(names, "image string, channel long, name string, mean double")
    got = {r["role"]: r["channel"] for r in autodetect_channels(df, (("dapi", ("plain 1499",)), ("rna", ("far.red (",)))).collect()}
    assert got == {"dapi": 1499, "rna": 1500}


def test_long_labels_stay_whole(spark):
    text = "x" * 1_200_000
    got = spark.range(1).select(F.length(prettify(F.lit(text), {}))).first()[0]
    assert got == len(text)


def test_masked_focus_scores(spark):
    rng = np.random.default_rng(4)
    planes = rng.integers(1, 100, (3, 6, 7)).astype(float)
    planes[2] *= 0.05
    rows = [(1, "a", z, y, planes[z, y].tolist()) for z in range(3) for y in range(6)] + [(2, "a", 0, y, [1.0, 5.0]) for y in range(2)]
    df = spark.createDataFrame(rows, "image long, channel string, z long, y long, vals array<double>")
    inside = [(y, x) for y in range(6) for x in range(7) if (y * 7 + x) % 3 == 0]
    mask = spark.createDataFrame([(1, y, x) for y, x in inside], "image long, y long, x long")
    got = {(r["image"], r["z"]): (r["score"], r["mean"]) for r in focus_scores(df, mask=mask).collect()}
    at = tuple(np.array(inside).T)
    for z, p in enumerate(planes):
        mean, e = p[at].mean(), np.pad(p, 1, mode="edge")
        lap = e[:-2, 1:-1] + e[2:, 1:-1] + e[1:-1, :-2] + e[1:-1, 2:] - 4 * p
        assert math.isclose(got[1, z][0], (lap / mean)[at].var(), rel_tol=1e-9) and math.isclose(got[1, z][1], mean, rel_tol=1e-12)
    assert got[2, 0] == (0.0, 0.0)
    full = spark.createDataFrame([(i, y, x) for i in (1, 2) for y in range(6) for x in range(7)], "image long, y long, x long")
    plain = sorted(map(tuple, focus_scores(df).collect()))
    assert all(a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9) for a, b in zip(plain, sorted(map(tuple, focus_scores(df, mask=full).collect()))))
    dim = {(r["image"], r["z"]): r["score"] for r in focus_scores(df, min_intensity=0.5).collect()}
    assert dim[1, 2] == 0.0 and dim[1, 0] > 0


def test_speck_takes_the_median_of_its_surroundings(spark):
    rng = np.random.default_rng(8)
    plane = rng.integers(90, 110, (24, 24)).astype(float)
    plane[:12] += 40
    speck = [(4, 4), (4, 5), (5, 4), (5, 5)]
    for y, x in speck:
        plane[y, x] = 9000
    plane[20, 20] = 9000  # too small to be one
    df = spark.createDataFrame([(1, y, x, float(plane[y, x])) for y in range(24) for x in range(24)], "image long, y long, x long, v double")
    near = {(y + dy, x + dx) for y, x in speck for dy in range(-5, 6) for dx in range(-5, 6) if abs(dy) + abs(dx) <= 5} - set(speck)
    ring = np.median([plane[y, x] for y, x in near if 0 <= y < 24 and 0 <= x < 24])
    cleaned, counts = mask_specks(df, 3, 20.0, "local")
    got = {(r["y"], r["x"]): r["v"] for r in cleaned.collect()}
    assert all(got[p] == ring for p in speck) and got[20, 20] == 9000 and counts.first()["n_masked"] == 4
    assert {r["v"] for r in mask_specks(df, 3, 20.0)[0].where("y in (4, 5) and x in (4, 5)").collect()} == {float(np.median(plane))}


def test_quality_and_middle_field(spark):
    flat = [(1, i, 5.0) for i in range(50)]
    tail = [(2, i, 5.0 if i < 40 else 90.0) for i in range(50)]
    got = {r["image"]: r["quality"] for r in plane_quality(spark.createDataFrame(flat + tail, "image long, i long, v double")).collect()}
    assert got == {1: 0.0, 2: float("inf")}
    fields = spark.createDataFrame([(1, f, n) for f, n in ((0, 3), (1, 9), (2, 9), (3, None))] + [(2, f, None) for f in (4, 2, 9, 7)], "well long, fov long, nucleus_count long")
    assert {r["well"]: (r["fov"], r["nucleus_count"]) for r in densest_fov(fields).collect()} == {1: (1, 9), 2: (7, None)}


def test_every_group_against_the_first(spark):
    rows = [(g, r, float(i + 3 * r + 7 * "abc".index(g))) for g in "abc" for r in range(4) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, rep long, v double")
    got = {r["against"]: r.asDict() for r in replicate_tests(df, "v", "g", ["a", "b", "c"], "rep").collect()}
    assert set(got) == {"b", "c"}
    for other in "bc":
        one = replicate_test(df, "v", "g", "a", other, "rep").first().asDict()
        assert {k: v for k, v in got[other].items() if k != "against"} == one


def test_u_p_falls_to_normal_with_ties(spark):
    df = spark.createDataFrame([(10.0, 5.0, 4.0, 6.0), (None, 5.0, 4.0, 0.0)], "u double, n1 double, n2 double, ties double")
    got = [r[0] for r in df.select(u_p("u", "n1", "n2", "ties")).collect()]
    assert 0.9 < got[0] <= 1.0 and got[1] is None
