"""Hand-computed and brute-force cases."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotframe.functions import draws, ranks, scalars, stencils
from spotframe.operators import coloc, focus, intensity, labels, lookup, neighbours, nulls, ranges, sampling, stats, thresholds
from spotframe.functions.tails import chi2_p, t_p, u_p
from spotframe.plans import modes


def rows_of(spark, plane, image=1):
    data = [(image, y, [float(v) for v in row]) for y, row in enumerate(plane)]
    return spark.createDataFrame(data, "image long, y long, vals array<double>")


def test_disk_and_rings():
    assert len(stencils.disk(3.0)) == 29
    tiles = stencils.rings([1.0, 2.0, 3.0])
    assert sorted(itertools.chain(*tiles)) == sorted(stencils.disk(3.0))


def test_threshold_scene(spark):
    values = {(0, 0): 300, (0, 1): 150, (1, 0): 50, (1, 1): 80, (2, 2): 400, (2, 3): 400, (3, 2): 20, (3, 3): 90}
    plane = np.zeros((4, 4))
    for (y, x), v in values.items():
        plane[y, x] = v
    rows = rows_of(spark, plane).withColumn("channel", F.lit("rna"))
    nuc = spark.createDataFrame([(1, y, x, 1) for y, x in values if y < 2], "image long, y long, x long, nucleus_id long")
    rim = spark.createDataFrame([(1, y, x, 1) for y, x in values if y > 1], "image long, y long, x long, cyto_id long")
    got = intensity.thresholded_intensity(rows, nuc, rim, 100.0).first()
    assert (got["nuc_thresh_total"], got["nuc_thresh_mean"], got["nuc_thresh_area_px"], got["nuc_thresh_fraction"]) == (450, 225, 2, 0.5)
    assert (got["cyto_thresh_total"], got["cyto_thresh_area_px"]) == (800, 2)
    assert intensity.thresholded_intensity(rows, nuc, rim, 150.0).first()["nuc_thresh_area_px"] == 2  # equal counts
    none = intensity.thresholded_intensity(rows, nuc, rim, None).first()
    assert none["nuc_thresh_total"] is None and none["nuc_thresh_area_px"] == 0


def test_nearest_partner_is_brute_force(spark):
    rng = np.random.default_rng(3)
    a = [(1, i, float(x), float(y), int(z)) for i, (x, y, z) in enumerate(rng.integers(0, 300, (60, 3)) % [300, 300, 5])]
    b = [(1, i, float(x), float(y), int(z)) for i, (x, y, z) in enumerate(rng.integers(0, 60, (20, 3)) % [60, 60, 5])]
    schema = "image long, spot_id long, x_px double, y_px double, z_slice int"
    lonely = [(2, 99, 1.0, 1.0, 0)]
    got = {
        (r["image"], r["spot_id"]): r["nn_distance_um"]
        for r in neighbours.nearest_partner(spark.createDataFrame(a + lonely, schema), spark.createDataFrame(b, schema)).collect()
    }
    for _, i, x, y, z in a:
        best = min(math.dist((x * 0.13, y * 0.13, z * 0.3), (p * 0.13, q * 0.13, w * 0.3)) for _, _, p, q, w in b)
        assert got[(1, i)] == pytest.approx(best, abs=1e-9)
    assert got[(2, 99)] is None


def test_ranks_survive_bucket_cuts(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLE_ONE_IN", 2)
    monkeypatch.setattr(ranks, "BUCKETS", 8)
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=400), np.full(150, 0.25)])
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    got = ranks.quantiles(df, "v", ["k"], {"a": 0.37, "m": 0.5}).first()
    assert got["a"] == pytest.approx(np.percentile(values, 37)) and got["m"] == pytest.approx(np.median(values))
    order = {r["v"]: r["rank"] for r in ranks.value_ranks(df, "v", ["k"]).collect()}
    assert order[0.25] == (values < 0.25).sum() + (150 + 1) / 2


def test_tail_probabilities(spark):
    row = spark.createDataFrame([(2.0, 10.0, 3.84145882, 1.0, 1.0, 3.0, 3.0, 0.0)], "t double, df double, x double, k double, u double, n1 double, n2 double, ties double").select(
        t_p("t", "df").alias("t"), chi2_p("x", "k").alias("c"), u_p("u", "n1", "n2", "ties").alias("u")
    ).first()
    assert row["t"] == pytest.approx(0.07338803, abs=1e-7)
    assert row["c"] == pytest.approx(0.05, abs=1e-7)
    assert row["u"] == pytest.approx(0.2, abs=1e-12)  # 2 * 2/20


def test_draws_agree_and_are_even(spark):
    state = 987654321
    df = spark.range(1, 2001).select(draws.draw(F.lit(state).cast("long"), F.col("id"), F.lit(5)).alias("d"))
    got = np.array([r["d"] for r in df.collect()])
    assert (got == nulls._draw(np.int64(state), np.arange(1, 2001), np.full(2000, 5))).all()
    assert abs((got / draws.PRIME).mean() - 0.5) < 0.03


def _one_nucleus(spark, partner):
    yy, xx = np.mgrid[:40, :40]
    inside = (yy - 20) ** 2 + (xx - 20) ** 2 <= 12**2
    lab = spark.createDataFrame([(1, int(y), int(x), 1) for y, x in zip(*np.nonzero(inside))], "image long, y long, x long, nucleus_id long")
    spots = spark.createDataFrame([(1, 1, i, float(y), float(x)) for i, (y, x) in enumerate([(15, 15), (20, 25), (24, 18), (18, 22)])], "image long, nucleus_id long, spot_id long, y_px double, x_px double")
    return spots, rows_of(spark, partner), lab


def test_constant_partner_gives_enrichment_one(spark):
    spots, rows, lab = _one_nucleus(spark, np.full((40, 40), 7.0))
    got = nulls.null_summary(*nulls.position_null(spots, rows, lab, n=50)).first()
    assert got["enrichment"] == pytest.approx(1.0)
    turned, nuclei, obs = nulls.rotation_null(spots, rows, lab, n=20)
    assert nuclei.first()["usable"] and nulls.null_summary(turned, obs).first()["enrichment"] == pytest.approx(1.0)


def test_bright_partner_is_enriched_whatever_the_partitioning(spark):
    plane = np.full((40, 40), 10.0)
    for y, x in [(15, 15), (20, 25), (24, 18), (18, 22)]:
        plane[y - 2 : y + 3, x - 2 : x + 3] = 500.0
    results = []
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        results.append(nulls.null_summary(*nulls.position_null(*_one_nucleus(spark, plane), n=200)).first())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0]["enrichment"] > 1.5 and results[0]["p"] < 0.05
    assert results[0]["null_mean"] == pytest.approx(results[1]["null_mean"]) and results[0]["p"] == results[1]["p"]


def test_crowded_nucleus_is_chunked_without_changing_draws(spark, monkeypatch):
    spots, rows, lab = _one_nucleus(spark, np.arange(1600.0).reshape(40, 40))
    whole = nulls.null_summary(*nulls.position_null(spots, rows, lab, n=30)).first()
    monkeypatch.setattr(nulls, "CHUNK", 3)
    parts = nulls.null_summary(*nulls.position_null(spots, rows, lab, n=30)).first()
    assert whole["null_mean"] == pytest.approx(parts["null_mean"])


def test_coloc_identical_and_orthogonal(spark):
    same = [(1, float(v), float(v)) for v in range(20)]
    flat = [(2, float(i % 2), float((i // 2) % 2)) for i in range(20)]
    px = spark.createDataFrame(same + flat, "k int, a double, b double")
    thr = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0)], "k int, thr_a double, thr_b double")
    got = {r["k"]: r for r in coloc.coloc_metrics(px, thr, ["k"], ["k"]).collect()}
    assert got[1]["pearson_r"] == pytest.approx(1.0) and got[2]["pearson_r"] == pytest.approx(0.0)
    small = coloc.coloc_metrics(px.limit(0).unionByName(spark.createDataFrame(same[:5], "k int, a double, b double")), thr, ["k"], ["k"]).first()
    assert small["pearson_r"] == 0.0 and small["thr_a"] is None


def test_costes_needs_twenty_pixels(spark):
    few = spark.createDataFrame([(1, float(i), float(i)) for i in range(10)], "k int, a double, b double")
    assert thresholds.costes(few, "a", "b", ["k"]).first()["thr_a"] == float("inf")


def test_fixed_window_slides_then_shrinks(spark):
    peak = spark.createDataFrame([(1, 0, 9, 0), (2, 0, 9, 5), (3, 0, 9, 9), (4, 0, 2, 1)], "image int, lo int, hi int, peak_z int")
    got = {r["image"]: (r["z_start"], r["z_end"], r["shifted"], r["shrunk"]) for r in focus.fixed_window(peak, 5).collect()}
    assert got == {1: (0, 4, True, False), 2: (3, 7, False, False), 3: (5, 9, True, False), 4: (0, 2, False, True)}


def test_window_grows_to_the_roomier_side(spark):
    scores = spark.createDataFrame([(1, z, s, 1.0) for z, s in enumerate([0.1, 0.1, 1.0, 0.1, 0.1, 0.1])], "image int, z int, score double, mean double")
    got = focus.focus_window(scores, focus.peak_z(scores), min_slices=3).first()
    # room 2 left, 3 right: first right, then the tie of 2 and 2 goes left
    assert (got["z_start"], got["z_end"], got["expanded"]) == (1, 3, True)


def test_components_and_perimeter(spark):
    ring = [(1, y, x) for y in range(5) for x in range(5) if y in (0, 4) or x in (0, 4)] + [(1, 2, 2), (1, 7, 7), (1, 8, 8)]
    mask = spark.createDataFrame(ring, "image long, y long, x long")
    assert labels.components(mask, 4).select("component").distinct().count() == 4
    assert labels.components(mask, 8).select("component").distinct().count() == 3
    square = spark.createDataFrame([(1, y, x, 1) for y in range(10) for x in range(10)], "image long, y long, x long, nucleus_id long")
    shape = labels.morphology(square, 1.0).first()
    assert shape["perimeter_um"] == pytest.approx(36.0) and shape["solidity"] > 0.95


def test_smoothing_restores_what_vanishes(spark):
    lab = spark.createDataFrame([(1, 5, x, 1) for x in range(3)] + [(1, y, x, 2) for y in range(8, 16) for x in range(8, 16)], "image long, y long, x long, nucleus_id long")
    frame = spark.createDataFrame([(1, 20, 20)], "image long, height int, width int")
    got = labels.smooth_labels(lab, frame, 2).groupBy("nucleus_id").count().collect()
    assert {r["nucleus_id"] for r in got} == {1, 2}


def test_footprint_scales_with_the_spot(spark):
    yy, xx = np.mgrid[:40, :40]
    plane = 100 * np.exp(-((yy - 20) ** 2 + (xx - 20) ** 2) / 18.0) + 1
    spots = spark.createDataFrame([(1, "rna1", 1, 20.0, 20.0, 0.9)], "image long, channel string, spot_id long, y_px double, x_px double, diameter_um double")
    got, pixels = sampling.footprint(spots, rows_of(spark, plane), rows_of(spark, np.full((40, 40), 3.0)))
    row = got.first()
    expected = int((plane >= 1 + 0.5 * (plane.max() - np.percentile(plane[11:30, 11:30], 10))).sum())
    assert row["footprint_mean"] == pytest.approx(3.0) and abs(row["footprint_area_px"] - expected) <= 12
    assert pixels.count() == row["footprint_area_px"]


def test_outlier_needs_spread(spark):
    base = [(i, 10.0 + i % 3, "", True) for i in range(9)]
    df = spark.createDataFrame(base + [(99, 900.0, "low_focus", False)], "image int, qc_rna1_spots_per_nucleus double, qc_flags string, qc_pass boolean")
    hit = ranges.flag_outliers(df).where("run_outlier").collect()
    assert [r["image"] for r in hit] == [99] and hit[0]["qc_flags"] == "low_focus,overdetect_rna1_outlier"


def test_gate_tolerance(spark):
    new = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (2, 1.0, 1.0, 1.05)], "image int, obs double, null_mean double, enrichment double")
    old = spark.createDataFrame([(1, 1.01, 1.0, 1.0), (2, 1.0, 1.0, 1.0)], "image int, protein_obs double, protein_null_mean double, rna2_enrichment double")
    assert {r["image"]: r["passed"] for r in lookup.gate(new, old).collect()} == {1: True, 2: False}


def test_labels_and_modes(spark):
    assert scalars.pair_suffix(0.3) == "0p3um"
    got = spark.range(1).select(scalars.safe_label(F.lit("gene OE/KD")).alias("a"), scalars.safe_label(F.lit("Sec-Only")).alias("b")).first()
    assert (got["a"], got["b"]) == ("gene_OE_KD", "Sec_Only")
    with pytest.raises(KeyError, match="rna_only"):
        modes.run_mode("nonsense", {})


def test_welch_matches_by_hand(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 6.0), ("b", 8.0)], "g string, v double")
    got = stats.welch(df, "v", "g", "a", "b").first()
    assert got["t"] == pytest.approx(-4 / math.sqrt(1 / 3 + 4 / 3))
    df = (5 / 3) ** 2 / ((1 / 3) ** 2 / 2 + (4 / 3) ** 2 / 2)
    assert got["df"] == pytest.approx(df)
    # the tail by numerical integration of the density over an angle
    angle = np.linspace(math.atan(abs(got["t"]) / math.sqrt(df)), math.pi / 2, 200001)
    height = math.gamma((df + 1) / 2) / (math.sqrt(math.pi) * math.gamma(df / 2)) * np.cos(angle) ** (df - 1)
    tail = float(((height[1:] + height[:-1]) / 2 * np.diff(angle)).sum())
    assert got["welch_p"] == pytest.approx(2 * tail, abs=1e-7)
