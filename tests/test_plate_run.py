"""A small plate run by hand: routing, rims, rejected files, conflicts and wells without a nucleus."""

import math

import pytest

from spotframe.plans.modes import run_mode
from spotframe.plans.plate_run import TABLES

MAP = {"568": "green", "647": "red"}
#: image: (well, routed channel's value in the nucleus, in the rim, elsewhere)
IMAGES = {1: (1, 100.0, 50.0, 10.0), 2: (1, 120.0, 40.0, 10.0), 3: (2, 60.0, 30.0, 10.0), 4: (3, 20.0, 20.0, 10.0), 5: (4, 90.0, 45.0, 10.0), 6: (9, 1.0, 1.0, 1.0)}
PLATE = [(1, "WT", "primary", "568", "green"), (2, "KO", "primary", "568", "green"), (3, "WT", "seconly", "568", "green"), (4, "WT", "primary", "647", "red"), (5, "KO", "seconly", "568", "green")]


@pytest.fixture(scope="module")
def inputs(spark):
    def where(y, x):
        return 0 if 3 <= y < 5 and 3 <= x < 5 else 1 if 2 <= y < 6 and 2 <= x < 6 else 2

    routed = {w: c for w, _, _, _, c in PLATE}
    rows = [(i, c, y, [v[where(y, x) + 1] * (1.0 if c == routed.get(v[0]) else 0.5) if c != "dapi" else 7.0 for x in range(8)]) for i, v in IMAGES.items() for c in ("dapi", "green", "red") for y in range(8)]
    masked = [i for i in IMAGES if i != 4]  # image 4 has no nucleus
    return {
        "files": spark.createDataFrame([(i, v[0], f"f{i}.vsi", i) for i, v in IMAGES.items()] + [(7, 1, "f7.vsi", 7)], "image long, well int, file string, fov_seq int"),
        "plate": spark.createDataFrame(PLATE, "well int, genotype string, arm string, secondary string, channel string"),
        "plane_rows": spark.createDataFrame(rows, "image long, channel string, y long, vals array<double>"),
        "labels": spark.createDataFrame([(i, y, x, 1) for i in masked for y in range(8) for x in range(8) if where(y, x) == 0], "image long, y long, x long, nucleus_id long"),
        "ring": spark.createDataFrame([(i, y, x, 1) for i in masked for y in range(8) for x in range(8) if where(y, x) == 1], "image long, y long, x long, cyto_id long"),
    }


@pytest.fixture(scope="module")
def tables(inputs):
    return run_mode("if_intensity", inputs, channel_map=MAP, overrides={1: "647", 2: "568"})


def test_all_tables_are_there(tables):
    assert set(tables) == set(TABLES)


def test_fields_and_nuclei(tables):
    fields = {r["file"]: r for r in tables["per_fov"].collect()}
    assert set(fields) == {"f1.vsi", "f2.vsi", "f3.vsi", "f4.vsi", "f5.vsi"}
    one = fields["f1.vsi"]
    assert one["nucleus_count"] == 1 and one["nuc_mean_qki"] == 100.0 and one["nuc_integrated_qki"] == 400.0 and one["cyto_mean_qki"] == 50.0 and one["nuc_over_cyto"] == 2.0
    assert one["qki_mean"] == (4 * 100 + 12 * 50 + 48 * 10) / 64 and one["mean_green"] == one["qki_mean"] and one["mean_red"] == one["qki_mean"] / 2
    assert one["total_dapi"] == 7 * 64 and one["exp_qki_s"] is None
    assert fields["f5.vsi"]["qki_channel"] == "red" and fields["f5.vsi"]["nuc_mean_qki"] == 90.0
    bare = fields["f4.vsi"]
    assert bare["nucleus_count"] == 0 and bare["nuc_mean_qki"] is None and bare["M1_pn"] is None
    # background of the genotype's secondary-only fields; KO has no such field on disk
    assert one["sec_qki_mean_pooled"] == bare["qki_mean"] and one["fold_qki_mean"] == one["qki_mean"] / bare["qki_mean"] and fields["f3.vsi"]["fold_qki_mean"] is None
    assert one["sec_m1_base"] is None and math.isclose(one["M1_pn"], (one["qki_mean"] - bare["qki_mean"]) * 64)
    nuclei = tables["per_nucleus"].collect()
    assert sorted((r["file"], r["nucleus_label"], r["area_px"]) for r in nuclei) == [(f"f{i}.vsi", 1, 4) for i in (1, 2, 3, 5)]


def test_wells_tests_and_projections(tables):
    wells = {r["well"]: r for r in tables["per_well"].collect()}
    assert set(wells) == {1, 2, 3, 4} and wells[1]["n_fov"] == 2 and wells[1]["nuc_mean_qki"] == 110.0
    assert math.isclose(wells[1]["wellfold_qki_mean"], wells[1]["qki_mean"] / wells[3]["qki_mean"]) and wells[2]["wellfold_qki_mean"] is None and wells[3]["wellfold_qki_mean"] is None
    stats = {(r["analysis"], r["secondary"], r["genotype"], r["metric"]): r for r in tables["stats"].collect()}
    raw = stats["per_secondary_raw", "568", "both", "ratio_qki_over_dapi"]
    assert (raw["n_a"], raw["n_b"]) == (1, 1) and raw["floor_WT"] == wells[3]["ratio_qki_over_dapi"] and raw["floor_KO"] is None
    pooled = stats["pooled_fold_n3", "pooled", "both", "wellfold_ratio"]
    assert pooled["group_A"] == "WT_primary(1,4)" and pooled["group_B"] == "KO_primary(2)"
    assert stats["primary_vs_seconly", "568", "WT", "nuc_mean_qki"]["group_A"] == "WT_primary"
    images = {r["image"]: r for r in tables["per_image_summary"].collect()}
    assert images["f4.vsi"]["secondary_only"] and images["f1.vsi"]["condition"] == "WT primary 568" and images["f1.vsi"]["nuclei_analyzed"] == 1
    assert {r["nucleus_area_px"] for r in tables["nuclei_metrics"].collect()} == {4}
    assert {r["channel"]: r["status"] for r in tables["exposure"].collect()} == {"green": "OK", "red": "OK", "dapi(DAPI)": "OK"}


def test_rejected_files_and_conflicts(inputs, tables):
    assert {(r["image"], r["reason"]) for r in tables["rejected"].collect()} == {(6, "not on the plate"), (7, "no pixels")}
    assert {r["well"]: r["verdict"] for r in tables["conflict"].collect()} == {1: "conflicts", 2: "consistent"}
    strict = run_mode("if_intensity", inputs, channel_map=MAP, overrides={1: "647", 2: "568"}, drop_conflicts=True)
    assert {r["well"] for r in strict["per_well"].select("well").collect()} == {2, 3, 4}
    assert (1, "conflicting override") in {(r["image"], r["reason"]) for r in strict["rejected"].collect()}


def test_rim_is_made_where_none_is_given(inputs):
    run = run_mode("if_intensity", {**inputs, "ring": None}, channel_map=MAP, ring_px=1)
    one = next(r for r in run["per_fov"].collect() if r["file"] == "f1.vsi")
    assert one["cyto_mean_qki"] == 50.0 and one["nuc_over_cyto"] == 2.0  # pixels one away from the nucleus lie in the rim
