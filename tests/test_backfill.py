"""Backfill of a finished run: values, status of images, and runs that are stopped half way."""

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spotframe.plans import backfill as B
from spotframe.sources.tables import write_tables

SIZE, NUCLEI = 40, {1: (12, 12), 2: (28, 26)}
SETTINGS = {"n": 60, "shards": 4, "wave": 2, "exclude_nucleoli": False, "families": ("position", "radial", "rotation", "patch"), "bins_um": (0.25, 0.5)}


def value(image, channel, y, x, bright):
    if image == 4:
        return 50.0  # an even field
    near = min((y - a) ** 2 + (x - b) ** 2 for a, b in bright)
    return float((y * 31 + x * 17 + image * 7) % 50 + (600 if channel == "rna2" and near <= 9 else 0))


def make_run(spark, run, images):
    """Two round nuclei with four bright spots each; image 6 has no mask, 7 no pixels, 8 a mask that is too large."""
    places = {k: [(y - 2, x), (y + 3, x), (y, x + 4), (y, x - 4)] for k, (y, x) in NUCLEI.items()}
    bright = [p for spots in places.values() for p in spots]
    inside = [(y, x, k) for k, (a, b) in NUCLEI.items() for y in range(SIZE) for x in range(SIZE) if (y - a) ** 2 + (x - b) ** 2 <= 100]
    labels = [(i, y, x, k) for i in images if i != 6 for y, x, k in inside] + [(8, SIZE + 3, 0, 1)] * (8 in images)
    spots = [(i, c, 100 * i + 10 * k + j, k, y, x) for i in images for c in ("rna1", "rna2") for k, at in places.items() for j, (y, x) in enumerate(at)]
    spots += [(i, "rna1", 100 * i + 90, 0, 0, 0) for i in images] + [(i, "rna1", 100 * i + 91, 9, 5, 5) for i in images]
    rows = [(i, c, z, y, [value(i, c, y, x, bright) + (0 if z == 1 else 1000) for x in range(SIZE)] if c != "dapi" else [float((x * 7 % 5) * (z == 1)) + 10 for x in range(SIZE)])
            for i in images if i != 7 for c in ("dapi", "rna1", "rna2") for z in (0, 1) for y in range(SIZE)]
    tables = {
        "labels": spark.createDataFrame(labels, "image long, y long, x long, nucleus_id long"),
        "spot_metrics": spark.createDataFrame(spots, "image long, channel string, spot_id long, nucleus_id long, y_px long, x_px long"),
        "plane_rows": spark.createDataFrame(rows, "image long, channel string, z int, y long, vals array<double>"),
        "per_image_summary": spark.createDataFrame([(i, "WT" if i % 2 else "KO") for i in images], "image long, condition string"),
    }
    write_tables(tables, run)
    return run


def files(run):
    return {str(p.relative_to(run)): p.stat().st_mtime_ns for p in Path(run).rglob("*.parquet") if "shard=" in str(p)}


def rows(spark, run, table):
    # sums of doubles depend on their order in the last digits
    return sorted((tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in B.backfilled(spark, run, table).collect()), key=str)


TABLES = [t for family in SETTINGS["families"] for t in B.RESULTS[family]] + [B.GATE]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    run = make_run(spark, str(tmp_path_factory.mktemp("whole")), range(1, 9))
    return run, B.backfill(spark, run, **SETTINGS)


def test_images_and_their_status(spark, whole):
    run, counts = whole
    assert counts == {"images": 8, "computed": 5, "passed": 0, "failed": 5}  # the run stores no numbers to hold against
    status = {r["image"]: r["status"] for r in B.backfilled(spark, run, B.GATE).collect()}
    assert status == {**dict.fromkeys(range(1, 6), "ok"), 6: "no mask", 7: "no plane", 8: "shape"}
    summary = {r["image"]: r for r in B.backfilled(spark, run, "coloc_null_summary").collect()}
    assert set(summary) == set(range(1, 6))
    # bright spots are enriched on the sharp slice; an even field is not, and its draws have no spread
    assert summary[1]["pooled_null_enrichment"] > 1.2 and summary[1]["pooled_null_p_empirical"] < 0.05 and summary[1]["n_nuclei_used"] == 2
    assert summary[1]["pooled_obs"] < 1000  # not the other slice
    even = summary[4]
    assert even["pooled_obs"] == even["pooled_null_mean"] == 50.0 and even["pooled_null_z"] is None and even["pooled_null_p_empirical"] == 1.0
    draws = B.backfilled(spark, run, "coloc_null_draws").where("image = 1").collect()
    assert sorted(r["iter"] for r in draws) == list(range(60)) and {r["condition"] for r in draws} == {"WT"}
    assert math.isclose(sum(r["pooled_null_value"] for r in draws) / 60, summary[1]["pooled_null_mean"])
    patch = {(r["image"], r["kind"]): r["value"] for r in B.backfilled(spark, run, "coloc_mean_patch").where("dy = 0 and dx = 0").collect()}
    assert patch[1, "spots"] > 1.5 * patch[1, "random"] and patch[4, "spots"] == patch[4, "random"] == 1.0
    assert B.pooled_patch(B.backfilled(spark, run, "coloc_mean_patch")).count() == 2 * 21 * 21
    assert B.backfilled(spark, run, "coloc_radial_profile").groupBy("image").count().where("count <> 2").count() == 0
    assert B.backfilled(spark, run, "coloc_rotation_null_summary").where("pooled_rotation_enrichment > 1.1").count() >= 4


def test_a_second_run_changes_nothing(spark, whole):
    run, _ = whole
    before = files(run)
    assert B.backfill(spark, run, **SETTINGS)["computed"] == 0
    assert files(run) == before
    with pytest.raises(ValueError, match="unknown null families"):
        B.backfill(spark, run, families=("tilt",))


@pytest.mark.parametrize("stop_at", [2, 9])
def test_a_stopped_run_goes_on(spark, whole, tmp_path, monkeypatch, stop_at):
    run = make_run(spark, str(tmp_path), range(1, 9))
    write, written = B._replace, []

    def stopped(df, where, table):
        if len(written) == stop_at:
            raise InterruptedError(table)
        written.append(table)
        write(df, where, table)

    monkeypatch.setattr(B, "_replace", stopped)
    with pytest.raises(InterruptedError):
        B.backfill(spark, run, **SETTINGS)
    done = {r["image"] for r in B.backfilled(spark, run, B.GATE).where("status = 'ok'").collect()} if B.GATE in written else set()
    if done:  # what is shown is complete, also where later tables of a wave were not reached
        shown = {r["image"] for r in B.backfilled(spark, run, "coloc_null_summary").collect()}
        assert shown == done
    monkeypatch.setattr(B, "_replace", write)
    again = B.backfill(spark, run, **SETTINGS)
    assert again["computed"] == 5 - len(done)
    for table in TABLES:
        assert rows(spark, run, table) == rows(spark, whole[0], table)


def test_inputs_that_come_later_are_taken_up(spark, whole, tmp_path):
    run = make_run(spark, str(tmp_path), [1, 2, 6])
    B.backfill(spark, run, **SETTINGS)
    more = spark.read.parquet(f"{run}/labels").where("image = 1").withColumn("image", F.lit(6).cast("long"))
    more.write.mode("append").parquet(f"{run}/labels")
    counts = B.backfill(spark, run, **SETTINGS)
    assert 1 <= counts["computed"] <= 3 and counts["images"] == 3
    assert {r["image"] for r in B.backfilled(spark, run, "coloc_null_summary").collect()} == {1, 2, 6}
    # the numbers of images that were there do not move
    assert [r for r in rows(spark, run, "coloc_null_draws") if r[0] == 1] == [r for r in rows(spark, whole[0], "coloc_null_draws") if r[0] == 1]
    assert B.backfill(spark, run, **{**SETTINGS, "seed": 5})["computed"] == 3
    assert B.backfill(spark, run, **{**SETTINGS, "seed": 5})["computed"] == 0


def test_gate_holds_the_run_against_its_own_numbers(spark, whole, tmp_path):
    run = make_run(spark, str(tmp_path), [1, 2, 3, 5])
    known = B.backfilled(spark, whole[0], "coloc_null_summary")
    off = F.when(F.col("image") == 2, 1.05).otherwise(1.01)
    stored = known.where("image in (1, 2, 5)").select(
        "image", "condition", (F.col("pooled_obs") * off).alias("protein_pooled_obs_at_rna1_spots"), F.col("pooled_null_mean").alias("rna2_pooled_null_mean_at_rna1_spots"),
        F.when(F.col("image") != 5, F.col("pooled_null_enrichment")).alias("rna2_pooled_enrichment_vs_null_at_rna1_spots"),
    ).unionByName(spark.createDataFrame([(3, "WT")], "image long, condition string"), allowMissingColumns=True)
    write_tables({"per_image_summary": stored}, run)
    counts = B.backfill(spark, run, **{**SETTINGS, "families": ("position",)})
    assert (counts["passed"], counts["failed"]) == (1, 3)  # 2 is off, 5 and 3 lack numbers
    gate = {r["image"]: r for r in B.backfilled(spark, run, B.GATE).collect()}
    assert gate[1]["passed"] and abs(gate[1]["d_obs"] - (1 - 1 / 1.01)) < 1e-9 and gate[3]["stored_obs"] is None


def test_nucleoli_are_found_again_or_read(spark, whole, tmp_path):
    run = make_run(spark, str(tmp_path), [1])
    holes = spark.createDataFrame([(1, y, x, 1) for y in range(8, 12) for x in range(8, 17)], "image long, y long, x long, nucleolus_id long")
    write_tables({"nucleoli": holes}, run)
    settings = {**SETTINGS, "families": ("position",)}
    B.backfill(spark, run, **{**settings, "exclude_nucleoli": True})
    spared = rows(spark, run, "coloc_null_draws")
    B.backfill(spark, run, **settings)
    assert rows(spark, run, "coloc_null_draws") != spared
    again = make_run(spark, str(tmp_path / "again"), [1])
    B.backfill(spark, again, **{**settings, "exclude_nucleoli": True, "nucleolus": {"min_um2": 0.05, "pct": 30.0}})
    assert len(rows(spark, again, "coloc_null_draws")) == 60
