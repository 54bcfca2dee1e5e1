"""Checks of whole runs: stored tables, and what a backfill adds to them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import spatial as S, views as V
from checks.groups import T_COLS, T_ROUND, welch_sql
from checks.views import oracle
from spotframe.functions.stencils import disk
from spotframe.operators import nulls
from spotframe.operators.frames import pixels_in, stencil_mean_rows
from spotframe.plans import backfill, plate_run as plate_plan
from spotframe.plans.modes import run_mode
from spotframe.session import checkpoint_folder, co_partitioned, cut_lineage
from spotframe.sources.tables import write_tables

QUERIES = {}
ORACLES = {}


def check(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


rounded = S.rounded


def _stored_run(spark, sf) -> str:
    """A finished run below the shared folder: spots, masks, nucleoli, pixels and the pooled numbers of its images.

    The pooled null mean it states is the expectation, the mean over all pixels that a draw may hit; every tenth
    image states numbers that are off by a twentieth.
    """
    run = f"{checkpoint_folder(spark)}/runs/{uuid.uuid4().hex}"
    spots, plane, _, _ = S._inputs(spark, sf)
    labels, holes = V.labels(spark, sf), V.nucleoli(spark, sf)
    spots = cut_lineage(spots)
    means = cut_lineage(stencil_mean_rows(plane, disk(3.0)))
    expected = pixels_in(means, nulls.sampling_region(labels, holes)).groupBy(*S.KEY).agg(F.avg("v").alias("e"))
    w = F.col("n_spots")
    pooled = nulls._observed(nulls.observed_spots(spots, plane, holes), means).join(expected, S.KEY).groupBy("image").agg((F.sum(w * F.col("obs")) / F.sum(w)).alias("o"), (F.sum(w * F.col("e")) / F.sum(w)).alias("e"))
    off = F.when(F.col("image") % 10 == 0, 1.05).otherwise(1.001)
    per_image = V.images(spark, sf).select("image", "condition").join(
        pooled.select("image", (F.col("o") * off).alias("protein_pooled_obs_at_rna1_spots"), F.col("e").alias("rna2_pooled_null_mean_at_rna1_spots"), (F.col("o") / F.col("e")).alias("protein_pooled_enrichment_vs_null_at_rna1_spots")),
        "image", "left",
    )
    write_tables({"spot_metrics": spots, "labels": labels, "nucleoli": holes, "plane_rows": V.pixel_rows(spark, sf), "per_image_summary": per_image}, run)
    return run


def _backfilled(spark, sf, table, **settings):
    with co_partitioned(spark):
        run = _stored_run(spark, sf)
    backfill.backfill(spark, run, seed=0, shards=16, **settings)
    return backfill.backfilled(spark, run, table)


COND = "JOIN (SELECT image, condition FROM v_images) USING (image)"


@check(oracle(f"""
SELECT image, condition, 'ok' AS status, round(obs, 6) AS obs, round(ln(null_mean), 9) AS log_null_mean, round(obs / null_mean, 6) AS enrichment, round(obs * CASE WHEN image % 10 = 0 THEN 1.05 ELSE 1.001 END::DOUBLE, 5) AS stored_obs, round(e, 6) AS stored_null_mean, image % 10 <> 0 AS passed FROM (
  SELECT image, any_value(o.obs) AS obs, avg(value) AS null_mean FROM v_id JOIN v_io o USING (image) GROUP BY ALL)
JOIN (SELECT image, sum(n_spots * e) / sum(n_spots) AS e FROM v_on JOIN (SELECT image, nucleus_id, avg(v) AS e FROM v_px GROUP BY ALL) USING (image, nucleus_id) GROUP BY ALL) USING (image) {COND}""", S.BASE, S.position_sql(0), S.POOLED))
def backfill_run_gate(spark, sf):
    out = _backfilled(spark, sf, backfill.GATE, families=("position",))
    out = out.withColumn("log_null_mean", F.round(F.log("null_mean"), 9)).select("image", "condition", "status", "obs", "log_null_mean", "enrichment", "stored_obs", "stored_null_mean", "passed")
    return rounded(rounded(out, 6, "obs", "enrichment", "stored_null_mean"), 5, "stored_obs")


@check(oracle(f"SELECT image, condition, iter - 1 AS iter, round(value, 6) AS pooled_null_value, round(obs, 6) AS pooled_obs FROM v_id JOIN v_io USING (image) {COND}", S.BASE, S.position_sql(0), S.POOLED))
def backfill_null_draws(spark, sf):
    return rounded(_backfilled(spark, sf, "coloc_null_draws", families=("position",)), 6, "pooled_null_value", "pooled_obs")


@check(oracle(f"""
SELECT image, condition, ring_um, n_spots, round(obs_mean, 6) AS obs_mean, round(null_mean, 6) AS null_mean, round(null_sd, 6) AS null_sd, round(obs_mean / null_mean, 6) AS enrichment, round((obs_mean - null_mean) / null_sd, 5) AS z FROM (
  SELECT image, ring_um, sum(n_spots) AS n_spots, sum(n_spots * obs_mean) / sum(n_spots) AS obs_mean, sum(n_spots * null_mean) / sum(n_spots) AS null_mean, sum(n_spots * null_sd) / sum(n_spots) AS null_sd FROM v_rad GROUP BY ALL) {COND}""", S.BASE, S.RINGS, S.RADIAL))
def backfill_radial_profile(spark, sf):
    out = _backfilled(spark, sf, "coloc_radial_profile", families=("radial",), bins_um=S.BINS_UM)
    return rounded(rounded(out, 5, "z"), 6, "obs_mean", "null_mean", "null_sd", "enrichment")


ROT = """v_use AS (SELECT image, nucleus_id FROM v_rot GROUP BY ALL HAVING median(retention) >= 0.5 AND count(value) >= 2),
v_ri AS (SELECT image, sum(n_spots * obs) / sum(n_spots) AS obs, count(*) AS n_nuclei_used FROM v_on SEMI JOIN v_use USING (image, nucleus_id) GROUP BY ALL),
v_rv AS (SELECT image, iter, sum(n_spots * value) / sum(n_spots) AS value FROM v_rot SEMI JOIN v_use USING (image, nucleus_id) GROUP BY ALL)"""


@check(oracle(f"""
SELECT image, condition, round(any_value(obs), 6) AS pooled_obs, round(ln(avg(value)), 9) AS log_mean, round(stddev_samp(value), 6) AS pooled_rotation_null_sd, round(any_value(obs) / avg(value), 6) AS pooled_rotation_enrichment,
  round((any_value(obs) - avg(value)) / stddev_samp(value), 4) AS pooled_rotation_null_z, any_value(n_nuclei_used) AS n_nuclei_used FROM v_rv JOIN v_ri USING (image) {COND} GROUP BY image, condition""", S.BASE, S.rotation_sql(), ROT))
def backfill_rotation_summary(spark, sf):
    out = _backfilled(spark, sf, "coloc_rotation_null_summary", families=("rotation",), n=S.NR)
    out = out.withColumn("log_mean", F.round(F.log("pooled_rotation_null_mean"), 9)).drop("pooled_rotation_null_mean", "pooled_rotation_p_empirical")
    return rounded(rounded(out, 6, "pooled_obs", "pooled_rotation_null_sd", "pooled_rotation_enrichment"), 4, "pooled_rotation_null_z")


# ---- plate run -------------------------------------------------------------------------------------
# three images make a well; wells 6, 12, 18 ... are not on the plate

WELL = "(image - 1) div 3"
PLATE = """v_files AS (SELECT image, (image - 1) // 3 AS well, 'f' || image || '.vsi' AS file, (image % 3)::INT AS fov_seq FROM v_images),
v_pl AS (
  SELECT well, CASE WHEN well % 2 = 0 THEN 'WT' ELSE 'KO' END AS genotype, CASE WHEN well // 4 % 3 = 0 THEN 'seconly' ELSE 'primary' END AS arm,
    CASE WHEN well // 2 % 2 = 0 THEN '568' ELSE '647' END AS secondary, CASE WHEN well // 2 % 2 = 0 THEN 'rna1' ELSE 'rna2' END AS qki_channel FROM (SELECT DISTINCT well FROM v_files WHERE well % 6 <> 5)),
v_ff AS (SELECT f.image, f.well, genotype, arm, secondary, qki_channel, file, fov_seq FROM v_files f JOIN v_pl USING (well)),
v_mn AS (SELECT image, avg(v) FILTER (channel = 'rna1') AS mean_rna1, avg(v) FILTER (channel = 'rna2') AS mean_rna2, avg(v) FILTER (channel = 'dapi') AS mean_dapi, sum(v) FILTER (channel = 'dapi') AS total_dapi FROM v_pixels GROUP BY ALL),
v_sg AS (SELECT f.image, avg(v) AS qki_mean, sum(v) AS total_qki FROM v_ff f JOIN v_pixels p ON p.image = f.image AND p.channel = f.qki_channel GROUP BY ALL),
v_nu AS MATERIALIZED (
  SELECT n.image, n.nucleus_id AS nucleus_label, area_px, m AS nuc_mean_qki, s AS nuc_integrated_qki, c AS cyto_mean_qki, m / c AS nuc_over_cyto
  FROM (SELECT l.image, nucleus_id, count(*) AS area_px, avg(v) AS m, sum(v) AS s FROM v_ff f JOIN v_labels l USING (image) JOIN v_pixels p ON p.image = f.image AND p.channel = f.qki_channel AND p.y = l.y AND p.x = l.x GROUP BY ALL) n
  LEFT JOIN (SELECT l.image, cyto_id AS nucleus_id, avg(v) AS c FROM v_ff f JOIN v_cyto l USING (image) JOIN v_pixels p ON p.image = f.image AND p.channel = f.qki_channel AND p.y = l.y AND p.x = l.x GROUP BY ALL) r USING (image, nucleus_id)),
v_fd AS MATERIALIZED (
  SELECT f.*, qki_mean, mean_dapi AS dapi_mean, total_qki, total_dapi, qki_mean / mean_dapi AS ratio_qki_over_dapi, mean_rna1, mean_rna2, mean_dapi, nucleus_count, nuc_mean_qki, nuc_integrated_qki, cyto_mean_qki, nuc_over_cyto,
    0.1::DOUBLE + f.well % 2 * 0.05::DOUBLE AS exp_qki_s, 0.2::DOUBLE AS exp_dapi_s FROM v_ff f JOIN v_mn USING (image) JOIN v_sg USING (image)
  JOIN (SELECT image, count(*) AS nucleus_count, avg(nuc_mean_qki) AS nuc_mean_qki, avg(nuc_integrated_qki) AS nuc_integrated_qki, avg(cyto_mean_qki) AS cyto_mean_qki, avg(nuc_over_cyto) AS nuc_over_cyto FROM v_nu GROUP BY ALL) USING (image)),
v_so AS (SELECT genotype, qki_channel, avg(qki_mean) AS q, avg(ratio_qki_over_dapi) AS r, avg(nuc_mean_qki) AS nm, 4096 * sum(qki_mean) / sum(nucleus_count) AS m1_base, count(*) AS n_fov FROM v_fd WHERE arm = 'seconly' GROUP BY ALL),
v_pf AS MATERIALIZED (
  SELECT f.*, q AS sec_qki_mean_pooled, r AS sec_ratio_pooled, nm AS sec_nuc_mean_pooled, m1_base AS sec_m1_base, (qki_mean - q) * 4096 / nucleus_count AS M1_pn, ratio_qki_over_dapi - r AS ratio_bgcorr, nuc_mean_qki - nm AS nuc_mean_bgcorr,
    qki_mean / q AS fold_qki_mean, ratio_qki_over_dapi / r AS fold_ratio, nuc_mean_qki / nm AS fold_nuc_mean FROM v_fd f LEFT JOIN v_so USING (genotype, qki_channel))"""
METRICS = plate_plan.WELL_METRICS
WELLS = f"""v_pw0 AS (SELECT well, genotype, arm, secondary, qki_channel, count(*) AS n_fov, {', '.join(f'avg({m}) AS {m}' for m in METRICS)} FROM v_pf GROUP BY ALL),
v_pw AS MATERIALIZED (
  SELECT w.*, CASE WHEN arm = 'primary' THEN w.nuc_mean_qki / m.a END AS wellfold_nuc_mean, CASE WHEN arm = 'primary' THEN w.ratio_qki_over_dapi / m.b END AS wellfold_ratio, CASE WHEN arm = 'primary' THEN w.qki_mean / m.c END AS wellfold_qki_mean FROM v_pw0 w
  LEFT JOIN (SELECT genotype, secondary, avg(nuc_mean_qki) AS a, avg(ratio_qki_over_dapi) AS b, avg(qki_mean) AS c FROM v_pw0 WHERE arm = 'seconly' GROUP BY ALL) m USING (genotype, secondary))"""
FOV_NUMBERS = [
    "qki_mean", "dapi_mean", "total_qki", "total_dapi", "ratio_qki_over_dapi", "mean_rna1", "mean_rna2", "exp_qki_s", "nuc_mean_qki", "nuc_integrated_qki", "cyto_mean_qki", "nuc_over_cyto", "sec_qki_mean_pooled", "sec_m1_base",
    "M1_pn", "ratio_bgcorr", "nuc_mean_bgcorr", "fold_qki_mean", "fold_ratio", "fold_nuc_mean",
]


def r4(columns) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in columns)


def _plate_run(spark, sf, table, **more):
    image = V.images(spark, sf).select("image")
    files = image.select("image", F.expr(WELL).alias("well"), F.concat(F.lit("f"), F.col("image").cast("string"), F.lit(".vsi")).alias("file"), (F.col("image") % 3).cast("int").alias("fov_seq"))
    w = F.col("well")
    plate = files.select("well").where(w % 6 != 5).distinct().select(
        "well", F.when(w % 2 == 0, "WT").otherwise("KO").alias("genotype"), F.expr("if((well div 4) % 3 = 0, 'seconly', 'primary')").alias("arm"),
        F.expr("if((well div 2) % 2 = 0, '568', '647')").alias("secondary"), F.expr("if((well div 2) % 2 = 0, 'rna1', 'rna2')").alias("channel"),
    )
    shot = F.when(F.col("channel") == "dapi", 0.2).otherwise(0.1 + F.expr(WELL) % 2 * 0.05)
    exposures = image.select("image", F.explode(F.array(*[F.lit(c) for c in ("dapi", "rna1", "rna2")])).alias("channel")).withColumn("exposure", shot)
    inputs = {"files": files, "plate": plate, "plane_rows": V.pixel_rows(spark, sf), "labels": V.label_rows(spark, sf), "ring": V.cyto_rows(spark, sf), "exposures": exposures}
    return run_mode("if_intensity", inputs, channel_map={"568": "rna1", "647": "rna2"}, with_p=False, **more)[table]


@check(oracle(f"SELECT well, genotype, arm, secondary, qki_channel, file, fov_seq, nucleus_label, area_px, {r4(['nuc_mean_qki', 'nuc_integrated_qki', 'cyto_mean_qki', 'nuc_over_cyto'])} FROM v_ff JOIN v_nu USING (image)", PLATE))
def plate_run_per_nucleus(spark, sf):
    return rounded(_plate_run(spark, sf, "per_nucleus"), 4, "nuc_mean_qki", "nuc_integrated_qki", "cyto_mean_qki", "nuc_over_cyto")


@check(oracle(f"SELECT well, genotype, arm, secondary, qki_channel, file, fov_seq, nucleus_count, {r4(FOV_NUMBERS)} FROM v_pf", PLATE))
def plate_run_per_fov(spark, sf):
    out = _plate_run(spark, sf, "per_fov").select("well", "genotype", "arm", "secondary", "qki_channel", "file", "fov_seq", "nucleus_count", *FOV_NUMBERS)
    return rounded(out, 4, *FOV_NUMBERS)


@check(oracle(f"SELECT well, genotype, arm, secondary, qki_channel, n_fov, {r4([*METRICS, 'wellfold_nuc_mean', 'wellfold_ratio', 'wellfold_qki_mean'])} FROM v_pw", PLATE, WELLS))
def plate_run_per_well(spark, sf):
    out = _plate_run(spark, sf, "per_well")
    return rounded(out, 4, *METRICS, "wellfold_nuc_mean", "wellfold_ratio", "wellfold_qki_mean")


TESTED = """v_t AS (
  SELECT 'per_secondary_raw' AS analysis, secondary, 'both' AS genotype, metric, genotype AS side, v FROM (UNPIVOT (SELECT secondary, genotype, nuc_mean_qki, ratio_qki_over_dapi, M1_pn, nuc_integrated_qki FROM v_pw WHERE arm = 'primary') ON nuc_mean_qki, ratio_qki_over_dapi, M1_pn, nuc_integrated_qki INTO NAME metric VALUE v)
  UNION ALL SELECT 'primary_vs_seconly', secondary, genotype, metric, CASE WHEN arm = 'primary' THEN 'WT' ELSE 'KO' END, v FROM (UNPIVOT (SELECT secondary, genotype, arm, nuc_mean_qki, ratio_qki_over_dapi FROM v_pw WHERE secondary IN (SELECT secondary FROM v_pl WHERE arm = 'primary')) ON nuc_mean_qki, ratio_qki_over_dapi INTO NAME metric VALUE v)
  UNION ALL SELECT 'pooled_fold_n3', 'pooled', 'both', metric, genotype, v FROM (UNPIVOT (SELECT genotype, wellfold_nuc_mean, wellfold_ratio, wellfold_qki_mean FROM v_pw WHERE arm = 'primary') ON wellfold_nuc_mean, wellfold_ratio, wellfold_qki_mean INTO NAME metric VALUE v)),
v_fl AS (SELECT secondary, metric, avg(v) FILTER (genotype = 'WT') AS fw, avg(v) FILTER (genotype = 'KO') AS fk FROM (UNPIVOT (SELECT secondary, genotype, nuc_mean_qki, ratio_qki_over_dapi, M1_pn, nuc_integrated_qki FROM v_pw WHERE arm = 'seconly') ON nuc_mean_qki, ratio_qki_over_dapi, M1_pn, nuc_integrated_qki INTO NAME metric VALUE v) GROUP BY ALL)"""


@check(oracle(f"""
SELECT t.analysis, t.secondary, t.genotype, t.metric, n_a, n_b, direction, {T_ROUND}, CASE WHEN t.analysis = 'per_secondary_raw' THEN round(fw, 3) END AS floor_WT, CASE WHEN t.analysis = 'per_secondary_raw' THEN round(fk, 3) END AS floor_KO,
  CASE t.analysis WHEN 'per_secondary_raw' THEN 'WT_primary' WHEN 'primary_vs_seconly' THEN t.genotype || '_primary' ELSE 'WT_primary(' || (SELECT string_agg(well, ',' ORDER BY well) FROM v_pl WHERE arm = 'primary' AND genotype = 'WT') || ')' END AS group_A
FROM ({welch_sql('v_t', 'side', 'WT', 'KO', 'v', 'analysis, secondary, genotype, metric')}) t LEFT JOIN v_fl f ON f.secondary = t.secondary AND f.metric = t.metric""".replace(", 7)", ", 3)"), PLATE, WELLS, TESTED))
def plate_run_stats(spark, sf):
    out = _plate_run(spark, sf, "stats").select("analysis", "secondary", "genotype", "metric", "n_a", "n_b", "direction", *T_COLS, "floor_WT", "floor_KO", "group_A")
    return rounded(out, 3, *T_COLS, "floor_WT", "floor_KO")


@check(oracle("SELECT channel, min(e) AS lowest, max(e) AS highest, count(*) AS n_fov, CASE WHEN max(e) - min(e) <= 0.01 THEN 'OK' ELSE 'MISMATCH' END AS status FROM (SELECT qki_channel AS channel, exp_qki_s AS e FROM v_pf UNION ALL SELECT 'dapi(DAPI)', exp_dapi_s FROM v_pf) GROUP BY ALL", PLATE))
def plate_run_exposure(spark, sf):
    return _plate_run(spark, sf, "exposure", exposure_tol=0.01).drop("exposures")


@check(oracle("SELECT genotype, qki_channel, round(q, 5) AS qki_mean, round(r, 6) AS ratio, round(nm, 5) AS nuc_mean, round(m1_base, 3) AS m1_base, n_fov FROM v_so", PLATE))
def plate_run_seconly(spark, sf):
    return rounded(rounded(rounded(_plate_run(spark, sf, "seconly"), 5, "qki_mean", "nuc_mean"), 6, "ratio"), 3, "m1_base")


@check(oracle("""
SELECT well, round(a, 5) AS mean_rna1, round(b, 5) AS mean_rna2, CASE WHEN a >= b THEN 'rna1' ELSE 'rna2' END AS higher, CASE well WHEN 1 THEN '568' ELSE '647' END AS override,
  CASE WHEN (CASE WHEN a >= b THEN '568' ELSE '647' END) = CASE well WHEN 1 THEN '568' ELSE '647' END THEN 'consistent' ELSE 'conflicts' END AS verdict FROM (SELECT well, avg(mean_rna1) AS a, avg(mean_rna2) AS b FROM v_fd WHERE well IN (1, 2) GROUP BY ALL)""", PLATE))
def plate_run_conflict(spark, sf):
    return rounded(_plate_run(spark, sf, "conflict", overrides={1: "568", 2: "647"}).drop("ref_well"), 5, "mean_rna1", "mean_rna2")


@check(oracle("SELECT file AS image, genotype || ' ' || arm || ' ' || secondary AS condition, arm = 'seconly' AS secondary_only, nucleus_count AS nuclei_analyzed, round(216.7::DOUBLE, 4) AS voxel_xy_nm, 1 AS n_z, well, round(nuc_mean_qki, 5) AS nuc_mean_qki FROM v_pf", PLATE))
def plate_run_image_summary(spark, sf):
    return rounded(_plate_run(spark, sf, "per_image_summary").select("image", "condition", "secondary_only", "nuclei_analyzed", "voxel_xy_nm", "n_z", "well", "nuc_mean_qki"), 5, "nuc_mean_qki")


@check(oracle("SELECT file AS image, genotype || ' ' || arm || ' ' || secondary AS condition, arm = 'seconly' AS secondary_only, nucleus_label AS nucleus_id, area_px AS nucleus_area_px, round(nuc_over_cyto, 6) AS nuc_over_cyto FROM v_ff JOIN v_nu USING (image)", PLATE))
def plate_run_nuclei_metrics(spark, sf):
    return rounded(_plate_run(spark, sf, "nuclei_metrics").select("image", "condition", "secondary_only", "nucleus_id", "nucleus_area_px", "nuc_over_cyto"), 6, "nuc_over_cyto")


@check(oracle("SELECT image, well, file, 'not on the plate' AS reason FROM v_files WHERE well % 6 = 5", PLATE))
def plate_run_rejected(spark, sf):
    return _plate_run(spark, sf, "rejected")
