"""Checks of manifests, plates, channels, stored tables and field statistics."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from checks import views as V
from checks.groups import T_COLS, T_ROUND, welch_sql
from checks.views import oracle
from spotframe.functions import scalars
from spotframe.operators import channels, fov, lookup
from spotframe.session import checkpoint_folder
from spotframe.sources import manifest, tables

QUERIES = {}
ORACLES = {}


def check(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


MAN = """v_man AS (
  SELECT path, CASE WHEN path LIKE '%Folder_ko/%' THEN 'Knockout' WHEN path LIKE '%Folder_sec/%' THEN 'Sec-Only' WHEN path LIKE '%img_1%' THEN 'Batch1' ELSE 'Folder_wt' END AS condition,
         path LIKE '%Folder_sec/%' AS sec_only, split_part(path, '/', 3) AS subfolder FROM v_listing WHERE path LIKE '%.tif' AND path NOT LIKE '%/\\_img%' ESCAPE '\\')"""


def _manifest(spark, sf):
    return manifest.build_manifest(V.listing(spark, sf), ["tif"], {"Folder_ko": "Knockout"}, ["Folder_sec"], None, [("img_1", "Batch1")])


@check(oracle("SELECT * FROM v_man", MAN))
def build_manifest(spark, sf):
    return _manifest(spark, sf)


@check(oracle("SELECT path, length FROM v_listing WHERE length >= 512"))
def reject_small(spark, sf):
    return manifest.reject_small(V.listing(spark, sf))


@check(oracle("SELECT * FROM v_man WHERE path IN (SELECT '/data/Folder_wt/img_' || image || '.tif' FROM v_images WHERE secondary_only = false) OR split_part(path, '/', 4) IN (SELECT 'img_' || image || '.tif' FROM v_images WHERE condition = 'KO')", MAN))
def subset_manifest(spark, sf):
    im = V.images(spark, sf)
    full = im.where("not secondary_only").select(F.concat(F.lit("/data/Folder_wt/img_"), F.col("image").cast("string"), F.lit(".tif")).alias("entry"))
    base = im.where("condition = 'KO'").select(F.concat(F.lit("img_"), F.col("image").cast("string"), F.lit(".tif")).alias("entry"))
    return manifest.subset_manifest(_manifest(spark, sf), full.unionByName(base), "/data/")


@check(oracle("SELECT * FROM v_man WHERE NOT sec_only", MAN))
def pending(spark, sf):
    m = _manifest(spark, sf)
    return manifest.pending(m, m.where("sec_only").select("path"))


@check(oracle("SELECT s_suppkey AS well, '/raw/Well_' || s_suppkey || '/scan_' || (s_suppkey % 97) || '_20250101.vsi' AS path, s_suppkey % 97 AS seq FROM supplier"))
def well_manifest(spark, sf):
    k = F.col("s_suppkey").cast("string")
    path = F.concat(F.lit("/raw/Well_"), k, F.lit("/scan_"), (F.col("s_suppkey") % 97).cast("string"), F.lit("_20250101.vsi"))
    return manifest.well_manifest(V.table(spark, sf, "supplier").select(path.alias("path")))


@check(oracle("SELECT well, genotype, arm, CASE WHEN well = 3 THEN '647' ELSE secondary END AS secondary, CASE WHEN well = 3 OR secondary = '647' THEN '640' ELSE '561' END AS channel FROM v_plate"))
def plate_layout(spark, sf):
    k = F.col("s_suppkey")
    raw = V.table(spark, sf, "supplier").select(
        k.cast("string").alias("Well_Num"), F.when(k % 2 == 0, "wild type").otherwise("line-ko").alias("Line"),
        F.when(k % 5 == 0, "secondary only").otherwise("primary+secondary").alias("Staining_Arm"), F.when(k % 3 == 0, "goat 565").otherwise(" AF647 ").alias("Secondary_Antibody"),
    )
    return manifest.plate_layout(raw, {"647": "640", "568": "561"}, {3: "647"})


@check(oracle("SELECT 'img_' || s_suppkey AS image, (s_suppkey % 5 + 1)::INT AS z_start, (s_suppkey % 5 + 6)::INT AS z_end FROM supplier"))
def focus_windows(spark, sf):
    k = F.col("s_suppkey").cast("string")
    lines = F.array(F.concat(F.lit("focus img_"), k, F.lit(" z 1-2")), F.lit("noise"), F.concat(F.lit("focus img_"), k, F.lit(" z "), (F.col("s_suppkey") % 5 + 1).cast("string"), F.lit("-"), (F.col("s_suppkey") % 5 + 6).cast("string")))
    log = V.table(spark, sf, "supplier").select(k.alias("path"), F.posexplode(lines).alias("line_no", "line"))
    return manifest.focus_windows(log, r"focus (\S+) z (\d+)-(\d+)")


@check(oracle("SELECT f.well, f.fov, f.nucleus_count, p.genotype, p.secondary FROM v_fov f JOIN v_plate p USING (well) WHERE p.arm = 'primary'"))
def join_plate(spark, sf):
    kept, _ = lookup.join_plate(V.fov(spark, sf), V.plate(spark, sf).where("arm = 'primary'"))
    return kept.select("well", "fov", "nucleus_count", "genotype", "secondary")


@check(oracle("SELECT f.well, f.fov FROM v_fov f JOIN v_plate p USING (well) WHERE p.arm <> 'primary'"))
def join_plate_rejected(spark, sf):
    return lookup.join_plate(V.fov(spark, sf), V.plate(spark, sf).where("arm = 'primary'"))[1].select("well", "fov")


@check(oracle("SELECT image, condition, voxel_xy_um, 2.0::DOUBLE AS k_mad FROM v_images"))
def write_and_read_run(spark, sf):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    per_image = tables.threshold_record(V.images(spark, sf).select("image", "condition", "voxel_xy_um"), {"k_mad": 2.0})
    tables.write_tables({"per_image": per_image, "nothing": per_image.where("image < 0"), "absent": None}, folder, {"per_image": ["condition"]})
    return tables.read_run(spark, folder, "per_image", "image long, voxel_xy_um double, k_mad double, condition string")


@check(oracle("SELECT image, channel, spot_id, image || ':' || channel || ':' || spot_id AS global_id FROM v_spots"))
def union_spots(spark, sf):
    s = V.spots(spark, sf).select("image", "channel", "spot_id")
    return tables.union_spots(s.where("channel = 'rna1'").drop("channel"), s.where("channel = 'rna2'").drop("channel")).select("image", "channel", "spot_id", "global_id")


@check(oracle("SELECT image, condition, NULL::INT AS height FROM v_images UNION ALL SELECT image, NULL, height FROM v_images"))
def union_tables(spark, sf):
    im = V.images(spark, sf)
    return tables.union_tables([im.select("image", "condition"), im.select("image", "height")])


@check(oracle("SELECT image, r.role, r.channel FROM v_images, (VALUES ('dapi', 0), ('rna', -1), ('rna2', 2)) r(role, channel)"))
def resolve_channels(spark, sf):
    return channels.resolve_channels(V.images(spark, sf).select("image", F.lit(3).alias("n_channels")), 1, -1, 9, one_indexed=True)


@check(oracle("SELECT image, r.role, CASE r.role WHEN 'antibody' THEN 1 WHEN 'dapi' THEN CASE WHEN image % 2 = 0 THEN 0 ELSE 1 END ELSE CASE WHEN image % 2 = 0 THEN 2 ELSE 0 END END AS channel FROM v_images, (VALUES ('dapi'), ('rna'), ('antibody')) r(role)"))
def autodetect_channels(spark, sf):
    first = F.when(F.col("image") % 2 == 0, "DAPI").otherwise("ch0")
    names = F.array(*[F.struct(F.lit(i).alias("channel"), n.alias("name"), F.lit(m).alias("mean")) for i, (n, m) in enumerate(((first, 10.0), (F.lit("Cy5"), 99.0), (F.lit("misc"), 50.0)))])
    rows = V.images(spark, sf).select("image", F.explode(names).alias("c")).select("image", "c.channel", "c.name", "c.mean")
    return channels.autodetect_channels(rows)


@check(oracle("SELECT channel, sigma, radius FROM (SELECT s_suppkey AS channel, CASE WHEN s_suppkey % 4 = 0 THEN s_acctbal ELSE 1.5 END AS sigma, 3.0::DOUBLE AS radius FROM supplier)"))
def resolve_params(spark, sf):
    rows = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("channel"), F.when(F.col("s_suppkey") % 4 == 0, F.col("s_acctbal")).alias("sigma"))
    return channels.resolve_params({"sigma": 1.5, "radius": 3.0}, rows)


@check(oracle("SELECT s_suppkey AS channel, coalesce(CASE WHEN s_acctbal > 5000 THEN s_acctbal END, CASE WHEN s_nationkey > 0 THEN s_nationkey::DOUBLE END, 7) AS floor FROM supplier"))
def resolve_floor(spark, sf):
    rows = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("channel"), F.when(F.col("s_acctbal") > 5000, F.col("s_acctbal")).alias("pinned"), F.col("s_nationkey").cast("double").alias("forwarded"), F.lit(7.0).alias("manual")
    )
    return channels.resolve_floor(rows)


@check(oracle("SELECT image, CASE channel WHEN 'rna2' THEN 'protein' ELSE channel END AS channel, count(*) AS protein_count FROM v_spots GROUP BY ALL"))
def relabel_channel(spark, sf):
    return channels.relabel_channel(V.spots(spark, sf).groupBy("image", "channel").agg(F.count(F.lit(1)).alias("rna2_count")))


@check(oracle("SELECT image, CASE WHEN secondary_only THEN 2 ELSE 1 END AS z_start, CASE WHEN secondary_only THEN 4 ELSE 5 END AS z_end FROM v_images"))
def z_overrides(spark, sf):
    im = V.images(spark, sf)
    return channels.z_overrides(im.select("image"), im.where("secondary_only").select("image", F.lit(2).alias("z_start"), F.lit(4).alias("z_end")), 1, 5)


@check(oracle("SELECT image, channel, y, x, max(v) AS v FROM v_stack WHERE z BETWEEN 1 AND 3 GROUP BY ALL"))
def select_z(spark, sf):
    return channels.select_z(V.stack_rows(spark, sf), "maxproj", 2, 4)


@check(oracle("SELECT image, channel, y, x, v FROM v_stack WHERE z = 2"))
def select_z_single(spark, sf):
    return channels.select_z(V.stack_rows(spark, sf), "single")


@check(oracle("SELECT image, channel, y, x, round(avg(v), 6) AS v FROM v_stack WHERE z BETWEEN image % 3 AND image % 3 + 2 GROUP BY ALL"))
def lock_z(spark, sf):
    rows = V.stack_rows(spark, sf)
    picked = rows.select("image").distinct().select("image", (F.col("image") % 3).alias("z_start"), (F.col("image") % 3 + 2).alias("z_end"))
    return rounded(channels.lock_z(rows, picked, "mean"), 6, "v")


@check(oracle("""
SELECT image, round(any_value(w.ms), 6) AS mean_signal, round(any_value(w.md), 6) AS mean_dapi, any_value(w.ts) AS total_signal, any_value(w.td) AS total_dapi, round(any_value(w.ms / w.md), 6) AS ratio, count(*) AS nucleus_count,
       round(avg(n.m), 6) AS nuc_mean, round(avg(n.s), 6) AS nuc_integrated, round(avg(c.m), 6) AS cyto_mean, round(avg(n.m / c.m), 6) AS nuc_over_cyto
FROM (SELECT image, avg(v) FILTER (channel = 'rna1') AS ms, avg(v) FILTER (channel = 'dapi') AS md, sum(v) FILTER (channel = 'rna1') AS ts, sum(v) FILTER (channel = 'dapi') AS td FROM v_pixels GROUP BY ALL) w
JOIN (SELECT image, nucleus_id, avg(v) AS m, sum(v) AS s FROM v_labels JOIN v_pixels USING (image, y, x) WHERE channel = 'rna1' GROUP BY ALL) n USING (image)
LEFT JOIN (SELECT image, cyto_id AS nucleus_id, avg(v) AS m FROM v_cyto JOIN v_pixels USING (image, y, x) WHERE channel = 'rna1' GROUP BY ALL) c USING (image, nucleus_id) GROUP BY image"""))
def quantify_fov(spark, sf):
    out, _ = fov.quantify_fov(V.pixel_rows(spark, sf), V.labels(spark, sf), V.cyto(spark, sf), "rna1", "dapi")
    return rounded(out, 6, "mean_signal", "mean_dapi", "ratio", "nuc_mean", "nuc_integrated", "cyto_mean", "nuc_over_cyto")


FIELDS = """v_pf AS (SELECT f.*, p.genotype, p.arm, p.secondary, p.channel, qki_mean / dapi_mean AS ratio FROM v_fov f JOIN v_plate p USING (well)),
v_pool AS (SELECT genotype, channel, avg(qki_mean) AS sq, avg(ratio) AS sr, 4096 * sum(qki_mean) / sum(nucleus_count) AS sb FROM v_pf WHERE arm = 'seconly' GROUP BY ALL),
v_cf AS (SELECT f.*, sq, sr, sb, (qki_mean - sq) * 4096 / nucleus_count AS m1_pn, ratio - sr AS ratio_bgcorr, qki_mean / sq AS fold_qki_mean, ratio / sr AS fold_ratio FROM v_pf f LEFT JOIN v_pool USING (genotype, channel)),
v_w AS (SELECT well, genotype, arm, secondary, channel, count(*) AS n_fov, avg(qki_mean) AS qki_mean, avg(dapi_mean) AS dapi_mean, avg(ratio) AS ratio, avg(nucleus_count) AS nucleus_count, avg(m1_pn) AS m1_pn, avg(ratio_bgcorr) AS ratio_bgcorr, avg(fold_qki_mean) AS fold_qki_mean, avg(fold_ratio) AS fold_ratio FROM v_cf GROUP BY ALL),
v_wf AS (
  SELECT w.*, CASE WHEN arm = 'primary' THEN w.qki_mean / m.q END AS wellfold_qki_mean, CASE WHEN arm = 'primary' THEN w.ratio / m.r END AS wellfold_ratio FROM v_w w
  LEFT JOIN (SELECT genotype, secondary, avg(qki_mean) AS q, avg(ratio) AS r FROM v_w WHERE arm = 'seconly' GROUP BY ALL) m USING (genotype, secondary))"""
FOLD = ["m1_pn", "ratio_bgcorr", "fold_qki_mean", "fold_ratio"]


def _fields(spark, sf):
    return V.fov(spark, sf).join(V.plate(spark, sf), "well").withColumn("ratio", F.col("qki_mean") / F.col("dapi_mean"))


@check(oracle("SELECT well, fov, " + ", ".join(f"round({c}, 5) AS {c}" for c in FOLD) + ", round(sb, 4) AS sec_m1_base FROM v_cf", FIELDS))
def secondary_correct(spark, sf):
    out = fov.secondary_correct(_fields(spark, sf), 4096)[0].select("well", "fov", *FOLD, F.round("sec_m1_base", 4).alias("sec_m1_base"))
    return rounded(out, 5, *FOLD)


@check(oracle("SELECT well, n_fov, round(wellfold_qki_mean, 6) AS wellfold_qki_mean, round(wellfold_ratio, 6) AS wellfold_ratio, round(fold_ratio, 6) AS fold_ratio FROM v_wf", FIELDS))
def well_folds(spark, sf):
    out = fov.secondary_correct(_fields(spark, sf), 4096)[1].select("well", "n_fov", "wellfold_qki_mean", "wellfold_ratio", "fold_ratio")
    return rounded(out, 6, "wellfold_qki_mean", "wellfold_ratio", "fold_ratio")


STATS = """v_rows AS (
  SELECT 'per_secondary_raw' AS analysis, secondary, 'both' AS genotype, metric, genotype AS side, v FROM (UNPIVOT (SELECT secondary, genotype, qki_mean, ratio, m1_pn FROM v_wf WHERE arm = 'primary') ON qki_mean, ratio, m1_pn INTO NAME metric VALUE v)
  UNION ALL SELECT 'primary_vs_seconly', secondary, genotype, metric, CASE WHEN arm = 'primary' THEN 'WT' ELSE 'KO' END, v FROM (UNPIVOT (SELECT secondary, genotype, arm, qki_mean, ratio FROM v_wf) ON qki_mean, ratio INTO NAME metric VALUE v)
  UNION ALL SELECT 'pooled_fold', 'pooled', 'both', metric, genotype, v FROM (UNPIVOT (SELECT genotype, wellfold_qki_mean, wellfold_ratio FROM v_wf WHERE arm = 'primary') ON wellfold_qki_mean, wellfold_ratio INTO NAME metric VALUE v))"""


@check(oracle(f"SELECT analysis, secondary, genotype, metric, n_a, n_b, direction, {T_ROUND} FROM ({welch_sql('v_rows', 'side', 'WT', 'KO', 'v', 'analysis, secondary, genotype, metric')})".replace(", 7)", ", 4)"), FIELDS, STATS))
def plate_stats(spark, sf):
    return rounded(fov.plate_stats(fov.secondary_correct(_fields(spark, sf), 4096)[1], with_p=False), 4, *T_COLS)


@check(oracle("""
SELECT channel, min(e) AS lowest, max(e) AS highest, count(*) AS n_fov, count(DISTINCT e) AS n_exposures, CASE WHEN max(e) - min(e) <= 0.005 THEN 'OK' ELSE 'MISMATCH' END AS status
FROM (SELECT channel, exp_qki_s AS e FROM v_pf UNION ALL SELECT 'dapi(DAPI)', exp_qki_s * 2 FROM v_pf) GROUP BY ALL""", FIELDS))
def exposure_check(spark, sf):
    fields = _fields(spark, sf).withColumn("exp_dapi_s", F.col("exp_qki_s") * 2)
    return fov.exposure_check(fields, 0.005).withColumn("n_exposures", F.size("exposures")).drop("exposures")


@check(oracle("""
SELECT w.well, round(m561, 6) AS mean_561, round(m640, 6) AS mean_640, CASE WHEN m561 >= m640 THEN '561' ELSE '640' END AS higher, '568' AS override,
       (SELECT min(p.well) FROM v_plate p WHERE arm = 'seconly' AND genotype = 'WT' AND p.well <> 3 AND p.channel = CASE WHEN m561 >= m640 THEN '561' ELSE '640' END) AS ref_well, CASE WHEN m561 >= m640 THEN 'consistent' ELSE 'conflicts' END AS verdict
FROM (SELECT well, avg(qki_mean) AS m561, avg(dapi_mean * 2000) AS m640 FROM v_fov WHERE well = 3 GROUP BY ALL) w"""))
def conflict_check(spark, sf):
    means = V.fov(spark, sf).select("well", F.col("qki_mean").alias("mean_561"), (F.col("dapi_mean") * 2000).alias("mean_640"))
    out = fov.conflict_check(means, V.plate(spark, sf), ["561", "640"], {3: "568"}, {"647": "640", "568": "561"})
    return rounded(out, 6, "mean_561", "mean_640")


@check(oracle("""
SELECT image, 'NT_ASO_' || image AS label, '0p' || rtrim(lpad((image % 9 + 1)::VARCHAR, 1, '0'), '0') || 'um' AS suffix, 'NT' AS grp, 'w' || image AS rep, TRUE AS control, CASE WHEN image % 3 = 0 THEN 'Sec' ELSE 'WT' END AS coarse,
       CASE WHEN image % 4 = 0 THEN '***' WHEN image % 4 = 1 THEN '**' WHEN image % 4 = 2 THEN '*' ELSE 'ns' END AS stars, 'Probe spots per nucleus' AS pretty, image * 0.13::DOUBLE AS um FROM v_images"""))
def label_functions(spark, sf):
    i = F.col("image")
    text = i.cast("string")
    group, rep = scalars.split_replicate(F.concat(F.lit("NT_w"), text), i)
    p = F.element_at(F.array(F.lit(0.0005), F.lit(0.005), F.lit(0.03), F.lit(0.5)), (i % 4 + 1).cast("int"))
    return V.images(spark, sf).select(
        "image", scalars.safe_label(F.concat(F.lit(' NT "ASO"-'), text, F.lit("?."))).alias("label"), scalars.pair_suffix_column((i % 9 + 1) / 10.0).alias("suffix"), group.alias("grp"), rep.alias("rep"),
        scalars.is_control(F.lit("scramble 2")).alias("control"), scalars.coarse_group(F.when(i % 3 == 0, "my-secondary").otherwise("WT_a-b")).alias("coarse"), scalars.stars(p).alias("stars"),
        scalars.prettify(F.lit("rna1 spots_per_nucleus"), {"rna1": "probe"}).alias("pretty"), scalars.px_to_um(i, F.lit(0.13)).alias("um"),
    )


def _written(spark, df, keys):
    """df (keys, value) as text files in folders named by the keys; the folder."""
    folder = f"{checkpoint_folder(spark)}/files-{uuid.uuid4().hex}"
    df.write.partitionBy(*keys).text(folder)
    return folder


@check(oracle("SELECT 'nation=' || s_nationkey AS folder, sum(strlen(s_name) + 1) AS bytes, 'nation=3' = 'nation=' || s_nationkey AS sec_only FROM supplier GROUP BY ALL"))
def manifest_of_files(spark, sf):
    """A written tree of files, listed through Spark's file source."""
    folder = _written(spark, V.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("value")), ["nation"])
    found = manifest.list_files(spark, folder)
    kept = manifest.build_manifest(found, ["txt"], secondary_folders=["nation=3"]).join(found, "path")
    return kept.groupBy(F.col("subfolder").alias("folder"), "sec_only").agg(F.sum("length").alias("bytes"))


@check(oracle("SELECT 'img_' || s_suppkey AS image, (s_suppkey % 5 + 1)::INT AS z_start, (s_suppkey % 5 + 6)::INT AS z_end FROM supplier"))
def focus_windows_of_files(spark, sf):
    """Windows from log files, of which each image has one with an earlier line that does not count."""
    k = F.col("s_suppkey")
    text = F.concat(F.lit("start\r\nfocus img_"), k.cast("string"), F.lit(" z 1-2\nfocus img_"), k.cast("string"), F.lit(" z "), (k % 5 + 1).cast("string"), F.lit("-"), (k % 5 + 6).cast("string"), F.lit("\nend"))
    logs = V.table(spark, sf, "supplier").repartition(8, "s_suppkey").select((k % 7).alias("well"), text.alias("value"))
    return manifest.focus_windows(manifest.read_log(spark, _written(spark, logs, ["well"])), r"focus (\S+) z (\d+)-(\d+)")
