"""Checks of pixel statistics: colocalization, thresholds, ranges, quality flags, pixel patterns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks import views as V
from checks.views import oracle
from spotframe.operators import coloc, depth, intensity, pixelpattern, ranges, thresholds
from spotframe.operators.frames import flat, pair_pixels_in, pixels_in
from spotframe.session import cut_lineage

QUERIES = {}
ORACLES = {}
KEY = ["image", "nucleus_id"]


def check(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _pairs(spark, sf):
    return pair_pixels_in(V.pixel_rows(spark, sf), "rna1", "rna2", V.labels(spark, sf))


PAIR = """v_pair AS (
  SELECT l.image, l.nucleus_id, l.y, l.x, p.v AS a, q.v AS b FROM v_labels l JOIN v_pixels p ON p.image = l.image AND p.y = l.y AND p.x = l.x AND p.channel = 'rna1'
  JOIN v_pixels q ON q.image = l.image AND q.y = l.y AND q.x = l.x AND q.channel = 'rna2')"""
COLOC = ["pearson_r", "cosine_overlap", "li_icq", "manders_m1", "manders_m2", "jaccard", "dice", "both_frac", "a_frac_above", "b_frac_above",
         "b_enrich_in_a_high", "a_enrich_in_b_high", "min_frac_a", "min_frac_b", "a_mean", "b_mean"]


@check(oracle("""
SELECT image, nucleus_id, count(*) AS n_pix, 1500.0 AS thr_a, 1400.0 AS thr_b, round(corr(a, b), 7) AS pearson_r, round(sum(a * b) / sqrt(sum(a * a) * sum(b * b)), 7) AS cosine_overlap,
       round(avg(((a - ma) * (b - mb) > 0)::INT) - 0.5, 7) AS li_icq, round(sum(a) FILTER (b >= 1400) / sum(a), 7) AS manders_m1, round(sum(b) FILTER (a >= 1500) / sum(b), 7) AS manders_m2,
       round(count(*) FILTER (a >= 1500 AND b >= 1400) / count(*) FILTER (a >= 1500 OR b >= 1400), 7) AS jaccard,
       round(2 * count(*) FILTER (a >= 1500 AND b >= 1400) / (count(*) FILTER (a >= 1500) + count(*) FILTER (b >= 1400)), 7) AS dice,
       round(count(*) FILTER (a >= 1500 AND b >= 1400) / count(*), 7) AS both_frac, round(count(*) FILTER (a >= 1500) / count(*), 7) AS a_frac_above, round(count(*) FILTER (b >= 1400) / count(*), 7) AS b_frac_above,
       round(avg(b) FILTER (a >= 1500) / avg(b) FILTER (a < 1500), 7) AS b_enrich_in_a_high, round(avg(a) FILTER (b >= 1400) / avg(a) FILTER (b < 1400), 7) AS a_enrich_in_b_high,
       round(sum(least(a, b)) / sum(a), 7) AS min_frac_a, round(sum(least(a, b)) / sum(b), 7) AS min_frac_b, round(avg(a), 7) AS a_mean, round(avg(b), 7) AS b_mean,
       sum(a) AS sum_a, sum(b) AS sum_b, sum(a * b) AS sum_product, sum(least(a, b)) AS sum_min
FROM v_pair JOIN (SELECT image, nucleus_id, avg(a) AS ma, avg(b) AS mb FROM v_pair GROUP BY ALL) USING (image, nucleus_id) GROUP BY image, nucleus_id""", PAIR))
def coloc_metrics(spark, sf):
    thr = V.images(spark, sf).select("image", F.lit(1500.0).alias("thr_a"), F.lit(1400.0).alias("thr_b"))
    return rounded(coloc.coloc_metrics(_pairs(spark, sf), thr, KEY, ["image"]), 7, *COLOC)


@check(oracle("""
SELECT image, nucleus_id, round(corr(rx, ry), 7) AS rho FROM (
  SELECT image, nucleus_id, rank() OVER (PARTITION BY image, nucleus_id ORDER BY a) + (count(*) OVER (PARTITION BY image, nucleus_id, a) - 1) / 2.0::DOUBLE AS rx,
         rank() OVER (PARTITION BY image, nucleus_id ORDER BY b) + (count(*) OVER (PARTITION BY image, nucleus_id, b) - 1) / 2.0::DOUBLE AS ry FROM v_pair) GROUP BY ALL""", PAIR))
def spearman_by(spark, sf):
    return rounded(coloc.spearman_by(_pairs(spark, sf), "a", "b", KEY), 7, "rho")


BOTH = "v_both AS (SELECT image, nucleus_id, 'a' AS channel, a AS v FROM v_pair UNION ALL SELECT image, nucleus_id, 'b', b FROM v_pair)"
MAD = """v_med AS (SELECT image, nucleus_id, channel, median(v) AS med FROM v_both GROUP BY ALL),
v_mad AS (SELECT image, nucleus_id, channel, med, median(abs(v - med)) AS mad FROM v_both JOIN v_med USING (image, nucleus_id, channel) GROUP BY ALL)"""


def _both(spark, sf):
    """Pixel values of both channels, one below the other."""
    cells = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("v")) for c in "ab"])
    return _pairs(spark, sf).select(*KEY, F.explode(cells).alias("_c")).select(*KEY, "_c.channel", "_c.v")


@check(oracle("SELECT image, nucleus_id, channel, CASE WHEN mad <= 0 THEN med ELSE med + 2 * mad END AS thr FROM v_mad", PAIR, BOTH, MAD))
def mad_threshold(spark, sf):
    return thresholds.mad_threshold(_both(spark, sf), "v", [*KEY, "channel"])


@check(oracle("""
SELECT image, nucleus_id, channel, v AS thr FROM (SELECT image, nucleus_id, channel, v, row_number() OVER (PARTITION BY image, nucleus_id, channel ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY image, nucleus_id, channel) AS n FROM v_both)
WHERE i = round_even(0.8::DOUBLE * (n - 1), 0)""", PAIR, BOTH))
def fiji_percentile(spark, sf):
    return thresholds.fiji_percentile(_both(spark, sf), "v", [*KEY, "channel"])


OTSU = """v_span AS (SELECT image, channel, z, min(v) AS lo, max(v) AS hi FROM v_stack GROUP BY ALL),
v_hist AS (SELECT image, channel, z, least(255, floor((v - lo) / ((hi - lo) / 256)))::INT AS slot, lo, hi, count(*) AS c FROM v_stack JOIN v_span USING (image, channel, z) GROUP BY ALL),
v_cum AS (
  SELECT *, lo + (slot + 0.5::DOUBLE) * ((hi - lo) / 256) AS centre, sum(c) OVER w AS w1, sum(c * (lo + (slot + 0.5::DOUBLE) * ((hi - lo) / 256))) OVER w AS m1,
         sum(c) OVER r AS w2, sum(c * (lo + (slot + 0.5::DOUBLE) * ((hi - lo) / 256))) OVER r AS m2
  FROM v_hist WINDOW w AS (PARTITION BY image, channel, z ORDER BY slot), r AS (PARTITION BY image, channel, z ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
v_otsu AS (
  SELECT image, channel, z, centre AS thr FROM (
    SELECT *, row_number() OVER (PARTITION BY image, channel, z ORDER BY round(w1::DOUBLE * w2 * pow(m1 / w1 - m2 / w2, 2), 6) DESC, slot) AS rn FROM v_cum WHERE w2 > 0) WHERE rn = 1)"""


@check(oracle("SELECT image, channel, z, round(thr, 6) AS thr FROM v_otsu", OTSU))
def otsu(spark, sf):
    return rounded(thresholds.otsu(V.stack(spark, sf), "v", ["image", "channel", "z"]), 6, "thr")


COSTES = """v_cm AS (SELECT image, avg(a) AS ma, avg(b) AS mb FROM v_pair GROUP BY ALL),
v_line AS (SELECT image, sum((a - ma) * (b - mb)) / sum((a - ma) * (a - ma)) AS slope, any_value(ma) AS ma, any_value(mb) AS mb FROM v_pair JOIN v_cm USING (image) GROUP BY ALL),
v_cand AS (
  SELECT image, a AS t FROM (SELECT image, a, row_number() OVER (PARTITION BY image ORDER BY a DESC) - 1 AS i, count(*) OVER (PARTITION BY image) AS n FROM (SELECT DISTINCT image, a FROM v_pair))
  WHERE i % greatest(1, n // 256) = 0),
v_scan AS (
  SELECT c.image, c.t, any_value(slope) * c.t + any_value(mb - slope * ma) AS u, count(*) AS n, covar_pop(a, b) AS vab, var_pop(a) AS vaa, var_pop(b) AS vbb
  FROM v_cand c JOIN v_line l USING (image) JOIN v_pair p ON p.image = c.image AND p.a < c.t AND p.b < l.slope * c.t + (l.mb - l.slope * l.ma) GROUP BY c.image, c.t),
v_hit AS (SELECT image, max(t) AS t, max_by(greatest(0, u), t) AS u FROM v_scan WHERE n >= 10 AND vaa > 1e-9 AND vbb > 1e-9 AND vab <= 0 GROUP BY ALL),
v_m AS (SELECT image, median(a) AS am, median(b) AS bm FROM v_pair GROUP BY ALL),
v_fb AS (SELECT image, any_value(am) + 2 * 1.4826 * median(abs(a - am)) AS fa, any_value(bm) + 2 * 1.4826 * median(abs(b - bm)) AS fb FROM v_pair JOIN v_m USING (image) GROUP BY ALL)"""


@check(oracle("SELECT l.image, round(coalesce(h.t, f.fa), 5) AS thr_a, round(coalesce(h.u, f.fb), 5) AS thr_b FROM v_line l JOIN v_fb f USING (image) LEFT JOIN v_hit h USING (image)", PAIR, COSTES))
def costes(spark, sf):
    return rounded(thresholds.costes(_pairs(spark, sf), "a", "b", ["image"]), 5, "thr_a", "thr_b")


@check(oracle("SELECT l.image, round(coalesce(h.t, f.fa), 5) AS thr FROM v_line l JOIN v_fb f USING (image) LEFT JOIN v_hit h USING (image)", PAIR, COSTES))
def coloc_threshold_costes(spark, sf):
    """The first channel of the pair; the fallback chain behind it never acts, as every image has a positive answer."""
    pixels = _pairs(spark, sf).select("image", F.lit("a").alias("channel"), F.col("a").alias("v"), F.col("b").alias("other"))
    none = F.lit(None).cast("double")
    fallback = V.images(spark, sf).select("image", F.lit("a").alias("channel"), none.alias("spot_thr"), none.alias("otsu_thr"), F.lit(1.0).alias("p99"))
    return rounded(thresholds.coloc_threshold(pixels, fallback, "image", "costes").drop("channel"), 5, "thr")


def _nuclear(spark, sf):
    rows = V.pixel_rows(spark, sf).where("channel <> 'dapi'")
    return pixels_in(rows, V.labels(spark, sf)).select("image", "channel", "v")


@check(oracle("""
SELECT image, channel, med + 2 * mad AS thr FROM v_images, (
  SELECT channel, any_value(med) AS med, median(abs(v - med)) AS mad FROM v_np JOIN (SELECT channel, median(v) AS med FROM v_np GROUP BY ALL) USING (channel) GROUP BY ALL)""",
  "v_np AS (SELECT p.channel, p.v FROM v_pixels p JOIN v_labels l USING (image, y, x) WHERE p.channel <> 'dapi')"))
def coloc_threshold(spark, sf):
    none = F.lit(None).cast("double")
    fallback = V.images(spark, sf).select("image", F.explode(F.array(F.lit("rna1"), F.lit("rna2"))).alias("channel"), none.alias("spot_thr"), none.alias("otsu_thr"), F.lit(1.0).alias("p99"))
    return thresholds.coloc_threshold(_nuclear(spark, sf), fallback)


@check(oracle("""
SELECT channel, CASE WHEN channel = 'dapi' THEN lo ELSE lo * 1.05 END AS lo, hi FROM (
  SELECT channel, quantile_cont(v, CASE channel WHEN 'dapi' THEN 0.1 ELSE 0.2 END) AS lo, 0 AS z FROM v_pixels WHERE channel = 'dapi' GROUP BY ALL
  UNION ALL SELECT channel, quantile_cont(v, 0.2), 0 FROM v_pixels WHERE channel <> 'dapi' GROUP BY ALL) a
JOIN (SELECT channel, quantile_cont(v, 0.999) AS hi FROM v_pixels WHERE channel = 'dapi' GROUP BY ALL UNION ALL SELECT channel, quantile_cont(v, 0.995) FROM v_pixels WHERE channel <> 'dapi' GROUP BY ALL) b USING (channel)""".replace("CASE channel WHEN 'dapi' THEN 0.1 ELSE 0.2 END", "0.1")))
def pooled_range(spark, sf):
    return ranges.pooled_range(flat(V.pixel_rows(spark, sf)), 20.0, 99.5, 5.0)


REGION = """v_reg AS (
  SELECT p.channel, p.v, CASE WHEN l.nucleus_id IS NOT NULL THEN 'nucleus' WHEN c.cyto_id IS NOT NULL THEN 'cytoplasm' ELSE 'background' END AS region
  FROM v_pixels p LEFT JOIN v_labels l USING (image, y, x) LEFT JOIN v_cyto c USING (image, y, x))"""


@check(oracle("""
SELECT channel, quantile_cont(v, 0.6) FILTER (region = 'cytoplasm') AS lo,
       CASE WHEN quantile_cont(v, 0.995) FILTER (region = 'nucleus') > quantile_cont(v, 0.6) FILTER (region = 'cytoplasm') THEN quantile_cont(v, 0.995) FILTER (region = 'nucleus') END AS hi FROM v_reg GROUP BY ALL""", REGION))
def reference_range(spark, sf):
    regions = V.labels(spark, sf).select("image", "y", "x", F.lit("nucleus").alias("region")).unionByName(V.cyto(spark, sf).select("image", "y", "x", F.lit("cytoplasm").alias("region")))
    pixels = flat(V.pixel_rows(spark, sf)).join(regions, ["image", "y", "x"], "left").fillna("background", ["region"])
    return ranges.reference_range(pixels, "cytoplasm", "nucleus", 60.0, 99.5)


@check(oracle("SELECT well, exp_qki_s AS lo, CASE WHEN dapi_mean - 25 <= exp_qki_s THEN exp_qki_s + 1 ELSE dapi_mean - 25 END AS hi, fov FROM v_fov"))
def manual_range(spark, sf):
    bounds = V.fov(spark, sf).select("well", "fov", F.col("exp_qki_s").alias("lo"), (F.col("dapi_mean") - 25).alias("hi"))
    return ranges.manual_range(bounds)


def _plate_pixels(spark, sf):
    wells = V.plate(spark, sf).select(F.col("well").alias("image"), "secondary", "arm", "genotype")
    return flat(V.pixel_rows(spark, sf).where("channel = 'rna1'").join(wells, "image"))


SHARED = """v_pp AS (SELECT p.image, p.v, w.secondary, w.arm, w.genotype FROM v_pixels p JOIN v_plate w ON w.well = p.image WHERE p.channel = 'rna1'),
v_sh AS (
  SELECT a.secondary, CASE WHEN hi <= lo THEN p2 ELSE lo END AS lo, CASE WHEN hi <= lo THEN p995 ELSE hi END AS hi FROM (
    SELECT secondary, quantile_cont(v, 0.97) AS hi, quantile_cont(v, 0.02) AS p2, quantile_cont(v, 0.995) AS p995 FROM v_pp WHERE arm = 'primary' AND genotype = 'WT' GROUP BY ALL) a
  JOIN (SELECT secondary, CASE WHEN secondary = '568' THEN 300 ELSE quantile_cont(v, 0.99) END AS lo FROM v_pp WHERE arm = 'seconly' GROUP BY secondary) b USING (secondary))"""


@check(oracle("SELECT secondary, lo, hi FROM v_sh", SHARED))
def shared_range(spark, sf):
    return ranges.shared_range(_plate_pixels(spark, sf), ceil_pct=97.0, floors={"568:window": 300.0, "647:single_plane": 5.0})


@check(oracle("""
SELECT image, kind, CASE kind WHEN 'ceiling' THEN a WHEN 'both' THEN 100 ELSE a END AS lo, CASE kind WHEN 'ceiling' THEN 1500 WHEN 'both' THEN 1200 ELSE b END AS hi
FROM (SELECT image, min(v) AS a, max(v) AS b FROM v_pixels WHERE channel = 'dapi' GROUP BY ALL), (VALUES ('own'), ('ceiling'), ('both'), ('crossed')) k(kind)"""))
def dapi_range(spark, sf):
    px = V.pixels(spark, sf).where("channel = 'dapi'").select("image", "v")
    bounds = {"own": {}, "ceiling": {"ceiling": 1500.0}, "both": {"floor": 100.0, "ceiling": 1200.0}, "crossed": {"floor": 3000.0}}
    out = [ranges.dapi_range(px, **b).withColumn("kind", F.lit(k)) for k, b in bounds.items()]
    return reduce(lambda a, b: a.unionByName(b), out)


@check(oracle("""
SELECT image, lo, CASE WHEN own > lo THEN own WHEN p999 > lo THEN p999 ELSE lo + 1 END AS hi FROM (
  SELECT image, secondary, quantile_cont(v, 0.97) AS own, quantile_cont(v, 0.999) AS p999 FROM v_pp GROUP BY ALL) JOIN v_sh USING (secondary)""", SHARED))
def per_image_ceiling(spark, sf):
    px = _plate_pixels(spark, sf)
    lo = ranges.shared_range(px, ceil_pct=97.0, floors={"568:window": 300.0})
    return ranges.per_image_ceiling(px, lo, 97.0)


QC = """v_qc AS (
  SELECT image, n_nuclei, n_spots, n_spots / n_nuclei AS spn, sd, sr1, sr2 FROM (SELECT image, count(*) AS n_nuclei, sum(n_spots) AS n_spots FROM v_one GROUP BY ALL)
  JOIN (SELECT image, avg((v >= 0.999::DOUBLE * 1995)::INT) FILTER (channel = 'dapi') AS sd, avg((v >= 0.999::DOUBLE * 1995)::INT) FILTER (channel = 'rna1') AS sr1, avg((v >= 0.999::DOUBLE * 1995)::INT) FILTER (channel = 'rna2') AS sr2 FROM v_pixels GROUP BY ALL) USING (image)),
v_qcf AS (
  SELECT *, concat_ws(',', CASE WHEN sd > 0.0005 THEN 'saturated_dapi' END, CASE WHEN sr1 > 0.0005 THEN 'saturated_rna1' END, CASE WHEN sr2 > 0.0005 THEN 'saturated_rna2' END,
         CASE WHEN n_nuclei < 5 THEN 'low_nuclei' END, CASE WHEN n_spots = 0 THEN 'zero_spot' END, CASE WHEN spn > 15 THEN 'overdetect_rna1' END) AS qc_flags FROM v_qc),
v_lim AS (SELECT any_value(m) + 2 * 1.4826 * median(abs(spn - m)) AS cut FROM v_qc, (SELECT median(spn) AS m FROM v_qc))"""


def _qc(spark, sf):
    from checks.cells import one_channel

    per_image = one_channel(spark, sf).groupBy("image").agg(F.count(F.lit(1)).alias("n_nuclei"), F.sum("n_spots").alias("n_spots")).withColumn("spots_per_nucleus", F.lit(None).cast("double"))
    focus = per_image.select("image", F.lit(1.0).alias("focus_score"))
    return ranges.qc_flags(per_image, flat(V.pixel_rows(spark, sf)), focus, full_scale=1995.0, saturated=0.0005, max_spots_per_nucleus=15.0)


@check(oracle("SELECT image, n_nuclei, n_spots, round(spn, 6) AS qc_rna1_spots_per_nucleus, round(sd, 7) AS qc_frac_saturated_dapi, round(sr1, 7) AS qc_frac_saturated_rna1, round(sr2, 7) AS qc_frac_saturated_rna2, qc_flags, qc_flags = '' AS qc_pass FROM v_qcf", QC))
def qc_flags(spark, sf):
    out = rounded(_qc(spark, sf), 7, "qc_frac_saturated_dapi", "qc_frac_saturated_rna1", "qc_frac_saturated_rna2").drop("spots_per_nucleus", "qc_focus_score")
    return rounded(out, 6, "qc_rna1_spots_per_nucleus")


@check(oracle("SELECT image, spn > cut AND spn > 10 AS run_outlier, CASE WHEN spn > cut AND spn > 10 THEN CASE WHEN qc_flags = '' THEN '' ELSE qc_flags || ',' END || 'overdetect_rna1_outlier' ELSE qc_flags END AS qc_flags, qc_flags = '' AND NOT (spn > cut AND spn > 10) AS qc_pass FROM v_qcf, v_lim", QC))
def flag_outliers(spark, sf):
    return ranges.flag_outliers(_qc(spark, sf), k=2.0, floor=10.0).select("image", "run_outlier", "qc_flags", "qc_pass")


@check(oracle("""
SELECT image, round(nm, 6) AS nuc_med, round(cm, 6) AS cyt_med, round(greatest(0, least(1, (nm - 500) / 1000)), 6) AS nuc_disp, round(greatest(0, least(1, (cm - 500) / 1000)), 6) AS cyt_disp FROM (
  SELECT s.image, median(s.v) FILTER (d.v >= 1000) AS nm, median(s.v) FILTER (d.v < 1000) AS cm FROM v_pixels s JOIN v_pixels d ON d.image = s.image AND d.y = s.y AND d.x = s.x AND d.channel = 'dapi' WHERE s.channel = 'rna1' GROUP BY ALL)"""))
def nuclear_dominance(spark, sf):
    thr = V.images(spark, sf).select("image", F.lit(1000.0).alias("thr"))
    out = intensity.nuclear_dominance(flat(V.pixel_rows(spark, sf)), thr, "rna1", "dapi", 500.0, 1500.0)
    return rounded(out, 6, "nuc_med", "cyt_med", "nuc_disp", "cyt_disp")


@check(oracle("""
SELECT image, nucleus_id, round(2 * sum(i * v) / (count(*) * sum(v)) - (count(*) + 1) / count(*), 7) AS gini FROM (
  SELECT image, nucleus_id, a AS v, row_number() OVER (PARTITION BY image, nucleus_id ORDER BY a) AS i FROM v_pair) GROUP BY ALL""", PAIR))
def gini(spark, sf):
    return rounded(pixelpattern.gini(_pairs(spark, sf), "a", KEY), 7, "gini")


@check(oracle("""
SELECT image, nucleus_id, round(sum(a) FILTER (a >= thr) / sum(a), 7) AS top_fraction FROM v_pair
JOIN (SELECT image, nucleus_id, (list(a ORDER BY a DESC))[greatest(1, round_even(count(*) * 0.05::DOUBLE, 0))::INT] AS thr FROM v_pair GROUP BY ALL) USING (image, nucleus_id) GROUP BY ALL""", PAIR))
def top_fraction(spark, sf):
    return rounded(pixelpattern.top_fraction(_pairs(spark, sf), "a", KEY, 0.05), 7, "top_fraction")


DEPTH = """v_box AS (SELECT image, nucleus_id, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM v_labels GROUP BY ALL),
v_bg AS (SELECT b.image, b.nucleus_id, g.y, g.x FROM v_box b JOIN v_grid g ON g.image = b.image AND g.y BETWEEN b.y0 AND b.y1 AND g.x BETWEEN b.x0 AND b.x1 WHERE NOT (g.d2 <= 36 AND g.block = b.nucleus_id)),
v_depth AS (SELECT l.image, l.nucleus_id, l.y, l.x, sqrt(min((l.y - b.y) * (l.y - b.y) + (l.x - b.x) * (l.x - b.x))) AS depth FROM v_labels l JOIN v_bg b USING (image, nucleus_id) GROUP BY ALL),
v_nd AS (SELECT image, nucleus_id, y, x, depth / max(depth) OVER (PARTITION BY image, nucleus_id) AS depth FROM v_depth)"""


@check(oracle("SELECT image, nucleus_id, y, x, round(depth, 9) AS depth FROM v_depth", DEPTH))
def depth_map(spark, sf):
    return rounded(depth.depth_map(V.labels(spark, sf)), 9, "depth")


@check(oracle("SELECT image, nucleus_id, y, x, round(depth, 9) AS depth FROM v_nd", DEPTH))
def normalize_depth(spark, sf):
    return rounded(pixelpattern.normalize_depth(depth.depth_map(V.labels(spark, sf))), 9, "depth")


PATTERN = """v_bgc AS (SELECT image, channel, quantile_cont(v, 0.05) AS bg FROM v_pixels GROUP BY ALL),
v_pp2 AS (
  SELECT d.image, d.nucleus_id, p.channel, p.v, greatest(p.v - b.bg, 0) AS vb, d.depth FROM v_nd d JOIN v_pixels p USING (image, y, x) JOIN v_bgc b USING (image, channel)
  WHERE NOT EXISTS (SELECT 1 FROM v_nucleoli n WHERE n.image = d.image AND n.y = d.y AND n.x = d.x)),
v_rk AS (SELECT *, row_number() OVER (PARTITION BY image, nucleus_id, channel ORDER BY vb) AS i, row_number() OVER (PARTITION BY image, nucleus_id, channel ORDER BY v) AS j FROM v_pp2),
v_thr AS (SELECT image, nucleus_id, channel, (list(vb ORDER BY vb DESC))[greatest(1, round_even(count(*) * 0.05::DOUBLE, 0))::INT] AS t5, (list(vb ORDER BY vb DESC))[greatest(1, round_even(count(*) * 0.1::DOUBLE, 0))::INT] AS t10 FROM v_pp2 GROUP BY ALL)"""
EDGES = [0.0, *pixelpattern.DEPTH_EDGES, 2.0]
DEPTH_COLS = ", ".join(f"round(avg(vb) FILTER (depth >= {lo!r}::DOUBLE AND depth < {hi!r}::DOUBLE), 6) AS d{i}" for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:])))


def _pattern(spark, sf):
    deep = pixelpattern.normalize_depth(depth.depth_map(V.labels(spark, sf)))
    keep = pixelpattern.sampling_pixels(V.labels(spark, sf), V.nucleoli(spark, sf), min_px=50)
    rows = V.pixel_rows(spark, sf).drop("z")
    pixels = cut_lineage(pixels_in(rows, keep.join(deep, ["image", "y", "x", "nucleus_id"])))
    return pixels, pixelpattern.background(flat(rows))


@check(oracle(f"""
SELECT image, nucleus_id, channel, count(*) AS n_px, round(avg(v), 6) AS mean, round(stddev_pop(v) / avg(v), 7) AS cv,
       round(2 * sum(i * vb) / (count(*) * sum(vb)) - (count(*) + 1) / count(*), 7) AS gini, round(2 * sum(j * v) / (count(*) * sum(v)) - (count(*) + 1) / count(*), 7) AS gini_raw,
       round(sum(vb) FILTER (vb >= t5) / sum(vb), 7) AS top5, round(sum(vb) FILTER (vb >= t10) / sum(vb), 7) AS top10, {DEPTH_COLS},
       round(avg(vb) FILTER (depth < 0.25) / avg(vb) FILTER (depth >= 0.5), 6) AS perinuclear_index
FROM v_rk JOIN v_thr USING (image, nucleus_id, channel) GROUP BY image, nucleus_id, channel""", DEPTH, PATTERN))
def pixel_pattern(spark, sf):
    pixels, bg = _pattern(spark, sf)
    out = pixelpattern.pixel_pattern(pixels, bg)
    out = rounded(out, 6, "mean", "perinuclear_index", *[f"d{i}" for i in range(10)])
    return rounded(out, 7, "cv", "gini", "gini_raw", "top5", "top10")


SWEEP = """v_qa AS (SELECT image, nucleus_id, list_sort(list_distinct(quantile_cont(a, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS qa, list_sort(list_distinct(quantile_cont(b, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS qb FROM v_pair GROUP BY ALL),
v_sw AS (SELECT image, nucleus_id, a, b, greatest(len(list_filter(qa, lambda e: e < a)) - 1, 0) AS ba, greatest(len(list_filter(qb, lambda e: e < b)) - 1, 0) AS bb FROM v_pair JOIN v_qa USING (image, nucleus_id))"""
SWEEP_COLS = ", ".join([f"round(avg(b) FILTER (ba = {i}), 6) AS b_at_a_d{i}, round(avg(a) FILTER (bb = {i}), 6) AS a_at_b_d{i}" for i in range(10)])


@check(oracle(f"SELECT image, nucleus_id, {SWEEP_COLS} FROM v_sw GROUP BY ALL", PAIR, SWEEP))
def decile_sweep(spark, sf):
    out = pixelpattern.decile_sweep(_pairs(spark, sf))
    return rounded(out, 6, *[c for c in out.columns if "_d" in c])
