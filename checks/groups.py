"""Checks of group statistics, reports and orders on the per-nucleus table."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from checks import views as V
from checks.cells import _full, _nuclei, one_channel, r6
from checks.views import oracle
from spotframe.functions.draws import sql_draw, sql_stream
from spotframe.operators import intensity, lookup, ordering, reports, stats

QUERIES = {}
ORACLES = {}
METRICS = ["n_spots", "nuclear_spots", "mean_peak", "log_total_peak", "nuclear_spot_fraction"]


def r7(df, *cols):
    return df.withColumns({c: F.round(c, 7) for c in cols})


def check(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def _cells(spark, sf):
    return reports.with_groups(one_channel(spark, sf))


def _long(spark, sf):
    return stats.long_table(one_channel(spark, sf).where("not secondary_only"), METRICS, ["image", "condition"])


LONG = """v_long AS (
  UNPIVOT (SELECT image, nucleus_id, condition, n_spots::DOUBLE AS n_spots, nuclear_spots::DOUBLE AS nuclear_spots, mean_peak, log_total_peak, nuclear_spot_fraction
           FROM v_one WHERE NOT secondary_only)
  ON n_spots, nuclear_spots, mean_peak, log_total_peak, nuclear_spot_fraction INTO NAME metric VALUE v),
v_rank AS (
  SELECT *, rank() OVER (PARTITION BY metric ORDER BY v) + (count(*) OVER (PARTITION BY metric, v) - 1) / 2.0::DOUBLE AS r FROM v_long),
v_mwu AS (
  SELECT metric, count(*) FILTER (condition = 'WT') AS n_a, count(*) FILTER (condition = 'KO') AS n_b, sum(r) FILTER (condition = 'WT') AS ra
  FROM v_rank GROUP BY ALL),
v_ties AS (SELECT metric, sum(t * t * t - t) AS ties FROM (SELECT metric, v, count(*)::DOUBLE AS t FROM v_long GROUP BY ALL) GROUP BY ALL),
v_test AS (
  SELECT metric, n_a, n_b, ties, ra - n_a * (n_a + 1) / 2.0::DOUBLE AS u, 2 * (ra - n_a * (n_a + 1) / 2.0::DOUBLE) / (n_a * n_b) - 1 AS cliffs_delta
  FROM v_mwu JOIN v_ties USING (metric))"""


@check(oracle("SELECT metric, round(v, 6) AS v, r AS rank, count(*) AS n FROM v_rank GROUP BY ALL", LONG))
def avg_rank(spark, sf):
    out = stats.avg_rank(_long(spark, sf).where("v is not null"), "v", ["metric"])
    return out.groupBy("metric", F.round("v", 6).alias("v"), "rank").agg(F.count(F.lit(1)).alias("n"))


@check(oracle("""SELECT metric, condition, round(avg(v), 7) AS mean, round(stddev_samp(v) / sqrt(count(v)), 7) AS sem, count(v) AS n FROM v_long GROUP BY ALL""", LONG))
def mean_sem_n(spark, sf):
    return r7(stats.mean_sem_n(_long(spark, sf), "v", ["metric", "condition"]), "mean", "sem")


@check(oracle("SELECT metric, n_a, n_b, ties, u, round(cliffs_delta, 9) AS cliffs_delta FROM v_test", LONG))
def mann_whitney(spark, sf):
    out = stats.mann_whitney(_long(spark, sf), "v", "condition", "WT", "KO", ["metric"], with_p=False)
    return out.withColumn("cliffs_delta", F.round("cliffs_delta", 9))


@check()
def mann_whitney_p(spark, sf):
    return stats.mann_whitney(_long(spark, sf), "v", "condition", "WT", "KO", ["metric"])


@check(oracle("SELECT metric, n_a, n_b, round(cliffs_delta, 9) AS cliffs_delta FROM v_test", LONG))
def cliffs_delta(spark, sf):
    return stats.cliffs_delta(_long(spark, sf), "v", "condition", "WT", "KO", ["metric"]).withColumn("cliffs_delta", F.round("cliffs_delta", 9))


def welch_sql(source: str, group: str, a: str, b: str, v: str, keys: str) -> str:
    """Aggregates and t columns of two groups of a table."""
    k = f"{keys}, " if keys else ""
    return f"""
SELECT {k}n_a, n_b, mean_a, mean_b, sd_a, sd_b, (mean_a - mean_b) / sqrt(sd_a * sd_a / n_a + sd_b * sd_b / n_b) AS t,
       pow(sd_a * sd_a / n_a + sd_b * sd_b / n_b, 2) / (pow(sd_a * sd_a / n_a, 2) / (n_a - 1) + pow(sd_b * sd_b / n_b, 2) / (n_b - 1)) AS df,
       (mean_a - mean_b) / sqrt(((n_a - 1) * sd_a * sd_a + (n_b - 1) * sd_b * sd_b) / (n_a + n_b - 2) * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b)) AS student_t,
       (mean_a - mean_b) / sqrt((sd_a * sd_a + sd_b * sd_b) / 2) AS cohens_d,
       CASE WHEN mean_a > mean_b THEN 'A>B' ELSE 'B>A' END AS direction
FROM (SELECT {k}count({v}) FILTER ({group} = '{a}') AS n_a, count({v}) FILTER ({group} = '{b}') AS n_b,
             avg({v}) FILTER ({group} = '{a}') AS mean_a, avg({v}) FILTER ({group} = '{b}') AS mean_b,
             stddev_samp({v}) FILTER ({group} = '{a}') AS sd_a, stddev_samp({v}) FILTER ({group} = '{b}') AS sd_b
      FROM {source} WHERE {group} IN ('{a}', '{b}') GROUP BY ALL)"""


T_COLS = ["mean_a", "mean_b", "sd_a", "sd_b", "t", "df", "student_t", "cohens_d"]
T_ROUND = ", ".join(f"round({c}, 7) AS {c}" for c in T_COLS)


@check(oracle(f"SELECT metric, n_a, n_b, direction, {T_ROUND} FROM ({welch_sql('v_long', 'condition', 'WT', 'KO', 'v', 'metric')})", LONG))
def welch(spark, sf):
    return r7(stats.welch(_long(spark, sf), "v", "condition", "WT", "KO", ["metric"], with_p=False), *T_COLS)


@check()
def welch_p(spark, sf):
    return stats.welch(_long(spark, sf), "v", "condition", "WT", "KO", ["metric"])


KRUSKAL = """v_kr AS (
  SELECT metric, third, v, rank() OVER (PARTITION BY metric ORDER BY v) + (count(*) OVER (PARTITION BY metric, v) - 1) / 2.0::DOUBLE AS r
  FROM (SELECT metric, image % 3 AS third, v FROM v_long)),
v_krg AS (SELECT metric, third, count(*) AS n, sum(r) AS rs FROM v_kr GROUP BY ALL),
v_kh AS (
  SELECT metric, count(*) AS k, sum(n)::DOUBLE AS n, 12.0::DOUBLE / (sum(n) * (sum(n) + 1)) * sum(rs * rs / n) - 3 * (sum(n) + 1) AS raw FROM v_krg GROUP BY ALL)"""


@check(oracle("SELECT metric, k, n, ties, round(raw / (1 - ties / (n * n * n - n)), 6) AS h FROM v_kh JOIN v_ties USING (metric)", LONG, KRUSKAL))
def kruskal(spark, sf):
    rows = _long(spark, sf).withColumn("third", F.col("image") % 3)
    return stats.kruskal(rows, "v", "third", ["metric"], with_p=False).withColumn("h", F.round("h", 6))


@check()
def kruskal_p(spark, sf):
    return stats.kruskal(_long(spark, sf).withColumn("third", F.col("image") % 3), "v", "third", ["metric"])


def rho_sql(source: str, x: str, y: str, keys: str, min_n: int = 8) -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    part_x = f"PARTITION BY {keys}, x" if keys else "PARTITION BY x"
    part_y = f"PARTITION BY {keys}, y" if keys else "PARTITION BY y"
    return f"""
SELECT {k}count(*) AS n, CASE WHEN count(*) >= {min_n} AND stddev_pop(rx) > 0 AND stddev_pop(ry) > 0 THEN corr(rx, ry) END AS rho FROM (
  SELECT {k}rank() OVER ({part} ORDER BY x) + (count(*) OVER ({part_x}) - 1) / 2.0::DOUBLE AS rx,
         rank() OVER ({part} ORDER BY y) + (count(*) OVER ({part_y}) - 1) / 2.0::DOUBLE AS ry
  FROM (SELECT {k}{x} AS x, {y} AS y FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)) GROUP BY ALL"""


@check(oracle(f"SELECT condition, n, round(rho, 9) AS rho FROM ({rho_sql('v_one', 'n_spots', 'mean_peak', 'condition')})"))
def spearman(spark, sf):
    return stats.spearman(one_channel(spark, sf), "n_spots", "mean_peak", ["condition"], with_p=False).withColumn("rho", F.round("rho", 9))


@check()
def spearman_p(spark, sf):
    return stats.spearman(one_channel(spark, sf), "n_spots", "mean_peak", ["condition"])


TWO = """v_sides AS (
  SELECT metric, avg(v) FILTER (condition = 'WT') AS a_mean, stddev_samp(v) FILTER (condition = 'WT') / sqrt(count(v) FILTER (condition = 'WT')) AS a_sem,
         count(v) FILTER (condition = 'WT') AS a_n, avg(v) FILTER (condition = 'KO') AS b_mean,
         stddev_samp(v) FILTER (condition = 'KO') / sqrt(count(v) FILTER (condition = 'KO')) AS b_sem, count(v) FILTER (condition = 'KO') AS b_n
  FROM v_long GROUP BY ALL),
v_sec AS (
  SELECT metric, avg(v) AS sec_mean, count(v) AS sec_n FROM (
    UNPIVOT (SELECT image, avg(n_spots) AS n_spots, avg(nuclear_spots) AS nuclear_spots, avg(mean_peak) AS mean_peak, avg(log_total_peak) AS log_total_peak,
                    avg(nuclear_spot_fraction) AS nuclear_spot_fraction FROM v_one WHERE secondary_only GROUP BY image)
    ON n_spots, nuclear_spots, mean_peak, log_total_peak, nuclear_spot_fraction INTO NAME metric VALUE v) GROUP BY ALL)"""


@check(oracle("""
SELECT metric, round(a_mean, 7) AS a_mean, round(a_sem, 7) AS a_sem, a_n, round(b_mean, 7) AS b_mean, round(b_sem, 7) AS b_sem, b_n, u,
       round(cliffs_delta, 9) AS cliffs_delta, CASE WHEN abs(cliffs_delta) < 1e-9 THEN '=' WHEN cliffs_delta > 0 THEN 'up WT' ELSE 'up KO' END AS direction,
       round(sec_mean, 7) AS sec_mean, sec_n FROM v_sides JOIN v_test USING (metric) LEFT JOIN v_sec USING (metric)""", LONG, TWO))
def comparison_table(spark, sf):
    nuclei = one_channel(spark, sf)
    per_image = nuclei.groupBy("image", "secondary_only").agg(*[F.avg(m).alias(m) for m in METRICS])
    out = reports.comparison_table(nuclei, per_image, METRICS, with_p=False)
    fives = ["a_mean", "a_sem", "b_mean", "b_sem", "sec_mean"]
    return out.withColumns({**{c: F.round(c, 7) for c in fives}, "cliffs_delta": F.round("cliffs_delta", 9)})


def _focus_inputs(spark, sf):
    meta = V.images(spark, sf).select("image", "condition", "secondary_only")
    spots = _full(spark, sf)
    labels = V.labels(spark, sf)
    nuclei = _nuclei(spark, sf, spots)
    active = spots.where("in_nucleus and paired = 1").groupBy("image", "nucleus_id", "channel").agg(F.count(F.lit(1)).alias("n_active"))
    nuclei = lookup.attach(nuclei, active, ["image", "nucleus_id", "channel"], {"n_active": 0})
    # the logarithm keeps exact rounding ties out of the comparison
    nuclei = nuclei.withColumn("total_peak", F.log("total_peak"))
    marked = lookup.classify_nucleolus(spots, V.nucleoli(spark, sf), V.images(spark, sf))
    above = intensity.above_floor_intensity(V.pixel_rows(spark, sf).where("channel <> 'dapi'"), labels, V.cyto(spark, sf), 800.0)
    return [df.join(meta, "image") for df in (nuclei, marked, above)]


FOCUS = """v_meta AS (SELECT image, condition FROM v_images WHERE NOT secondary_only),
v_act AS (SELECT image, nucleus_id, channel, count(*) AS n_active FROM v_full WHERE in_nucleus AND paired = 1 GROUP BY ALL),
v_fn AS (
  SELECT m.condition, n.channel, n.n_spots::DOUBLE AS n_spots, n.nuclear_spots::DOUBLE AS nuclear_spots, n.cyto_spots::DOUBLE AS cyto_spots,
         coalesce(a.n_active, 0)::DOUBLE AS n_active, n.nuclear_spots / nullif(n.n_spots, 0) AS nuclear_spot_fraction,
         n.paired_count / nullif(n.n_spots, 0) AS paired_fraction, ln(n.total_peak) AS total_peak
  FROM v_nuc n JOIN v_meta m USING (image) LEFT JOIN v_act a USING (image, nucleus_id, channel)),
v_marked AS (
  SELECT s.*, m.condition, h.nucleolus_id IS NOT NULL AS in_nucleolus FROM v_full s JOIN v_meta m USING (image)
  LEFT JOIN v_nucleoli h ON s.image = h.image AND s.y_px = h.y AND s.x_px = h.x),
v_im AS (
  SELECT image, channel, condition, avg(peak) FILTER (in_nucleus) AS peak_nuclear, avg(peak) FILTER (in_cytoplasm) AS peak_cytoplasmic,
         avg(diameter_um) FILTER (in_nucleus) AS diameter_nuclear, avg(diameter_um) FILTER (in_cytoplasm) AS diameter_cytoplasmic,
         avg(peak) FILTER (in_nucleus) / avg(peak) FILTER (in_cytoplasm) AS peak_ratio FROM v_marked GROUP BY ALL),
v_cm AS (
  SELECT image, nucleus_id, channel, condition, avg(peak) AS peak_any, avg(peak) FILTER (in_nucleus) AS peak_nuclear, avg(peak) FILTER (in_cytoplasm) AS peak_cytoplasmic,
         count(*) FILTER (in_nucleolus)::DOUBLE AS nucleolar_spots, count(*) FILTER (in_nucleolus AND in_nucleus) / nullif(count(*) FILTER (in_nucleus), 0) AS nucleolar_fraction
  FROM v_marked WHERE nucleus_id > 0 GROUP BY ALL),
v_ab AS (
  SELECT condition, channel, nuc_above, cyto_above, nuc_above / nullif(cyto_above, 0) AS nc_ratio_above FROM (
    SELECT l.image, l.nucleus_id, p.channel, m.condition, sum(greatest(v - 800, 0)) FILTER (l.part = 'nuc') AS nuc_above, sum(greatest(v - 800, 0)) FILTER (l.part = 'cyto') AS cyto_above
    FROM v_pixels p JOIN (SELECT image, y, x, nucleus_id, 'nuc' AS part FROM v_labels UNION ALL SELECT image, y, x, cyto_id, 'cyto' FROM v_cyto) l USING (image, y, x)
    JOIN v_meta m USING (image) WHERE p.channel <> 'dapi' GROUP BY ALL)),
v_sections AS (
  SELECT 'A' AS section, channel || ' ' || metric AS metric, condition, v FROM (UNPIVOT (SELECT condition, channel, n_spots, nuclear_spots, cyto_spots, n_active FROM v_fn) ON n_spots, nuclear_spots, cyto_spots, n_active INTO NAME metric VALUE v)
  UNION ALL SELECT 'B', channel || ' ' || metric, condition, v FROM (UNPIVOT v_ab ON nuc_above, cyto_above, nc_ratio_above INTO NAME metric VALUE v)
  UNION ALL SELECT 'C', channel || ' ' || metric, condition, v FROM (UNPIVOT (SELECT condition, channel, peak_nuclear, peak_cytoplasmic, peak_ratio FROM v_im) ON peak_nuclear, peak_cytoplasmic, peak_ratio INTO NAME metric VALUE v)
  UNION ALL SELECT 'D', channel || ' ' || metric, condition, v FROM (UNPIVOT (SELECT condition, channel, diameter_nuclear, diameter_cytoplasmic FROM v_im) ON diameter_nuclear, diameter_cytoplasmic INTO NAME metric VALUE v)
  UNION ALL SELECT 'E', channel || ' ' || metric, condition, v FROM (UNPIVOT (SELECT condition, channel, nuclear_spot_fraction, paired_fraction FROM v_fn) ON nuclear_spot_fraction, paired_fraction INTO NAME metric VALUE v)
  UNION ALL SELECT 'F', channel || ' ' || metric, condition, v FROM (UNPIVOT (SELECT condition, channel, peak_any, peak_nuclear, peak_cytoplasmic FROM v_cm) ON peak_any, peak_nuclear, peak_cytoplasmic INTO NAME metric VALUE v)
  UNION ALL SELECT 'F', channel || ' ' || metric, condition, v FROM (UNPIVOT (SELECT condition, channel, total_peak FROM v_fn) ON total_peak INTO NAME metric VALUE v)
  UNION ALL SELECT 'G', channel || ' ' || metric, condition, v FROM (UNPIVOT (SELECT condition, channel, nucleolar_spots, nucleolar_fraction FROM v_cm) ON nucleolar_spots, nucleolar_fraction INTO NAME metric VALUE v)),
v_sr AS (
  SELECT *, rank() OVER (PARTITION BY section, metric ORDER BY round(v, 9)) + (count(*) OVER (PARTITION BY section, metric, round(v, 9)) - 1) / 2.0::DOUBLE AS r FROM v_sections)"""


@check(oracle("""
SELECT section, metric, round(avg(v) FILTER (condition = 'WT'), 7) AS a_mean, count(*) FILTER (condition = 'WT') AS a_n,
       round(avg(v) FILTER (condition = 'KO'), 7) AS b_mean, count(*) FILTER (condition = 'KO') AS b_n,
       round(2 * (sum(r) FILTER (condition = 'WT') - count(*) FILTER (condition = 'WT') * (count(*) FILTER (condition = 'WT') + 1) / 2.0::DOUBLE)
         / (count(*) FILTER (condition = 'WT') * count(*) FILTER (condition = 'KO')) - 1, 7) AS cliffs_delta
FROM v_sr GROUP BY ALL""", FOCUS))
def focus_report(spark, sf):
    out = reports.focus_report(*_focus_inputs(spark, sf), with_p=False)
    return out.select("section", "metric", *[F.round(c, 7).alias(c) for c in ("a_mean", "b_mean", "cliffs_delta")], "a_n", "b_n")


@check(oracle("""
SELECT i.condition, i.n_images, n.n_nuclei, round(n.spots_per_nucleus, 6) AS spots_per_nucleus, s.n_rna1, s.n_rna2
FROM (SELECT condition, count(*) AS n_images FROM v_images GROUP BY ALL) i
LEFT JOIN (SELECT condition, count(*) AS n_nuclei, avg(n_spots) AS spots_per_nucleus FROM v_one GROUP BY ALL) n USING (condition)
LEFT JOIN (SELECT condition, count(*) FILTER (channel = 'rna1') AS n_rna1, count(*) FILTER (channel = 'rna2') AS n_rna2 FROM v_spots JOIN v_images USING (image) GROUP BY ALL) s USING (condition)"""))
def executive_counts(spark, sf):
    meta = V.images(spark, sf).select("image", "condition")
    out = reports.executive_counts(meta, one_channel(spark, sf), V.spots(spark, sf).join(meta, "image"))
    return r6(out, "spots_per_nucleus")


@check(oracle("""
SELECT metric FROM (SELECT unnest(['n_spots', 'nuclear_spots', 'mean_peak', 'log_total_peak', 'nuclear_spot_fraction']) AS metric)"""))
def discover_metrics(spark, sf):
    nuclei = one_channel(spark, sf)
    found = reports.discover_metrics(nuclei)
    return nuclei.select(F.explode(F.array(*[F.lit(m) for m in found])).alias("metric")).distinct()


COUNT_BIN = "CASE WHEN {c} > 0 AND {c} <= 2 THEN '1-2' WHEN {c} > 2 AND {c} <= 5 THEN '3-5' WHEN {c} > 5 AND {c} <= 10 THEN '6-10' WHEN {c} > 10 AND {c} <= 20 THEN '11-20' WHEN {c} > 20 AND {c} <= 40 THEN '21-40' WHEN {c} > 40 THEN '40+' END"


@check(oracle(f"SELECT image, nucleus_id, {COUNT_BIN.format(c='n_spots')} AS bin FROM v_one"))
def abundance_bins(spark, sf):
    return reports.abundance_bins(one_channel(spark, sf), "n_spots").select("image", "nucleus_id", "bin")


@check(oracle("""
SELECT image, nucleus_id, CASE WHEN mean_peak > q[1] AND mean_peak <= q[2] THEN 1 WHEN mean_peak > q[2] AND mean_peak <= q[3] THEN 2 WHEN mean_peak > q[3] AND mean_peak <= q[4] THEN 3
       WHEN mean_peak > q[4] AND mean_peak <= q[5] THEN 4 WHEN mean_peak > q[5] AND mean_peak <= q[6] + 1e-6 THEN 5 END AS bin
FROM v_one, (SELECT quantile_cont(mean_peak, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS q FROM v_one)"""))
def abundance_quantile_bins(spark, sf):
    out = reports.abundance_bins(one_channel(spark, sf), "mean_peak").select("image", "nucleus_id", "mean_peak", "bin")
    low = out.where("bin is not null").groupBy("bin").agg(F.min("mean_peak").alias("lo")).withColumn("one", F.lit(1))
    order = low.withColumn("n", F.row_number().over(Window.partitionBy("one").orderBy("lo"))).select("bin", "n")
    return out.join(order, "bin", "left").select("image", "nucleus_id", F.col("n").alias("bin"))


SC = f"""v_sc AS (
  SELECT 'n_spots' AS abundance, image, condition AS grp, n_spots::DOUBLE AS ab, {COUNT_BIN.format(c='n_spots')} AS bin, mean_peak, nuclear_spot_fraction FROM v_one WHERE NOT secondary_only),
v_scl AS (UNPIVOT v_sc ON mean_peak, nuclear_spot_fraction INTO NAME metric VALUE v),
v_scope AS (SELECT 'pool' AS scope, * FROM v_scl UNION ALL SELECT CASE grp WHEN 'WT' THEN 'A' ELSE 'B' END, * FROM v_scl)"""
SC_METRICS = ["mean_peak", "nuclear_spot_fraction"]


def _sc(spark, sf):
    return _cells(spark, sf).where("not secondary_only")


@check(oracle(f"SELECT metric, scope, n, round(rho, 9) AS rho FROM ({rho_sql('v_scope', 'ab', 'v', 'metric, scope')})", SC))
def dose_response(spark, sf):
    return reports.dose_response(_sc(spark, sf), "n_spots", SC_METRICS, "WT", "KO", with_p=False)[0].withColumn("rho", F.round("rho", 9))


@check(oracle("SELECT metric, scope, bin, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v) / sqrt(count(*)), 6) AS sem FROM v_scope WHERE bin IS NOT NULL GROUP BY ALL", SC))
def dose_response_bins(spark, sf):
    return r6(reports.dose_response(_sc(spark, sf), "n_spots", SC_METRICS, "WT", "KO", with_p=False)[1], "mean", "sem")


@check(oracle("""
SELECT metric, bin, n_a, n_b, CASE WHEN n_a >= 5 AND n_b >= 5 THEN ra - n_a * (n_a + 1) / 2.0::DOUBLE END AS u, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b FROM (
  SELECT metric, bin, count(*) FILTER (grp = 'WT') AS n_a, count(*) FILTER (grp = 'KO') AS n_b, sum(r) FILTER (grp = 'WT') AS ra, avg(v) FILTER (grp = 'WT') AS mean_a, avg(v) FILTER (grp = 'KO') AS mean_b
  FROM (SELECT *, rank() OVER (PARTITION BY metric, bin ORDER BY v) + (count(*) OVER (PARTITION BY metric, bin, v) - 1) / 2.0::DOUBLE AS r FROM v_scl WHERE bin IS NOT NULL) GROUP BY ALL)""", SC))
def matched_bins(spark, sf):
    return r6(reports.matched_bins(_sc(spark, sf), "n_spots", SC_METRICS, "WT", "KO", with_p=False), "mean_a", "mean_b")


TERT = """v_ko AS (SELECT * FROM v_scl WHERE grp = 'KO' AND ab >= 1),
v_third AS (
  SELECT metric, ab, v, CASE WHEN ab <= q[2] THEN 0 WHEN ab <= q[3] THEN 1 ELSE 2 END AS third
  FROM v_ko JOIN (SELECT metric, quantile_cont(ab, [0, 1.0 / 3, 2.0 / 3, 1]) AS q FROM v_ko GROUP BY ALL) USING (metric))"""


@check(oracle("SELECT metric, third, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v) / sqrt(count(*)), 6) AS sem, median(ab) AS abund_median FROM v_third GROUP BY ALL", SC, TERT))
def tertile_summary(spark, sf):
    return r6(reports.tertile_test(_sc(spark, sf), "n_spots", SC_METRICS, "KO", with_p=False)[0], "mean", "sem")


@check(oracle("""
SELECT metric, count(*) AS k, any_value(total) AS n, any_value(ties) AS ties,
       round((12.0::DOUBLE / (any_value(total) * (any_value(total) + 1)) * sum(rs * rs / n) - 3 * (any_value(total) + 1)) / (1 - any_value(ties) / (any_value(total)::DOUBLE * any_value(total) * any_value(total) - any_value(total))), 6) AS h
FROM (SELECT metric, third, count(*) AS n, sum(r) AS rs FROM (SELECT *, rank() OVER (PARTITION BY metric ORDER BY v) + (count(*) OVER (PARTITION BY metric, v) - 1) / 2.0::DOUBLE AS r FROM v_third) GROUP BY ALL)
JOIN (SELECT metric, count(*) AS total FROM v_third GROUP BY ALL) USING (metric)
JOIN (SELECT metric, sum(t * t * t - t) AS ties FROM (SELECT metric, v, count(*)::DOUBLE AS t FROM v_third GROUP BY ALL) GROUP BY ALL) USING (metric) GROUP BY ALL""", SC, TERT))
def tertile_kruskal(spark, sf):
    return reports.tertile_test(_sc(spark, sf), "n_spots", SC_METRICS, "KO", with_p=False)[1].withColumn("h", F.round("h", 6))


@check(oracle("""
SELECT metric, grp AS "group", count(*) AS n, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_samp(v), 6) AS sd, round(stddev_samp(v) / avg(v), 6) AS cv,
       round((avg(v * v * v) - 3 * avg(v) * avg(v * v) + 2 * avg(v) * avg(v) * avg(v)) / pow(var_pop(v), 1.5), 6) AS skew
FROM (SELECT metric, grp, CASE WHEN metric = 'mean_peak' THEN v / 1000 ELSE v END AS v FROM v_scl) GROUP BY ALL""", SC))
def distribution(spark, sf):
    cells = _sc(spark, sf).withColumn("mean_peak", F.col("mean_peak") / 1000)
    return r6(reports.distribution_table(cells, SC_METRICS, "WT", "KO", with_p=False)[0], "mean", "median", "sd", "cv", "skew")


REP = "v_rep AS (SELECT metric, grp, image, avg(v) AS m FROM v_scl GROUP BY ALL)"


@check(oracle(f"SELECT metric, n_a, n_b, direction, {T_ROUND}, round(100 * (mean_b - mean_a) / mean_a, 7) AS pct_change FROM ({welch_sql('v_rep', 'grp', 'WT', 'KO', 'm', 'metric')})", SC, REP))
def replicate_test(spark, sf):
    return r7(reports.distribution_table(_sc(spark, sf), SC_METRICS, "WT", "KO", with_p=False)[1], *T_COLS, "pct_change")


@check(oracle(f"""
SELECT tier, metric, n, round(rho, 9) AS rho FROM ({rho_sql("(SELECT tier, metric, ab, v FROM (UNPIVOT (SELECT t.tier, ab, nuclear_spot_fraction * ab AS assoc_count, nuclear_spot_fraction AS assoc_fraction FROM v_sc, (VALUES ('ge1', 1), ('ge3', 3)) t(tier, lim) WHERE ab >= lim) ON assoc_count, assoc_fraction INTO NAME metric VALUE v))", 'ab', 'v', 'tier, metric')})""", SC))
def saturation(spark, sf):
    cells = _sc(spark, sf).withColumn("usable", F.lit(True))
    return reports.saturation(cells, "n_spots", "nuclear_spot_fraction", "usable", with_p=False).withColumn("rho", F.round("rho", 9))


@check(oracle(f"SELECT metric, n_a, n_b, direction, {T_ROUND}, round(100 * (mean_b - mean_a) / mean_a, 7) AS pct_change, round(mean_b - mean_a, 7) AS b_minus_a FROM ({welch_sql('v_rep', 'grp', 'WT', 'KO', 'm', 'metric')})", SC, REP))
def well_welch(spark, sf):
    cells = _sc(spark, sf).withColumn("well", F.col("image"))
    return r7(reports.well_welch(cells, SC_METRICS, "WT", "KO", with_p=False), *T_COLS, "pct_change", "b_minus_a")


@check(oracle("""
SELECT g AS "group", round(m, 3) AS index_mean, g = 'Sec' AND round(m, 3) >= 0.9 * (SELECT avg(nuclear_spot_fraction) FROM v_one WHERE NOT secondary_only) AS likely_technical
FROM (SELECT CASE WHEN secondary_only THEN 'Sec' ELSE condition END AS g, avg(nuclear_spot_fraction) AS m FROM v_one GROUP BY ALL)"""))
def stain_qc(spark, sf):
    cells = one_channel(spark, sf).withColumn("group", F.when(F.col("secondary_only"), "Sec").otherwise(F.col("condition")))
    return reports.stain_qc(cells, "nuclear_spot_fraction")


@check(oracle("""
SELECT image, CASE WHEN secondary_only THEN 'sec-only' ELSE condition END AS condition, row_number() OVER (ORDER BY CASE WHEN secondary_only THEN 2 WHEN condition = 'WT' THEN 0 ELSE 1 END, image) AS pos FROM v_images"""))
def order_conditions(spark, sf):
    # the position is read back from the order over the image count, which is small next to its pixels
    out = ordering.order_conditions(V.images(spark, sf).select("image", "condition", "secondary_only"), "image")
    ids = out.select("image", "condition").withColumn("_i", F.monotonically_increasing_id())
    before = F.count(F.lit(1)).over(Window.orderBy("_i"))
    return ids.withColumn("pos", before).drop("_i")


@check(oracle("SELECT image, condition, secondary_only FROM v_images ORDER BY CASE WHEN condition = 'WT' THEN 0 ELSE 1 END, image"))
def control_first(spark, sf):
    return ordering.control_first(V.images(spark, sf).select("image", "condition", "secondary_only"), "condition", "image")


@check(oracle("SELECT image, secondary_only FROM v_images ORDER BY secondary_only, image"))
def secondary_last(spark, sf):
    return ordering.secondary_last(V.images(spark, sf).select("image", "secondary_only"), "image")


@check(oracle("""
SELECT image, nucleus_id, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY image ORDER BY d, nucleus_id) AS rn FROM (
    SELECT o.image, o.nucleus_id, abs(o.mean_peak - m.mid) AS d FROM v_one o
    JOIN (SELECT image, list(mean_peak ORDER BY mean_peak)[count(*) // 2 + 1] AS mid FROM v_one WHERE mean_peak IS NOT NULL GROUP BY ALL) m USING (image) WHERE o.mean_peak IS NOT NULL)) WHERE rn <= 2"""))
def representative(spark, sf):
    out = ordering.representative(one_channel(spark, sf), "mean_peak", 2)
    return out.select("image", "nucleus_id", F.round("distance", 6).alias("distance"))


SAMPLE = f"""v_in AS (SELECT image, nucleus_id, spot_id, y_px AS y, x_px AS x FROM v_strat WHERE channel = 'rna1' AND in_nucleus),
v_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY n DESC, nucleus_id) AS rn FROM (SELECT image, nucleus_id, count(*) AS n FROM v_in GROUP BY ALL)) WHERE rn <= 6),
v_pick AS (
  SELECT image, nucleus_id, n, 'spot' AS kind, y, x, row_number() OVER (PARTITION BY image, nucleus_id ORDER BY {sql_draw(sql_stream(0, 'image', 'nucleus_id'), 'spot_id % 2147483647')}, spot_id) AS pick FROM v_in JOIN v_best USING (image, nucleus_id)
  UNION ALL
  SELECT image, nucleus_id, n, 'random', y, x, row_number() OVER (PARTITION BY image, nucleus_id ORDER BY {sql_draw(sql_stream(0, 'image', 'nucleus_id'), 'y', 'x')}, y, x) FROM v_labels JOIN v_best USING (image, nucleus_id))"""


@check(oracle("SELECT image, nucleus_id, kind, y, x, pick FROM v_pick WHERE pick <= 8 AND pick <= n", SAMPLE))
def top_nuclei_samples(spark, sf):
    from checks.cells import _strat

    spots = _strat(spark, sf).where("channel = 'rna1' and in_nucleus").select("image", "nucleus_id", "spot_id", F.col("y_px").alias("y"), F.col("x_px").alias("x"))
    return ordering.top_nuclei_samples(spots, V.labels(spark, sf))


@check(oracle("SELECT well, fov, nucleus_count FROM (SELECT *, row_number() OVER (PARTITION BY well ORDER BY nucleus_count DESC, fov) AS rn FROM v_fov) WHERE rn = 1"))
def densest_fov(spark, sf):
    return ordering.densest_fov(V.fov(spark, sf))


@check(oracle("""
SELECT secondary, genotype, well, n_primary FROM v_plate JOIN (SELECT secondary, count(*) AS n_primary FROM v_plate WHERE arm = 'primary' GROUP BY ALL) USING (secondary) WHERE arm = 'primary'
UNION ALL SELECT 'pooled', genotype, well, 0 FROM v_plate WHERE arm = 'primary'"""))
def comparison_groups(spark, sf):
    return ordering.comparison_groups(V.plate(spark, sf))


@check(oracle("SELECT DISTINCT condition AS \"group\", CASE condition WHEN 'WT' THEN 'A' WHEN 'KO' THEN 'B' END AS role FROM v_one WHERE NOT secondary_only"))
def pick_groups(spark, sf):
    cells = _sc(spark, sf)
    a, b = ordering.pick_groups(cells)
    role = F.when(F.col("group") == a, "A").when(F.col("group") == b, "B")
    return cells.select("group").distinct().withColumn("role", role)
