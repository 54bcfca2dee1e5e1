"""Checks of spot and nucleus operators: lookup, filters, intensity, rollups, pairing."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.views import oracle
from spotframe.session import cut_lineage
from spotframe.operators import intensity, lookup, neighbours, rollups, spotfilters

QUERIES = {}
ORACLES = {}


def check(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _strat(spark, sf):
    return lookup.stratify_spots(V.spots(spark, sf), V.label_rows(spark, sf), V.cyto_rows(spark, sf), V.images(spark, sf))


def _paired(spark, sf):
    return neighbours.pair_spots(neighbours.nearest_between_channels(V.spots(spark, sf)), 0.3, "paired")


def _full(spark, sf):
    return cut_lineage(lookup.stratify_spots(_paired(spark, sf), V.label_rows(spark, sf), V.cyto_rows(spark, sf), V.images(spark, sf)))


def _nuclei(spark, sf, spots=None):
    return rollups.spot_rollup(spots or _full(spark, sf), intensity.nuclei_of(V.labels(spark, sf)))


def _total(column):
    """Sum of prices that does not hang on their order: a last digit more or less would break ties of the rank tests."""
    return F.sum(F.col(column).cast("decimal(28,6)")).cast("double")


def one_channel(spark, sf):
    """Per-nucleus table of the first channel with its image's condition: input of the group statistics."""
    spots = _strat(spark, sf).where("channel = 'rna1' and nucleus_id > 0").groupBy("image", "nucleus_id").agg(
        F.count(F.lit(1)).alias("n_spots"),
        F.sum(F.col("in_nucleus").cast("int")).alias("nuclear_spots"),
        (_total("peak") / F.count("peak")).alias("mean_peak"),
        F.log(_total("peak")).alias("log_total_peak"),
    )
    meta = V.images(spark, sf).select("image", "condition", "secondary_only")
    nuclei = intensity.nuclei_of(V.labels(spark, sf)).join(meta, "image")
    whole = lookup.attach(nuclei, spots, ["image", "nucleus_id"], {"n_spots": 0, "nuclear_spots": 0})
    cols = ["image", "nucleus_id", "condition", "secondary_only", "n_spots", "nuclear_spots", "mean_peak", "log_total_peak"]
    share = F.when(F.col("n_spots") > 0, F.col("nuclear_spots") / F.col("n_spots")).alias("nuclear_spot_fraction")
    return cut_lineage(whole.select(*cols, share))


@check(oracle("SELECT image, channel, spot_id, nucleus_id, in_nucleus, in_cytoplasm FROM v_strat"))
def stratify_spots(spark, sf):
    return _strat(spark, sf).select("image", "channel", "spot_id", "nucleus_id", "in_nucleus", "in_cytoplasm")


@check(oracle("""
SELECT s.image, s.channel, s.spot_id, n.nucleolus_id IS NOT NULL AS in_nucleolus,
       s.in_nucleus AND n.nucleolus_id IS NULL AS in_nucleus_excluding_nucleolus
FROM v_strat s LEFT JOIN v_nucleoli n ON s.image = n.image AND s.y_px = n.y AND s.x_px = n.x"""))
def classify_nucleolus(spark, sf):
    out = lookup.classify_nucleolus(_strat(spark, sf), V.nucleoli_rows(spark, sf), V.images(spark, sf))
    return out.select("image", "channel", "spot_id", "in_nucleolus", "in_nucleus_excluding_nucleolus")


@check(oracle("""
SELECT image, channel, spot_id, peak FROM v_spots
WHERE peak >= CASE WHEN channel = 'rna1' THEN 20000 ELSE 0 END"""))
def floor_spots(spark, sf):
    floors = spark.createDataFrame([("rna1", 20000.0), ("rna2", 0.0)], "channel string, floor double")
    return spotfilters.floor_spots(V.spots(spark, sf), floors).select("image", "channel", "spot_id", "peak")


@check(oracle("""
SELECT s.image, s.channel, s.spot_id, s.peak FROM v_spots s
JOIN (SELECT image, channel, quantile_cont(peak, 0.95) AS p95 FROM v_spots GROUP BY ALL) q USING (image, channel)
WHERE s.peak <= 0.9 * q.p95 + 1e-9"""))
def drop_specks(spark, sf):
    return spotfilters.drop_specks(V.spots(spark, sf), 0.9).select("image", "channel", "spot_id", "peak")


@check(oracle("SELECT image, channel, spot_id FROM v_strat WHERE in_nucleus OR in_cytoplasm"))
def drop_floaters(spark, sf):
    return spotfilters.drop_floaters(_strat(spark, sf)).select("image", "channel", "spot_id")


GHOSTS = """v_ghost AS (
  SELECT a.image, a.nucleus_id FROM v_area a
  LEFT JOIN (SELECT image, nucleus_id, count(*) AS n FROM v_strat WHERE channel = 'rna1' AND peak >= 60000 AND nucleus_id > 0 GROUP BY ALL) s USING (image, nucleus_id)
  JOIN (SELECT l.image, l.nucleus_id, stddev_pop(v) / avg(v) AS cv FROM v_pixels p JOIN v_labels l USING (image, y, x) WHERE p.channel = 'dapi' GROUP BY ALL) d USING (image, nucleus_id)
  WHERE coalesce(s.n, 0) = 0 AND a.area_px >= 100 AND d.cv <= 0.195)"""


def _ghosts(spark, sf):
    labels, none = V.labels(spark, sf), V.nucleoli(spark, sf)
    dapi = V.pixel_rows(spark, sf).where("channel = 'dapi'").drop("channel")
    spots = _strat(spark, sf).where("channel = 'rna1' AND peak >= 60000")
    counts = spots.where("nucleus_id > 0").groupBy("image", "nucleus_id").agg(F.count(F.lit(1)).alias("n_spots"))
    nuclei = lookup.attach(intensity.chromatin(dapi, labels, none), counts, ["image", "nucleus_id"], {"n_spots": 0})
    return spotfilters.drop_ghosts(nuclei, labels, spots, max_cv=0.195, min_area=100)


@check(oracle("""
SELECT 'nuclei' AS kind, image, count(*) AS n FROM (SELECT * FROM v_area ANTI JOIN v_ghost USING (image, nucleus_id)) GROUP BY ALL
UNION ALL SELECT 'pixels', image, count(*) FROM (SELECT * FROM v_labels ANTI JOIN v_ghost USING (image, nucleus_id)) GROUP BY ALL
UNION ALL SELECT 'spots', image, count(*) FROM (SELECT * FROM v_strat ANTI JOIN v_ghost USING (image, nucleus_id) WHERE channel = 'rna1' AND peak >= 60000) GROUP BY ALL""", GHOSTS))
def drop_ghosts(spark, sf):
    parts = [
        df.groupBy("image").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
        for kind, df in zip(("nuclei", "pixels", "spots"), _ghosts(spark, sf))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(oracle("SELECT image, nucleus_id, n_spots FROM v_one WHERE NOT secondary_only"))
def drop_secondary(spark, sf):
    return spotfilters.drop_secondary(one_channel(spark, sf)).select("image", "nucleus_id", "n_spots")


@check(oracle("""
SELECT 'below' AS kind, image, channel, sum(CASE WHEN v >= 900 THEN v ELSE 0 END) AS total FROM v_pixels GROUP BY ALL
UNION ALL SELECT 'above', image, channel, sum(greatest(v - 900, 0)) FROM v_pixels GROUP BY ALL
UNION ALL SELECT 'positive', image, channel, sum((v >= 900)::INT) FROM v_pixels GROUP BY ALL
UNION ALL SELECT 'stretch', image, channel, round(sum(greatest(least((v - 100) / 900.0::DOUBLE, 1), 0)), 4) FROM v_pixels GROUP BY ALL
UNION ALL SELECT 'own', image, channel, round(sum((v - lo) / (hi - lo)), 4)
  FROM v_pixels JOIN (SELECT image, channel, min(v) AS lo, max(v) AS hi FROM v_pixels GROUP BY ALL) USING (image, channel) GROUP BY ALL
UNION ALL SELECT 'guarded', image, channel, round(sum(greatest(least((v - lo) / (hi - lo), 1), 0)), 4)
  FROM v_pixels JOIN (SELECT image, channel, quantile_cont(v, 0.02) AS lo, quantile_cont(v, 0.995) AS hi FROM v_pixels GROUP BY ALL) USING (image, channel) GROUP BY ALL"""))
def plane_projections(spark, sf):
    p = V.pixels(spark, sf)
    kinds = {
        "below": (spotfilters.mask_below(p, 900.0), F.sum("v")),
        "above": (spotfilters.above_floor(p, 900.0), F.sum("v")),
        "positive": (spotfilters.positive_mask(p, 900.0), F.sum(F.col("positive").cast("double"))),
        "stretch": (spotfilters.stretch(p, 100.0, 1000.0), F.round(F.sum("v"), 4)),
        "own": (spotfilters.stretch(p, None, None), F.round(F.sum("v"), 4)),
        "guarded": (spotfilters.stretch_guarded(p, 5.0, 5.0), F.round(F.sum("v"), 4)),
    }
    out = None
    for kind, (df, total) in kinds.items():
        part = df.groupBy("image", "channel").agg(total.alias("total")).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


COMP = """v_comp AS (
  SELECT image, y, x, nucleus_id, 'nuc' AS part FROM v_labels UNION ALL SELECT image, y, x, cyto_id, 'cyto' FROM v_cyto),
v_ci AS (
  SELECT c.image, c.nucleus_id, p.channel, sum((part = 'nuc')::INT) AS nuc_area_px, sum(v) FILTER (part = 'nuc') AS nuc_sum,
         avg(v) FILTER (part = 'nuc') AS nuc_mean, sum((part = 'cyto')::INT) AS cyto_area_px,
         coalesce(sum(v) FILTER (part = 'cyto'), 0) AS cyto_sum, avg(v) FILTER (part = 'cyto') AS cyto_mean
  FROM v_pixels p JOIN v_comp c USING (image, y, x) GROUP BY ALL)"""


def _ci(spark, sf):
    return intensity.compartment_intensity(V.pixel_rows(spark, sf), V.labels(spark, sf), V.cyto(spark, sf))


@check(oracle("SELECT image, nucleus_id, channel, nuc_area_px, nuc_sum, round(nuc_mean, 6) AS nuc_mean, cyto_area_px, cyto_sum, round(cyto_mean, 6) AS cyto_mean FROM v_ci", COMP))
def compartment_intensity(spark, sf):
    return r6(_ci(spark, sf), "nuc_mean", "cyto_mean")


@check(oracle("""
SELECT image, nucleus_id, channel, round(CASE WHEN cyto_mean > 0 THEN nuc_mean / cyto_mean END, 6) AS nc_ratio_mean,
       round(CASE WHEN cyto_sum > 0 THEN nuc_sum / cyto_sum END, 6) AS nc_ratio_total,
       round(CASE WHEN nuc_sum + cyto_sum > 0 THEN nuc_sum / (nuc_sum + cyto_sum) END, 6) AS nuclear_fraction,
       nuc_sum + cyto_sum AS cell_total, nuc_area_px + cyto_area_px AS cell_area_px FROM v_ci""", COMP))
def nc_ratios(spark, sf):
    out = intensity.nc_ratios(_ci(spark, sf))
    cols = ["nc_ratio_mean", "nc_ratio_total", "nuclear_fraction"]
    return r6(out.select("image", "nucleus_id", "channel", *cols, "cell_total", "cell_area_px"), *cols)


def _thresh_sql(part: str) -> str:
    keep = f"part = '{part}' AND v >= 1500"
    return (
        f"CASE WHEN count(*) FILTER (part = '{part}') > 0 THEN coalesce(sum(v) FILTER ({keep}), 0) END AS {part}_thresh_total, "
        f"round(avg(v) FILTER ({keep}), 6) AS {part}_thresh_mean, count(*) FILTER ({keep}) AS {part}_thresh_area_px, "
        f"round(count(*) FILTER ({keep}) / nullif(count(*) FILTER (part = '{part}'), 0), 6) AS {part}_thresh_fraction"
    )


@check(oracle(f"SELECT c.image, c.nucleus_id, p.channel, {_thresh_sql('nuc')}, {_thresh_sql('cyto')} FROM v_pixels p JOIN v_comp c USING (image, y, x) GROUP BY ALL", COMP))
def thresholded_intensity(spark, sf):
    out = intensity.thresholded_intensity(V.pixel_rows(spark, sf), V.labels(spark, sf), V.cyto(spark, sf), 1500.0)
    return r6(out, "nuc_thresh_mean", "cyto_thresh_mean", "nuc_thresh_fraction", "cyto_thresh_fraction")


@check(oracle("""
SELECT image, nucleus_id, channel, nuc_above, cyto_above, round(CASE WHEN cyto_above > 0 THEN nuc_above / cyto_above END, 6) AS nc_ratio_above,
       round(CASE WHEN nuc_above + cyto_above > 0 THEN nuc_above / (nuc_above + cyto_above) END, 6) AS nuclear_fraction_above
FROM (SELECT c.image, c.nucleus_id, p.channel, sum(greatest(v - 800, 0)) FILTER (part = 'nuc') AS nuc_above,
             coalesce(sum(greatest(v - 800, 0)) FILTER (part = 'cyto'), 0) AS cyto_above
      FROM v_pixels p JOIN v_comp c USING (image, y, x) GROUP BY ALL)""", COMP))
def above_floor_intensity(spark, sf):
    out = intensity.above_floor_intensity(V.pixel_rows(spark, sf), V.labels(spark, sf), V.cyto(spark, sf), 800.0)
    return r6(out, "nc_ratio_above", "nuclear_fraction_above")


@check(oracle("""
SELECT image, nucleus_id, count(*) AS area_px, round(avg(v), 6) AS dapi_mean, round(stddev_pop(v), 6) AS dapi_std, round(stddev_pop(v) / avg(v), 6) AS dapi_cv,
       any_value(med) AS dapi_median, round(any_value(p10), 6) AS dapi_p10, round(any_value(p90), 6) AS dapi_p90,
       round(avg((v >= 1.5 * med)::INT), 6) AS heterochromatin_fraction, count(*) FILTER (hole) AS nucleolus_area_px,
       round(count(*) FILTER (hole) / count(*), 6) AS nucleolus_fraction, round(avg(v) FILTER (NOT hole), 6) AS dapi_mean_outside_nucleolus
FROM v_chr JOIN (SELECT image, nucleus_id, median(v) AS med, quantile_cont(v, 0.1) AS p10, quantile_cont(v, 0.9) AS p90 FROM v_chr GROUP BY ALL) USING (image, nucleus_id)
GROUP BY ALL""", """v_chr AS (
  SELECT l.image, l.nucleus_id, p.v, n.nucleolus_id IS NOT NULL AS hole FROM v_pixels p JOIN v_labels l USING (image, y, x)
  LEFT JOIN v_nucleoli n USING (image, y, x) WHERE p.channel = 'dapi')"""))
def chromatin(spark, sf):
    dapi = V.pixel_rows(spark, sf).where("channel = 'dapi'").drop("channel")
    out = intensity.chromatin(dapi, V.labels(spark, sf), V.nucleoli(spark, sf))
    return r6(out, "dapi_mean", "dapi_std", "dapi_cv", "dapi_p10", "dapi_p90", "heterochromatin_fraction", "nucleolus_fraction", "dapi_mean_outside_nucleolus")


@check(oracle("SELECT s.image, s.channel, s.spot_id, round(n.nn, 9) AS nn_distance_um FROM v_spots s LEFT JOIN v_nn n USING (image, channel, x_px, y_px, z_slice)"))
def nearest_partner(spark, sf):
    s = V.spots(spark, sf)
    a, b = s.where("channel = 'rna1'"), s.where("channel = 'rna2'")
    both = neighbours.nearest_partner(a, b).unionByName(neighbours.nearest_partner(b, a))
    return both.select("image", "channel", "spot_id", F.round("nn_distance_um", 9).alias("nn_distance_um"))


@check(oracle("SELECT image, channel, spot_id, paired AS paired_at_0p3um FROM v_full"))
def pair_spots(spark, sf):
    return neighbours.pair_spots(_paired(spark, sf), 0.3).select("image", "channel", "spot_id", "paired_at_0p3um")


@check(oracle("""
SELECT image, nucleus_id, area_px, channel, n_spots, nuclear_spots, cyto_spots, round(mean_peak, 6) AS mean_peak, round(total_peak, 4) AS total_peak,
       round(median_peak, 6) AS median_peak, round(median_nn_um, 6) AS median_nn_um, paired_count,
       round(nuclear_spots / nullif(n_spots, 0), 6) AS nuclear_spot_fraction, round(nullif(n_spots, 0) / (area_px * 0.0169::DOUBLE), 6) AS density_per_um2,
       round(peak_cv, 6) AS peak_cv, round(paired_count / nullif(n_spots, 0), 6) AS paired_fraction FROM v_nuc"""))
def spot_rollup(spark, sf):
    out = r6(_nuclei(spark, sf), "mean_peak", "median_peak", "median_nn_um", "nuclear_spot_fraction", "density_per_um2", "peak_cv", "paired_fraction")
    return out.withColumn("total_peak", F.round("total_peak", 4))


@check(oracle("""
SELECT a.image, a.nucleus_id, a.area_px, coalesce(sum((channel = 'rna1' AND in_nucleus AND paired = 1)::INT), 0) AS n_active_rna1,
       coalesce(sum((channel = 'rna2' AND in_nucleus AND paired = 1)::INT), 0) AS n_active_rna2,
       coalesce(sum((channel = 'rna1' AND in_cytoplasm)::INT), 0) AS n_mature_rna1, coalesce(sum((channel = 'rna2' AND in_cytoplasm)::INT), 0) AS n_mature_rna2
FROM v_area a LEFT JOIN v_full s USING (image, nucleus_id) GROUP BY ALL"""))
def active_and_mature(spark, sf):
    return rollups.active_and_mature(_full(spark, sf), intensity.nuclei_of(V.labels(spark, sf)))


@check(oracle("""
SELECT a.image, a.nucleus_id, a.area_px, round(coalesce(avg(diameter_um), 0.3), 6) AS mean_diameter_um, round(coalesce(avg(diameter_um / 0.13), 0.3 / 0.13), 6) AS mean_fwhm_px,
       round(coalesce(median(diameter_um / 0.13), 0.3 / 0.13), 6) AS median_fwhm_px,
       round(coalesce(avg(pi() * (diameter_um / 0.26) * (diameter_um / 0.26)), pi() * (0.3 / 0.26) * (0.3 / 0.26)), 6) AS mean_area_px,
       round(4.0 / 3.0 * pi() * 0.15 * 0.15 * 0.15, 6) AS nominal_volume_um3
FROM v_area a LEFT JOIN v_strat s ON s.image = a.image AND s.nucleus_id = a.nucleus_id AND s.channel = 'rna1' AND s.diameter_um > 0 GROUP BY ALL"""))
def spot_size_rollup(spark, sf):
    spots = _strat(spark, sf).where("channel = 'rna1'")
    out = rollups.spot_size_rollup(spots, intensity.nuclei_of(V.labels(spark, sf)), 0.3)
    return r6(out, "mean_diameter_um", "mean_fwhm_px", "median_fwhm_px", "mean_area_px", "nominal_volume_um3")


@check(oracle("""
SELECT n.*, s.n_spots_raw, s.n_in_cell AS n_spots, s.paired_all AS paired_count, round(s.median_nn, 6) AS median_nn_um, s.n_spots_raw - s.n_in_cell AS n_floaters,
       round(n.nuclear_spots / nullif(s.n_in_cell, 0), 6) AS frac_nuclear, round(s.paired_all / nullif(s.n_in_cell, 0), 6) AS paired_fraction
FROM (SELECT image, channel, count(*) AS n_nuclei, round(avg(n_spots), 6) AS spots_per_nucleus_mean, round(stddev_samp(n_spots) / avg(n_spots), 6) AS spots_per_nucleus_cv,
             median(n_spots) AS spots_per_nucleus_median, sum(nuclear_spots) AS nuclear_spots, sum(cyto_spots) AS cyto_spots,
             round(avg((n_spots >= 1)::INT), 4) AS frac_nuclei_ge1, round(avg((n_spots >= 5)::INT), 4) AS frac_nuclei_ge5, round(avg((n_spots >= 10)::INT), 4) AS frac_nuclei_ge10,
             round(avg(mean_peak), 6) AS mean_peak_mean, round(stddev_samp(mean_peak) / avg(mean_peak), 6) AS mean_peak_cv, round(median(mean_peak), 7) AS mean_peak_median,
             round(avg(total_peak), 6) AS total_peak_mean, round(stddev_samp(total_peak) / avg(total_peak), 6) AS total_peak_cv, round(median(total_peak), 4) AS total_peak_median
      FROM v_nuc GROUP BY ALL) n
LEFT JOIN (SELECT image, channel, count(*) AS n_spots_raw, sum((in_nucleus OR in_cytoplasm)::INT) AS n_in_cell, sum(paired) AS paired_all, median(nn_distance_um) AS median_nn
           FROM v_full GROUP BY ALL) s USING (image, channel)"""))
def per_image_summary(spark, sf):
    spots = _full(spark, sf)
    out = rollups.per_image_summary(_nuclei(spark, sf, spots), spots)
    out = r6(out, "spots_per_nucleus_mean", "spots_per_nucleus_cv", "mean_peak_cv", "total_peak_cv", "median_nn_um", "frac_nuclear", "paired_fraction")
    digits = {"mean_peak_mean": 6, "mean_peak_median": 7, "total_peak_mean": 6, "total_peak_median": 4}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@check(oracle("""
SELECT a.image, a.nucleus_id, a.condition AS "group", sum((peak >= 0)::INT)::BIGINT AS foci_ge0, sum((peak >= 5000)::INT) AS foci_ge5000, sum((peak >= 8000)::INT) AS foci_ge8000,
       sum((peak >= 10000)::INT) AS foci_ge10000, sum((peak >= 12000)::INT) AS foci_ge12000, sum((peak >= 15000)::INT) AS foci_ge15000
FROM (SELECT image, nucleus_id, condition FROM v_area JOIN v_images USING (image)) a
LEFT JOIN v_strat s ON s.image = a.image AND s.nucleus_id = a.nucleus_id AND s.in_nucleus AND s.channel = 'rna2' GROUP BY ALL""").replace("sum((peak", "coalesce(sum((peak").replace(")::INT)::BIGINT AS", ")::INT), 0) AS").replace(")::INT) AS foci", ")::INT), 0) AS foci"))
def foci_bands(spark, sf):
    nuclei = intensity.nuclei_of(V.labels(spark, sf)).drop("area_px").join(V.images(spark, sf).select("image", F.col("condition").alias("group")), "image")
    return rollups.foci_bands(_strat(spark, sf).where("channel = 'rna2'"), nuclei)[0]


@check(oracle("""
SELECT a.condition AS "group", f.floor, round(avg(a.n), 3) AS foci_per_nucleus FROM (
  SELECT v.image, v.nucleus_id, i.condition, f.floor, count(s.spot_id) AS n FROM v_area v JOIN v_images i USING (image)
  CROSS JOIN (VALUES (0.0), (5000.0), (8000.0), (10000.0), (12000.0), (15000.0)) f(floor)
  LEFT JOIN v_strat s ON s.image = v.image AND s.nucleus_id = v.nucleus_id AND s.in_nucleus AND s.channel = 'rna2' AND s.peak >= f.floor
  GROUP BY ALL) a JOIN (VALUES (0.0::DOUBLE)) u(z) ON TRUE, LATERAL (SELECT a.floor::DOUBLE AS floor) f GROUP BY ALL"""))
def foci_band_means(spark, sf):
    nuclei = intensity.nuclei_of(V.labels(spark, sf)).drop("area_px").join(V.images(spark, sf).select("image", F.col("condition").alias("group")), "image")
    return rollups.foci_bands(_strat(spark, sf).where("channel = 'rna2'"), nuclei)[1]
