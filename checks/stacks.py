"""Checks of focus selection and of label and mask operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.views import oracle
from spotframe.functions.stencils import disk
from spotframe.operators import focus, frames, labels, sampling, specks
from spotframe.plans import modes

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


def _at(dy: int, dx: int) -> str:
    return f"(SELECT v FROM v_stack q WHERE q.image = s.image AND q.channel = s.channel AND q.z = s.z AND q.y = greatest(0, least(7, s.y + {dy})) AND q.x = greatest(0, least(7, s.x + {dx})))"


NEAR = """v_st AS MATERIALIZED (SELECT * FROM v_stack),
v_nb AS (SELECT s.image, s.channel, s.z, s.y, s.x, d.dy, d.dx, greatest(0, least(7, s.y + d.dy)) AS jy, greatest(0, least(7, s.x + d.dx)) AS jx
         FROM v_st s CROSS JOIN (SELECT a.i - 1 AS dy, b.i - 1 AS dx FROM v_side a, v_side b WHERE a.i < 3 AND b.i < 3) d),
v_lap AS (
  SELECT n.image, n.channel, n.z, n.y, n.x, sum(CASE WHEN abs(dy) + abs(dx) = 1 THEN q.v WHEN dy = 0 AND dx = 0 THEN -4 * q.v ELSE 0 END) AS lap,
         sum(q.v * dy * CASE WHEN dx = 0 THEN 2 ELSE 1 END) AS gy, sum(q.v * dx * CASE WHEN dy = 0 THEN 2 ELSE 1 END) AS gx
  FROM v_nb n JOIN v_st q ON q.image = n.image AND q.channel = n.channel AND q.z = n.z AND q.y = n.jy AND q.x = n.jx GROUP BY ALL),
v_lev AS (SELECT image, channel, z, avg(v) AS mean, var_pop(v) AS var FROM v_st GROUP BY ALL),
v_sc AS MATERIALIZED (SELECT l.image, l.channel, l.z, var_pop(lap) / (any_value(mean) * any_value(mean)) AS score, any_value(mean) AS mean, sum(gy * gy + gx * gx) / (any_value(mean) * any_value(mean)) AS ten, any_value(var) / (any_value(mean) * any_value(mean)) AS nv
         FROM v_lap l JOIN v_lev USING (image, channel, z) GROUP BY ALL)"""


def _scores(spark, sf, metric="variance_of_laplacian"):
    return focus.focus_scores(V.stack_rows(spark, sf), metric)


@check(oracle("SELECT image, channel, z, round(score, 7) AS score, round(mean, 6) AS mean FROM v_sc", NEAR))
def focus_scores(spark, sf):
    return rounded(rounded(_scores(spark, sf), 7, "score"), 6, "mean")


@check(oracle("""
SELECT image, channel, z, med AS median, mad, round(p999, 6) AS p999, round(CASE WHEN mad > 0 THEN (p999 - med) / (mad * 1.4826) WHEN p999 > med THEN 'infinity'::DOUBLE ELSE 0 END, 6) AS quality
FROM (SELECT image, channel, z, any_value(med) AS med, median(abs(v - med)) AS mad, quantile_cont(v, 0.999) AS p999
  FROM v_stack JOIN (SELECT image, channel, z, median(v) AS med FROM v_stack GROUP BY ALL) USING (image, channel, z) GROUP BY ALL)"""))
def plane_quality(spark, sf):
    return rounded(focus.plane_quality(V.stack(spark, sf), ("image", "channel", "z")), 6, "quality", "p999")


@check(oracle("SELECT image, channel, z, round(ten, 6) AS score FROM v_sc", NEAR))
def focus_tenengrad(spark, sf):
    return rounded(_scores(spark, sf, "tenengrad").drop("mean"), 6, "score")


@check(oracle("SELECT image, channel, z, round(nv * mean, 6) AS score FROM v_sc", NEAR))
def focus_normalized_variance(spark, sf):
    return rounded(focus.focus_scores(V.stack_rows(spark, sf), "normalized_variance", intensity_weighted=True).drop("mean"), 6, "score")


@check(oracle("SELECT image, channel, z FROM (SELECT *, row_number() OVER (PARTITION BY image, channel ORDER BY round(score, 9) DESC, z) AS rn FROM v_sc) WHERE rn = 1", NEAR))
def best_plane(spark, sf):
    return focus.best_plane(_scores(spark, sf))


# every channel of a stack is searched as an image of its own
EACH = "v_se AS (SELECT image * 2 + channel AS image, z, score, mean FROM v_sc)"
PEAK = """v_pk AS (SELECT image, lo, hi, z AS peak_z, score AS peak_score FROM (
  SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, z) AS rn, min(z) OVER (PARTITION BY image) AS lo, max(z) OVER (PARTITION BY image) AS hi FROM v_se) WHERE rn = 1)"""


def _each(df):
    return df.withColumn("image", F.col("image") * 2 + F.col("channel"))


@check(oracle("""
SELECT image, lo, hi, z AS peak_z FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, z) AS rn FROM (
  SELECT *, min(z) OVER (PARTITION BY image) AS lo, max(z) OVER (PARTITION BY image) AS hi FROM v_se)
  WHERE z BETWEEN lo + (hi - lo + 1 - round_even((hi - lo + 1) * 0.6, 0)::INT) // 2 AND hi - ((hi - lo + 1 - round_even((hi - lo + 1) * 0.6, 0)::INT) - (hi - lo + 1 - round_even((hi - lo + 1) * 0.6, 0)::INT) // 2)) WHERE rn = 1""", NEAR, EACH))
def peak_z(spark, sf):
    return focus.peak_z(_each(_scores(spark, sf)), central_fraction=0.6).drop("peak_score")


@check(oracle("""
SELECT image, CASE WHEN 3 >= hi - lo + 1 THEN lo ELSE greatest(lo, least(peak_z - 1, hi - 2)) END AS z_start, CASE WHEN 3 >= hi - lo + 1 THEN hi ELSE greatest(lo, least(peak_z - 1, hi - 2)) + 2 END AS z_end,
       hi - lo + 1 > 3 AND greatest(lo, least(peak_z - 1, hi - 2)) <> peak_z - 1 AS shifted, 3 >= hi - lo + 1 AS shrunk FROM v_pk""", NEAR, EACH, PEAK))
def fixed_window(spark, sf):
    return focus.fixed_window(focus.peak_z(_each(_scores(spark, sf))), 3)


@check(oracle("""
SELECT p.image, coalesce(max(s.z) FILTER (s.z < peak_z AND s.score < 0.9 * peak_score) + 1, any_value(lo)) AS z_start, coalesce(min(s.z) FILTER (s.z > peak_z AND s.score < 0.9 * peak_score) - 1, any_value(hi)) AS z_end, FALSE AS expanded, FALSE AS clipped
FROM v_pk p JOIN v_se s ON s.image = p.image GROUP BY p.image""", NEAR, EACH, PEAK))
def focus_window(spark, sf):
    scores = _each(_scores(spark, sf))
    return focus.focus_window(scores, focus.peak_z(scores), frac=0.9, min_slices=1)


JOINT = "v_js AS (SELECT image, z, exp(sum(ln(s))) AS p, exp(avg(ln(s))) AS g, min(s) AS m FROM (SELECT image, channel, z, score / max(score) OVER (PARTITION BY image, channel) AS s FROM v_sc) GROUP BY ALL)"


@check(oracle("SELECT image, z, round(p, 7) AS product, round(g, 7) AS geomean, round(m, 7) AS least FROM v_js", NEAR, JOINT))
def joint_score(spark, sf):
    scores = _scores(spark, sf)
    parts = [focus.joint_score(scores, how).withColumnRenamed("score", name) for how, name in (("product", "product"), ("geomean", "geomean"), ("min", "least"))]
    return rounded(parts[0].join(parts[1], ["image", "z"]).join(parts[2], ["image", "z"]), 7, "product", "geomean", "least")


@check(oracle("SELECT image, z FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY p DESC, z) AS rn FROM v_js) WHERE rn = 1", NEAR, JOINT))
def joint_plane(spark, sf):
    return focus.joint_plane(_scores(spark, sf))


def _weights(name: str, sigma: float) -> str:
    reach = len(focus.gaussian_weights(sigma)) // 2
    return f"{name} AS (SELECT d, w / sum(w) OVER () AS w FROM (SELECT i - {reach} AS d, exp(-0.5::DOUBLE * pow((i - {reach}) / {sigma}::DOUBLE, 2)) AS w FROM (SELECT unnest(range({2 * reach + 1})) AS i)))"


def _mirror(i: str, n: int) -> str:
    return f"CASE WHEN ((({i}) % {2 * n}) + {2 * n}) % {2 * n} < {n} THEN ((({i}) % {2 * n}) + {2 * n}) % {2 * n} ELSE {2 * n - 1} - ((({i}) % {2 * n}) + {2 * n}) % {2 * n} END"


def _cross(name: str, source: str, least: int) -> str:
    """Pixels of the frame of whose cross (itself and four neighbours) at least so many are in the source."""
    return f"{name} AS MATERIALIZED (SELECT g.image, g.y, g.x FROM v_first g JOIN (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) o(dy, dx) ON true JOIN {source} s ON s.image = g.image AND s.y = g.y + dy AND s.x = g.x + dx GROUP BY ALL HAVING count(*) >= {least})"


MASKED = [
    "v_top AS MATERIALIZED (SELECT image, y, x, max(v) AS v FROM v_stack WHERE channel = 0 GROUP BY ALL)",
    "v_first AS (SELECT image, y, x FROM v_top)",
    _weights("v_w", 1.5),
    f"v_d1 AS MATERIALIZED (SELECT g.image, g.y, g.x, sum(t.v * w) AS v FROM v_first g CROSS JOIN v_w JOIN v_top t ON t.image = g.image AND t.x = g.x AND t.y = {_mirror('g.y + d', 8)} GROUP BY ALL)",
    f"v_f AS MATERIALIZED (SELECT g.image, g.y, g.x, sum(t.v * w) AS v FROM v_first g CROSS JOIN v_w JOIN v_d1 t ON t.image = g.image AND t.y = g.y AND t.x = {_mirror('g.x + d', 8)} GROUP BY ALL)",
    "v_b AS (SELECT image, min(v) AS lo, (max(v) - min(v)) / 256 AS width FROM v_f GROUP BY ALL)",
    "v_h AS (SELECT image, least(255, floor((v - lo) / width)) AS slot, count(*) AS c, any_value(lo) AS lo, any_value(width) AS width FROM v_f JOIN v_b USING (image) GROUP BY ALL)",
    """v_wt AS (
  SELECT image, slot, lo + (slot + 0.5) * width AS centre, sum(c) OVER lower AS w1, sum(c * (lo + (slot + 0.5) * width)) OVER lower AS m1, sum(c) OVER upper AS w2, sum(c * (lo + (slot + 0.5) * width)) OVER upper AS m2 FROM v_h
  WINDOW lower AS (PARTITION BY image ORDER BY slot), upper AS (PARTITION BY image ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))""",
    "v_cut AS (SELECT image, centre AS thr FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY round(w1::DOUBLE * w2 * pow(m1 / w1 - m2 / w2, 2), 6) DESC, slot) AS rn FROM v_wt WHERE w2 > 0) WHERE rn = 1)",
    "v_m0 AS MATERIALIZED (SELECT image, y, x FROM v_f JOIN v_cut USING (image) WHERE v > thr)",
    _cross("v_m1", "v_m0", 5), _cross("v_m2", "v_m1", 1), _cross("v_m3", "v_m2", 1), _cross("v_m4", "v_m3", 5),
    "v_cov AS MATERIALIZED (SELECT image, coalesce(n, 0) / 64 AS coverage, coalesce(n, 0) > 0 AND coalesce(n, 0) / 64 >= 0.01 AS used FROM (SELECT DISTINCT image FROM v_stack) LEFT JOIN (SELECT image, count(*) AS n FROM v_m4 GROUP BY ALL) USING (image))",
    "v_nm AS MATERIALIZED (SELECT image, y, x FROM v_m4 SEMI JOIN (SELECT image FROM v_cov WHERE used) USING (image))",
]


def _dapi(spark, sf):
    return V.stack_rows(spark, sf).where("channel = 0").drop("channel")


@check(oracle("SELECT image, y, x FROM v_nm", *MASKED))
def nuclear_mask(spark, sf):
    return focus.nuclear_mask(_dapi(spark, sf))[0]


@check(oracle("SELECT image, y, x, round(v, 6) AS v FROM v_f", *MASKED[:5]))
def gaussian_smooth(spark, sf):
    rows = focus.brightest_rows(_dapi(spark, sf))
    return rounded(frames.flat(focus.gaussian_rows(rows, 1.5)), 6, "v")


@check(oracle("""
SELECT c.image, lo, hi, z, round(p, 7) AS joint_score, used AS mask_used, round(coverage, 9) AS coverage FROM v_cov c JOIN (
  SELECT *, row_number() OVER (PARTITION BY image ORDER BY p DESC, z) AS rn FROM (SELECT *, min(z) OVER (PARTITION BY image) AS lo, max(z) OVER (PARTITION BY image) AS hi FROM v_ms)
  WHERE z BETWEEN lo + (hi - lo + 1 - 3) // 2 AND hi - ((hi - lo + 1 - 3) - (hi - lo + 1 - 3) // 2)) j ON j.image = c.image WHERE rn = 1""", NEAR, *MASKED, """v_in AS (
  SELECT l.image, l.channel, l.z, l.y, l.x, l.lap, s.v FROM v_lap l JOIN v_st s USING (image, channel, z, y, x) WHERE (l.image, l.y, l.x) IN (SELECT (image, y, x) FROM v_nm) OR l.image IN (SELECT image FROM v_cov WHERE NOT used)),
v_ml AS (SELECT image, channel, z, CASE WHEN mean < 0.9 * max(mean) OVER (PARTITION BY image, channel) THEN 0 ELSE score END AS score FROM (SELECT image, channel, z, avg(v) AS mean, var_pop(lap) / avg(v) AS score FROM v_in GROUP BY ALL)),
v_mn AS (SELECT image, channel, z, CASE WHEN max(score) OVER w > 0 THEN score / max(score) OVER w ELSE 1 END AS s FROM v_ml WINDOW w AS (PARTITION BY image, channel)),
v_ms AS (SELECT image, z, product(s) AS p FROM v_mn GROUP BY ALL)"""))
def joint_focus(spark, sf):
    out = focus.joint_focus(V.stack_rows(spark, sf), [0, 1], central_fraction=0.6, min_intensity=0.9, intensity_weighted=True, masked=True)
    return rounded(rounded(out, 7, "joint_score"), 9, "coverage")


@check(oracle("SELECT image, CASE WHEN image % 2 = 0 THEN max(z) FILTER (channel = 1) ELSE max(z) FILTER (channel = 0) END AS z, CASE WHEN image % 2 = 0 THEN 'rna' ELSE 'dapi' END AS anchor FROM (SELECT *, row_number() OVER (PARTITION BY image, channel ORDER BY score DESC, z) AS rn FROM v_sc) WHERE rn = 1 GROUP BY image", NEAR))
def anchor_plane(spark, sf):
    scores = _scores(spark, sf).withColumn("channel", F.when(F.col("channel") == 0, "dapi").otherwise("rna"))
    quality = scores.select("image").distinct().withColumn("quality", F.when(F.col("image") % 2 == 0, 5.0).otherwise(1.0))
    return focus.anchor_plane(scores, quality)


# ---- masks and labels ------------------------------------------------------------------------------

MASK = "v_mask AS MATERIALIZED (SELECT image, channel, z, y, x FROM v_stack WHERE v >= 1000)"
PLANE = ["image", "channel", "z"]


def _mask(spark, sf):
    return V.stack(spark, sf).where("v >= 1000").select(*PLANE, "y", "x")


def _frames(spark, sf):
    return V.stack_rows(spark, sf).select("image", F.lit(8).alias("height"), F.lit(8).alias("width")).distinct()


def dilated_sql(name: str, source: str, radius: float, keys: str, size: int) -> str:
    offsets = ", ".join(str(o) for o in disk(radius))
    return f"""{name} AS MATERIALIZED (SELECT DISTINCT {keys}, y + dy AS y, x + dx AS x FROM {source} CROSS JOIN (VALUES {offsets}) o(dy, dx) WHERE y + dy BETWEEN 0 AND {size - 1} AND x + dx BETWEEN 0 AND {size - 1})"""


def eroded_sql(name: str, source: str, radius: float, keys: str, size: int, everything: str) -> list[str]:
    """What no pixel outside the source reaches."""
    return [
        f"{name}_out AS (SELECT {keys}, y, x FROM {everything} ANTI JOIN {source} USING ({keys}, y, x))",
        dilated_sql(f"{name}_reach", f"{name}_out", radius, keys, size),
        f"{name} AS MATERIALIZED (SELECT {keys}, y, x FROM {everything} ANTI JOIN {name}_reach USING ({keys}, y, x))",
    ]


STACK_PX = "v_all AS (SELECT image, channel, z, y, x FROM v_stack)"
STACKED = ("image, channel, z", 8)
DIL = dilated_sql("v_dil", "v_mask", 1.0, *STACKED)


@check(oracle("SELECT * FROM v_dil", MASK, DIL))
def morph_dilate(spark, sf):
    return labels.morph(_mask(spark, sf), _frames(spark, sf), "dilate", 1.0, PLANE)


@check(oracle("SELECT * FROM v_ero", MASK, STACK_PX, *eroded_sql("v_ero", "v_mask", 1.0, *STACKED, "v_all")))
def morph_erode(spark, sf):
    return labels.morph(_mask(spark, sf), _frames(spark, sf), "erode", 1.0, PLANE)


@check(oracle("SELECT * FROM v_clo", MASK, STACK_PX, DIL, *eroded_sql("v_clo", "v_dil", 1.0, *STACKED, "v_all")))
def morph_close(spark, sf):
    return labels.morph(_mask(spark, sf), _frames(spark, sf), "close", 1.0, PLANE)


WIDE = ("image, channel", 64)


@check(oracle("SELECT * FROM v_opn", "v_wide AS MATERIALIZED (SELECT image, channel, y, x FROM v_pixels WHERE v >= 120)", "v_all AS (SELECT image, channel, y, x FROM v_pixels)",
    *eroded_sql("v_ero", "v_wide", 2.5, *WIDE, "v_all"), dilated_sql("v_opn", "v_ero", 2.5, *WIDE)))
def morph_open(spark, sf):
    wide = V.pixels(spark, sf).where("v >= 120").select("image", "channel", "y", "x")
    return labels.morph(wide, V.images(spark, sf), "open", 2.5, ["image", "channel"])


@check(oracle("SELECT * FROM v_ero", "v_wide AS MATERIALIZED (SELECT image, channel, y, x FROM v_pixels WHERE v >= 2)", "v_all AS (SELECT image, channel, y, x FROM v_pixels)", *eroded_sql("v_ero", "v_wide", 10.0, *WIDE, "v_all")))
def morph_erode_far(spark, sf):
    wide = V.pixels(spark, sf).where("v >= 2").select("image", "channel", "y", "x")
    return labels.morph(wide, V.images(spark, sf), "erode", 10.0, ["image", "channel"])


@check(oracle("SELECT image, channel, z, y, x, component FROM v_comp", MASK).replace("WITH v_images", "WITH RECURSIVE v_images", 1).replace("SELECT image, channel, z, y, x, component FROM v_comp", """, v_reach AS (
  SELECT image, channel, z, y, x, y AS sy, x AS sx FROM v_mask
  UNION SELECT r.image, r.channel, r.z, m.y, m.x, r.sy, r.sx FROM v_reach r JOIN v_mask m ON m.image = r.image AND m.channel = r.channel AND m.z = r.z AND abs(m.y - r.y) <= 1 AND abs(m.x - r.x) <= 1)
SELECT image, channel, z, y, x, min(sy * 2147483648 + sx) AS component FROM v_reach GROUP BY ALL"""))
def components(spark, sf):
    return labels.components(_mask(spark, sf), 8, PLANE)


@check(oracle("SELECT image, y, x, nucleus_id FROM v_labels WHERE nucleus_id % 16 <> 5 AND (SELECT 1) = 1").replace("nucleus_id % 16 <> 5", "nucleus_id <> 5"))
def filter_area(spark, sf):
    # label 5 loses half of its pixels first, which takes it below the size limit
    cut = V.labels(spark, sf).where("nucleus_id <> 5 or x < 8")
    return labels.filter_area(cut, 100, 1000)


@check(oracle("SELECT image, y, x, CASE nucleus_id WHEN 6 THEN 1 WHEN 7 THEN 2 WHEN 10 THEN 3 WHEN 11 THEN 4 END AS nucleus_id FROM v_labels WHERE nucleus_id IN (6, 7, 10, 11)"))
def drop_border(spark, sf):
    return labels.drop_border(V.labels(spark, sf), V.images(spark, sf), 5)


@check(oracle("""
SELECT c.image, c.y, c.x, arg_min(l.nucleus_id, c.d * 100 + l.nucleus_id) AS cyto_id FROM v_cand c JOIN v_lab l ON l.image = c.image AND l.y = c.ly AND l.x = c.lx GROUP BY ALL""",
    "v_lab AS MATERIALIZED (SELECT * FROM v_labels)",
    """v_cand AS MATERIALIZED (SELECT image, y, x, y + jy AS ly, x + jx AS lx, jy * jy + jx * jx AS d FROM v_grid CROSS JOIN (SELECT a.i - 4 AS jy, b.i - 4 AS jx FROM v_side a, v_side b WHERE a.i < 9 AND b.i < 9) WHERE d2 > 36 AND jy * jy + jx * jx <= 16)"""))
def expand_labels(spark, sf):
    return labels.expand_labels(V.labels(spark, sf), V.images(spark, sf), 4)


# masks that smoothing changes: nuclei with notches and spurs, the pixels of which follow from the pixel values
ROUGH = "v_rough AS MATERIALIZED (SELECT g.image, g.y, g.x, g.block AS nucleus_id FROM v_grid g JOIN v_pixels p ON p.image = g.image AND p.y = g.y AND p.x = g.x AND p.channel = 'dapi' WHERE g.d2 <= 49 AND (g.d2 <= 9 OR p.v::BIGINT % 10 > 1))"
LABELLED = ("image, nucleus_id", 64)
SQUARE = "v_sq AS (SELECT image, block AS nucleus_id, g.y, g.x FROM (SELECT DISTINCT image, block FROM v_grid) b JOIN (SELECT DISTINCT image AS i, y, x FROM v_grid) g ON g.i = b.image AND abs(g.y - ((b.block - 1) // 4 * 16 + 8)) <= 14 AND abs(g.x - ((b.block - 1) % 4 * 16 + 8)) <= 14)"


def _rough(spark, sf):
    dapi = V.pixels(spark, sf).where("channel = 'dapi'")
    near = (F.col("y") % 16 - 8) * (F.col("y") % 16 - 8) + (F.col("x") % 16 - 8) * (F.col("x") % 16 - 8)
    kept = dapi.withColumn("d2", near).where("d2 <= 49 AND (d2 <= 9 OR cast(v AS long) % 10 > 1)")
    return kept.select("image", "y", "x", F.expr("(y div 16) * 4 + (x div 16) + 1").alias("nucleus_id"))


@check(oracle("""
SELECT image, y, x, min(nucleus_id) AS nucleus_id FROM v_o s WHERE NOT EXISTS (SELECT 1 FROM v_rough r WHERE r.image = s.image AND r.y = s.y AND r.x = s.x AND r.nucleus_id <> s.nucleus_id) GROUP BY ALL""",
    ROUGH, SQUARE, dilated_sql("v_c1", "v_rough", 2, *LABELLED), *eroded_sql("v_c", "v_c1", 2, *LABELLED, "v_sq"), *eroded_sql("v_o1", "v_c", 2, *LABELLED, "v_sq"), dilated_sql("v_o", "v_o1", 2, *LABELLED)))
def smooth_labels(spark, sf):
    return labels.smooth_labels(_rough(spark, sf), V.images(spark, sf), 2)


NUCLEOLI = ("image, nucleus_id, component", 64)
DARK = """v_dapi AS MATERIALIZED (SELECT l.image, l.nucleus_id, l.y, l.x, p.v FROM v_labels l JOIN v_pixels p USING (image, y, x) WHERE p.channel = 'dapi'),
v_dark AS MATERIALIZED (
  SELECT d.image, d.nucleus_id, d.y, d.x FROM v_dapi d JOIN (SELECT image, nucleus_id, quantile_cont(v, 0.6) AS cut FROM v_dapi GROUP BY ALL) q USING (image, nucleus_id)
  WHERE v <= cut AND (SELECT 1) = 1 AND EXISTS (SELECT 1 FROM v_inner i WHERE i.image = d.image AND i.y = d.y AND i.x = d.x)),
v_walk AS (
  SELECT image, nucleus_id, y, x, y AS sy, x AS sx FROM v_dark
  UNION SELECT r.image, r.nucleus_id, m.y, m.x, r.sy, r.sx FROM v_walk r JOIN v_dark m ON m.image = r.image AND m.nucleus_id = r.nucleus_id AND abs(m.y - r.y) + abs(m.x - r.x) <= 1),
v_part AS MATERIALIZED (SELECT image, nucleus_id, y, x, min(sy * 2147483648 + sx) AS component FROM v_walk GROUP BY ALL),
v_big AS MATERIALIZED (SELECT p.* FROM v_part p SEMI JOIN (SELECT image, nucleus_id, component FROM v_part GROUP BY ALL HAVING count(*) BETWEEN 2 AND 67) USING (image, nucleus_id, component)),
v_cells AS MATERIALIZED (SELECT c.image, c.nucleus_id, c.component, l.y, l.x FROM (SELECT DISTINCT image, nucleus_id, component FROM v_big) c JOIN v_grid l ON l.image = c.image AND abs(l.y - ((c.nucleus_id - 1) // 4 * 16 + 8)) <= 8 AND abs(l.x - ((c.nucleus_id - 1) % 4 * 16 + 8)) <= 8)"""


@check(oracle("SELECT DISTINCT image, y, x, nucleus_id AS nucleolus_id FROM v_clo SEMI JOIN v_labels USING (image, nucleus_id, y, x)",
    "v_px AS (SELECT image, y, x FROM v_labels)", "v_every AS (SELECT image, y, x FROM v_grid)", *eroded_sql("v_inner", "v_px", 1, "image", 64, "v_every"), DARK,
    dilated_sql("v_cd", "v_big", 1, *NUCLEOLI), *eroded_sql("v_clo", "v_cd", 1, *NUCLEOLI, "v_cells")).replace("WITH v_images", "WITH RECURSIVE v_images", 1))
def detect_nucleoli(spark, sf):
    rows = V.pixel_rows(spark, sf).where("channel = 'dapi'").drop("channel", "z")
    return labels.detect_nucleoli(rows, V.labels(spark, sf), V.images(spark, sf), pct=60.0, min_um2=0.03, closing=1, border=1)


OTSU = """v_f AS (SELECT image, v FROM v_pixels WHERE channel = 'dapi'),
v_b AS (SELECT image, min(v) AS lo, (max(v) - min(v)) / 256 AS width FROM v_f GROUP BY ALL),
v_h AS (SELECT image, least(255, floor((v - lo) / width)) AS slot, count(*) AS c, any_value(lo) AS lo, any_value(width) AS width FROM v_f JOIN v_b USING (image) GROUP BY ALL),
v_w AS (
  SELECT image, slot, lo + (slot + 0.5) * width AS centre, sum(c) OVER lower AS w1, sum(c * (lo + (slot + 0.5) * width)) OVER lower AS m1, sum(c) OVER upper AS w2, sum(c * (lo + (slot + 0.5) * width)) OVER upper AS m2 FROM v_h
  WINDOW lower AS (PARTITION BY image ORDER BY slot), upper AS (PARTITION BY image ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
v_cut AS (SELECT image, centre AS thr FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY round(w1::DOUBLE * w2 * pow(m1 / w1 - m2 / w2, 2), 6) DESC, slot) AS rn FROM v_w WHERE w2 > 0) WHERE rn = 1),
v_on AS MATERIALIZED (SELECT p.image, p.y, p.x FROM v_pixels p JOIN v_cut USING (image) WHERE channel = 'dapi' AND v > thr),
v_walk AS (
  SELECT image, y, x, y AS sy, x AS sx FROM v_on o  -- the first pixel of a component has none above it or to its left
  WHERE NOT EXISTS (SELECT 1 FROM v_on a WHERE a.image = o.image AND (a.y = o.y AND a.x = o.x - 1)) AND NOT EXISTS (SELECT 1 FROM v_on a WHERE a.image = o.image AND a.y = o.y - 1 AND a.x = o.x)
  UNION SELECT r.image, m.y, m.x, r.sy, r.sx FROM v_walk r JOIN v_on m ON m.image = r.image AND abs(m.y - r.y) + abs(m.x - r.x) <= 1),
v_found AS MATERIALIZED (SELECT image, y, x, min(sy * 2147483648 + sx) AS id FROM v_walk GROUP BY ALL),
v_keep AS (
  SELECT image, id, row_number() OVER (PARTITION BY image ORDER BY id) AS nucleus_id FROM (SELECT image, id, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1, count(*) AS n FROM v_found GROUP BY ALL)
  WHERE n >= 20 AND y0 >= 1 AND x0 >= 1 AND y1 + 1 <= 63 AND x1 + 1 <= 63)"""


@check(oracle("SELECT image, y, x, nucleus_id FROM v_found JOIN v_keep USING (image, id)", OTSU).replace("WITH v_images", "WITH RECURSIVE v_images", 1))
def otsu_labels(spark, sf):
    dapi = V.pixels(spark, sf).where("channel = 'dapi'").select("image", "y", "x", "v")
    return labels.otsu_labels(dapi, V.images(spark, sf), min_px=20, margin=1)


MOMENTS = "(SELECT image, nucleus_id, count(*) AS area_px, avg(y) AS cy, avg(x) AS cx, var_pop(y) + 1.0::DOUBLE / 12 AS vy, var_pop(x) + 1.0::DOUBLE / 12 AS vx, covar_pop(y, x) AS c FROM v_labels GROUP BY ALL)"


@check(oracle(f"""
SELECT image, nucleus_id, area_px, round(area_px * 0.0169::DOUBLE, 6) AS area_um2, cy AS centroid_y, cx AS centroid_x, round(4 * sqrt((vy + vx + sqrt((vy - vx) * (vy - vx) + 4 * c * c)) / 2) * 0.13::DOUBLE, 6) AS major_axis_um,
       round(4 * sqrt((vy + vx - sqrt((vy - vx) * (vy - vx) + 4 * c * c)) / 2) * 0.13::DOUBLE, 6) AS feret_min_um FROM {MOMENTS}"""))
def morphology(spark, sf):
    out = labels.morphology(V.labels(spark, sf)).select("image", "nucleus_id", "area_px", "area_um2", "centroid_y", "centroid_x", "major_axis_um", "feret_min_um")
    return rounded(out, 6, "area_um2", "major_axis_um", "feret_min_um")


@check()
def morphology_shape(spark, sf):
    return labels.morphology(V.labels(spark, sf))


@check()
def detect_spots(spark, sf):
    rows = V.pixel_rows(spark, sf).where("channel <> 'dapi'")
    return sampling.detect_spots(rows, sigma=1.0, threshold=150.0)


@check(oracle("SELECT image, channel, z, y, x, v FROM v_stack"))
def flat_pixels(spark, sf):
    return frames.flat(V.stack_rows(spark, sf))


SPECK = """v_sp AS MATERIALIZED (SELECT (image * 2 + channel) * 5 + z AS image, y, x, v FROM v_stack),
v_sm AS (SELECT image, any_value(med) AS med, median(abs(v - med)) AS mad FROM v_sp JOIN (SELECT image, median(v) AS med FROM v_sp GROUP BY ALL) USING (image) GROUP BY ALL)"""


@check(oracle("SELECT image, y, x, CASE WHEN v > med + 1.4826 * 2 * mad THEN med ELSE v END AS v FROM v_sp JOIN v_sm USING (image)", SPECK))
def mask_specks(spark, sf):
    plane = V.stack(spark, sf).select(((F.col("image") * 2 + F.col("channel")) * 5 + F.col("z")).alias("image"), "y", "x", "v")  # every plane
    return specks.mask_specks(plane, 1, k=2.0)[0].select("image", "y", "x", "v")


@check(oracle("""
SELECT s.image * 2 + s.channel AS image, s.channel, s.y, s.x, max(v) AS v FROM v_st s JOIN (
  SELECT image, greatest(lo, least(z - 1, hi - 1)) AS a FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, z) AS rn FROM (
    SELECT *, min(z) OVER (PARTITION BY image) AS lo, max(z) OVER (PARTITION BY image) AS hi FROM v_se) WHERE z BETWEEN lo + 1 AND hi - 2) WHERE rn = 1) w
ON w.image = s.image * 2 + s.channel AND s.z BETWEEN w.a AND w.a + 1 GROUP BY ALL""", NEAR, EACH))
def windowed_max(spark, sf):
    return specks.windowed_max(_each(V.stack_rows(spark, sf)), _each(_scores(spark, sf)))


@check(oracle("SELECT image, nucleus_id, channel, area_px, n_spots, nuclear_spots, cyto_spots, paired_count FROM v_nuc"))
def run_mode_rna_rna(spark, sf):
    inputs = {"spots": V.spots(spark, sf), "labels": V.labels(spark, sf), "cyto": V.cyto(spark, sf), "images": V.images(spark, sf), "plane_rows": V.pixel_rows(spark, sf)}
    out = modes.run_mode("rna_rna", inputs)["nuclei_metrics"]
    return out.select("image", "nucleus_id", "channel", "area_px", "n_spots", "nuclear_spots", "cyto_spots", "paired_count")


@check(oracle("SELECT image, n_nuclei, n_spots FROM (SELECT n.image, count(*) AS n_nuclei, sum(n.n_spots) AS n_spots FROM v_nuc n JOIN v_images i USING (image) WHERE n.channel = 'rna1' AND NOT i.secondary_only GROUP BY ALL)"))
def run_mode_rna_only(spark, sf):
    im = V.images(spark, sf)
    inputs = {"spots": V.spots(spark, sf), "labels": V.labels(spark, sf), "cyto": V.cyto(spark, sf), "images": im}
    nuclei = modes.run_mode("rna_only", inputs)["nuclei_metrics"]
    return nuclei.join(im.where("not secondary_only").select("image"), "image").groupBy("image").agg(F.count(F.lit(1)).alias("n_nuclei"), F.sum("n_spots").alias("n_spots"))


ONE_CHANNEL = "SELECT image, n_nuclei, n_spots FROM (SELECT n.image, count(*) AS n_nuclei, sum(n.n_spots) AS n_spots FROM v_nuc n JOIN v_images i USING (image) WHERE n.channel = 'rna1' AND NOT i.secondary_only GROUP BY ALL)"


def _one_channel(name):
    def run(spark, sf):
        im = V.images(spark, sf)
        inputs = {"spots": V.spots(spark, sf), "labels": V.labels(spark, sf), "cyto": V.cyto(spark, sf), "images": im}
        nuclei = modes.run_mode(name, inputs)["nuclei_metrics"]
        return nuclei.join(im.where("not secondary_only").select("image"), "image").groupBy("image").agg(F.count(F.lit(1)).alias("n_nuclei"), F.sum("n_spots").alias("n_spots"))

    run.__name__ = f"run_mode_{name}"
    return run


for _name in ("ab_ab", "protein_only", "pub_images"):
    check(oracle(ONE_CHANNEL))(_one_channel(_name))


@check(oracle("SELECT image, nucleus_id, CASE channel WHEN 'rna2' THEN 'protein' ELSE channel END AS channel, area_px, n_spots, nuclear_spots, cyto_spots, paired_count FROM v_nuc"))
def run_mode_rna_protein(spark, sf):
    inputs = {"spots": V.spots(spark, sf), "labels": V.labels(spark, sf), "cyto": V.cyto(spark, sf), "images": V.images(spark, sf), "plane_rows": V.pixel_rows(spark, sf)}
    out = modes.run_mode("rna_protein", inputs)["nuclei_metrics"]
    return out.select("image", "nucleus_id", "channel", "area_px", "n_spots", "nuclear_spots", "cyto_spots", "paired_count")
