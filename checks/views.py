"""Spatial tables derived from the given tables: one set for Spark, the same set as SQL for DuckDB.

An image is a supplier, its spots are that supplier's line items, nuclei are disks on a 16-pixel grid
of a 64 x 64 frame, and image stacks are cut from the embedding vectors.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

SIZE = 64


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def images(spark: SparkSession, sf: str) -> DataFrame:
    # a frame expands to thousands of rows: spread the images before that happens
    sec = F.col("s_suppkey") % 5 == 0
    return table(spark, sf, "supplier").repartition(2 * spark.sparkContext.defaultParallelism, "s_suppkey").select(
        F.col("s_suppkey").alias("image"),
        sec.alias("secondary_only"),
        F.when(sec, "SEC").when(F.col("s_suppkey") % 2 == 0, "WT").otherwise("KO").alias("condition"),
        F.lit(0.13).alias("voxel_xy_um"),
        F.lit(0.3).alias("voxel_z_um"),
        F.lit(SIZE).alias("height"),
        F.lit(SIZE).alias("width"),
    )


def spots(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("image"),
        F.when(F.col("l_linestatus") == "O", "rna1").otherwise("rna2").alias("channel"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 2097152 + F.col("l_partkey")).alias("spot_id"),
        (F.col("l_partkey") * 7 % SIZE).alias("x_px"),
        (F.col("l_orderkey") * 13 % SIZE).alias("y_px"),
        F.col("l_linenumber").alias("z_slice"),
        F.col("l_extendedprice").alias("peak"),
        (F.col("l_quantity") / 100.0 + 0.1).alias("diameter_um"),
    )


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    side = F.sequence(F.lit(0).cast("long"), F.lit(SIZE - 1).cast("long"))
    rows = images(spark, sf).select("image", F.explode(side).alias("y"))
    return rows.select("image", "y", F.explode(side).alias("x"))


def _d2():
    dy, dx = F.col("y") % 16 - 8, F.col("x") % 16 - 8
    return dy * dy + dx * dx


def _block():
    return F.expr("(y div 16) * 4 + (x div 16) + 1")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return _grid(spark, sf).where(_d2() <= 36).select("image", "y", "x", _block().alias("nucleus_id"))


def cyto(spark: SparkSession, sf: str) -> DataFrame:
    return _grid(spark, sf).where((_d2() > 36) & (_d2() <= 64)).select("image", "y", "x", _block().alias("cyto_id"))


def nucleoli(spark: SparkSession, sf: str) -> DataFrame:
    return _grid(spark, sf).where(_d2() <= 4).select("image", "y", "x", _block().alias("nucleolus_id"))


def _disk_rows(spark: SparkSession, sf: str, inside: str):
    """Label rows (image, y, ids): the nucleus number of each pixel for which `inside` holds of its d2, else 0."""
    side = F.sequence(F.lit(0).cast("long"), F.lit(SIZE - 1).cast("long"))
    d2 = "(y % 16 - 8) * (y % 16 - 8) + (x % 16 - 8) * (x % 16 - 8)"
    ids = F.expr(f"transform(sequence(0L, 63L), x -> if({inside.replace('d2', d2)}, (y div 16) * 4 + (x div 16) + 1, 0L))")
    return images(spark, sf).select("image", F.explode(side).alias("y")).select("image", "y", ids.alias("ids"))


def label_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _disk_rows(spark, sf, "d2 <= 36")


def cyto_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _disk_rows(spark, sf, "d2 > 36 AND d2 <= 64")


def nucleoli_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _disk_rows(spark, sf, "d2 <= 4")


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    channel = F.element_at(F.array(F.lit("dapi"), F.lit("rna1"), F.lit("rna2")), F.col("c") + 1)
    base = (F.col("image") * 7919 + F.col("c").cast("long") * 104729 + F.col("y") * 1299709 + F.col("x") * 15485863) % 997
    inside = F.when(_d2() <= 36, 1000).otherwise(0)
    return (
        _grid(spark, sf)
        .select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("c"))
        .select("image", channel.alias("channel"), "y", "x", (base + inside).cast("double").alias("v"))
    )


def pixel_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same values as ``pixels``, one array per image row."""
    side = F.sequence(F.lit(0).cast("long"), F.lit(SIZE - 1).cast("long"))
    rows = (
        images(spark, sf)
        .select("image", F.explode(side).alias("y"))
        .select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("c"))
    )
    channel = F.element_at(F.array(F.lit("dapi"), F.lit("rna1"), F.lit("rna2")), F.col("c") + 1)
    vals = F.expr(
        "transform(sequence(0L, 63L), x -> cast((image * 7919 + cast(c as long) * 104729 + y * 1299709 + x * 15485863) % 997"
        " + if((y % 16 - 8) * (y % 16 - 8) + (x % 16 - 8) * (x % 16 - 8) <= 36, 1000, 0) as double))"
    )
    return rows.select("image", channel.alias("channel"), F.lit(0).alias("z"), "y", vals.alias("vals"))


def stack_rows(spark: SparkSession, sf: str) -> DataFrame:
    """8 x 8 stacks of two channels and five slices: (image, channel, z, y, vals)."""
    vec = table(spark, sf, "embeddings").select(
        F.expr("vec_id div 10").alias("image"),
        F.expr("cast((vec_id % 10) div 5 as int)").alias("channel"),
        F.expr("cast(vec_id % 5 as int)").alias("z"),
        F.expr("transform(embedding, e -> floor((cast(e as double) + 1.0D) * 1000))").alias("e"),
    )
    return vec.select(
        "image", "channel", "z", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("y"), "e"
    ).select("image", "channel", "z", "y", F.expr("transform(slice(e, cast(y as int) * 8 + 1, 8), v -> cast(v as double))").alias("vals"))


def stack(spark: SparkSession, sf: str) -> DataFrame:
    return stack_rows(spark, sf).select("image", "channel", "z", "y", F.posexplode("vals").alias("x", "v")).withColumn("x", F.col("x").cast("long"))


def plate(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.alias("well"),
        F.when(k % 2 == 0, "WT").otherwise("KO").alias("genotype"),
        F.when(k % 5 == 0, "seconly").otherwise("primary").alias("arm"),
        F.when(k % 3 == 0, "568").otherwise("647").alias("secondary"),
        F.when(k % 3 == 0, "561").otherwise("640").alias("channel"),
    )


def fov(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("well"), (F.col("l_orderkey") % 8).alias("fov"))
        .agg(
            F.avg("l_extendedprice").alias("qki_mean"),
            F.avg("l_quantity").alias("dapi_mean"),
            F.count(F.lit(1)).alias("nucleus_count"),
            F.min("l_tax").alias("exp_qki_s"),
        )
    )


def listing(spark: SparkSession, sf: str) -> DataFrame:
    cond = F.lower("condition")
    return images(spark, sf).select(
        F.concat(F.lit("/data/Folder_"), cond, F.lit("/"), F.when(F.col("image") % 11 == 0, "_").otherwise(""), F.lit("img_"), F.col("image").cast("string"), F.when(F.col("image") % 7 == 0, ".txt").otherwise(".tif")).alias("path"),
        (F.col("image") * 37 % 2000).alias("length"),
    )


# The same views for DuckDB; v_nuc is the per-nucleus table that several checks start from.
PRELUDE = """
WITH v_images AS (
  SELECT s_suppkey AS image, s_suppkey % 5 = 0 AS secondary_only,
         CASE WHEN s_suppkey % 5 = 0 THEN 'SEC' WHEN s_suppkey % 2 = 0 THEN 'WT' ELSE 'KO' END AS condition,
         0.13::DOUBLE AS voxel_xy_um, 0.3::DOUBLE AS voxel_z_um, 64 AS height, 64 AS width FROM supplier),
v_spots AS (
  SELECT l_suppkey AS image, CASE WHEN l_linestatus = 'O' THEN 'rna1' ELSE 'rna2' END AS channel,
         (l_orderkey * 8 + l_linenumber) * 2097152 + l_partkey AS spot_id,
         l_partkey * 7 % 64 AS x_px, l_orderkey * 13 % 64 AS y_px, l_linenumber AS z_slice,
         l_extendedprice AS peak, l_quantity / 100.0::DOUBLE + 0.1::DOUBLE AS diameter_um FROM lineitem),
v_side AS (SELECT unnest(range(64)) AS i),
v_grid AS (
  SELECT image, a.i AS y, b.i AS x, (a.i % 16 - 8) * (a.i % 16 - 8) + (b.i % 16 - 8) * (b.i % 16 - 8) AS d2,
         (a.i // 16) * 4 + (b.i // 16) + 1 AS block FROM v_images, v_side a, v_side b),
v_labels AS (SELECT image, y, x, block AS nucleus_id FROM v_grid WHERE d2 <= 36),
v_cyto AS (SELECT image, y, x, block AS cyto_id FROM v_grid WHERE d2 > 36 AND d2 <= 64),
v_nucleoli AS (SELECT image, y, x, block AS nucleolus_id FROM v_grid WHERE d2 <= 4),
v_pixels AS (
  SELECT image, ch.channel, y, x,
         ((image * 7919 + ch.c * 104729 + y * 1299709 + x * 15485863) % 997 + CASE WHEN d2 <= 36 THEN 1000 ELSE 0 END)::DOUBLE AS v
  FROM v_grid, (VALUES (0, 'dapi'), (1, 'rna1'), (2, 'rna2')) ch(c, channel)),
v_stack AS (
  SELECT vec_id // 10 AS image, (vec_id % 10) // 5 AS channel, vec_id % 5 AS z, pos // 8 AS y, pos % 8 AS x,
         floor((embedding[pos + 1]::DOUBLE + 1.0::DOUBLE) * 1000) AS v
  FROM embeddings, (SELECT unnest(range(64)) AS pos)),
v_plate AS (
  SELECT s_suppkey AS well, CASE WHEN s_suppkey % 2 = 0 THEN 'WT' ELSE 'KO' END AS genotype,
         CASE WHEN s_suppkey % 5 = 0 THEN 'seconly' ELSE 'primary' END AS arm,
         CASE WHEN s_suppkey % 3 = 0 THEN '568' ELSE '647' END AS secondary,
         CASE WHEN s_suppkey % 3 = 0 THEN '561' ELSE '640' END AS channel FROM supplier),
v_fov AS (
  SELECT l_suppkey AS well, l_orderkey % 8 AS fov, avg(l_extendedprice) AS qki_mean, avg(l_quantity) AS dapi_mean,
         count(*) AS nucleus_count, min(l_tax) AS exp_qki_s FROM lineitem GROUP BY ALL),
v_listing AS (
  SELECT '/data/Folder_' || lower(condition) || '/' || CASE WHEN image % 11 = 0 THEN '_' ELSE '' END || 'img_' || image
         || CASE WHEN image % 7 = 0 THEN '.txt' ELSE '.tif' END AS path, image * 37 % 2000 AS length FROM v_images),
v_strat AS (
  SELECT s.*, coalesce(l.nucleus_id, c.cyto_id, 0) AS nucleus_id, l.nucleus_id IS NOT NULL AS in_nucleus,
         l.nucleus_id IS NULL AND c.cyto_id IS NOT NULL AS in_cytoplasm
  FROM v_spots s LEFT JOIN v_labels l ON s.image = l.image AND s.y_px = l.y AND s.x_px = l.x
  LEFT JOIN v_cyto c ON s.image = c.image AND s.y_px = c.y AND s.x_px = c.x),
v_area AS (SELECT image, nucleus_id, count(*) AS area_px FROM v_labels GROUP BY ALL),
v_pos AS (SELECT DISTINCT image, channel, x_px, y_px, z_slice FROM v_spots),
v_nn AS (
  SELECT a.image, a.channel, a.x_px, a.y_px, a.z_slice,
         min(sqrt(((a.x_px * 0.13::DOUBLE) - (b.x_px * 0.13::DOUBLE)) * ((a.x_px * 0.13::DOUBLE) - (b.x_px * 0.13::DOUBLE))
           + ((a.y_px * 0.13::DOUBLE) - (b.y_px * 0.13::DOUBLE)) * ((a.y_px * 0.13::DOUBLE) - (b.y_px * 0.13::DOUBLE))
           + ((a.z_slice * 0.3::DOUBLE) - (b.z_slice * 0.3::DOUBLE)) * ((a.z_slice * 0.3::DOUBLE) - (b.z_slice * 0.3::DOUBLE)))) AS nn
  FROM v_pos a JOIN v_pos b ON a.image = b.image AND a.channel <> b.channel GROUP BY ALL),
v_full AS (
  SELECT s.*, n.nn AS nn_distance_um, CASE WHEN n.nn <= 0.3::DOUBLE THEN 1 ELSE 0 END AS paired
  FROM v_strat s LEFT JOIN v_nn n USING (image, channel, x_px, y_px, z_slice)),
v_nuc AS (
  SELECT a.image, a.nucleus_id, a.area_px, ch.channel, count(s.spot_id) AS n_spots,
         coalesce(sum(s.in_nucleus::INT), 0) AS nuclear_spots, coalesce(sum(s.in_cytoplasm::INT), 0) AS cyto_spots,
         avg(s.peak) AS mean_peak, sum(s.peak) AS total_peak, median(s.peak) AS median_peak,
         median(s.nn_distance_um) AS median_nn_um, coalesce(sum(s.paired), 0) AS paired_count,
         stddev_samp(s.peak) / avg(s.peak) AS peak_cv
  FROM v_area a CROSS JOIN (VALUES ('rna1'), ('rna2')) ch(channel)
  LEFT JOIN v_full s ON s.image = a.image AND s.nucleus_id = a.nucleus_id AND s.channel = ch.channel
  GROUP BY ALL),
v_one AS (
  SELECT n.image, n.nucleus_id, i.condition, i.secondary_only, n.n_spots, n.nuclear_spots, n.mean_peak, ln(n.total_peak) AS log_total_peak,
         n.nuclear_spots / nullif(n.n_spots, 0) AS nuclear_spot_fraction
  FROM v_nuc n JOIN v_images i USING (image) WHERE n.channel = 'rna1')
"""


def oracle(body: str, *ctes: str) -> str:
    """A full query: the shared views, further named steps, then ``body``."""
    extra = "".join(f", {c.strip()}" for c in ctes)
    return f"{PRELUDE.strip()}{extra}\n{body.strip()}"
