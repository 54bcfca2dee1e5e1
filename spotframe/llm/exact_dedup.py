"""Exact duplicates: group by a 128-bit content hash, then compare bytes inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from spotframe.llm.common import ascii_lower, save, text_or_empty


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = ascii_lower,
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row per input row.

    Two texts are equal when their normalised bytes are. Rows meet under a 128-bit hash; inside a
    hash group the texts themselves are the second grouping key, so a collision splits a group and
    never merges two texts. Copies are collapsed in the map-side half of that grouping, so a text
    that makes up a third of the table costs one row per task in the shuffle.

    keep: "smallest" or "largest" id of a group stays. Defined cases: a null text counts as empty, so
    null and empty texts form one group; a null id never stays before a non-null one, and a group
    of null ids only keeps null (kept is then true); rows repeating both id and text all count in
    group_size and share `kept`; an empty table gives no rows; other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    norm = normalise(text_or_empty(F.col(text_col)))
    source = docs.select(F.col(id_col).alias("_id"), norm.alias("_norm"))
    # sha2 and the grouping hash share the normalised text: it is computed once per row
    hashed = source.select("_id", "_norm", content_hash(F.col("_norm")).alias("_h"))
    rows = save(hashed.select("_id", "_h", F.sha2(F.col("_norm"), 256).alias("text_sha256")))
    best = F.min("_id") if keep == "smallest" else F.max("_id")
    texts = hashed.groupBy("_h", "_norm").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = save(texts.select("_h", F.sha2(F.col("_norm"), 256).alias("text_sha256"), "keep_id", "group_size"))
    collided = groups.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_h")
    plain = rows.join(groups.drop("text_sha256"), "_h")
    if not collided.isEmpty():
        # different texts under one hash: those rows meet their group by the bytes as well
        inside = texts.join(collided, "_h", "left_semi").select("_h", "_norm", "keep_id", "group_size")
        exact = hashed.join(inside, ["_h", "_norm"]).select("_id", "_h", F.sha2(F.col("_norm"), 256).alias("text_sha256"), "keep_id", "group_size")
        plain = plain.join(collided, "_h", "left_anti").unionByName(exact)
    return plain.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


OP8_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
