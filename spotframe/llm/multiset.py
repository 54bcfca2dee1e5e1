"""Document fingerprints: a homomorphic multiset hash of paragraphs, with lanes that also measure likeness.

Every paragraph is hashed to a wide vector and the vectors of a document are added lane by lane:

* 16 lanes modulo 2**62 decide equality. They depend on which paragraphs there are and how often, not on
  their order. A lane of a paragraph comes from its SHA-256 digest, so two different paragraphs
  agree only where SHA-256 or all lanes collide.
* 64 lanes modulo 2**32 count, over the sentences of the paragraph, one bit each of a 64-bit hash. Twice the
  count less the number of sentences is a sum of signs, so the squared distance of two such
  vectors estimates how many sentences two documents do not share.
* one lane counts the sentences and one the characters.

Adding the vector of a paragraph inserts it and subtracting deletes it. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.llm.common import text_or_empty

LANES = 16
MODULUS = (1 << 62) - 1
#: Two counts of 32 bits are kept in one long: bit k of the hash and bit k + 32.
PAIR = 0x0000000100000001
SIGNS = 32
PARAGRAPH_SQL = r"\n"
#: A sentence ends at its full stop and space, or with its paragraph.
SENTENCE_SQL = r"\n|\\. "
#: Documents per bucket of neighbours.
BUCKET_ROWS = 1000


def fingerprint_columns(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds <prefix>lanes (equality) and <prefix>signs (counted bits, then the number of sentences) of column `text`.

    Each is one fold over the paragraphs or sentences: the digest of an element is computed once and added to
    all lanes.
    """
    equality = (
        f"aggregate(transform(split({text}, '{PARAGRAPH_SQL}'), p -> sha2(p, 256)), array_repeat(0L, {LANES}), (acc, d) -> "
        f"zip_with(acc, sequence(0, {LANES - 1}), (a, k) -> (a + (xxhash64(k, d) & {MODULUS}L)) & {MODULUS}L))"
    )
    bits = (
        f"aggregate(transform(filter(split({text}, '{SENTENCE_SQL}'), s -> s != ''), s -> xxhash64(s)), array_repeat(0L, {SIGNS + 1}), (acc, h) -> "
        f"zip_with(acc, sequence(0, {SIGNS}), (a, k) -> a + if(k = {SIGNS}, 1L, shiftrightunsigned(h, k) & {PAIR}L)))"
    )
    return df.withColumn(f"{prefix}lanes", F.expr(equality)).withColumn(f"{prefix}signs", F.expr(bits))


def as_text(lanes: Column, signs: Column, chars: Column) -> Column:
    """The vector as fixed-width lowercase hex, lane after lane."""
    wide = F.transform(F.concat(lanes, signs, F.array(chars)), lambda v: F.lpad(F.lower(F.hex(v)), 16, "0"))
    return F.array_join(wide, "")


def likeness(a_signs: Column, b_signs: Column) -> Column:
    """Estimated share of common sentences, 0 to 1, from two sign vectors.

    The mean square of (sum of signs of a - sum of signs of b) over the lanes estimates the squared
    distance D of the two multisets, and the squares of each side its squared length; 1 - D / (|a|^2 + |b|^2),
    held inside 0 and 1. Two texts without sentences are alike; one of them is like nothing else.
    """

    def lanes(signs: Column) -> Column:
        units = F.element_at(signs, -1)
        pairs = F.slice(signs, 1, SIGNS)
        low = F.transform(pairs, lambda v: 2 * v.bitwiseAND(F.lit(0xFFFFFFFF)) - units)
        high = F.transform(pairs, lambda v: 2 * F.shiftrightunsigned(v, 32) - units)
        return F.concat(low, high)

    zero = F.struct(F.lit(0.0).alias("apart"), F.lit(0.0).alias("both"))
    sums = F.aggregate(
        F.zip_with(lanes(a_signs), lanes(b_signs), lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))),
        zero,
        lambda acc, v: F.struct(
            (acc["apart"] + (v["x"] - v["y"]) * (v["x"] - v["y"])).alias("apart"),
            (acc["both"] + v["x"] * v["x"] + v["y"] * v["y"]).alias("both"),
        ),
        lambda acc: F.when(acc["both"] > 0, 1 - acc["apart"] / acc["both"]),
    )
    empty = (F.element_at(a_signs, -1) == 0) & (F.element_at(b_signs, -1) == 0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(sums, F.when(empty, 1.0).otherwise(0.0))))


def neighbours(docs: DataFrame, id_col: str, columns: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs plus `_next`, a struct of `columns` of the document after it in descending id order; the last meets the first.

    Documents are cut into buckets of consecutive ids at approximate quantiles, and every bucket also gets
    a copy of the document that follows it, so the order is never sorted as a whole. `prepare` adds columns to the
    rows and the copies. Rows of equal id follow each other in the order of `columns`; null ids come last. Beyond
    4096 buckets of `bucket_rows` the buckets grow; their sort spills.
    """
    key = F.col(id_col)
    facts = docs.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("known")).first()
    bins = max(1, min(4096, -(-facts["n"] // bucket_rows)))
    cuts = docs.agg(F.percentile_approx(key, [i / bins for i in range(1, bins)], 100 * bins)).first()[0] if bins > 1 and facts["known"] else []
    cuts = sorted(set(cuts or []))
    # a bucket is the number of cuts below the id: found by a binary search over literal bounds
    bucket = F.when(key.isNull(), F.lit(-1)).otherwise(_bucket(key, cuts))
    placed = docs.withColumn("_bucket", bucket).withColumn("_ghost", F.lit(0))
    tops = placed.groupBy("_bucket").agg(F.max(id_col).alias("_top")).collect()  # one row per bucket, 4097 at most
    order = sorted(tops, key=lambda r: r["_bucket"])
    if not order:
        return prepare(docs).withColumn("_next", F.struct(*[F.col(c) for c in columns]))
    follows = {order[i]["_bucket"]: (order[i - 1]["_bucket"], order[i - 1]["_top"]) for i in range(len(order))}
    table = [(to, below, top) for to, (below, top) in follows.items()]
    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(table, f"_to int, _in int, _top {kind}")
    ghosts = (
        placed.join(F.broadcast(wanted), (F.col("_bucket") == F.col("_in")) & key.eqNullSafe(F.col("_top")))
        .select(*docs.columns, F.col("_to").alias("_bucket"), F.lit(1).alias("_ghost"))
    )
    window = Window.partitionBy("_bucket").orderBy("_ghost", key.desc_nulls_last(), *[F.col(c) for c in columns])
    following = F.lead(F.struct(*[F.col(c) for c in columns])).over(window)
    return prepare(placed.unionByName(ghosts)).withColumn("_next", following).where(F.col("_ghost") == 0).drop("_bucket", "_ghost")


def _bucket(key: Column, cuts: list) -> Column:
    """How many cuts lie below the value; nested halves keep it at log2(len(cuts)) comparisons."""
    if not cuts:
        return F.lit(0)

    def half(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= F.lit(cuts[mid]), half(lo, mid)).otherwise(half(mid + 1, hi))

    return half(0, len(cuts))


def insert(a: Column, b: Column) -> Column:
    """Equality lanes of two documents' paragraphs taken together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MODULUS)))


def delete(a: Column, b: Column) -> Column:
    """Equality lanes of a without the paragraphs of b, which it contains."""
    return F.zip_with(a, b, lambda x, y: F.when(x >= y, x - y).otherwise(x - y + F.lit(MODULUS) + 1))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per document.

    The edited text is the document with its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document in descending id order; after the last comes the first.

    Defined cases: null texts count as empty; a single document is its own next one; null ids come last and
    are ordered by text, as are rows that repeat an id; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    near = neighbours(rows, "_id", ["_text", "own_signs"], lambda df: fingerprint_columns(df, "_text", "own_"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = near.withColumn("n_chars", F.char_length("_text").cast("long")).select(
        "_id",
        "n_chars",
        F.concat(F.left("_text", F.col("n_chars").cast("int") - half), F.left(F.col("_next._text"), half)).alias("_edited"),
        "own_lanes",
        "own_signs",
        F.col("_next.own_signs").alias("next_signs"),
    )
    return fingerprint_columns(edited, "_edited", "new_").select(
        F.col("_id").alias(id_col),
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_text(F.col("own_lanes"), F.col("own_signs"), F.col("n_chars")).alias("fingerprint"),
        as_text(F.col("new_lanes"), F.col("new_signs"), F.char_length("_edited").cast("long")).alias("edited_fingerprint"),
        likeness(F.col("own_signs"), F.col("new_signs")).alias("near_edited"),
        likeness(F.col("own_signs"), F.col("next_signs")).alias("near_next"),
    )
