"""Importance resampling towards a target: scores from an array of bucket gains, then an exact distributed selection.

A text's features are its runs of one to three words. A feature falls into the bucket that its CRC-32
names, and a bucket's gain says how much more often the target has it than the corpus. Weights are sums
of gains looked up in an array. The cut-off among the scores is found by a weighted median of medians over
partitions, and only the winners are sorted.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spotframe.llm.common import SQL_CRC_STEPS, numbered, save, small_batches, sql_crc

#: A-Z to a-z; ASCII characters other than letters and digits part words. Bytes of longer characters stay.
SPOKEN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of text that are cut into words at a time.
PORTION = 4_000_000
#: Words up to so many bytes have their checksum computed side by side.
SHORT = 64


@functools.lru_cache(maxsize=1)
def _checksum_tables() -> tuple[np.ndarray, np.ndarray]:
    """(one byte more, so many zero bytes more): CRC-32 as table look-ups.

    A checksum is linear over bits, so what `n` more bytes make of it is the sum of what they make of its
    four bytes: the second table holds that at [n * 1024 + place * 256 + byte].
    """
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    bits = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    moved = [bits]
    for _ in range(SHORT):
        last = moved[-1]
        moved.append(step[last & 255] ^ (last >> 8))
    return step, np.concatenate(moved)


def _moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """What checksums become by so many zero bytes more."""
    _, moved = _checksum_tables()
    left = by
    while True:
        at = np.minimum(left, SHORT) * 1024
        crc = moved[at + (crc & 255)] ^ moved[at + 256 + ((crc >> 8) & 255)] ^ moved[at + 512 + ((crc >> 16) & 255)] ^ moved[at + 768 + (crc >> 24)]
        left = np.maximum(left - SHORT, 0)
        if not left.any():
            return crc


def features(texts: list[bytes | None], longest: int = 3) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(n, text, value): for n = 0 the number of words of every text, then the CRC-32 of every run of n = 1 .. longest words.

    texts are bytes of UTF-8, None counts as empty; the words of a run are joined by one space.
    """
    step, _ = _checksum_tables()
    joined = b" ".join(t or b"" for t in texts).translate(SPOKEN)
    edges = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    line = np.frombuffer(joined + b" ", np.uint8)
    word = np.concatenate(([False], line != 32))
    turns = np.flatnonzero(word[1:] != word[:-1])
    start, size = turns[::2], turns[1::2] - turns[::2]
    text = np.searchsorted(edges, start, "right") - 1
    yield 0, np.arange(len(texts)), np.bincount(text, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    here = np.flatnonzero(size <= SHORT)
    for j in range(int(size[here].max(initial=0))):
        here = here[size[here] > j]
        now = crc[here]
        crc[here] = step[(now ^ line[start[here] + j]) & 255] ^ (now >> 8)
    crc ^= 0xFFFFFFFF
    for i in np.flatnonzero(size > SHORT):
        crc[i] = zlib.crc32(joined[start[i] : start[i] + size[i]])
    run = crc
    for n in range(1, longest + 1):
        if n > 1:
            # the run before, a space, and one word more
            raw = run[:-1] ^ 0xFFFFFFFF
            spaced = step[(raw ^ 32) & 255] ^ (raw >> 8) ^ 0xFFFFFFFF
            run = _moved(spaced, size[n - 1 :]) ^ crc[n - 1 :] if len(spaced) else spaced
        inside = text[: len(run)] == text[n - 1 :] if n > 1 else np.ones(len(run), bool)
        yield n, text[: len(run)][inside], run[inside]


def _portions(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of a column, so many bytes at a time."""
    texts, held, first = [], 0, 0
    for i, value in enumerate(column.cast(pa.large_binary())):
        t = value.as_py()
        if texts and held + len(t or b"") > PORTION:
            yield first, texts
            texts, held, first = [], 0, i
        texts.append(t)
        held += len(t or b"")
    if texts:
        yield first, texts


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = 10_000, longest: int = 3) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without a feature are left out. One array per task, then a sum."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _portions(batch.column(0)):
                for n, _, crc in features(texts, longest):
                    if n:
                        total += np.bincount(crc % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return small_batches(docs.select(text_col)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text: str = "text", buckets: int = 10_000, longest: int = 3) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of every bucket, in doubles: an array of fixed size."""
    counts = []
    for table, column in ((docs, text_col), (target, target_text)):
        n = np.zeros(buckets)
        for bucket, total in bucket_counts(table, column, buckets, longest).collect():
            n[bucket] = total
        counts.append(n)
    s, t = counts
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = 3) -> DataFrame:
    """(_id, n_words, n_features, weight): sums of gains over all features of each row's text."""
    buckets = len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            words, n_features, weight = (np.zeros(rows, np.int64) for _ in range(3))
            for first, texts in _portions(batch.column(1)):
                part = slice(first, first + len(texts))
                for n, text, value in features(texts, longest):
                    if n == 0:
                        words[part] = value
                        continue
                    n_features[part] += np.bincount(text, minlength=len(texts))
                    # sums of whole numbers below 2**53 are exact in doubles
                    weight[part] += np.bincount(text, gains[value % buckets], len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(n_features), pa.array(weight)], ["_id", "n_words", "n_features", "weight"])

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col))
    return small_batches(source).mapInArrow(score, f"_id {source.schema['_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def _median(keys: list[str]) -> Callable:
    """The middle key of what a partition still holds, with the number of its keys."""

    def middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            order = pc.sort_indices(table, [(k, "ascending") for k in keys], null_placement="at_end")
            at = order[(table.num_rows - 1) // 2].as_py()
            row = table.slice(at, 1).append_column("n", pa.array([table.num_rows]))
            yield from row.combine_chunks().to_batches()

    return middle


def cutoff(keys: DataFrame, wanted: int, last: int = 512) -> tuple | None:
    """The wanted-th smallest key of keys (distinct rows; columns in order of comparison, nulls last), None if wanted is 0.

    Each round, every partition names the median of the keys it still holds. The median of these, each
    weighted by its partition's number of keys, has at least a quarter of all remaining keys on either
    side, so a round drops at least a quarter of them. When at most `last` keys remain they are sorted.
    The driver holds one key per partition, never more than `last` otherwise.
    """
    if wanted <= 0:
        return None
    names = keys.columns
    kinds = {f.name: f.dataType for f in keys.schema}
    ordered = lambda parts: F.struct(*[x for p in parts for x in (p.isNull().alias("e"), p.alias("v"))])  # noqa: E731  nulls last
    key = ordered([F.col(c) for c in names])
    rank = lambda row: tuple((v is None, v) if v is not None else (True,) for v in row)
    stored = rest = keys
    held = count = keys.count()
    schema = T.StructType([*keys.schema.fields, T.StructField("n", T.LongType())])
    while count > last:
        middles = sorted((rank(r[:-1]), r[-1], tuple(r[:-1])) for r in rest.mapInArrow(_median(names), schema).collect())
        total = sum(m[1] for m in middles)
        seen = 0
        for _, n, pivot in middles:
            seen += n
            if 2 * seen >= total:
                break
        at = ordered([F.lit(v).cast(kinds[c]) for c, v in zip(names, pivot)])
        below = rest.where(key <= at).count()
        if below == wanted:
            return pivot
        if below > wanted:
            rest, count = rest.where(key < at), below - 1
        else:
            rest, count, wanted = rest.where(key > at), count - below, wanted - below
        if count * 4 <= held:
            stored = rest = save(rest)
            held = count
    return sorted((rank(r), tuple(r)) for r in rest.collect())[wanted - 1][1]


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) with u in (0, 1) from the SHA-256 of `seed:id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    percent: int = 5,
    least_words: int = 20,
    buckets: int = 10_000,
    longest: int = 3,
    seed: int = 42,
    last: int = 512,
) -> DataFrame:
    """(id, n_features, weight, score, rank): one row per input row; rank is null where the row is not drawn.

    Of the N rows with at least `least_words` words the floor(percent * N / 100) highest scores are drawn,
    ties to the smaller id, and ranked in that order. Defined cases: null and empty texts have no feature and
    weight 0; a null id is written as an empty text in its random number and stands after all others among
    ties; rows repeating id and text tie, and any of them is drawn; an empty target makes every gain depend
    on the corpus alone; an empty table gives no rows; other columns are ignored.
    """
    gains = bucket_gains(docs, target, text_col, target_text, buckets, longest)
    scored = weigh(docs, gains, id_col, text_col, longest).withColumn("score", F.col("weight") + gumbel(F.col("_id"), seed)).withColumn("_row", F.monotonically_increasing_id())
    scored = save(scored)
    keys = scored.where(F.col("n_words") >= least_words).select((-F.col("score")).alias("_low"), "_id", "_row")
    wanted = percent * keys.count() // 100
    edge = cutoff(keys, wanted, last)
    order = [F.col("_low").asc(), F.col("_id").asc_nulls_last(), F.col("_row").asc()]
    if edge is None:
        winners = keys.limit(0)
    else:
        low, at, row = F.col("_low"), F.lit(edge[1]).cast(keys.schema["_id"].dataType), F.lit(edge[2])
        same = F.col("_id").eqNullSafe(at)
        ahead = F.coalesce(F.col("_id") < at, F.lit(False)) if edge[1] is not None else F.col("_id").isNotNull()
        winners = keys.where((low < F.lit(edge[0])) | ((low == F.lit(edge[0])) & (ahead | (same & (F.col("_row") <= row)))))
    ranks = numbered(winners, order, "rank").select(F.col("_row").alias("_won"), "rank")
    return scored.join(ranks, F.col("_row") == F.col("_won"), "left").select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP11_SQL = f"""
WITH {SQL_CRC_STEPS},
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
runs AS (
  SELECT r, array_to_string(w[i : i + n - 1], ' ') AS f
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, range(1, 4) AS k(n) WHERE len(w) >= n)),
target AS (
  SELECT array_to_string(w[i : i + n - 1], ' ') AS f
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b, range(1, 4) AS k(n) WHERE len(w) >= n)),
names AS (SELECT f, {sql_crc("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM (SELECT f FROM runs UNION ALL SELECT f FROM target)), crc_steps),
s AS (SELECT bucket, count(*) AS s FROM runs JOIN names USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target JOIN names USING (f) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0)::DOUBLE FROM s) AS all_s, (SELECT coalesce(sum(t), 0)::DOUBLE FROM t) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM runs JOIN names USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS UBIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (r)
"""
