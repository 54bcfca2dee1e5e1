"""Benchmark decontamination: a prefix-filtered set join of document shingles with benchmark windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.llm.common import ascii_lower, save, text_or_empty

#: What stands between words: all ASCII characters but letters and digits, one by one, which a pattern looks up faster than ranges.
BETWEEN = "[" + "".join(f"\\x{c:02x}" for c in range(128) if not chr(c).isalnum()) + "]+"
#: Benchmark tables of at most so many rows (of a few words each) are sent to every executor; larger ones are shuffled.
SENT_ROWS = 500_000
#: Stands in place of a shingle's number where a row speaks of a whole text.
WHOLE = -1


def _spelled(text: Column) -> Column:
    """The words of a text between two empty ones, A-Z in lower case."""
    ascii_only = F.length(text) == F.octet_length(text)
    folded = F.when(ascii_only, F.lower(text)).otherwise(ascii_lower(text))
    return F.split(F.concat(F.lit(" "), folded, F.lit(" ")), BETWEEN)


def words_of(text: Column) -> Column:
    return F.array_remove(_spelled(text_or_empty(text)), "")


def _runs(words: str, width: int) -> Column:
    """All runs of `width` consecutive elements of the array column, joined by a space."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - F.lit(width - 1), F.lit(0)))
    if width == 1:
        return starts
    return F.transform(starts, lambda word, i: F.concat_ws(" ", word, *[F.get(words, i + F.lit(k)) for k in range(1, width)]))


def _blocks(names: DataFrame) -> list[DataFrame]:
    """names in blocks of about SENT_ROWS rows, each small enough to be sent to every executor."""
    blocks = names.count() // max(SENT_ROWS, 1) + 1
    return [names] if blocks == 1 else [names.where(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == i) for i in range(blocks)]


def _sent(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 10) -> tuple[DataFrame, DataFrame]:
    """(windows, owners), stored: windows (wid, words, len), one row per distinct window; owners (wid, item).

    An item of fewer words than a window, but not none, is one window. A null id is written as an empty text.
    """
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.lit(window - 1), F.lit(1)))
    cut = items.select("item", "words", F.explode(starts).alias("start")).select("item", F.slice("words", F.col("start"), F.lit(window)).alias("words"))
    # the words joined by spaces are the window: a word holds no space
    owned = save(cut.select("item", F.array_join("words", " ").alias("window")).distinct())
    named = save(owned.select("window").distinct().withColumn("wid", F.monotonically_increasing_id()))
    windows = named.select("wid", F.split("window", " ").alias("words")).withColumn("len", F.size("words"))
    return windows, save(owned.join(named, "window").select("wid", "item"))


def shingle_parts(windows: DataFrame, shingle: int = 3) -> tuple[DataFrame, DataFrame, list[int]]:
    """(names, parts, widths): the shingles of all windows (shingle, sid), where they stand in them (wid, len, off, sid), and their widths.

    A window shorter than a shingle is one shingle. Both tables are stored.
    """
    width = F.least(F.col("len"), F.lit(shingle))
    widths = sorted((r[0] for r in windows.select(width.alias("w")).distinct().collect()), reverse=True)
    cut = windows.select("wid", "len", F.posexplode(_runs("words", shingle)).alias("off", "shingle"))
    for w in widths:
        if w < shingle:
            cut = cut.union(windows.where(F.col("len") == w).select("wid", "len", F.lit(0), F.array_join("words", " ")))
    names = save(cut.select("shingle").distinct().withColumn("sid", F.monotonically_increasing_id()))
    return names, save(cut.join(names, "shingle").select("wid", "len", "off", "sid")), widths


def shingle_places(texts: DataFrame, names: DataFrame, widths: list[int]) -> DataFrame:
    """(id, key, n, pos, sid), stored: every place, from 0, where a shingle of names stands in a text (id, key, words) of n words.

    words begin and end with an empty one. Each text also has one row with sid WHOLE, so texts are read once.
    Words are unpacked beside their text's array, which generated code holds by reference, and meet a table that
    is at hand: only hits are ever written out. A benchmark too large for that is met in blocks.
    """
    n = F.size("words") - 2
    found = None
    for number, block in enumerate(_blocks(names)):
        for w in widths or [1]:
            first = found is None
            wanted = block.union(block.sparkSession.createDataFrame([("", WHOLE)], "shingle string, sid long")) if first else block
            # an inner posexplode would split every text twice, to leave out empty arrays beforehand
            each = texts.select("id", "key", "words", F.posexplode_outer("words").alias("at", "word"))
            inside = (F.col("at") > 0) & (F.col("at") + w - 1 <= n)
            text = F.concat_ws(" ", "word", *[F.get("words", F.col("at") + k) for k in range(1, w)]) if w > 1 else F.col("word")
            kept = each.where(inside | (F.col("at") == 0) if first else inside)
            named = kept.select("id", "key", n.cast("long").alias("n"), (F.col("at") - 1).alias("pos"), F.when(F.col("at") > 0, text).otherwise("").alias("shingle"))
            here = named.join(F.broadcast(wanted), "shingle").select("id", "key", "n", "pos", "sid")
            found = here if first else found.union(here)
    return save(found)


def occurrences(found: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, start, len, wid), stored: every place at which a window stands in a text, from places (key, n, pos, sid) of its shingles.

    All shingles of a window must be there, so the prefix that a text has to share is one, the rarest: shingles are
    ordered by the number of their places in all texts. A place of it proposes a start, length and position must
    leave room for the window, and the start is verified by all other shingles standing at their own places.
    Shingles are compared as texts, never by a hash, so what is verified is equal word by word.
    """
    # a window of which a shingle stands nowhere is out; of the others the rarest shingle is the prefix
    counted = found.groupBy("sid").agg(F.count(F.lit(1)).alias("places"))
    rarest = (
        parts.join(counted, "sid", "left")
        .groupBy("wid", "len")
        .agg(F.count(F.lit(1)).alias("parts"), F.count("places").alias("present"), F.min(F.struct("places", "off", "sid")).alias("r"))
        .where(F.col("parts") == F.col("present"))
        .select("wid", "len", "parts", F.col("r.off").alias("off"), F.col("r.sid").alias("sid"))
    )
    prefixes = _sent(save(rarest))
    start = F.col("pos") - F.col("off")
    proposed = found.join(prefixes, "sid").where((start >= 0) & (start + F.col("len") <= F.col("n"))).select("key", "wid", "len", "parts", start.alias("start"))
    others = parts.select("wid", F.col("off").alias("o"), "sid")
    checks = proposed.join(_sent(others), "wid").select("key", "wid", "len", "parts", "start", (F.col("start") + F.col("o")).alias("pos"), "sid")
    verified = checks.join(found.select("key", "pos", "sid"), ["key", "pos", "sid"]).groupBy("key", "wid", "len", "parts", "start").agg(F.count(F.lit(1)).alias("equal"))
    return save(verified.where(F.col("equal") == F.col("parts")).select("key", "start", "len", "wid"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 3,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated): one row per input row.

    A word is hit when it lies inside any occurrence of a benchmark window. n_items counts the items with an
    occurring window; items_sha256 is the digest of their ids, sorted as texts and joined by commas.

    Equal texts are searched once: rows meet their result by the text's MD5 digest. Defined cases: null and
    empty texts have no words and no hits, and items_sha256 is that of an empty text; null items and items
    without words have no windows; items that repeat an id are one item; a null item id counts as an empty
    text; every row of a repeated doc_id is answered; an empty benchmark hits nothing; an empty table
    gives no rows; other columns are ignored.
    """
    key = F.unhex(F.md5(text_or_empty(F.col(text_col)).cast("binary")))
    texts = docs.select(F.col(id_col).alias("id"), key.alias("key"), _spelled(text_or_empty(F.col(text_col))).alias("words"))
    windows, owners = benchmark_windows(benchmark, item_col, item_text, window)
    names, parts, widths = shingle_parts(windows, shingle)
    hits = shingle_places(texts, names, widths)
    # copies of a text fall together before the shuffle
    found = save(hits.where(F.col("sid") != WHOLE).groupBy("key", "pos", "sid").agg(F.max("n").alias("n")))
    places = occurrences(found, parts)

    # words covered: what each place adds to the places that start before it
    ahead = Window.partitionBy("key").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    fresh = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(ahead), F.lit(0))), F.lit(0))
    covered = places.select("key", "start", "len").distinct().withColumn("fresh", fresh).groupBy("key").agg(F.sum("fresh").alias("n_hit"))
    named = places.select("key", "wid").distinct().join(_sent(owners), "wid").select("key", "item").distinct()
    items = named.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    result = covered.join(items, "key").select(F.col("key").alias("_key"), "n_hit", "n_items", "items")

    rows = hits.where(F.col("sid") == WHOLE).select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("n").alias("n_words"))
    hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    return rows.join(result, "_key", "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.coalesce(F.col("n_items"), F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce(F.col("items"), F.lit("")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


OP12_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, len(ws) AS n, array_to_string(ws, ' ') AS s
  FROM (SELECT item, w[i : i + 9] AS ws FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0))),
lens AS (SELECT DISTINCT n FROM win),
runs AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN lens ON len(w) >= n)),
occ AS (SELECT r, i, runs.n, item FROM runs JOIN win ON runs.s = win.s AND runs.n = win.n),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
