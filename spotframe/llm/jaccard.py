"""Exact near-duplicate join on word n-gram sets, with components instead of all pairs.

Two documents link when 100 * |A and B| >= percent * |A or B|. The steps, each exact:

1. Equal sets are collapsed; one representative of each goes on.
2. Position skipping. The elements of a set stand in order of rarity (how many sets of the whole table hold them, by
   a table of counts of fixed size; equal counts by hash); a linked set shares all but `spare` of them. A
   slice at the front of that order, half as long again as the plain prefix filter needs, must therefore hold
   elements that occur in other slices (front_size gives the bound); representatives with more than `spare` elements
   that occur in no other slice drop out before any list is built.
3. The remaining sets meet in the index lists of their prefixes, apart by size. A list gives one link to its first member
   for each other member, never its pairs; connected lists form a cluster that contains every link of its sets.
4. Answers from a similar set. In a cluster of more than one block every set is compared with the cluster's leader. Sets that link to it are connected; and
   as 1 - similarity is a metric, two sets can only link when their distances to the leader differ by no more than the
   threshold allows. The cluster is cut into blocks by that distance, and pairs of blocks are skipped when the
   distances rule all links out, or when all sets of both are linked to the leader already.
5. The pairs of blocks that are left are compared set by set inside a task; a forest of the links found goes on.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from spotframe.llm.common import components, give_back, release, save, small_batches, spaced_lower, text_or_empty

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Words remembered per task; the table is emptied when full, which only costs time.
REMEMBERED = 300_000
#: Sets in a block; the distance to the leader is cut into so many bands.
BLOCK, BANDS = 1024, 20
#: Shared elements multiplied at a time when two blocks are compared.
COLUMNS = 8192
#: Bits of the bitmap that spares most sets the second look.
MARKS = 1 << 25
#: Counts in the table that orders elements by rarity; elements that share a count are ordered alike.
COUNTS = 1 << 19
_SHIFT = np.uint64(64 - COUNTS.bit_length() + 1)


class Shingler:
    def __init__(self, words: int):
        self.words = words
        self.known: dict[str, int] = {}

    def set_of(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the word n-grams of a text (white space as spaces, lower case)."""
        parts = list(filter(None, text.split(" ")))
        if not parts:
            return np.empty(0, dtype=np.uint64)
        try:
            h = np.fromiter(map(self.known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        except KeyError:
            if len(self.known) > REMEMBERED:
                self.known = {}
            new = set(parts).difference(self.known)
            self.known.update((w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))) for w in new)
            h = np.fromiter(map(self.known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        k = min(self.words, len(h))
        mixed = h[: len(h) - k + 1].copy()
        for i in range(1, k):
            mixed = mixed * _M1 + h[i : len(h) - k + 1 + i]
        mixed += np.uint64(k)
        mixed ^= mixed >> np.uint64(30)
        mixed *= _M2
        mixed ^= mixed >> np.uint64(27)
        mixed *= _M3
        mixed ^= mixed >> np.uint64(31)
        return np.unique(mixed)


def _spare(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """How many elements of a set of n a linked set may lack: n - ceil(percent * n / 100)."""
    return n - -(-percent * n // 100)


def front_size(n: int, percent: int) -> int:
    """Elements in the slice at the front of a set of n.

    Of the slice of A, at most max(|A - B|, front_size(A) - front_size(B) + |B - A|) elements miss the slice of a linked
    B: if one of A's lies behind all of B's slice, then what B's slice shares with A is in A's slice. That is never more
    than A's spare when the slice is half as long again, rounded down (rounded up it can be), from 50 percent on; below,
    the slice is that of the plain prefix filter, for which it holds as |B - A| is at most B's spare.
    """
    spare = _spare(n, percent)
    return spare + (spare // 2 if percent >= 50 else 0) + 1


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


#: Counts that travel together.
PIECE = 4096
SETS = "n bigint, digest binary, part bigint, counts binary"


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(_id, n, digest, part, counts) of docs (_id, _text): a row for each text, digest being null without words.

    Each task adds rows with part and counts only: how often its texts' elements fall on each of COUNTS places, one
    array per task whatever it reads.
    """
    kind = docs.schema["_id"].dataType.simpleString()
    names = ["_id", *[c.split()[0] for c in SETS.split(", ")]]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total, id_type = Shingler(words), np.zeros(COUNTS, np.int64), None
        for batch in batches:
            id_type, rows = batch.schema[0].type, batch.num_rows
            made = [shingler.set_of(text) for text in batch.column(1).to_pylist()]
            digest = [hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None for one in made]
            if made:
                total += np.bincount((np.concatenate(made) >> _SHIFT).astype(np.int64), minlength=COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(one) for one in made], pa.int64()), pa.array(digest, pa.binary()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary())], names)
            del made
        del shingler
        give_back()
        if id_type is not None:
            parts = COUNTS // PIECE
            counts = pa.array([one.tobytes() for one in np.minimum(total, 2**32 - 1).astype(np.uint32).reshape(parts, PIECE)])
            yield pa.RecordBatch.from_arrays([pa.nulls(parts, id_type), pa.nulls(parts, pa.int64()), pa.nulls(parts, pa.binary()), pa.array(range(parts), pa.int64()), counts], names)

    return docs.mapInArrow(build, f"_id {kind}, {SETS}")


def rarity(counted: DataFrame) -> np.ndarray:
    """COUNTS numbers from rows (part, counts): how often elements that begin with a place occur in all sets, as rounded logarithms.

    Arrays of tasks meet in pieces, so no task adds up all of them.
    """

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.uint32).astype(np.int64) for c in frame["counts"])
        # a quarter of a doubling is told apart: what matters is which elements are common
        return pd.DataFrame({"part": frame["part"].iloc[:1], "level": [np.rint(4 * np.log2(1.0 + total)).astype(np.uint8).tobytes()]})

    out = np.zeros((COUNTS // PIECE, PIECE), np.uint8)
    for r in counted.groupBy("part").applyInPandas(add, "part long, level binary").collect():
        out[r["part"]] = np.frombuffer(r["level"], np.uint8)
    return out.ravel()


def _rare_first(made: list[np.ndarray], level: np.ndarray) -> list[np.ndarray]:
    """The elements of each set, rare ones first and by hash among equals."""
    return [one[np.argsort(level[(one >> _SHIFT).astype(np.int64)], kind="stable")] for one in made]


def _fronts(docs: DataFrame, words: int, level: np.ndarray, percent: int) -> DataFrame:
    """(_id, n, digest, front) of docs (_id, _text): the slice at the start of each set's order."""
    kind = docs.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            made = [shingler.set_of(text) for text in batch.column(1).to_pylist()]
            digest = [hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None for one in made]
            n = [len(one) for one in made]
            front = [one[: front_size(len(one), percent)].copy() for one in _rare_first(made, level)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), _lists(front)], ["_id", "n", "digest", "front"])
            del made, front
        del shingler
        give_back()

    return docs.mapInArrow(cut, f"_id {kind}, n bigint, digest binary, front array<bigint>")


def _sociable(fronts: DataFrame, percent: int) -> DataFrame:
    """(rep, n) of fronts (rep, n, front) without the sets that have too many elements nobody else has."""
    postings = fronts.select("rep", F.explode("front").alias("e"))
    # one row per element after a map-side sum: a frequent element never gathers its sets
    alone = postings.groupBy("e").agg(F.min("rep").alias("rep"), F.count(F.lit(1)).alias("sets")).where(F.col("sets") == 1)
    lonely = alone.groupBy("rep").agg(F.count(F.lit(1)).alias("alone"))
    spare = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100))
    return fronts.select("rep", "n").join(lonely, "rep", "left").where(F.coalesce(F.col("alone"), F.lit(0)) <= spare).select("rep", "n")


def _marks(ids: DataFrame) -> np.ndarray:
    """A bitmap of MARKS bits in which the hash of every id is set: MARKS / 8 bytes however many ids there are."""
    bit = F.pmod(F.xxhash64("rep"), F.lit(MARKS))
    rows = ids.select((bit / 32768).cast("int").alias("part"), (bit % 32768).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros((MARKS // 32768, 4096), dtype=np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.ravel()


def _among(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of sets (rep, n, elements) whose rep a bitmap of ids (rep) lets through: all of ids, and a few others."""
    marks = _marks(ids)
    kind = sets.schema["rep"].dataType.simpleString()

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(3).to_numpy()
            kept = batch.filter(pa.array((marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))
            yield pa.RecordBatch.from_arrays(kept.columns[:3], ["rep", "n", "elements"])

    marked = sets.select("rep", "n", "elements", F.pmod(F.xxhash64("rep"), F.lit(MARKS)).alias("_bit"))
    return marked.mapInArrow(through, f"rep {kind}, n bigint, elements array<bigint>")


def _linked(inter: Column, n: Column, m: Column, percent: int) -> Column:
    return inter * 100 >= (n + m - inter) * percent


def _forest(pairs: np.ndarray, size: int) -> np.ndarray:
    """Rows of pairs (a, b) that join two trees; the others add nothing."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for row, (a, b) in enumerate(pairs.tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            keep.append(row)
    return pairs[keep]


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(len(a), len(b)) exact sizes of the intersections; only elements on both sides are multiplied."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(b)), dtype=np.float32)

    def where(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        hit = both[at] == flat
        return row[hit], at[hit]

    if not len(both):
        return out.astype(np.int64)
    (ra, ca), (rb, cb) = where(a), where(b)
    for low in range(0, len(both), COLUMNS):
        left, right = np.zeros((len(a), COLUMNS), np.float32), np.zeros((len(b), COLUMNS), np.float32)
        i, j = (ca >= low) & (ca < low + COLUMNS), (cb >= low) & (cb < low + COLUMNS)
        left[ra[i], ca[i] - low] = 1
        right[rb[j], cb[j] - low] = 1
        out += left @ right.T  # sums of ones below 2 ** 24 are exact
    return out.astype(np.int64)


def _compare(percent: int):
    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        first, second = frame[frame["side"] == 0], frame[frame["side"] == 1]
        same = len(second) == 0
        other = first if same else second
        a, b = [np.asarray(x) for x in first["elements"]], [np.asarray(x) for x in other["elements"]]
        na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        inter = intersections(a, b)
        hit = inter * 100 >= (na[:, None] + nb[None, :] - inter) * percent
        if same:
            hit = np.triu(hit, 1)
        pairs = np.argwhere(hit)
        pairs[:, 1] += 0 if same else len(a)
        kept = _forest(pairs, len(a) + (0 if same else len(b)))
        ids = first["rep"].to_numpy() if same else np.concatenate((first["rep"].to_numpy(), second["rep"].to_numpy()))
        return pd.DataFrame({"a": ids[kept[:, 0]], "b": ids[kept[:, 1]]})

    return compare


def link_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links among sets (rep, n, elements) that connect the same sets as all links do."""
    kind = sets.schema["rep"].dataType.simpleString()
    spare = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100))
    # sizes of linked sets differ by one step of this ladder at most; a group holds the sets of two steps
    step = F.floor(F.log(F.col("n")) / F.lit(-1.001 * math.log(percent / 100.0))).cast("int")
    prefix = sets.select("rep", F.explode(F.slice("elements", 1, (spare + 1).cast("int"))).alias("e"), step.alias("step"))
    grouped = prefix.select("rep", "e", F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("group"))
    heads = grouped.groupBy("group", "e").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("sets")).where(F.col("sets") > 1)
    # a set has a node in each of its groups; nodes that share a number by chance only make a cluster larger
    met = grouped.join(heads.hint("merge"), ["group", "e"]).where(F.col("rep") != F.col("head")).select(F.xxhash64("group", "head").alias("a"), F.xxhash64("group", "rep").alias("b"))
    nodes = sets.select("rep", F.explode(F.array(step, step + 1)).alias("group")).select("rep", F.xxhash64("group", "rep").alias("node"))
    members = nodes.join(components(met).withColumnRenamed("root", "cluster"), "node").select("rep", "cluster").distinct()
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"))
    clusters = save(members.join(sizes, "cluster"))
    # a cluster of one block is compared as it is
    few = clusters.where(F.col("sets") <= BLOCK).select("rep", "cluster", F.lit(0).alias("side"))
    found = few.hint("merge").join(sets.select("rep", "elements"), "rep").groupBy("cluster").applyInPandas(_compare(percent), f"a {kind}, b {kind}")
    many = clusters.where(F.col("sets") > BLOCK).select("rep", "cluster")
    return found if many.isEmpty() else found.union(_link_by_leader(sets, many, percent))


def _link_by_leader(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """The same for clusters (rep, cluster) of many sets, by their distance to the first of each."""
    kind = sets.schema["rep"].dataType.simpleString()
    sets = save(_among(sets, clusters.select("rep")))
    members = sets.join(clusters, "rep")
    first = clusters.groupBy("cluster").agg(F.min("rep").alias("lead"))
    leaders = first.join(sets.select(F.col("rep").alias("lead"), F.col("n").alias("leader_n"), F.col("elements").alias("leader")), "lead").dropDuplicates(["cluster"])
    inter = F.size(F.array_intersect("elements", "leader")).cast("long")
    placed = members.join(leaders, "cluster").withColumn("i", inter).withColumn("u", F.col("n") + F.col("leader_n") - F.col("i"))
    placed = save(
        placed.select(
            "cluster", "lead", "rep", "elements",
            _linked(F.col("i"), F.col("n"), F.col("leader_n"), percent).alias("in_lead"),
            F.expr(f"({BANDS} * (u - i)) div u").cast("int").alias("band"),
        )
    )
    direct = placed.where(F.col("in_lead") & (F.col("rep") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("rep").alias("b"))
    # a band is cut into blocks by hash; all sets of a block are linked to the leader, or none is
    block = ["band", "in_lead", "part"]
    bands = save(placed.groupBy("cluster", "band", "in_lead").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts")))
    blocks = bands.select("cluster", "band", "in_lead", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    x, y = blocks.alias("x"), blocks.alias("y")
    reach = -(-BANDS * (100 - percent) // 100)
    order = "struct(x.band, x.in_lead, x.part) <= struct(y.band, y.in_lead, y.part)"
    pairs = x.join(y, F.expr(f"x.cluster = y.cluster AND {order} AND y.band - x.band <= {reach} AND NOT (x.in_lead AND y.in_lead)"))
    pair = [f"{s}_{c}" for s in "xy" for c in block]
    pairs = pairs.select("x.cluster", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in block])

    def side(number: int, name: str) -> DataFrame:
        return pairs.select("cluster", *pair, *[F.col(f"{name}_{c}").alias(c) for c in block], F.lit(number).alias("side"))

    apart = F.expr("NOT (x_band = y_band AND x_in_lead = y_in_lead AND x_part = y_part)")
    sides = side(0, "x").unionByName(side(1, "y").where(apart))
    in_parts = placed.join(bands, ["cluster", "band", "in_lead"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    meeting = in_parts.join(sides, ["cluster", *block]).select("cluster", *pair, "side", "rep", "elements")
    return direct.union(meeting.groupBy("cluster", *pair).applyInPandas(_compare(percent), f"a {kind}, b {kind}"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id), one row per input row; component_id is the smallest id reachable by links.

    A document's set holds the distinct `words`-word shingles of its lower-cased (A-Z) text, words being what
    stands between the six ASCII white-space characters; with fewer words, the whole sequence is the one element.
    Elements are compared by 64-bit hashes.

    Defined cases: a null text, or one without words, has an empty set, links with nothing and is its own component;
    equal sets link whatever their size; rows repeating an id share the id's components; a null id takes part as a row of
    its own set and is never the smallest while another id is there; an empty table gives no rows.
    """
    rows = small_batches(docs).select(F.col(id_col).alias("_id"), spaced_lower(text_or_empty(F.col(text_col))).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    made = save(_sets(rows, words))
    level = rarity(made.where(F.col("part").isNotNull()).select("part", "counts"))
    sets = save(made.where(F.col("part").isNull()).select("_id", "n", "digest"))
    del made
    whole = _fronts(rows.where(F.col("_id").isNotNull()), words, level, percent).where(F.col("digest").isNotNull())
    distinct = save(whole.groupBy("digest").agg(F.min("_id").alias("rep"), F.first("n").alias("n"), F.first("front").alias("front")))
    release(docs.sparkSession)
    near = save(_sociable(distinct, percent))
    release(docs.sparkSession)
    marks = _marks(near)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            bit = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))
            made = _rare_first([shingler.set_of(t) for t in batch.column(1).to_pylist()], level)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(m) for m in made], pa.int64()), _lists(made)], ["rep", "n", "elements"])
        del shingler
        give_back()

    # the bitmap lets a few others through; they are compared like all others, and what links is linked
    marked = rows.where(F.col("_id").isNotNull()).select("_id", "_text", F.pmod(F.xxhash64("_id"), F.lit(MARKS)).alias("_bit")).mapInArrow(full, f"rep {kind}, n bigint, elements array<bigint>")
    if near.count() * 4 > MARKS:  # a bitmap that full lets too many through
        marked = marked.join(near.select("rep"), "rep", "left_semi")
    elements = save(marked)
    groups = save(distinct.select("digest", "rep"))
    del distinct, whole, marked  # the slices are no longer needed
    release(docs.sparkSession)
    roots = components(link_sets(elements, percent)).select(F.col("node").alias("rep"), "root")
    found = groups.join(roots, "rep", "left").select("digest", F.coalesce("root", "rep").alias("_root"))
    return sets.join(found, "digest", "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_root", "_id").alias("component_id")
    )
