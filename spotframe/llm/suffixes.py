"""Repeated passages across documents, by a multi-document Burrows-Wheeler transform built column by column.

Every byte covered by a `width`-byte string that also starts in a document with a smaller id is removed.

0. A text that equals a smaller document's is covered as a whole. Such copies are found by their SHA-256 and take no
   further part: what they hold, the smaller document holds.
1. Each `width`-byte string has an anchor: the smallest hash among the `GRAM`-byte strings inside it. The anchor depends
   on the string alone, so equal strings have equal anchors. Documents are dealt into blocks; a block
   sends each of its anchors once, and anchors that only one document has are dropped.
2. Around the shared anchors blocks cut contexts: runs of neighbouring strings with the same anchor, at most
   `width` + RUN - 1 bytes. Equal contexts of a block are sent once, with the smallest and largest id that has them.
   An anchor of more than HOT runs may have as many contexts: it is hot, and its runs are cut into their single
   strings, which are dealt by their own hash, so that no task gathers the contexts of one anchor.
3. An anchor with one context has nothing to compare. All other contexts of a bucket of anchors are collections of short
   documents, of whole anchors and of similar length, so that no round passes over texts that ended long before. The transform
   and the longest common prefixes of a collection are built as in BCR: each round inserts one more symbol of every document, from the right; the place of a new suffix
   follows from the place of the suffix before it. Neighbours with a common prefix of `width` or more are
   the same string, and the smallest id among them decides.
4. Blocks get the smallest ids of their contexts back and cut their texts.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from spotframe.llm.common import save, small_batches, text_or_empty

#: Bytes of an anchor, and strings at most in a context.
GRAM, RUN = 20, 64
#: Characters of text in a block, and buckets of contexts for each block.
BLOCK_CHARS, BUCKETS = 8_000_000, 4
#: Runs of an anchor above which its strings are dealt one by one.
HOT = 4096
#: Suffixes up to which the two one-byte columns of a collection stay in memory; larger ones are files of the task. Ranks,
#: order and range minima are in memory at any size.
IN_MEMORY = 50_000_000
#: Symbols after which the next anchor of a bucket begins another collection; an anchor is never divided.
PIECE = 100_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _load(data: np.ndarray, at: int, count: int) -> np.ndarray:
    """Eight bytes at every position from `at`, as unaligned longs."""
    return np.ndarray((count,), dtype="<u8", buffer=data, offset=at, strides=(1,))


def anchors(raw: bytes, width: int) -> np.ndarray:
    """The anchor hash of every `width`-byte string of raw, by its start."""
    n = len(raw)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    data = np.frombuffer(raw, dtype=np.uint8)
    grams = n - GRAM + 1
    h = _load(data, 0, grams) * _M1
    h ^= h >> np.uint64(29)
    h += _load(data, 8, grams)
    h *= _M2
    h ^= h >> np.uint64(32)
    h += _load(data, 12, grams)
    h *= _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    h ^= h >> np.uint64(32)
    span, reach = width - GRAM + 1, 1
    while 2 * reach <= span:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    rest = span - reach
    return np.minimum(h[: n - width + 1], h[rest : rest + n - width + 1])


def runs(anchor: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, past-the-last start, anchor) of the runs of equal anchors that are in the sorted array `shared`."""
    if not len(anchor) or not len(shared):
        return (np.empty(0, dtype=np.int64),) * 2 + (np.empty(0, dtype=np.uint64),)
    first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
    past = np.append(first[1:], len(anchor))
    value = anchor[first]
    hit = shared[np.minimum(np.searchsorted(shared, value), len(shared) - 1)] == value
    first, past, value = first[hit], past[hit], value[hit]
    if len(first) and (past - first).max() > RUN:  # text that repeats itself
        parts = -(-(past - first) // RUN)
        inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(first, parts) + RUN * inside
        first, past, value = start, np.minimum(start + RUN, np.repeat(past, parts)), np.repeat(value, parts)
    return first, past, value


def spread(string: bytes, buckets: int) -> int:
    """The bucket of a hot anchor's string."""
    return int.from_bytes(_key(string)[:8], "big") % buckets


def _key(context: bytes) -> bytes:
    return hashlib.blake2b(context, digest_size=16).digest()


class Columns:
    """Arrays of a collection: in memory, or above IN_MEMORY elements as scratch files of the task."""

    def __init__(self) -> None:
        self.folder: tempfile.TemporaryDirectory | None = None

    def empty(self, size: int, dtype: type) -> np.ndarray:
        if size <= IN_MEMORY:
            return np.empty(size, dtype=dtype)
        self.folder = self.folder or tempfile.TemporaryDirectory()
        with tempfile.NamedTemporaryFile(dir=self.folder.name) as file:  # the mapping outlives the name
            return np.memmap(file.name, dtype=dtype, mode="w+", shape=(size,))

    def close(self) -> None:
        if self.folder:
            self.folder.cleanup()


class LowestBetween:
    """Minimum of any range of small numbers: by doubling ranges up to 16 numbers, and blocks of 16 between the ends of longer ones."""

    SHORT = 4

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(values) and len(self.levels) <= self.SHORT:
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))
        block = 1 << self.SHORT
        self.blocks = LowestBetween(self.levels[-1][::block].copy()) if len(values) >= 2 * block - 1 else None

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over [low, high], low <= high."""
        size, block = high - low + 1, 1 << self.SHORT
        out = np.empty(len(low), dtype=np.uint8)
        level = np.frexp(np.minimum(size, 2 * block).astype(np.float32))[1] - 1
        for k in range(self.SHORT + 1):
            at = np.flatnonzero(level == k)
            if len(at):
                table = self.levels[k]
                out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k) + 1])
        at = np.flatnonzero(level > self.SHORT)
        if len(at):
            a, b, table = low[at], high[at], self.levels[-1]
            ends = np.minimum(table[a], table[b - block + 1])
            out[at] = np.minimum(ends, self.blocks.of(-(-a // block), (b + 1) // block - 1))
        return out


def collection_order(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, length, common) of all suffixes of the texts in sorted order.

    common[i] is the common prefix of suffix i and the one before it, capped at `depth`. Suffix 0.. are the empty
    ones, one for each text. Round j inserts the suffix of length j of every text that has one.
    """
    m = len(texts)
    length = np.fromiter(map(len, texts), dtype=np.int64, count=m)
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    end = np.cumsum(length)
    code = np.zeros(256, dtype=np.uint8)
    used = np.unique(flat)
    code[used] = np.arange(1, len(used) + 1)  # 0 closes a text; UTF-8 leaves room for it
    symbols = np.concatenate((code[flat], np.zeros(1, dtype=np.uint8)))
    columns = Columns()

    def symbol_before(which: np.ndarray, suffix: int) -> np.ndarray:
        at = end[which] - suffix - 1
        return np.where(length[which] > suffix, symbols[at], 0).astype(np.uint8)

    bwt, common = symbol_before(np.arange(m), 0), np.zeros(m, dtype=np.uint8)
    active = np.flatnonzero(length > 0)
    place, j = active.copy(), 0

    def ranks() -> tuple[np.ndarray, int]:
        order = np.argsort(bwt, kind="stable")  # the suffixes that follow, by their first symbol
        return order, len(bwt) - int(np.count_nonzero(bwt))

    while len(active):
        j += 1
        order, closed = ranks()
        # active texts stand by place; by symbol and place they stand as in `order`, so marks give their ranks
        turn = np.argsort(bwt[place], kind="stable")
        marked = np.zeros(len(bwt), dtype=bool)
        marked[place] = True
        active, place, k = active[turn], place[turn], np.flatnonzero(marked[order])
        new = m + k - closed
        # common prefixes of the new suffixes with their neighbours: one more than those of the suffixes behind
        lowest = LowestBetween(common)
        own = bwt[place]
        last = order[np.maximum(k - 1, 0)]
        has_last = (k > 0) & (bwt[last] == own)
        following = order[np.minimum(k + 1, len(bwt) - 1)]
        has_following = (k + 1 < len(bwt)) & (bwt[following] == own)
        size = m + len(bwt) - closed
        old = np.ones(size, dtype=bool)
        old[new] = False
        out_bwt, out_common = columns.empty(size, np.uint8), columns.empty(size, np.uint8)
        out_bwt[old], out_common[old] = bwt, common
        out_bwt[new] = symbol_before(active, j)
        low = np.concatenate((last[has_last], place[has_following])) + 1
        found = np.minimum(lowest.of(low, np.concatenate((place[has_last], following[has_following]))) + 1, depth)
        value = np.zeros(len(k), dtype=np.uint8)
        split = len(low) - np.count_nonzero(has_following)
        value[has_last] = found[:split]
        out_common[new] = value
        out_common[new[has_following] + 1] = found[split:]
        bwt, common = out_bwt, out_common
        going = length[active] > j
        active, place = active[going], new[going]
    # which suffix stands where: from the empty suffixes, one symbol back at a time
    order, closed = ranks()
    rank = np.empty(len(bwt), dtype=np.int64)
    rank[order] = np.arange(len(bwt))
    who, size_of = np.empty(len(bwt), dtype=np.int32), np.empty(len(bwt), dtype=np.uint8)
    active = place = np.arange(m)
    j = 0
    while len(active):
        who[place], size_of[place] = active, min(j, 255)
        going = length[active] > j
        active, place = active[going], m + rank[place[going]] - closed
        j += 1
    common = np.array(common)
    columns.close()
    return who, size_of, common


def collections(group: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Numbers of the texts of each collection: texts of one group stay together, groups go by their longest text."""
    if not len(group):
        return []
    _, group = np.unique(group, return_inverse=True)
    longest = np.zeros(group.max() + 1, dtype=np.int64)
    np.maximum.at(longest, group, length)
    turn = np.argsort(longest, kind="stable")
    piece = np.empty(len(longest), dtype=np.int64)
    piece[turn] = (np.cumsum(np.bincount(group, length)[turn]) - 1) // PIECE
    of = piece[group]
    order = np.argsort(of, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(of[order])) + 1)


def smallest_owners(texts: list[bytes], owner: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the smallest owner of any text with the same `width`-byte string, by the string's start."""
    out = [np.empty(max(0, len(t) - width + 1), dtype=owner.dtype) for t in texts]
    if not texts:
        return out
    who, size, common = collection_order(texts, width)
    long = np.flatnonzero(size >= width)
    if not len(long):
        return out
    first = np.flatnonzero(common[long] < width)
    first = first if len(first) and first[0] == 0 else np.concatenate(([0], first))
    lowest = np.minimum.reduceat(owner[who[long]], first)
    value = np.repeat(lowest, np.diff(np.append(first, len(long))))
    which, start = who[long], np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))[who[long]] - size[long]
    bounds = np.cumsum([0, *map(len, out)])
    flat = np.empty(bounds[-1], dtype=owner.dtype)
    flat[bounds[which] + start] = value
    return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _split(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(rows that carry an anchor, rows that name a copy). No number is ever null: pandas would make them floats."""
    copy = rows["is_copy"].to_numpy(dtype=bool)
    return rows[~copy], rows[copy]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, with_kept: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]), one row per document.

    Texts are UTF-8 bytes. A byte goes when a `width`-byte string over it also starts in a document with a smaller id;
    overlapping strings count, and strings are looked up in the texts as given. n_spans counts maximal
    removed runs; `kept` are the remaining bytes.

    Defined cases: null texts count as empty; texts shorter than `width` stay whole; a null id counts as larger than
    all others and null ids do not remove from each other; nor do rows that repeat an id; an empty
    table gives no rows. Ids are integers. `width` is from GRAM to 190.
    """
    if not GRAM <= width <= 255 - RUN:
        raise ValueError("width out of range")
    kind = docs.schema[id_col].dataType.simpleString()
    last = (1 << 63) - 1
    rows = small_batches(docs).select(F.col(id_col).alias("_own"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(last)).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.length("_text") + 100), F.lit(0)).alias("s")).first()["s"]
    blocks = max(1, -(-size // BLOCK_CHARS))
    buckets = BUCKETS * blocks
    block = F.pmod(F.xxhash64("_id", F.length("_text")), F.lit(blocks)).cast("int").alias("block")
    dealt = rows.select("*", F.xxhash64("_text").alias("_h"), block).repartition(int(blocks), "block")
    digests = save(rows.where(F.octet_length("_text") >= width).select("_id", F.xxhash64("_text").alias("_h"), block, F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha")))
    first = digests.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    copies = save(digests.join(first, "_sha").where(F.col("_id") > F.col("_first")).select("block", F.col("_id").alias("copy"), F.col("_h").alias("copy_h")))

    def originals(frame: pd.DataFrame, copies_: pd.DataFrame) -> Iterator[tuple[int, bytes]]:
        gone = set(zip(copies_["copy"], copies_["copy_h"], strict=True))
        for doc, h, text in zip(frame["_id"], frame["_h"], frame["_text"], strict=True):
            if (doc, h) not in gone:
                yield doc, text.encode("utf-8", "surrogatepass")

    def send_anchors(frame: pd.DataFrame, copies_: pd.DataFrame) -> pd.DataFrame:
        found, ids, times = [], [], []
        for doc, raw in originals(frame, copies_):
            a = anchors(raw, width)
            if len(a):
                start = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1))
                length = np.diff(np.append(start, len(a)))
                a, count = np.unique(np.repeat(a[start], -(-length // RUN)), return_counts=True)
                found.append(a)
                times.append(count)
                ids.append(np.full(len(a), doc))
        if not found:
            return pd.DataFrame({"anchor": np.empty(0, np.int64), "at": np.empty(0, np.int64)})
        flat, doc = np.concatenate(found), np.concatenate(ids)
        order = np.argsort(flat, kind="stable")
        flat, doc, count = flat[order], doc[order], np.concatenate(times)[order]
        first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
        # the block's number behind that of the anchor's runs in it, negative where two of them share it
        at = (np.minimum(np.add.reduceat(count, first), HOT + 1) << 32) + int(frame["block"].iloc[0]) + 1
        return pd.DataFrame({"anchor": flat[first].view(np.int64), "at": np.where(several, -at, at)})

    sent = dealt.groupBy("block").cogroup(copies.groupBy("block")).applyInPandas(send_anchors, "anchor bigint, at bigint")
    no_copy = (F.lit(0).cast("bigint").alias("copy"), F.lit(0).cast("bigint").alias("copy_h"), F.lit(False).alias("is_copy"))
    alike = Window.partitionBy("anchor")  # one row per block at most
    shared = (
        sent.withColumn("_n", F.count(F.lit(1)).over(alike))
        .withColumn("_runs", F.sum(F.shiftright(F.abs("at"), 32)).over(alike))
        .where((F.col("_n") > 1) | (F.col("at") < 0))
        .withColumn("copy", F.when(F.col("_runs") > HOT, 1).otherwise(0).cast("bigint"))  # of an anchor: whether it is hot
        .select((F.abs("at").bitwiseAND(F.lit((1 << 32) - 1)) - 1).cast("int").alias("block"), "anchor", "copy", *no_copy[1:])
        .unionByName(copies.select("block", F.lit(0).cast("bigint").alias("anchor"), "copy", "copy_h", F.lit(True).alias("is_copy")))
    )

    def cut_contexts(frame: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        anchors_, copies_ = _split(wanted)
        known = np.sort(anchors_["anchor"].to_numpy(dtype=np.int64).view(np.uint64))
        hot = set(anchors_["anchor"][anchors_["copy"] == 1])
        held: dict[bytes, list] = {}

        for doc, raw in originals(frame, copies_):
            first, past, value = runs(anchors(raw, width), known)
            for a, b, v in zip(first.tolist(), past.tolist(), value.view(np.int64).tolist(), strict=True):
                context = raw[a : b + width - 1]
                one = held.get(context)
                if one is None:
                    held[context] = [v, doc, doc]
                elif doc < one[1]:
                    one[1] = doc
                elif doc > one[2]:
                    one[2] = doc
        for context in [c for c, v in held.items() if v[0] in hot]:
            v, low, high = held.pop(context)
            for i in range(len(context) - width + 1):
                one = held.setdefault(context[i : i + width], [v, low, high])
                one[1], one[2] = min(one[1], low), max(one[2], high)
        block = int(frame["block"].iloc[0]) if len(frame) else 0
        values = list(held.values())
        is_hot = [v[0] in hot for v in values]
        return pd.DataFrame({
            "anchor": [v[0] for v in values], "context": list(held), "block": np.where(is_hot, -block - 1, block).astype(np.int32), "low": [v[1] for v in values], "high": [v[2] for v in values],
            "bucket": np.array([spread(c, buckets) if h else v[0] % buckets for c, v, h in zip(held, values, is_hot, strict=True)], dtype=np.int32),
        })

    contexts = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(cut_contexts, "anchor bigint, context binary, block int, low bigint, high bigint, bucket int")

    def resolve(frame: pd.DataFrame) -> pd.DataFrame:
        codes, distinct = pd.factorize(frame["context"].to_numpy())
        owner = np.full(len(distinct), last)
        np.minimum.at(owner, codes, frame["low"].to_numpy())
        anchor = np.empty(len(distinct), dtype=np.int64)
        anchor[codes] = frame["anchor"].to_numpy()
        _, group, number = np.unique(anchor, return_inverse=True, return_counts=True)
        hot = np.zeros(len(distinct), dtype=bool)
        hot[codes] = frame["block"].to_numpy() < 0
        alone = (number[group] == 1) | hot  # a hot anchor's contexts are single strings
        lowest: list = [None] * len(distinct)
        for c in np.flatnonzero(alone):
            lowest[c] = owner[c : c + 1]
        several = np.flatnonzero(~alone)
        for part in collections(group[several], np.fromiter((len(distinct[c]) for c in several), dtype=np.int64, count=len(several))):
            mine = several[part]
            for c, v in zip(mine, smallest_owners([distinct[c] for c in mine], owner[mine], width), strict=True):
                lowest[c] = v
        flat, size = np.concatenate(lowest), np.fromiter(map(len, lowest), dtype=np.int64, count=len(lowest))
        start = np.cumsum(size) - size
        matters = np.flatnonzero(np.minimum.reduceat(flat, start)[codes] < frame["high"].to_numpy())
        begins = np.append(True, flat[1:] != flat[:-1])
        begins[start] = True
        at = np.flatnonzero(begins)
        value, cut = flat[at].tolist(), np.append(np.searchsorted(at, start), len(at)).tolist()
        first = (at - np.repeat(start, size)[at]).tolist()
        steps = {}
        for c in np.unique(codes[matters]).tolist():
            steps[c] = (_key(distinct[c]), [-1] if hot[c] else first[cut[c] : cut[c + 1]], value[cut[c] : cut[c + 1]])
        chosen = [steps[c] for c in codes[matters].tolist()]
        part = frame.iloc[matters]
        home = part["block"].to_numpy()
        return pd.DataFrame({"block": np.where(home < 0, -home - 1, home), "anchor": part["anchor"].to_numpy(), "key": [c[0] for c in chosen], "first": [c[1] for c in chosen], "owner": [c[2] for c in chosen]})

    resolved = contexts.groupBy("bucket").applyInPandas(resolve, "block int, anchor bigint, key binary, first array<int>, owner array<bigint>")
    answers = resolved.select("*", *no_copy).unionByName(copies.select("block", F.lit(0).cast("bigint").alias("anchor"), "copy", "copy_h", F.lit(True).alias("is_copy")), allowMissingColumns=True)
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_kept else "")

    def cut_texts(frame: pd.DataFrame, answers_: pd.DataFrame) -> pd.DataFrame:
        found_, copies_ = _split(answers_)
        known = np.unique(found_["anchor"].to_numpy(dtype=np.int64).view(np.uint64))
        strings: dict[bytes, list[tuple[int, int]]] = {}  # hot context -> starts and owners of its strings
        lookup = {k: (f, o) for k, f, o in zip(found_["key"], found_["first"], found_["owner"], strict=True)}
        hot = {a for a, f in zip(found_["anchor"], found_["first"], strict=True) if f[0] < 0}
        gone_ = set(zip(copies_["copy"], copies_["copy_h"], strict=True))
        out = []
        for doc, h, text in zip(frame["_id"], frame["_h"], frame["_text"], strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            if (doc, h) in gone_:
                out.append((len(raw), len(raw), 1, hashlib.sha256(b"").hexdigest(), b""))
                continue
            edge = np.zeros(len(raw) + 1, dtype=np.int32)
            first, past, value = runs(anchors(raw, width), known) if lookup else (np.empty(0, np.int64),) * 3
            hit = False
            for a, b, v in zip(first.tolist(), past.tolist(), value.view(np.int64).tolist(), strict=True):
                if v in hot:
                    context = raw[a : b + width - 1]
                    if context not in strings:
                        answers = [lookup.get(_key(context[i : i + width])) for i in range(b - a)]
                        strings[context] = [(i, x[1][0]) for i, x in enumerate(answers) if x is not None]
                    for i, o in strings[context]:
                        if o < doc:
                            edge[a + i] += 1
                            edge[a + i + width] -= 1
                            hit = True
                    continue
                found = lookup.get(_key(raw[a : b + width - 1]))
                if found is None:
                    continue
                starts, owners = found
                for i, (s, o) in enumerate(zip(starts, owners, strict=True)):
                    if o < doc:
                        stop = starts[i + 1] if i + 1 < len(starts) else b - a
                        edge[a + s] += 1
                        edge[a + stop - 1 + width] -= 1
                        hit = True
            if hit:
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            else:
                out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
        table = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        table.insert(0, id_col, frame["_own"].to_numpy() if len(frame) else [])
        return table if with_kept else table.drop(columns="kept")

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(cut_texts, schema)
