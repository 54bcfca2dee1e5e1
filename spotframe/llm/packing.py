"""Packing token pieces into fixed-length sequences: dominance reduction, then best fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from spotframe.llm.common import save, small_batches, text_or_empty
from spotframe.llm.encoding import table

#: Ranks inside one length are counted in this many slices, so no length is ranked in one task.
SLICES = 4096


def token_pieces(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the token ids of every text, cut where they exceed capacity.

    `end_id` closes each document. Only the first piece of a cut document may be shorter than capacity. A
    null text counts as empty: it is the single id `end_id`. `ids` are little-endian unsigned 32-bit.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = table(vocab), np.uint32(end_id).tobytes()
        for batch in batches:
            ids, coded = batch.column(0), encoder.encode_batch(batch.column(1).to_pylist())
            row, piece, start, length, crc, raw = [], [], [], [], [], []
            for i, one in enumerate(coded):
                one += end
                n = len(one) // 4
                at, size = 0, n % capacity or capacity
                k = 0
                while at < n:
                    part = one[4 * at : 4 * (at + size)]
                    row.append(i), piece.append(k), start.append(at), length.append(size), crc.append(zlib.crc32(part))
                    if with_ids:
                        raw.append(part)
                    at, size, k = at + size, capacity, k + 1
            columns = [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = small_batches(docs).select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    return rows.mapInArrow(cut, schema).withColumnRenamed("_id", id_col)


class Stock:
    """Counts of lengths still to be placed; at most `capacity` different ones."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, count: int) -> None:
        self.n[size] -= count
        if not self.n[size]:
            del self.n[size]
            self.sizes.remove(size)

    def put(self, size: int, count: int) -> None:
        if size not in self.n:
            insort(self.sizes, size)
        self.n[size] = self.n.get(size, 0) + count

    def largest(self, most: int) -> int | None:
        i = bisect_right(self.sizes, most)
        return self.sizes[i - 1] if i else None

    def smallest(self, how_many: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.n[s], how_many - len(out))
            if len(out) == how_many:
                break
        return out


def dominating_set(stock: Stock, item: int, capacity: int) -> tuple[int, ...] | None:
    """What to put beside `item` (not in the stock now), if one choice dominates every other; else None.

    A set dominates another when the other's pieces can be shared out so that each share fits into one
    piece of the set: swapping them never needs more sequences.
    """
    room = capacity - item
    best = stock.largest(room)
    if best is None:
        return ()
    low = stock.smallest(3)
    if best == room or len(low) < 2 or low[0] + low[1] > room:
        return (best,)  # it fills the sequence, or nothing but single companions fit
    if len(low) == 3 and sum(low) <= room:
        return None  # three companions fit: undecided
    # two companions at most. The best pair led by the largest companion:
    stock.take(best, 1)
    second = stock.largest(room - best)
    stock.put(best, 1)
    floor = second or 0
    # a pair whose smaller piece exceeds `second` is dominated by neither choice, unless its sum is
    i = bisect_right(stock.sizes, floor)
    rival = None
    if i < len(stock.sizes):
        s = stock.sizes[i]
        t = s if stock.n[s] > 1 else (stock.sizes[i + 1] if i + 1 < len(stock.sizes) else None)
        rival = s + t if t is not None and s + t <= room else None
    if rival is None:
        return (best, second) if second else (best,)
    if second is None and _largest_pair(stock, room) <= best:
        return (best,)
    return None


def _largest_pair(stock: Stock, room: int) -> int:
    top = 0
    for s in stock.sizes:
        if 2 * s > room:
            break
        t = stock.largest(room - s)
        if t is not None and (t != s or stock.n[s] > 1):
            top = max(top, s + t)
    return top


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(fixed sets with their number, what is left), by the dominance reduction of Martello and Toth.

    Equal lengths are handled together: a fixed set is repeated until one of its lengths runs out.
    """
    stock, fixed = Stock(counts), []
    changed = True
    while changed:
        changed = False
        for item in sorted(stock.sizes, reverse=True):
            while item in stock.n:
                stock.take(item, 1)
                beside = dominating_set(stock, item, capacity)
                stock.put(item, 1)
                if beside is None:
                    break
                group = (item, *beside)
                need: dict[int, int] = defaultdict(int)
                for s in group:
                    need[s] += 1
                times = min(stock.n[s] // k for s, k in need.items())
                # the choice holds while the lengths it was derived from are there: none new appear
                for s, k in need.items():
                    stock.take(s, k * times)
                fixed.append((group, times))
                changed = True
    return fixed, dict(stock.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(set, number of sequences that hold it): lengths in descending order, each into the fullest sequence it fits."""
    free: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def shelve(room: int, group: tuple[int, ...], times: int) -> None:
        if times:
            if room not in open_:
                insort(free, room)
                open_[room] = []
            open_[room].append((group, times))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect_left(free, size)
            if i < len(free):
                room = free[i]
                group, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], free[i]
            else:
                room, group, times = capacity, (), left
            each = room // size
            whole = min(times, left // each)
            if whole:
                shelve(room - each * size, group + (size,) * each, whole)
                left -= whole * each
                rest = times - whole
            else:
                shelve(room - left * size, group + (size,) * left, 1)
                left, rest = 0, times - 1
            if group:
                shelve(room, group, rest)
    return [one for groups in open_.values() for one in groups]


def packing_plan(counts: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, offset): where the pieces of a length go, by their rank.

    Work and result depend on the number of different lengths (at most `capacity`), not on the pieces.
    """
    fixed, left = reduce_by_dominance(counts, capacity)
    used: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for group, times in [*fixed, *best_fit(left, capacity)]:
        at = 0
        for size in group:
            rows[size].append((used[size], sequence, at))
            used[size] += times
            at += size
        sequence += times
    return {s: np.asarray(r, dtype=np.int64) for s, r in rows.items()}


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """pieces plus (sequence_id, offset): as few sequences of `capacity` as the two methods find.

    Only the histogram of lengths reaches the driver: at most `capacity` rows, whatever the input. A
    piece's place follows from its rank among those of its length; ranks are counted per hash slice of
    the length and added up, so that a length that most pieces share is ranked by many tasks.

    Defined cases: an empty table gives no rows; a null or non-positive length, or one above capacity,
    is an error; equal pieces take different places; columns of other names are kept. `pieces` must be
    stored or cheap, as it is read twice.
    """
    checked = F.when(F.col("length").between(1, capacity), F.col("length")).otherwise(F.raise_error(F.lit("length outside 1..capacity")).cast("long"))
    slices = pieces.withColumn("length", checked).withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(SLICES)))
    counts = save(slices.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = packing_plan(histogram, capacity)
    running = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_slice", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_slice").orderBy(*order)
    ranked = slices.join(offsets, ["length", "_slice"]).withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1)
    names = [c for c in pieces.columns]
    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id bigint, offset bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for s in np.unique(size):
                at, rows = np.flatnonzero(size == s), plan[int(s)]
                hit = np.searchsorted(rows[:, 0], rank[at], "right") - 1
                sequence[at] = rows[hit, 1] + rank[at] - rows[hit, 0]
                offset[at] = rows[hit, 2]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return ranked.select(*names, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset) for every piece of every text."""
    return pack(save(token_pieces(docs, vocab, id_col, text_col, capacity, end_id, with_ids)), capacity, (id_col, "piece"))
