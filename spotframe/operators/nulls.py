"""Null models of partner signal at spots: random positions, rings, rotations, translations.

A nucleus travels as one row: the band of pixels around it and its spots, the runs of its mask and of its
nucleoli. There the disk mean, or all ring means, of its window are taken at once, after which a draw is an
array lookup and the draws of all iterations are one matrix. Nothing is computed off the nuclei and no plane is
stored. What is asked of a nucleus or an image (mean and spread of its iterations, a percentile, sums over its
nuclei) is taken in the task that draws, so iterations leave it only where they are the result. The spots of a
crowded nucleus are cut into chunks, which spread over rows; sums of iterations stay arrays unless a nucleus
has several chunks. Draws are counter-based, so results do not depend on partitioning or on task retries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spotframe.functions.draws import PRIME, SHIFTS, WEIGHTS, draw_index, stream
from spotframe.functions.ranks import quantiles
from spotframe.functions.scalars import ratio
from spotframe.functions.stencils import disk, rings
from spotframe.operators.frames import value_at
from spotframe.operators.runs import id_at, rows_of_runs, to_runs
from spotframe.session import cut_lineage

KEY = ["image", "nucleus_id"]
CHUNK = 256
FIXED_ANGLES = (90.0, 180.0, 270.0)
# Offsets of the seed for the separate random streams of each null family.
POSITION, RADIAL, ROTATION, TRANSLATION, ASSOCIATION = 0, 101, 202, 404, 303


def observed_spots(spots: DataFrame, plane_rows: DataFrame, holes: DataFrame | None = None) -> DataFrame:
    """(image, nucleus_id, spot_id, cy, cx): rounded, clipped centres; spots over ``holes`` are dropped."""
    size = plane_rows.groupBy("image").agg(F.max("y").alias("_h"), (F.max(F.size("vals")) - 1).alias("_w"))
    zero = F.lit(0).cast("long")
    out = (
        spots.where(F.col("nucleus_id") > 0)
        .join(size, "image")
        .select(
            *KEY, "spot_id",
            F.greatest(zero, F.least(F.rint("y_px").cast("long"), F.col("_h"))).alias("cy"),
            F.greatest(zero, F.least(F.rint("x_px").cast("long"), F.col("_w").cast("long"))).alias("cx"),
        )
    )
    if holes is None:
        return out
    rows = rows_of_runs([_hole_runs(holes)]).select("image", F.col("y").alias("cy"), F.col("cells").alias("_cells"))
    over = id_at(F.col("_cells"), F.col("cx"), 0)
    return out.join(rows, ["image", "cy"], "left").where(~over.eqNullSafe(F.col("nucleus_id"))).select(*out.columns)


def _hole_runs(holes: DataFrame) -> DataFrame:
    return holes if "x0" in holes.columns or "ids" in holes.columns else holes.select("image", "y", "x", "nucleolus_id")


def _label_runs(labels: DataFrame) -> DataFrame:
    return labels if "x0" in labels.columns or "ids" in labels.columns else labels.select("image", "y", "x", "nucleus_id")


def sampling_region(labels: DataFrame, holes: DataFrame | None = None) -> DataFrame:
    """Nucleus pixels without nucleoli; the whole nucleus where nothing would be left."""
    if holes is None:
        return labels.select("image", "y", "x", "nucleus_id")
    hit = holes.select("image", "y", "x", F.col("nucleolus_id").alias("nucleus_id"), F.lit(1).alias("_hole"))
    marked = labels.select("image", "y", "x", "nucleus_id").join(hit, ["image", "y", "x", "nucleus_id"], "left")
    left = marked.groupBy(*KEY).agg(F.count(F.when(F.col("_hole").isNull(), 1)).alias("_left"))
    return marked.join(left, KEY).where(F.col("_hole").isNull() | (F.col("_left") == 0)).drop("_hole", "_left")


def _observed(spots: DataFrame, mean_rows: DataFrame) -> DataFrame:
    at = value_at(spots, mean_rows, "cy", "cx", "v")
    return at.groupBy(*KEY).agg(F.avg("v").alias("obs"), F.count(F.lit(1)).alias("n_spots"))


def _one_plane(plane_rows: DataFrame) -> DataFrame:
    return plane_rows.select("image", "y", "vals")


def _draw(state: np.ndarray, *counters: np.ndarray) -> np.ndarray:
    """The numbers of ``functions.draws.draw`` for whole arrays of counters."""
    total = state
    for c, weight in zip(counters, WEIGHTS):
        total = total + c * weight
    out = _modulo(total)
    for shift, c in zip(SHIFTS, (counters * 2)[::-1]):
        out = _modulo(out * (out + shift) + c)
    return out


def _modulo(x: np.ndarray) -> np.ndarray:
    """x % PRIME for whole numbers from 0 to 2^63 - 1: as 2^31 is 1 modulo the prime, the upper bits are added to the lower."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return x - PRIME * (x >= PRIME)


def _nuclei(spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None, reach: int, seed: int) -> DataFrame:
    """One row per nucleus with spots and mask, and chunk of its spots.

    (KEY, part, parts, n_spots, my, mx, state, height, width, y0, x0, band, mask, holes, sp): band holds the pixels
    from (y0, x0) on that lie within reach of the mask or a spot, cut at the frame; sp are the chunk's spots.
    """
    seen = cut_lineage(observed_spots(spots, plane_rows, holes), True)
    runs = to_runs(_label_runs(labels)).withColumnRenamed("id", "nucleus_id")
    run = F.struct(F.col("y").cast("long").alias("y"), F.col("x0").cast("long").alias("x0"), F.col("x1").cast("long").alias("x1"))
    mask = runs.groupBy(*KEY).agg(
        F.collect_list(run).alias("mask"), F.min("y").alias("_y0"), F.max("y").alias("_y1"), F.min("x0").alias("_x0"), F.max("x1").alias("_x1")
    )
    centre = seen.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_spots"), F.avg("cy").alias("my"), F.avg("cx").alias("mx"),
        F.min("cy").alias("_s0"), F.max("cy").alias("_s1"), F.min("cx").alias("_t0"), F.max("cx").alias("_t1"),
    )
    frame = plane_rows.groupBy("image").agg((F.max("y") + 1).alias("height"), F.max(F.size("vals")).cast("long").alias("width"))
    low = lambda a, b: F.greatest(F.least(a, b).cast("long") - reach, F.lit(0).cast("long"))
    high = lambda a, b, n: F.least(F.greatest(a, b).cast("long") + reach, F.col(n) - 1)
    boxes = cut_lineage(
        centre.join(mask, KEY).join(frame, "image").select(
            *KEY, "n_spots", "my", "mx", "height", "width", "mask", stream(seed, *[F.col(k) for k in KEY]).alias("state"),
            low("_y0", "_s0").alias("y0"), high("_y1", "_s1", "height").alias("y1"), low("_x0", "_t0").alias("x0"), high("_x1", "_t1", "width").alias("x1"),
        ),
        True,
    )
    lines = boxes.select(*KEY, "x0", "x1", F.explode(F.sequence("y0", "y1")).alias("y")).join(plane_rows.select("image", "y", "vals"), ["image", "y"])
    cut = F.slice("vals", (F.col("x0") + 1).cast("int"), (F.col("x1") - F.col("x0") + 1).cast("int"))
    bands = lines.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("y", cut.alias("v")))).alias("_b")).select(*KEY, F.transform("_b", lambda r: r["v"]).alias("band"))
    whole = boxes.drop("y1", "x1").join(bands, KEY)
    none = F.array().cast("array<struct<y:bigint,x0:bigint,x1:bigint>>")
    if holes is not None:
        spared = to_runs(_hole_runs(holes)).withColumnRenamed("id", "nucleus_id").groupBy(*KEY).agg(F.collect_list(run).alias("holes"))
        whole = whole.join(spared, KEY, "left").withColumn("holes", F.coalesce("holes", none))
    else:
        whole = whole.withColumn("holes", none)
    # a spot's chunk follows from its id, so no ordering of a whole nucleus is needed
    parts = F.expr(f"(n_spots + {CHUNK - 1}) div {CHUNK}")
    dealt = seen.join(boxes.select(*KEY, "n_spots"), KEY).withColumn("part", F.pmod(F.xxhash64("spot_id"), parts))
    # stored, as spots then come to the planes, which are larger and stand by image already
    chunks = cut_lineage(dealt.groupBy(*KEY, "part").agg(F.collect_list(F.struct("spot_id", "cy", "cx")).alias("sp")), True)
    # every number of a chunk is there, also where no spot's id falls on it
    numbered = whole.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    no_spots = F.array().cast(chunks.schema["sp"].dataType)
    out = numbered.join(chunks, [*KEY, "part"], "left").withColumn("sp", F.coalesce("sp", no_spots))
    if boxes.where(F.col("n_spots") > CHUNK).isEmpty():
        return out
    # the chunks of a crowded nucleus leave the task that it stands in; the other nuclei of an image stay together
    return out.repartition("image", F.when(F.col("parts") > 1, F.xxhash64("nucleus_id", "part")))


class _Lists:
    """The lists of one column of a batch: views of a flat array."""

    def __init__(self, column: pa.ListArray, field: str | None = None) -> None:
        self.at = column.offsets.to_numpy()
        self.flat = (column.values if field is None else column.values.field(field)).to_numpy(zero_copy_only=False)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.at[i] : self.at[i + 1]]


def _nuclei_of(batch: pa.RecordBatch) -> Iterator[_Nucleus]:
    columns = dict(zip(batch.schema.names, batch.columns))
    numbers = {c: columns[c].to_pylist() for c in (*KEY, "part", "parts", "n_spots", "my", "mx", "state", "height", "width", "y0", "x0")}
    lines = columns["band"].offsets.to_numpy()
    pixels = _Lists(columns["band"].values)
    runs = {c: [_Lists(columns[c], f) for f in ("y", "x0", "x1")] for c in ("mask", "holes")}
    spots = [_Lists(columns["sp"], f) for f in ("spot_id", "cy", "cx")]
    for i in range(batch.num_rows):
        first, last = lines[i], lines[i + 1]
        band = pixels.flat[pixels.at[first] : pixels.at[last]].reshape(last - first, -1)
        yield _Nucleus({c: v[i] for c, v in numbers.items()}, band, *([r[i] for r in runs[c]] for c in ("mask", "holes")), *(s[i] for s in spots))


def _batch(schema: str, columns: Sequence) -> pa.RecordBatch:
    """Rows for Spark; ``schema`` as in DDL, columns of long, double and arrays of these."""
    plain = {"long": pa.int64(), "double": pa.float64()}
    kinds = dict(part.split() for part in schema.split(", "))
    types = [plain[k] if k in plain else pa.list_(plain[k[6:-1]]) for k in kinds.values()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(kinds))


def _rows(batch: pa.RecordBatch, schema: str, row_of: Callable[[_Nucleus], tuple]) -> pa.RecordBatch:
    """One row for each nucleus of a batch."""
    out = [row_of(nucleus) for nucleus in _nuclei_of(batch)]
    return _batch(schema, list(zip(*out)) if out else [[] for _ in schema.split(", ")])


class _Nucleus:
    """One chunk row as arrays: window, sampling mask, spots, and the means of a stencil at every pixel of the window."""

    def __init__(self, numbers: dict, band: np.ndarray, mask: Sequence[np.ndarray], holes: Sequence[np.ndarray], spot_id: np.ndarray, cy: np.ndarray, cx: np.ndarray) -> None:
        self.__dict__.update(numbers)
        self.band = band
        inside, spared = self._filled(mask), self._filled(holes)
        left = inside & ~spared
        # the whole nucleus where nothing would be left
        self.mask = left if left.any() else inside
        self.cy, self.cx, self.word = cy, cx, spot_id % PRIME
        self.grid = None

    def _filled(self, runs: Sequence[np.ndarray]) -> np.ndarray:
        out = np.zeros(self.band.shape, bool)
        for y, x0, x1 in zip(*(r.tolist() for r in runs)):
            y -= self.y0
            if 0 <= y < out.shape[0]:
                out[y, max(x0 - self.x0, 0) : max(x1 - self.x0 + 1, 0)] = True
        return out

    def means(self, offsets: Sequence[tuple[int, int]]) -> np.ndarray:
        """Stencil means with every offset clipped to the frame, summed in the same order at every pixel."""
        reach = max(max(abs(dy), abs(dx)) for dy, dx in offsets)
        h, w = self.band.shape
        rows = np.clip(np.arange(self.y0 - reach, self.y0 + h + reach), 0, self.height - 1) - self.y0
        cols = np.clip(np.arange(self.x0 - reach, self.x0 + w + reach), 0, self.width - 1) - self.x0
        # beyond the band, but within the frame, no pixel of the mask and no spot looks
        wide = self.band[np.clip(rows, 0, h - 1)][:, np.clip(cols, 0, w - 1)]
        total = np.zeros((h, w))
        for dy, dx in offsets:
            total += wide[reach + dy : reach + dy + h, reach + dx : reach + dx + w]
        return total / len(offsets)

    def look(self, offsets: Sequence[tuple[int, int]]) -> _Nucleus:
        """Take the means of a stencil: v at the spots, and NaN off the mask in the grid that turned spots look at."""
        means = self.means(offsets)
        self.v = means[self.cy - self.y0, self.cx - self.x0]
        self.grid = np.where(self.mask, means, np.nan)
        return self

    def at(self, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        y, x = y - self.y0, x - self.x0
        inside = (y >= 0) & (y < self.grid.shape[0]) & (x >= 0) & (x < self.grid.shape[1])
        return np.where(inside, self.grid[np.where(inside, y, 0), np.where(inside, x, 0)], np.nan)


def _drawn_sums(nucleus: _Nucleus, values: np.ndarray, n: int) -> np.ndarray:
    """(stencils, n): sums of the values drawn by this chunk's share of the spots, for all stencils at the same pixels."""
    first = nucleus.part * CHUNK
    spots = np.arange(first, min(first + CHUNK, nucleus.n_spots), dtype=np.int64)[:, None]
    iters = np.arange(1, n + 1, dtype=np.int64)[None, :]
    at = (_draw(np.int64(nucleus.state), iters, spots) / float(PRIME) * values.shape[1]).astype(np.int64)
    return np.stack([one.take(at).sum(axis=0) for one in values])


Stencils = Sequence[Sequence[tuple[int, int]]]


def _seen_and_drawn(nucleus: _Nucleus, n: int, stencils: Stencils) -> tuple[list[float], np.ndarray]:
    """Sums at the spots and, by iteration, at drawn pixels; one line for each stencil."""
    means = [nucleus.means(offsets) for offsets in stencils]
    seen = [float(m[nucleus.cy - nucleus.y0, nucleus.cx - nucleus.x0].sum()) for m in means]
    return seen, _drawn_sums(nucleus, np.stack([m[nucleus.mask] for m in means]), n)


POSITIONS = "image long, nucleus_id long, parts long, n_spots long, seen array<double>, sums array<double>"
PROFILE = f"{POSITIONS}, mean array<double>, sd array<double>"


def _position_batches(batches: Iterator[pa.RecordBatch], n: int, stencils: Stencils) -> Iterator[pa.RecordBatch]:
    def row(nucleus: _Nucleus) -> tuple:
        seen, sums = _seen_and_drawn(nucleus, n, stencils)
        return nucleus.image, nucleus.nucleus_id, nucleus.parts, nucleus.n_spots, seen, sums.ravel()

    return (_rows(batch, POSITIONS, row) for batch in batches)


def _profile_batches(batches: Iterator[pa.RecordBatch], n: int, stencils: Stencils) -> Iterator[pa.RecordBatch]:
    """As positions, but with mean and spread of the iterations; the sums stay only where other chunks are to be added."""
    def row(nucleus: _Nucleus) -> tuple:
        seen, sums = _seen_and_drawn(nucleus, n, stencils)
        many = nucleus.parts > 1
        means, spread = _mean_and_spread(sums / nucleus.n_spots)
        return nucleus.image, nucleus.nucleus_id, nucleus.parts, nucleus.n_spots, seen, sums.ravel() if many else [], [] if many else means, [] if many else spread

    return (_rows(batch, PROFILE, row) for batch in batches)


def _mean_and_spread(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = values.shape[1]
    return values.mean(axis=1), values.std(axis=1, ddof=1) if n > 1 else np.zeros(len(values))


#: Images whose sums a task holds at once.
HELD = 512
POOLED = "image long, n_spots long, n_nuclei long, seen double, sums array<double>"


def _pooled_batches(batches: Iterator[pa.RecordBatch], n: int, offsets: Sequence[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Sums over the nuclei of an image that stand in one task; an image may leave it in several rows."""
    held: dict = {}

    def rows() -> pa.RecordBatch:
        return _batch(POOLED, [list(held), *zip(*held.values())])

    for batch in batches:
        for nucleus in _nuclei_of(batch):
            (seen,), (sums,) = _seen_and_drawn(nucleus, n, [offsets])
            once = nucleus.part == 0
            if nucleus.image not in held and len(held) == HELD:
                yield rows()
                held.clear()
            mine = held.setdefault(nucleus.image, [0, 0, 0.0, np.zeros(n)])
            mine[0] += nucleus.n_spots if once else 0
            mine[1] += 1 if once else 0
            mine[2] += seen
            mine[3] += sums
    if held:
        yield rows()


def _whole(chunks: DataFrame, sums: Sequence[str]) -> DataFrame:
    """chunks (KEY, parts, n_spots, sums ARRAY ...) with the arrays of a nucleus added up; most nuclei are one chunk."""
    one = chunks.where("parts = 1").select(*KEY, "n_spots", *sums)
    many = chunks.where("parts > 1").select(*KEY, "n_spots", F.posexplode(F.arrays_zip(*sums)).alias("_i", "_r"))
    added = many.groupBy(*KEY, "n_spots", "_i").agg(*[F.sum(f"_r.{s}").alias(s) for s in sums])
    ordered = added.groupBy(*KEY, "n_spots").agg(F.sort_array(F.collect_list(F.struct("_i", *sums))).alias("_a"))
    arrays = [F.col(f"_a.{s}").alias(s) for s in sums]
    return one.unionByName(ordered.select(*KEY, "n_spots", *arrays))


def _positions(spots, plane_rows, labels, holes, n: int, stencils, seed: int) -> tuple[DataFrame, DataFrame]:
    """(sums (KEY, n_spots, sums), observed (KEY, n_spots, seen)), both arrays, one stencil after the other."""
    reach = max(max(abs(dy), abs(dx)) for offsets in stencils for dy, dx in offsets)
    nuclei = _nuclei(spots, _one_plane(plane_rows), labels, holes, reach, seed)
    chunks = cut_lineage(nuclei.mapInArrow(lambda it: _position_batches(it, n, stencils), POSITIONS), True)
    return _whole(chunks.drop("seen"), ["sums"]), _whole(chunks.drop("sums"), ["seen"])


def position_null(
    spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None = None, n: int = 1000, disk_px: float = 3.0, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(draws (KEY, n_spots, iter, value), observed (KEY, obs, n_spots)).

    Each iteration draws as many pixels of the nucleus as it has spots and averages their disk means. Nuclei
    without a pixel in the mask have neither.
    """
    sums, seen = _positions(spots, plane_rows, labels, holes, n, [disk(disk_px)], seed + POSITION)
    drawn = sums.select(*KEY, "n_spots", F.posexplode("sums").alias("_i", "_s"))
    draws = drawn.select(*KEY, "n_spots", (F.col("_i") + 1).alias("iter"), (F.col("_s") / F.col("n_spots")).alias("value"))
    return draws, seen.select(*KEY, (F.get("seen", F.lit(0)) / F.col("n_spots")).alias("obs"), "n_spots")


def pooled_position_null(
    spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None = None, n: int = 1000, disk_px: float = 3.0, seed: int = 0
) -> DataFrame:
    """(image, obs, n_spots, n_nuclei, values): ``position_null`` with the nuclei of an image weighted by their spot counts.

    values are the iterations of the image, as ``pool_draws`` gives them. No iteration of a nucleus leaves its task.
    """
    offsets = disk(disk_px)
    nuclei = _nuclei(spots, _one_plane(plane_rows), labels, holes, max(max(abs(dy), abs(dx)) for dy, dx in offsets), seed + POSITION)
    return _pooled(nuclei.mapInArrow(lambda it: _pooled_batches(it, n, offsets), POOLED))


def _pooled(partial: DataFrame) -> DataFrame:
    """Images from rows of ``POOLED``; sorted rows are added in the same order each time."""
    rows = F.sort_array(F.collect_list("sums"))
    whole = partial.groupBy("image").agg(F.sum("n_spots").alias("n_spots"), F.sum("n_nuclei").alias("n_nuclei"), F.sum("seen").alias("seen"), rows.alias("_r"))
    added = F.aggregate(F.slice("_r", 2, F.size("_r")), F.get("_r", F.lit(0)), lambda a, r: F.zip_with(a, r, lambda x, y: x + y))
    sums = F.when(F.size("_r") == 1, F.get("_r", F.lit(0))).otherwise(added)
    values = F.transform(sums, lambda s: s / F.col("n_spots"))
    return cut_lineage(whole.select("image", (F.col("seen") / F.col("n_spots")).alias("obs"), "n_spots", "n_nuclei", values.alias("values")), True)


def image_draws(pooled: DataFrame) -> DataFrame:
    """(image, obs, further columns, iter, value) of pooled images; they are unpacked where they stand."""
    keep = [c for c in pooled.columns if c not in ("values", "n_spots", "n_nuclei")]
    return pooled.select(*keep, F.posexplode("values").alias("_i", "value")).select(*keep, (F.col("_i") + 1).alias("iter"), "value")


def radial_null(
    spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None = None, n: int = 1000,
    bins_um: Sequence[float] = (0.25, 0.5, 0.75, 1.0), voxel_xy_um: float = 0.13, seed: int = 0,
) -> DataFrame:
    """(KEY, ring_um, obs_mean, null_mean, null_sd, n_spots): rings share one set of drawn positions."""
    kept = [(float(edge), offsets) for edge, offsets in zip(bins_um, rings([b / voxel_xy_um for b in bins_um])) if offsets]
    stencils = [offsets for _, offsets in kept]
    reach = max(max(abs(dy), abs(dx)) for offsets in stencils for dy, dx in offsets)
    nuclei = _nuclei(spots, _one_plane(plane_rows), labels, holes, reach, seed + RADIAL)
    chunks = cut_lineage(nuclei.mapInArrow(lambda it: _profile_batches(it, n, stencils), PROFILE), True)
    one = chunks.where("parts = 1").select(*KEY, "n_spots", "seen", "mean", "sd")
    many = chunks.where("parts > 1").drop("mean", "sd")
    whole = _whole(many.drop("seen"), ["sums"]).join(_whole(many.drop("sums"), ["seen"]).drop("n_spots"), KEY)
    crowded = whole.mapInArrow(lambda it: _whole_profiles(it, len(kept), n), "image long, nucleus_id long, n_spots long, seen array<double>, mean array<double>, sd array<double>")
    edges = F.array(*[F.lit(edge) for edge, _ in kept])
    each = one.unionByName(crowded).select(*KEY, "n_spots", F.posexplode(F.arrays_zip("seen", "mean", "sd")).alias("_k", "_r"))
    return each.select(
        *KEY, F.get(edges, F.col("_k")).alias("ring_um"), (F.col("_r.seen") / F.col("n_spots")).alias("obs_mean"),
        F.col("_r.mean").alias("null_mean"), F.col("_r.sd").alias("null_sd"), "n_spots",
    )


def _whole_profiles(batches: Iterator[pa.RecordBatch], stencils: int, n: int) -> Iterator[pa.RecordBatch]:
    """Mean and spread of the iterations of crowded nuclei, whose chunks were added up."""
    schema = "image long, nucleus_id long, n_spots long, seen array<double>, mean array<double>, sd array<double>"
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        counts, sums = columns["n_spots"].to_pylist(), _Lists(columns["sums"])
        stats = [_mean_and_spread(sums[i].reshape(stencils, n) / c) for i, c in enumerate(counts)]
        yield _batch(schema, [*(columns[c].to_pylist() for c in (*KEY, "n_spots", "seen")), [m for m, _ in stats], [s for _, s in stats]])


def pool_radial(radial: DataFrame) -> DataFrame:
    """(image, ring_um, ...): ring values of an image weighted by spot counts."""
    w = F.col("n_spots")
    pooled = [(F.sum(w * F.col(c)) / F.sum(w)).alias(c) for c in ("obs_mean", "null_mean", "null_sd")]
    out = radial.groupBy("image", "ring_um").agg(*pooled, F.sum(w).alias("n_spots"))
    return out.withColumn("enrichment", ratio(F.col("obs_mean"), F.col("null_mean"))).withColumn(
        "z", ratio(F.col("obs_mean") - F.col("null_mean"), F.col("null_sd"))
    )


def _angles(state: int, *counters: np.ndarray) -> np.ndarray:
    return 360.0 * (_draw(np.int64(state), *counters) / float(PRIME))


def _sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.isfinite(values).sum(axis=1), np.nansum(values, axis=1)


#: Turned spots that are taken at once, over the nuclei of a group and their iterations.
TURNED = 1 << 16


class _Group:
    """Nuclei of a batch side by side: one column for each spot, so that all of them turn in the same steps."""

    def __init__(self, nuclei: Sequence[_Nucleus]) -> None:
        counts = [n.cy.size for n in nuclei]
        self.first = np.cumsum([0, *counts[:-1]])
        self.of = np.repeat(np.arange(len(nuclei)), counts)
        starts = np.cumsum([0, *(n.grid.size for n in nuclei[:-1])])
        self.flat = np.concatenate([n.grid.ravel() for n in nuclei])
        each = lambda values: np.array(values)[self.of]
        self.start, self.y0, self.x0 = each(starts), each([n.y0 for n in nuclei]), each([n.x0 for n in nuclei])
        self.h, self.w = each([n.grid.shape[0] for n in nuclei]), each([n.grid.shape[1] for n in nuclei])
        self.my, self.mx = each([n.my for n in nuclei]), each([n.mx for n in nuclei])
        self.states = np.array([n.state for n in nuclei], dtype=np.int64)
        self.state = self.states[self.of]
        self.word, self.v = np.concatenate([n.word for n in nuclei]), np.concatenate([n.v for n in nuclei])
        self.oy, self.ox = np.concatenate([n.cy for n in nuclei]) - self.my, np.concatenate([n.cx for n in nuclei]) - self.mx

    def turned(self, cos: np.ndarray, sin: np.ndarray, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Means under the spots turned about the centres of their nuclei, NaN off the mask."""
        oy, ox = self.oy[which], self.ox[which]
        y = np.rint(self.my[which] + (oy * cos - ox * sin)).astype(np.int64) - self.y0[which]
        x = np.rint(self.mx[which] + (oy * sin + ox * cos)).astype(np.int64) - self.x0[which]
        w = self.w[which]
        inside = (y >= 0) & (y < self.h[which]) & (x >= 0) & (x < w)
        return np.where(inside, self.flat[np.where(inside, self.start[which] + y * w + x, 0)], np.nan)

    def added(self, values: np.ndarray) -> np.ndarray:
        """(nuclei, iterations) from (iterations, spots)."""
        return np.add.reduceat(values, self.first, axis=1).T


def _groups(batch: pa.RecordBatch, offsets: Sequence[tuple[int, int]], n: int) -> Iterator[tuple[list[_Nucleus], _Group]]:
    """Nuclei with spots of a batch, so many that their iterations are about ``TURNED`` turned spots."""
    held, spots = [], 0
    for nucleus in _nuclei_of(batch):
        if nucleus.cy.size == 0:
            continue
        held.append(nucleus.look(offsets))
        spots += nucleus.cy.size
        if spots * n >= TURNED:
            yield held, _Group(held)
            held, spots = [], 0
    if held:
        yield held, _Group(held)


def _rotated(group: _Group, n: int, max_redraw: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n_in, s_in, s_all), each (nuclei, iterations)."""
    iters = np.arange(1, n + 1, dtype=np.int64)
    angles = _angles(group.states[None, :], iters[:, None])
    fixed = min(n, len(FIXED_ANGLES))
    angles[:fixed] = np.array(FIXED_ANGLES[:fixed])[:, None]
    angles = np.radians(angles)
    kept = group.turned(np.cos(angles)[:, group.of], np.sin(angles)[:, group.of])
    fits = np.isfinite(kept)
    n_in, s_in = group.added(fits.astype(np.int64)), group.added(np.where(fits, kept, 0.0))
    i, s = np.nonzero(~fits)
    for attempt in range(1, max_redraw + 1):
        if i.size == 0:
            break
        again = np.radians(_angles(group.state[s], iters[i], group.word[s], np.int64(attempt)))
        kept[i, s] = found = group.turned(np.cos(again), np.sin(again), s)
        missing = ~np.isfinite(found)
        i, s = i[missing], s[missing]
    kept[i, s] = group.v[s]
    return n_in, s_in, group.added(kept)


TURNS = "image long, nucleus_id long, parts long, n_spots long, seen array<double>, n_in array<long>, s_in array<double>, s_all array<double>"


def _rotation_batches(batches: Iterator[pa.RecordBatch], n: int, max_redraw: int, offsets: Sequence[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for nuclei, group in _groups(batch, offsets, n):
            rows = zip(nuclei, *_rotated(group, n, max_redraw))
            yield _batch(TURNS, list(zip(*((u.image, u.nucleus_id, u.parts, u.n_spots, [float(u.v.sum())], *sums) for u, *sums in rows))))


MOVES = "image long, nucleus_id long, parts long, n_spots long, seen array<double>, n_in array<long>, s_in array<double>"


def _translation_batches(batches: Iterator[pa.RecordBatch], n: int, offsets: Sequence[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    iters = np.arange(1, n + 1, dtype=np.int64)

    def row(nucleus: _Nucleus) -> tuple:
        nucleus.look(offsets)
        py, px = np.nonzero(nucleus.mask)
        py, px = py + nucleus.y0, px + nucleus.x0
        anchor = np.floor(_draw(np.int64(nucleus.state), iters) / float(PRIME) * py.size).astype(np.int64)
        dy, dx = py[anchor] - int(np.rint(nucleus.my)), px[anchor] - int(np.rint(nucleus.mx))
        n_in, s_in = _sums(nucleus.at(nucleus.cy[None, :] + dy[:, None], nucleus.cx[None, :] + dx[:, None]))
        return nucleus.image, nucleus.nucleus_id, nucleus.parts, nucleus.n_spots, [float(nucleus.v.sum())], n_in, s_in

    return (_rows(batch, MOVES, row) for batch in batches)


SINGLE = "image long, nucleus_id long, parts long, threshold double, fraction double, seen array<double>, vs array<double>"


def _single_batches(batches: Iterator[pa.RecordBatch], n: int, p: float, min_values: int, offsets: Sequence[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Percentile and share above it of whole nuclei; the values themselves only where other chunks have more of them."""
    iters = np.arange(1, n + 1, dtype=np.int64)
    for batch in batches:
        for nuclei, group in _groups(batch, offsets, n):
            angles = np.radians(_angles(group.states[None, :], iters[:, None]))
            values = group.turned(np.cos(angles)[:, group.of], np.sin(angles)[:, group.of])
            rows = []
            for nucleus, first in zip(nuclei, group.first):
                own = values[:, first : first + nucleus.cy.size]
                own = own[np.isfinite(own)]
                key = (nucleus.image, nucleus.nucleus_id, nucleus.parts)
                if nucleus.parts > 1:
                    rows.append((*key, None, None, nucleus.v, own))
                elif own.size >= min_values:
                    cut = _quantile(own, p)
                    rows.append((*key, cut, float((nucleus.v > cut).mean()), [], []))
            if rows:
                yield _batch(SINGLE, list(zip(*rows)))


def _quantile(values: np.ndarray, p: float) -> float:
    """The value that ``functions.ranks.quantiles`` gives: linear between neighbours."""
    position = p * (values.size - 1)
    low, high = int(np.floor(position)), int(np.ceil(position))
    ordered = np.partition(values, (low, high))
    return float(ordered[low] + (ordered[high] - ordered[low]) * (position - low))


def _moved(batches: Callable, schema: str, spots, plane_rows, labels, holes, disk_px: float, seed: int) -> DataFrame:
    """Rows of a null that moves whole nuclei of spots, by chunk, stored."""
    offsets = disk(disk_px)
    reach = max(max(abs(dy), abs(dx)) for dy, dx in offsets)
    nuclei = _nuclei(spots, _one_plane(plane_rows), labels, holes, reach, seed)
    return cut_lineage(nuclei.mapInArrow(lambda it: batches(it, offsets), schema), True)


def _observed_of(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(*KEY, "n_spots").agg((F.sum(F.get("seen", F.lit(0))) / F.col("n_spots")).alias("obs")).select(*KEY, "obs", "n_spots")


def rotation_null(
    spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None = None, n: int = 1000, disk_px: float = 3.0,
    min_retention: float = 0.5, max_redraw: int = 40, seed: int = 0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(draws (KEY, n_spots, iter, value, drop_value, retention), nuclei with obs and retention, observed).

    A nucleus' spots turn about their centroid by 90, 180, 270, then random degrees. A spot leaving the
    mask is turned again by angles of its own until it fits, else it stays where it was observed;
    drop_value averages only the spots that fitted at once.
    """
    chunks = _moved(lambda it, offsets: _rotation_batches(it, n, max_redraw, offsets), TURNS, spots, plane_rows, labels, holes, disk_px, seed + ROTATION)
    whole = _whole(chunks.drop("seen"), ["n_in", "s_in", "s_all"])
    per = whole.select(*KEY, "n_spots", F.posexplode(F.arrays_zip("n_in", "s_in", "s_all")).alias("_i", "_r"))
    sums = per.select(*KEY, "n_spots", (F.col("_i") + 1).alias("iter"), "_r.n_in", "_r.s_in", "_r.s_all")
    draws = sums.select(
        *KEY, "n_spots", "iter", (F.col("s_all") / F.col("n_spots")).alias("value"),
        ratio(F.col("s_in"), F.col("n_in")).alias("drop_value"), (F.col("n_in") / F.col("n_spots")).alias("retention"),
    )
    usable = whole.select(*KEY, _median_share("n_in").alias("median_retention"))
    nuclei = usable.select(*KEY, "median_retention", ((F.col("median_retention") >= min_retention) & F.lit(n >= 2)).alias("usable"))
    return draws, nuclei, _observed_of(chunks)


def _turned_pools(batches: Iterator[pa.RecordBatch], n: int, max_redraw: int, min_retention: float, offsets: Sequence[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Rows of ``TURNS`` of crowded nuclei, and without a nucleus the sums over the usable other nuclei of an image."""
    held: dict = {}

    def row(image: int, spots: int, nuclei: int, seen: float, sums: np.ndarray) -> tuple:
        return image, None, nuclei, spots, [seen], [], [], sums

    for batch in batches:
        out = []
        for nuclei, group in _groups(batch, offsets, n):
            for u, n_in, s_in, s_all in zip(nuclei, *_rotated(group, n, max_redraw)):
                if u.parts > 1:
                    out.append((u.image, u.nucleus_id, u.parts, u.n_spots, [float(u.v.sum())], n_in, s_in, s_all))
                elif n >= 2 and np.median(n_in / u.n_spots) >= min_retention:
                    if u.image not in held and len(held) == HELD:
                        out += [row(image, *mine) for image, mine in held.items()]
                        held.clear()
                    mine = held.setdefault(u.image, [0, 0, 0.0, np.zeros(n)])
                    mine[0] += u.n_spots
                    mine[1] += 1
                    mine[2] += float(u.v.sum())
                    mine[3] += s_all
        if out:
            yield _batch(TURNS, list(zip(*out)))
    if held:
        yield _batch(TURNS, list(zip(*(row(image, *mine) for image, mine in held.items()))))


def pooled_rotation_null(
    spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None = None, n: int = 1000, disk_px: float = 3.0,
    min_retention: float = 0.5, max_redraw: int = 40, seed: int = 0,
) -> DataFrame:
    """(image, obs, n_spots, n_nuclei, values) of ``rotation_null`` over its usable nuclei, as in ``pooled_position_null``."""
    rows = _moved(lambda it, offsets: _turned_pools(it, n, max_redraw, min_retention, offsets), TURNS, spots, plane_rows, labels, holes, disk_px, seed + ROTATION)
    pools = rows.where("nucleus_id IS NULL").select("image", "n_spots", F.col("parts").alias("n_nuclei"), F.get("seen", F.lit(0)).alias("seen"), F.col("s_all").alias("sums"))
    crowded = rows.where("nucleus_id IS NOT NULL")
    usable = _whole(crowded.drop("seen"), ["n_in", "s_all"]).where((_median_share("n_in") >= min_retention) & F.lit(n >= 2))
    seen = crowded.groupBy(*KEY).agg(F.sum(F.get("seen", F.lit(0))).alias("seen"))
    added = usable.join(seen, KEY).select("image", "n_spots", F.lit(1).cast("long").alias("n_nuclei"), "seen", F.col("s_all").alias("sums"))
    return _pooled(pools.unionByName(added))


def _median_share(counts: str) -> Column:
    """Median over the iterations of a nucleus of the share of its spots; the counts are whole numbers, so their order is that of the shares."""
    ordered = F.array_sort(counts)
    at = lambda i: F.get(ordered, i.cast("int")) / F.col("n_spots")
    return (at((F.size(counts) - 1) / 2) + at(F.size(counts) / 2)) / 2.0


def translation_null(
    spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None = None, n: int = 1000, disk_px: float = 3.0,
    min_retention: float = 0.5, seed: int = 0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shift all spots so that their centre falls on a random pixel; spots leaving the mask are dropped.

    Iterations that keep too few spots are left out of the draws. Results as in ``rotation_null``.
    """
    chunks = _moved(lambda it, offsets: _translation_batches(it, n, offsets), MOVES, spots, plane_rows, labels, holes, disk_px, seed + TRANSLATION)
    whole = _whole(chunks.drop("seen"), ["n_in", "s_in"])
    per = whole.select(*KEY, "n_spots", F.posexplode(F.arrays_zip("n_in", "s_in")).alias("_i", "_r"))
    sums = per.select(*KEY, "n_spots", (F.col("_i") + 1).alias("iter"), "_r.n_in", "_r.s_in")
    every = cut_lineage(
        sums.select(*KEY, "n_spots", "iter", ratio(F.col("s_in"), F.col("n_in")).alias("value"), (F.col("n_in") / F.col("n_spots")).alias("retention"))
    )
    kept = (F.col("retention") >= min_retention) & F.col("value").isNotNull()
    nuclei = every.groupBy(*KEY).agg(F.median("retention").alias("median_retention"), F.count(F.when(kept, 1)).alias("_n")).select(
        *KEY, "median_retention", ((F.col("median_retention") >= min_retention) & (F.col("_n") >= 2)).alias("usable")
    )
    return every.where(kept), nuclei, _observed_of(chunks)


def association_fraction(
    spots: DataFrame, plane_rows: DataFrame, labels: DataFrame, holes: DataFrame | None = None, pct: float = 95.0, n: int = 200,
    disk_px: float = 3.0, min_values: int = 20, seed: int = 0,
) -> DataFrame:
    """(KEY, threshold, fraction): share of spots above a high percentile of single rotated positions."""
    chunks = _moved(lambda it, offsets: _single_batches(it, n, pct / 100, min_values, offsets), SINGLE, spots, plane_rows, labels, holes, disk_px, seed + ASSOCIATION)
    many = chunks.where("parts > 1")
    singles = many.select(*KEY, F.explode("vs").alias("v"))
    enough = singles.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_values).select(*KEY)
    cut = quantiles(singles, "v", KEY, {"threshold": pct / 100}).join(enough, KEY, "left_semi")
    seen = many.select(*KEY, F.explode("seen").alias("v"))
    crowded = seen.join(cut, KEY).groupBy(*KEY, "threshold").agg(F.avg(F.when(F.col("v") > F.col("threshold"), 1.0).otherwise(0.0)).alias("fraction"))
    return chunks.where("parts = 1").select(*KEY, "threshold", "fraction").unionByName(crowded)


def null_summary(draws: DataFrame, observed: DataFrame | None, keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Null mean and sd, enrichment, z and empirical p of the observed statistic per key.

    Without ``observed`` the draws carry it themselves.
    """
    keys = list(keys)
    rows = draws.where(F.col("value").isNotNull())
    if observed is not None:
        rows = rows.join(observed.select(*keys, "obs"), keys)
    stats = rows.groupBy(*keys, "obs").agg(
        F.avg("value").alias("null_mean"),
        F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("null_sd"),
        F.sum(F.when(F.col("value") >= F.col("obs"), 1).otherwise(0)).alias("_ge"),
        F.count(F.lit(1)).alias("n_draws"),
    )
    return (
        stats.withColumn("enrichment", ratio(F.col("obs"), F.col("null_mean")))
        .withColumn("z", ratio(F.col("obs") - F.col("null_mean"), F.col("null_sd")))
        .withColumn("p", (F.col("_ge") + 1) / (F.col("n_draws") + 1))
        .drop("_ge")
    )


def pool_draws(draws: DataFrame, observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(image draws (image, iter, value, obs), per-image summary): nuclei weighted by their spot counts."""
    w = F.col("n_spots")
    image_obs = observed.groupBy("image").agg((F.sum(w * F.col("obs")) / F.sum(w)).alias("obs"), F.sum(w).alias("n_spots"))
    pooled = draws.groupBy("image", "iter").agg((F.sum(w * F.col("value")) / F.sum(w)).alias("value"))
    summary = null_summary(pooled, image_obs, ["image"])
    return pooled.join(image_obs.select("image", "obs"), "image"), summary


def pool_weighted(nuclei: DataFrame) -> DataFrame:
    """(image, enrichment, z): spot-weighted means of per-nucleus values, for nulls of unequal length."""
    w = F.when(F.col("enrichment").isNotNull(), F.col("n_spots"))
    return nuclei.groupBy("image").agg(
        (F.sum(w * F.col("enrichment")) / F.sum(w)).alias("enrichment"), (F.sum(w * F.col("z")) / F.sum(w)).alias("z")
    )


def matched_random(spots: DataFrame, labels: DataFrame, seed: int = 0) -> DataFrame:
    """(KEY, spot_id, y, x): for every spot one random pixel of its nucleus."""
    numbered = labels.select(*KEY, "y", "x").withColumn("_k", F.row_number().over(Window.partitionBy(*KEY).orderBy("y", "x")) - 1)
    sizes = labels.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_size"))
    state = stream(seed, *[F.col(k) for k in KEY])
    drawn = spots.where(F.col("nucleus_id") > 0).select(*KEY, "spot_id").join(sizes, KEY)
    at = draw_index(state, F.col("_size"), F.col("spot_id") % PRIME).cast("int")
    # the drawn number meets its pixel: no spot carries the pixels of its nucleus
    return drawn.withColumn("_k", at).join(numbered, [*KEY, "_k"]).select(*KEY, "spot_id", "y", "x")
