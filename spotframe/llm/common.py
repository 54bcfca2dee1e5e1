"""Shared helpers: table reading, text expressions, reliable checkpoints, components over links."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from spotframe.session import cut_lineage

#: A word is a maximal run of bytes other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents per Arrow batch, and bytes: whichever is reached first.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(docs: DataFrame) -> DataFrame:
    """docs as it is; whole texts then reach Python so many at a time, which bounds a worker's memory."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


#: What forgets a large table that a Python worker keeps between tasks.
_FORGET: list[Callable[[], None]] = []


def kept_by_worker(make: Callable) -> Callable:
    """make(path), remembered in the worker process for the last path; every other remembered table goes first.

    Workers are used again by later stages, which would else pile up the tables of all stages before them.
    """

    @functools.lru_cache(maxsize=1)
    @functools.wraps(make)  # tasks find it under this name
    def remembered(path: str):
        for forget in _FORGET:
            if forget is not remembered.cache_clear:
                forget()
        give_back()
        return make(path)

    _FORGET.append(remembered.cache_clear)
    return remembered


def give_back() -> None:
    """Return memory that this process holds but does not use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def spaced_lower(text: Column) -> Column:
    """A-Z to a-z and the other five white-space characters to spaces: words are what stands between spaces."""
    return F.translate(text, UPPER + "\t\n\x0b\x0c\r", LOWER + "     ")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def save(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of spark.checkpoint.dir (see spotframe.session.cut_lineage)."""
    return cut_lineage(df)


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files and checkpoints that nothing refers to any more.

    Its cleaner acts when the driver collects garbage, which a driver with little to do puts off for half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for tables that an operator writes and reads back."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        save(spark.range(1))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def numbered(df: DataFrame, order: list[Column], name: str = "_number") -> DataFrame:
    """df with the place 1, 2, 3 ... of each row in the given order, stored.

    Ranges of rows are sorted side by side and each is told how many rows stand before it, so no task sees
    the whole table; what reaches the driver is one count per range. Rows equal in the order get any places.
    """
    spread = save(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_ix", F.monotonically_increasing_id()))
    part = F.shiftright("_ix", 33)
    before, rows = 0, []
    for p, n in sorted((r[0], r[1]) for r in spread.groupBy(part.alias("p")).count().collect()):
        rows.append((p, before))
        before += n
    offsets = df.sparkSession.createDataFrame(rows, "_part long, _before long")
    placed = spread.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, F.col("_ix") - F.shiftleft("_part", 33) + F.col("_before") + 1).drop("_ix", "_part", "_before")


def running_sums(df: DataFrame, key: str, place: str, columns: list[str], chunk: int = 4096) -> DataFrame:
    """df with columns replaced by their sums over the rows of the key up to and with this place (a whole number).

    A key is summed in chunks of so many places, and then over its chunks: a key that holds a third of the
    table is the work of many tasks.
    """
    cut = df.withColumn("_chunk", F.floor(F.col(place) / chunk))
    whole = cut.groupBy(key, "_chunk").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(key, "_chunk", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_carry_{c}") for c in columns])
    inside = Window.partitionBy(key, "_chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select(*[(F.sum(c).over(inside).alias(c) if c in columns else c) for c in cut.columns])
    summed = local.join(carried, [key, "_chunk"])
    return summed.select(*[(F.col(c) + F.col(f"_carry_{c}")).alias(c) if c in columns else c for c in df.columns])


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node that links reach.

    Alternating large-star and small-star steps: each replaces the links by about as many, so a
    component never becomes a list in one task's memory, and the number of rounds grows with the
    logarithm of the longest chain. Every round is checkpointed.
    """
    edges = save(links.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    release(edges.sparkSession)

    def star(e: DataFrame, larger: bool) -> DataFrame:
        # larger: neighbours above a node are moved to the smallest of its neighbours and itself;
        # otherwise the neighbours below it, and the node itself, are
        if larger:
            near = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            near = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = near.join(low, "u")
        if larger:
            moved = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return moved.where(F.col("a") != F.col("b")).distinct()

    digest = None
    for _ in range(rounds):
        edges = save(star(star(edges, True), False))
        release(edges.sparkSession)
        now = edges.agg(F.count(F.lit(1)), F.sum((F.xxhash64("a", "b") % 1_000_003)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == digest:
            break
        digest = now
    else:
        raise RuntimeError("components did not settle")
    # settled: every link is (node, root)
    roots = edges.groupBy(F.greatest("a", "b").alias("node")).agg(F.min(F.least("a", "b")).alias("root"))
    return roots.union(edges.select(F.least("a", "b").alias("node")).distinct().select("node", F.col("node").alias("root")))


# ---- DuckDB statements

#: A CTE with the 256 steps of CRC-32, made by their rule; read with "FROM ..., crc_steps".
SQL_CRC_STEPS = "crc_steps AS MATERIALIZED (SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY b) AS steps FROM range(256) AS r(b))"


def sql_crc(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text column, where crc_steps is joined."""
    digits = f"hex(encode({text}))"
    byte = f"(instr('0123456789ABCDEF', {digits}[2 * i - 1]) - 1) * 16 + instr('0123456789ABCDEF', {digits}[2 * i]) - 1"
    return f"xor(list_reduce(list_prepend(4294967295, range(1, strlen({text}) + 1)), lambda c, i: xor(c >> 8, steps[(xor(c, {byte}) & 255) + 1])), 4294967295)"
