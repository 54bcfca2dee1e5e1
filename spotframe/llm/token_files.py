"""Token ids on disk: frequency-ranked, byte-aligned variable-length codes with separate control bytes.

A block holds whole documents in id order. Inside a block the ids are replaced by their frequency rank
(rank 0 is the most frequent), so most take one byte. A rank takes one to four bytes, lowest first, in
`data`; its length less one takes two bits of `control`, four ranks to a byte, lowest bits first. `ranks`
gives the id of each rank as little-endian unsigned 32-bit integers. Blocks are rows of uncompressed
Parquet files, which Spark's committer makes appear once, also when a writing task is lost and repeated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spotframe.llm.common import shared_path, small_batches, text_or_empty
from spotframe.llm.encoding import table

#: A block is closed when it holds so many ids; one longer document is a block of its own.
BLOCK_IDS = 2_000_000
#: Control byte -> lengths of its four ranks.
_LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.uint8) + 1
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_block(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ranks, control, data) of unsigned 32-bit ids."""
    distinct, inverse, count = np.unique(ids, return_inverse=True, return_counts=True) if ids.size and ids.max() > 1 << 22 else _counted(ids)
    order = np.argsort(-count, kind="stable")
    rank_of = np.empty(len(order), dtype=np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    ranks = rank_of[inverse]
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(code) // 4) * 4, dtype=np.uint8)
    padded[: len(code)] = code
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= code[:, None]
    return distinct[order].astype("<u4").tobytes(), control.tobytes(), ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[used].tobytes()


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    count = np.bincount(ids)
    distinct = np.flatnonzero(count)
    place = np.zeros(len(count), dtype=np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[ids], count[distinct]


def decode_block(ranks: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ids of a block: lengths by table lookup, values by one masked gather."""
    if not n:
        return np.empty(0, dtype="<u4")
    length = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n]
    start = np.cumsum(length, dtype=np.int64) - length
    words = np.ndarray((len(data),), dtype="<u4", buffer=data + b"\0\0\0\0", strides=(1,))
    return np.frombuffer(ranks, dtype="<u4")[words[start] & _MASK[length]]


def write_token_files(docs: DataFrame, path: str, vocab: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> str:
    """Write all documents in ascending id order below `path`; returns path.

    Documents are dealt out by id ranges and sorted inside them; part and block number the pieces in order.
    Null texts count as empty and hold only `end_id`; null ids come first; rows that repeat an id stay
    next to each other, ordered by text; an empty table writes no block.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"part int, block int, before bigint, n_ids bigint, ids array<{kind}>, lengths array<bigint>, ranks binary, control binary, data binary"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, part = table(vocab), np.uint32(end_id).tobytes(), TaskContext.get().partitionId()
        block, before, held, keys, lengths, size = 0, 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            ranks, control, data = encode_block(ids)
            values = [[part], [block], [before], [len(ids)], [keys], [lengths], [ranks], [control], [data]]
            key_type = pa.list_(ids_type)
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), key_type, pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], [f.split()[0] for f in schema.split(", ")])

        for batch in batches:
            ids_type = batch.schema.field(0).type
            for key, coded in zip(batch.column(0).to_pylist(), encoder.encode_batch(batch.column(1).to_pylist()), strict=True):
                n = len(coded) // 4 + 1
                if size and size + n > BLOCK_IDS:
                    yield close()
                    block, before, held, keys, lengths, size = block + 1, before + size, [], [], [], 0
                held += (coded, end)
                keys.append(key), lengths.append(n)
                size += n
        if size:
            yield close()

    rows = small_batches(docs).select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    ordered = rows.repartitionByRange(F.col("_id").asc_nulls_first()).sortWithinPartitions(F.col("_id").asc_nulls_first(), "_text")
    ordered.mapInArrow(write, schema).write.option("compression", "none").parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every stored document; start counts the ids of all before it."""
    blocks = spark.read.parquet(path)
    # one row per writing task: bounded by the number of tasks, far below a broadcast's limit
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = f"`{id_col}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, lengths = batch.column(0)[i].values, batch.column(1)[i].values.to_numpy()
                raw = decode_block(*(batch.column(c)[i].as_py() for c in (2, 3, 4)), batch.column(5)[i].as_py()).tobytes()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                parts = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                first = batch.column(6)[i].as_py()
                columns = [keys, pa.array(starts + first), pa.array(lengths), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = [id_col, "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    first = (F.col("before") + F.col("_offset")).alias("first")
    return blocks.join(F.broadcast(offsets), "part").select("ids", "lengths", "ranks", "control", "data", "n_ids", first).mapInArrow(read, schema)


def token_files(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Write the documents, by default below the shared folder, and read them back (see both functions)."""
    spark = docs.sparkSession
    path = write_token_files(docs, path or shared_path(spark, "token_files"), vocab, id_col, text_col, end_id)
    return read_token_files(spark, path, id_col, with_ids)
