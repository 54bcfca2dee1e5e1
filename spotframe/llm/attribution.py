"""Token counts per section: whole texts are encoded once, token spans are joined to section spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spotframe.llm.common import small_batches, text_or_empty
from spotframe.llm.encoding import TEXTS, PieceTable, table

RULES = ("majority", "first", "last")


def owner(starts: np.ndarray, begin: int, end: int, rule: str) -> int:
    """The section that a token over the characters [begin, end) belongs to.

    first / last: the section of its first / last character. majority: the section that holds most of
    its characters, the earliest among equals.
    """
    low, high = np.searchsorted(starts, [begin, max(begin, end - 1)], "right") - 1
    if low == high or rule == "first":
        return int(low)
    if rule == "last":
        return int(high)
    edges = np.concatenate(([begin], starts[low + 1 : high + 1], [end]))
    return int(low + np.argmax(np.diff(edges)))


def span_counts(spans: list[tuple[int, int]], starts: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section, from the spans of all tokens of a text."""
    counts = np.zeros(len(starts), dtype=np.int64)
    if spans:
        begin, end = np.asarray(spans, dtype=np.int64).T
        low = np.searchsorted(starts, begin, "right") - 1
        high = np.searchsorted(starts, np.maximum(begin, end - 1), "right") - 1
        across = low != high
        counts += np.bincount(low[~across], minlength=len(starts))
        for i in np.flatnonzero(across):
            counts[owner(starts, int(begin[i]), int(end[i]), rule)] += 1
    return counts


def _spans(encoder: PieceTable, piece: str, known: dict[str, list[tuple[int, int]]]) -> list[tuple[int, int]]:
    if piece not in known:
        if len(known) > 50_000:
            known.clear()
        known[piece] = encoder.tokenizer.encode(piece, add_special_tokens=False).offsets
    return known[piece]


def section_counts(encoder: PieceTable, pieces: list[str], starts: np.ndarray, rule: str, known: dict) -> np.ndarray:
    """Tokens of each section of one text; `pieces` are the text cut by encoder.cut.

    This is the interval join of two ordered lists: a piece that lies inside one section gives all its
    tokens to it; only the tokens of pieces across a boundary are looked at one by one.
    """
    counts = np.zeros(len(starts), dtype=np.int64)
    length = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    length[1:] += 1  # the space at the cut
    end = np.cumsum(length)
    begin = end - length
    tokens = _token_numbers(encoder, pieces)
    low = np.searchsorted(starts, begin, "right") - 1
    high = np.searchsorted(starts, np.maximum(begin, end - 1), "right") - 1
    same = low == high
    counts += np.bincount(low[same], weights=tokens[same], minlength=len(starts)).astype(np.int64)
    for i in np.flatnonzero(~same):
        at = int(begin[i])
        for a, b in _spans(encoder, pieces[i] if i == 0 else " " + pieces[i], known):
            counts[owner(starts, at + a, at + b, rule)] += 1
    return counts


def _token_numbers(encoder: PieceTable, pieces: list[str]) -> np.ndarray:
    coded = map(encoder.inner.__getitem__, pieces[1:])
    numbers = np.fromiter(map(len, coded), dtype=np.int64, count=len(pieces) - 1) // 4
    return np.concatenate(([len(encoder.head[pieces[0]]) // 4], numbers))


def token_counts(
    docs: DataFrame,
    vocab: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    starts_col: str | None = None,
    rule: str = "majority",
) -> DataFrame:
    """(id, section, start, n_chars, n_tokens): one row per section of every text.

    Sections cover a text without gaps. They begin at the code points listed in `starts_col` (ascending,
    the first is 0), by default at the beginning of each line; a line break belongs to the line it ends,
    and no section begins at the end of the text. `rule` allocates a token that crosses a boundary, see
    `owner`; every token goes to exactly one section, so the sum over a text is its number of tokens.

    Defined cases: a null or empty text has one empty section without tokens; starts beyond the text
    give empty sections; null starts count as one section; rows repeating an id are counted one by one; an
    empty table gives no rows; other columns are ignored. The tokenizer must keep character offsets.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, section int, start bigint, n_chars bigint, n_tokens bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known = table(vocab), {}
        for batch in (big.slice(at, TEXTS) for big in batches for at in range(0, big.num_rows, TEXTS)):
            texts = batch.column(1).to_pylist()
            given = batch.column(2).to_pylist() if starts_col else [None] * len(texts)
            row, section, start, chars, tokens = [], [], [], [], []
            for i, (text, pieces) in enumerate(zip(texts, encoder.learn_batch(texts), strict=True)):
                at = np.asarray(_lines(text) if starts_col is None else (given[i] or [0]), dtype=np.int64)
                row.append(np.full(len(at), i))
                section.append(np.arange(len(at), dtype=np.int32))
                start.append(at)
                stop = np.minimum(np.append(at[1:], len(text)), len(text))
                chars.append(np.maximum(stop - at, 0))
                tokens.append(span_counts(encoder.tokenizer.encode(text, add_special_tokens=False).offsets, at, rule) if pieces is None else section_counts(encoder, pieces, at, rule, known))
            if texts:
                ids = batch.column(0).take(pa.array(np.concatenate(row)))
                columns = [ids, *(pa.array(np.concatenate(x)) for x in (section, start, chars, tokens))]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "section", "start", "n_chars", "n_tokens"])

    columns = [F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text")]
    if starts_col:
        columns.append(F.col(starts_col).cast("array<bigint>").alias("_starts"))
    return small_batches(docs).select(*columns).mapInArrow(count, schema)


def _lines(text: str) -> list[int]:
    starts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts
