"""Every stage on odd rows, and the whole pipeline against a plain chain of the same decisions."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from spotframe.llm import mixing
from tests.llm.test_operators import BYTES, FOLD, SF, library, linked_components, texts


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows_and_on_none(odd, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    kept = stage(odd.sparkSession, odd, "")
    empty = stage(odd.sparkSession, none, "")
    assert empty.count() == 0
    rows = kept.collect()
    if name == "packing":
        assert len(rows) >= odd.count()
        return
    assert kept.columns == empty.columns == odd.columns and kept.dtypes == odd.dtypes
    given = Counter(map(tuple, odd.collect()))
    assert set(map(tuple, rows)) <= set(given)
    ids = {r["doc_id"] for r in rows}
    if name == "language_id":
        assert {7, 8, 9, 15}.isdisjoint(ids) and {1, 2, 3, 4, 5, 6, 12, 14, 16, None} <= ids
    if name == "exact_copies":
        assert 3 not in ids and {1, 2, 4, 5, 6, 7, 12, 16} <= ids and 8 not in ids
    if name == "near_copies":
        assert {3, 4, 6}.isdisjoint(ids) and {1, 2, 5, 7, 8, 9, 12, 16} <= ids
    if name == "source_mix":
        assert all(n <= 3 * given[r] * given[r] for r, n in Counter(map(tuple, rows)).items())


def test_run_equals_the_plain_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(d, t) for d, t in texts(docs) if any(c.isalpha() for c in t)]
    first = {}
    for d, t in sorted(rows):
        first.setdefault(t.translate(FOLD), d)
    rows = [(d, t) for d, t in rows if first[t.translate(FOLD)] == d]
    roots = {d: root for d, _, root in linked_components(rows, 5, 80)}
    rows = [(d, t) for d, t in rows if roots[d] == d]
    left = docs.where(docs.doc_id.isin([d for d, _ in rows]))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(left).collect()}
    plain, want = library(BYTES), Counter()
    for d, t in rows:
        ids = [*plain.encode(t, add_special_tokens=False).ids, 0]
        at, k, size = 0, 0, len(ids) % 2048 or 2048
        while at < len(ids):
            want[(d, k, at, size, zlib.crc32(np.asarray(ids[at : at + size], "<u4").tobytes()))] += copies[d]
            at, size, k = at + size, 2048, k + 1
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == +want
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()
    assert ordered.groupby("sequence_id")["length"].sum().max() <= 2048
