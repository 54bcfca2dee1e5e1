"""What Python workers keep between tasks, the order of elements that the join of sets goes by, and minima of ranges."""

import numpy as np

from spotframe.llm import common, jaccard, suffixes


def test_a_worker_keeps_the_last_table_only():
    made = []

    def one(path):
        made.append(("one", path))
        return path

    def two(path):
        made.append(("two", path))
        return path

    first, second = common.kept_by_worker(one), common.kept_by_worker(two)
    assert first.__qualname__ == one.__qualname__  # tasks find it by its name
    assert first("a") == first("a") == "a" and made == [("one", "a")]
    second("a")
    first("a")  # it was forgotten when the other was made
    first("b")
    first("a")
    assert made == [("one", "a"), ("two", "a"), ("one", "a"), ("one", "b"), ("one", "a")]
    second("a")
    assert made[-1] == ("two", "a")
    for forget in (first.cache_clear, second.cache_clear):
        common._FORGET.remove(forget)


def test_rare_elements_stand_first_in_one_order_for_all_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**64, 40, dtype=np.uint64)) for _ in range(5)] + [np.empty(0, np.uint64)]
    level = rng.integers(0, 3, jaccard.COUNTS).astype(np.uint8)
    key = lambda e: (int(level[int(e) >> int(jaccard._SHIFT)]), int(e))
    for one, ordered in zip(sets, jaccard._rare_first(sets, level)):
        assert ordered.tolist() == sorted(one.tolist(), key=key)


def test_range_minima_hold_few_numbers():
    values = np.random.default_rng(1).integers(0, 60, 3000).astype(np.uint8)
    table = suffixes.LowestBetween(values)
    held, part = 0, table
    while part is not None:
        held, part = held + sum(map(len, part.levels)), part.blocks
    assert held < 6 * len(values)  # all doubling ranges would be ten times as many
    for n in (*range(1, 70), len(values)):
        table = suffixes.LowestBetween(values[:n])
        pairs = np.sort(np.random.default_rng(n).integers(0, n, (300, 2)), axis=1)
        got = table.of(pairs[:, 0], pairs[:, 1])
        assert got.tolist() == [values[a : b + 1].min() for a, b in pairs], n


def test_collections_keep_anchors_whole_and_lengths_alike(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 2000)
    rng = np.random.default_rng(5)
    group, length = rng.integers(-40, 40, 900), rng.integers(50, 60, 900)
    length[group == 7] += 50
    parts = suffixes.collections(group, length)
    assert sorted(np.concatenate(parts)) == list(range(900)) and len(parts) > 10
    assert sum(len(np.unique(group[p])) for p in parts) == len(np.unique(group))
    assert sum(length[p].max() > 100 for p in parts) == 1
    assert suffixes.collections(group[:0], length[:0]) == []


def test_owners_are_the_same_in_one_collection_and_in_many(monkeypatch):
    rng = np.random.default_rng(6)
    passage = bytes(rng.integers(97, 100, 130).tolist())
    made = [(g, passage[a : a + n]) for g in range(6) for a, n in zip(rng.integers(0, 60, 8), rng.integers(50, 70, 8), strict=True)]
    group, texts, owner = np.array([g for g, _ in made]), [t for _, t in made], rng.integers(0, 1000, len(made))
    monkeypatch.setattr(suffixes, "PIECE", 500)
    parts = suffixes.collections(group, np.array([len(t) for t in texts]))
    assert len(parts) == 6
    for p in parts:
        for c, got in zip(p, suffixes.smallest_owners([texts[c] for c in p], owner[p], 50), strict=True):
            alike = [(texts[o], owner[o]) for o in np.flatnonzero(group == group[c])]
            assert got.tolist() == [min(w for t, w in alike if texts[c][i : i + 50] in t) for i in range(len(texts[c]) - 49)]
