"""Importance resampling, benchmark decontamination and the conversation trie on odd rows, against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.harness import connect, difference
from spotframe.llm import common, contamination, resampling, turn_trie

SF = "/root/testdata/sf0.001"
FOLD = {i: i + 32 for i in range(65, 91)}
SPOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()


def spoken(text):
    return SPOKEN.findall((text or "").translate(FOLD))


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(9)
    rows = [(1, "one TWO", "x"), (2, None, "x"), (3, "", "x"), (4, "...", "x"), (None, "sep line", "x"), (1, "line nul", "x"), (5, "hend " * 30, "x"), (6, "日本語 テスト abc", "x")]
    base = next(t for i, t, *_ in odd_rows() if i == 1).split(" ")
    rows += [(10, " ".join(base[20:45]), "x"), (11, " ".join(base[40:60]), "x"), (12, " ".join(base[41:50]), "x"), (10, " ".join(base[20:45]), "x")]
    rows += [(20 + i, " ".join(rng.choice(base) for _ in range(14)), "x") for i in range(5)]
    return spark.createDataFrame(rows, "item_id long, text string, kept string").cache()


def odd_rows():
    from tests.llm.conftest import odd_texts

    return odd_texts()


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_decontamination", "op13_conversation_trie"])
def test_whole_tables_match_duckdb(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert difference(got, connect(SF).execute(entry.oracle_sql()[name]).df()) is None


# ---- shared helpers

def test_numbered_and_running_sums_cross_ranges_and_chunks(spark):
    rng = random.Random(3)
    values = [(rng.choice("ab"), rng.randrange(100)) for _ in range(500)]
    rows = common.numbered(spark.createDataFrame(values, "k string, v long").repartition(5), [F.col("k"), F.col("v").desc()], "place").collect()
    assert [(r["k"], r["v"]) for r in sorted(rows, key=lambda r: r["place"])] == sorted(values, key=lambda x: (x[0], -x[1]))
    assert sorted(r["place"] for r in rows) == list(range(1, 501))
    sums = common.running_sums(spark.createDataFrame([("a", i, i * i) for i in range(40)] + [("b", 7, 1)], "k string, at long, v long"), "k", "at", ["v"], chunk=6)
    assert {(r["k"], r["at"], r["v"]) for r in sums.collect()} == {("a", i, sum(j * j for j in range(i + 1))) for i in range(40)} | {("b", 7, 1)}
    assert common.numbered(spark.createDataFrame([], "k long"), [F.col("k")]).count() == 0


# ---- 11 importance resampling

def test_checksums_of_runs_equal_zlib():
    rng = random.Random(4)
    made = ["".join(rng.choice("abZ9é日 .\n'") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["", None, "x" * 1000 + " y " + "é" * 500, "a", " a b "]
    got = defaultdict(Counter)
    counts = {}
    for n, text, value in resampling.features([None if t is None else t.encode() for t in made]):
        if n == 0:
            counts = dict(zip(text.tolist(), value.tolist()))
        else:
            for t, v in zip(text.tolist(), value.tolist()):
                got[n, t][v] += 1
    for i, t in enumerate(made):
        words = spoken(t)
        assert counts[i] == len(words)
        for n in (1, 2, 3):
            assert got[n, i] == Counter(zlib.crc32(" ".join(words[k : k + n]).encode()) for k in range(len(words) - n + 1))


def resampled(rows, target, percent, least, buckets=10_000):
    """(id, n_features, weight, score) of every row and the drawn (id, score) in order."""
    grams = lambda t: [" ".join(w[i : i + n]) for w in [spoken(t)] for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    count = lambda texts: Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t))
    s, t = count(x[1] for x in rows), count(target)
    total, other = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (other + buckets)))) for b in s}
    out, ranked = [], []
    for doc, text in rows:
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in grams(text))
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(grams(text)), weight, score))
        if len(spoken(text)) >= least:
            ranked.append((-score, doc is None, doc or 0, doc))
    drawn = sorted(ranked)[: percent * len(ranked) // 100]
    return out, [(d[3], -d[0]) for d in drawn]


@pytest.mark.parametrize("last", [0, 512])
@pytest.mark.parametrize("percent", [5, 40, 100, 0])
def test_resampling_is_exact(spark, odd, items, percent, last):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want, drawn = resampled(rows, [r["text"] for r in items.collect()], percent, 5)
    got = resampling.resample(odd.repartition(6), items, percent=percent, least_words=5, last=last).collect()
    key = lambda x: str(x)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=key) == sorted(want, key=key)
    assert [(r["doc_id"], r["score"]) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


def test_cutoff_by_medians_of_uneven_partitions_with_ties(spark):
    rng = random.Random(6)
    # one partition holds most keys, many keys tie in the first column, ids are null or repeated
    rows = [(rng.randrange(4), rng.choice([None, rng.randrange(5)]), i) for i in range(600)]
    keys = spark.createDataFrame(rows, "a long, id long, row long").withColumn("p", F.when(F.col("row") < 450, 0).otherwise(F.col("row") % 7)).repartition(7, "p").drop("p")
    ordered = sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2]))
    for wanted in (1, 37, 300, 599, 600):
        assert resampling.cutoff(keys, wanted, last=3) == ordered[wanted - 1]
    assert resampling.cutoff(keys, 0) is None


def test_resampling_of_empty_tables(spark, odd, none, items):
    assert resampling.resample(none, items).count() == 0
    bare = resampling.resample(odd, items.limit(0), percent=50, least_words=1).collect()
    assert len(bare) == odd.count() and any(r["rank"] == 1 for r in bare)


# ---- 12 benchmark decontamination

def contaminated(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = spoken(text)
        for i in range(max(len(w) - window, 0) + 1):
            if w:
                windows[tuple(w[i : i + window])].add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        w, hit, found = spoken(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (run := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[run]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, shingle", [(10, 3), (4, 2), (2, 3)])
def test_decontamination_is_exact(odd, items, window, shingle):
    got = contamination.decontaminate(odd, items, window=window, shingle=shingle).collect()
    want = contaminated([(r["doc_id"], r["text"]) for r in odd.collect()], [(r["item_id"], r["text"]) for r in items.collect()], window)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(w[3] > 1 for w in want) and any(w[5] is False for w in want)


def test_decontamination_with_a_benchmark_in_blocks(odd, items, monkeypatch):
    monkeypatch.setattr(contamination, "SENT_ROWS", 30)
    test_decontamination_is_exact(odd, items, 10, 3)


def test_decontamination_of_empty_tables(odd, none, items):
    assert contamination.decontaminate(none, items).count() == 0
    for blank in (items.limit(0), items.where("text is null or text = '...'")):
        rows = contamination.decontaminate(odd, blank).collect()
        assert len(rows) == odd.count() and all(r["n_hit"] == r["n_items"] == 0 and r["items_sha256"] == EMPTY and not r["contaminated"] for r in rows)


# ---- 13 conversation trie

def trie(rows, group=20, most=4):
    """The nodes of rebuilt conversations, made from their texts."""
    own = defaultdict(list)
    digest = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = int(math.copysign(abs(c) // group * group, c))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    ends = {p: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest() for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], ends[p]) for p, m in members.items()) if members else []


def turns_of(rng, convs):
    rows = []
    for c in convs:
        for k in range(rng.choice([1, 1, 2, 3, 5, 7])):
            rows.append((c, rng.choice([k, k, k, None, 1]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "a b", "c", "", None, "long " * 40])))
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_exact(spark, seed):
    rng = random.Random(seed)
    # bases that are absent or short, ids below zero, conversations alike, and turns of no conversation
    rows = turns_of(rng, [*range(0, 60), *range(101, 120), -45, -40, -41, -60, 2**40]) + [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [r for r in rows if r[0] in (3, 20)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, c string").repartition(5)
    got = found(turn_trie.conversation_trie(df))
    assert got == sorted(trie(rows), key=lambda r: tuple((x is None, x) for x in r))
    assert max(r[3] for r in got if r[1]) > 1


def test_trie_of_long_and_of_equal_conversations(spark):
    # one conversation longer than a chunk of the running sums, thousands of equal ones, and some that lose all their turns
    rows = [(0, k, "user", f"turn {k}") for k in range(4500)] + [(c, k, "user", f"same {k}") for c in range(1000, 6000) for k in range(4)] + [(7001, 0, "user", "lost"), (7003, 0, "user", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(turn_trie.conversation_trie(df)) == sorted(trie_by_length(rows), key=lambda r: tuple((x is None, x) for x in r))


def trie_by_length(rows):
    """trie() for long conversations: the long one shares nothing, so it is answered apart."""
    short = [r for r in rows if r[0] != 0]
    nodes = trie(short)
    n = sum(r[0] == 0 for r in rows)
    root = next(r for r in nodes if r[1] == 0)
    rest = [(r[0], r[1], 0 if r[1] == 1 else r[2], *r[3:]) for r in nodes if r[1]]
    top = (0, 0, None, root[3] + 1, root[4] + 1, root[5] + 1, root[6], root[7])
    end = hashlib.sha256(b"0").hexdigest()
    return [top, *rest, *[(0, d, 0, 1, int(d < n), 1, 0, end if d == n else EMPTY) for d in range(1, n + 1)]]


def test_fingerprints_compose(spark):
    rows = [(c, k, "r", f"{c}{k}") for c in (0, 1) for k in range(6)]
    stored = turn_trie.turn_references(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    got = {(r["c"], r["k"]): (r["ref"], [r[lane] for lane in turn_trie.LANES]) for r in turn_trie.running_fingerprints(stored, 0).collect()}
    for i, (base, prime) in enumerate(zip(turn_trie._bases(0), turn_trie.PRIMES)):
        for c in (0, 1):
            value = 0
            for k in range(1, 7):
                ref, lanes = got[c, k]
                value = (value + int(ref[8 * i : 8 * i + 8], 16) * pow(base, k, prime)) % prime
                assert lanes[i] == value


def test_collisions_of_fingerprints_are_found(spark, monkeypatch):
    rows = turns_of(random.Random(8), range(40))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    usual = turn_trie._bases
    # the first attempt gives every sequence the fingerprint 0
    monkeypatch.setattr(turn_trie, "_bases", lambda attempt: usual(attempt) if attempt else [p * 2 for p in turn_trie.PRIMES])
    monkeypatch.setattr(turn_trie, "pow", lambda b, e, p: 0 if b % p == 0 else pow(b, e, p), raising=False)
    assert found(turn_trie.conversation_trie(df)) == sorted(trie(rows), key=lambda r: tuple((x is None, x) for x in r))


def test_trie_of_an_empty_table(spark):
    assert turn_trie.conversation_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
