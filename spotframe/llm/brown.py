"""Class-based n-grams: exchange clustering of words, class transitions and word emissions.

Every word has a class. Classes begin with elements: the most frequent words by themselves, all others with the words
of the same ending, so that unknown words have a class too. Exchange clustering moves elements between classes
as long as the likelihood of the class bigrams grows; then every distinct training word is exchanged by itself, by
the classes before and after all of its tokens. The probability of a token is
P(class | class before) * P(token | class), smoothed with the unigram estimate.
"""

from __future__ import annotations


from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from spotframe.llm.common import crc_mod, release, save, shared_path, small_batches, spaced_lower, text_or_empty

#: Token that closes every text. No word contains white space.
END = "\n"
#: Words with an element of their own, and elements that all other words share by their ending.
FREQUENT, ENDINGS = 512, 256
CLASSES = 48
#: Characters that decide the shared element of a word.
ENDING_CHARS = 2
#: Distinct words counted in a task before they are handed on.
HELD_WORDS = 300_000
#: Pairs of a word and a neighbour's class held in a task before they are handed on.
HELD_PAIRS = 2_000_000
#: Words whose element is remembered in a task, and texts counted at a time.
KNOWN_WORDS, TEXTS = 600_000, 256
#: Weight of the class model against the unigram estimate.
CLASS_WEIGHT = 0.75
#: Characters of text in a block, whose words are looked up together.
BLOCK_CHARS = 8_000_000


def tokens(text: str) -> list[str]:
    """Words of a text whose white space is spaces (common.spaced_lower), then END."""
    return [*filter(None, text.split(" ")), END]


def element_of(word: str, frequent: dict[str, int]) -> int:
    """Number of the word's element: its own, or that of its ending."""
    own = frequent.get(word)
    return own if own is not None else FREQUENT + xxhash.xxh32_intdigest(word[-ENDING_CHARS:].encode("utf-8", "surrogatepass")) % ENDINGS


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over the column `text`, with END once for each text. Grows with the distinct words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(tokens(text))
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return texts.select("text").mapInArrow(count, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def element_bigrams(texts: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(a, b, n): how often element b follows element a; a text begins after END. At most (elements)^2 rows."""
    size = FREQUENT + ENDINGS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        sums = np.zeros(size * size, dtype=np.int64)
        for batch in (big.slice(at, TEXTS) for big in batches for at in range(0, big.num_rows, TEXTS)):
            pairs = []
            for text in batch.column(0).to_pylist():
                ids = elements(tokens(text), frequent, known)
                pairs.append(np.concatenate((ids[-1:], ids[:-1])) * size + ids)
            if pairs:
                sums += np.bincount(np.concatenate(pairs), minlength=size * size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)), pa.array(sums[at])], ["a", "b", "n"])

    return texts.select("text").mapInArrow(count, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def elements(words: list[str], frequent: dict[str, int], known: dict[str, int]) -> np.ndarray:
    """Elements of the words of a text, remembered in `known`."""
    if len(known) > KNOWN_WORDS:
        known.clear()
    found = list(map(known.get, words))
    if None in found:
        for i, e in enumerate(found):
            if e is None:
                w = words[i]
                found[i] = known[w] = element_of(w, frequent)
    return np.array(found, dtype=np.int64)


def _xlogx(v: np.ndarray | float) -> np.ndarray | float:
    return v * np.log(np.maximum(v, 1e-300))


def exchange(n: np.ndarray, classes: int, rounds: int = 5) -> np.ndarray:
    """Class of each element: bigram counts n (elements x elements) -> numbers below `classes`.

    Each element in turn is taken out of its class and put where the log likelihood
    sum(N(c, d) log N(c, d)) - sum(N(c) log N(c)) - sum(N(d) log N(d)) is largest, the lowest class among equals.
    Work depends on the number of elements and classes, not on the corpus.
    """
    size = len(n)
    order = np.argsort(-(n.sum(axis=0) + n.sum(axis=1)), kind="stable")
    of = np.empty(size, dtype=np.int64)
    of[order] = np.minimum(np.arange(size), classes - 1)
    # spread what is left over the classes instead of leaving it in the last one
    rest = order[classes:]
    of[rest] = np.arange(len(rest)) % classes
    one = np.eye(classes)[of]
    left, right = n @ one, n.T @ one  # element -> class after it, element -> class before it
    pair = one.T @ left
    for _ in range(rounds):
        moved = 0
        for w in order:
            out_w, in_w, self_w = left[w], right[w], n[w, w]
            if not (out_w.any() or in_w.any()):
                continue
            c = of[w]
            # counts without w
            base = pair.copy()
            base[c, :] -= out_w
            base[:, c] -= in_w
            base[c, c] += self_w
            o, i = out_w.copy(), in_w.copy()
            o[c] -= self_w
            i[c] -= self_w
            rows, cols = base.sum(axis=1), base.sum(axis=0)
            # w's own bigrams, in the class it joins: to others, from others, and with itself
            gain = (
                _xlogx(base + o[None, :]).sum(axis=1) - _xlogx(base).sum(axis=1)
                + _xlogx(base + i[:, None]).sum(axis=0) - _xlogx(base).sum(axis=0)
            )
            d = np.diag(base)
            gain += _xlogx(d + o + i + self_w) - _xlogx(d + o) - _xlogx(d + i) + _xlogx(d)
            total_o, total_i = o.sum() + self_w, i.sum() + self_w
            gain -= _xlogx(rows + total_o) - _xlogx(rows) + _xlogx(cols + total_i) - _xlogx(cols)
            new = int(np.argmax(gain))
            if gain[new] <= gain[c] + 1e-9:
                continue
            pair = base
            pair[new, :] += o
            pair[:, new] += i
            pair[new, new] += self_w
            of[w] = new
            left[:, c] -= n[:, w]
            left[:, new] += n[:, w]
            right[:, c] -= n[w, :]
            right[:, new] += n[w, :]
            moved += 1
        if not moved:
            break
    return of


def word_contexts(texts: DataFrame, frequent: dict[str, int], of: np.ndarray, classes: int) -> DataFrame:
    """(word, pairs): a word's tokens by the class after them and the class before them, in several rows for some words.

    An entry is count * 2 * classes + slot; slot is the class after, or `classes` plus the class before.
    """
    wide = 2 * classes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, int] = {}
        cls = np.zeros(1024, dtype=np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            code, n = _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            ends = np.concatenate(([0], np.cumsum(np.bincount(code // wide, minlength=len(place)))))
            pairs = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(n * wide + code % wide))
            return pa.RecordBatch.from_arrays([pa.array(list(place), pa.string()), pairs], ["word", "pairs"])

        for batch in (big.slice(at, TEXTS) for big in batches for at in range(0, big.num_rows, TEXTS)):
            codes = []
            for text in batch.column(0).to_pylist():
                words = tokens(text)
                found = list(map(place.get, words))
                if None in found:
                    for i, at in enumerate(found):
                        if at is None:
                            w = words[i]
                            at = place.get(w)
                            if at is None:
                                at = place[w] = len(place)
                                if at == len(cls):
                                    cls = np.concatenate((cls, np.zeros_like(cls)))
                                cls[at] = of[element_of(w, frequent)]
                            found[i] = at
                ids = np.array(found, dtype=np.int64)
                own = cls[ids]
                codes += [ids * wide + np.concatenate((own[1:], own[:1])), ids * wide + classes + np.concatenate((own[-1:], own[:-1]))]
            if codes:
                held.append(np.unique(np.concatenate(codes), return_counts=True))
            if len(place) > HELD_WORDS or sum(len(h[0]) for h in held) > HELD_PAIRS:
                yield out()
                place.clear()
                held.clear()
        if held:
            yield out()

    return texts.select("text").mapInArrow(count, "word string, pairs array<bigint>")


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with the sums of their numbers."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    return code[first], np.add.reduceat(n, first)


def exchanged(own: np.ndarray, word: np.ndarray, slot: np.ndarray, n: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, best class) of words of the classes `own`, each taken out of its class and put where the likelihood is largest.

    word, slot, n: the words' tokens by slot (see word_contexts), words ascending; pair: bigrams of the classes. Every word
    is judged against the same `pair`, so the answer does not hang on how words are dealt. Cells that the words before and
    after share are judged one side at a time, and a bigram of a word with itself counts as one of its old class.
    """
    classes = len(pair)
    at = np.arange(len(own))
    total = np.bincount(word, weights=np.where(slot < classes, n, 0), minlength=len(own))
    table, m = np.concatenate((pair.T, pair)), n.astype(np.float64)
    gains = np.zeros((len(own), classes))
    for a in range(0, len(word), 100_000):
        cut = slice(a, a + 100_000)
        there, more = table[slot[cut]], m[cut]
        mine = own[word[cut]]
        gain = _xlogx(there + more[:, None]) - _xlogx(there)
        stay = there[np.arange(len(mine)), mine]
        gain[np.arange(len(mine)), mine] = _xlogx(stay) - _xlogx(stay - more)
        first = np.flatnonzero(np.concatenate(([True], word[cut][1:] != word[cut][:-1])))
        gains[word[cut][first]] += np.add.reduceat(gain, first, axis=0)
    for side in (pair.sum(axis=1), pair.sum(axis=0)):
        loss = _xlogx(side[None, :] + total[:, None]) - _xlogx(side)[None, :]
        loss[at, own] = _xlogx(side[own]) - _xlogx(side[own] - total)
        gains -= loss
    best = np.argmax(gains, axis=1)
    return total.astype(np.int64), np.where(gains[at, best] > gains[at, own] + 1e-9, best, own)


def likelihood(pair: np.ndarray) -> float:
    """Log likelihood of class bigrams, but for the words inside the classes, which no exchange changes."""
    return float(_xlogx(pair).sum() - _xlogx(pair.sum(axis=1)).sum() - _xlogx(pair.sum(axis=0)).sum())


def exchange_words(texts: DataFrame, frequent: dict[str, int], of: np.ndarray, pair: np.ndarray) -> DataFrame:
    """(word, c, own, cls): tokens of every distinct word, the class of its element and the class it is exchanged into.

    Rows of a word meet in one sorted stream; a task holds a batch of it.
    """
    classes = len(pair)
    wide = 2 * classes

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_rows(rows: pa.Table) -> pa.RecordBatch:
            words, lists = rows.column("word").combine_chunks(), rows.column("pairs").combine_chunks()
            fresh = np.concatenate(([True], pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False))) if len(words) > 1 else np.array([True])
            row = np.repeat(np.cumsum(fresh) - 1, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            code, n = _summed(row * wide + flat % wide, flat // wide)
            distinct = words.filter(pa.array(fresh))
            own = np.fromiter((of[element_of(w, frequent)] for w in distinct.to_pylist()), dtype=np.int64, count=len(distinct))
            total, best = exchanged(own, code // wide, code % wide, n, pair)
            return pa.RecordBatch.from_arrays([distinct, pa.array(total), pa.array(own.astype(np.int32)), pa.array(best.astype(np.int32))], ["word", "c", "own", "cls"])

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if not rows.num_rows:
                continue
            words = rows.column("word")
            # the last word may go on in the next batch
            cut = pc.index(words, words[-1]).as_py()
            if cut:
                yield of_rows(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield of_rows(held)

    contexts = word_contexts(texts, frequent, of, classes)
    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(choose, "word string, c bigint, own int, cls int")


@dataclass
class Model:
    """Bounded by the elements and classes, but for the table of words."""

    words: DataFrame  # (word, c, own, cls): count, class of the element and class of every training word
    frequent: dict[str, int]
    of: np.ndarray  # class of each element, which is that of unknown words
    pair: np.ndarray  # bigrams of the elements' classes
    n: int
    v: int
    transition: np.ndarray | None = None  # natural P(class | class before), smoothed
    class_tokens: np.ndarray | None = None  # training tokens of each class
    class_words: np.ndarray | None = None  # distinct training words of each class


def train(texts: DataFrame, counts: DataFrame, classes: int = CLASSES) -> Model:
    """texts (text), counts (word, c) of the same texts. What is gathered: rows of each word, and the element bigrams."""
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    frequent = {r["word"]: i for i, r in enumerate(top)}
    size = FREQUENT + ENDINGS
    matrix = np.zeros((size, size))
    for r in element_bigrams(texts, frequent).toLocalIterator():
        matrix[r["a"], r["b"]] = r["n"]
    of = exchange(matrix, classes)
    one = np.eye(classes)[of]
    pair = one.T @ matrix @ one
    words = save(exchange_words(texts, frequent, of, pair))
    return Model(words, frequent, of, pair, int(facts["n"]), int(facts["v"]))


def settle(model: Model, pair: np.ndarray) -> tuple[Model, str]:
    """The model with the bigrams of the exchanged words' classes, and the column of its words that holds their class.

    Words move at the same time, so what each gains by itself may be lost together: then words keep the classes of their elements.
    """
    classes = len(pair)
    column = "cls" if likelihood(pair) > likelihood(model.pair) else "own"
    pair = pair if column == "cls" else model.pair
    tokens_, words_ = np.zeros(classes), np.zeros(classes)
    for r in model.words.groupBy(F.col(column).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():  # one row per class
        tokens_[r["k"]], words_[r["k"]] = r["c"], r["v"]
    transition = (pair + 0.5) / (pair.sum(axis=1, keepdims=True) + 0.5 * classes)
    return replace(model, transition=transition, class_tokens=tokens_, class_words=words_), column


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1, classes: int = CLASSES, class_weight: float = CLASS_WEIGHT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per document.

    Learns from all documents whose crc32(id as text) mod `folds` is not `held_out` and scores all. Texts are
    lower-cased A-Z; tokens are the words and one END. base_score sums log10((c + 0.5) / (N + 0.5 (V + 1)));
    score sums log10 of class_weight * P(class | class before) * (c + 0.5) / (C + 0.5 (W + 1)) plus the rest of
    the weight times the unigram estimate, C and W the tokens and distinct words of the word's class.

    The words of a block of documents are looked up together: each distinct word of a block is one row of a
    join with the counts, so the shuffle carries words per block, not tokens, and a frequent word costs one row
    per block. Blocks are read twice: to count the bigrams of the words' classes, and to score.

    Defined cases: null texts count as empty and hold END only; with nothing to learn from, every c, N and V
    is 0; rows repeating an id are scored one by one and all count; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fold = crc_mod(F.col(id_col), folds) == held_out
    rows = small_batches(docs).select(F.col(id_col).alias("_id"), fold.alias("held_out"), spaced_lower(text_or_empty(F.col(text_col))).alias("text"))
    learned = rows.where(~F.col("held_out"))
    counts = save(word_counts(learned))
    model = train(learned, counts, classes)
    del counts
    release(docs.sparkSession)
    characters = rows.agg(F.coalesce(F.sum(F.length("text") + 200), F.lit(0)).alias("s")).first()["s"]
    blocks = max(1, -(-characters // block_chars))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("_id", F.length("text")), F.lit(blocks)).cast("int")).repartition(int(blocks), "block")

    def distinct_words(frame: pd.DataFrame) -> pd.DataFrame:
        seen: set[str] = set()
        for text in frame["text"]:
            seen.update(tokens(text))
        return pd.DataFrame({"word": list(seen), "block": frame["block"].iloc[0]})

    wanted = blocked.groupBy("block").applyInPandas(distinct_words, "word string, block int")
    # read twice, so stored; in columns, as a checkpoint of its rows is not compressed
    path = shared_path(docs.sparkSession, "words")
    wanted.join(model.words, "word").select("block", "word", "c", "own", "cls").write.parquet(path)
    looked_up = docs.sparkSession.read.parquet(path)
    release(docs.sparkSession)
    end = int(model.words.where(F.col("word") == END).agg(F.max("cls")).first()[0] or 0)

    def class_bigrams(frame: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        cls = dict(zip(words["word"], words["cls"], strict=True))
        sums = np.zeros(classes * classes, dtype=np.int64)
        for text in frame["text"]:
            own = np.array(list(map(cls.__getitem__, tokens(text))), dtype=np.int64)
            sums += np.bincount(np.concatenate(([end], own[:-1])) * classes + own, minlength=classes * classes)
        at = np.flatnonzero(sums)
        return pd.DataFrame({"a": at // classes, "b": at % classes, "n": sums[at]})

    pair = np.zeros((classes, classes))
    learned_blocks = blocked.where(~F.col("held_out")).groupBy("block").cogroup(looked_up.groupBy("block"))
    for r in learned_blocks.applyInPandas(class_bigrams, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        pair[r["a"], r["b"]] = r["n"]
    model, column = settle(model, pair)
    release(docs.sparkSession)
    n, bounded = model.n, replace(model, words=None)
    # unknown words and the start of a text go by the class of their element or END
    start = end if column == "cls" else int(model.of[element_of(END, model.frequent)])
    schema = f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def of_block(frame: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        scorer = BlockScorer(bounded, words["word"].tolist(), words["c"].to_numpy(dtype=np.int64), words[column].to_numpy(dtype=np.int64), start, class_weight)
        out = [scorer.text(t) for t in frame["text"]]
        held = frame["held_out"].to_numpy()
        return pd.DataFrame({
            id_col: frame["_id"].to_numpy() if frame["_id"].notna().all() else frame["_id"], "held_out": held,
            "n_tokens": [o[0] for o in out], "n_known": [o[1] for o in out], "train_tokens": n,
            "base_score": [o[2] for o in out], "score": [o[3] for o in out],
        })

    return blocked.groupBy("block").cogroup(looked_up.groupBy("block")).applyInPandas(of_block, schema)


class BlockScorer:
    """Scores texts of a block, given the counts of all its known words."""

    def __init__(self, model: Model, words: list[str], c: np.ndarray, cls: np.ndarray, start: int, class_weight: float):
        self.model, self.weight = model, class_weight
        self.place = dict(zip(words, range(len(words)), strict=True))
        self.c = c
        self.cls = cls
        self.uni = (c + 0.5) / (model.n + 0.5 * (model.v + 1))
        self.log_uni = np.log10(self.uni)
        self.emit = (c + 0.5) / (model.class_tokens[self.cls] + 0.5 * (model.class_words[self.cls] + 1))
        self.start = start

    def _add(self, new: list[str]) -> None:
        at = len(self.place)
        self.place.update(zip(new, range(at, at + len(new)), strict=True))
        m = self.model
        cls = m.of[np.fromiter((element_of(w, m.frequent) for w in new), dtype=np.int64, count=len(new))]
        self.c = np.concatenate((self.c, np.zeros(len(new), dtype=np.int64)))
        self.cls = np.concatenate((self.cls, cls))
        unknown = 0.5 / (m.n + 0.5 * (m.v + 1))
        self.uni = np.concatenate((self.uni, np.full(len(new), unknown)))
        self.log_uni = np.concatenate((self.log_uni, np.full(len(new), np.log10(unknown))))
        self.emit = np.concatenate((self.emit, 0.5 / (m.class_tokens[cls] + 0.5 * (m.class_words[cls] + 1))))

    def text(self, text: str) -> tuple[int, int, float, float]:
        words = tokens(text)
        found = list(map(self.place.get, words))
        if None in found:
            self._add(list({w for w, i in zip(words, found, strict=True) if i is None}))
            found = list(map(self.place.__getitem__, words))
        at = np.array(found, dtype=np.int64)
        cls = self.cls[at]
        before = np.concatenate(([self.start], cls[:-1]))
        mixed = self.weight * self.model.transition[before, cls] * self.emit[at] + (1 - self.weight) * self.uni[at]
        return len(words), int((self.c[at] > 0).sum()), float(self.log_uni[at].sum()), float(np.log10(mixed).sum())
