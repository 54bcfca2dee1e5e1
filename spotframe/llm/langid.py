"""Language identification by unigram pieces, summed over all segmentations of the text.

The pieces are those of a fixed public vocabulary. Every language has a probability for each piece; the
probability of a word is the sum over all ways to cut it into pieces (forward algorithm), that of a text the
product over its words. Probabilities are learned by expectation maximisation over a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spotframe.llm.common import crc_mod, kept_by_worker, save, small_batches, text_or_empty

#: Bytes of a piece that fit into one unsigned long; longer pieces are found by their first bytes and a hash, then compared.
PIECE_BYTES = 8
#: Words of more bytes are summed with others of about their length, looked up so many bytes at a time.
SHORT, STEP = 48, 4096
#: Positions after which sums are scaled, so that a word of any length stays inside the range of doubles.
RESCALE, CENTRE = 24, 1e140
#: Words remembered per worker process; the table is emptied when full, which only costs time.
REMEMBERED = 400_000
#: Smallest piece probability. Every byte is a piece, so no word has probability 0.
FLOOR = 1e-6
#: Texts scored at a time inside a task.
TEXTS = 256
_M = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary: pieces of up to PIECE_BYTES as sorted unsigned longs, one list for each number of bytes, then the longer ones."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found: set[bytes] = {bytes([b]) for b in range(256)}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                raw = model.id_to_piece(i).replace("▁", " ").encode()
                if raw and b" " not in raw[1:]:  # no word holds a space
                    found.add(raw)
        by_length: list[list[int]] = [[] for _ in range(PIECE_BYTES + 1)]
        longer: dict[int, list[bytes]] = {}
        for raw in sorted(found):
            if len(raw) <= PIECE_BYTES:
                by_length[len(raw)].append(int.from_bytes(raw, "big"))
            else:
                longer.setdefault(len(raw), []).append(raw)
        self.keys = [np.sort(np.array(k, dtype=np.uint64)) for k in by_length]
        sizes = [len(k) for k in self.keys]
        self.first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.size = sum(sizes)
        self.longest = max(map(len, found))
        self.heads = np.unique(np.array([int.from_bytes(raw[:PIECE_BYTES], "big") for raws in longer.values() for raw in raws], dtype=np.uint64))
        self.longer: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # length -> sorted hashes, numbers, bytes
        for length, raws in sorted(longer.items()):
            matrix = np.frombuffer(b"".join(raws), dtype=np.uint8).reshape(len(raws), length)
            h = np.array([int.from_bytes(raw[:PIECE_BYTES], "big") for raw in raws], dtype=np.uint64)
            for k in range(PIECE_BYTES, length):
                h = h * _M + matrix[:, k]
            order = np.argsort(h)
            if (np.diff(h[order]) == 0).any():
                raise ValueError("two pieces with one hash")
            self.longer[length] = h[order], self.size + order, matrix[order]
            self.size += len(raws)

    def find(self, block: np.ndarray) -> tuple[list[np.ndarray], dict[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
        """block (m, n) bytes -> (for each length up to PIECE_BYTES the piece's number at each start, `size` where there
        is none; for ends of longer pieces: their length, rows and numbers)."""
        m, n = block.shape
        wide, out, packed = block.astype(np.uint64), [], np.zeros((m, n), dtype=np.uint64)
        for length in range(1, min(PIECE_BYTES, n) + 1):
            starts = n - length + 1
            packed = (packed[:, :starts] << np.uint64(8)) | wide[:, length - 1 :]
            keys = self.keys[length]
            if not len(keys):
                out.append(np.full(packed.shape, self.size, dtype=np.int32))
                continue
            at = np.minimum(np.searchsorted(keys, packed.ravel()), len(keys) - 1)
            hit = keys[at] == packed.ravel()
            out.append(np.where(hit, at + self.first[length], self.size).astype(np.int32).reshape(packed.shape))
        return out, self._find_longer(block, packed) if n > PIECE_BYTES and len(self.heads) else {}

    def _find_longer(self, block: np.ndarray, heads: np.ndarray) -> dict[int, list[tuple[int, np.ndarray, np.ndarray]]]:
        n = block.shape[1]
        at = np.minimum(np.searchsorted(self.heads, heads.ravel()), len(self.heads) - 1)
        rows, starts = np.nonzero((self.heads[at] == heads.ravel()).reshape(heads.shape))
        h, out = heads[rows, starts], {}
        for length in range(PIECE_BYTES + 1, min(self.longest, n) + 1):
            inside = starts + length <= n
            rows, starts, h = rows[inside], starts[inside], h[inside]
            h = h * _M + block[rows, starts + length - 1]
            if not len(rows) or length not in self.longer:
                continue
            keys, numbers, raws = self.longer[length]
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == h)
            hit = hit[(block[rows[hit, None], starts[hit, None] + np.arange(length)] == raws[at[hit]]).all(axis=1)]
            hit = hit[np.argsort(starts[hit], kind="stable")]
            cuts = np.flatnonzero(np.diff(starts[hit])) + 1
            for part in np.split(hit, cuts) if len(hit) else ():
                out.setdefault(int(starts[part[0]]) + length, []).append((length, rows[part], numbers[at[part]]))
        return out


@kept_by_worker
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _blocks(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in words, bytes, lengths): a space and each word, those of about one length together, filled up with zeros."""
    raws = [b" " + word.encode("utf-8", "surrogatepass") for word in words]
    length = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
    order = np.argsort(length, kind="stable")
    low = 0
    while low < len(order):
        shortest = int(length[order[low]])
        most = shortest if shortest <= SHORT else shortest + shortest // 4
        high = min(int(np.searchsorted(length[order], most, side="right")), low + max(1, 20_000 * SHORT // most))
        at = order[low:high]
        n = int(length[at[-1]])
        yield at, np.frombuffer(b"".join([raws[i].ljust(n, b"\0") for i in at]), dtype=np.uint8).reshape(len(at), n), length[at]
        low = high


def _windows(vocab: Pieces, block: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(begin, low, high): pieces with ends in (low, high] lie behind begin."""
    for low in range(0, block.shape[1], STEP):
        yield max(0, low - vocab.longest), low, min(low + STEP, block.shape[1])


def forward(vocab: Pieces, p: np.ndarray, block: np.ndarray, length: np.ndarray, trace: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(log of the summed probability of all segmentations (m, languages), the same of each prefix (n + 1, m) of the first language).

    Only the sums that a piece can reach back to are kept, scaled now and then; none ends at any fixed position.
    """
    m, n = block.shape
    size = min(vocab.longest, n) + 1
    ring = np.zeros((size, m, p.shape[1]))
    ring[0] = 1.0
    shift, out = np.zeros((m, p.shape[1])), np.zeros((m, p.shape[1]))
    logs = np.zeros((n + 1, m)) if trace else None
    ends = set(length.tolist())
    for begin, low, high in _windows(vocab, block):
        short, longer = vocab.find(block[:, begin:high])
        used = [(found != vocab.size).any(axis=0) for found in short]
        for end in range(low + 1, high + 1):
            e = end - begin
            now = np.zeros((m, p.shape[1]))
            for k in range(1, min(PIECE_BYTES, e) + 1):
                if used[k - 1][e - k]:
                    now += ring[(end - k) % size] * p[short[k - 1][:, e - k]]
            for k, rows, numbers in longer.get(e, ()):
                now[rows] += ring[(end - k) % size][rows] * p[numbers]
            ring[end % size] = now
            if trace:
                logs[end] = np.log(now[:, 0]) + shift[:, 0]
            if end in ends:
                done = length == end
                out[done] = np.log(now[done]) + shift[done]
            if end % RESCALE == 0 and end < n:
                scale = now * CENTRE
                ring /= scale
                shift += np.log(scale)
    return out, logs


def log_probability(vocab: Pieces, p: np.ndarray, words: list[str]) -> np.ndarray:
    """(words, languages): natural log of the probability of each word. p has a last row of zeros."""
    out = np.zeros((len(words), p.shape[1]))
    for at, block, length in _blocks(words):
        out[at] = forward(vocab, p, block, length)[0]
    return out


def expected_counts(vocab: Pieces, p: np.ndarray, words: list[str], weight: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece, by the forward algorithm and shares handed back; p has one column."""
    counts = np.zeros(vocab.size + 1)
    for at, block, length in _blocks(words):
        m, n = block.shape
        logs = forward(vocab, p, block, length, trace=True)[1]
        cut = np.zeros((n + 1, m))  # expected segmentations with a cut at each position
        cut[length, np.arange(m)] = weight[at]
        for begin, low, high in reversed(list(_windows(vocab, block))):
            short, longer = vocab.find(block[:, begin:high])
            used = [(found != vocab.size).any(axis=0) for found in short]
            for end in range(high, low, -1):
                e = end - begin
                for k in range(1, min(PIECE_BYTES, e) + 1):
                    if used[k - 1][e - k]:
                        number = short[k - 1][:, e - k]
                        use = cut[end] * p[number, 0] * np.exp(logs[end - k] - logs[end])
                        cut[end - k] += use
                        np.add.at(counts, number, use)
                for k, rows, numbers in longer.get(e, ()):
                    use = cut[end][rows] * p[numbers, 0] * np.exp(logs[end - k][rows] - logs[end][rows])
                    cut[end - k][rows] += use
                    np.add.at(counts, numbers, use)
    return counts[:-1]


def _with_zero(p: np.ndarray) -> np.ndarray:
    return np.vstack([p, np.zeros((1, p.shape[1]))])


def train(labelled: DataFrame, vocab: str, per_language: int = 500, rounds: int = 4) -> tuple[list[str], np.ndarray]:
    """(languages in order, probabilities with a last row of zeros) from labelled (key, text, lang).

    Fitted on a bounded sample: about `per_language` documents of each language, those whose key hashes
    lowest, with their whole texts. Only sums over the vocabulary (pieces x languages) reach the driver.
    """
    known = labelled.where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((0, 0))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))])
    unit = F.pmod(F.xxhash64("key"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    sample = known.where(unit < F.element_at(share, F.col("lang")))
    words = sample.select("lang", F.explode(F.split(text_or_empty(F.col("text")), r"\s+")).alias("word")).where(F.col("word") != "")
    counted = save(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    vocabulary = pieces(vocab)
    p = np.full((vocabulary.size, len(languages)), 1.0 / vocabulary.size)
    for _ in range(rounds):
        now = {lang: p[:, [i]] for i, lang in enumerate(languages)}

        def expect(frames: Iterator[pd.DataFrame], now: dict = now) -> Iterator[pd.DataFrame]:
            ours = pieces(vocab)
            sums: dict[str, np.ndarray] = {}
            for frame in frames:
                for lang, part in frame.groupby("lang"):
                    one = expected_counts(ours, _with_zero(now[lang]), part["word"].tolist(), part["n"].to_numpy(dtype=float))
                    sums[lang] = sums.get(lang, 0.0) + one
            for lang, one in sums.items():
                at = np.flatnonzero(one)
                yield pd.DataFrame({"lang": lang, "piece": at, "uses": one[at]})

        uses = counted.mapInPandas(expect, "lang string, piece long, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))
        totals = np.zeros_like(p)
        column = {lang: i for i, lang in enumerate(languages)}
        for r in uses.toLocalIterator():
            totals[r["piece"], column[r["lang"]]] = r["uses"]
        totals += 0.1
        p = np.maximum(totals / totals.sum(axis=0), FLOOR)
        p /= p.sum(axis=0)
        p = np.maximum(p, FLOOR)
    return languages, _with_zero(p)


class Scorer:
    """Log probabilities of words under every language, remembered per word."""

    def __init__(self, vocab: str, p: np.ndarray):
        self.vocab, self.p = pieces(vocab), p
        self.place: dict[str, int] = {}
        self.value = np.zeros((0, p.shape[1]))

    def texts(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): log probability of each whole text."""
        split = [t.split() for t in texts]
        if len(self.place) > REMEMBERED:
            self.place, self.value = {}, self.value[:0]
        new = list(set().union(*split).difference(self.place))
        if new:
            at = len(self.place)
            self.place.update(zip(new, range(at, at + len(new)), strict=True))
            if at + len(new) > len(self.value):
                grown = np.zeros((max(2 * len(self.value), at + len(new)), self.p.shape[1]))
                grown[:at] = self.value[:at]
                self.value = grown
            self.value[at : at + len(new)] = log_probability(self.vocab, self.p, new)
        out = np.zeros((len(texts), self.p.shape[1]))
        get = self.place.__getitem__
        for i, words in enumerate(split):
            if words:
                out[i] = self.value[np.fromiter(map(get, words), dtype=np.int64, count=len(words))].sum(axis=0)
        return out


def identify(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out: int = 2, per_language: int = 500, rounds: int = 4, keep_columns: bool = False, prefix: str = "") -> DataFrame:
    """docs' id with (held_out, lang_pred, score): the language that makes the whole text most probable.

    Learns from documents with a language whose crc32(id as text) mod `folds` is not `held_out`; predictions
    use the text alone. score is the posterior probability of the predicted language under equal priors.

    Defined cases: a null text, or one without a letter, is `und` with score 0; so is every text where nothing
    can be learned; equal probabilities go to the first language in code-point order; rows repeating an id
    are judged one by one; an empty table gives no rows; other columns are ignored, or kept in front of the
    results with `keep_columns`. `prefix` goes before the names of the results, so that none clashes.
    """
    fold = crc_mod(F.col(id_col), folds) == held_out
    labelled = docs.where(~fold).select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    languages, p = train(labelled, vocab, per_language, rounds)
    names = docs.columns if keep_columns else [id_col, text_col]
    judged = predict(small_batches(docs).select(*names), languages, p, vocab, text_col, prefix).withColumn(f"{prefix}held_out", fold)
    return judged.select(*(names if keep_columns else [id_col]), *[prefix + c for c in ("held_out", "lang_pred", "score")])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, languages: list[str], p: np.ndarray, vocab: str, text_col: str, prefix: str = "") -> DataFrame:
    """docs plus (lang_pred, score); p as returned by `train`."""
    pred, posterior_name = prefix + "lang_pred", prefix + "score"
    if not languages:
        return docs.withColumn(pred, F.lit("und")).withColumn(posterior_name, F.lit(0.0))
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{pred}` string, `{posterior_name}` double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(vocab, p)
        for big in batches:
            for at in range(0, big.num_rows, TEXTS):
                batch = big.slice(at, TEXTS)
                sums = scorer.texts([t or "" for t in batch.column(names.index(text_col)).to_pylist()])
                best = sums.argmax(axis=1)
                posterior = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([languages[i] for i in best]), pa.array(posterior)], [*names, pred, posterior_name])

    letters = has_letter(F.col(text_col))
    return (
        docs.mapInArrow(score, schema)
        .withColumn(posterior_name, F.when(letters, F.col(posterior_name)).otherwise(0.0))
        .withColumn(pred, F.when(letters, F.col(pred)).otherwise("und"))
    )
