"""Token ids of whole texts with a remembered table of pieces, for use inside Spark tasks.

A public tokenizer cuts a text into pieces before it merges anything, and a single space between two
other characters that are not white space is always such a cut. A text is therefore split there, each
distinct piece is encoded once by the tokenizers library, and its ids are remembered in the worker
process. The ids are those of the whole text: the cuts are the tokenizer's own.
"""

from __future__ import annotations

import gc
import json
import os
from array import array
from itertools import filterfalse, islice

from spotframe.llm.common import kept_by_worker

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces kept per worker process; the table is emptied when it is full, which only costs time.
REMEMBERED = 1_000_000
#: Texts whose pieces are looked up together.
TEXTS = 256
_TAIL = frozenset(".,;:!?|")


def _byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write every byte as a printable character; the others are counted up from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTES = _byte_characters()


def _direct(settings: dict) -> tuple[str, bool] | None:
    """(how a space before letters is written, whether case is folded) for the two layouts whose letters can skip the pre-tokenizer."""
    cut, form = settings["pre_tokenizer"] or {}, settings["normalizer"]
    if form is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
        return _BYTES[32], False
    steps = [s["type"] for s in cut.get("pretokenizers", [])]
    if steps == ["Split", "ByteLevel"] and form and [s["type"] for s in form.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
        return "", True
    return None


class PieceTable:
    """Ids of pieces as little-endian unsigned 32-bit integers.

    `head` holds pieces that begin a text, `inner` those that follow a cut; the space at the cut
    belongs to them and is not part of the key.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.direct = _direct(json.loads(self.tokenizer.to_str()))
        self.head: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}

    def _learn(self, known: dict[str, bytes], new: list[str], lead: str) -> None:
        # punctuation that closes a word is always a piece of its own for these vocabularies: the word is encoded once
        stems = {p: p[:-1] for p in new if p[-1] in _TAIL and p[-2:-1].isascii() and p[-2:-1].isalpha()}
        wanted = new
        if stems:
            wanted = [p for p in new if p not in stems]
            wanted = list(dict.fromkeys([*wanted, *(s for s in stems.values() if s not in known)]))
        if self.direct:
            # a run of letters is one piece whatever stands around it: it goes to the library's merges at once
            space, folds = self.direct
            space = space if lead else ""
            merges, other = self.model.tokenize, []
            for piece in wanted:
                if not (piece.isalpha() and (piece.isascii() or max(piece) < "\u0100")):
                    other.append(piece)
                    continue
                plain = piece.lower() if folds else piece
                coded = merges(space + (plain if plain.isascii() else plain.encode().decode("latin-1").translate(_BYTES)))
                known[piece] = array("I", [t.id for t in coded]).tobytes()
            wanted = other
        coded = self.tokenizer.encode_batch_fast([lead + p for p in wanted] if lead else wanted, add_special_tokens=False)
        for piece, one in zip(wanted, coded, strict=True):
            known[piece] = array("I", one.ids).tobytes()
        for piece, stem in stems.items():
            mark = piece[-1]
            if mark not in self.head:
                self.head[mark] = self.whole(mark)
            known[piece] = known[stem] + self.head[mark]

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn_batch(self, texts: list[str]) -> list[list[str] | None]:
        """Pieces of many texts; what is new in any of them is encoded in one call.

        None stands for a text that has white space beside a space or at an end: not every space in it is
        a cut. Pieces whose ends are white space never enter the tables, so such texts are found among the
        new pieces.
        """
        self._make_room()
        cut: list[list[str] | None] = [self._folded(t).split(" ") for t in texts]
        new: set[str] = set()
        for c in cut:
            new.update(filterfalse(self.inner.__contains__, islice(c, 1, None)))
        odd = self._learn_new({c[0] for c in cut}.difference(self.head), new)
        return [None if odd and not odd.isdisjoint(c) else c for c in cut]

    def _folded(self, text: str) -> str:
        """Lower case where the vocabulary folds case anyway and the text is Latin-1, whose letters fold one by one."""
        if self.direct and self.direct[1]:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
            return text.lower()
        return text

    def _make_room(self) -> None:
        if len(self.inner) > REMEMBERED:
            self.inner = {}
        if len(self.head) > REMEMBERED:
            self.head = {}

    def _learn_new(self, heads: set[str], new: set[str]) -> set[str]:
        """Encode what is new; returns the pieces that are not whole pieces, as one of their ends is white space."""
        odd = {p for p in heads | new if not p or p.strip() is not p}
        if heads - odd:
            self._learn(self.head, list(heads - odd), "")
        if new - odd:
            self._learn(self.inner, list(new - odd), " ")
        return odd

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts, four bytes each."""
        out: list[bytes] = []
        for at in range(0, len(texts), TEXTS):
            some = texts[at : at + TEXTS]
            self._make_room()
            get = self.inner.get
            cut = [self._folded(t).split(" ") for t in some]
            coded = [list(map(get, islice(c, 1, None))) for c in cut]
            open_ = [i for i, (c, ids) in enumerate(zip(cut, coded, strict=True)) if c[0] not in self.head or None in ids]
            if open_:
                missing = [[k for k, ids in enumerate(coded[i]) if ids is None] for i in open_]
                new = {cut[i][k + 1] for i, ks in zip(open_, missing, strict=True) for k in ks}
                odd = self._learn_new({cut[i][0] for i in open_}.difference(self.head), new)
                for i, ks in zip(open_, missing, strict=True):
                    c, ids = cut[i], coded[i]
                    if odd and not odd.isdisjoint(c):
                        cut[i] = None
                        continue
                    for k in ks:
                        ids[k] = self.inner[c[k + 1]]
            for text, c, ids in zip(some, cut, coded, strict=True):
                out.append(self.whole(text) if c is None else self.head[c[0]] + b"".join(ids))
        return out


@kept_by_worker
def table(path: str) -> PieceTable:
    """One table per worker process and vocabulary; tasks of the same worker share it."""
    gc.set_threshold(100_000, 50, 100)  # the tables hold no cycles
    return PieceTable(path)


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the files are the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
