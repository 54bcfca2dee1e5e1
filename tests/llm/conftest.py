import random

import pytest

#: Columns that operators also use for their results or inside.
CLASHING = ("kept", "size", "score", "length", "start", "component_id", "copies", "piece", "block", "word", "held_out", "target", "n", "key")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def odd_texts() -> list:
    """(doc_id, text, lang, source): nulls everywhere, ties, repeated rows, empty, odd and very long texts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, other = prose(120), prose(90)
    near = base.split(" ")
    near[60] = "changed"
    return [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, base, "en", None), (4, " ".join(near), "en", "b"),
        (5, other, "fr", "b"), (6, other + " " + prose(3), "fr", "b"), (7, None, None, None), (8, "", "en", "a"), (9, "   \t\n ", "fr", "b"),
        (10, "one two", "en", "c"), (11, "one  two", "en", "c"), (12, prose(30_000), "fr", "c"), (13, "x" * 200_000, None, "c"), (14, "日本語 テスト。\n\n\nabc <|endoftext|> ﬁ İ Σ", None, "a"),
        (15, "12345 67 !!! ...", "en", "a"), (16, "a. b\n\nc. d\n" * 40, "en", "b"), (16, "a. b\n\nc. d\n" * 40, "en", "b"), (None, base, "en", "a"), (None, None, None, None),
        (-3, prose(50), "en", "a"), (2**40, prose(50), "fr", "b"), (17, "nul\x00byte \x1f sep   line", "fr", "b"), (18, ("Hend " * 900).strip(), "en", "b"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, lang, s, None if t is None else len(t), *["clash"] * len(CLASHING)) for i, t, lang, s in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
