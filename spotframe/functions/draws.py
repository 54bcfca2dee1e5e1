"""Seeded counter draws: a pure function of seed, identifiers and counters, whatever the partitioning.

A stream starts from a digest of seed and identifiers. A draw adds its counters with fixed weights and
runs two quadratic steps modulo the Mersenne prime 2^31 - 1, which stays inside BIGINT arithmetic and
generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRIME = 2147483647
# Weights below 2^29, so that three weighted counters and a state stay below 2^63.
WEIGHTS = (433494437, 370248451, 274876859)
SHIFTS = (48271, 69621)


def stream(seed: int, *ids: Column) -> Column:
    """Start value in [0, 2^31 - 1) of the stream named by the seed and identifiers."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[i.cast("string") for i in ids]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % PRIME


def draw(state: Column, *counters: Column) -> Column:
    """A whole number in [0, 2^31 - 1) for up to three counters below 2^31."""
    words = [c.cast("long") for c in counters]
    start = state
    for w, weight in zip(words, WEIGHTS):
        start = start + w * F.lit(weight).cast("long")
    s = start % PRIME
    for shift, w in zip(SHIFTS, (words * 2)[::-1]):
        s = (s * (s + shift) + w) % PRIME
    return s


def uniform(state: Column, *counters: Column) -> Column:
    return draw(state, *counters) / F.lit(float(PRIME))


def draw_index(state: Column, size: Column, *counters: Column) -> Column:
    """0-based index below ``size``."""
    return F.floor(uniform(state, *counters) * size).cast("long")


def sql_draw(state: str, *counters: str) -> str:
    """The number of ``draw`` as a SQL expression, for checks in another engine."""
    start = " + ".join([f"({state})", *[f"({c})::BIGINT * {w}" for c, w in zip(counters, WEIGHTS)]])
    s = f"(({start}) % {PRIME})"
    for shift, c in zip(SHIFTS, (list(counters) * 2)[::-1]):
        s = f"(({s} * ({s} + {shift}) + ({c})) % {PRIME})"
    return s


def sql_stream(seed: int, *ids: str) -> str:
    """The start value of ``stream`` as a SQL expression."""
    named = " || '|' || ".join([f"'{seed}'", *[f"({i})::VARCHAR" for i in ids]])
    return f"(('0x' || substr(md5({named}), 1, 8))::BIGINT % {PRIME})"
