"""Integer pixel offsets of disks, rings and squares, as literal arrays to explode."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def usable_radius(radius: float) -> float:
    return float(radius) if math.isfinite(radius) and radius > 0 else 1.0


def disk(radius: float) -> list[tuple[int, int]]:
    """Offsets (dy, dx) with dy^2 + dx^2 <= radius^2."""
    r = usable_radius(radius)
    reach = max(1, round(r))
    return [
        (dy, dx)
        for dy in range(-reach, reach + 1)
        for dx in range(-reach, reach + 1)
        if dy * dy + dx * dx <= r * r
    ]


def rings(edges: Sequence[float]) -> list[list[tuple[int, int]]]:
    """One offset list per ring: ring 0 is a disk, ring i the annulus (edges[i-1], edges[i]]."""
    outer = disk(max(1.0, edges[-1])) if edges else []
    out = []
    inner = -1.0
    for edge in edges:
        out.append([(dy, dx) for dy, dx in outer if inner < math.hypot(dy, dx) <= edge])
        inner = edge
    return out


def square(half: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in range(-half, half + 1) for dx in range(-half, half + 1)]


def spans(offsets: Sequence[tuple[int, int]]) -> dict[int, list[int]]:
    """Offsets grouped by row: dy -> sorted dx values."""
    by_row: dict[int, list[int]] = {}
    for dy, dx in sorted(offsets):
        by_row.setdefault(dy, []).append(dx)
    return by_row


def literal(offsets: Sequence[tuple[int, int]]) -> Column:
    return F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])
