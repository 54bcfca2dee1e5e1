"""Column expressions: labels, units, rotations and guarded arithmetic."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Label prefixes of the control group (case-insensitive).
CONTROL_PREFIXES = (
    "nt", "control", "ctrl", "ctl", "scr", "scramble", "sic", "si-c", "wt", "dmso", "veh", "vehicle",
    "mock", "untreated", "none", "no dox", "nodox", "no-dox", "parent", "baseline",
)
# A replicate suffix is a separator, an optional w / rep / r and digits.
REPLICATE_PATTERN = r"(?i)^(.+?)[_\-\s]((?:w|rep|r)?\d+)$"
# Full width at half maximum of a Gaussian with unit sigma.
FWHM_PER_SIGMA = 2.355


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def finite(c: Column) -> Column:
    """NaN and infinities become NULL, so that Spark aggregates skip them."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def safe_label(c: Column, default: str = "") -> Column:
    """Label usable in a file name.

    Quotes, colons, wildcards, angle brackets and pipes are dropped; blanks, hyphens, dots, commas and
    slashes separate words; words are joined by single underscores.
    """
    kept = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"""["':*?<>|]""", "")
    text = F.regexp_replace(F.regexp_replace(kept, r"[\s\-.,/\\_]+", "_"), r"^_|_$", "")
    return F.when(text == "", F.lit(default)).otherwise(text)


def pair_suffix(distance: float) -> str:
    """0.3 -> '0p3um', used in column names."""
    return f"{distance:.3f}".rstrip("0").rstrip(".").replace(".", "p") + "um"


def pair_suffix_column(distance: Column) -> Column:
    digits = F.format_string("%.3f", distance.cast("double"))
    digits = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", "")
    return F.concat(F.replace(digits, F.lit("."), F.lit("p")), F.lit("um"))


def split_replicate(condition: Column, image: Column) -> tuple[Column, Column]:
    """(group, replicate) from a condition such as 'WT_rep2'; without a match the image is the replicate."""
    hit = condition.rlike(REPLICATE_PATTERN)
    group = F.when(hit, F.regexp_extract(condition, REPLICATE_PATTERN, 1)).otherwise(condition)
    rep = F.when(hit, F.regexp_extract(condition, REPLICATE_PATTERN, 2)).otherwise(image.cast("string"))
    return group, rep


def is_control(c: Column) -> Column:
    return F.lower(F.trim(c)).rlike("^(" + "|".join(CONTROL_PREFIXES) + ")")


def coarse_group(c: Column) -> Column:
    """'Sec' for secondary-only labels, else the label up to its first underscore or hyphen."""
    return F.when(F.lower(c).contains("sec"), F.lit("Sec")).otherwise(F.regexp_extract(c, r"^[^_-]*", 0))


def stars(p: Column) -> Column:
    return (
        F.when(p.isNull(), F.lit("n/a"))
        .when(p < 0.001, F.lit("***"))
        .when(p < 0.01, F.lit("**"))
        .when(p < 0.05, F.lit("*"))
        .otherwise(F.lit("ns"))
    )


def format_p(p: Column) -> Column:
    return F.when(p.isNull(), F.lit("n/a")).when(p < 0.001, F.lit("<0.001")).otherwise(F.format_string("%.3f", p))


def direction(treated: Column, control: Column) -> Column:
    return (
        F.when(treated.isNull() | control.isNull(), F.lit("n/a"))
        .when(treated > control, F.lit("up"))
        .when(treated < control, F.lit("down"))
        .otherwise(F.lit("same"))
    )


def px_to_um(c: Column, voxel_um: Column) -> Column:
    return c * voxel_um


def disk_area(diameter: Column) -> Column:
    return F.lit(math.pi) * (diameter / 2.0) * (diameter / 2.0)


def sphere_volume(diameter: Column) -> Column:
    half = diameter / 2.0
    return F.lit(4.0 / 3.0 * math.pi) * half * half * half


def rotate(oy: Column, ox: Column, cy: Column, cx: Column, degrees: Column) -> tuple[Column, Column]:
    """Centre-relative offsets turned about (cy, cx), rounded half-even to a pixel."""
    angle = F.radians(degrees)
    c, s = F.cos(angle), F.sin(angle)
    return (
        F.rint(cy + (oy * c - ox * s)).cast("long"),
        F.rint(cx + (oy * s + ox * c)).cast("long"),
    )


def prettify(c: Column, labels: Mapping[str, str]) -> Column:
    """Metric column name to a readable label; channel tokens are replaced as whole words."""
    text = c
    for token, label in labels.items():
        text = F.regexp_replace(text, rf"\b{token}\b", label)
    text = F.trim(F.replace(text, F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))
