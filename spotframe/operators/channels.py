"""Channel roles, parameter resolution and z selection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

# Words in a channel name that give away its role, roles tried in this order.
ROLE_WORDS = (
    ("dapi", ("dapi", "hoechst", "draq5", "405")),
    ("rna", ("488", "fitc", "gfp", "555", "tritc", "cy3", "561")),
    ("antibody", ("647", "cy5", "far red", "far-red", "640")),
)


def resolve_channels(images: DataFrame, dapi: int, rna: int, rna2: int, one_indexed: bool = False) -> DataFrame:
    """(image, role, channel): given numbers made 0-based and clamped; -1 stays automatic.

    images (image, n_channels). A second RNA channel that is missing or equals the first is an error.
    """
    shift = 1 if one_indexed else 0

    def index(given: int) -> Column:
        if given < 0:
            return F.lit(-1).cast("long")
        return F.greatest(F.lit(0).cast("long"), F.least(F.lit(given - shift).cast("long"), F.col("n_channels").cast("long") - 1))

    second = index(rna2)
    checked = F.when((second < 0) | (second == index(rna)), F.raise_error(F.lit("second RNA channel is missing or equals the first")).cast("long")).otherwise(second)
    roles = F.array(*[F.struct(F.lit(r).alias("role"), c.alias("channel")) for r, c in (("dapi", index(dapi)), ("rna", index(rna)), ("rna2", checked))])
    return images.select("image", F.explode(roles).alias("_r")).select("image", "_r.role", "_r.channel")


def autodetect_channels(names: DataFrame, words: Sequence[tuple[str, Sequence[str]]] = ROLE_WORDS) -> DataFrame:
    """(image, role, channel) from channel names, each named channel used once, roles in order.

    names (image, channel, name, mean). Without a named DAPI the channel brightest on average is taken;
    roles still open then get the remaining channels in order. An image has few channels, so they are
    handled as one array.
    """
    rows = names.groupBy("image").agg(F.sort_array(F.collect_list(F.struct("channel", "name", "mean"))).alias("ch"))
    out = rows.withColumn("left", F.col("ch"))

    def unused(role: str) -> Column:
        return F.filter("left", lambda c: ~c["channel"].eqNullSafe(F.col(f"_{role}")))

    for role, parts in words:
        hit = F.filter("left", _has_word(parts))
        out = out.withColumn(f"_{role}", F.get(hit, F.lit(0))["channel"]).withColumn("left", unused(role))
    brightest = F.array_max(F.transform("ch", lambda c: F.struct(c["mean"].alias("m"), c["channel"].alias("c"))))["c"]
    out = out.withColumn("_dapi", F.coalesce("_dapi", brightest)).withColumn("left", unused("dapi"))
    for role, _ in words:
        out = _take(out, role)
    roles = F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"_{r}").alias("channel")) for r, _ in words])
    return out.select("image", F.explode(roles).alias("_r")).select("image", "_r.role", "_r.channel").where(F.col("channel").isNotNull())


def _has_word(parts: Sequence[str]) -> Callable[[Column], Column]:
    """A test of a channel for any of the words, taken literally."""
    return lambda c: reduce(or_, [F.contains(F.lower(c["name"]), F.lit(p)) for p in parts])


def _take(df: DataFrame, role: str) -> DataFrame:
    """Fill an open role with the first channel left over."""
    is_open = F.col(f"_{role}").isNull() & (F.size("left") > 0)
    first = F.get("left", F.lit(0))["channel"]
    return df.select(
        *[c for c in df.columns if c not in (f"_{role}", "left")],
        F.when(is_open, first).otherwise(F.col(f"_{role}")).alias(f"_{role}"),
        F.when(is_open, F.slice("left", F.lit(2), F.size("left"))).otherwise(F.col("left")).alias("left"),
    )


def resolve_params(shared: Mapping[str, float], overrides: DataFrame) -> DataFrame:
    """Per-channel settings: the override where given, else the shared value."""
    cols = [(F.coalesce(F.col(k), F.lit(v)) if k in overrides.columns else F.lit(v)).alias(k) for k, v in shared.items()]
    return overrides.select("channel", *cols)


def resolve_floor(roles: DataFrame) -> DataFrame:
    """(channel, floor): pinned, else forwarded, else manual minimum; non-positive values do not count."""
    return roles.select("channel", F.coalesce(*[F.when(F.col(c) > 0, F.col(c)) for c in ("pinned", "forwarded", "manual")]).alias("floor"))


def relabel_channel(df: DataFrame, source: str = "rna2", target: str = "protein") -> DataFrame:
    """Rename the second channel in column names and channel values; a name already taken is left alone."""
    renames = {}
    for c in df.columns:
        new = c.replace(source, target)
        if new != c and new not in df.columns and new not in renames.values():
            renames[c] = new
    out = df.withColumnsRenamed(renames)
    return out.withColumn("channel", F.when(F.col("channel") == source, target).otherwise(F.col("channel"))) if "channel" in out.columns else out


def z_overrides(images: DataFrame, overrides: DataFrame, default_start: int | None, default_end: int | None) -> DataFrame:
    """(image, z_start, z_end): per-image bounds where given, else the defaults; images (image, n_z)."""
    joined = images.join(overrides, "image", "left")
    return joined.select("image", F.coalesce("z_start", F.lit(default_start)).alias("z_start"), F.coalesce("z_end", F.lit(default_end)).alias("z_end"))


def _max_rows(rows: DataFrame) -> DataFrame:
    """Pixel-wise maximum over z, in flat form."""
    keep = [c for c in rows.columns if c not in ("vals", "z")]
    return rows.select(*keep, F.posexplode("vals").alias("x", "v")).groupBy(*keep, "x").agg(F.max("v").alias("v")).withColumn("x", F.col("x").cast("long"))


def select_z(plane_rows: DataFrame, mode: str, z_start: int | None = None, z_end: int | None = None, z: int | None = None) -> DataFrame:
    """One slice, the maximum projection, or the whole stack; bounds are 1-based, inclusive and clamped."""
    depth = plane_rows.groupBy("image").agg((F.max("z") + 1).alias("_n"))
    rows = plane_rows.join(depth, "image")
    if mode == "single":
        chosen = F.lit(z - 1) if z is not None else F.expr("_n div 2")
        at = F.greatest(F.lit(0), F.least(chosen, F.col("_n") - 1))
        one = rows.where(F.col("z") == at).drop("_n", "z")
        keep = [c for c in one.columns if c != "vals"]
        return one.select(*keep, F.posexplode("vals").alias("x", "v")).withColumn("x", F.col("x").cast("long"))
    low = F.greatest(F.lit(1), F.least(F.lit(z_start or 1), F.col("_n")))
    high = F.greatest(F.lit(1), F.least(F.lit(z_end) if z_end else F.col("_n"), F.col("_n")))
    inside = F.when(low <= high, (F.col("z") + 1 >= low) & (F.col("z") + 1 <= high)).otherwise(F.lit(True))
    stack = rows.where(inside).drop("_n")
    if mode == "3d":
        return stack
    if mode != "maxproj":
        raise ValueError("mode is 'single', 'maxproj' or '3d'")
    return _max_rows(stack)


def lock_z(plane_rows: DataFrame, picked: DataFrame, project: str = "max") -> DataFrame:
    """Every channel on the picked slice (image, z) or window (image, z_start, z_end; 0-based, inclusive)."""
    if "z" in picked.columns:
        rows = plane_rows.join(picked, ["image", "z"])
        return rows
    inside = (F.col("z") >= F.col("z_start")) & (F.col("z") <= F.col("z_end"))
    rows = plane_rows.join(picked, "image").where(inside).drop("z_start", "z_end")
    if project == "none":
        return rows
    if project == "max":
        return _max_rows(rows)
    keep = [c for c in rows.columns if c not in ("vals", "z")]
    return rows.select(*keep, F.posexplode("vals").alias("x", "v")).groupBy(*keep, "x").agg(F.avg("v").alias("v")).withColumn("x", F.col("x").cast("long"))
