"""Image manifests, plate layouts and logs as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SECONDARY_LABEL = "Sec-Only"  # fixed value
WELL_PATTERN = r"(?i)well[_\-\s]*(\d+)"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, r"[/\\]"), -1)


def _folder(path: Column) -> Column:
    parts = F.split(path, r"[/\\]")
    return F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(-2)))


def build_manifest(
    listing: DataFrame,
    extensions: Sequence[str],
    folder_map: Mapping[str, str] | None = None,
    secondary_folders: Sequence[str] = (),
    secondary_substring: str | None = None,
    rules: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """(path, condition, sec_only, subfolder): the folder map, then secondary-only, then the first name rule."""
    name, folder = _name(F.col("path")), _folder(F.col("path"))
    lower = F.lower(name)
    wanted = F.lit(False)
    for ext in extensions:
        wanted = wanted | lower.endswith("." + ext.lower().lstrip("."))
    sec = folder.isin(*secondary_folders) if secondary_folders else F.lit(False)
    if secondary_substring:
        sec = sec | lower.contains(secondary_substring.lower())
    label = F.lit(None).cast("string")
    for substring, condition in reversed(list(rules)):
        label = F.when(lower.contains(substring.lower()), F.lit(condition)).otherwise(label)
    mapped = F.lit(None).cast("string")
    for key, condition in (folder_map or {}).items():
        mapped = F.when(folder == key, F.lit(condition)).otherwise(mapped)
    condition = F.coalesce(mapped, F.when(sec, F.lit(SECONDARY_LABEL)), label, folder)
    return listing.where(wanted & ~name.startswith("_")).select(
        "path", condition.alias("condition"), sec.alias("sec_only"), folder.alias("subfolder")
    )


def reject_small(listing: DataFrame, min_bytes: int = 512) -> DataFrame:
    return listing.where(F.col("length") >= min_bytes)


def subset_manifest(manifest: DataFrame, subset: DataFrame, root: str = "") -> DataFrame:
    """Keep files named in ``subset`` (entry) by base name, full path or path below ``root``."""
    path = F.col("path")
    below = F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1))) if root else path
    keys = manifest.withColumn("_k", F.explode(F.array_distinct(F.array(path, _name(path), below))))
    hits = keys.join(subset.select(F.col("entry").alias("_k")).distinct(), "_k", "left_semi").select("path").distinct()
    return manifest.join(hits, "path", "left_semi")


def pending(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Files without a row in the finished table (path)."""
    return manifest.join(done.select("path"), "path", "left_anti")


def well_manifest(listing: DataFrame, extensions: Sequence[str] = ("vsi",), pattern: str = WELL_PATTERN) -> DataFrame:
    """(well, path, seq): well number from the folder, sequence number from the last short number of the name."""
    name, folder = _name(F.col("path")), _folder(F.col("path"))
    keep = F.lit(False)
    for ext in extensions:
        keep = keep | F.lower(name).endswith("." + ext.lower().lstrip("."))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    short = F.filter(F.split(stem, "_"), lambda t: t.rlike(r"^\d{1,3}$"))
    seq = F.coalesce(F.try_element_at(short, F.lit(-1)).cast("int"), F.lit(0))
    well = F.regexp_extract(folder, pattern, 1)
    return listing.where(keep & (well != "")).select(well.cast("int").alias("well"), "path", seq.alias("seq")).orderBy("well", "seq", "path")


# Accepted column names of a plate layout, in order of preference.
PLATE_COLUMNS = {
    "well": ("well", "well_num", "well_number"),
    "genotype": ("genotype", "geno", "line"),
    "arm": ("staining_arm", "arm", "staining"),
    "secondary": ("secondary", "secondary_label_in_layout", "secondary_antibody", "secondary_label", "secondary_label_in_folder_name"),
}


def normal_secondary(c: Column) -> Column:
    """647 stays, 568 and 565 are one arm, anything else is trimmed."""
    return F.when(c.contains("647"), "647").when(c.contains("568") | c.contains("565"), "568").otherwise(F.trim(c))


def plate_layout(table: DataFrame, channel_map: Mapping[str, str], overrides: Mapping[int, str] | None = None) -> DataFrame:
    """(well, genotype, arm, secondary, channel) from a layout table with any of the accepted column names."""
    by_lower = {c.lower().strip(): c for c in table.columns}
    source = {}
    for target, names in PLATE_COLUMNS.items():
        found = [by_lower[n] for n in names if n in by_lower]
        if not found:
            raise ValueError(f"plate layout lacks a {target} column; it has {table.columns}")
        source[target] = F.col(f"`{found[0]}`").cast("string")
    well = F.expr(f"try_cast(`{[by_lower[n] for n in PLATE_COLUMNS['well'] if n in by_lower][0]}` as int)")
    secondary = normal_secondary(source["secondary"])
    for key, value in (overrides or {}).items():
        secondary = F.when(F.col("well") == int(key), normal_secondary(F.lit(value))).otherwise(secondary)
    channel = F.raise_error(F.concat(F.lit("unknown secondary "), F.col("secondary"))).cast("string")
    for key, name in reversed(list(channel_map.items())):
        channel = F.when(F.col("secondary").contains(key), F.lit(name)).otherwise(channel)
    return (
        table.withColumn("well", well)
        .where(F.col("well").isNotNull())
        .select(
            "well",
            F.when(F.upper(source["genotype"]).contains("KO"), "KO").otherwise("WT").alias("genotype"),
            F.when(F.lower(source["arm"]).contains("primary"), "primary").otherwise("seconly").alias("arm"),
            secondary.alias("secondary"),
        )
        .withColumn("channel", channel)
    )


def focus_windows(log_lines: DataFrame, pattern: str) -> DataFrame:
    """(image, z_start, z_end) of the last matching line per file; log_lines (path, line_no, line).

    ``pattern`` captures image, start and end.
    """
    parts = [F.regexp_extract("line", pattern, i) for i in (1, 2, 3)]
    hits = log_lines.where(F.col("line").rlike(pattern)).select(parts[0].alias("image"), parts[1].cast("int").alias("s"), parts[2].cast("int").alias("e"), "line_no")
    last = F.max_by(F.struct("s", "e"), "line_no")
    return hits.groupBy("image").agg(last.alias("_w")).select("image", F.col("_w.s").alias("z_start"), F.col("_w.e").alias("z_end"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of text files, each file read whole so that line numbers hold."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
