"""Reading and writing the tables of a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from spotframe.session import cut_lineage


def read_run(spark: SparkSession, path: str, table: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A stored table of a finished run; CSV tables need a schema."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("give a schema for CSV tables")
        reader = reader.option("header", "true")
    return (reader.schema(schema) if schema else reader).load(f"{path}/{table}")


def write_tables(tables: Mapping[str, DataFrame | None], path: str, partition_by: Mapping[str, Sequence[str]] | None = None, fmt: str = "parquet") -> list[str]:
    """Write the given tables below ``path``; absent and empty ones are skipped. Returns the names written.

    Each plan runs once, into a checkpoint that is then looked at and copied.
    """
    written = []
    for name, df in tables.items():
        if df is None or (df := cut_lineage(df)).isEmpty():
            continue
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", "true")
        keys = (partition_by or {}).get(name)
        (writer.partitionBy(*keys) if keys else writer).save(f"{path}/{name}")
        written.append(name)
    return written


def threshold_record(thresholds: DataFrame, params: Mapping[str, object]) -> DataFrame:
    """Threshold table with the settings that produced it, one row per image."""
    return thresholds.withColumns({k: F.lit(v) for k, v in params.items()})


def union_spots(a: DataFrame, b: DataFrame, channels: tuple[str, str] = ("rna1", "rna2")) -> DataFrame:
    """Both channels' spots with a channel column and an id that is unique over both."""
    first, second = a.withColumn("channel", F.lit(channels[0])), b.withColumn("channel", F.lit(channels[1]))
    both = first.unionByName(second, allowMissingColumns=True)
    return both.withColumn("global_id", F.concat_ws(":", "image", "channel", "spot_id"))


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables; a column missing somewhere is NULL there."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tables)
