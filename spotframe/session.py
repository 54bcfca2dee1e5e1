"""Session helpers: local session for tests and the lineage cut used by iterative operators."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Planner settings the operators are written for. Shuffled hash joins are chosen from measured
# partition sizes, so a large side still gets a sort-merge join that can spill.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stencils and draws expand rows after the shuffle, so small partitions are kept apart
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: The planner does not see that an explode makes a table grow: an image list of some KB that becomes pixels is estimated
#: at some KB still, and would be sent whole through the driver. So estimates choose no broadcast; measured sizes do.
ESTIMATED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
#: Pixel rows compress to little, so a partition of some MB may not fit a task as a hash table: sort-merge joins spill.
HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
_GIVEN = "spotframe.givenBroadcastThreshold"


def _broadcast_by_measure(spark: SparkSession, measured: bool) -> None:
    """Let the session's broadcast limit hold for measured sizes only, or give back what the session came with."""
    given = spark.conf.get(_GIVEN, None)
    if measured and given is None:
        limit = spark.conf.get(ESTIMATED)
        spark.conf.set(_GIVEN, f"{limit} {spark.conf.get(MEASURED, None) or ''}")
        if not spark.conf.get(MEASURED, None):
            spark.conf.set(MEASURED, limit)
        spark.conf.set(ESTIMATED, "-1")
    elif not measured and given is not None:
        limit, own = given.split(" ")
        spark.conf.set(ESTIMATED, limit)
        spark.conf.set(MEASURED, own) if own else spark.conf.unset(MEASURED)
        spark.conf.unset(_GIVEN)


def configure(spark: SparkSession, measured_broadcasts: bool = True) -> SparkSession:
    """Apply the planner settings to a session that somebody else created.

    ``measured_broadcasts`` False leaves broadcasts to the planner's estimates, for work that explodes no small table.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if measured_broadcasts:
        spark.conf.set(HASHED, "0")
        # rows that carry pixels are large, so a batch for Python is bounded by bytes as well
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    _broadcast_by_measure(spark, measured_broadcasts)
    return spark


def local_session(cpus: int = 8, app: str = "spotframe") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("SPOTFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the context knows it.

    It comes from ``spark.checkpoint.dir`` (a shared folder on a cluster). Only where neither that setting
    nor a context directory exists, as in local tests, a fresh folder is used.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder before running this operator")
            configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Plans made inside join tables that are dealt by some of the join keys where they stand.

    For tables that all hang on one bounded key, as the parts of an image do; a pooled key would gather in one task.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame, by_image: bool = False) -> DataFrame:
    """Checkpoint to reliable storage, see ``checkpoint_folder``. ``by_image``: every join has the image among its keys."""
    checkpoint_folder(df.sparkSession)
    if not by_image:
        return df.checkpoint()
    with co_partitioned(df.sparkSession):
        return df.checkpoint()
