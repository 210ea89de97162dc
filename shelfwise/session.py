"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    Nothing here but the time zone is required for right results. What was set
    at submit time stays; only what ``conf`` names is set in any case.
    """
    builder, submitted = SparkSession.builder.appName(app), SparkConf()
    for key, value in DEFAULTS.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own, because there the
    driver and the tasks share one disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    fallback = os.path.join(tempfile.gettempdir(), f"shelfwise-{spark.sparkContext.applicationId}")
    os.makedirs(fallback, exist_ok=True)
    return fallback


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job go when it ends, not when the driver collects garbage: for jobs whose result is stored."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that it is built once and survives lost executors.

    Columns rather than a checkpoint's rows: they are stored compressed, and a later step reads only those it uses. Its shuffles
    are not needed any more and leave the disk, so that a query of many steps holds those of one.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
