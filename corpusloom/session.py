"""Session settings and the shared folder for written intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Of a repeated JSON key the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings for a cluster session; sizes and masters are the caller's."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the place that ``spark.checkpoint.dir`` names.

    Only a local session may leave that unset (tests); its warehouse folder is used then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


#: Spark then removes the shuffle files of a write when that write has ended.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written here go with its end, not when the driver happens to collect its garbage. Later actions start from the files written."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def written(df: DataFrame, **options: str) -> DataFrame:
    """The rows written once to the shared folder; whatever follows starts from the files, also after a lost executor."""
    path = shared_folder(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
