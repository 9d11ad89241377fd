"""Source articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_COLUMNS = ("article", "abstract", "section_names")
SOURCE_SCHEMA = T.StructType(
    [T.StructField("article_id", T.LongType()), *[T.StructField(name, T.StringType()) for name in SOURCE_COLUMNS]]
)


def scan_articles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Articles of one source, fixed schema, needed columns only. ``fmt`` is parquet, json or orc."""
    return spark.read.format(fmt).schema(SOURCE_SCHEMA).load(path)


def tag_and_union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources as one, each row tagged with the name of its ``dataset``."""
    tagged = [df.withColumn("dataset", F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, tagged)


def preview(df: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(key).limit(rows)
