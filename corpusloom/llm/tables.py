"""Written intermediate tables and columns that an operator carries along."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import shared_folder


def written(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends there, a lost executor costs no more."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    """How many tasks a shuffle is dealt to: the session's own setting, which is sized to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def exactly(df: DataFrame, name: str) -> Column:
    """The column of that name, also where it has dots or another column differs in case only."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").select(*columns)


def carried(df: DataFrame, keep: Sequence[str]) -> Column:
    """The columns to carry as one struct, so that their names cannot clash with the operator's own."""
    fields = [exactly(df, name).alias(f"c{i}") for i, name in enumerate(keep)]
    return F.struct(*fields, F.lit(0).alias("none")).alias("carried")


def released(keep: Sequence[str], taken: set[str] = frozenset()) -> list[Column]:
    """The carried columns under their names; the operator's own columns replace those of the same name."""
    return [F.col(f"carried.c{i}").alias(name) for i, name in enumerate(keep) if name not in taken]
