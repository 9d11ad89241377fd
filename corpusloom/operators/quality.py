"""Declared constraints of the stored tables as checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas


def check_not_null(df: DataFrame, table: str) -> DataFrame:
    """``(table_name, column_name, null_rows)`` for every column, from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    rows = counted.unpivot([], df.columns, "column_name", "null_rows")
    return rows.select(F.lit(table).alias("table_name"), "column_name", "null_rows")


def check_unique(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once, with their number of rows.

    Texts are not a shuffle key: their digests are counted first, and only rows whose digest occurs again are
    compared in full.
    """
    if any(isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType)) for name in key):
        digest = F.xxhash64(*key)
        again = df.groupBy(digest.alias("_digest")).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("_digest")
        df = df.select(*key, digest.alias("_digest")).join(again, "_digest", "left_semi")
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def check_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of values that occur again, and of their rows, for every declared key of the given tables.

    Each table is read once: a row gives a digest of 128 bits for each of its keys, and the digests of all keys of all tables meet
    in one shuffle, counted before it. Texts are not moved.
    """
    declared = [(name, key) for keys in (schemas.PRIMARY_KEYS, schemas.UNIQUE_KEYS) for name, key in keys.items() if name in tables]
    digests = []
    for table in dict.fromkeys(name for name, _ in declared):
        entries = [
            F.struct(F.lit(n).alias("key_no"), F.xxhash64(F.lit(1), *key).alias("a"), F.xxhash64(F.lit(2), *key).alias("b"))
            for n, (name, key) in enumerate(declared)
            if name == table
        ]
        digests.append(tables[table].select(F.inline(F.array(*entries))))
    counts = reduce(DataFrame.unionByName, digests).groupBy("key_no", "a", "b").agg(F.count("*").alias("rows"))
    again = counts.where("rows > 1").groupBy("key_no").agg(F.count("*").alias("repeated_keys"), F.sum("rows").alias("key_rows"))
    names = tables[declared[0][0]].sparkSession.createDataFrame([(n, name, ",".join(key)) for n, (name, key) in enumerate(declared)], "key_no int, table_name string, key_columns string")
    zero = F.lit(0).cast("long")
    return names.join(again, "key_no", "left").select("table_name", "key_columns", F.coalesce("repeated_keys", zero).alias("repeated_keys"), F.coalesce("key_rows", zero).alias("key_rows"))


def key_collisions(df: DataFrame, generated: str, natural: tuple[str, ...]) -> DataFrame:
    """Generated ids that stand for more than one natural key."""
    distinct = df.select(generated, *natural).distinct()
    return distinct.groupBy(generated).agg(F.count("*").alias("natural_keys")).where(F.col("natural_keys") > 1)


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row, with their number of rows.

    Counted per value before the join, so a value that a third of the child rows share arrives as one row.
    """
    values = child.groupBy(F.col(column).alias("missing_value")).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_column).alias("missing_value"))
    return values.join(known, "missing_value", "left_anti")


def check_references(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of orphan rows of every declared reference between the given tables.

    Each table is read once: a row gives the ids that others may refer to, and those that it refers to. All of them meet in one
    shuffle on what is referred to and the id, counted before it, so a hot id is one row per task.
    """
    references = [reference for reference in schemas.FOREIGN_KEYS if reference[0] in tables and reference[2] in tables]
    targets = list(dict.fromkeys(reference[2:] for reference in references))
    values = []
    for table in dict.fromkeys(name for reference in references for name in (reference[0], reference[2])):

        def entry(target: int, column: str, reference: int) -> Column:
            return F.struct(F.lit(target).alias("target"), F.col(column).cast("long").alias("id"), F.lit(reference).alias("reference"))

        entries = [entry(n, column, -1) for n, (parent, column) in enumerate(targets) if parent == table]
        entries += [entry(targets.index(reference[2:]), reference[1], n) for n, reference in enumerate(references) if reference[0] == table]
        values.append(tables[table].select(F.inline(F.array(*entries))))
    counts = [F.count_if(F.col("reference") == n).alias(str(n)) for n in range(len(references))]
    by_id = reduce(DataFrame.unionByName, values).groupBy("target", "id").agg(F.bool_or(F.col("reference") == -1).alias("known"), *counts)
    orphans = by_id.where("NOT known OR id IS NULL").agg(*[F.coalesce(F.sum(F.col(f"`{n}`")), F.lit(0)).cast("long").alias(str(n)) for n in range(len(references))])
    rows = orphans.unpivot([], [F.col(f"`{n}`") for n in range(len(references))], "n", "orphan_rows")
    names = orphans.sparkSession.createDataFrame([(str(n), child, column, parent) for n, (child, column, parent, _) in enumerate(references)], "n string, child_table string, child_column string, parent_table string")
    return rows.join(names, "n").select("child_table", "child_column", "parent_table", "orphan_rows")
