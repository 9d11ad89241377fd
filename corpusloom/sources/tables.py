"""Stored tables: parquet folders under one root on a shared file system."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import chain
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import ids


def newest_per_key(incoming: DataFrame, key: list[str], order: str | None = None) -> DataFrame:
    """One row per key. With ``order`` the row with the largest value wins; combined before the shuffle."""
    if order is None:
        return incoming.dropDuplicates(key)
    others = [name for name in incoming.columns if name not in key]
    best = incoming.groupBy(*key).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return best.select(*key, "_row.*").select(*incoming.columns)


def upsert_by_key(existing: DataFrame, incoming: DataFrame, key: list[str], order: str | None = None) -> DataFrame:
    """Incoming rows replace stored rows with the same key."""
    fresh = newest_per_key(incoming, key, order).select(*existing.columns)
    return existing.join(fresh.select(*key), key, "left_anti").unionByName(fresh)


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored, one per key."""
    return incoming.dropDuplicates(key).join(existing.select(*key), key, "left_anti").select(*incoming.columns)


def key_collisions(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Keys that a strict append of ``incoming`` would violate: stored already, or given twice.

    Keys only, counted before the join.
    """
    counts = incoming.groupBy(*key).agg(F.count("*").alias("incoming_rows"))
    stored = existing.select(*key).distinct().withColumn("_stored", F.lit(True))
    marked = counts.join(stored, key, "left")
    return marked.where((F.col("incoming_rows") > 1) | F.col("_stored").isNotNull()).select(*key, "incoming_rows")


def replace_variant(existing: DataFrame, fresh: DataFrame, column: str, variant: int) -> DataFrame:
    """All rows of one variant replaced by new ones."""
    return existing.where(F.col(column) != variant).unionByName(fresh.select(*existing.columns))


class KeyCollision(ValueError):
    """A strict append would break a key."""


class StillReferenced(ValueError):
    """Rows that other tables refer to would be removed."""


@dataclass(frozen=True)
class Tables:
    """The nine tables under ``root``."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> None:
        """Create every table that does not exist yet, empty."""
        for name, schema in schemas.TABLES.items():
            self._writer(self.spark.createDataFrame([], schema), name, "ignore").parquet(self.path(name))

    def read(self, table: str) -> DataFrame:
        """All columns in schema order (a scan would move the partition column to the end)."""
        self._finish_swap(table)
        schema = schemas.TABLES[table]
        reader = self.spark.read.schema(schema)
        if table not in schemas.PARTITION_COLUMNS:  # runs are folders, not values
            reader = reader.option("recursiveFileLookup", "true")
        return reader.parquet(self.path(table)).select(*schema.fieldNames())

    def select(self, table: str, *columns: str | Column) -> DataFrame:
        return self.read(table).select(*columns)

    def _writer(self, df: DataFrame, table: str, mode: str):
        writer = df.select(*schemas.TABLES[table].fieldNames()).write.mode(mode)
        variant = schemas.PARTITION_COLUMNS.get(table)
        return writer.partitionBy(variant) if variant else writer

    def append(self, table: str, rows: DataFrame) -> None:
        """Append rows whose keys are known to be new."""
        self._writer(rows, table, "append").parquet(self.path(table))

    def append_strict(self, table: str, rows: DataFrame) -> None:
        """Append; raise if a key is stored already or given twice.

        ``rows`` is evaluated for the check and for the write, so pass written or deterministic rows.
        """
        self.check_new(table, rows)
        self.append(table, rows)

    def check_new(self, table: str, rows: DataFrame) -> None:
        """Raise if a key of ``rows`` is stored already or given twice; other columns are not looked at."""
        key = list(schemas.PRIMARY_KEYS[table])
        clash = key_collisions(self.read(table), rows, key).take(1)
        if clash:
            raise KeyCollision(f"{table}: key {clash[0].asDict()} exists already or is given twice")

    def overwrite_variant(self, table: str, rows: DataFrame) -> None:
        """Replace the variants that occur in ``rows``; other variants are not read or written."""
        writer = self._writer(rows, table, "overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path(table))

    # Ids of sources

    def blocks(self) -> DataFrame:
        """``(dataset, source_block, block)``: which block of article ids each block of a dataset's own ids has.

        ``ids.MOST_BLOCKS`` rows at most, over all datasets.
        """
        path = f"{self.root}/_article_blocks"
        schema = "dataset string, source_block long, block long"
        self.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def place(self, source: DataFrame, dataset: str) -> DataFrame:
        """``source`` with ``article_id`` unique over datasets, and the dataset's own id as ``source_article_id``.

        A block of ids that comes up first gets its own number if that is free and in range, else one after the largest. Only
        numbers of blocks reach the driver, which are bounded; sources whose ids are spread over more blocks are refused.
        """
        known = self.blocks().collect()
        own = {row["source_block"] for row in known if row["dataset"] == dataset}
        seen = source.select(ids.source_block(F.col("article_id")).alias("source_block")).distinct().limit(ids.MOST_BLOCKS + 1)
        new = sorted({row[0] for row in seen.collect() if row[0] is not None} - own)
        taken = {row["block"] for row in known}
        if len(taken) + len(new) > ids.MOST_BLOCKS:
            raise ValueError(f"article ids of all datasets are spread over more than {ids.MOST_BLOCKS} blocks of {1 << ids.BLOCK_BITS}")
        given = {block: block for block in new if 0 <= block < ids.MOST_BLOCKS and block not in taken}
        taken |= given.keys()
        free = chain(range(max(taken, default=-1) + 1, ids.MOST_BLOCKS), range(ids.MOST_BLOCKS))
        for block in new:
            if block not in given:
                given[block] = next(number for number in free if number not in taken)
                taken.add(given[block])
        if given:
            rows = [(dataset, block, number) for block, number in given.items()]
            self.spark.createDataFrame(rows, self.blocks().schema).coalesce(1).write.mode("append").parquet(f"{self.root}/_article_blocks")
        blocks = F.broadcast(self.blocks().where(F.col("dataset") == dataset).select("source_block", "block"))  # bounded, see blocks()
        placed = source.withColumn("source_block", ids.source_block(F.col("article_id"))).join(blocks, "source_block")
        others = [name for name in source.columns if name != "article_id"]
        return placed.select(ids.in_block(F.col("block"), F.col("article_id")).alias("article_id"), F.col("article_id").alias("source_article_id"), *others)

    def source_ids(self) -> DataFrame:
        """``(article_id, dataset, source_article_id)`` of every stored article."""
        rows = self.select("articles", "article_id", "dataset").withColumn("block", ids.source_block(F.col("article_id")))
        joined = rows.join(F.broadcast(self.blocks()), ["dataset", "block"], "left")
        own = F.when(F.col("source_block").isNull(), F.col("article_id")).otherwise(ids.in_block(F.col("source_block"), F.col("article_id")))
        return joined.select("article_id", "dataset", own.alias("source_article_id"))

    # Runs

    def store_run(self, content: dict[str, DataFrame], numbers: dict[str, int]) -> None:
        """Rows of several tables that belong together, and the next free numbers after them.

        The rows of a run are a folder in each table, and the run counts once its numbers are stored; what a run that
        stopped before that has written is removed by ``drop_unfinished_runs``.
        """
        run = f"run-{uuid.uuid4().hex}"
        for table, rows in content.items():
            rows.select(*schemas.TABLES[table].fieldNames()).write.parquet(f"{self.path(table)}/{run}")
        row = self.spark.createDataFrame([(run, *numbers.values())], "run string, " + ", ".join(f"{name} long" for name in numbers))
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/_runs/{'-'.join(content)}")

    def runs(self, *tables: str) -> DataFrame | None:
        """The finished runs over these tables with their numbers, or None."""
        path = f"{self.root}/_runs/{'-'.join(tables)}"
        return self.spark.read.parquet(path) if self.exists(path) else None

    def drop_unfinished_runs(self, *tables: str) -> None:
        """Remove what stopped runs left in these tables; their folders are listed, no row is read."""
        stored = self.runs(*tables)
        finished = set() if stored is None else {row[0] for row in stored.select("run").collect()}
        for table in tables:
            for name in self._folders(self.path(table)):
                if name.startswith("run-") and name not in finished:
                    self._delete(f"{self.path(table)}/{name}")

    def _file_system(self, folder: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def exists(self, folder: str) -> bool:
        system, path = self._file_system(folder)
        return system.exists(path)

    def _files(self, folder: str) -> list[str]:
        """Parquet files below a folder, by their paths from there."""
        found, system = [], self._file_system(folder)[0]
        for entry in system.listStatus(self._file_system(folder)[1]):
            name = entry.getPath().getName()
            if entry.isDirectory():
                found += [f"{name}/{inner}" for inner in self._files(f"{folder}/{name}")]
            elif name.endswith(".parquet"):
                found.append(name)
        return found

    def _folders(self, folder: str) -> list[str]:
        system, path = self._file_system(folder)
        return [entry.getPath().getName() for entry in system.listStatus(path) if entry.isDirectory()]

    def delete_variant(self, table: str, variant: int) -> None:
        """Remove all rows of a variant; raise if a row of another table refers to one of them."""
        column = schemas.PARTITION_COLUMNS[table]
        removed = self.read(table).where(F.col(column) == variant)
        for child, name, parent, key in schemas.FOREIGN_KEYS:
            if parent == table:
                used = self.select(child, F.col(name).alias(key)).join(removed.select(key), key, "left_semi")
                if found := used.take(1):
                    raise StillReferenced(f"{table}.{key} {found[0][0]} is referred to by {child}.{name}")
        self._delete(f"{self.path(table)}/{column}={variant}")

    def upsert(self, table: str, rows: DataFrame, order: str | None = None) -> None:
        """Rows replace stored rows of their primary key, or are added; of several for a key the one with the largest ``order`` counts.

        Only files that hold one of the keys are written anew; all others stay as they are. New files and the names of the old
        ones are stored first, then they change places; a call that stops leaves the table as it was or is
        completed by the next read.
        """
        key = list(schemas.PRIMARY_KEYS[table])
        fresh = self.stage(newest_per_key(rows, key, order).select(*schemas.TABLES[table].fieldNames()))
        held = self.read(table).select("*", F.col("_metadata.file_path").alias("_file"))
        touched = [row[0] for row in held.join(fresh.select(*key), key, "left_semi").select("_file").distinct().collect()]
        kept = held.where(F.col("_file").isin(touched)).drop("_file").join(fresh.select(*key), key, "left_anti")
        swap = f"{self.root}/_swaps/{table}"
        self._writer(kept.unionByName(fresh), table, "overwrite").parquet(f"{swap}/new")
        self.spark.createDataFrame([(name,) for name in touched], "name string").coalesce(1).write.mode("overwrite").parquet(f"{swap}/old")
        self._finish_swap(table)

    def _finish_swap(self, table: str) -> None:
        """Put the files of an upsert in their places, from wherever it stopped; nothing happens without one."""
        swap = f"{self.root}/_swaps/{table}"
        if not self.exists(swap):
            return
        if self.exists(f"{swap}/old/_SUCCESS"):  # written last: before that the upsert has not begun
            for name in self._files(f"{swap}/new"):
                target = f"{self.path(table)}/{name}"
                self._file_system(target)[0].mkdirs(self._file_system(target)[1].getParent())
                self._file_system(target)[0].rename(self._file_system(f"{swap}/new/{name}")[1], self._file_system(target)[1])
            for row in self.spark.read.schema("name string").parquet(f"{swap}/old").collect():
                self._delete(unquote(row["name"]))
        self._delete(swap)

    def rewrite(self, table: str, rows: DataFrame) -> None:
        """Replace a table by rows that may be computed from it: written next to it first."""
        staged = self.stage(rows.select(*schemas.TABLES[table].fieldNames()))
        self._writer(staged, table, "overwrite").parquet(self.path(table))

    def stage(self, rows: DataFrame, by: str | None = None) -> DataFrame:
        """Write rows once under the root and read them back; later steps start from the written files.

        ``by`` names a column with few values; a filter on it reads the files of its value only.
        """
        path = self.new_folder()
        writer = rows.write.partitionBy(by) if by else rows.write
        writer.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)

    def new_folder(self) -> str:
        """A path for staged rows that nothing else uses."""
        return f"{self.root}/_staged/{uuid.uuid4().hex}"

    def release(self) -> None:
        """Remove all staged rows. Call it when no run is going on and the frames that runs returned are used up."""
        self._delete(f"{self.root}/_staged")

    def _delete(self, folder: str) -> None:
        system, path = self._file_system(folder)
        system.delete(path, True)
