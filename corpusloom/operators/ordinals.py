"""Positions in key order, running sums and ordered prefixes, without a task that takes more than its range of keys.

All of it rests on one layout: rows dealt to the session's partitions by ranges of their keys and sorted there, so the ranges
follow the rows, whatever the keys are and however sparse. What a row adds inside its partition is known from
one pass in order; what the partitions before it add is a list with one entry per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.operators.rows import settle
from corpusloom.session import written

#: ``monotonically_increasing_id`` has a partition's number above, and the row's number inside it below this many bits.
_ROW_BITS = 33


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sorted_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows in ranges of their keys, sorted; NULL keys come first. One shuffle."""
    return df.repartitionByRange(_partitions(df), *keys).sortWithinPartitions(*keys)


def _before(totals: dict[int, list[int]]) -> list[tuple[int, ...]]:
    """``(partition, sum of the partitions before it, ...)`` from the totals of each partition."""
    numbers = sorted(totals)
    columns = zip(*[totals[number] for number in numbers], strict=True)
    sums = [list(accumulate(column, initial=0))[:-1] for column in columns]
    return [(number, *row) for number, row in zip(numbers, zip(*sums, strict=True), strict=True)]


def exclusive_prefix_sums(
    df: DataFrame, keys: list[str], values: dict[str, Column], derive: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Add, per entry ``out: value``, the sum of ``value`` over all rows that come before in key order.

    The keys are any columns that can be ordered, unique together. Rows are shuffled once; every partition
    sums as its rows pass in order and they are written with these sums. The totals of the partitions, one row each,
    are added up on the driver and joined back. Dealing by ranges looks at the input twice, so what is expensive belongs in
    ``derive``, which is applied after the shuffle, once per row.
    """
    amounts = [f"_amount_{i}" for i in range(len(values))]
    ranged = sorted_ranges(df, keys)
    df = settle(derive(ranged)) if derive else ranged
    given = df.select("*", *[value.cast("long").alias(name) for name, value in zip(amounts, values.values(), strict=True)])
    fields = [*df.schema.fields, T.StructField("_range", T.LongType()), *[T.StructField(name, T.LongType()) for name in amounts], *[T.StructField(f"_own{name}", T.LongType()) for name in amounts]]
    schema = T.StructType(fields)
    arrow, width = to_arrow_schema(schema), len(df.columns)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, sums = TaskContext.get().partitionId(), [0] * len(amounts)
        for batch in batches:
            own = [pc.fill_null(batch.column(name), 0) for name in amounts]
            before = []
            for i, column in enumerate(own):
                running = pc.add(pc.cumulative_sum(column), sums[i])
                before.append(pc.subtract(running, column))
                sums[i] = running[-1].as_py() if len(running) else sums[i]
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([number] * batch.num_rows, pa.int64()), *before, *own], schema=arrow)

    stored = written(given.mapInArrow(add_up, schema))
    totals = stored.groupBy("_range").agg(*[F.sum(f"_own{name}") for name in amounts])
    offsets = _before({row[0]: list(row[1:]) for row in totals.collect()})
    names = ["_range", *[f"_before{name}" for name in amounts]]
    placed = stored.join(df.sparkSession.createDataFrame(offsets, ", ".join(f"{name} long" for name in names)), "_range")
    return placed.select(*df.columns, *[(F.col(name) + F.col(f"_before{name}")).alias(out) for name, out in zip(amounts, values, strict=True)])


def exclusive_prefix_sum(df: DataFrame, keys: list[str], value: Column, out: str) -> DataFrame:
    """``exclusive_prefix_sums`` for a single value."""
    return exclusive_prefix_sums(df, keys, {out: value})


def ordinal_id(df: DataFrame, keys: list[str], out: str, start: Column | int = 0) -> DataFrame:
    """0-based position of every row in key order, plus ``start``.

    Any keys that can be ordered, dense or sparse. One shuffle; rows are numbered in their range as they are written.
    """
    begin = start if isinstance(start, Column) else F.lit(start)
    stored = written(sorted_ranges(df, keys).select("*", F.monotonically_increasing_id().alias("_at")))
    part, row = F.shiftright("_at", _ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    totals = stored.groupBy(part.alias("_range")).agg(F.count("*"))
    offsets = df.sparkSession.createDataFrame(_before({number: [n] for number, n in totals.collect()}), "_range long, _before long")
    placed = stored.withColumn("_range", part).join(offsets, "_range")
    return placed.select(*df.columns, (F.col("_before") + row + begin).cast("long").alias(out))


def _compared(keys: list[str], values: tuple) -> tuple[Column, Column]:
    """Whether a row comes before the given key, and whether it has that key; NULL comes first."""
    before, same = F.lit(False), F.lit(True)
    for key, value in zip(keys, values, strict=True):
        column = F.col(key)
        if value is None:
            less, equal = F.lit(False), column.isNull()
        else:
            less, equal = column.isNull() | (column < F.lit(value)), column.eqNullSafe(F.lit(value))
        before, same = before | (same & less), same & equal
    return before, same


def cut_key(df: DataFrame, keys: list[str], position: int) -> tuple[tuple, int, int] | None:
    """The key at a 0-based position of the ordered rows, how many rows come before that key, and how many have it.

    None beyond the end.

    Equal keys are counted before the shuffle, so a key of many rows is one entry. The ranges are counted, and
    only the range that holds the position is summed row by row.
    """
    if position < 0:
        return None
    counts = df.select(*keys).groupBy(*keys).agg(F.count("*").alias("_n"))
    stored = written(sorted_ranges(counts, keys).select("*", F.spark_partition_id().alias("_range")))
    totals = {row[0]: [row[1]] for row in stored.groupBy("_range").agg(F.sum("_n")).collect()}
    holding = [(number, before) for number, before in _before(totals) if before <= position < before + totals[number][0]]
    if not holding:
        return None
    ((number, before),) = holding
    # One range of keys, in one task.
    ordered = stored.where(F.col("_range") == number).coalesce(1).sortWithinPartitions(*keys)
    found = T.StructType([*[df.schema[key] for key in keys], T.StructField("_before", T.LongType()), T.StructField("_n", T.LongType())])
    arrow, left = to_arrow_schema(found), position - before

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = 0
        for batch in batches:
            ends = pc.cumulative_sum(batch.column("_n"))
            if batch.num_rows and passed <= left < passed + ends[-1].as_py():
                row = pc.index(pc.greater(ends, left - passed), True).as_py()
                rows = batch.column("_n")[row].as_py()
                first = passed + ends[row].as_py() - rows
                columns = [batch.column(i).slice(row, 1).cast(arrow.field(i).type) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([first + before], pa.int64()), pa.array([rows], pa.int64())], schema=arrow)
            passed += ends[-1].as_py() if batch.num_rows else 0

    row = ordered.select(*keys, "_n").mapInArrow(find, found).first()
    return tuple(row[:-2]), row["_before"], row["_n"]


def _any(df: DataFrame, n: int) -> DataFrame:
    """``n`` of the rows, whichever; rows are numbered where they are."""
    stored = written(df.select("*", F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", _ROW_BITS)
    totals = {number: [rows] for number, rows in stored.groupBy(part.alias("_range")).agg(F.count("*")).collect()}
    offsets = df.sparkSession.createDataFrame(_before(totals), "_range long, _before long")
    position = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stored.withColumn("_range", part).join(offsets, "_range").where(position < n).select(*df.columns)


def first_n(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order, for any ``n`` and any keys that can be ordered; NULL keys come first.

    Keys alone are shuffled, to find the key at which to cut; the rows are then filtered by it where they are, which
    a scan can use. The order of the result is not kept. Of rows that share the last key any are taken.
    """
    if n <= 0:
        return df.limit(0)
    cut = cut_key(df, keys, n - 1)
    if cut is None:
        return df
    key, rows_before, rows_of_key = cut
    before, same = _compared(keys, key)
    if rows_before + rows_of_key == n:
        return df.where(before | same)
    return df.where(before).unionByName(_any(df.where(same), n - rows_before))


def row_at(df: DataFrame, key: str, position: int) -> DataFrame:
    """The row at a 0-based position of an ordered result; any one of those that share its key."""
    cut = cut_key(df, [key], position)
    return df.limit(0) if cut is None else df.where(_compared([key], cut[0])[1]).limit(1)
