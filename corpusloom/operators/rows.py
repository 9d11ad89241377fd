"""Two row-shaping helpers that keep expensive columns from being computed more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, given: Sequence[str] = ()) -> DataFrame:
    """Make the columns of ``df`` final, so that a later filter is not computed from their definitions.

    The optimizer moves a filter below the projections it depends on and repeats their expressions
    there; over a long chain that would run the whole chain several times per row. A filter cannot pass
    a generator that produces the column it tests. ``given`` columns come first and stay outside the generator:
    they have no chain, and are not carried along it where nobody reads them.
    """
    made = [F.col(name) for name in df.columns if name not in given]
    return df.select(*given, F.inline(F.array(F.struct(*made))))


def exploded(df: DataFrame, keep: list, array: str | Column, position: str, value: str) -> DataFrame:
    """One row per array element with its position; an empty or missing array gives none.

    A plain explode makes the optimizer add a test that the array is not empty below it, which computes
    the array a second time. An outer explode does not; its placeholder rows are dropped afterwards.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return rows.where(F.col(position).isNotNull())
