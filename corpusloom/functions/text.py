"""Text cleaning and token windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.rows import exploded

# The characters that a Unicode-aware strip removes.
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Entity names that start with these are citation markers of the source corpus.
REFERENCE_MARKERS = ("@xmath", "@xchem", "@xref", "@xlink")

# Fixed value: a model stops here.
STOP_SEQUENCE = "<<END>>"


def strip_nul(text: Column) -> Column:
    """Drop NUL characters."""
    return F.replace(text, F.char(F.lit(0)), F.lit(""))


def strip_blanks(text: Column) -> Column:
    """Drop leading and trailing blanks of any kind, line breaks included."""
    return F.trim(text, F.lit(BLANK_CHARACTERS))


def before_stop(text: Column, stop: str = STOP_SEQUENCE) -> Column:
    """Model output up to the stop sequence."""
    return F.substring_index(text, stop, 1)


def drop_reference_markers(entities: Column) -> Column:
    """Entity array without citation markers."""
    pattern = "^(" + "|".join(REFERENCE_MARKERS) + ")"
    return F.filter(entities, lambda name: ~name.rlike(pattern))


@dataclass(frozen=True)
class PatternTokenizer:
    """Tokens are the matches of a regular expression; everything stays in column expressions.

    ``separator`` joins tokens back to text. ``LOSSLESS`` keeps the blanks inside the tokens, so that
    joining all of them gives the text back.
    """

    pattern: str = r"\S+"
    separator: str = " "

    def tokens(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def count(self, text: Column) -> Column:
        return F.regexp_count(text, F.lit(self.pattern)).cast("long")

    def head(self, text: Column, size: int) -> Column:
        """The first window of a text."""
        return F.array_join(F.slice(self.tokens(text), 1, size), self.separator)

    def with_windows(
        self, df: DataFrame, text: str, size: int, overlap: int, out: str, drop_covered_tail: bool = False
    ) -> DataFrame:
        """Replace the text column by the array of its windows.

        The token array is used twice, so the optimizer keeps it as a projection of its own and each
        text is tokenized once. The windows are built as one array: a row of tokens is never copied
        per window, which would be quadratic in the length of the text.
        """
        kept = [name for name in df.columns if name != text]
        tokens = df.select(*kept, self.tokens(F.col(text)).alias("_tokens"))
        length = F.size("_tokens")
        last = F.greatest(length - overlap - 1, F.lit(0)) if drop_covered_tail else length - 1
        starts = F.sequence(F.lit(0), last, F.lit(size - overlap))
        windows = F.transform(
            starts, lambda start: F.array_join(F.slice("_tokens", start + 1, F.lit(size)), self.separator)
        )
        empty = F.array().cast("array<string>")
        return tokens.select(*kept, F.when(length > 0, windows).otherwise(empty).alias(out))


LOSSLESS = PatternTokenizer(r"\s*\S+(?:\s+\z)?", "")


@dataclass(frozen=True)
class ModelTokenizer:
    """A model's own tokenizer, applied in Arrow batches.

    ``factory`` is called once per task and returns an object with
    ``encode(text) -> list[int]`` and ``decode(list[int]) -> str``.
    """

    factory: Callable

    def count(self, text: Column) -> Column:
        factory = self.factory

        @F.pandas_udf("long")
        def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = factory()
            for texts in batches:
                yield texts.map(lambda value: len(model.encode(value)), na_action="ignore")

        return lengths(text)

    def head(self, text: Column, size: int) -> Column:
        factory = self.factory

        @F.pandas_udf("string")
        def heads(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = factory()
            for texts in batches:
                yield texts.map(lambda value: model.decode(model.encode(value)[:size]), na_action="ignore")

        return heads(text)

    def with_windows(
        self, df: DataFrame, text: str, size: int, overlap: int, out: str, drop_covered_tail: bool = False
    ) -> DataFrame:
        factory = self.factory

        def cut(model, value: str) -> list[str]:
            ids = model.encode(value)
            stop = max(len(ids) - overlap, 1) if drop_covered_tail else len(ids)
            return [model.decode(ids[at : at + size]) for at in range(0, min(stop, len(ids)), size - overlap)]

        @F.pandas_udf("array<string>")
        def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = factory()
            for texts in batches:
                yield texts.map(lambda value: cut(model, value), na_action="ignore")

        kept = [name for name in df.columns if name != text]
        return df.select(*kept, windows(F.col(text)).alias(out))


def chunk_articles(
    df: DataFrame,
    text: str = "article",
    size: int = 1024,
    overlap: int = 256,
    tokenizer: PatternTokenizer | ModelTokenizer = PatternTokenizer(),
    drop_covered_tail: bool = False,
) -> DataFrame:
    """One row per token window: the other columns of ``df``, ``part_no`` from 0, ``part_text``.

    Works row by row, without a shuffle. A text without tokens gives no row.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than the window size")
    kept = [name for name in df.columns if name != text]
    windows = tokenizer.with_windows(df, text, size, overlap, "_windows", drop_covered_tail)
    return exploded(windows, kept, "_windows", "part_no", "part_text")


def window_count(n_tokens: Column, size: int, overlap: int, drop_covered_tail: bool = False) -> Column:
    """Number of windows of a text, from its token count alone."""
    step = size - overlap
    reach = F.greatest(n_tokens - overlap, F.lit(1)) if drop_covered_tail else n_tokens
    return F.when(n_tokens > 0, F.ceil(reach / F.lit(step))).otherwise(F.lit(0)).cast("long")
