"""Quality rules with robust multivariate outliers: minimum covariance determinant per language and source.

One scan takes the statistics of each text and a vector of transformed ones, in thousandths as integers, so that sums
are exact and do not depend on the order of the rows. For every language and source two estimates start, at the medians
and spreads of its features and at their mean and covariance, and take concentration steps until they stay: the ``SHARE`` of
rows with the smallest distances gives the next mean and covariance. Of both the one with the smaller determinant counts. Each
step is two pre-aggregated sums over all rows, so the largest source costs no task more
than others; distances are counted in bins, of which a unit has a bounded number. A row is rejected if its squared
Mahalanobis distance under the final estimate is over ``CUTOFF``.

A source of under ``MIN_ROWS`` rows is judged by the estimate of all rows of its language; if these are as few, by that of
all rows, however many there are. Rows that fail the base rules take no part in estimates.

Defined cases: a null text has no words and fails. Null languages and sources are '' here. Repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import scans, tables
from corpusloom.llm.bytewords import covered, mixed, words_of

SHARE = 0.75
CUTOFF = 60.0
MIN_ROWS = 200
STEPS = 30  # ends earlier, when no estimate changes
UNIT = 1000
#: Smallest spread of each feature, in its own measure: what ordinary texts differ by even where most have the same value.
LEAST_SPREAD = (0.10, 0.06, 0.15, 0.15)
_BINS_PER_E = 500
_LAST_BIN = 20_000

STATISTICS = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")]
)
FEATURES = ("f0", "f1", "f2", "f3")
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def statistics(rows: pa.RecordBatch) -> list:
    words = words_of(rows.column("text"))
    owner, n = words.rows(), rows.num_rows

    def between(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[stop] - sums[start]

    characters = between((words.data & 0xC0) != 0x80, words.start, words.end)
    word_chars = np.bincount(owner, weights=characters, minlength=n).astype(np.int64)
    symbols = between(_SYMBOL[words.data], words.texts[:-1], words.texts[1:])
    windows = words.windows(words.hashes(), 3)
    at = np.flatnonzero(words.left() >= 3)
    _, number, times = np.unique(mixed(windows[at] ^ (owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), return_inverse=True, return_counts=True)
    starts = np.zeros(len(windows), dtype=bool)
    starts[at[times[number] > 1]] = True
    repeated = np.bincount(owner, weights=covered(starts, 3), minlength=n).astype(np.int64)
    repeats, lines = [], []
    for text in rows.column("text").to_pylist():
        with_words = [line for line in (text or "").encode().split(b"\n") if line.strip()]
        lines.append(len(with_words))
        repeats.append(len(with_words) - len(set(with_words)))
    return [words.counts, word_chars, symbols, repeats, repeated, lines]


def _features() -> list[Column]:
    """Mean word length (log), symbols a word, repeated lines and repeated words (square roots of shares)."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = [
        F.log((F.col("word_chars") + 1) / words),
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    ]
    return [F.round(value * UNIT).cast("long").alias(name) for value, name in zip(values, FEATURES, strict=True)]


def _units(rows: DataFrame, min_rows: int) -> DataFrame:
    """Per language and source the unit that judges its rows (itself, its language or all), and the units that they are part of."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    languages = sizes.groupBy("lang").agg(F.sum("n").alias("of_lang"), F.min("n").alias("least"))
    everything = languages.where(F.col("of_lang") < min_rows).limit(1).count() > 0
    own, lang = F.to_json(F.array("lang", "source")), F.to_json(F.array("lang"))
    unit = F.when(F.col("n") >= min_rows, own).when(F.col("of_lang") >= min_rows, lang).otherwise(F.lit("[]"))
    parts = F.array(
        F.when(F.col("n") >= min_rows, own), F.when((F.col("of_lang") >= min_rows) & (F.col("least") < min_rows), lang), F.when(F.lit(everything), F.lit("[]"))
    )
    return sizes.join(languages, "lang").select("lang", "source", unit.alias("unit"), F.filter(parts, F.isnotnull).alias("units"))


def _inverted(sums: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mean, inverse covariance and the logarithm of its determinant from sums; the least spreads keep every covariance regular."""
    p = len(FEATURES)
    floor = np.diag((np.array(LEAST_SPREAD) * UNIT) ** 2)
    for frame in sums:
        out = []
        for row in frame.itertuples(index=False):
            mean = np.array([float(x) for x in row.firsts]) / row.n
            second = np.array([float(x) for x in row.seconds]).reshape(p, p) / row.n
            covariance = second - np.outer(mean, mean) + floor
            out.append((row.unit, row.start, mean.tolist(), np.linalg.inv(covariance).reshape(-1).tolist(), round(float(np.linalg.slogdet(covariance)[1]), 6)))
        yield pd.DataFrame(out, columns=["unit", "start", "mean", "inverse", "size"])


def _estimated(rows: DataFrame) -> DataFrame:
    products = [F.sum((F.col(a) * F.col(b)).cast("decimal(38,0)")).cast("string") for a in FEATURES for b in FEATURES]
    sums = rows.groupBy("unit", "start").agg(
        F.count("*").alias("n"), F.array(*[F.sum(name).cast("string") for name in FEATURES]).alias("firsts"), F.array(*products).alias("seconds")
    )
    return tables.written(sums.mapInPandas(_inverted, "unit string, start int, mean array<double>, inverse array<double>, size double"))


def _started(rows: DataFrame) -> DataFrame:
    """Medians, and spreads from medians of deviations; counted by value, as the values are integers in a small range."""

    def medians(values: DataFrame) -> DataFrame:
        counts = values.groupBy("unit", "feature", "x").agg(F.count("*").alias("n"))
        upto = Window.partitionBy("unit", "feature").orderBy("x")
        whole = Window.partitionBy("unit", "feature")
        ranked = counts.select("unit", "feature", "x", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("all"))
        return ranked.where("2 * upto >= all").groupBy("unit", "feature").agg(F.min("x").alias("median"))

    each = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(name).alias("x")) for i, name in enumerate(FEATURES)]))
    long = rows.select("unit", each.alias("at")).select("unit", "at.feature", "at.x")
    middle = tables.written(medians(long))
    spread = medians(long.join(middle, ["unit", "feature"]).select("unit", "feature", F.abs(F.col("x") - F.col("median")).alias("x")))
    both = middle.join(spread.withColumnRenamed("median", "spread"), ["unit", "feature"])
    floor = F.get(F.array(*[F.lit(x * UNIT) for x in LEAST_SPREAD]), "feature")
    variance = F.pow(F.col("spread") * 1.4826, F.lit(2)) + floor * floor
    gathered = both.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("feature", F.col("median").cast("double").alias("m"), variance.alias("v")))).alias("by"))
    p = len(FEATURES)
    inverse = F.array(*[1 / F.get("by.v", F.lit(i)) if i == j else F.lit(0.0) for i in range(p) for j in range(p)])
    return tables.written(gathered.select("unit", F.lit(0).alias("start"), F.col("by.m").alias("mean"), inverse.alias("inverse"), F.lit(0.0).alias("size")))


def _distance() -> Column:
    p = len(FEATURES)
    off = [F.col(name) - F.get("mean", F.lit(i)) for i, name in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(p):
            total = total + off[i] * off[j] * F.get("inverse", F.lit(i * p + j))
    return F.round(total, 6)


def _bin() -> Column:
    return F.least(F.floor(F.log1p(F.greatest(F.col("distance"), F.lit(0.0))) * _BINS_PER_E), F.lit(_LAST_BIN)).cast("int")


def estimate(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """``(unit, mean, inverse)`` for rows with a unit and the features; the covariance is that of the chosen rows, not scaled."""
    params = _started(rows).unionByName(_estimated(rows.withColumn("start", F.lit(1))))
    before, key = None, ["unit", "start"]
    for _ in range(steps):
        scored = rows.join(params, "unit").withColumn("distance", _distance()).withColumn("bin", _bin())
        counts = scored.groupBy(*key, "bin").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*key).orderBy("bin"))
        need = F.ceil(F.sum("n").over(Window.partitionBy(*key)) * share)
        cut = tables.written(counts.select(*key, "bin", upto.alias("upto"), need.alias("need")).where("upto >= need").groupBy(*key).agg(F.min("bin").alias("cut")))
        chosen = scored.drop("mean", "inverse", "size").join(cut, key).where("bin <= cut")
        params = _estimated(chosen)
        state = params.agg(F.sum(F.xxhash64(*key, "mean", "inverse").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return tables.written(params.groupBy("unit").agg(F.min(F.struct("size", "start", "mean", "inverse")).alias("best")).select("unit", "best.mean", "best.inverse"))


def apply_quality_rules(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
    share: float = SHARE, cutoff: float = CUTOFF, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Per row: the id, the statistics, ``base_failed``, ``kept`` and ``distance`` (squared; null where ``base_failed``)."""
    base = docs.select(
        tables.exactly(docs, id_column).alias("doc_id"), tables.exactly(docs, text_column).alias("text"),
        F.coalesce(tables.exactly(docs, lang_column).cast("string"), F.lit("")).alias("lang"), F.coalesce(tables.exactly(docs, source_column).cast("string"), F.lit("")).alias("source"),
    )
    made = scans.with_columns(base, statistics, STATISTICS, keep=["lang", "source"])
    failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    made = tables.written(made.withColumn("base_failed", failed).select("*", *_features()))
    passed = made.where(~F.col("base_failed"))
    units = tables.written(_units(passed, min_rows))
    rows = passed.join(units.drop("unit"), ["lang", "source"]).select(F.explode("units").alias("unit"), *FEATURES)
    params = estimate(rows, share)
    found = made.join(units.drop("units"), ["lang", "source"], "left").join(params, "unit", "left")
    distance = F.when(~F.col("base_failed"), _distance())
    kept = ~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))
    return found.select(F.col("doc_id").alias(id_column), *STATISTICS.names[:5], "base_failed", kept.alias("kept"), distance.alias("distance"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = apply_quality_rules(tables.table(spark, folder, "documents", "doc_id", "text", "lang", "source"))
    return found.select("doc_id", *STATISTICS.names[:5], "base_failed", "kept", "distance")
