"""Quality classifier by co-training: one classifier reads the text, one the page metadata, and each teaches the other.

Both are logistic regressions over hashed features: the text view has the words of a text and the classes of its
statistics (symbols, capitals, repeated words, word length), the metadata view language, source and length class.
Each round, a view's confident guesses on unlabelled texts become labels of the other view. At the end each view is
calibrated on labelled texts that neither has seen, and a regression over both gives the score of every document.

Training uses at most ``LABELLED`` labelled and ``UNLABELLED`` other documents, chosen by a hash of the id; they are
documented bounds, the driver holds their feature numbers only. Scoring is one scan over all documents.

A document is good if its quality is 1 and it is not toxic; ``kept`` is a score of at least ``KEEP_FROM``.

Defined cases: without labels of both classes nothing can be learnt: every score is the share of good labels (1 without
labels) and everything is kept. Null texts are empty, null metadata is a value of its own. Repeated labels of one id
count as the worst of them. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import scans, tables
from corpusloom.llm.bytewords import ALPHANUMERIC, string_bytes, words_of

SLOTS = 1 << 18
LABELLED = 20_000
UNLABELLED = 10_000
ROUNDS = 3
CONFIDENT = 0.98
KEEP_FROM = 0.5
#: Standard errors by which a feature's shares must differ; chance passes one feature in ten thousand.
TELLING = 4.0
_HELD_OUT = 5  # every fifth labelled document calibrates
_PAIRS = {"upper": bytes(range(0x41, 0x5B)), "symbol": b"#*$%&<>@^~=+_\\{}[]", "stop": b"!?", "bar": b"|", "digit": bytes(range(0x30, 0x3A)), "line": b"\n"}
_KINDS = []
for _members in _PAIRS.values():
    _flags = np.zeros(256, dtype=np.int64)
    _flags[list(_members)] = 1
    _KINDS.append(_flags)


def _classes(shares: np.ndarray) -> np.ndarray:
    """A share's class on a logarithmic scale, 0 for none."""
    return np.where(shares > 0, np.clip(np.round(14 + 1.5 * np.log2(np.maximum(shares, 1e-9))), 1, 40), 0).astype(np.int64)


def text_view(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each text, each once, and where each text's begin."""
    n = rows.num_rows
    words = words_of(rows.column("text"), ALPHANUMERIC, lower=True)
    owner = words.rows()
    slots = (words.hashes() % np.uint64(SLOTS)).astype(np.int64)
    pairs = np.unique(owner * SLOTS + slots)
    distinct = np.bincount(pairs // SLOTS, minlength=n)
    data, texts = string_bytes(rows.column("text"))
    size = np.maximum(np.diff(texts), 1)
    count = np.maximum(words.counts, 1)
    shares = []
    for flags in _KINDS:
        sums = np.concatenate(([0], np.cumsum(flags[data])))
        shares.append((sums[texts[1:]] - sums[texts[:-1]]) / size)
    shares.append(distinct / count)
    shares.append(np.bincount(owner, weights=words.end - words.start, minlength=n) / count / 64)
    shares.append(np.bincount(owner[1:], weights=(slots[1:] == slots[:-1]) & (owner[1:] == owner[:-1]), minlength=n)[:n] / count if len(owner) else np.zeros(n))
    statistics = np.array([np.arange(n) * SLOTS + (SLOTS - 1 - 64 * (i + 1) + _classes(x)) for i, x in enumerate(shares)]).reshape(-1)
    every = np.unique(np.concatenate([pairs, statistics.astype(np.int64)]))
    return every % SLOTS, np.searchsorted(every // SLOTS, np.arange(n + 1))


def page_view(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    n = rows.num_rows
    made = []
    size = ["none" if x is None else str(int(x).bit_length()) for x in rows.column("page_size").to_pylist()]
    lang, source = ([repr(x) for x in rows.column(name).to_pylist()] for name in ("page_lang", "page_source"))
    for name, values in (("lang", lang), ("source", source), ("size", size), ("both", [a + b for a, b in zip(lang, source, strict=True)])):
        made.append(words_hash([f"{name}={value}" for value in values]))
    return np.array(made).T.reshape(-1), np.arange(n + 1) * len(made)


def words_hash(values: list[str]) -> np.ndarray:
    everything = words_of(pa.array(values, pa.string()), np.ones(256, dtype=bool))
    return (everything.hashes() % np.uint64(SLOTS)).astype(np.int64)


@dataclass
class View:
    """Feature numbers of the training documents, as rows of different length."""

    slots: np.ndarray
    of: np.ndarray

    @classmethod
    def joined(cls, packed: list[bytes]) -> View:
        parts = [np.frombuffer(x, dtype=np.int32) for x in packed]
        return cls(np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, dtype=np.int64), np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64))

    def logits(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(weights[self.slots])))
        return sums[self.of[1:]] - sums[self.of[:-1]] + weights[SLOTS]

    def _telling(self, rows: np.ndarray, good: np.ndarray) -> np.ndarray:
        """Features whose share among good rows differs from that among bad ones by more than chance would give."""
        of = np.concatenate([self.slots[self.of[i] : self.of[i + 1]] for i in rows])
        owner = np.repeat(good, self.of[rows + 1] - self.of[rows])
        in_good, in_bad = (np.bincount(of[owner == kind], minlength=SLOTS + 1) for kind in (1, 0))
        n_good, n_bad = max(1, int((good == 1).sum())), max(1, int((good == 0).sum()))
        pooled = (in_good + in_bad + 1) / (n_good + n_bad + 2)
        apart = np.abs(in_good / n_good - in_bad / n_bad) / np.sqrt(pooled * (1 - pooled) * (1 / n_good + 1 / n_bad))
        return (apart >= TELLING) & (in_good + in_bad >= 5)

    def fitted(self, rows: np.ndarray, good: np.ndarray, passes: int = 15, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
        """Weights by adaptive gradient steps over batches, of the features that tell the classes apart."""
        weights, squares = np.zeros(SLOTS + 1), np.full(SLOTS + 1, 1e-4)
        rng = np.random.default_rng(11)
        usable = self._telling(rows, good)
        usable[SLOTS] = True
        share = good.mean()
        cost = np.where(good > 0, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
        for _ in range(passes):
            for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 200)):
                chosen = rows[batch]
                slots = np.concatenate([self.slots[self.of[i] : self.of[i + 1]] for i in chosen])
                owner = np.repeat(np.arange(len(chosen)), self.of[chosen + 1] - self.of[chosen])
                scale = 1 / np.sqrt(np.maximum(1, self.of[chosen + 1] - self.of[chosen]) / 50)
                z = np.bincount(owner, weights=weights[slots], minlength=len(chosen)) + weights[SLOTS]
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good[batch]) * cost[batch]
                step = np.bincount(slots, weights=(error * scale)[owner], minlength=SLOTS + 1)
                step[SLOTS] = error.sum()
                touched = np.flatnonzero((step != 0) & usable)
                gradient = step[touched] / len(chosen) + decay * weights[touched]
                squares[touched] += gradient**2
                weights[touched] -= rate * gradient / np.sqrt(squares[touched])
        return weights


def _regression(columns: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Logistic regression with a small penalty by Newton steps; the last weight is the constant."""
    x = np.column_stack([columns, np.ones(len(columns))])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - good) + 1e-2 * weights
        curve = (x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(len(weights))
        weights -= np.linalg.solve(curve, slope)
    return weights


@dataclass
class Model:
    text: np.ndarray
    page: np.ndarray
    combined: np.ndarray
    calibrated: tuple[np.ndarray, np.ndarray]

    def scores(self, text: np.ndarray, page: np.ndarray) -> list[np.ndarray]:
        def chance(weights, *columns):
            return np.round(1 / (1 + np.exp(-np.clip(np.column_stack([*columns, np.ones(len(columns[0]))]) @ weights, -30, 30))), 6)

        return [chance(self.calibrated[0], text), chance(self.calibrated[1], page), chance(self.combined, text, page)]


def co_train(text: View, page: View, good: np.ndarray, rounds: int = ROUNDS, confident: float = CONFIDENT) -> Model:
    """``good`` is 1, 0 or -1 (not labelled) for each document of the views."""
    labelled, others = np.flatnonzero(good >= 0), np.flatnonzero(good < 0)
    held = labelled[np.arange(len(labelled)) % _HELD_OUT == 0]
    own = labelled[np.arange(len(labelled)) % _HELD_OUT != 0]
    if len(set(good[own])) < 2 or len(set(good[held])) < 2:
        held = own = labelled
    views, taught = (text, page), [(np.zeros(0, dtype=np.int64), np.zeros(0))] * 2
    weights = [np.zeros(SLOTS + 1)] * 2
    for number in range(rounds + 1):
        for v in (0, 1):
            rows, guess = taught[v]
            weights[v] = views[v].fitted(np.concatenate([own, rows]), np.concatenate([good[own].astype(float), guess]))
        if number == rounds or not len(others):
            break
        guesses = []
        for v in (0, 1):
            logits = views[v].logits(weights[v])
            scale = _regression(logits[held][:, None], good[held])
            chance = 1 / (1 + np.exp(-np.clip(logits[others] * scale[0] + scale[1], -30, 30)))
            sure = (chance >= confident) | (chance <= 1 - confident)
            guesses.append((others[sure], (chance[sure] >= 0.5).astype(float)))
        taught = guesses[::-1]
    logits = [view.logits(w)[held] for view, w in zip(views, weights, strict=True)]
    calibrated = tuple(_regression(z[:, None], good[held]) for z in logits)
    return Model(*weights, _regression(np.column_stack(logits), good[held]), calibrated)


_PACKED = T.StructType([T.StructField("text_features", T.BinaryType()), T.StructField("page_features", T.BinaryType())])
SCORES = T.StructType([T.StructField(name, T.DoubleType()) for name in ("text_score", "page_score", "score")])


def _as_batch(rows: pa.RecordBatch) -> pa.RecordBatch:
    fields = pc.struct_field
    carried = rows.column("carried")
    return pa.RecordBatch.from_arrays([rows.column("text"), *[fields(carried, f"c{i}") for i in range(3)]], names=["text", "page_lang", "page_source", "page_size"])


def _packed(rows: pa.RecordBatch) -> list:
    out = []
    for slots, of in (text_view(_as_batch(rows)), page_view(_as_batch(rows))):
        small = slots.astype(np.int32)
        out.append([small[a:b].tobytes() for a, b in zip(of[:-1], of[1:], strict=True)])
    return out


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> Model | float:
    """A model, or the share of good labels where nothing can be learnt. Columns as :func:`classify` prepares them."""
    known = labels.groupBy("doc_id").agg((F.min("quality") * (1 - F.max("toxic"))).alias("good")).where("doc_id IS NOT NULL AND good IS NOT NULL")
    # A bounded number of ids, the smallest hashes: every task keeps that many at most.
    some = known.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(labelled)
    others = docs.select("doc_id").where("doc_id IS NOT NULL").join(known, "doc_id", "left_anti").distinct()
    others = others.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(unlabelled)
    chosen = tables.written(some.unionByName(others.withColumn("good", F.lit(-1))))
    rows = docs.join(chosen, "doc_id").dropDuplicates(["doc_id"])
    view = scans.with_columns(rows, _packed, _PACKED, keep=["page_lang", "page_source", "page_size", "good"])
    held = sorted(view.select("doc_id", "good", "text_features", "page_features").toLocalIterator(), key=lambda r: r.doc_id)
    good = np.array([r.good for r in held], dtype=np.int64)
    if len(set(good[good >= 0])) < 2:
        return float(good[good >= 0].mean()) if (good >= 0).any() else 1.0
    return co_train(View.joined([r.text_features for r in held]), View.joined([r.page_features for r in held]), good)


def classify(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
    size_column: str = "n_chars", keep: Sequence[str] = (), keep_from: float = KEEP_FROM, **bounds: int,
) -> DataFrame:
    """Per row: the id, the ``keep`` columns, ``text_score``, ``page_score``, ``score`` and ``kept``."""
    own = {id_column, *SCORES.names, "kept"}
    others = [name for name in keep if name not in own and name != text_column]
    base = docs.select(
        tables.exactly(docs, id_column).cast("long").alias("doc_id"), tables.exactly(docs, text_column).alias("text"), tables.exactly(docs, lang_column).cast("string").alias("page_lang"),
        tables.exactly(docs, source_column).cast("string").alias("page_source"), tables.exactly(docs, size_column).cast("long").alias("page_size"), tables.carried(docs, others),
    )
    model = train(base.drop("carried"), labels.select("doc_id", "quality", "toxic"), **bounds)
    back = dict(zip(others, tables.released(others), strict=True)) | {text_column: F.col("text").alias(text_column)}
    kept = [back[name] for name in keep if name in back and name not in own]
    if isinstance(model, float):
        scores = [F.lit(model).alias(name) for name in SCORES.names]
        return base.select(F.col("doc_id").alias(id_column), *kept, *scores, F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(rows: pa.RecordBatch) -> list:
        given, own_model = _as_batch(rows), shared.value
        text = View(*text_view(given)).logits(own_model.text)
        page = View(*page_view(given)).logits(own_model.page)
        return [pa.array(x) for x in own_model.scores(text, page)]

    scored = scans.with_columns(base, compute, SCORES, keep=["page_lang", "page_source", "page_size", "carried", "text"])
    return scored.select(F.col("doc_id").alias(id_column), *kept, *SCORES.names, (F.col("score") >= keep_from).alias("kept"))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.table(spark, folder, "documents", "doc_id", "text", "lang", "source", "n_chars")
    return classify(docs, tables.table(spark, folder, "labels", "doc_id", "quality", "toxic"))
