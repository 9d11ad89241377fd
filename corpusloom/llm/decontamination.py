"""Benchmark decontamination by suffix arrays of the training texts.

Every run of texts is a shard. A shard sorts those of its suffixes that begin with a pair of neighbouring words of
the benchmark (no other suffix can match) into a suffix array, ordered by word numbers up to the window's length.
Every window that starts a test suffix is then found by two binary searches, which give all its places; runs of
places on one diagonal join to the longest verbatim matches. The scan does not shuffle, and nothing depends on how
often a passage occurs.

The benchmark is read by every task, so it goes in blocks of ``BLOCK_BYTES`` of text: each block is one pass over the
texts. Results of several blocks meet by id and text digest.

Defined cases: null or blank texts have no words and are clean. Items without words match nothing, items shorter
than the window are one window of their own length. Items of equal id count once; a null item id reads as ''.
Repeated rows each get their result. In ``matches`` a window that an item repeats counts at its first place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import scans, tables
from corpusloom.llm.bytewords import ALPHANUMERIC, Words, words_of

WINDOW = 10
BLOCK_BYTES = 8 << 20
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
_MATCH = T.StructType(
    [T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(_SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("matches", T.ArrayType(_MATCH)),
    ]
)
_SIEVE = 1 << 20


class _Tests:
    """A block of items: its vocabulary, and the distinct windows as sort keys with the items that have them."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        words = words_of(pa.array([text for _, text in items], pa.string()), ALPHANUMERIC, lower=True)
        hashes = words.hashes()
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        numbers = numbers.astype(np.int64) + 1
        self.sieve = np.zeros(_SIEVE, dtype=bool)
        self.sieve[self.vocabulary % np.uint64(_SIEVE)] = True
        base = len(self.vocabulary) + 1
        patterns: dict[tuple, dict[int, int]] = {}
        pairs, singles = set(), set()
        for i, (name, _) in enumerate(items):
            own = numbers[words.of[i] : words.of[i + 1]].tolist()
            length = min(window, len(own))
            for start in range(len(own) - length + 1 if own else 0):
                pattern = tuple(own[start : start + length])
                patterns.setdefault(pattern, {}).setdefault(place[name], start)
                if length > 1:
                    pairs.add(pattern[0] * base + pattern[1])
                else:
                    singles.add(pattern[0])
        self.lengths = np.array([len(p) for p in patterns], dtype=np.int64)
        self.owners = [np.array(sorted(p.items()), dtype=np.int64) for p in patterns.values()]
        self.owner_counts = np.array([len(x) for x in self.owners], dtype=np.int64)
        self.owner_rows = np.concatenate(self.owners) if self.owners else np.zeros((0, 2), dtype=np.int64)
        self.owner_of = np.concatenate(([0], np.cumsum(self.owner_counts)))
        self.pairs, self.singles, self.base = np.array(sorted(pairs), dtype=np.int64), np.array(sorted(singles), dtype=np.int64), base
        low = np.zeros((len(patterns), window), dtype=">u4")
        high = np.full((len(patterns), window), 0xFFFFFFFF, dtype=">u4")
        for i, pattern in enumerate(patterns):
            low[i, : len(pattern)] = high[i, : len(pattern)] = pattern
        self.low, self.high = _sort_keys(low), _sort_keys(high)

    def numbers(self, words: Words) -> np.ndarray:
        """Word numbers of the vocabulary, 0 for other words."""
        hashes = words.hashes()
        out = np.zeros(len(hashes), dtype=np.int64)
        likely = np.flatnonzero(self.sieve[hashes % np.uint64(_SIEVE)])
        if len(likely):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[likely]), len(self.vocabulary) - 1)
            out[likely] = np.where(self.vocabulary[at] == hashes[likely], at + 1, 0)
        return out


def _sort_keys(matrix: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like them."""
    return np.ascontiguousarray(matrix).view(f"S{4 * matrix.shape[1]}").reshape(-1)


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def _suffix_array(tests: _Tests, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes that can match, in the order of their words, and their sort keys."""
    numbers, left = tests.numbers(words), words.left()
    follows = np.append(numbers[1:], 0)
    known = np.flatnonzero(numbers)
    begins = (left[known] > 1) & _among(numbers[known] * tests.base + follows[known], tests.pairs)
    places = known[begins | _among(numbers[known], tests.singles)]
    keys = np.zeros((len(places), tests.window), dtype=">u4")
    for k in range(tests.window):
        inside = left[places] > k
        keys[inside, k] = numbers[places[inside] + k]
    keys = _sort_keys(keys)
    order = np.argsort(keys, kind="stable")
    return places[order], keys[order]


def _expanded(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that stand for ``counts`` further ones: the row of each, and its number there."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """Values as one list per row; ``rows`` is in order."""
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _search(tests: _Tests, rows: pa.RecordBatch) -> list:
    words = words_of(rows.column("text"), ALPHANUMERIC, lower=True)
    n = rows.num_rows
    array, keys = _suffix_array(tests, words)
    first, last = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
    pattern, number = _expanded(last - first)
    place, length = array[first[pattern] + number], tests.lengths[pattern]
    text = np.searchsorted(words.of, place, side="right") - 1

    change = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + length, -1)
    hit = np.cumsum(change)[:-1] > 0
    home = words.rows()
    before = np.concatenate(([False], hit[:-1] & (home[1:] == home[:-1]))) if len(hit) else hit
    after = np.concatenate((hit[1:] & (home[1:] == home[:-1]), [False])) if len(hit) else hit
    starts, stops = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
    where = home[starts]
    spans = pa.StructArray.from_arrays([pa.array(starts - words.of[where]), pa.array(stops - words.of[where])], ["start", "stop"])

    owner, nth = _expanded(tests.owner_counts[pattern])
    item, begin = tests.owner_rows[tests.owner_of[pattern[owner]] + nth].T if len(owner) else (np.zeros(0, dtype=np.int64),) * 2
    of_text, at = text[owner], place[owner]
    order = np.lexsort((at, at - begin, item, of_text))
    of_text, at, item, begin, size = of_text[order], at[order], item[order], begin[order], length[owner][order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (of_text[1:] != of_text[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (begin[1:] != begin[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head, len(at))[1:] - 1
    names = pa.array(tests.names, pa.string())
    matches = pa.StructArray.from_arrays(
        [names.take(pa.array(item[head])), pa.array(begin[head]), pa.array(at[head] - words.of[of_text[head]]), pa.array(at[tail] - at[head] + size[tail])],
        ["item_id", "item_start", "start", "length"],
    )
    both = np.unique(of_text * max(1, len(tests.names)) + item)
    listed, kind = np.divmod(both, max(1, len(tests.names)))
    return [pa.array(words.counts), _lists(where, n, spans), _lists(listed, n, names.take(pa.array(kind))), _lists(of_text[head], n, matches)]


def _searcher(items: Broadcast, window: int):
    held: list[_Tests] = []

    def search(rows: pa.RecordBatch) -> list:
        if not held:
            held.append(_Tests(items.value, window))
        return _search(held[0], rows)

    return search


def _n_hit(spans):
    """Words in the union of spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(state, span):
        fresh = F.greatest(span["stop"], state["end"]) - F.greatest(span["start"], state["end"])
        return F.struct((state["n"] + F.greatest(fresh, F.lit(0))).alias("n"), F.greatest(span["stop"], state["end"]).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda state: state["n"])


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    keep: Sequence[str] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per text: ``n_words``, ``n_hit``, ``items`` (ids, sorted), ``matches``, ``contaminated`` and the ``keep`` columns."""
    spark = docs.sparkSession
    tests = items.select(
        F.coalesce(tables.exactly(items, item_id_column).cast("string"), F.lit("")).alias("name"),
        F.coalesce(tables.exactly(items, item_text_column), F.lit("")).alias("text"),
    )
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    passes = []
    for block in range(blocks):
        of_block = tests.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast([(r.name, r.text) for r in of_block.select(F.col("name").alias("name"), "text").toLocalIterator()])
        passes.append((block, _searcher(shared, window)))
    if blocks == 1:
        found = scans.with_columns(docs, passes[0][1], FOUND, id_column, text_column, keep)
    else:
        found = _merged(docs, passes, id_column, text_column, keep)
    n_hit = _n_hit(F.col("spans"))
    outputs = ["n_words", "spans", "items", "matches", "n_hit", "contaminated"]
    kept = [name for name in found.columns if name not in outputs]
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", F.col("n_hit") > 0).select(
        *kept, "n_words", "n_hit", F.array_sort("items").alias("items"), "matches", "contaminated"
    )


def _merged(docs, passes, id_column, text_column, keep) -> DataFrame:
    """Results of several blocks: one written table per pass, met by id and digest, then joined to the rows."""
    names = [name for name in keep if name not in {id_column, *FOUND.names}]
    text = tables.exactly(docs, text_column)
    base = docs.select(tables.exactly(docs, id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"), tables.carried(docs, names))
    parts = None
    for _, search in passes:
        one = tables.written(scans.with_columns(base.select("id", "text", "digest"), search, FOUND, "id", "text", ["digest"]).dropDuplicates(["id", "digest"]))
        parts = one if parts is None else parts.unionByName(one)
    total = parts.groupBy(F.col("id").alias("of_id"), F.col("digest").alias("of_digest")).agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.flatten(F.collect_list("matches")).alias("matches"),
    )
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest"))
    joined = base.select("id", "digest", "carried").join(total, same, "left")
    return joined.select(F.col("id").alias(id_column), *tables.released(names), *FOUND.names)


def decontaminate(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without the texts that hold a benchmark window, in the columns of ``docs``."""
    others = [name for name in docs.columns if name not in (id_column, text_column)]
    base = docs.select(tables.exactly(docs, id_column).alias("own_id"), tables.exactly(docs, text_column).alias("own_text"), tables.carried(docs, others))
    found = find_contamination(base, items, "own_id", "own_text", keep=["own_text", "carried"], **options)
    back = {id_column: F.col("own_id").alias(id_column), text_column: F.col("own_text").alias(text_column)}
    back |= dict(zip(others, tables.released(others), strict=True))
    return found.where(~F.col("contaminated")).select(*[back[name] for name in docs.columns])


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(
        tables.table(spark, folder, "documents", "doc_id", "text"), tables.table(spark, folder, "benchmark", "item_id", "text")
    )
    listed = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), "contaminated"
    )
