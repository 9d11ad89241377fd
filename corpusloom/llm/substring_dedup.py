"""Substring dedup by fixed-block anchors.

Texts are cut into non-overlapping blocks of ``(window + 1) // 2`` words from their start; any repeat of ``window``
words holds at least one whole block of the text it repeats, whatever its own alignment. The steps:

1. *Index and probe.* Every block is an index entry, every rolling window of a block's length a probe. Chunks (texts
   dealt by a hash of their id) send each distinct probe once, as 31 bits inside a bucket, with a flag if it is a
   block there, too. A bucket answers which of them another chunk has, one of both as a block.
2. *Extend.* From each anchor that is alive, the windows of full length that hold it (up to ``window - block`` words
   to its left and right) are told by 128 bits, a fingerprint and a BLAKE2 digest of their words, and the smallest id that has
   them is found for each. Neighbouring windows join to maximal repeats.
3. *Remove.* Each text loses every word covered by a window that starts in a text with a smaller id.

What crosses the network is pre-aggregated per chunk, so a passage in a third of all texts is one entry per chunk,
never a pair. Anchors only filter; words go where both the polynomial fingerprint and the BLAKE2 digest of two windows are
equal, so texts made to collide in polynomials do not. Nothing is broadcast or collected; all pieces grow with the words and are dealt by hash.

Defined cases: a null or blank text has no words and keeps its text. Texts of equal id never remove each other's
words. A null id counts as larger than any other; rows with it do not remove each other's words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm import tables
from corpusloom.llm.bytewords import Words, covered, words_of

WINDOW = 13
CHUNKS_PER_PARTITION = 4
_NO_ID = np.iinfo(np.int64).max
_LOW = np.uint64(0x7FFFFFFF)

PACKED = T.StructType(
    [T.StructField("chunk", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("keys", T.BinaryType()), T.StructField("ids", T.BinaryType())]
)
_PACKED_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary())])


#: A window: its fingerprint, which deals it out, and the digest of its words; 128 bits of two independent kinds.
_KEY = np.dtype([("fp", "<u8"), ("digest", "<u8")])


def _packed(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACKED_ARROW, strict=True)], schema=_PACKED_ARROW)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts, and the end."""
    if not len(sorted_values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]))


def _by_key(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of window keys, and where each run of equal ones starts in it, and the end."""
    order = np.lexsort((keys["digest"], keys["fp"]))
    return order, _runs(keys[order])


class _Chunk:
    """The texts of one chunk as arrays."""

    def __init__(self, rows: pa.Table, window: int, buckets: int):
        self.window, self.block, self.buckets = window, (window + 1) // 2, buckets
        self.words: Words = words_of(rows.column("text"))
        self.ids = rows.column("id").fill_null(_NO_ID).to_numpy()
        self.hashes = self.words.hashes()

    def anchors(self) -> np.ndarray:
        """Bucket and low bits of the block-long window from each word on; 0 where there is none."""
        rolling = self.words.windows(self.hashes, self.block)
        keys = (_bucket(rolling, self.buckets) << np.uint64(32)) | ((rolling & _LOW) << np.uint64(1))
        return np.where(self.words.left() >= self.block, keys | np.uint64(1 << 63), np.uint64(0))

    def whole(self) -> np.ndarray:
        """The fingerprint of the full window from each word on; 0 where there is none."""
        found = self.words.windows(self.hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5), self.window)
        return np.where(self.words.left() >= self.window, found | np.uint64(1), np.uint64(0))

    def keys(self, whole: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The keys of the windows ``at``."""
        out = np.zeros(len(at), dtype=_KEY)
        out["fp"] = whole[at]
        out["digest"] = self.words.digests(at, self.window)
        return out

    def owners(self, at: np.ndarray) -> np.ndarray:
        """The ids of the texts that the windows ``at`` are in."""
        return np.repeat(self.ids, self.words.counts)[at]


def _probe(window: int, buckets: int):
    def probe(key: tuple, rows: pa.Table) -> pa.Table:
        chunk = _Chunk(rows, window, buckets)
        anchors = chunk.anchors()
        is_block = (chunk.words.places() % chunk.block == 0).astype(np.uint64)
        entries = np.unique((anchors | is_block)[anchors > 0])
        places = (entries >> np.uint64(32)).astype(np.uint32) & np.uint32(0x7FFFFFFF)
        low = entries.astype(np.uint32)
        cuts = _runs(places)
        number = key[0].as_py()
        return pa.Table.from_batches([_packed([(number, int(places[a]), low[a:b].tobytes(), b"") for a, b in zip(cuts[:-1], cuts[1:], strict=True)])])

    return probe


def _collected(batches: Iterator[pa.RecordBatch], kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """All packed rows of a partition: row numbers' chunk and bucket, and for each entry its row and key."""
    chunks, buckets, keys, ids = [], [], [], []
    for batch in batches:
        chunks += batch.column("chunk").to_pylist()
        buckets += batch.column("bucket").to_pylist()
        keys += [np.frombuffer(x, dtype=kind) for x in batch.column("keys").to_pylist()]
        ids += batch.column("ids").to_pylist()
    sizes = np.array([len(x) for x in keys], dtype=np.int64)
    row = np.repeat(np.arange(len(keys)), sizes)
    return np.array(chunks, dtype=np.int64), np.array(buckets, dtype=np.int64), row, np.concatenate(keys) if keys else np.zeros(0, dtype=kind), sizes, ids


def _answered(chunk: np.ndarray, bucket: np.ndarray, row: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed row per asking row; ``row`` must be in order."""
    cuts = _runs(row)
    out = [(int(chunk[row[a]]), int(bucket[row[a]]), keys[a:b].tobytes(), b"") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for at in range(0, len(out), 2000):
        yield _packed(out[at : at + 2000])


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which probes another chunk has, one of both as a block."""
    chunk, bucket, row, keys, _, _ = _collected(batches, np.uint32)
    if not len(keys):
        return
    value = (bucket[row].astype(np.uint64) << np.uint64(32)) | keys
    order = np.argsort(value, kind="stable")
    cuts = _runs(value[order] >> np.uint64(1))
    asker = chunk[row][order]
    several = np.minimum.reduceat(asker, cuts[:-1]) != np.maximum.reduceat(asker, cuts[:-1])
    blocks = np.maximum.reduceat(keys[order] & np.uint32(1), cuts[:-1]) > 0
    alive = np.sort(order[np.repeat(several & blocks, np.diff(cuts))])
    yield from _answered(chunk, bucket, row[alive], keys[alive] >> np.uint32(1))


def _extend(window: int, buckets: int):
    def extend(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_batches([_packed([])])
        chunk = _Chunk(rows, window, buckets)
        anchors = chunk.anchors()
        live = [np.zeros(0, dtype=np.uint64)]
        for place, low in zip(answers.column("bucket").to_pylist(), answers.column("keys").to_pylist(), strict=True):
            live.append((np.frombuffer(low, dtype=np.uint32).astype(np.uint64) << np.uint64(1)) | np.uint64(1 << 63 | place << 32))
        own, times = np.unique(anchors[anchors > 0], return_counts=True)
        live = np.unique(np.concatenate([*live, own[times > 1]]))
        hit = np.zeros(len(anchors), dtype=bool)
        if len(live):
            at = np.minimum(np.searchsorted(live, anchors), len(live) - 1)
            hit = live[at] == anchors
        total = np.concatenate(([0], np.cumsum(hit)))
        reach = window - chunk.block + 1
        last = np.minimum(np.arange(len(hit)) + reach, len(hit))
        whole = chunk.whole()
        candidates = np.flatnonzero((whole > 0) & (total[last] > total[:-1]))
        keys = chunk.keys(whole, candidates)
        order, starts = _by_key(keys)
        distinct = keys[order[starts[:-1]]]
        least = np.minimum.reduceat(chunk.owners(candidates)[order], starts[:-1]) if len(order) else np.zeros(0, dtype=np.int64)
        places = _bucket(distinct["fp"], buckets)
        cuts = _runs(places)
        number = key[0].as_py()
        return pa.Table.from_batches(
            [_packed([(number, int(places[a]), distinct[a:b].tobytes(), least[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])]
        )

    return extend


def _earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which windows start in another chunk in a text of smaller id."""
    chunk, bucket, row, keys, _, ids = _collected(batches, _KEY)
    if not len(keys):
        return
    least = np.frombuffer(b"".join(ids), dtype=np.int64)
    order, cuts = _by_key(keys)
    first = np.repeat(np.minimum.reduceat(least[order], cuts[:-1]), np.diff(cuts))
    later = np.sort(order[least[order] > first])
    yield from _answered(chunk, bucket, row[later], keys[later])


def _kept(words: Words, row: int, gone: np.ndarray) -> str:
    """A text without the words that ``gone`` marks: their bytes and the blanks up to the next kept word go."""
    first, last = words.of[row], words.of[row + 1]
    stays = np.flatnonzero(~gone[first:last]) + first
    if not len(stays):
        return ""
    jump = np.flatnonzero(np.diff(stays) > 1)
    begin = words.start[stays[np.concatenate(([0], jump + 1))]]
    follows = np.append(stays[jump] + 1, stays[-1] + 1)  # the word after each kept run
    end = np.where(follows < last, words.start[np.minimum(follows, len(words.start) - 1)], words.texts[row + 1])
    if not gone[first]:
        begin[0] = words.texts[row]
    return b"".join(words.data[a:b].tobytes() for a, b in zip(begin, end, strict=True)).decode()


def _remove(window: int, buckets: int, schema: pa.Schema):
    def remove(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        rows = rows.combine_chunks()
        chunk = _Chunk(rows, window, buckets)
        whole = chunk.whole()
        elsewhere = np.concatenate([np.zeros(0, dtype=_KEY), *[np.frombuffer(x, dtype=_KEY) for x in answers.column("keys").to_pylist()]])
        # Fingerprints that come twice here or are asked for from elsewhere; the digests of their windows decide.
        own, times = np.unique(whole[whole > 0], return_counts=True)
        likely = np.union1d(own[times > 1], elsewhere["fp"])
        at = np.flatnonzero((whole > 0) & np.isin(whole, likely, kind="sort"))
        keys = np.concatenate((chunk.keys(whole, at), elsewhere))
        order, runs = _by_key(keys)
        ids = np.concatenate((chunk.owners(at), np.full(len(elsewhere), np.iinfo(np.int64).min)))
        least = np.empty(len(keys), dtype=np.int64)
        if len(keys):
            least[order] = np.repeat(np.minimum.reduceat(ids[order], runs[:-1]), np.diff(runs))
        repeated = ids[: len(at)] > least[: len(at)]
        starts = np.zeros(len(whole), dtype=bool)
        starts[at[repeated]] = True
        gone = covered(starts, window)
        total = np.concatenate(([0], np.cumsum(gone)))
        removed = total[chunk.words.of[1:]] - total[chunk.words.of[:-1]]
        changed = np.flatnonzero(removed)
        text = rows.column("text").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks)
        if len(changed):
            mask = np.zeros(len(removed), dtype=bool)
            mask[changed] = True
            text = pc.replace_with_mask(text, pa.array(mask), pa.array([_kept(chunk.words, i, gone) for i in changed], text.type))
        columns = [rows.column("id"), rows.column("carried"), text, pa.array(chunk.words.counts, pa.int64()), pa.array(removed, pa.int64())]
        return pa.Table.from_arrays(columns, schema=schema)

    return remove


def substring_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, keep: Sequence[str] = ()
) -> DataFrame:
    """Remove repeats of ``window`` words or more; the text of the smallest id keeps its words.

    Returns the id, the ``keep`` columns, ``kept_text`` (blanks between kept words as they were), ``n_words`` and
    ``n_removed``. Texts are shuffled once, by a hash of their id.
    """
    if window < 1:
        raise ValueError("window must be positive")
    n = tables.parts(docs.sparkSession)
    key = tables.exactly(docs, id_column)
    dealt = docs.select(
        key.cast("long").alias("id"),
        tables.exactly(docs, text_column).alias("text"),
        tables.carried(docs, keep),
        F.pmod(F.xxhash64(key), F.lit(n * CHUNKS_PER_PARTITION)).alias("chunk"),
    ).repartition(n, "chunk")
    buckets = n
    probes = dealt.groupBy("chunk").applyInArrow(_probe(window, buckets), PACKED)
    alive = probes.repartitionById(n, F.col("bucket")).mapInArrow(_match, PACKED)
    candidates = dealt.groupBy("chunk").cogroup(alive.groupBy("chunk")).applyInArrow(_extend(window, buckets), PACKED)
    later = candidates.repartitionById(n, F.col("bucket")).mapInArrow(_earliest, PACKED)
    result = T.StructType(
        [dealt.schema["id"], dealt.schema["carried"], T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    )
    kept = dealt.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(_remove(window, buckets, to_arrow_schema(result)), result)
    outputs = {id_column, "kept_text", "n_words", "n_removed"}
    return kept.select(F.col("id").alias(id_column), *tables.released(keep, outputs), "kept_text", "n_words", "n_removed")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup(tables.table(spark, folder, "documents", "doc_id", "text"))
    joined = F.trim(F.regexp_replace(F.coalesce("kept_text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(joined, 256).alias("kept_sha256"))
