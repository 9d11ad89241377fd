"""Best-fit packing with certified bounds: token sequences of a fixed capacity, as few as the bounds allow.

Texts become token ids in one scan that keeps only the numbers of each piece: length, place, checksum. Packing then
works on pieces alone:

1. *Pack.* Pieces are dealt to partitions of about ``PIECES`` rows; each is packed best-fit decreasing.
2. *Certify.* Dual feasible functions give a lower bound of each partition's bins. A partition that meets its bound
   is final but for its emptiest bin, which a bound per partition rounds up to. So is every full bin of the others.
3. *Exchange.* The pieces of the remaining bins go to new partitions, formed across the old ones and twice as large,
   and are packed again, until no gap remains, no bin is saved, or after ``ROUNDS`` rounds. All remaining bins then
   stay as they are.

Every round reads only what the last left open. A partition has at most ``PIECES * 2 ** (ROUNDS - 1)`` pieces of six
numbers, whatever the input, so no task grows with the data.

Only texts longer than the capacity are cut: into pieces of full length, the first one shorter where it does not
divide. Every document ends with ``end_id``. Special tokens' strings in a text are the special tokens, as the tokenizer file has them.

Defined cases: a null or empty text is one piece with the end token only. Repeated rows and ids are packed one by one.
"""

from __future__ import annotations

import base64
import bisect
import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import tables
from corpusloom.llm.bytewords import text_slices

CAPACITY = 2048
END_ID = 0
PIECES = 20_000
ROUNDS = 4
RANKS = "byte_bpe_50k.tiktoken"  # the ids of the tokenizer file; a test holds both equal
TOKENIZER = "byte_bpe_50k.json"

#: A run of blanks and the run of other characters after it; the tokenizer's pattern never joins two of these.
_STRETCH = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Blanks beyond ASCII and separators can join with blanks on both sides; such texts are encoded whole.
_OTHER_BLANK = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_HELD_STRETCHES = 400_000

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
_PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PLACED = T.StructType([*PIECE.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("open", T.BooleanType()), T.StructField("gap", T.LongType())])


class _Encoder:
    """Ids of whole texts as little-endian bytes; ids of frequent stretches are kept."""

    def __init__(self, path: str, pattern: str, tokenizer_path: str):
        import tiktoken

        with open(tokenizer_path, encoding="utf-8") as described:
            added = json.load(described)["added_tokens"]
        if any(token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"] for token in added):
            raise ValueError("special tokens that take in their surroundings are not supported")
        # Texts are cut at special tokens first, the longest one at a place.
        self.special_ids = {token["content"]: np.array([token["id"]], dtype="<u4").tobytes() for token in added}
        self.special = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special_ids, key=len, reverse=True)) + ")") if added else None

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.opens[[number for token, number in ranks.items() if token.startswith(b" ")]] = True
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        if self.special and self.special.search(text):
            return b"".join(self.special_ids.get(part) or self._plain(part) for part in self.special.split(text) if part)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def _learn(self, stretches: set[str]) -> None:
        """Encode many stretches in one call where each is one blank and a word: the blank begins each one's ids."""
        if len(self.known) + len(stretches) > _HELD_STRETCHES:
            self.known.clear()
        plain = [s for s in stretches if s[0] == " " and len(s) > 1 and s[1] not in " \t\n\r\x0b\x0c"]
        ids = np.array(self.encoding.encode_ordinary("".join(plain)), dtype="<u4")
        cuts = np.flatnonzero(self.opens[ids])
        if len(cuts) == len(plain):
            ends = np.append(cuts, len(ids))[1:].tolist()
            held = ids.tobytes()
            self.known.update(zip(plain, [held[4 * a : 4 * b] for a, b in zip(cuts.tolist(), ends, strict=True)], strict=True))
        for s in stretches:
            if s not in self.known:
                self.known[s] = self._whole(s)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [None if _OTHER_BLANK.search(text) or (self.special and self.special.search(text)) else _STRETCH.findall(text) for text in texts]
        fresh = {s for own in split if own for s in own}
        missing = fresh.difference(self.known)
        if len(self.known) + len(missing) > _HELD_STRETCHES:
            missing = fresh
        if missing:
            self._learn(missing)
        for text, own in zip(texts, split, strict=True):
            yield self._whole(text) if own is None else b"".join(map(self.known.__getitem__, own))


_ENCODERS: dict[tuple[str, str, str], _Encoder] = {}


def token_pieces(docs: DataFrame, id_column: str, text_column: str, capacity: int, end_id: int, encoder_key: tuple[str, str, str]) -> DataFrame:
    """One row per piece; the scan of the texts, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(encoder_key) or _ENCODERS.setdefault(encoder_key, _Encoder(*encoder_key))
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for rows in text_slices(batch, "text"):
                out = []
                for number, ids in zip(rows.column("id").to_pylist(), encoder.encode([t or "" for t in rows.column("text").to_pylist()]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    first = n - capacity * ((n - 1) // capacity)
                    cuts = [0, *range(first, n + 1, capacity)]
                    out += [(number, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PIECE_ARROW, strict=True)], schema=_PIECE_ARROW)

    base = docs.select(tables.exactly(docs, id_column).cast("long").alias("id"), tables.exactly(docs, text_column).alias("text"))
    return base.mapInArrow(run, PIECE)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual feasible functions over all their parameters.

    For a threshold k up to half the capacity: lengths over ``capacity - k`` count whole, those under k nothing, others
    themselves. For a divisor k: a length x counts ``floor((k + 1) x / capacity)`` of k, or itself where that is whole.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * size).sum()) // capacity)
    many, total = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(counts * size)))
    for k in range(1, capacity // 2 + 1):
        whole = many[-1] - many[capacity - k + 1]
        middle = total[capacity - k + 1] - total[k]
        best = max(best, int(-(-(whole * capacity + middle) // capacity)))
    for k in range(1, 101):
        share = (k + 1) * size
        value = np.where(share % capacity == 0, size * k, (share // capacity) * capacity)
        best = max(best, int(-(-int((counts * value).sum()) // (capacity * k))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """A bin number for each length."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.zeros(len(lengths), dtype=np.int64)
    rooms: list[int] = []  # distinct free sizes, ascending
    having: dict[int, list[int]] = {}
    made = 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        at = bisect.bisect_left(rooms, length)
        if at == len(rooms):
            number, room = made, capacity
            made += 1
        else:
            room = rooms[at]
            number = having[room].pop()
            if not having[room]:
                rooms.pop(at)
        bins[i] = number
        rest = room - length
        if rest:
            held = having.setdefault(rest, [])
            if not held:
                bisect.insort(rooms, rest)
            held.append(number)
    return bins


def _packer(capacity: int, round_number: int):
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        order = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = order.column("length").to_numpy()
        bins = best_fit_decreasing(lengths, capacity)
        n = int(bins.max()) + 1
        gap = n - lower_bound(lengths, capacity)
        filled = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[by_bin])
        offset = np.empty(len(lengths), dtype=np.int64)
        offset[by_bin] = ends - lengths[by_bin] - np.repeat(np.cumsum(filled) - filled, np.bincount(bins, minlength=n))
        sequence = (round_number << 56) + (key[0].as_py() << 24) + bins
        open_bins = filled < capacity if gap else filled < min(capacity, filled.min() + 1)
        left = open_bins[bins]
        return pa.table([*order.select(PIECE.names).columns, pa.array(sequence), pa.array(offset), pa.array(left), pa.array(np.full(len(bins), gap))], names=_PLACED.names)

    return pack


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, pieces_per_partition: int = PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``sequence_id``, ``offset`` and ``gap`` for every piece of a written table; ``length`` must be 1 to ``capacity``."""
    done, rest, before = [], pieces, None
    for number in range(rounds):
        n = rest.count()
        groups = max(1, math.ceil(n / (pieces_per_partition << number)))
        order = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(number))
        # Equal rows must not meet in one partition: a group of copies is dealt like other rows.
        dealt = rest.withColumn("deal", F.pmod(order + F.monotonically_increasing_id(), F.lit(groups)))
        placed = tables.written(dealt.groupBy("deal").applyInArrow(_packer(capacity, number), _PLACED))
        open_bins = placed.where("open").agg(F.count_distinct("sequence_id")).first()[0]
        if number + 1 == rounds or not open_bins or groups == 1 or (before is not None and open_bins >= before):
            return _union([*done, placed])
        done.append(placed.where(~F.col("open")))
        rest, before = placed.where("open").select(*PIECE.names), open_bins
    return _union(done)


def _union(tables_: list[DataFrame]) -> DataFrame:
    out = tables_[0]
    for one in tables_[1:]:
        out = out.unionByName(one)
    # A full bin, and every bin of a partition that meets its bound, is certified.
    gap = F.when(F.col("open"), F.col("gap")).otherwise(F.lit(0)).cast("long").alias("gap")
    return out.select(*PIECE.names, "sequence_id", "offset", gap)


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    ranks_path: str | None = None,
    pattern: str | None = None,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` and ``gap``.

    ``gap`` is 0 for pieces in sequences that are certified; for others it says by how many bins at most the partition that
    they were last packed in exceeds the fewest possible.

    ``ranks_path`` and ``tokenizer_path`` name the ranks and the tokenizer file of one vocabulary, which every executor has;
    without them the public ones are used.
    """
    if ranks_path is None or pattern is None or tokenizer_path is None:
        import public_tokenizers

        ranks_path, pattern = ranks_path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
        tokenizer_path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    pieces = tables.written(token_pieces(docs, id_column, text_column, capacity, end_id, (ranks_path, pattern, tokenizer_path)))
    return pack_pieces(pieces, capacity)


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(tables.table(spark, folder, "documents", "doc_id", "text"))
