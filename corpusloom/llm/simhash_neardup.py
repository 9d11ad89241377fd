"""SimHash near duplicates through vantage-point trees.

1. *Fingerprints.* One scan hashes every shingle of a text (XXH64, seed 42) and takes the majority of each bit.
   Equal fingerprints are one point from here on, however many texts have it.
2. *Trees.* A fingerprint is read as ``BLOCKS`` blocks of bits. Two that differ in up to ``distance`` bits differ in up
   to ``distance // BLOCKS`` bits of some block, so each block has a tree of its own with that radius. A node of a
   tree has a vantage point, and its branches are the Hamming distances to it. A point lives in one leaf. By the
   triangle bound its partners are in branches whose distance differs by the radius at most, so it visits the
   leaves across those boundaries, and only leaves after its own: each pair meets once per tree.
3. *Pairs.* A leaf is a shard. Inside it further vantage distances cut the points into cells; only points of cells
   within the radius of each other are compared, exactly, on all bits. The shard returns one link per point to its
   group's smallest, never all pairs of a dense group, and skips cells that are one group already.
4. *Components* of the links, and their smallest document.

The trees' depth follows the number of points, so leaves keep their size. Searches visit a growing number of leaves:
with n points about n ** 0.4 of n ** 0.7 (random fingerprints); see the README for what that costs at scale.

Defined cases: a null, empty or blank text has the fingerprint zero and links like any other. Repeated rows and ids
each get their result. A null id gets a result, too, and counts as larger than all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import scans, tables
from corpusloom.llm.bytewords import mixed, words_of
from corpusloom.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BLOCKS = 3
LEAF_POINTS = 100_000
LOCAL_LEVELS = 3
_CHUNK = 1 << 21

_LANES = np.array([[(byte >> bit) & 1 for bit in range(8)] for byte in range(256)], dtype=np.uint8).view(np.uint64).reshape(-1)


# Fingerprints


def fingerprints(rows: pa.RecordBatch, shingle: int = SHINGLE) -> np.ndarray:
    """A 64-bit fingerprint of each text."""
    import xxhash

    words = words_of(rows.column("text"), lower=True)
    counts = words.counts
    # All words of all texts, each followed by one space: a shingle is a slice without its last byte.
    sizes = words.end - words.start + 1
    ends = np.cumsum(sizes)
    spread = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
    inside = np.ones(len(spread), dtype=bool)
    inside[ends - 1] = False
    alive = np.zeros(len(words.data), dtype=np.int8)
    if len(words.start):
        change = np.zeros(len(words.data) + 1, dtype=np.int8)
        change[words.start] += 1
        change[words.end] -= 1
        alive = np.cumsum(change[:-1], dtype=np.int8)
    spread[inside] = words.data[alive > 0]
    held = spread.tobytes()

    per_text = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    first = np.repeat(words.of[:-1] - (np.cumsum(per_text) - per_text), per_text) + np.arange(per_text.sum())
    last = first + np.repeat(np.minimum(counts, shingle), per_text) - 1
    begins, stops = (ends[first] - sizes[first]).tolist(), (ends[last] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(held[a:b], SEED) for a, b in zip(begins, stops, strict=True)], dtype=np.uint64)

    # Eight 8-bit counters in one number; sums of up to 255 hashes cannot overflow, longer texts are summed in runs.
    ones = np.zeros((len(counts), 64), dtype=np.int64)
    owner = np.repeat(np.arange(len(counts)), per_text)
    runs = np.flatnonzero(np.diff(owner * 2**32 + (np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) // 255, prepend=-1))
    if len(runs):
        as_bytes = hashes.view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            sums = np.add.reduceat(_LANES[as_bytes[:, byte]], runs)
            np.add.at(ones[:, 8 * byte : 8 * byte + 8], owner[runs], sums.view(np.uint8).reshape(-1, 8))
    bits = (2 * ones > per_text[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


# Trees


def block_bounds(blocks: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each block."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _block(points: np.ndarray, first: int, size: int) -> np.ndarray:
    return (points >> np.uint64(first)) & np.uint64((1 << size) - 1)


def _vantage(nodes: np.ndarray, size: int) -> np.ndarray:
    """A node's vantage point: any fixed function of the node does."""
    return mixed(nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) & np.uint64((1 << size) - 1)


def leaves(points: np.ndarray, tree: int, bounds: tuple[int, int], levels: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(point number, leaf, lives there)`` for the leaf of each point and all later leaves that it has to visit."""
    values = _block(points, *bounds)
    home = np.full(len(points), tree, dtype=np.int64)
    number, node = np.arange(len(points)), home
    for _ in range(levels):
        own = np.bitwise_count(values ^ _vantage(home, bounds[1])).astype(np.int64)
        there = np.bitwise_count(values[number] ^ _vantage(node, bounds[1])).astype(np.int64)
        home = home * 65 + own
        steps = np.arange(-radius, radius + 1)
        branch = (there[:, None] + steps).reshape(-1)
        number = np.repeat(number, len(steps))
        node = np.repeat(node, len(steps)) * 65 + branch
        stays = (branch >= 0) & (branch <= bounds[1]) & (node >= home[number])
        number, node = number[stays], node[stays]
    return number, node, node == home[number]


def tree_levels(points: int, blocks: int, leaf_points: int) -> int:
    """Levels until the fullest leaf of random points is expected to have ``leaf_points``; two at least."""
    size = 64 // blocks
    fullest = math.comb(size, size // 2) / 2**size
    levels = 2
    while points * fullest**levels > leaf_points:
        levels += 1
    return levels


# Pairs inside a leaf


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the groups of each pair; a group's label is its smallest number."""
    while True:
        left, right = labels[a], labels[b]
        differ = left != right
        if not differ.any():
            return labels
        a, b, left, right = a[differ], b[differ], left[differ], right[differ]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


def groups_in_leaf(points: np.ndarray, lives: np.ndarray, tree: int, blocks: int, distance: int, local_levels: int = LOCAL_LEVELS) -> np.ndarray:
    """For each point the smallest number of its group by links of a point that lives here and any other."""
    bounds = block_bounds(blocks)[tree]
    radius = distance // blocks
    values = _block(points, *bounds)
    cells = np.zeros(len(points), dtype=np.int64)
    for level in range(local_levels):
        vantage = _vantage(np.array([1_000_003 + 31 * level + tree]), bounds[1])
        cells = cells * 128 + np.bitwise_count(values ^ vantage) + 32
    living = np.flatnonzero(lives)
    living = living[np.argsort(cells[living], kind="stable")]
    in_order = cells[living]
    kinds, of_kind = np.unique(cells, return_inverse=True)
    steps = np.zeros(1, dtype=np.int64)
    for _ in range(local_levels):
        steps = (steps[:, None] * 128 + np.arange(-radius, radius + 1)).reshape(-1)
    labels = np.arange(len(points))
    for step in steps[np.argsort(np.abs(steps), kind="stable")]:
        low, high = np.searchsorted(in_order, kinds + step, "left"), np.searchsorted(in_order, kinds + step, "right")
        counts = (high - low)[of_kind]
        # Living points that are all of one group with the asking one need no comparison.
        filled = high > low
        if filled.any():
            one = labels[living]
            same = np.full(len(kinds), -1, dtype=np.int64)
            spans = np.column_stack((low[filled], high[filled])).reshape(-1)
            padded = np.append(one, 0)
            least, most = np.minimum.reduceat(padded, spans)[::2], np.maximum.reduceat(padded, spans)[::2]
            same[filled] = np.where(least == most, least, -1)
            counts[labels == same[of_kind]] = 0
        asking = np.flatnonzero(counts)
        ends = np.cumsum(counts[asking])
        at = 0
        while at < len(asking):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _CHUNK, "right")))
            some = asking[at:stop]
            n = counts[some]
            left = np.repeat(some, n)
            right = living[np.repeat(low[of_kind[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            near = np.bitwise_count(points[left] ^ points[right]) <= distance
            labels = _merge(labels, left[near], right[near])
            at = stop
    return labels


_VISIT = T.StructType([T.StructField("leaf", T.LongType()), T.StructField("tree", T.IntegerType()), T.StructField("fp", T.LongType()), T.StructField("lives", T.BooleanType())])
_VISIT_ARROW = pa.schema([("leaf", pa.int64()), ("tree", pa.int32()), ("fp", pa.int64()), ("lives", pa.bool_())])
_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def links(points: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """Links ``(a, b)`` that connect all pairs of distinct ``fp`` up to ``distance`` bits apart; not every pair is one."""
    levels, radius = tree_levels(points.count(), blocks, leaf_points), distance // blocks
    bounds = block_bounds(blocks)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(given), 20_000):
                some = given[at : at + 20_000]
                for tree in range(blocks):
                    number, leaf, lives = leaves(some, tree + 1, bounds[tree], levels, radius)
                    arrays = [pa.array(leaf), pa.array(np.full(len(leaf), tree, dtype=np.int32)), pa.array(some[number].view(np.int64)), pa.array(lives)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=_VISIT_ARROW)

    def connect(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        lives = rows.column("lives").to_numpy(zero_copy_only=False)
        found = rows.column("fp").to_numpy()
        if not lives.any():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        labels = groups_in_leaf(found.view(np.uint64), lives, rows.column("tree")[0].as_py(), blocks, distance)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"a": found[linked], "b": found[labels[linked]]})

    n = tables.parts(points.sparkSession)
    return points.select("fp").mapInArrow(visit, _VISIT).repartition(n, "leaf").groupBy("leaf").applyInArrow(connect, _LINK)


def _fingerprinted(docs: DataFrame, id_column: str, text_column: str, shingle: int, keep: list[str]) -> DataFrame:
    """A written table of the id, the fingerprint and, if asked for, the text and a struct of further columns."""

    def compute(rows: pa.RecordBatch) -> list:
        return [pa.array(fingerprints(rows, shingle).view(np.int64))]

    columns = [tables.exactly(docs, id_column).alias("doc_id"), tables.exactly(docs, text_column).alias("text"), tables.carried(docs, keep)]
    made = scans.with_columns(docs.select(*columns), compute, T.StructType([T.StructField("fp", T.LongType())]), keep=["text", "carried"] if keep else [])
    return tables.written(made)


def _components(made: DataFrame, distance: int) -> DataFrame:
    """``(fp, least, root)`` for every distinct fingerprint; ``least`` is its smallest id, ``root`` names its component."""
    points = tables.written(made.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(points, distance))
    placed = points.join(roots, points["fp"] == roots["node"], "left")
    return tables.written(placed.select("fp", "least", F.coalesce("root", "fp").alias("root")))


def _checked(distance: int) -> None:
    if not 0 <= distance < 64:
        raise ValueError("distance must be 0 to 63")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row: the id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of its component."""
    _checked(distance)
    made = _fingerprinted(docs, id_column, text_column, shingle, [])
    placed = _components(made, distance)
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = made.join(placed.join(smallest, "root").select("fp", "component_id"), "fp")
    return joined.select(F.col("doc_id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs``, one of each component: the one of smallest id, and one only if that is repeated."""
    _checked(distance)
    others = [name for name in docs.columns if name not in (id_column, text_column)]
    made = _fingerprinted(docs, id_column, text_column, shingle, others or [id_column])
    made = made.withColumn("row", F.monotonically_increasing_id())  # of a written table, so it stays
    placed = _components(made.select("doc_id", "fp"), distance)
    rows = made.select("doc_id", "fp", "row").join(placed.select("fp", "root"), "fp")
    chosen = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    stays = made.join(tables.written(chosen.select(F.col("first.row").alias("row"))), "row", "left_semi")
    back = dict(zip(others, tables.released(others), strict=True)) | {id_column: F.col("doc_id").alias(id_column), text_column: F.col("text").alias(text_column)}
    return stays.select(*[back[name] for name in docs.columns])


def op10_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(tables.table(spark, folder, "documents", "doc_id", "text"))
