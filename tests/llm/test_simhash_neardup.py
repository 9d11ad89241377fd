"""SimHash groups against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import simhash_neardup as near
from corpusloom.llm.components import components
from llm import samples

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, distance):
    """Smallest number of each point's group, by all pairs."""
    label = list(range(len(points)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    points = np.array(points, dtype=np.uint64)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= distance):
            a, b = sorted((root(i), root(i + 1 + int(j))))
            label[b] = a
    return [root(i) for i in range(len(points))]


def expected(rows):
    largest = float("inf")
    points = [fingerprint(r[1]) for r in rows]
    label = groups(points, 4)
    least = {}
    for r, g in zip(rows, label, strict=True):
        least[g] = min(least.get(g, largest), largest if r[0] is None else r[0])
    return sorted(((r[0], f"{p:016x}", None if least[g] == largest else least[g]) for r, p, g in zip(rows, points, label, strict=True)), key=repr)


def planted(seed, n):
    """Random fingerprints, chains of close ones and a dense group."""
    rng = np.random.default_rng(seed)
    points = set(rng.integers(0, 2**63, n, dtype=np.uint64).tolist())
    for base in list(points)[: n // 4]:
        for _ in range(rng.integers(1, 4)):
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                base ^= 1 << int(bit)
            points.add(base)
    centre = int(rng.integers(0, 2**63))
    for _ in range(n // 2):
        points.add(centre ^ sum(1 << int(b) for b in rng.choice(16, rng.integers(0, 9), replace=False)))
    return sorted(points)


@pytest.mark.parametrize("blocks,distance,leaf", [(3, 4, 100), (1, 4, 100_000), (2, 4, 50), (5, 4, 50), (3, 0, 100), (3, 7, 1000)])
def test_links_connect_all_pairs(spark, blocks, distance, leaf):
    points = planted(blocks, 400)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "fp long")
    found = near.links(frame, distance, blocks, leaf).collect()
    held = {int(np.uint64(p).view(np.int64)): i for i, p in enumerate(points)}
    label = np.arange(len(points))
    for r in found:
        assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") > 0
        label = near._merge(label, np.array([held[r.a]]), np.array([held[r.b]]))
    assert label.tolist() == groups(points, distance)


def test_few_links_for_a_dense_group(spark):
    points = [sum(1 << i for i in range(12) if p >> i & 1) for p in range(4096)]
    frame = spark.createDataFrame([(p,) for p in points], "fp long")
    assert near.links(frame).count() < 3 * 40 * len(points)


def test_brute_force(spark):
    docs, rows = samples.documents(spark, 5, 150, 60)
    rows = rows + [(None, rows[3][1], None, None, 1), (None, "only here at all", None, None, 1)]
    long = [(6000 + i, " ".join(f"w{k}" for k in range(400 + i)), None, None, 1) for i in range(6)]
    docs = spark.createDataFrame(rows + long, samples.SCHEMA).withColumns({"fp": F.lit(1), "node": F.lit("x")})
    got = sorted((tuple(r) for r in near.near_duplicates(docs).collect()), key=repr)
    assert got == expected(rows + long)


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 50)] + [(100, i) for i in range(101, 400)] + [(7, 7), (-5, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: -5 for i in [-5, *range(100, 400)]}


def test_empty(spark):
    assert near.near_duplicates(samples.empty(spark)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in near.op10_simhash_neardup(spark, folder).collect()), key=repr)
    assert got == expected(rows) and any(r[0] != r[2] for r in got)
