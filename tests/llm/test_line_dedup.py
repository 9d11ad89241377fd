"""Line dedup against dictionaries, insertions against deletions, the filter against sets."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from corpusloom.llm.cuckoo import CuckooFilter, Full
from corpusloom.llm.line_dedup import LineIndex
from llm import samples

BLANKS = " \t\n\x0b\x0c\r"


def key(line, least):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    return found if len(found) >= least else None


def expected(rows, index_rows=None, least=20, docs=3):
    held = {}
    for number, text, *_ in rows if index_rows is None else index_rows:
        for line in (text or "").split("\n"):
            if key(line, least) is not None:
                held.setdefault(key(line, least), set()).add(float("inf") if number is None else number)
    out = []
    for number, text, *_ in rows:
        own = float("inf") if number is None else number
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (len(held.get(key(x, least), ())) >= docs and own in held[key(x, least)] and own != max(held[key(x, least)]))]
        out.append((own, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def found(df):
    return sorted((float("inf") if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect())


def lined(seed, n, first=0):
    """Documents of few lines from a small stock, in other case and with other blanks around."""
    rng = random.Random(seed)
    stock = [" ".join(rng.choice(samples.WORDS) for _ in range(rng.randint(2, 6))) for _ in range(25)] + ["", " ", "x" * 20, "É" * 19]
    rows = []
    for i in range(n):
        lines = [rng.choice(["", " ", "\t"]) + rng.choice([str, str.upper])(rng.choice(stock)) + rng.choice(["", "\r", " "]) for _ in range(rng.randint(0, 9))]
        rows.append((first + i, "\n".join(lines)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_brute_force_with_hard_rows(spark):
    rows = lined(1, 80) + [(None, "alpha beta Gamma delta"), (None, None), (500, None), (501, ""), (3, "x" * 20), (3, "x" * 20), (700, "x" * 20 + "\n" + "y " * 100_000)]
    docs = frame(spark, rows).withColumns({"key": F.lit(1), "n_lines": F.lit("own"), "id": F.lit("i"), "keys": F.lit(2)})
    index = LineIndex.create(spark, shard_keys=8).insert(docs)
    result = index.dedup(docs, keep=["key", "n_lines", "id", "keys"])
    assert result.columns == ["doc_id", "key", "id", "keys", "kept_text", "n_lines", "n_dropped"]
    assert found(result) == expected(rows)
    assert any(r[2] for r in expected(rows)) and index.shards > 1


def test_empty(spark):
    index = LineIndex.create(spark).insert(samples.empty(spark))
    assert index.dedup(samples.empty(spark)).collect() == [] and index.current().collect() == []
    rows = lined(2, 5)
    assert found(index.dedup(frame(spark, rows))) == expected(rows, [])
    assert found(index.insert(frame(spark, rows)).dedup(frame(spark, rows))) == expected(rows)


def state(index):
    return sorted(map(tuple, index.current().collect())), sorted(map(tuple, index.live().distinct().collect()))


def test_insertions_and_deletions(spark):
    """Batches give what one batch gives; deleting what was inserted gives the index as it was, its filters too."""
    first, second = lined(3, 40), lined(4, 40, 1000)
    a = LineIndex.create(spark, shard_keys=16).insert(frame(spark, first))
    b = a.insert(frame(spark, second))
    both = LineIndex.create(spark, shard_keys=16).insert(frame(spark, first + second))
    assert state(b) == state(both)
    assert found(b.dedup(frame(spark, first + second))) == expected(first + second)
    c = b.delete(spark.createDataFrame([(n,) for n, _ in second] + [(99_999,), (None,)], "doc_id long"))
    assert state(c) == state(a) and found(c.dedup(frame(spark, first))) == expected(first)
    assert {r.shard: r.n_keys for r in c._last_filters().collect() if r.n_keys} == {
        r.shard: r.n for r in c.current().select(F.pmod(F.xxhash64("key"), F.lit(c.shards)).cast("int").alias("shard")).groupBy("shard").agg(F.count("*").alias("n")).collect()
    }
    # The largest holder goes: the next one keeps the line. What was deleted can come back.
    some = [n for n, _ in second if n % 2]
    d = b.delete(spark.createDataFrame([(n,) for n in some], "doc_id long"))
    rest = first + [row for row in second if row[0] % 2 == 0]
    assert found(d.dedup(frame(spark, rest))) == expected(rest)
    back = d.insert(frame(spark, [row for row in second if row[0] % 2]))
    assert found(back.dedup(frame(spark, first + second))) == expected(first + second)
    assert state(a) == state(LineIndex.create(spark).insert(frame(spark, first)))
    with pytest.raises(ValueError):
        b.insert(frame(spark, second[:9]))


def test_filter():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 2**64, 50_000, dtype=np.uint64)
    held = CuckooFilter.of_size(40_000)
    held.insert(hashes[:40_000])
    assert held.contains(hashes[:40_000]).all() and held.held == 40_000
    assert held.contains(rng.integers(0, 2**64, 200_000, dtype=np.uint64)).mean() < 0.001
    held.delete(hashes[:30_000])
    assert held.contains(hashes[30_000:40_000]).all() and held.held == 10_000
    again = CuckooFilter.from_bytes(held.to_bytes())
    again.insert(hashes[:30_000])
    again.delete(hashes[:40_000])
    assert again.held == 0
    with pytest.raises(KeyError):
        again.delete(hashes[:1])
    with pytest.raises(Full):
        CuckooFilter.of_size(8).insert(hashes)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    assert differences(spark, duck(folder), folder, "op13_line_dedup") == []
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    from corpusloom.llm.line_dedup import op13_line_dedup

    want = [(a, b, c, hashlib.sha256(d.encode()).hexdigest()) for a, b, c, d in expected(rows)]
    assert sorted(map(tuple, op13_line_dedup(spark, folder).collect())) == want and any(r[2] for r in want)
