"""Decontamination against a scan of all windows."""

import hashlib
import re

import pytest

from pyspark.sql import functions as F

from corpusloom.llm.decontamination import decontaminate, find_contamination, op5_decontamination
from llm import samples

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, window=10):
    owners = {}
    for name, text in items:
        own = words(text)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            owners.setdefault(tuple(own[i : i + n]), set()).add("" if name is None else str(name))
    lengths = {len(x) for x in owners}
    out = []
    for number, text in docs:
        own = words(text)
        hit, named = set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                if found := owners.get(tuple(own[i : i + n])):
                    hit |= set(range(i, i + n))
                    named |= found
        out.append((number, len(own), len(hit), sorted(named)))
    return sorted(out, key=repr)


ITEMS = [(1, samples.texts(3, 1, 40)[0]), (2, "Alpha, BETA gamma"), (3, None), (4, "..."), (None, "mu mu mu mu mu mu mu mu mu mu mu mu"), (5, "solitaire")]


@pytest.mark.parametrize("seed,window,block", [(3, 10, 1 << 20), (3, 3, 1 << 20), (4, 4, 700)])
def test_brute_force(spark, seed, window, block):
    docs, rows = samples.documents(spark, seed, 120, 90)
    items = ITEMS + [(i, t) for i, t in enumerate(samples.texts(seed, 6, 30), 10)] * 2
    given = spark.createDataFrame(items, "item_id long, text string")
    extra = [(5000, "x solitaire y"), (5001, "mu " * 30), (None, "alpha beta gamma")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = find_contamination(docs, given, window=window, block_bytes=block)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=repr)
    assert got == expected([(r[0], r[1]) for r in rows] + extra, items, window)
    assert any(r[2] for r in got)


def test_longest_matches(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"zero. {item.upper()} end two THREE"), (2, "nothing here")], "doc_id long, text string")
    found = find_contamination(docs, spark.createDataFrame([(7, item)], "item_id long, text string"), keep=["text"])
    rows = {r.doc_id: r for r in found.collect()}
    assert [tuple(m) for m in rows[1].matches] == [("7", 0, 1, 13)] and rows[1].n_hit == 13
    assert rows[2].matches == [] and rows[2].text == "nothing here"
    assert [r.doc_id for r in decontaminate(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()] == [2]


def test_clashing_names_over_several_blocks(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(6)]
    rows = [(1, f"a {items[0][1]} b", 5), (None, items[3][1], 6), (1, "nothing", 7), (2, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept long")
    for name in ("_digest", "digest", "id", "of_id", "carried", "spans"):
        given = docs.withColumn(name, F.lit("own"))
        found = find_contamination(given, spark.createDataFrame(items, "item_id long, text string"), keep=["kept", name, "text"], block_bytes=100)
        assert sorted((r.kept, r.n_hit) for r in found.collect()) == [(5, 12), (6, 12), (7, 0), (8, 0)]
        assert name == "spans" or {r[name] for r in found.collect()} == {"own"}
        assert decontaminate(given, spark.createDataFrame(items, "item_id long, text string"), block_bytes=100).columns == given.columns


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs, rows = samples.documents(spark)
    assert find_contamination(samples.empty(spark), none).collect() == []
    assert {r.n_hit for r in find_contamination(docs, none).collect()} == {0}
    clash = docs.withColumnRenamed("lang", "spans").withColumnRenamed("source", "id")
    assert decontaminate(clash, none).count() == len(rows)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in op5_decontamination(spark, folder).collect()), key=repr)
    want = [(a, b, c, len(d), hashlib.sha256(",".join(d).encode()).hexdigest(), c > 0) for a, b, c, d in expected(docs, items)]
    assert got == sorted(want, key=repr) and any(r[5] for r in got)
