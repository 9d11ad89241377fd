"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import spelling_variants as variants
from llm import samples

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else (a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :])


def expected(counts, ratio=10):
    by_mask = {}
    for word in counts:
        for key in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            by_mask.setdefault(key, set()).add(word)
    near = {word: set() for word in counts}
    for group in by_mask.values():
        for word in group:
            near[word] |= {other for other in group if one_edit(word, other)}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] and counts[best] > 0 else None
    out = []
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, counts[word], len(near[word]), form[word], counts[form[word]] if form[word] else None, root))
    return sorted(out)


def words_of(rows):
    counts = Counter()
    for number, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def found(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


@pytest.mark.parametrize("seed,alphabet,longest", [(1, "ab", 9), (2, "abcé", 7), (3, "a", 30)])
def test_every_pair(spark, seed, alphabet, longest):
    """Dense vocabularies, words of one letter, a word that is a prefix of the next, ties in number."""
    rng = random.Random(seed)
    counts = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))): rng.choice([1, 1, 2, 10, 20, 100, 1000]) for _ in range(250)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(variants.variants(df)) == expected(counts)


def test_long_words(spark):
    """A word of 20,000 letters is one edge of the trie, not as many levels."""
    long = "abcdefghij" * 2_000
    counts = {long: 50, long + "x": 5, "y" + long: 4, long[:1000] + long[1001:]: 2, long[:15_000] + "zz" + long[15_001:]: 3, "abcdefghij": 1}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(variants.variants(df)) == expected(counts)


def test_defined_cases(spark):
    rows = [(None, 3), ("", 3), ("singular", 4), ("singular", 6), ("singulars", 1), ("none", None)]
    df = spark.createDataFrame(rows, "word string, n long").withColumns({"node": F.lit(1), "text": F.lit("x")})
    assert found(variants.variants(df)) == expected({"singular": 10, "singulars": 1, "none": 0})
    assert variants.variants(spark.createDataFrame([], "word string, n long")).collect() == []
    docs, rows = samples.documents(spark, 4, 200, 80)
    clash = docs.withColumns({"id": F.lit("x"), "run": F.lit(1), "h": F.lit(0)})
    more = [(None, "Singular singular SINGULAR \xc9coles Ācoles"), (None, "singular")]
    given = clash.select("doc_id", "text", "id", "run", "h").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    assert {r.word: r.n for r in variants.damaged_words(given).collect()} == words_of(rows + more)
    assert variants.damaged_words(samples.empty(spark)).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    result = found(variants.op12_spelling_variants(spark, folder))
    assert result == expected(words_of(rows))
    assert any(r[3] for r in result)
