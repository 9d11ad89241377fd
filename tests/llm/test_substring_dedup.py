"""Substring dedup against a dictionary of all windows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.substring_dedup import op1_substring_dedup, substring_dedup
from llm import samples

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window):
    """Sorted ``(id, words, removed, kept words)``; a null id comes last."""
    largest = float("inf")
    first = {}
    split = [(largest if row[0] is None else row[0], WORD.findall(row[1] or "")) for row in rows]
    for number, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, largest), number)
    out = []
    for number, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < number:
                gone |= set(range(i, i + window))
        out.append((number, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out)


def found(df):
    return sorted((float("inf") if r[0] is None else r[0], r.n_words, r.n_removed, " ".join(WORD.findall(r.kept_text or ""))) for r in df.collect())


@pytest.mark.parametrize("seed,window", [(1, 13), (2, 13), (3, 5), (4, 1), (5, 2), (6, 50)])
def test_brute_force(spark, seed, window):
    docs, rows = samples.documents(spark, seed, 150, 120)
    assert found(substring_dedup(docs, window=window)) == expected(rows, window)


def test_null_id_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (7, text), (None, text), (8, "x " + text + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"chunk": F.lit(1), "n_words": F.lit("own"), "id": F.lit("x")})
    result = substring_dedup(docs, keep=["chunk", "n_words", "id"])
    assert result.columns == ["doc_id", "chunk", "id", "kept_text", "n_words", "n_removed"]
    assert found(result.select("doc_id", "n_words", "n_removed", "kept_text")) == expected(rows, 13)


def test_blanks_between_kept_words_stay(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text), (2, " a\n\nb  " + text + "\tc\n"), (3, text)], "doc_id long, text string")
    assert {r.doc_id: r.kept_text for r in substring_dedup(docs).collect()} == {1: text, 2: " a\n\nb  c\n", 3: ""}


def test_empty(spark):
    assert substring_dedup(samples.empty(spark)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    result = sorted(tuple(r) for r in op1_substring_dedup(spark, folder).collect())
    assert result == [(a, b, c, hashlib.sha256(d.encode()).hexdigest()) for a, b, c, d in expected(rows, 13)]
    assert any(r[2] for r in result)


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_words_that_collide_in_polynomials(spark, size):
    """Thue-Morse words over two letters and their mirrors have the same polynomial hash for every odd base."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(size))
    mirror = word.translate(str.maketrans("ab", "ba"))
    equal = " ".join(["w"] * 12)
    rows = [(1, f"{equal} {word}"), (2, f"{equal} {mirror}"), (3, f"{word} {mirror} " * 20), (4, f"{mirror} {word} " * 20), (5, f"{equal} {word}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(substring_dedup(docs)) == expected(rows, 13)
    sequence = " ".join(word), " ".join(mirror)
    rows = [(1, sequence[0]), (2, sequence[1]), (3, sequence[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(substring_dedup(docs, window=size)) == expected(rows, size)
