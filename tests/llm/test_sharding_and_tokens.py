"""Extendible sharding against splitting one bit at a time; token counts against greedy cutting."""

import random
from collections import defaultdict
from hashlib import md5

import public_tokenizers
import pytest

from corpusloom.llm import extendible_sharding as sharding
from corpusloom.llm import token_counts as counting
from llm import samples


def buckets(rows, limit):
    """Shard of each hash by splitting buckets one bit at a time."""
    out = {}
    waiting = [("", rows)]
    while waiting:
        prefix, own = waiting.pop()
        if sum(n for _, n in own) <= limit or len({h for h, _ in own}) == 1:
            out |= {h: prefix for h, _ in own}
            continue
        for bit in "01":
            if inside := [(h, n) for h, n in own if h[len(prefix)] == bit]:
                waiting.append((prefix + bit, inside))
    return out


@pytest.mark.parametrize("limit,copies", [(200, 0), (3000, 50), (1, 3), (10**9, 5)])
def test_shards(spark, limit, copies):
    docs, rows = samples.documents(spark, 4, 120, 60)
    more = [(7, "many copies of one id", None, None, 1)] * copies + [(None, "x", None, None, 1)]
    docs = docs.union(spark.createDataFrame(more, samples.SCHEMA)).withColumnRenamed("lang", "shard").withColumnRenamed("source", "h")
    got = sharding.extendible_shards(docs, limit_bytes=limit, keep=["shard", "h"]).collect()
    rows = rows + more
    sized = [(f"{int(md5(('' if r[0] is None else str(r[0])).encode()).hexdigest()[:15], 16):060b}", len((r[1] or "").encode())) for r in rows]
    place = buckets(sized, limit)
    want = sorted((repr(r[0]), n, place[h]) for r, (h, n) in zip(rows, sized, strict=True))
    assert sorted((repr(r.doc_id), r.n_bytes, r.shard) for r in got) == want
    pages = defaultdict(list)
    for r in got:
        pages[r.shard, r.page].append(r.n_bytes)
    assert all(sum(p) <= limit or len([n for n in p if n]) == 1 for p in pages.values())


def test_no_shards(spark):
    assert sharding.extendible_shards(samples.empty(spark)).collect() == []


def greedy(word, pieces):
    count = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        at, count = end, count + 1
    return count


def test_automaton_on_random_vocabularies():
    rng = random.Random(3)
    for _ in range(300):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        automaton = counting.Automaton(pieces)
        for _ in range(40):
            word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == greedy(word, pieces), (pieces, word)


def test_counts(spark):
    docs, rows = samples.documents(spark, 6, 100, 80)
    rows = rows + [(None, "\U0001f600 plain 中文" + "x" * 300, None, None, 1)]
    docs = spark.createDataFrame(rows, samples.SCHEMA).withColumnRenamed("lang", "n_tokens")
    pieces = set(counting.sentence_pieces(public_tokenizers.path(counting.VOCABULARY)))
    want = []
    for r in rows:
        words = [w.decode() for w in (r[1] or "").encode().split()]
        found = [greedy(counting.MARKER + w, pieces) for w in words]
        want.append((r[0], len(words), sum(n or 1 for n in found), found.count(0)))
    got = counting.token_counts(docs, keep=["n_tokens"]).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    assert counting.token_counts(samples.empty(spark)).collect() == []


def test_pages_of_one_id_with_a_large_text(spark):
    """2,000 small rows of one id beside a text over the limit: about as many pages as their bytes need."""
    rows = [(7, "x" * 100)] * 2000 + [(7, "y" * 1500), (7, "z" * 999), (8, "w" * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pages = defaultdict(list)
    for r in sharding.extendible_shards(docs, limit_bytes=1000).collect():
        pages[r.shard, r.page].append(r.n_bytes)
    assert sum(map(len, pages.values())) == len(rows) and all(sum(p) <= 1000 or p == [1500] for p in pages.values())
    assert 200 <= len(pages) <= 240
