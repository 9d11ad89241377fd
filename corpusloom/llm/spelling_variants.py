"""Spelling variants: words one edit apart, by a frontier of states that walks a relational trie level by level.

1. *Trie.* Every word is read forwards and backwards. A node is a prefix, named by a hash; of each word only
   the nodes from half its length on exist, since of two words one edit apart either the first or the second half
   of the shorter way is equal. Nodes in which nothing branches, ends or begins are left out, so an edge carries a
   text and a very long word is one edge. Edges are a table ``(node, letter, label, child, ends, onward)``; ``onward``
   is a bit set of the letters that go on from the child.
2. *Frontier.* A state is ``(word, position, node, edits)``. The states without edit are the nodes on a word's own path. One
   join with the edges of their nodes lets them leave it, by a replacement, an insertion or a deletion at a sibling's
   first letter. From there each level is one join on node and next letter. A state with one edit that has used up
   its word in a node where a word ends is a neighbour; one that cannot go on by ``onward`` is not kept.
3. *Choice.* Neighbours are checked on the words themselves, counted per word, and the most frequent one that is
   frequent enough is the word's form. Forms are followed to the last by pointer jumping; each step multiplies the
   frequency, so there are few.

A node has at most as many edges as the alphabet has letters, whatever the number of words behind it, and a join on a hot
node can be split. States are written after each level. The number of levels is the largest number of branching
nodes in the second half of any word. Prefixes of equal hash are one node: it offers more ways, and the check on words
decides, so no result depends on hashes.

Defined cases: null and empty words are left out; repeated rows of a word add up their ``n`` (null: none). Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import tables

RATIO = 10
LEAST_LENGTH, LEAST_COUNT = 7, 2
LETTERS = "[a-zÀ-ÿ]"
DAMAGED = 31
_SIDES = (b"read from first to last letter: ", b"read from last to first letter: ")  # sides share no node
_HELD_WORDS = 300_000


@F.pandas_udf(T.ArrayType(T.LongType()))
def _path(texts: pd.Series, sides: pd.Series) -> pd.Series:
    """Node ids of a text's prefixes, from half its length (of the word one shorter) to the whole."""
    import xxhash

    out = []
    for text, side in zip(texts, sides, strict=True):
        first = (len(text) - 1) // 2
        state = xxhash.xxh3_64(_SIDES[side] + text[:first].encode())
        nodes = [state.intdigest()]
        for letter in text[first:]:
            state.update(letter.encode())
            nodes.append(state.intdigest())
        out.append(np.array(nodes, dtype=np.uint64).view(np.int64))
    return pd.Series(out)


def _from(text: Column, position: Column | int) -> Column:
    """The text from a position on, counted from 0."""
    return F.substring(text, F.lit(position) + 1 if isinstance(position, int) else position + 1, F.length(text))


def _bit(letter: Column) -> Column:
    """A letter's place in a bit set of 64; several letters share one."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (F.ascii(letter) % 64).cast("int"))


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges, and ``(n, side, text, key, steps)``: for each word and side its whole-word node and its kept nodes; written tables."""
    both = words.select("word", "n", "word_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    text = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")).alias("text")
    sided = both.select((F.col("word_id") * 2 + F.col("side")).alias("id"), "n", "side", text)
    length = F.length("text")
    first = F.floor((length - 1) / 2).cast("int")
    pathed = tables.written(sided.select("*", first.alias("first"), _path("text", "side").alias("nodes")))
    letters = F.split(_from(F.col("text"), F.col("first")), "")  # one pass over the text, not one per node
    at = pathed.select("id", "first", length.alias("length"), F.posexplode(F.arrays_zip("nodes", letters.alias("letters"))).alias("step", "at")).select(
        "id", F.col("at.nodes").alias("node"), (F.col("first") + F.col("step")).alias("depth"), "length", F.ascii("at.letters").alias("next"), _bit(F.col("at.letters")).alias("bit")
    )
    ends, leads = F.col("depth") == F.col("length"), F.col("depth") < F.col("length")
    begins = F.col("depth") <= F.floor((F.col("length") + 1) / 2)
    next_letter = F.when(leads, F.col("next"))
    branches = F.coalesce(F.min(next_letter) < F.max(next_letter), F.lit(False))
    kept = (
        at.groupBy("node")
        .agg(F.max(ends | begins).alias("stays"), branches.alias("branches"), F.max(ends).alias("ends"), F.coalesce(F.bit_or(F.when(leads, F.col("bit"))), F.lit(0)).alias("onward"))
        .where("stays OR branches")
        .select("node", "branches", "ends", "onward")
    )
    # Only ids and depths meet the kept nodes; texts join their word's nodes afterwards.
    steps = F.array_sort(F.collect_list(F.struct("depth", "node", "branches", "ends", "onward"))).alias("steps")
    chains = at.select("id", "node", "depth").join(kept, "node").groupBy("id").agg(steps)
    key = F.element_at("nodes", -1).alias("key")
    paths = tables.written(pathed.select("id", "n", "side", "text", key).join(chains, "id").drop("id"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("steps") - 1),
        lambda i: F.struct(
            F.get("steps", i - 1)["node"].alias("node"),
            F.substring("text", F.get("steps", i - 1)["depth"] + 1, F.get("steps", i)["depth"] - F.get("steps", i - 1)["depth"]).alias("label"),
            F.get("steps", i)["node"].alias("child"),
            F.get("steps", i)["ends"].alias("ends"),
            F.get("steps", i)["onward"].alias("onward"),
        ),
    )
    edges = paths.where(F.size("steps") > 1).select(F.inline(pairs)).distinct()
    return tables.written(edges.select("node", F.substring("label", 1, 1).alias("letter"), "label", "child", "ends", "onward")), paths


def _alive(position: Column) -> Column:
    """Whether a state at a position can end or go on in the child."""
    left = F.length("text") - position
    onward = F.col("onward").bitwiseAND(_bit(F.substring("text", position + 1, F.lit(1)))) != 0
    return ((left == 0) & F.col("ends")) | ((left > 0) & onward)


_STATE = ["text", "side", "position", "node", "at", "edit"]


def _moved(stepped: DataFrame) -> DataFrame:
    """A level's states as a written table; ``done`` where a word ends."""
    return tables.written(stepped.select("text", "side", "position", F.col("child").alias("node"), "at", "edit", (F.col("position") == F.length("text")).alias("done")))


def _leaving(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """States with one edit, made at a letter by which another word leaves the path."""
    half = F.floor(F.length("text") / 2)
    on_path = paths.select("text", "side", F.explode("steps").alias("step")).where((F.col("step.depth") >= half) & (F.col("step.onward") != 0))
    others = on_path.where(F.col("step.branches") | (F.col("step.depth") == F.length("text")))
    states = others.select("text", "side", F.col("step.depth").alias("at"), F.col("step.node").alias("node"), F.substring("text", F.col("step.depth") + 1, F.lit(1)).alias("own"))
    joined = states.join(edges, "node").where("letter <> own")
    at, length = F.col("at"), F.length("label")
    left = _from(F.col("text"), at)
    after, tail = _from(F.col("text"), at + 1), _from(F.col("label"), 1)

    def way(valid: Column, further: Column, edit: Column) -> Column:
        return F.when(valid & _alive(further), F.struct(further.alias("position"), edit.alias("edit")))

    some = F.col("own") != ""
    ways = F.array(
        way(some & F.startswith(after, tail), at + length, F.col("letter")),  # replaced
        way(F.startswith(left, tail), at + length - 1, F.col("letter")),  # inserted
        way(some & F.startswith(after, F.col("label")), at + 1 + length, F.lit("")),  # deleted
    )
    found = joined.select("text", "side", "at", "child", F.explode(ways).alias("way")).where("way IS NOT NULL")
    return found.select("text", "side", "at", "child", "way.position", "way.edit")


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``: every ordered pair of words of ``(word, n, word_id)`` that one edit turns into each other."""
    edges, paths = trie(words)
    # The last letter goes, in a node of the own path where a word ends.
    last = paths.select("text", "side", F.explode("steps").alias("step")).where((F.col("step.depth") == F.length("text") - 1) & F.col("step.ends"))
    found = last.select("text", "side", F.col("step.node").alias("key"), F.col("step.depth").alias("at"), F.lit("").alias("edit"))
    level = _moved(_leaving(paths, edges))
    while True:
        found = found.unionByName(level.where("done").select("text", "side", F.col("node").alias("key"), "at", "edit"))
        frontier = level.where("NOT done").select(_STATE)
        if frontier.isEmpty():
            break
        asking = frontier.withColumn("letter", F.substring("text", F.col("position") + 1, F.lit(1)))
        stepped = asking.join(edges, ["node", "letter"]).where(F.startswith(_from(F.col("text"), F.col("position")), F.col("label")))
        further = stepped.withColumn("position", F.col("position") + F.length("label"))
        level = _moved(further.where(_alive(F.col("position"))))
    whole = paths.select("key", "side", F.col("n").alias("near_n"), F.col("text").alias("near_text"))
    pairs = found.join(whole, ["key", "side"])
    goes = (F.length("text") >= F.length("near_text")).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("at")), "edit", _from(F.col("text"), F.col("at") + goes))

    def forwards(text: str) -> Column:
        return F.when(F.col("side") == 0, F.col(text)).otherwise(F.reverse(text))

    checked = pairs.where(F.col("near_text") == edited).select(forwards("text").alias("word"), "side", forwards("near_text").alias("near"), "near_n")
    half = F.floor(F.length("word") / 2).cast("int")
    same_half = F.substring("word", F.lit(1), half) == F.substring("near", F.lit(1), half)
    # Equal first halves are the forward side's.
    return checked.where((F.col("side") == 0) | ~same_half).select("word", "near", "near_n")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """For every word of ``(word, n)``: ``word, n, n_near, form, form_n, root``.

    ``form`` is the neighbour of largest ``n`` (the smallest word of several), if it occurs ``ratio`` times as often at
    least; ``root`` is the last form in a chain of forms, the word itself if it has none.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, else forms can be circular")
    counted = words.where("word <> ''").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
    words = tables.written(counted.withColumn("word_id", F.monotonically_increasing_id()))  # written, so it stays
    near = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best"))
    joined = words.drop("word_id").join(near, "word", "left")
    enough = -F.col("best.n") >= ratio * F.col("n")
    enough = enough & (F.col("best.n") < 0)
    chosen = tables.written(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n")
        )
    )
    jumps = chosen.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = tables.written(jumps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        jumps = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            break
    return chosen.join(jumps, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def damaged_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(word, n)``: runs of letters of all texts, A-Z lower-cased, one letter of some deleted by a checksum of id and run.

    A null text has no runs; a null id counts as an empty one. Tasks count their own words before the shuffle.
    """
    import re

    run, schema = re.compile(LETTERS + "{%d,}" % LEAST_LENGTH), T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            words, n = list(counts), list(counts.values())
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in batches:
            for number, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                words = run.findall(text.as_py().encode().lower().decode())  # lower() of bytes is A-Z only
                before = zlib.crc32(f"{'' if number is None else number}:".encode())
                for i, word in enumerate(words):
                    h = zlib.crc32(word.encode(), before)
                    if h % DAMAGED == 0:
                        place = h % len(word)
                        words[i] = word[:place] + word[place + 1 :]
                counts.update(words)
                if len(counts) > _HELD_WORDS:
                    yield counted()
        if counts:
            yield counted()

    given = docs.select(tables.exactly(docs, id_column).alias("id"), tables.exactly(docs, text_column).alias("text"))
    words = given.mapInArrow(count, schema).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(damaged_words(tables.table(spark, folder, "documents", "doc_id", "text")))
