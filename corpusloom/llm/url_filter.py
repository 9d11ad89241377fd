"""URL filters by a Bloom filter cascade, in DataFrame operations only.

A cascade holds a list exactly for every key of a known universe (all keys of the corpus): level 1 is a Bloom filter
of the listed keys, level 2 one of the other keys that level 1 lets through, level 3 one of the listed keys that
level 2 lets through, and so on until nothing is let through. A key is listed if it passes an odd number of levels.
Each level is a few bits for each key that it holds; probing is an expression on the row, without a join.

Levels are literals of the query, so they are allowed ``MAX_FILTER_BYTES`` together; a longer list is held as a table
and joined by key instead.

Rules are pairs of host and path start. A row's candidates are its host's suffixes with its path's starts in the
lengths that rules have; two cascades (allowed, blocked) tell which candidates are rules, and the longest wins.
Pages without a rule are blocked if their host and path are on the list of pages, a cascade of its own.

Defined cases: a null url or one without :// has an empty host and path. A key that is on both lists is blocked.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import tables

MAX_FILTER_BYTES = 4 << 20
BITS_PER_KEY = 10
HASHES = 5
#: Host, path start, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _places(key: Column, level: int, words: int) -> list[tuple[Column, Column]]:
    """Word and bit of each hash of a key."""
    first, second = F.xxhash64(key, F.lit(level)), F.xxhash64(key, F.lit(-1 - level))
    places = []
    for i in range(HASHES):
        at = F.pmod(first.bitwiseXOR(F.call_function("shiftrightunsigned", second, F.lit(i * 7))), F.lit(words * 64).cast("long"))
        places.append((F.call_function("shiftright", at, F.lit(6)).cast("int"), at.bitwiseAND(F.lit(63)).cast("int")))
    return places


def _filter(keys: DataFrame, level: int, room: int) -> tuple[int, str] | None:
    """A Bloom filter of ``keys`` as its number of words and their text; None if it needs over ``room`` bytes."""
    words = max(1, -(-keys.count() * BITS_PER_KEY // 64))
    if words * 8 > room:
        return None
    each = keys.select(F.explode(F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in _places(F.col("key"), level, words)])).alias("at"))
    set_bits = each.groupBy("at.word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at.bit"))).alias("bits"))
    # At most max_filter_bytes, in one job: an iterator over the partitions would be a job for each of them.
    held = set_bits.toArrow()
    values = np.zeros(words, dtype=np.int64)
    values[held["word"].to_numpy()] = held["bits"].to_numpy()
    return words, ",".join(map(str, values.tolist()))


def _passes(key: Column, level: int, words: int, text: str) -> Column:
    held = F.split(F.lit(text), ",").cast("array<bigint>")  # folded to one literal when the query is planned
    tests = [F.call_function("getbit", F.get(held, word), bit) == 1 for word, bit in _places(key, level, words)]
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def cascade(universe: DataFrame, listed: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> Callable[[Column], Column] | None:
    """A test for membership in ``listed (key)``, exact for every key of ``universe (key)``; None if it is too large."""
    universe = tables.written(universe.select("key").where("key IS NOT NULL").distinct())
    inside = tables.written(universe.join(listed.select("key").distinct(), "key", "left_semi"))
    outside = tables.written(universe.join(inside, "key", "left_anti"))
    levels, room = [], max_filter_bytes
    holds, others = inside, outside
    while not holds.isEmpty():
        made = _filter(holds, len(levels), room)
        if made is None:
            return None
        room -= 8 * made[0]
        passed = tables.written(others.where(_passes(F.col("key"), len(levels), *made)))
        levels.append(made)
        holds, others = passed, holds

    def member(key: Column) -> Column:
        out = F.lit(False)
        for level in reversed(range(len(levels))):
            out = _passes(key, level, *levels[level]) & ~out
        return F.coalesce(out, F.lit(False))

    return member


def _marked(rows: DataFrame, key: str, name: str, universe: DataFrame, listed: DataFrame, max_filter_bytes: int) -> DataFrame:
    """Add a flag whether ``key`` is listed: by a cascade, or by a join where that would be too large."""
    member = cascade(universe, listed, max_filter_bytes)
    if member is not None:
        return rows.withColumn(name, member(F.col(key)))
    found = listed.select(F.col("key").alias(f"{name}_key")).distinct()
    return rows.join(found, rows[key] == found[f"{name}_key"], "left").withColumn(name, F.col(f"{name}_key").isNotNull()).drop(f"{name}_key")


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(known, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """Per page: the id, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules (host, path, verdict)`` with the verdicts allow and block; ``listed (key)`` are blocked pages as host and
    path in one text.
    """
    host, path = host_and_path(tables.exactly(pages, url_column))
    rows = pages.select(tables.exactly(pages, id_column).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("page", F.concat("host", "path"))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)] or [F.lit(None).cast("string")]), lambda s: s.isNotNull())
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))
    rows = rows.withColumn("candidates", F.when(F.col("host") != "", pairs).otherwise(F.array().cast("array<string>")))
    universe = tables.written(rows.select(F.explode("candidates").alias("key")).distinct())
    keys = rules.select(F.concat("host", "path").alias("key"), "verdict")
    blocked, allowed = keys.where("verdict = 'block'"), keys.where("verdict = 'allow'")
    is_blocked, is_allowed = cascade(universe, blocked, max_filter_bytes), cascade(universe, allowed, max_filter_bytes)
    if is_blocked is None or is_allowed is None:
        rows = _ruled_by_join(rows, keys)
    else:
        tested = F.transform("candidates", lambda k: F.struct(F.length(k).alias("size"), is_blocked(k).alias("blocks"), is_allowed(k).alias("allows"), k.alias("key")))
        best = F.array_max(F.filter(tested, lambda t: t["blocks"] | t["allows"]))
        rows = rows.withColumn("best", best)
        rows = rows.withColumn("rule", F.col("best.key")).withColumn("ruled", F.when(F.col("best.blocks"), "block").when(F.col("best.allows"), "allow"))
    rows = _marked(rows, "page", "on_list", rows.select(F.col("page").alias("key")), listed, max_filter_bytes)
    verdict = F.coalesce("ruled", F.when(F.col("on_list"), "block").otherwise("allow"))
    return rows.select(F.col("id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"))


def _ruled_by_join(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The longest rule of each page for rule lists over the filter bound: distinct candidates lists meet the rules."""
    lists = rows.select("candidates").distinct()
    verdicts = keys.groupBy("key").agg(F.max("verdict").alias("ruled"))
    found = lists.select("candidates", F.explode("candidates").alias("key")).join(verdicts, "key")
    best = found.groupBy("candidates").agg(F.max(F.struct(F.length("key").alias("size"), "key", "ruled")).alias("best"))
    return rows.join(best, "candidates", "left").withColumns({"rule": F.col("best.key"), "ruled": F.col("best.ruled")})


def feed_pages(pages: DataFrame, url_column: str = "url") -> DataFrame:
    """Pages that feeds link to: host and path of every url with a utm_source."""
    host, path = host_and_path(F.col(url_column))
    return pages.where(F.col(url_column).rlike(r"[?&]utm_source=")).select(F.concat(host, path).alias("key"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = tables.table(spark, folder, "pages", "page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(pages, rules, feed_pages(pages))


OP6_SQL = f"""
WITH rules(rule_host, rule_path, ruled) AS (VALUES {", ".join(map(str, RULES))}),
     p AS (SELECT page_id, url,
                  translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
                  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
     fits AS (SELECT page_id, url, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(ruled, length(rule_host || rule_path)) AS ruled
              FROM p, rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL),
     feeds AS (SELECT DISTINCT host || path AS feed FROM p WHERE regexp_matches(url, '[?&]utm_source='))
SELECT p.page_id, host, path, rule, coalesce(ruled, CASE WHEN feed IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fits ON p.page_id = fits.page_id AND p.url = fits.url LEFT JOIN feeds ON host || path = feed
"""
