"""URL filters against sets."""

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import tables, url_filter

URLS = [
    None, "", "no scheme/x", "://", "http://EXAMPLE.org/es/1", "http://a.example.org/en/123", "http://org/", "http://xorg/", "https://b.com/fr/", "https://b.com/de/x#y",
    "https://b.net/p?utm_source=1", "https://b.net/p", "https://b.net/q?x=1", "http://example.org", "http://x.org?/es/", "http://É.org/É", "a://b://c.org/", "http://b.net/p", "https://com/de/",
]


def expected(urls, rules, listed):
    out = []
    for i, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[2:] if fits else (None, "block" if host + path in listed else "allow")
        out.append((i, host, path, rule, verdict))
    return out


@pytest.mark.parametrize("room", [1 << 20, 8])
def test_verdicts(spark, room):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("key", F.lit(1))
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    got = url_filter.filter_urls(pages, rules, url_filter.feed_pages(pages), max_filter_bytes=room).collect()
    assert sorted(map(tuple, got)) == expected(URLS, url_filter.RULES, {"b.net/p"})


def test_cascade_is_exact(spark):
    """Two bits a key let many keys through, so several levels are needed."""
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("cast(key as int) % 7 = 0").union(spark.createDataFrame([("not there",)], "key string"))
    url_filter.BITS_PER_KEY, before = 2, url_filter.BITS_PER_KEY
    try:
        member = url_filter.cascade(universe, listed)
    finally:
        url_filter.BITS_PER_KEY = before
    assert sorted(int(r.key) for r in universe.where(member(F.col("key"))).collect()) == list(range(0, 20_000, 7))


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.filter_urls(pages, rules, url_filter.feed_pages(pages)).collect() == []


def test_a_filter_takes_as_many_jobs_for_any_number_of_partitions(spark):
    """Over many partitions, a job for each of them took most of the time."""
    keys = tables.written(spark.range(3_000).select(F.col("id").cast("string").alias("key")))
    held = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    made, jobs = [], []
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for partitions in (2, 40):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            group = f"filter over {partitions}"
            spark.sparkContext.setJobGroup(group, group)
            made.append(url_filter._filter(keys, 0, 1 << 20))
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in held.items():
            spark.conf.set(name, value)
    assert made[0] == made[1] and jobs[0] == jobs[1] > 0
