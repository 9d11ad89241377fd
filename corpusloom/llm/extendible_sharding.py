"""Shards by extendible hashing, in DataFrame operations only.

A row's key hash is 60 bits. The directory is indexed by a prefix of them; a bucket over the byte limit splits on
its next bit, others keep their depth. Instead of splitting one bit at a time, bytes are counted once per prefix of
``bits`` bits (about eight times as many prefixes as shards), rolled up to all shorter prefixes, and every prefix
takes the shallowest depth at which its bucket fits. Only prefixes that are still too large are counted again, deeper.
The directory is as large as the number of shards and joins the rows by prefix; what is shuffled is ids and sizes.

A bucket of one single hash cannot split (a repeated id, or one text over the limit). Its rows go to numbered pages
that each fit the limit, counted in runs of rows, so that an id with a third of all rows does not meet in one task. For them
rows are numbered where they are read, so pass a stored table.

Defined cases: null texts have 0 bytes, a null id has the key ''. A single text over the limit is a page of its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import tables

HASH_BITS = 60
LIMIT_BYTES = 1 << 20
_RUN_PAGES = 1000


def key_hash(key: Column) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def _prefix(bits: Column | int) -> Column:
    shift = F.lit(HASH_BITS) - (bits if isinstance(bits, Column) else F.lit(bits))
    return F.call_function("shiftright", F.col("h"), shift.cast("int"))


def _directory(live: DataFrame, least: int, bits: int, limit: int) -> DataFrame:
    """For each prefix of ``bits`` bits: its bucket's depth and bytes, null if it has to split further."""
    sizes = live.groupBy(_prefix(bits).alias("prefix")).agg(F.sum("n_bytes").alias("bytes"), F.min("h").alias("low"), F.max("h").alias("high"))
    sizes = tables.written(sizes)
    every = sizes.withColumn("depth", F.explode(F.sequence(F.lit(least), F.lit(bits))))
    of = F.call_function("shiftright", F.col("prefix"), (F.lit(bits) - F.col("depth")).cast("int"))
    buckets = every.groupBy("depth", of.alias("bucket")).agg(F.sum("bytes").alias("bucket_bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
    fits = buckets.where((F.col("bucket_bytes") <= limit) | (F.col("low") == F.col("high"))).select("depth", "bucket", "bucket_bytes")
    placed = every.select("prefix", "depth", of.alias("bucket")).join(fits, ["depth", "bucket"])
    first = placed.groupBy("prefix").agg(F.min_by(F.struct("depth", "bucket_bytes"), "depth").alias("at"))
    return tables.written(sizes.select("prefix").join(first, "prefix", "left"))


def extendible_shards(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit_bytes: int = LIMIT_BYTES, keep: Sequence[str] = ()) -> DataFrame:
    """Per row the id, the ``keep`` columns, ``n_bytes``, ``shard`` (the hash prefix as bits), ``page``, ``depth``, ``bucket_bytes``.

    A shard's file is the rows of one ``(shard, page)``; keep the text to write them with ``partitionBy``.
    """
    key = tables.exactly(docs, id_column)
    n_bytes = F.coalesce(F.octet_length(tables.exactly(docs, text_column)), F.lit(0)).cast("long")
    # A row's number in the scan, taken before anything is shuffled: a task that runs again gives the same ones.
    row = F.monotonically_increasing_id().alias("row")
    rows = docs.select(key.alias("id"), n_bytes.alias("n_bytes"), key_hash(key).alias("h"), row, tables.carried(docs, keep))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    least, bits = 0, min(HASH_BITS, max(1, math.ceil(math.log2(max(1, total / limit_bytes)))) + 3)
    live, placed = rows.select("h", "n_bytes"), rows.withColumn("at", F.lit(None).cast("struct<depth:int,bucket_bytes:bigint>"))
    while True:
        directory = _directory(live, least, bits, limit_bytes)
        found = directory.where(F.col("at").isNotNull()).select(F.col("prefix").alias("of"), F.col("at").alias("new"))
        placed = placed.join(found, _prefix(bits) == F.col("of"), "left").withColumn("at", F.coalesce("at", "new")).drop("of", "new")
        split = directory.where(F.col("at").isNull()).select(F.col("prefix").alias("of"))
        if split.isEmpty():
            break
        live = live.join(split, _prefix(bits) == F.col("of"), "left_semi")
        least, bits = bits + 1, min(HASH_BITS, bits + 8)
    shard = F.when(F.col("at.depth") == 0, F.lit("")).otherwise(F.lpad(F.bin(_prefix(F.col("at.depth"))), F.col("at.depth"), F.lit("0")))
    paged = _pages(placed, limit_bytes)
    own = {id_column, "n_bytes", "shard", "page", "depth", "bucket_bytes"}
    return paged.select(
        F.col("id").alias(id_column), *tables.released(keep, own), "n_bytes", shard.alias("shard"), "page", F.col("at.depth").alias("depth"), F.col("at.bucket_bytes").alias("bucket_bytes")
    )


def _pages(placed: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets that cannot split, in pages up to the limit; page 0 for all others.

    Small rows (an eighth of the limit at most) fill pages to seven eighths before the last one of a page, middle ones (up to half)
    to a half, and each larger row is a page: a large text leaves the pages of the others as full as they are.
    """
    over = F.col("at.bucket_bytes") > limit
    runs = F.ceil(F.col("at.bucket_bytes") / F.lit(limit * _RUN_PAGES)).cast("long")
    kind = F.when(F.col("n_bytes") <= limit // 8, 0).when(F.col("n_bytes") <= limit // 2, 1).otherwise(2)
    some = placed.where(over).withColumns({"run": F.pmod("row", runs), "kind": kind})
    run = Window.partitionBy("h", "run", "kind").orderBy("n_bytes", "row")
    before = F.coalesce(F.sum("n_bytes").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.when(F.col("kind") == 0, F.floor(before / max(1, limit - limit // 8))).when(F.col("kind") == 1, F.floor(before / max(1, limit - limit // 2))).otherwise(F.row_number().over(run) - 1)
    page = (F.col("run") * F.lit(2**40) + number) * 3 + F.col("kind")
    return placed.where(~over).withColumn("page", F.lit(0).cast("long")).unionByName(some.withColumn("page", page.cast("long")).drop("run", "kind"))


def op9_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return extendible_shards(tables.table(spark, folder, "documents", "doc_id", "text"))


OP9_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
     depths AS (SELECT range AS depth FROM range({HASH_BITS + 1})),
     buckets AS (SELECT depth, h >> ({HASH_BITS} - depth) AS bucket, sum(n_bytes)::BIGINT AS bucket_bytes, min(h) = max(h) AS single
                 FROM d, depths GROUP BY ALL),
     fits AS (SELECT * FROM buckets WHERE bucket_bytes <= {LIMIT_BYTES} OR single),
     placed AS (SELECT h, min(fits.depth) AS depth FROM (SELECT DISTINCT h FROM d), fits
                WHERE h >> ({HASH_BITS} - fits.depth) = bucket GROUP BY h)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> ({HASH_BITS} - depth)), depth::INTEGER, '0') END AS shard,
       0::BIGINT AS page, depth::INTEGER AS depth, bucket_bytes
FROM d JOIN placed USING (h) JOIN fits USING (depth) WHERE bucket = h >> ({HASH_BITS} - depth)
"""
