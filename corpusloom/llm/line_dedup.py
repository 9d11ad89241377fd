"""Reversible line dedup: exact reference counts of lines, and a cuckoo filter per shard in front of them.

An index is four stored tables, which grow by insertions and deletions and are never rewritten:

* ``postings (doc_id, key)``: the distinct keys of each document that is inserted; ``gone (doc_id, version)`` ends them.
* ``references (key, shard, version, n_docs, largest)``: in how many documents a key is, and the largest of these. Of
  several rows of a key that of the latest version counts; ``n_docs`` 0 means that the key is gone.
* ``filters (shard, version, n_keys, held)``: a cuckoo filter of the keys that have references, per shard of keys.

An insertion counts its keys, pre-aggregated per task, and asks each shard's filter for them: keys that the filter does
not know are new and are never looked up; only the others meet the exact table. New keys go into the filters.
A deletion counts the keys of its documents again from the postings that remain, and takes keys without a document out
of the filters. A shard's filter is one row, and the number of shards follows the
number of keys, so that a shard has about ``shard_keys`` keys at most. A key in a third of all documents is one row in its shard.

Every call returns a new index and leaves the old one as it was, so a call that stops leaves nothing half done.

Defined cases: a null or empty text is one empty line. Rows that repeat a doc_id belong to one document. A null id is one
document, larger than all others. A key is a line stripped of ASCII blanks with A-Z lower-cased, known by 128 bits of SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm import scans, tables
from corpusloom.llm.bytewords import text_slices
from corpusloom.llm.cuckoo import CuckooFilter

LEAST_LENGTH, LEAST_DOCS = 20, 3
SHARD_KEYS = 500_000
_BLANKS = " \t\n\x0b\x0c\r"
_FILTER = T.StructType(
    [T.StructField("shard", T.IntegerType()), T.StructField("version", T.IntegerType()), T.StructField("n_keys", T.LongType()), T.StructField("held", T.BinaryType())]
)
_ASKED = T.StructType([T.StructField("key", T.BinaryType())])
_REFERENCE = "key binary, shard int, version int, n_docs long, largest long"
_NO_ID = 2**63 - 1


def line_key(line: str, least: int = LEAST_LENGTH) -> bytes | None:
    """The key of a line; none if it is shorter than ``least`` code points."""
    import hashlib

    found = line.strip(_BLANKS)
    return hashlib.sha256(found.encode().lower()).digest()[:16] if len(found) >= least else None  # lower() of bytes is A-Z only


def _hashes(keys: pa.Array) -> np.ndarray:
    """64 bits of each key for its filter; the shard uses others."""
    return np.frombuffer(b"".join(key[:8] for key in keys.to_pylist()), dtype="<u8")


def _shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


@dataclass(frozen=True)
class LineIndex:
    """An index of lines; ``create`` makes an empty one."""

    spark: SparkSession
    postings: DataFrame
    gone: DataFrame
    references: DataFrame
    filters: DataFrame
    shards: int = 1
    version: int = 0
    least_length: int = LEAST_LENGTH
    shard_keys: int = SHARD_KEYS

    @classmethod
    def create(cls, spark: SparkSession, least_length: int = LEAST_LENGTH, shard_keys: int = SHARD_KEYS) -> LineIndex:
        postings = spark.createDataFrame([], "doc_id long, key binary, version int")
        gone, references = spark.createDataFrame([], "doc_id long, version int"), spark.createDataFrame([], _REFERENCE)
        return cls(spark, postings, gone, references, spark.createDataFrame([], _FILTER), least_length=least_length, shard_keys=shard_keys)

    # Reading

    def current(self) -> DataFrame:
        """``(key, n_docs, largest)`` of every key with a document."""
        latest = self.references.groupBy("key").agg(F.max(F.struct("version", "n_docs", "largest")).alias("r"))
        return latest.select("key", "r.n_docs", "r.largest").where("n_docs > 0")

    def live(self) -> DataFrame:
        """``(doc_id, key)`` of the documents that are in the index."""
        ends = self.gone.groupBy("doc_id").agg(F.max("version").alias("ended"))
        return self.postings.join(ends, "doc_id", "left").where("ended IS NULL OR version > ended").select("doc_id", "key")

    def _last_filters(self) -> DataFrame:
        return self.filters.groupBy("shard").agg(F.max(F.struct("version", "n_keys", "held")).alias("f")).select("shard", "f.n_keys", "f.held")

    # Writing

    def insert(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> LineIndex:
        """The index with the documents of ``docs``. A document whose lines are in the index already must be deleted first."""
        version = self.version + 1
        postings = tables.written(self._postings(docs, id_column, text_column).withColumn("version", F.lit(version)))
        if self.version and not postings.join(self.live(), "doc_id", "left_semi").isEmpty():
            raise ValueError("a document is in the index already; delete it first")
        once = postings.select("key", "doc_id").distinct()
        counted = tables.written(once.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("largest")))
        index = self._resharded(counted)
        counted = counted.select("*", _shard(index.shards))
        known = index._known(counted).select("key", F.col("n_docs").alias("before"), F.col("largest").alias("largest_before"))
        merged = counted.join(known, "key", "left").select(
            "key",
            "shard",
            F.lit(version).alias("version"),
            (F.col("n_docs") + F.coalesce("before", F.lit(0))).alias("n_docs"),
            F.greatest("largest", "largest_before").alias("largest"),
            F.col("before").isNull().alias("new"),
        )
        merged = tables.written(merged)
        filters = index._changed(merged.where("new"), version, insert=True)
        return replace(
            index,
            postings=index.postings.unionByName(postings),
            references=index.references.unionByName(merged.drop("new")),
            filters=index.filters.unionByName(filters),
            version=version,
        )

    def delete(self, ids: DataFrame, id_column: str = "doc_id") -> LineIndex:
        """The index without the documents of these ids; ids that it does not have change nothing."""
        version = self.version + 1
        ids = tables.written(ids.select(F.coalesce(tables.exactly(ids, id_column).cast("long"), F.lit(_NO_ID)).alias("doc_id")).distinct().withColumn("version", F.lit(version)))
        live = self.live()
        touched = tables.written(live.join(ids.select("doc_id"), "doc_id", "left_semi").select("key").distinct())
        remains = live.join(ids.select("doc_id"), "doc_id", "left_anti").join(touched, "key", "left_semi").distinct()
        left = remains.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("largest"))
        changed = touched.join(left, "key", "left").select(
            "key", _shard(self.shards), F.lit(version).alias("version"), F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"), "largest"
        )
        changed = tables.written(changed)
        filters = self._changed(changed.where("n_docs = 0"), version, insert=False)
        return replace(
            self, gone=self.gone.unionByName(ids), references=self.references.unionByName(changed), filters=self.filters.unionByName(filters), version=version
        )

    def _postings(self, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
        least = self.least_length

        def keys(rows: pa.RecordBatch) -> list:
            found = [list({key: None for line in (text or "").split("\n") if (key := line_key(line, least))}) for text in rows.column("text").to_pylist()]
            return [pa.array(found, pa.list_(pa.binary()))]

        made = scans.with_columns(docs, keys, T.StructType([T.StructField("keys", T.ArrayType(T.BinaryType()))]), id_column, text_column)
        return made.select(F.coalesce(tables.exactly(made, id_column), F.lit(_NO_ID)).alias("doc_id"), F.explode("keys").alias("key"))

    def _resharded(self, more: DataFrame) -> LineIndex:
        """The index with shards for its keys and as many more; filters are built anew if their number changes."""
        stored = self._last_filters().agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0]
        needed = -(-(more.count() + stored) // self.shard_keys)
        if needed <= self.shards:
            return self
        index = replace(self, shards=1 << int(needed - 1).bit_length(), filters=self.spark.createDataFrame([], _FILTER))
        return replace(index, filters=index._changed(self.current().select("key", _shard(index.shards)), self.version, insert=True))

    def _known(self, keys: DataFrame) -> DataFrame:
        """``(key, n_docs, largest)`` of the keys that are in the index: the filters say which ones may be."""

        def ask(shard: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
            if not held.num_rows or not asked.num_rows:
                return pa.table({"key": pa.array([], pa.binary())})
            key = asked.column("key").combine_chunks()
            known = CuckooFilter.from_bytes(held.column("held")[0].as_py()).contains(_hashes(key))
            return pa.table({"key": key.filter(pa.array(known))})

        asked = keys.select("key", "shard").groupBy("shard").cogroup(self._last_filters().groupBy("shard")).applyInArrow(ask, _ASKED)
        return self.current().join(asked, "key", "left_semi") if self.version else self.current()

    def _changed(self, keys: DataFrame, version: int, insert: bool) -> DataFrame:
        """The filters of the shards of these keys with them, or without them, as a written table."""
        schema, size = to_arrow_schema(_FILTER), self.shard_keys

        def change(shard: tuple, keys: pa.Table, before: pa.Table) -> pa.Table:
            if not keys.num_rows:
                return schema.empty_table()
            hashes = _hashes(keys.column("key").combine_chunks())
            held = CuckooFilter.from_bytes(before.column("held")[0].as_py()) if before.num_rows else CuckooFilter.of_size(size)
            if insert:
                held.insert(hashes)
            else:
                held.delete(hashes)
            return pa.table([[shard[0].as_py()], [version], [held.held], [held.to_bytes()]], schema=schema)

        groups = keys.select("key", "shard").groupBy("shard").cogroup(self._last_filters().groupBy("shard"))
        return tables.written(groups.applyInArrow(change, _FILTER))

    # Dedup

    def dropped(self, least_docs: int = LEAST_DOCS) -> DataFrame:
        """``(doc_id, key)`` of the lines that documents lose: keys in ``least_docs`` documents stay in the largest only."""
        heavy = self.current().where(F.col("n_docs") >= least_docs).select("key", "largest")
        return self.live().join(heavy, "key").where("doc_id <> largest").select("doc_id", "key")

    def dedup(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_docs: int = LEAST_DOCS, keep: Sequence[str] = ()) -> DataFrame:
        """Per row of ``docs``: the id, the ``keep`` columns, ``kept_text``, ``n_lines`` and ``n_dropped``.

        Documents that are not in the index keep all their lines. Texts are shuffled once, to their dropped keys.
        """
        least = self.least_length
        names = [name for name in keep if name != id_column]
        given = docs.select(
            tables.exactly(docs, id_column).cast("long").alias("id"),
            F.coalesce(tables.exactly(docs, id_column).cast("long"), F.lit(_NO_ID)).alias("doc_id"),
            tables.exactly(docs, text_column).alias("text"),
            tables.carried(docs, names),
        )
        lost = self.dropped(least_docs).groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
        joined = given.join(lost, "doc_id", "left").select("id", "text", "carried", "keys")
        schema = T.StructType(
            [joined.schema["id"], joined.schema["carried"], T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
        )
        arrow = to_arrow_schema(schema)

        def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in text_slices(batch, "text"):
                    texts, n_lines, n_dropped = [], [], []
                    for text, keys in zip(rows.column("text").to_pylist(), rows.column("keys").to_pylist(), strict=True):
                        lines = (text or "").split("\n")
                        stay = lines
                        if keys:
                            gone = set(keys)
                            stay = [line for line in lines if line_key(line, least) not in gone]
                        texts.append("\n".join(stay))
                        n_lines.append(len(lines))
                        n_dropped.append(len(lines) - len(stay))
                    columns = [rows.column("id"), rows.column("carried").cast(arrow.field("carried").type), pa.array(texts, arrow.field("kept_text").type), n_lines, n_dropped]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) if isinstance(c, list) else c for c in columns], schema=arrow)

        made = joined.mapInArrow(rewrite, schema)
        outputs = {id_column, "kept_text", "n_lines", "n_dropped"}
        released = [column for column, name in zip(tables.released(names), names, strict=True) if name not in outputs]
        return made.select(F.col("id").alias(id_column), *released, "kept_text", "n_lines", "n_dropped")


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.table(spark, folder, "documents", "doc_id", "text")
    kept = LineIndex.create(spark).insert(docs).dedup(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP13_SQL = """
WITH split AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     keyed AS (SELECT row, doc_id, lines, list_transform(lines, lambda line: translate(
         trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS keys FROM split),
     held AS (SELECT DISTINCT doc_id, key FROM (SELECT doc_id, unnest(keys) AS key FROM keyed) WHERE length(key) >= 20),
     heavy AS (SELECT key, max(doc_id) AS largest FROM held GROUP BY key HAVING count(*) >= 3),
     lost AS (SELECT doc_id, list(key) AS gone FROM held JOIN heavy USING (key) WHERE doc_id <> largest GROUP BY doc_id),
     kept AS (SELECT doc_id, lines, [line FOR line, i IN lines IF NOT list_contains(coalesce(gone, []), keys[i])] AS stay
              FROM keyed LEFT JOIN lost USING (doc_id))
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - len(stay))::BIGINT AS n_dropped, sha256(array_to_string(stay, chr(10))) AS kept_sha256
FROM kept
"""
