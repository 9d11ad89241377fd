"""The stored tables, derived from a directory of parquet test tables.

``documents`` become the articles. Where an operator selects pending work, the stored part is given by
attributes of the data: articles with a row in ``labels`` have summaries, those of quality 1 have answers for
their full windows, English ones have part summaries, non-toxic ones of these have relation documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.functions.jsontext import serialise_document
from corpusloom.functions.prompts import render_template
from corpusloom.functions.text import PatternTokenizer, window_count
from corpusloom.operators import graph, ingest
from corpusloom.operators.repair import accepted, repair_answers
from corpusloom.plans.sample_answers import SHAPES
from corpusloom.session import shuffles_removed, written

CHUNK_SIZE, CHUNK_OVERLAP = 64, 16
TOKENIZER = PatternTokenizer()


def with_raw_answer(windows: DataFrame) -> DataFrame:
    """Add ``part_topics``: an answer in one of the sample shapes, filled from the whole part."""

    def name(position: int) -> Column:
        token = F.coalesce(F.get("_tokens", F.lit(position)), F.lit(""))
        return F.concat(F.lit(f"e{position + 1}"), F.regexp_replace(token, "[^A-Za-z0-9]", ""))

    filler = F.repeat(F.lit("x"), F.greatest(F.lit(220) - F.length("_plain"), F.lit(0)))
    filled = (
        windows.withColumn("_tokens", F.split("part_text", " ", 4))
        .withColumn("_plain", F.regexp_replace("part_text", r'["\\\[\]{}]+', ""))
        .withColumns({"D": F.concat("_plain", filler), "a": name(0), "b": name(1), "c": name(2)})
    )
    places = {place: F.col(place) for place in "Dabc"}
    shape = F.pmod(F.col("article_id") + F.col("part_no"), F.lit(len(SHAPES)))
    answer = F.when(F.lit(False), F.lit(""))
    for number, template in enumerate(SHAPES):
        answer = answer.when(shape == number, render_template(template, **places))
    return filled.select(*windows.columns, answer.alias("part_topics"))


@dataclass(frozen=True)
class SampleTables:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stored(self, rows: DataFrame) -> DataFrame:
        """Rows as a stored table: written once, packed, read where needed."""
        with shuffles_removed(self.spark):
            return written(rows, compression="zstd")

    def _dealt(self, ranges: bool = False) -> DataFrame:
        c = F.col
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = self.table("documents").select("doc_id", "text", F.substring_index("text", "\n", 1).alias("abstract"), "source", "lang")
        dealt = rows.repartitionByRange(tasks, "doc_id") if ranges else rows.repartition(tasks, "doc_id")
        return dealt.select(
            c("doc_id").alias("article_id"),
            c("text").alias("article"),
            "abstract",
            F.concat(F.lit("intro\n"), c("source"), F.lit("\n"), c("lang")).alias("section_names"),
            c("lang").alias("dataset"),
        )

    @cached_property
    def source(self) -> DataFrame:
        """Source articles; the first line of a text is its abstract.

        A test table is one row group, which no scan can split, so its rows are dealt to the session's partitions. Abstracts
        are cut before that, so that no text is moved where only its abstract is read.
        """
        return self._dealt()

    @cached_property
    def articles(self) -> DataFrame:
        return self.source.select("article_id", "dataset", "abstract", "section_names")

    @cached_property
    def windows(self) -> DataFrame:
        """``(article_id, part_no, part_id, part_text)`` of every article; every file has a range of articles, so that a range of parts is in few files."""
        return self.stored(ingest.article_parts(self._dealt(ranges=True), CHUNK_SIZE, CHUNK_OVERLAP, TOKENIZER))

    @cached_property
    def parts(self) -> DataFrame:
        return self.windows.select("part_id", "part_text")

    @cached_property
    def part_counts(self) -> DataFrame:
        tokens = self.source.select("article_id", TOKENIZER.count(F.col("article")).alias("_n"))
        return tokens.select("article_id", window_count(F.col("_n"), CHUNK_SIZE, CHUNK_OVERLAP).alias("n_parts"))

    @cached_property
    def register(self) -> DataFrame:
        return self.stored(ingest.number_parts(self.part_counts, CHUNK_SIZE, CHUNK_OVERLAP))

    def _summary(self, articles: DataFrame, variant: int) -> DataFrame:
        return articles.select(
            "article_id",
            F.concat(F.lit("Summary: "), "abstract").alias("article_summary"),
            F.lit(variant).alias("summary_variant"),
            ids.variant_id(F.col("article_id"), variant).alias("summary_id"),
        )

    @cached_property
    def labels(self) -> DataFrame:
        return self.table("labels").withColumnRenamed("doc_id", "article_id")

    @cached_property
    def summaries(self) -> DataFrame:
        """Variant 0 for labelled articles, variant 1 for those of quality 1."""
        labelled = self.articles.join(self.labels, "article_id")
        return self._summary(labelled, 0).unionByName(self._summary(labelled.where("quality = 1"), 1))

    @cached_property
    def all_summaries(self) -> DataFrame:
        return self._summary(self.articles, 0)

    def _answers(self, windows: DataFrame) -> DataFrame:
        c = F.col
        return with_raw_answer(windows).select(
            "article_id",
            "part_id",
            "part_topics",
            F.lit(0).alias("topics_variant"),
            ids.variant_id(c("part_id"), 0).alias("topics_id"),
            ids.variant_id(c("article_id"), 0).alias("article_summary_id"),
        )

    @cached_property
    def all_answers(self) -> DataFrame:
        """An answer for every part of every article."""
        return self._answers(self.windows)

    @cached_property
    def repaired(self) -> DataFrame:
        return repair_answers(self.all_answers)

    @cached_property
    def _stored_answers(self) -> DataFrame:
        full = self.windows.where(TOKENIZER.count(F.col("part_text")) == CHUNK_SIZE)
        return self.stored(self._answers(full.join(self.labels.where("quality = 1").select("article_id"), "article_id")))

    @cached_property
    def topics(self) -> DataFrame:
        return self._stored_answers.drop("article_id")

    @cached_property
    def _stored_documents(self) -> DataFrame:
        english = self.articles.where("dataset = 'en'").select("article_id")
        return self.stored(accepted(repair_answers(self._stored_answers.join(english, "article_id"))))

    @cached_property
    def part_summaries(self) -> DataFrame:
        return self._stored_documents.select(
            "part_id",
            F.col("document.section_description").alias("part_summary"),
            F.lit(0).alias("summary_variant"),
            ids.variant_id(F.col("part_id"), 0).alias("summary_id"),
            "article_summary_id",
        )

    def _raw(self, documents: DataFrame) -> DataFrame:
        return documents.select(
            "article_id",
            "part_id",
            ids.variant_id(F.col("part_id"), 0).alias("part_summary_id"),
            F.col("topics_id").alias("part_topics_id"),
            "article_summary_id",
            ids.variant_id(F.col("topics_id"), 0).alias("relation_id"),
            serialise_document(F.col("document")).alias("raw_relation_text"),
            F.lit(0).alias("relations_variant"),
        )

    @cached_property
    def raw_relations(self) -> DataFrame:
        harmless = self.labels.where("toxic = 0").select("article_id")
        return self._raw(self._stored_documents.join(harmless, "article_id"))

    @cached_property
    def all_relations(self) -> DataFrame:
        """Relation documents of every accepted answer."""
        return self.stored(self._raw(accepted(self.repaired)))

    @cached_property
    def content(self) -> dict[str, DataFrame]:
        """The nine tables. Answers, nodes and edges are those of all articles, so some refer to rows not stored."""
        return {
            "articles": self.articles,
            "article_part_register": self.register.withColumns({n: F.col(n).cast("int") for n in ("chunk_size", "chunk_overlap")}),
            "article_parts": self.parts,
            "short_article_summary": self.summaries,
            "short_part_summary": self.part_summaries,
            "extracted_part_topics": self.stored(self.all_answers.drop("article_id")),
            "extracted_relations_raw": self.raw_relations,
            "relation_objects": self.stored(self.nodes),
            "relations": self.stored(self.edges),
        }

    @cached_property
    def placed(self) -> DataFrame:
        return graph.placed_documents(self.all_relations)

    @cached_property
    def nodes(self) -> DataFrame:
        return graph.entity_nodes(self.placed)

    @cached_property
    def edges(self) -> DataFrame:
        return graph.relation_edges(self.placed)
