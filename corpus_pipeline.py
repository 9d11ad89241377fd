"""From raw documents to packed token sequences: five stages, each a written table before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import best_fit_packing, decontamination, quality_classifier, simhash_neardup, substring_dedup, tables

#: Repeats of at least so many words go; shorter ones are ordinary language in a corpus.
REPEAT_WORDS = 50


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    labels = tables.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return quality_classifier.classify(docs, labels, keep=docs.columns).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints, that of the smallest id."""
    return simhash_neardup.one_of_each(docs, shingle=simhash_neardup.SHINGLE, distance=simhash_neardup.DISTANCE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that one of smaller id has."""
    kept = substring_dedup.substring_dedup(docs, window=REPEAT_WORDS, keep=[name for name in docs.columns if name not in ("text", "n_chars")])
    new = {"text": F.col("kept_text").alias("text"), "n_chars": F.length("kept_text").cast("long").alias("n_chars")}
    return kept.select(*[new.get(name, F.col(name)) for name in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontamination.decontaminate(docs, tables.table(spark, sf_dir, "benchmark", "item_id", "text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return best_fit_packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_neardup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", decontaminated),
    ("best_fit_packing", packed),
]

#: The classifier, fingerprints and packing have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents", "*")
    for _, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
