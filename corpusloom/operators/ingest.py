"""Articles and their parts: new rows only, cleaned, cut, numbered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.functions.text import PatternTokenizer, chunk_articles, strip_nul
from corpusloom.operators.ordinals import exclusive_prefix_sum


def clean_articles(df: DataFrame) -> DataFrame:
    """Remove NUL characters from the three text columns."""
    texts = {name: strip_nul(F.col(name)) for name in ("article", "abstract", "section_names")}
    return df.withColumns(texts)


def next_value(df: DataFrame, column: str, out: str, where: Column | None = None) -> DataFrame:
    """One row: one more than the largest stored value, 0 if there is none."""
    rows = df if where is None else df.where(where)
    return rows.agg(F.coalesce(F.max(column) + 1, F.lit(0)).cast("long").alias(out))


def resume_watermark(
    articles: DataFrame, register: DataFrame, dataset: str, chunk_size: int, chunk_overlap: int
) -> DataFrame:
    """One row with ``next_article_id`` of a dataset and ``next_part_index`` of a chunk configuration."""
    config = (F.col("chunk_size") == chunk_size) & (F.col("chunk_overlap") == chunk_overlap)
    part = next_value(register, "part_index", "next_part_index", config)
    article = next_value(articles, "article_id", "next_article_id", F.col("dataset") == dataset)
    return article.withColumn("next_part_index", part.scalar())


def resume_after(source: DataFrame, articles: DataFrame, dataset: str) -> DataFrame:
    """Source rows past the largest stored article id of the dataset.

    The watermark is fetched first, as one number, so that the scan can skip row groups below it.
    """
    start = next_value(articles, "article_id", "start", F.col("dataset") == dataset).first()["start"]
    return source.where(F.col("article_id") >= start)


def not_yet_inserted(source: DataFrame, articles: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Source rows whose key is not stored; one join for the whole batch."""
    names = key or ["article_id"]
    return source.join(articles.select(*names), names, "left_anti")


def drop_empty_articles(
    df: DataFrame, text: str = "article", tokenizer: PatternTokenizer = PatternTokenizer()
) -> DataFrame:
    """Articles with at least one token; ids were given before, so gaps remain."""
    return df.where(F.col(text).rlike(tokenizer.pattern))


def number_parts(
    counts: DataFrame, chunk_size: int, chunk_overlap: int, start: Column | int = 0, config_no: int = 0
) -> DataFrame:
    """Register rows from ``(article_id, n_parts)``: ``part_index`` runs on across articles.

    Only the counts are shuffled and summed; the texts stay where they are, because ``part_id`` is a
    function of article and position.
    """
    begin = start if isinstance(start, Column) else F.lit(start)
    placed = exclusive_prefix_sum(counts, ["article_id"], F.col("n_parts"), "_offset")
    positions = placed.where(F.col("n_parts") > 0).select(
        "article_id", "_offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1)).alias("_no")
    )
    return positions.select(
        (F.col("_offset") + F.col("_no") + begin).alias("part_index"),
        F.lit(chunk_size).alias("chunk_size"),
        F.lit(chunk_overlap).alias("chunk_overlap"),
        "article_id",
        ids.part_id(F.col("article_id"), F.col("_no"), config_no).alias("part_id"),
    )


def article_parts(
    articles: DataFrame,
    chunk_size: int = 1024,
    chunk_overlap: int = 256,
    tokenizer=PatternTokenizer(),
    drop_covered_tail: bool = False,
    config_no: int = 0,
) -> DataFrame:
    """``(article_id, part_no, part_id, part_text)`` of every window, without a shuffle."""
    parts = chunk_articles(
        articles.select("article_id", "article"), "article", chunk_size, chunk_overlap, tokenizer, drop_covered_tail
    )
    part_id = ids.part_id(F.col("article_id"), F.col("part_no"), config_no)
    return parts.select("article_id", F.col("part_no").cast("long").alias("part_no"), part_id.alias("part_id"), "part_text")


def part_range(register: DataFrame) -> DataFrame:
    """Smallest and largest part index per article."""
    return register.groupBy("article_id").agg(
        F.min("part_index").alias("min_part_index"), F.max("part_index").alias("max_part_index")
    )


def in_index_ranges(register: DataFrame, ranges: DataFrame, chunk_size: int, chunk_overlap: int) -> DataFrame:
    """Register rows of a chunk configuration whose part index lies in the closed range of their article."""
    config = (F.col("chunk_size") == chunk_size) & (F.col("chunk_overlap") == chunk_overlap)
    inside = F.col("part_index").between(F.col("min_part_index"), F.col("max_part_index"))
    return register.where(config).join(ranges, "article_id").where(inside).select(*register.columns)


def index_to_id(indexed_texts: DataFrame, register: DataFrame) -> DataFrame:
    """``(part_id, part_text)`` of texts that are addressed by their natural key."""
    key = ["article_id", "chunk_size", "chunk_overlap", "part_index"]
    return indexed_texts.join(register.select(*key, "part_id"), key, "inner").select("part_id", "part_text")
