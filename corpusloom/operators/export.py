"""Training records: the five-table join and the prompt columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.documents import read_document
from corpusloom.functions.jsontext import pretty_answer
from corpusloom.functions.prompts import PROMPT_FORMATS, training_prompt
from corpusloom.schemas import CORE_EXPORT, WIDE_EXPORT


#: A slice has about so many answers or more; there are so many slices at most.
SLICE_ROWS, SLICES = 50_000, 16


def export_records(
    topics: DataFrame,
    raw_relations: DataFrame,
    parts: DataFrame,
    summaries: DataFrame,
    articles: DataFrame,
    summary_key: str = "summary_id",
    topics_variant: int | None = None,
    relations_variant: int | None = None,
) -> DataFrame:
    """``part_id`` and the six export columns, unordered.

    ``summary_key='article_id'`` reproduces the published export, which compares article ids with
    summary ids. Relation and part texts are shuffled once, by part: the joins on summaries and articles move ids of
    parts and what is found for them. An article may own a large share of all parts: a hot key of those joins is split
    at run time.
    """
    if summary_key not in ("summary_id", "article_id"):
        raise ValueError("summary_key is 'summary_id' or 'article_id'")
    if topics_variant is not None:
        topics = topics.where(F.col("topics_variant") == topics_variant)
    if relations_variant is not None:
        raw_relations = raw_relations.where(F.col("relations_variant") == relations_variant)
    keys = topics.select("part_id", F.col("article_summary_id").alias("_summary"))
    relations = raw_relations.select("part_id", "article_id", F.col("raw_relation_text").alias("extracted_relations"))
    texts = parts.select("part_id", F.col("part_text").alias("text_part"))
    general = summaries.select(F.col(summary_key).alias("_summary"), F.col("article_summary").alias("general_text_summary"))
    about = articles.select("article_id", "dataset", "abstract", "section_names")
    owners = relations.select("part_id", "article_id").distinct().join(about, "article_id").withColumnRenamed("article_id", "_owner")
    heads = keys.join(general, "_summary").join(owners, "part_id")
    # A range instead of an equality: a further key would sort the texts anew.
    joined = heads.join(relations, "part_id").where(F.col("article_id").between(F.col("_owner"), F.col("_owner"))).join(texts, "part_id")
    return joined.select("part_id", *WIDE_EXPORT.fieldNames())


def record_slices(
    topics: DataFrame,
    raw_relations: DataFrame,
    parts: DataFrame,
    summaries: DataFrame,
    articles: DataFrame,
    summary_key: str = "summary_id",
    topics_variant: int | None = None,
    relations_variant: int | None = None,
    slice_rows: int = SLICE_ROWS,
    slices: int = SLICES,
) -> list[DataFrame]:
    """``export_records`` in ranges of parts, in order: together all records, each once.

    The join of a slice shuffles the texts of its parts alone, so that its files can go before the next slice is written. The tables
    are read for every slice; stored in the order of their parts, only where the range is. Of summaries and articles each slice
    takes what lies between the smallest and the largest id that it refers to, which is few of them where ids follow each other.
    """
    counted = topics.agg(F.count("part_id"), F.percentile_approx("part_id", [i / slices for i in range(1, max(slices, 2))])).first()
    n = max(1, min(slices, -(-counted[0] // slice_rows)))
    cuts = sorted({counted[1][i * slices // n - 1] for i in range(1, n)})
    number = reduce(add, [(F.col("part_id") >= cut).cast("int") for cut in cuts], F.lit(0))

    def ends(df: DataFrame, key: str) -> dict[int, tuple]:
        return {row[0]: row[1:] for row in df.groupBy(number.alias("_slice")).agg(F.min(key), F.max(key)).collect()}

    def inside(key: str, low, high) -> Column:
        return (F.col(key) >= F.lit(low)) & (F.col(key) <= F.lit(high))

    summary_ends, article_ends = ends(topics, "article_summary_id"), ends(raw_relations, "article_id")
    found = []
    for at, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        if at not in summary_ends or at not in article_ends:
            continue

        def ranged(df: DataFrame, low=low, high=high) -> DataFrame:
            df = df if low is None else df.where(F.col("part_id") >= low)
            return df if high is None else df.where(F.col("part_id") < high)

        found.append(
            export_records(
                ranged(topics),
                ranged(raw_relations),
                ranged(parts),
                summaries.where(inside(summary_key, *summary_ends[at])),
                articles.where(inside("article_id", *article_ends[at])),
                summary_key,
                topics_variant,
                relations_variant,
            )
        )
    return found or [export_records(topics, raw_relations, parts, summaries, articles, summary_key, topics_variant, relations_variant)]


def in_part_order(records: DataFrame) -> DataFrame:
    """Records by part (a range shuffle, then a sort per partition); write the result itself, a stored copy has no order."""
    return records.orderBy("part_id")


def ordered_export(records: DataFrame) -> DataFrame:
    """The six export columns in part order."""
    return in_part_order(records).select(*WIDE_EXPORT.fieldNames())


def core_columns(records: DataFrame) -> DataFrame:
    return records.select(*CORE_EXPORT.fieldNames())


def training_prompts(records: DataFrame, *keys: str) -> DataFrame:
    """All six formats per record, one column each, in fixed order. The answer text is built once."""
    answered = records.select(
        *keys,
        F.col("general_text_summary").alias("_summary"),
        F.col("text_part").alias("_part"),
        read_document(F.col("extracted_relations")).alias("_document"),
    ).withColumn("_answer", pretty_answer(F.col("_document")))
    columns = [
        training_prompt(name, F.col("_summary"), F.col("_part"), F.col("_answer")).alias(name)
        for name in PROMPT_FORMATS
    ]
    return answered.select(*keys, *columns)


def long_prompts(prompts: DataFrame, *keys: str) -> DataFrame:
    """One row per record and format."""
    return prompts.unpivot(list(keys), list(PROMPT_FORMATS), "prompt_name", "prompt")
