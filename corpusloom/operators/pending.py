"""Work selection: which rows still lack an output. All of it is equi joins and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.operators.ordinals import first_n


def of_variant(df: DataFrame, column: str, variant: int) -> DataFrame:
    return df.where(F.col(column) == variant)


def below_id(df: DataFrame, column: str, bound: int) -> DataFrame:
    return df.where(F.col(column) < bound)


def pending_articles(
    articles: DataFrame, summaries: DataFrame, summary_variant: int, amount_to_process: int
) -> DataFrame:
    """Articles below an id bound without a summary of the variant, the first that many in id order.

    Ids are selected and limited before they meet the texts of their articles.
    """
    done = of_variant(summaries, "summary_variant", summary_variant).select("article_id")
    wanted = below_id(articles, "article_id", amount_to_process)
    todo = wanted.select("article_id").join(done, "article_id", "left_anti")
    chosen = first_n(todo, ["article_id"], amount_to_process)
    return wanted.select("article_id", "abstract", "section_names").join(chosen, "article_id", "left_semi")


def part_summary_feed(register: DataFrame, parts: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every part with every summary of its article. The texts of parts come last and are shuffled once, by part."""
    summarised = summaries.select("article_id", "summary_id", "article_summary")
    return (
        register.select("part_id", "article_id")
        .join(summarised, "article_id")
        .join(parts.select("part_id", "part_text"), "part_id")
        .select("summary_id", "part_id", "part_text", "article_summary")
    )


def processed_keys(topics: DataFrame, column: str) -> DataFrame:
    return topics.select(column).distinct()


def pending_part_keys(
    register: DataFrame, summaries: DataFrame, topics: DataFrame, granularity: str = "article"
) -> DataFrame:
    """``(summary_id, part_id)`` still to process, keys only, no texts.

    ``granularity='article'`` leaves out summaries with any processed part, ``'part'`` only the processed
    parts themselves, so that an interrupted article is completed.
    """
    summarised = summaries.select("article_id", "summary_id")
    pairs = register.select("part_id", "article_id").join(summarised, "article_id").select("summary_id", "part_id")
    if granularity == "article":
        done = processed_keys(topics, "article_summary_id").withColumnRenamed("article_summary_id", "summary_id")
        pairs = pairs.join(done, "summary_id", "left_anti")
    elif granularity != "part":
        raise ValueError("granularity is 'article' or 'part'")
    return pairs.join(topics.select("part_id"), "part_id", "left_anti").select("summary_id", "part_id")


def pending_parts(
    register: DataFrame,
    parts: DataFrame,
    summaries: DataFrame,
    topics: DataFrame,
    limit: int,
    granularity: str = "article",
    one_summary: bool = False,
    topics_variant: int | None = None,
    summary_variant: int | None = None,
    config_no: int | None = None,
) -> DataFrame:
    """The first ``limit`` pending pairs in (summary, part) order, with their texts; the order itself is not kept.

    Only answers of ``topics_variant`` count as processed, only summaries of ``summary_variant`` and parts of the chunk
    configuration ``config_no`` are taken; each of them is all if not given. Keys are selected and limited first; only the chosen ones are joined to the texts. With
    ``one_summary`` a part goes with its smallest summary id only: an answer is stored once per part.
    """
    if topics_variant is not None:
        topics = of_variant(topics, "topics_variant", topics_variant)
    if summary_variant is not None:
        summaries = of_variant(summaries, "summary_variant", summary_variant)
    if config_no is not None:
        register = register.where(ids.config_of_part(F.col("part_id")) == config_no)
    keys = pending_part_keys(register, summaries, topics, granularity)
    if one_summary:
        keys = keys.groupBy("part_id").agg(F.min("summary_id").alias("summary_id")).select("summary_id", "part_id")
    chosen = first_n(keys, ["summary_id", "part_id"], limit)
    return (
        chosen.join(parts.select("part_id", "part_text"), "part_id")
        .join(summaries.select("summary_id", "article_summary"), "summary_id")
        .select("summary_id", "part_id", "part_text", "article_summary")
    )


def remaining_budget(topics: DataFrame, topics_variant: int, amount_to_process: int) -> DataFrame:
    """One row: rows stored for the variant, and how many are left of the target."""
    stored = F.count("*")
    left = F.greatest(F.lit(amount_to_process).cast("long") - stored, F.lit(0).cast("long"))
    return of_variant(topics, "topics_variant", topics_variant).agg(
        stored.alias("already_processed"), left.alias("still_to_process")
    )


def pending_part_summaries(
    topics: DataFrame, part_summaries: DataFrame, topics_variant: int, summary_variant: int
) -> DataFrame:
    """Answers of a variant whose part, or whose article summary, has no stored part summary.

    A row is done if its part *and* its article summary occur, each on its own. That is the anti join
    of two semi joins; the literal OR of two NOT IN would be a nested loop over all pairs.
    """
    stored = of_variant(part_summaries, "summary_variant", summary_variant)
    wanted = of_variant(topics, "topics_variant", topics_variant)
    parts = stored.select("part_id").distinct().withColumn("_part_done", F.lit(True))
    summaries = stored.select("article_summary_id").distinct().withColumn("_summary_done", F.lit(True))
    marked = wanted.join(parts, "part_id", "left").join(summaries, "article_summary_id", "left")
    return marked.where(F.col("_part_done").isNull() | F.col("_summary_done").isNull()).select(*topics.columns)


def pending_relations(
    topics: DataFrame,
    parts: DataFrame,
    part_summaries: DataFrame,
    register: DataFrame,
    raw_relations: DataFrame,
    summary_variant: int,
    relations_variant: int,
    topics_variant: int = 0,
) -> DataFrame:
    """Answers with a stored part summary and no raw relation row of the variant."""
    done = of_variant(raw_relations, "relations_variant", relations_variant).select(
        F.col("part_topics_id").alias("topics_id")
    )
    summaries = of_variant(part_summaries, "summary_variant", summary_variant).select("part_id", "summary_id")
    return (
        of_variant(topics, "topics_variant", topics_variant)
        .join(done, "topics_id", "left_anti")
        .join(parts.select("part_id"), "part_id")
        .join(summaries, "part_id")
        .join(register.select("part_id", "article_id"), "part_id")
        .select(
            "part_id", "part_topics", "topics_variant", "topics_id", "article_summary_id", "summary_id", "article_id"
        )
    )


def pending_graph(raw_relations: DataFrame, nodes: DataFrame, relations_variant: int) -> DataFrame:
    """Raw relation rows of a variant that have no entity yet."""
    done = nodes.select(F.col("source_id").alias("relation_id"))
    return of_variant(raw_relations, "relations_variant", relations_variant).join(done, "relation_id", "left_anti")


def coverage(done: DataFrame, total: DataFrame) -> DataFrame:
    """One row: done, total and their ratio."""
    wanted = total.agg(F.count("*").alias("total")).scalar()
    counts = done.agg(F.count("*").alias("done")).withColumn("total", wanted)
    return counts.withColumn("ratio", F.try_divide("done", "total"))
