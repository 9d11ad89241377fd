"""The whole flow as Spark jobs over stored tables, in order: ingest, summarise, extract, clean, graph, export.

Every step selects what its output tables lack, so a step that is run again goes on where it stopped.
Model answers are written once, slice by slice, and read back before anything else uses them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.functions.jsontext import serialise_document
from corpusloom.functions.prompts import EXTRACTION_TEMPLATE, SUMMARY_TEMPLATE, fit_prompt
from corpusloom.functions.text import STOP_SEQUENCE, PatternTokenizer, strip_nul
from corpusloom.operators import export, graph, inference, ingest, pending
from corpusloom.operators.repair import accepted, repair_answers, repair_report
from corpusloom.schemas import CORE_EXPORT
from corpusloom.sources.csvfiles import write_csv
from corpusloom.sources.tables import Tables

#: Answers of one slice, which are stored together: what a stop may lose of each task that is asking.
SLICE_ROWS = 10_000


def _largest(df: DataFrame, column: str) -> int:
    """One number: the largest stored value, -1 if the table is empty."""
    return df.agg(F.coalesce(F.max(column), F.lit(-1))).first()[0]


def insert_articles(
    tables: Tables,
    source: DataFrame,
    inserted_dataset: str,
    chunk_size: int = 1024,
    chunk_overlap: int = 256,
    tokenizer=PatternTokenizer(),
    config_no: int = 0,
) -> DataFrame:
    """Store the articles of ``source`` that are past the resume point of their dataset, with their parts.

    ``source`` has ``article_id, article, abstract, section_names``; its ids are unique in the dataset, and become ids that are
    unique over all (``Tables.place``; ``Tables.source_ids`` has both). Stored articles of the dataset that lack
    parts of ``config_no`` get theirs from ``source``, wherever the resume point is; the ids of those that still lack them, as
    ``source`` does not have them, are returned.

    Ids past the resume point are not stored, so texts meet no table of stored ids: they pass one job, from the scan to the
    written parts. The register is numbered from the ids of the written parts, and articles without a part are
    blank. Articles come last and mark the work as done: after an interruption the next run adds what is missing.
    """
    register = tables.read("article_part_register")
    config = (F.col("chunk_size") == chunk_size) & (F.col("chunk_overlap") == chunk_overlap)
    of_config = ids.config_of_part(F.col("part_id")) == config_no
    if register.where(of_config).where(~config).take(1):
        raise ValueError(f"config_no {config_no} is stored with another chunk size or overlap")
    stored = tables.source_ids().where(F.col("dataset") == inserted_dataset)
    start = _largest(stored, "source_article_id")
    placed = tables.place(source, inserted_dataset)
    fresh = placed if stored.isEmpty() else placed.where(F.col("source_article_id") > start)

    def owners() -> DataFrame:
        return tables.select("article_parts", "part_id").where(of_config).select(ids.owner_of_part(F.col("part_id")).alias("article_id")).distinct()

    # Usually neither is there: parts of a run that stopped before its articles, and articles without parts of this configuration.
    uncut = ingest.clean_articles(fresh.drop("source_article_id"))
    leftover = owners().join(tables.select("articles", "article_id"), "article_id", "left_anti")
    if not leftover.isEmpty():
        uncut = uncut.join(leftover, "article_id", "left_anti")
    lacking = stored.select("article_id").join(owners(), "article_id", "left_anti")
    if not lacking.isEmpty():
        older = placed.where(F.col("source_article_id") <= start).drop("source_article_id")
        uncut = uncut.unionByName(ingest.clean_articles(older.join(lacking, "article_id", "left_semi")))
    tables.append("article_parts", ingest.article_parts(uncut, chunk_size, chunk_overlap, tokenizer, config_no=config_no))

    first_index = _largest(register.where(config), "part_index") + 1
    written = tables.select("article_parts", "part_id").where(of_config)
    unnumbered = written.join(register.select("part_id"), "part_id", "left_anti")
    counts = unnumbered.groupBy(ids.owner_of_part(F.col("part_id")).alias("article_id")).agg(F.count("*").alias("n_parts"))
    tables.append("article_part_register", ingest.number_parts(counts, chunk_size, chunk_overlap, first_index, config_no))
    # Only the short texts are read again.
    about = fresh.select("article_id", *[strip_nul(F.col(name)).alias(name) for name in ("abstract", "section_names")])
    tables.append("articles", about.join(owners(), "article_id", "left_semi").withColumn("dataset", F.lit(inserted_dataset)))
    now = tables.select("articles", "article_id", "dataset").where(F.col("dataset") == inserted_dataset)
    return now.select("article_id").join(owners(), "article_id", "left_anti")


def _store_answers(
    tables: Tables,
    table: str,
    prompts: DataFrame,
    row: Callable[[DataFrame], DataFrame],
    owner: Column,
    predict_factory: Callable,
    slice_rows: int,
    models: int,
    tasks_per_model: int | None,
    stop: str | None = None,
) -> DataFrame:
    """Ask for the answers slice by slice and append them to the table.

    Unless ``tasks_per_model`` limits how many tasks may ask, slices are the tasks of one job: each asks one model, its answers
    are stored as it ends, and a call that stops keeps the slices that have ended; the next one asks for the rest. With a limit
    the slices come one after the other, each asked by so many tasks per model. ``prompts`` has the key columns, the
    one to spread by first, and ``prompt``. Returns the answers, failed ones included.
    """
    key = [name for name in prompts.columns if name != "prompt"]
    # Every prompt gets one answer, so the keys are compared once, before anything is asked.
    tables.check_new(table, row(prompts.withColumn("output", F.lit(None).cast("string"))))
    numbered, slices = inference.in_slices(prompts, owner, slice_rows)
    folder = tables.new_folder()
    if tasks_per_model is None:
        asked = inference.slices_over_models(numbered, slices, models)
        return _ask_and_append(tables, table, asked, row, key, predict_factory, stop, folder)
    staged = tables.stage(numbered, by="slice")
    for number in range(slices):
        chosen = staged.where(F.col("slice") == number).drop("slice")
        spread = inference.spread_over_models(chosen, key[0], models, tasks_per_model)
        answers = _ask_and_append(tables, table, spread, row, key, predict_factory, stop, f"{folder}/slice={number}")
    return tables.spark.read.schema(answers.schema).parquet(folder).drop("slice")


def _ask_and_append(
    tables: Tables, table: str, spread: DataFrame, row: Callable[[DataFrame], DataFrame], key: list[str], predict_factory: Callable, stop: str | None, folder: str
) -> DataFrame:
    """Write the answers to ``folder``, each task's as it ends, and append those without an error to the table.

    If a task fails, what the others have written is appended before the error goes on.
    """
    answers = inference.infer(spread, predict_factory, key, model="model_no", stop=stop)
    try:
        # Version 2 moves the file of a task into the folder when the task ends, not when all have.
        answers.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(folder)
    finally:
        if tables.exists(folder):
            written = tables.spark.read.schema(answers.schema).parquet(folder)
            tables.append(table, row(written.where(F.col("error").isNull())))
    return written


def summarise_articles(
    tables: Tables,
    predict_factory: Callable,
    amount_to_process: int,
    summary_variant: int = 0,
    overwrite_variant: bool = False,
    models: int = 1,
    tasks_per_model: int | None = None,
    template: str = SUMMARY_TEMPLATE,
    tokenizer=PatternTokenizer(),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Summaries of the pending articles, stored every ``slice_rows``. Returns this run's answers, failed ones included.

    ``overwrite_variant`` removes the variant's rows first; go on after a stop without it.
    """
    if overwrite_variant:
        tables.delete_variant("short_article_summary", summary_variant)
    stored = tables.read("short_article_summary")
    todo = pending.pending_articles(tables.read("articles"), stored, summary_variant, amount_to_process)
    prompts = fit_prompt(todo, template, {"abstract": "abstract", "list_of_sections": "section_names"}, tokenizer)

    def row(answers: DataFrame) -> DataFrame:
        return answers.select(
            "article_id",
            F.col("output").alias("article_summary"),
            F.lit(summary_variant).alias("summary_variant"),
            ids.variant_id(F.col("article_id"), summary_variant).alias("summary_id"),
        )

    return _store_answers(
        tables,
        "short_article_summary",
        prompts.select("article_id", "prompt"),
        row,
        F.col("article_id"),
        predict_factory,
        slice_rows,
        models,
        tasks_per_model,
    )


def extract_topics(
    tables: Tables,
    predict_factory: Callable,
    amount_to_process: int,
    topics_variant: int = 0,
    overwrite_variant: bool = False,
    models: int = 1,
    tasks_per_model: int | None = None,
    granularity: str = "article",
    template: str = EXTRACTION_TEMPLATE,
    tokenizer=PatternTokenizer(),
    slice_rows: int = SLICE_ROWS,
    summary_variant: int | None = None,
    config_no: int | None = None,
) -> DataFrame | None:
    """Answers for the pending parts, up to a number of stored answers of the variant, stored every ``slice_rows``.

    Pending is what has no answer of this variant; ``summary_variant`` and ``config_no`` narrow it to some summaries and parts.
    The parts of an article are in one slice, so a call that stops leaves no article half done. Returns the answers of
    this run, or None if the number is reached already. ``overwrite_variant`` as in ``summarise_articles``.
    """
    if overwrite_variant:
        tables.delete_variant("extracted_part_topics", topics_variant)
    topics = tables.read("extracted_part_topics")
    left = pending.remaining_budget(topics, topics_variant, amount_to_process).first()["still_to_process"]
    if left == 0:
        return None
    todo = pending.pending_parts(
        tables.read("article_part_register"),
        tables.read("article_parts"),
        tables.read("short_article_summary"),
        topics,
        left,
        granularity,
        one_summary=True,
        topics_variant=topics_variant,
        summary_variant=summary_variant,
        config_no=config_no,
    )
    fields = {"summary": "article_summary", "text_to_extract": "part_text"}
    prompts = fit_prompt(todo, template, fields, tokenizer).select("part_id", "summary_id", "prompt")

    def row(answers: DataFrame) -> DataFrame:
        return answers.select(
            "part_id",
            F.col("output").alias("part_topics"),
            F.lit(topics_variant).alias("topics_variant"),
            ids.variant_id(F.col("part_id"), topics_variant).alias("topics_id"),
            F.col("summary_id").alias("article_summary_id"),
        )

    return _store_answers(
        tables,
        "extracted_part_topics",
        prompts,
        row,
        ids.owner_of_part(F.col("part_id")),
        predict_factory,
        slice_rows,
        models,
        tasks_per_model,
        STOP_SEQUENCE,
    )


def clean_relations(
    tables: Tables, summary_variant: int = 0, topics_variant: int = 0, relations_variant: int = 0, **repair
) -> DataFrame:
    """Repair pending answers once, then store part summaries and relation documents from the result.

    Returns the one-row repair report of this run.
    """
    topics = tables.read("extracted_part_topics")
    summaries = tables.read("short_part_summary")
    raw = tables.read("extracted_relations_raw")
    register = tables.read("article_part_register")
    unsummarised = pending.pending_part_summaries(topics, summaries, topics_variant, summary_variant)
    unrelated = topics.where(F.col("topics_variant") == topics_variant).join(
        pending.of_variant(raw, "relations_variant", relations_variant).select(F.col("part_topics_id").alias("topics_id")),
        "topics_id",
        "left_anti",
    )
    marked = unsummarised.select("topics_id").unionByName(unrelated.select("topics_id")).distinct()
    repaired = repair_answers(topics.join(marked, "topics_id", "left_semi"), **repair)
    repaired = tables.stage(repaired.drop("part_topics", "repaired_text"))

    good = accepted(repaired)
    new_summaries = good.join(unsummarised.select("topics_id"), "topics_id", "left_semi").select(
        "part_id",
        F.col("document.section_description").alias("part_summary"),
        F.lit(summary_variant).alias("summary_variant"),
        ids.variant_id(F.col("part_id"), summary_variant).alias("summary_id"),
        "article_summary_id",
    )
    tables.append_strict("short_part_summary", tables.stage(new_summaries))

    todo = pending.pending_relations(
        topics,
        tables.read("article_parts"),
        tables.read("short_part_summary"),
        register,
        raw,
        summary_variant,
        relations_variant,
        topics_variant,
    ).drop("part_topics")
    documents = todo.join(good.select("topics_id", "document"), "topics_id").select(
        "article_id",
        "part_id",
        F.col("summary_id").alias("part_summary_id"),
        F.col("topics_id").alias("part_topics_id"),
        "article_summary_id",
        ids.variant_id(F.col("topics_id"), relations_variant).alias("relation_id"),
        serialise_document(F.col("document")).alias("raw_relation_text"),
        F.lit(relations_variant).alias("relations_variant"),
    )
    tables.append_strict("extracted_relations_raw", tables.stage(documents))
    return repair_report(repaired)


def build_graph(tables: Tables, relations_variant: int = 0) -> None:
    """Store nodes and edges of the documents that have none yet.

    They are one run: what a run that stopped has written is a folder that goes first. Stored edges are not read; the
    next numbers are those of the last run.
    """
    names = ("relations", "relation_objects")
    tables.drop_unfinished_runs(*names)
    nodes = tables.read("relation_objects")
    todo = pending.pending_graph(tables.read("extracted_relations_raw"), nodes, relations_variant)
    runs = tables.runs(*names)
    if runs is None:  # rows that came in otherwise
        first_node, first_edge = max(_largest(nodes, "object_id"), 0) + 1, max(_largest(tables.read("relations"), "relation_id"), 0) + 1
    else:
        first_node, first_edge = runs.agg(F.max("next_node"), F.max("next_edge")).first()
    placed = tables.stage(graph.placed_documents(todo))
    ends = placed.agg(F.max(F.col("node_offset") + F.size("names")), F.max(F.col("edge_offset") + F.size("edges"))).first()
    if ends[0] is None:
        return
    content = {"relations": graph.relation_edges(placed, first_node, first_edge), "relation_objects": graph.entity_nodes(placed, first_node)}
    tables.store_run(content, {"next_node": first_node + ends[0], "next_edge": first_edge + ends[1]})


def export_dataset(tables: Tables, folder: str, summary_key: str = "summary_id", **variants) -> DataFrame:
    """Write the wide, core and prompt CSV folders in part order; returns the prompts, in no order."""
    records = export.export_records(
        tables.read("extracted_part_topics"),
        tables.read("extracted_relations_raw"),
        tables.read("article_parts"),
        tables.read("short_article_summary"),
        tables.read("articles"),
        summary_key,
        **variants,
    )
    # Joined once; every folder is then written straight from its sort, so that its files follow the parts.
    records = tables.stage(records)
    write_csv(export.ordered_export(records), f"{folder}/extracted_relations")
    write_csv(export.core_columns(export.in_part_order(records.select("part_id", *CORE_EXPORT.fieldNames()))), f"{folder}/core_extracted_relations")
    # From the staged rows, not from the CSV, where an empty text reads back as NULL.
    used = records.select("part_id", *CORE_EXPORT.fieldNames())
    write_csv(export.training_prompts(export.in_part_order(used)), f"{folder}/prompts")
    prompts = export.training_prompts(used)
    return prompts


def open_tables(spark: SparkSession, root: str) -> Tables:
    """The stored tables under ``root``, created empty where missing."""
    tables = Tables(spark, root)
    tables.create()
    return tables
