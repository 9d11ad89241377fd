"""Every operator as a query over the test tables, each with the SQL that says what it must return."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.functions import answers, documents, ids, jsontext, prompts, text
from corpusloom.operators import export, graph, inference, ingest, ordinals, pending, quality, repair
from corpusloom.plans import oracles, pipeline
from corpusloom.plans.sample_tables import CHUNK_OVERLAP, CHUNK_SIZE, TOKENIZER, SampleTables
from corpusloom.session import shared_folder
from corpusloom.sources import articles as article_sources
from corpusloom.sources import csvfiles
from corpusloom.sources import tables as stored

QUERIES: dict[str, Callable[[SampleTables], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AMOUNT_TO_PROCESS = 10_000
PARTS_TO_PROCESS = 10_850
c = F.col


def query(sql: str | None = None):
    """Register a query under its function name; ``sql`` is the select part of its oracle."""

    def register(function: Callable[[SampleTables], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = oracles.statement(sql)
        return function

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function):
        return lambda spark, folder: function(SampleTables(spark, folder.rstrip("/")))

    return {name: bound(function) for name, function in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _long(name: str) -> Column:
    return c(name).cast("long").alias(name)


def _joined(names: Column) -> Column:
    """An array as one text, order kept."""
    return F.array_join(names, "|")


def _sorted(names: Column) -> Column:
    """A set as one text."""
    return F.array_join(F.array_sort(names), "|")


# Sources and sinks


@query("SELECT article_id, article, abstract, section_names FROM src")
def scan_articles(t: SampleTables) -> DataFrame:
    path = shared_folder(t.spark)
    t.source.write.parquet(path)
    return article_sources.scan_articles(t.spark, path)


@query(
    """SELECT 'documents' AS dataset, article_id, article, abstract, section_names FROM src
       UNION ALL SELECT 'pages', page_id, html, url, '' FROM pages"""
)
def tag_and_union_sources(t: SampleTables) -> DataFrame:
    pages = t.table("pages").select(
        c("page_id").alias("article_id"), c("html").alias("article"), c("url").alias("abstract"), F.lit("").alias("section_names")
    )
    both = {"documents": t.source.drop("dataset"), "pages": pages}
    return article_sources.tag_and_union_sources(both)


@query("SELECT article_id, abstract FROM src ORDER BY article_id LIMIT 10")
def preview(t: SampleTables) -> DataFrame:
    return article_sources.preview(t.articles.select("article_id", "abstract"), "article_id", 10)


@query("SELECT article_id, abstract, section_names FROM src")
def table_scan(t: SampleTables) -> DataFrame:
    tables = pipeline.open_tables(t.spark, shared_folder(t.spark))
    tables.append("articles", t.articles)
    return tables.select("articles", "article_id", "abstract", "section_names")


@query(
    """SELECT article_id, dataset, CASE WHEN article_id IN (SELECT doc_id FROM labels) THEN 'new: ' || abstract ELSE abstract END
              AS abstract, section_names FROM src
       UNION ALL SELECT page_id + 1000000000, 'pages', url, '' FROM pages"""
)
def upsert_by_key(t: SampleTables) -> DataFrame:
    changed = t.articles.join(t.labels.select("article_id"), "article_id", "left_semi").withColumn(
        "abstract", F.concat(F.lit("new: "), "abstract")
    )
    added = t.table("pages").select(
        (c("page_id") + 1_000_000_000).alias("article_id"), F.lit("pages").alias("dataset"), c("url").alias("abstract"), F.lit("").alias("section_names")
    )
    older = changed.withColumn("abstract", F.lit("superseded")).withColumn("given", F.lit(1))
    incoming = older.unionByName(changed.unionByName(added).withColumn("given", F.lit(2)))
    return stored.upsert_by_key(t.articles, incoming, ["article_id"], "given")


@query(
    """SELECT part_index, chunk_size::BIGINT AS chunk_size, chunk_overlap::BIGINT AS chunk_overlap, article_id, part_id FROM reg
       WHERE article_id NOT IN (SELECT doc_id FROM labels)"""
)
def insert_ignore(t: SampleTables) -> DataFrame:
    known = t.register.join(t.labels.select("article_id"), "article_id", "left_semi")
    fresh = stored.insert_ignore(known, t.register.union(t.register), ["part_index", "chunk_size", "chunk_overlap", "article_id"])
    return fresh.select("part_index", _long("chunk_size"), _long("chunk_overlap"), "article_id", "part_id")


@query("SELECT article_id, 0::BIGINT AS summary_variant, 1::BIGINT AS incoming_rows FROM summ WHERE summary_variant = 0")
def append_strict(t: SampleTables) -> DataFrame:
    clash = stored.key_collisions(t.summaries, t.all_summaries, list(schemas.PRIMARY_KEYS["short_article_summary"]))
    return clash.select("article_id", _long("summary_variant"), "incoming_rows")


_REPLACED_VARIANT = """SELECT article_id, article_summary, summary_variant::BIGINT AS summary_variant, summary_id FROM summ
       WHERE summary_variant <> 1 UNION ALL SELECT article_id, abstract, 1, article_id * 16 + 1 FROM src"""


def _new_variant(t: SampleTables) -> DataFrame:
    return t.articles.select(
        "article_id",
        c("abstract").alias("article_summary"),
        F.lit(1).alias("summary_variant"),
        ids.variant_id(c("article_id"), 1).alias("summary_id"),
    )


@query(_REPLACED_VARIANT)
def replace_variant(t: SampleTables) -> DataFrame:
    """As a function of two DataFrames."""
    changed = stored.replace_variant(t.summaries, _new_variant(t), "summary_variant", 1)
    return changed.select("article_id", "article_summary", _long("summary_variant"), "summary_id")


@query(_REPLACED_VARIANT)
def replace_stored_variant(t: SampleTables) -> DataFrame:
    """As an overwrite of the stored table's variant."""
    tables = pipeline.open_tables(t.spark, shared_folder(t.spark))
    tables.append("short_article_summary", t.summaries)
    tables.overwrite_variant("short_article_summary", _new_variant(t))
    return tables.select("short_article_summary", "article_id", "article_summary", _long("summary_variant"), "summary_id")


def _records(t: SampleTables) -> DataFrame:
    return export.export_records(t.all_answers, t.all_relations, t.parts, t.all_summaries, t.articles)


def _record_slices(t: SampleTables) -> list[DataFrame]:
    # Summaries and articles are read by every slice.
    return export.record_slices(t.all_answers, t.all_relations, t.parts, t.stored(t.all_summaries), t.stored(t.articles))


_WIDE = "general_text_summary, text_part, extracted_relations, dataset, abstract, section_names"


@query(f"SELECT {_WIDE} FROM wide")
def export_wide_csv(t: SampleTables) -> DataFrame:
    path = shared_folder(t.spark)
    csvfiles.write_csv_slices([export.ordered_export(records) for records in _record_slices(t)], path)
    return csvfiles.read_csv(t.spark, path, schemas.WIDE_EXPORT)


@query("SELECT general_text_summary, text_part, extracted_relations FROM wide")
def export_core_csv(t: SampleTables) -> DataFrame:
    path = shared_folder(t.spark)
    csvfiles.write_csv(export.core_columns(_records(t)), path)
    return csvfiles.read_csv(t.spark, path, schemas.CORE_EXPORT)


@query("SELECT article_id, article, section_names FROM src")
def read_csv(t: SampleTables) -> DataFrame:
    path = shared_folder(t.spark)
    rows = t.source.select("article_id", "article", "section_names")
    csvfiles.write_csv(rows, path)
    return csvfiles.read_csv(t.spark, path, rows.schema)


_PROMPT_COLUMNS = ", ".join(f"{oracles.training_prompt(name)} AS {name}" for name in prompts.PROMPT_FORMATS)


@query(f"SELECT {_PROMPT_COLUMNS} FROM wide JOIN pretty USING (part_id)")
def export_prompts_csv(t: SampleTables) -> DataFrame:
    path = shared_folder(t.spark)
    written = [export.training_prompts(records) for records in _record_slices(t)]
    csvfiles.write_csv_slices(written, path)
    return csvfiles.read_csv(t.spark, path, written[0].schema)


@query(
    """SELECT 'articles' AS table_name, count(*) AS stored_rows FROM src
       UNION ALL SELECT 'article_part_register', count(*) FROM win
       UNION ALL SELECT 'article_parts', count(*) FROM win
       UNION ALL SELECT 'short_article_summary', count(*) FROM summ
       UNION ALL SELECT 'short_part_summary', count(*) FROM part_summ
       UNION ALL SELECT 'extracted_part_topics', count(*) FROM topics
       UNION ALL SELECT 'extracted_relations_raw', count(*) FROM raw
       UNION ALL SELECT 'relation_objects', count(*) FROM nodes JOIN raw ON relation_id = source_id
       UNION ALL SELECT 'relations', count(*) FROM edges JOIN raw USING (source_id)""".replace(
        "JOIN raw USING (source_id)", "JOIN raw ON raw.relation_id = source_id"
    )
)
def create_tables(t: SampleTables) -> DataFrame:
    """All nine tables created empty, filled, and counted."""
    tables = pipeline.open_tables(t.spark, shared_folder(t.spark))
    tables.create()
    placed = graph.placed_documents(t.raw_relations)
    content = {
        "articles": t.articles,
        "article_part_register": t.register,
        "article_parts": t.parts,
        "short_article_summary": t.summaries,
        "short_part_summary": t.part_summaries,
        "extracted_part_topics": t.topics,
        "extracted_relations_raw": t.raw_relations,
        "relation_objects": graph.entity_nodes(placed),
        "relations": graph.relation_edges(placed),
    }
    counts = None
    for name, rows in content.items():
        tables.append(name, rows)
        count = tables.read(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("stored_rows"))
        counts = count if counts is None else counts.unionByName(count)
    return counts


# Projections, filters, predicates


@query("SELECT article_id, article, abstract, section_names FROM src")
def strip_nul(t: SampleTables) -> DataFrame:
    """NUL characters are put after every dot and blank first."""

    def spoiled(name: str) -> Column:
        nul = F.char(F.lit(0))
        return F.replace(F.replace(c(name), F.lit("."), F.concat(F.lit("."), nul)), F.lit(" "), F.concat(nul, F.lit(" ")))

    names = article_sources.SOURCE_COLUMNS
    return ingest.clean_articles(t.source.select("article_id", *[spoiled(name).alias(name) for name in names]))


@query(r"SELECT article_id, article FROM src WHERE regexp_matches(article, '\S')")
def drop_empty_articles(t: SampleTables) -> DataFrame:
    """All articles, and a blank one for every label."""
    blank = t.labels.select("article_id", F.lit(" \n ").alias("article"))
    return ingest.drop_empty_articles(t.source.select("article_id", "article").unionByName(blank))


@query(f"SELECT article_id, dataset FROM src WHERE article_id < {AMOUNT_TO_PROCESS}")
def id_bound(t: SampleTables) -> DataFrame:
    return pending.below_id(t.articles, "article_id", AMOUNT_TO_PROCESS).select("article_id", "dataset")


@query("SELECT article_id, article_summary, summary_id FROM summ WHERE summary_variant = 1")
def variant_filter(t: SampleTables) -> DataFrame:
    return pending.of_variant(t.summaries, "summary_variant", 1).select("article_id", "article_summary", "summary_id")


@query(
    """SELECT source_id, object_id, object_name FROM nodes
       WHERE (source_id, object_name) IN (SELECT source_id, source_name FROM pairs)"""
)
def in_list_filter(t: SampleTables) -> DataFrame:
    documents_ = graph.read_documents(t.all_relations, "relation_id")
    wanted = graph.source_target_pairs(documents_).select("source_id", c("source_name").alias("object_name"))
    return graph.nodes_among(t.nodes, wanted)


@query("SELECT part_index, article_id, part_id FROM reg WHERE article_id IN (SELECT doc_id FROM labels)")
def index_range_filter(t: SampleTables) -> DataFrame:
    labelled = t.register.join(t.labels.select("article_id"), "article_id", "left_semi")
    rows = ingest.in_index_ranges(t.register, ingest.part_range(labelled), CHUNK_SIZE, CHUNK_OVERLAP)
    return rows.select("part_index", "article_id", "part_id")


@query(
    """SELECT article_id, article FROM src
       WHERE article_id > (SELECT coalesce(max(article_id), -1) FROM src JOIN labels ON doc_id = article_id
                           WHERE dataset = 'de' AND quality = 0)"""
)
def resume_after(t: SampleTables) -> DataFrame:
    known = t.articles.join(t.labels.where("quality = 0"), "article_id", "left_semi")
    return ingest.resume_after(t.source, known, "de").select("article_id", "article")


@query("SELECT part_id, part_text AS text_part FROM win")
def rename_project(t: SampleTables) -> DataFrame:
    return t.parts.select("part_id", c("part_text").alias("text_part"))


# Joins


@query(
    f"""SELECT article_id, abstract, section_names FROM src
        WHERE article_id NOT IN (SELECT article_id FROM summ WHERE summary_variant = 0) AND article_id < {AMOUNT_TO_PROCESS}
        ORDER BY article_id LIMIT {AMOUNT_TO_PROCESS}"""
)
def pending_articles(t: SampleTables) -> DataFrame:
    return pending.pending_articles(t.articles, t.summaries, 0, AMOUNT_TO_PROCESS)


@query(
    """SELECT summary_id, part_id, part_text, article_summary FROM reg JOIN win USING (part_id)
       JOIN summ ON summ.article_id = reg.article_id"""
)
def part_summary_feed(t: SampleTables) -> DataFrame:
    return pending.part_summary_feed(t.register, t.parts, t.summaries)


_PENDING_PARTS = f"""SELECT summary_id, win.part_id, part_text, article_summary FROM win JOIN summ ON summ.article_id = win.article_id
    WHERE %s win.part_id NOT IN (SELECT part_id FROM topics)
    ORDER BY summary_id, win.part_id
    LIMIT greatest({PARTS_TO_PROCESS} - (SELECT count(*) FROM topics), 0)"""
_UNTOUCHED = "summary_id NOT IN (SELECT article_summary_id FROM topics) AND"


def _pending_parts(t: SampleTables, granularity: str) -> DataFrame:
    left = pending.remaining_budget(t.topics, 0, PARTS_TO_PROCESS).first()["still_to_process"]
    return pending.pending_parts(t.register, t.parts, t.summaries, t.topics, left, granularity)


@query(_PENDING_PARTS % _UNTOUCHED)
def pending_parts(t: SampleTables) -> DataFrame:
    return _pending_parts(t, "article")


@query(_PENDING_PARTS % "")
def pending_parts_by_part(t: SampleTables) -> DataFrame:
    return _pending_parts(t, "part")


@query(
    """SELECT summ.summary_id, win.part_id, part_text, article_summary FROM win JOIN summ ON summ.article_id = win.article_id
       WHERE win.article_id % 3 > 0 AND summ.summary_variant = 0"""
)
def pending_parts_of_variant(t: SampleTables) -> DataFrame:
    """Answers of variant 0 are stored for all parts, those of variant 1 for every third article."""
    second = t.all_answers.where("article_id % 3 = 0").withColumn("topics_variant", F.lit(1))
    return pending.pending_parts(
        t.register, t.parts, t.summaries, t.all_answers.unionByName(second), 1 << 30, topics_variant=1, summary_variant=0, config_no=0
    )


@query(
    """SELECT part_id, part_topics, topics_id, article_summary_id FROM topics
       WHERE part_id NOT IN (SELECT part_id FROM part_summ) OR article_summary_id NOT IN (SELECT article_summary_id FROM part_summ)"""
)
def pending_part_summaries(t: SampleTables) -> DataFrame:
    rows = pending.pending_part_summaries(t.topics, t.part_summaries, 0, 0)
    return rows.select("part_id", "part_topics", "topics_id", "article_summary_id")


@query(
    """SELECT t.part_id, t.topics_id, t.article_summary_id, p.summary_id, reg.article_id
       FROM topics t JOIN win ON win.part_id = t.part_id JOIN part_summ p ON p.part_id = t.part_id
       JOIN reg ON reg.part_id = t.part_id WHERE t.topics_id NOT IN (SELECT part_topics_id FROM raw)"""
)
def pending_relations(t: SampleTables) -> DataFrame:
    rows = pending.pending_relations(t.topics, t.parts, t.part_summaries, t.register, t.raw_relations, 0, 0)
    return rows.select("part_id", "topics_id", "article_summary_id", "summary_id", "article_id")


@query(
    """SELECT part_id * 256 AS relation_id, raw_relation_text FROM stored
       WHERE part_id * 256 NOT IN (SELECT relation_id FROM raw)"""
)
def pending_graph(t: SampleTables) -> DataFrame:
    """The documents of the stored part of the flow have nodes already."""
    known = graph.entity_nodes(graph.placed_documents(t.raw_relations))
    return pending.pending_graph(t.all_relations, known, 0).select("relation_id", "raw_relation_text")


@query(f"SELECT part_id, {_WIDE} FROM wide")
def export_join(t: SampleTables) -> DataFrame:
    return _records(t)


@query(
    """SELECT win.part_id, 'Summary: ' || s.abstract AS general_text_summary, part_text AS text_part,
              raw_relation_text AS extracted_relations, a.dataset, a.abstract, a.section_names
       FROM stored JOIN win USING (part_id) JOIN src s ON s.article_id = win.article_id * 16
       JOIN src a ON a.article_id = win.article_id"""
)
def export_join_by_article_id(t: SampleTables) -> DataFrame:
    return export.export_records(
        t.all_answers, t.all_relations, t.parts, t.all_summaries, t.articles, summary_key="article_id"
    )


@query("SELECT article_id, article FROM src WHERE article_id NOT IN (SELECT doc_id FROM labels)")
def not_yet_inserted(t: SampleTables) -> DataFrame:
    return ingest.not_yet_inserted(t.source, t.labels).select("article_id", "article")


@query("SELECT part_id, part_text FROM win")
def index_to_id(t: SampleTables) -> DataFrame:
    """Texts are addressed by their running index first."""
    offsets = ordinals.exclusive_prefix_sum(t.part_counts, ["article_id"], c("n_parts"), "first_index")
    indexed = t.windows.join(offsets, "article_id").select(
        "article_id",
        F.lit(CHUNK_SIZE).alias("chunk_size"),
        F.lit(CHUNK_OVERLAP).alias("chunk_overlap"),
        (c("first_index") + c("part_no")).alias("part_index"),
        "part_text",
    )
    return ingest.index_to_id(indexed, t.register)


@query("SELECT source_id, object_id, subject_id, relation_type FROM edges")
def resolve_entities(t: SampleTables) -> DataFrame:
    pairs = graph.source_target_pairs(graph.read_documents(t.all_relations, "relation_id"))
    return graph.resolve_entities(pairs, t.nodes).select("source_id", "object_id", "subject_id", "relation_type")


@query("SELECT source_id, relation_no, relation_type, source_name, target_name FROM pairs")
def source_target_pairs(t: SampleTables) -> DataFrame:
    rows = graph.source_target_pairs(graph.read_documents(t.all_relations, "relation_id"))
    return rows.select("source_id", _long("relation_no"), "relation_type", "source_name", "target_name")


# Aggregations


@query(
    """SELECT (SELECT coalesce(max(article_id) + 1, 0) FROM src WHERE dataset = 'fr') AS next_article_id,
              (SELECT coalesce(max(part_index) + 1, 0) FROM reg) AS next_part_index"""
)
def resume_watermark(t: SampleTables) -> DataFrame:
    return ingest.resume_watermark(t.articles, t.register, "fr", CHUNK_SIZE, CHUNK_OVERLAP)


@query(
    """SELECT article_id, min(part_index) AS min_part_index, max(part_index) AS max_part_index FROM reg GROUP BY article_id"""
)
def part_range(t: SampleTables) -> DataFrame:
    return ingest.part_range(t.register)


@query(
    f"""SELECT count(*) AS already_processed, greatest({PARTS_TO_PROCESS} - count(*), 0)::BIGINT AS still_to_process FROM topics"""
)
def remaining_budget(t: SampleTables) -> DataFrame:
    return pending.remaining_budget(t.topics, 0, PARTS_TO_PROCESS)


@query("SELECT DISTINCT article_summary_id FROM topics")
def processed_keys(t: SampleTables) -> DataFrame:
    return pending.processed_keys(t.topics, "article_summary_id")


@query(
    """SELECT count(*) AS tested, count_if(reject_reason IS NULL)::BIGINT AS correct, count_if(reject_reason = 'unfit')::BIGINT AS unfit,
              round(count_if(reject_reason IS NULL) / count_if(reject_reason IS DISTINCT FROM 'unfit'), 6) AS achievable,
              round(count_if(reject_reason IS NULL) / count(*), 6) AS all_answers
       FROM judged"""
)
def repair_report(t: SampleTables) -> DataFrame:
    report = repair.repair_report(t.repaired)
    return report.select(
        "tested", "correct", "unfit", F.round("achievable", 6).alias("achievable"), F.round("all", 6).alias("all_answers")
    )


_RELATION_TEXT = """part_id, relation_no, description, array_to_string(sources, '|') AS source_entities,
    array_to_string(targets, '|') AS target_entities"""


@query(f"SELECT {_RELATION_TEXT} FROM good_rel")
def merge_same_description(t: SampleTables) -> DataFrame:
    rows = repair.exploded_relations(t.repaired, "part_id")
    return rows.select(
        "part_id",
        _long("relation_no"),
        "description",
        _joined(c("source_entities")).alias("source_entities"),
        _joined(c("target_entities")).alias("target_entities"),
    )


@query("SELECT part_id, array_to_string(entities, '|') AS entities FROM good_ent")
def entity_closure(t: SampleTables) -> DataFrame:
    good = repair.accepted(t.repaired)
    return good.select("part_id", _joined(c("document.list_of_entities")).alias("entities"))


@query(
    """SELECT (SELECT count(DISTINCT article_id) FROM summ) AS done, count(*) AS total,
              round((SELECT count(DISTINCT article_id) FROM summ) / count(*), 6) AS ratio FROM src"""
)
def coverage(t: SampleTables) -> DataFrame:
    row = pending.coverage(t.summaries.select("article_id").distinct(), t.articles)
    return row.select("done", "total", F.round("ratio", 6).alias("ratio"))


# Ids


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS article_id FROM labels")
def ordinal_id(t: SampleTables) -> DataFrame:
    return ordinals.ordinal_id(t.table("labels").select("doc_id"), ["doc_id"], "article_id")


@query("SELECT part_index, article_id, part_id FROM reg")
def global_part_index(t: SampleTables) -> DataFrame:
    return t.register.select("part_index", "article_id", "part_id")


@query(
    """SELECT part_id, article_id * 16 AS article_summary_id, part_id * 16 AS topics_id, part_id * 16 AS part_summary_id,
              part_id * 256 AS relation_id, first_object_id, first_edge_id
       FROM good JOIN win USING (part_id)
       LEFT JOIN (SELECT source_id, min(object_id) AS first_object_id FROM nodes GROUP BY 1) n ON n.source_id = part_id * 256
       LEFT JOIN (SELECT source_id, min(relation_id) AS first_edge_id FROM edges GROUP BY 1) e ON e.source_id = part_id * 256"""
)
def surrogate_keys(t: SampleTables) -> DataFrame:
    """All seven generated ids: five packed, two dense."""
    first_node = t.nodes.groupBy("source_id").agg(F.min("object_id").alias("first_object_id"))
    first_edge = t.edges.groupBy("source_id").agg(F.min("relation_id").alias("first_edge_id"))
    rows = t.all_relations.withColumnRenamed("relation_id", "source_id")
    return (
        rows.join(first_node, "source_id", "left")
        .join(first_edge, "source_id", "left")
        .select(
            "part_id",
            "article_summary_id",
            c("part_topics_id").alias("topics_id"),
            "part_summary_id",
            c("source_id").alias("relation_id"),
            "first_object_id",
            "first_edge_id",
        )
    )


@query("SELECT count(*) AS parts, 0::BIGINT AS shared_ids FROM win")
def hashed_keys(t: SampleTables) -> DataFrame:
    """Hashed ids of all parts, and how many of them stand for two natural keys."""
    natural = ("article_id", "part_no")
    hashed = t.windows.select(*natural, ids.hashed_id(*[c(name) for name in natural]).alias("part_id"))
    shared = quality.key_collisions(hashed, "part_id", natural).agg(F.count("*").alias("shared_ids"))
    return hashed.agg(F.count("*").alias("parts")).withColumn("shared_ids", shared.scalar())


# Sorts, limits


@query("SELECT part_id, part_text FROM win ORDER BY part_id LIMIT 1000")
def order_limit(t: SampleTables) -> DataFrame:
    return ordinals.first_n(t.parts, ["part_id"], 1000)


_FEED_KEYS = "SELECT summary_id, part_id FROM reg JOIN summ USING (article_id) ORDER BY summary_id, part_id"


@query(f"{_FEED_KEYS} LIMIT 1500")
def order_two_keys_limit(t: SampleTables) -> DataFrame:
    keys = pending.part_summary_feed(t.register, t.parts, t.summaries).select("summary_id", "part_id")
    return ordinals.first_n(keys, ["summary_id", "part_id"], 1500)


@query(f"SELECT *, row_number() OVER (ORDER BY summary_id, part_id) - 1 AS rank FROM ({_FEED_KEYS})")
def rank_two_keys(t: SampleTables) -> DataFrame:
    """The ranking that a large limit is cut from."""
    keys = pending.part_summary_feed(t.register, t.parts, t.summaries).select("summary_id", "part_id")
    return ordinals.ordinal_id(keys, ["summary_id", "part_id"], "rank")


@query(f"SELECT {_WIDE} FROM wide ORDER BY part_id")
def full_sort(t: SampleTables) -> DataFrame:
    return export.ordered_export(_records(t))


@query("SELECT part_id, row_number() OVER (ORDER BY part_id) - 1 AS position, text_part FROM wide")
def export_file_order(t: SampleTables) -> DataFrame:
    """Place of every record in the exported files, read by their names."""
    path = shared_folder(t.spark)
    columns = T.StructType([T.StructField("part_id", T.LongType()), T.StructField("text_part", T.StringType())])
    csvfiles.write_csv(export.in_part_order(_records(t).select(*columns.names)), path, rows_per_file=500)
    return csvfiles.read_csv_in_order(t.spark, path, columns, "position")


@query(f"SELECT part_id, {_WIDE} FROM wide ORDER BY part_id LIMIT 1 OFFSET 20")
def row_at(t: SampleTables) -> DataFrame:
    return ordinals.row_at(_records(t), "part_id", 20)


# Set operations

_NAMES_PER_ARTICLE = "string_split(article, ' ')"


@query(
    f"""SELECT article_id, array_to_string(list_sort(list_distinct(list_filter({_NAMES_PER_ARTICLE} || ['caffeine', 'plain'],
               lambda n: n NOT IN {oracles.names(documents.EXAMPLE_ENTITIES)}))), '|') AS entities FROM src"""
)
def drop_prompt_example_entities(t: SampleTables) -> DataFrame:
    listed = F.concat(F.split("article", " "), F.array(F.lit("caffeine"), F.lit("plain")))
    nothing = F.from_json(F.lit("[]"), F.lit("array<struct<source_entities array<string>, target_entities array<string>>>"))
    return t.source.select("article_id", _sorted(documents.close_entities(listed, nothing)).alias("entities"))


@query(
    f"""SELECT article_id, array_to_string(list_sort(list_distinct({_NAMES_PER_ARTICLE} || string_split(section_names, chr(10)))), '|')
               AS entities FROM src"""
)
def merge_entity_sets(t: SampleTables) -> DataFrame:
    merged = F.array_union(F.split("article", " "), F.split("section_names", "\n"))
    return t.source.select("article_id", _sorted(merged).alias("entities"))


# Text functions


@query("SELECT article_id, part_no, part_id, part_text FROM win")
def chunk_tokens(t: SampleTables) -> DataFrame:
    return ingest.article_parts(t.source, CHUNK_SIZE, CHUNK_OVERLAP, TOKENIZER)


@query(
    r"""SELECT article_id, s // 48 AS part_no, array_to_string(w[s + 1 : s + 64], '') AS part_text
        FROM (SELECT article_id, w, unnest(range(0, greatest(len(w) - 16, 1), 48)) AS s
              FROM (SELECT article_id, regexp_extract_all(article, '\s*\S+(?:\s+\z)?') AS w FROM src) WHERE len(w) > 0)"""
)
def chunk_tokens_lossless(t: SampleTables) -> DataFrame:
    """Blanks kept, no window that its predecessor covers."""
    rows = text.chunk_articles(
        t.source.select("article_id", "article"), "article", CHUNK_SIZE, CHUNK_OVERLAP, text.LOSSLESS, True
    )
    return rows.select("article_id", _long("part_no"), "part_text")


@query("SELECT dataset, count(*) AS parts, sum(length(part_text))::BIGINT AS characters FROM win JOIN src USING (article_id) GROUP BY 1")
def parts_per_dataset(t: SampleTables) -> DataFrame:
    rows = text.chunk_articles(t.source.select("dataset", "article"), "article", CHUNK_SIZE, CHUNK_OVERLAP)
    return rows.groupBy("dataset").agg(
        F.count("*").alias("parts"), F.sum(F.length("part_text")).alias("characters")
    )


_SUMMARY_SQL = oracles.rendered(prompts.SUMMARY_TEMPLATE, abstract="abstract", list_of_sections="section_names")


@query(rf"SELECT article_id, len(regexp_extract_all({_SUMMARY_SQL}, '\S+'))::BIGINT AS prompt_tokens FROM src")
def token_count(t: SampleTables) -> DataFrame:
    prompt = prompts.render_template(
        prompts.SUMMARY_TEMPLATE, abstract=c("abstract"), list_of_sections=c("section_names")
    )
    return t.articles.select("article_id", TOKENIZER.count(prompt).alias("prompt_tokens"))


_WHOLE = oracles.rendered(prompts.SUMMARY_TEMPLATE, abstract="article", list_of_sections="section_names")
_HEADS = oracles.rendered(
    prompts.SUMMARY_TEMPLATE,
    abstract=r"array_to_string(regexp_extract_all(article, '\S+')[1:1536], ' ')",
    list_of_sections=r"array_to_string(regexp_extract_all(section_names, '\S+')[1:1536], ' ')",
)


@query(
    rf"""SELECT article_id, n AS prompt_tokens, CASE WHEN n > 2048 THEN {_HEADS} ELSE whole END AS prompt
         FROM (SELECT *, len(regexp_extract_all(whole, '\S+'))::BIGINT AS n FROM (SELECT *, {_WHOLE} AS whole FROM src))"""
)
def truncate_to_budget(t: SampleTables) -> DataFrame:
    """Whole articles take the place of abstracts, so that some prompts are over the budget."""
    fields = {"abstract": "article", "list_of_sections": "section_names"}
    rows = prompts.fit_prompt(t.source, prompts.SUMMARY_TEMPLATE, fields, TOKENIZER)
    return rows.select("article_id", "prompt_tokens", "prompt")


@query(f"SELECT article_id, {_SUMMARY_SQL} AS prompt FROM src")
def render_summary_prompt(t: SampleTables) -> DataFrame:
    prompt = prompts.render_template(
        prompts.SUMMARY_TEMPLATE, abstract=c("abstract"), list_of_sections=c("section_names")
    )
    return t.articles.select("article_id", prompt.alias("prompt"))


_EXTRACTION_SQL = oracles.rendered(prompts.EXTRACTION_TEMPLATE, summary="article_summary", text_to_extract="part_text")


@query(f"SELECT part_id, {_EXTRACTION_SQL} AS prompt FROM win JOIN all_summ USING (article_id)")
def render_extraction_prompt(t: SampleTables) -> DataFrame:
    rows = pending.part_summary_feed(t.register, t.parts, t.all_summaries)
    prompt = prompts.render_template(
        prompts.EXTRACTION_TEMPLATE, summary=c("article_summary"), text_to_extract=c("part_text")
    )
    return rows.select("part_id", prompt.alias("prompt"))


@query(f"SELECT part_id, {oracles.rendered(prompts.CATEGORY_TEMPLATE, text_to_extract='part_text')} AS prompt FROM win")
def render_category_prompt(t: SampleTables) -> DataFrame:
    prompt = prompts.render_template(prompts.CATEGORY_TEMPLATE, text_to_extract=c("part_text"))
    return t.parts.select("part_id", prompt.alias("prompt"))


def _register_training_prompt(name: str) -> None:
    def one_format(t: SampleTables) -> DataFrame:
        return export.training_prompts(_records(t), "part_id").select("part_id", name)

    one_format.__name__ = name
    query(f"SELECT part_id, {oracles.training_prompt(name)} AS {name} FROM wide JOIN pretty USING (part_id)")(one_format)


for _name in prompts.PROMPT_FORMATS:
    _register_training_prompt(_name)


@query(
    f"""UNPIVOT (SELECT part_id, {_PROMPT_COLUMNS} FROM wide JOIN pretty USING (part_id))
        ON {', '.join(prompts.PROMPT_FORMATS)} INTO NAME prompt_name VALUE prompt"""
)
def all_prompt_variants(t: SampleTables) -> DataFrame:
    return export.long_prompts(export.training_prompts(_records(t), "part_id"), "part_id")


@query(
    f"""SELECT article_id, array_to_string(list_filter(string_split(article, ' ') || ['@xmath3', '@xcite', '@xref7 b'],
               lambda n: NOT regexp_matches(n, {oracles.text(oracles.MARKER_PATTERN)})), '|') AS entities FROM src"""
)
def drop_reference_markers(t: SampleTables) -> DataFrame:
    listed = F.concat(F.split("article", " "), F.array(F.lit("@xmath3"), F.lit("@xcite"), F.lit("@xref7 b")))
    return t.source.select("article_id", _joined(text.drop_reference_markers(listed)).alias("entities"))


# JSON repair

_FREE = """d || chr(10) || '```json' || chr(10) || '{"categories": [{"name": "' || a || '", "description": "' || b || '"}]'
    || CASE (article_id + part_no) % 3 WHEN 0 THEN '}' ELSE '' END || CASE (article_id + part_no) % 3 WHEN 2 THEN ' {' ELSE '' END
    || chr(10) || '``` ' || c"""


@query(
    f"""SELECT part_id, CASE (article_id + part_no) % 3 WHEN 2 THEN coalesce(json_extract_string(j, '$.categories[0].name'), '')
               ELSE json_extract_string(j, '$.categories[0].name') END AS name
        FROM (SELECT *, (regexp_extract(free, '(?s)\\{{.*\\]') || '}}')::JSON AS j FROM (SELECT *, {_FREE} AS free FROM filled))"""
)
def json_from_free_text(t: SampleTables) -> DataFrame:
    """Prose around a fenced object: complete, without its last brace, or with a stray brace after it."""
    tokens = F.split("part_text", " ")
    name = F.concat(F.lit("e1"), F.regexp_replace(F.get(tokens, F.lit(0)), "[^A-Za-z0-9]", ""))
    case = F.pmod(c("article_id") + c("part_no"), F.lit(3))
    free = F.concat(
        F.regexp_replace("part_text", r'["\\\[\]{}]', ""),
        F.lit('\n```json\n{"categories": [{"name": "'),
        name,
        F.lit('", "description": "x"}]'),
        F.when(case == 0, F.lit("}")).when(case == 2, F.lit(" {")).otherwise(F.lit("")),
        F.lit("\n``` done"),
    )
    found = answers.json_from_free_text(free)
    return t.windows.select("part_id", F.try_variant_get(found, "$.categories[0].name", "string").alias("name"))


def _stages(t: SampleTables, *columns: str) -> DataFrame:
    return answers.repair_stages(t.all_answers).select("part_id", *columns)


@query("SELECT part_id, normalised FROM r1")
def normalise_layout(t: SampleTables) -> DataFrame:
    return _stages(t, "normalised")


@query("SELECT part_id, own AS own_description, opened FROM r2")
def restore_prefill(t: SampleTables) -> DataFrame:
    return _stages(t, "own_description", "opened")


@query("SELECT part_id, closed FROM r3")
def trim_tail(t: SampleTables) -> DataFrame:
    return _stages(t, "closed")


@query("SELECT part_id, fit, lead, rest FROM r4")
def split_on_entities(t: SampleTables) -> DataFrame:
    return _stages(t, "fit", "lead", "rest")


@query("SELECT part_id, description FROM r5")
def repair_description(t: SampleTables) -> DataFrame:
    return _stages(t, "description")


@query("SELECT part_id, rejoined FROM r6")
def rejoin_lines(t: SampleTables) -> DataFrame:
    return _stages(t, "rejoined")


@query("SELECT part_id, completed FROM r7")
def close_tail(t: SampleTables) -> DataFrame:
    return _stages(t, "completed")


@query("SELECT part_id, repaired_text FROM r8")
def repair_punctuation(t: SampleTables) -> DataFrame:
    return _stages(t, "repaired_text")


@query(
    """SELECT part_id, CASE WHEN reject_reason IS NULL THEN 'accepted' WHEN reject_reason = 'unfit' THEN 'unfit' ELSE 'rejected' END
              AS status, reject_reason FROM judged"""
)
def parse_and_validate(t: SampleTables) -> DataFrame:
    return t.repaired.select("part_id", "status", "reject_reason")


@query("SELECT part_id, answer FROM pretty")
def pretty_answer(t: SampleTables) -> DataFrame:
    good = repair.accepted(t.repaired)
    return good.select("part_id", jsontext.pretty_answer(c("document")).alias("answer"))


def _relation_rows(t: SampleTables) -> DataFrame:
    repaired = answers.repair_stages(t.all_answers).select("part_id", "fit", "repaired_text")
    return repair.relation_rows(repaired, "part_id").withColumn("relation_no", _long("relation_no"))


@query(
    """SELECT part_id, pos AS relation_no,
              coalesce(string_agg(DISTINCT name, '|' ORDER BY name) FILTER (WHERE side = 's'), '') AS sources,
              coalesce(string_agg(DISTINCT name, '|' ORDER BY name) FILTER (WHERE side = 't'), '') AS targets
       FROM rel LEFT JOIN ends USING (part_id, pos) WHERE rel.described GROUP BY part_id, pos"""
)
def coerce_endpoints(t: SampleTables) -> DataFrame:
    rows = _relation_rows(t).where("described")
    return rows.select("part_id", "relation_no", _sorted(c("sources")).alias("sources"), _sorted(c("targets")).alias("targets"))


@query("SELECT part_id, relation_no, strength FROM good_rel")
def pick_strength(t: SampleTables) -> DataFrame:
    return repair.exploded_relations(t.repaired, "part_id").select("part_id", _long("relation_no"), "strength")


@query("SELECT part_id, pos AS relation_no, description FROM kept_rel")
def drop_prompt_example_relations(t: SampleTables) -> DataFrame:
    rows = _relation_rows(t).where("described").where(~documents.mentions_example(c("description")))
    return rows.select("part_id", "relation_no", "description")


@query("SELECT part_id, pos AS relation_no, description FROM rel WHERE described")
def skip_undescribed(t: SampleTables) -> DataFrame:
    return _relation_rows(t).where("described").select("part_id", "relation_no", "description")


@query("SELECT part_id, bool_and(first_key = 'description') AS description_first FROM rel WHERE described GROUP BY part_id")
def description_first_rule(t: SampleTables) -> DataFrame:
    rows = _relation_rows(t).where("described")
    return rows.groupBy("part_id").agg(F.every("first").alias("description_first"))


@query("SELECT part_id, section_description FROM good")
def rename_section_description(t: SampleTables) -> DataFrame:
    return repair.accepted(t.repaired).select("part_id", c("document.section_description").alias("section_description"))


@query("SELECT part_id, raw_relation_text FROM stored")
def serialise_relations(t: SampleTables) -> DataFrame:
    return t.all_relations.select("part_id", "raw_relation_text")


@query(f"SELECT {_RELATION_TEXT}, array_to_string(entities, '|') AS entities FROM good_rel JOIN good_ent USING (part_id)")
def read_fields(t: SampleTables) -> DataFrame:
    rows = graph.read_documents(t.all_relations, "part_id").select(
        "part_id",
        _joined(c("document.list_of_entities")).alias("entities"),
        F.posexplode("document.relations").alias("relation_no", "relation"),
    )
    return rows.select(
        "part_id",
        _long("relation_no"),
        c("relation.description").alias("description"),
        _joined(c("relation.source_entities")).alias("source_entities"),
        _joined(c("relation.target_entities")).alias("target_entities"),
        "entities",
    )


@query(
    """SELECT part_id, 0::BIGINT AS topics_variant, part_id * 16 AS topics_id, article_id * 16 AS article_summary_id, article_id
       FROM good JOIN win USING (part_id)"""
)
def attach_lineage(t: SampleTables) -> DataFrame:
    good = repair.accepted(t.repaired)
    return good.select("part_id", _long("topics_variant"), "topics_id", "article_summary_id", "article_id")


# Relation graph


@query("SELECT source_id, object_id, object_name FROM nodes")
def entity_nodes(t: SampleTables) -> DataFrame:
    return t.nodes


@query("SELECT relation_id, source_id, object_id, subject_id, relation_type FROM edges")
def relation_edges(t: SampleTables) -> DataFrame:
    return t.edges


# Batch inference, with a model that answers with the length and a digest of the prompt


def _models():
    """Defined inside a function, so that they travel to the workers by value."""

    def digest(_: int):
        def predict(texts: list[str]) -> list[str]:
            import hashlib

            return [f"{len(text)} {hashlib.md5(text.encode()).hexdigest()} <<END>> and more" for text in texts]

        return predict

    def choosy(_: int):
        def predict(texts: list[str]) -> list[str]:
            if any("\nfr\n" in text for text in texts):
                raise ValueError("no French")
            return [str(len(text)) for text in texts]

        return predict

    return digest, choosy


_digest_model, _choosy_model = _models()


def _summary_prompts(t: SampleTables) -> DataFrame:
    return render_summary_prompt(t)


_DIGEST = "length(prompt) || ' ' || md5(prompt) || ' '"
_PROMPTED = f"(SELECT *, {_SUMMARY_SQL} AS prompt FROM src)"


@query(f"SELECT article_id, {_DIGEST} || '<<END>> and more' AS output FROM {_PROMPTED}")
def batch_infer(t: SampleTables) -> DataFrame:
    return inference.infer(_summary_prompts(t), _digest_model, ["article_id"]).select("article_id", "output")


@query(f"SELECT article_id, {_DIGEST} AS output FROM {_PROMPTED}")
def stop_sequence(t: SampleTables) -> DataFrame:
    rows = inference.infer(_summary_prompts(t), _digest_model, ["article_id"], stop=text.STOP_SEQUENCE)
    return rows.select("article_id", "output")


@query(
    f"""SELECT article_id, CASE WHEN dataset <> 'fr' THEN length(prompt)::VARCHAR END AS output,
               CASE WHEN dataset = 'fr' THEN 'ValueError: no French' END AS error FROM {_PROMPTED}"""
)
def isolate_failures(t: SampleTables) -> DataFrame:
    return inference.infer(_summary_prompts(t), _choosy_model, ["article_id"])


@query("SELECT (('0x' || substr(md5(article_id::VARCHAR), 1, 15))::BIGINT % 4)::VARCHAR AS model, count(*) AS rows FROM src GROUP BY 1")
def spread_over_models(t: SampleTables) -> DataFrame:
    """Rows per model, of four."""
    spread = inference.spread_over_models(_summary_prompts(t), "article_id", 4)
    rows = inference.infer(spread, lambda number: lambda texts: [str(number)] * len(texts), ["article_id"], model="model_no")
    return rows.groupBy(c("output").alias("model")).agg(F.count("*").alias("rows"))


def _ingested(t: SampleTables) -> stored.Tables:
    tables = pipeline.open_tables(t.spark, shared_folder(t.spark))
    pipeline.insert_articles(tables, t.source.drop("dataset"), "documents", CHUNK_SIZE, CHUNK_OVERLAP)
    return tables


@query(
    """SELECT part_index, chunk_size, chunk_overlap, article_id, part_id, part_text
       FROM reg JOIN win USING (article_id, part_id)
       UNION ALL
       SELECT row_number() OVER (ORDER BY article_id, s) - 1, 32, 8, article_id, (article_id * 16 + 1) * 1048576 + s // 24,
              array_to_string(t[s + 1 : s + 32], ' ')
       FROM (SELECT article_id, t, unnest(range(0, len(t), 24)) AS s FROM tok)"""
)
def two_chunk_configurations(t: SampleTables) -> DataFrame:
    """A second chunk configuration of an ingested corpus, in two runs; the second one has nothing left to do."""
    tables = _ingested(t)
    for _ in range(2):
        pipeline.insert_articles(tables, t.source.drop("dataset"), "documents", 32, 8, config_no=1)
    rows = tables.read("article_part_register").join(tables.read("article_parts"), "part_id")
    return rows.select("part_index", "chunk_size", "chunk_overlap", "article_id", "part_id", "part_text")


@query(
    r"""SELECT dataset, source_article_id, (n_tokens + 47) // 48 AS n_parts
        FROM (SELECT dataset, source_article_id, len(regexp_extract_all(body, '\S+')) AS n_tokens
              FROM (SELECT 'documents' AS dataset, doc_id AS source_article_id, text AS body FROM documents
                    UNION ALL SELECT 'pages', page_id, html FROM pages
                    UNION ALL SELECT 'far', doc_id * 3 + 1099511627776, text FROM documents))
        WHERE n_tokens > 0"""
)
def datasets_with_equal_ids(t: SampleTables) -> DataFrame:
    """Three datasets: two whose ids overlap, and one with ids from 2^40 on; number of parts by dataset and its own id."""
    tables = pipeline.open_tables(t.spark, shared_folder(t.spark))
    pages = t.table("pages").select(
        c("page_id").alias("article_id"), c("html").alias("article"), c("url").alias("abstract"), F.lit("").alias("section_names")
    )
    documents = t.source.drop("dataset")
    far = documents.withColumn("article_id", c("article_id") * 3 + (1 << 40))
    for name, source in {"documents": documents, "pages": pages, "far": far}.items():
        pipeline.insert_articles(tables, source, name, CHUNK_SIZE, CHUNK_OVERLAP)
    parts = tables.select("article_part_register", "article_id").groupBy("article_id").agg(F.count("*").alias("n_parts"))
    return tables.source_ids().join(parts, "article_id").select("dataset", "source_article_id", "n_parts")


def _fitted(template: str, rows: str, **fields: str) -> str:
    """Rows with a ``prompt`` that is cut to the budget."""
    heads = {name: rf"array_to_string(regexp_extract_all({column}, '\S+')[1:1536], ' ')" for name, column in fields.items()}
    return rf"""(SELECT *, CASE WHEN len(regexp_extract_all(whole, '\S+')) > 2048 THEN {oracles.rendered(template, **heads)}
                               ELSE whole END AS prompt FROM (SELECT *, {oracles.rendered(template, **fields)} AS whole FROM {rows}))"""


_FITTED_SUMMARY = _fitted(prompts.SUMMARY_TEMPLATE, "src", abstract="abstract", list_of_sections="section_names")
_FITTED_EXTRACTION = _fitted(
    prompts.EXTRACTION_TEMPLATE, "win JOIN all_summ USING (article_id)", summary="article_summary", text_to_extract="part_text"
)


@query(f"SELECT article_id, {_DIGEST} || '<<END>> and more' AS article_summary, article_id * 16 AS summary_id FROM {_FITTED_SUMMARY}")
def summarise_articles(t: SampleTables) -> DataFrame:
    """Ingest, then summarise in two runs; the second one has nothing left to do but must not fail."""
    tables = _ingested(t)
    amount = 1 << 30
    pipeline.summarise_articles(tables, _digest_model, amount, models=4)
    pipeline.summarise_articles(tables, _digest_model, amount, models=4)
    return tables.select("short_article_summary", "article_id", "article_summary", "summary_id")


@query(
    f"""SELECT part_id, {_DIGEST} AS part_topics, part_id * 16 AS topics_id, summary_id AS article_summary_id
        FROM {_FITTED_EXTRACTION}"""
)
def extract_relations_from_parts(t: SampleTables) -> DataFrame:
    """Extraction over all parts of an ingested corpus."""
    tables = _ingested(t)
    tables.append("short_article_summary", t.all_summaries)
    pipeline.extract_topics(tables, _digest_model, 1 << 30, models=4)
    return tables.select("extracted_part_topics", "part_id", "part_topics", "topics_id", "article_summary_id")


@query("SELECT relation_id, source_id, object_id, subject_id, relation_type FROM edges")
def corpus_to_graph(t: SampleTables) -> DataFrame:
    """The whole flow over stored tables: ingest, answers, repair, documents, nodes, edges."""
    tables = _ingested(t)
    tables.append("short_article_summary", t.all_summaries)
    tables.append("extracted_part_topics", t.all_answers)
    pipeline.clean_relations(tables)
    pipeline.build_graph(tables)
    return tables.read("relations")


# Constraints


def _null_rows() -> str:
    nulls = ("count_if(quality IS DISTINCT FROM 1)", "count_if(toxic IS DISTINCT FROM 1)", "count(*)")
    selects = [
        f"SELECT {oracles.text(table)} AS table_name, {oracles.text(name)} AS column_name, {nulls[i % 3]}::BIGINT AS null_rows FROM labels"
        for table, schema in schemas.TABLES.items()
        for i, name in enumerate(schema.names)
    ]
    return " UNION ALL ".join(selects)


@query(_null_rows())
def check_not_null(t: SampleTables) -> DataFrame:
    """All columns of the nine tables; each table has one more row per label with NULLs that depend on the label."""
    filled = (c("quality") == 1, c("toxic") == 1, F.lit(False))
    reports = []
    for table, rows in t.content.items():
        faults = [F.when(filled[i % 3], F.lit("0")).cast(f.dataType).alias(f.name) for i, f in enumerate(schemas.TABLES[table])]
        reports.append(quality.check_not_null(rows.select(*schemas.TABLES[table].names).union(t.labels.select(*faults)), table))
    return reduce(DataFrame.unionByName, reports)


@query("SELECT article, count(*) AS rows FROM src GROUP BY article HAVING count(*) > 1")
def check_unique(t: SampleTables) -> DataFrame:
    return quality.check_unique(t.source, ("article",))


# Rows that are stored a second time: condition on the table, and its rows in SQL.
_STORED_TWICE = {
    "articles": ("dataset = 'fr'", "src WHERE dataset = 'fr'"),
    "article_part_register": ("part_index >= 100", "reg WHERE part_index >= 100"),
    "article_parts": ("contains(part_text, 'q')", "win WHERE contains(part_text, 'q')"),
    "short_article_summary": ("summary_variant = 1", "summ WHERE summary_variant = 1"),
    "short_part_summary": ("contains(part_summary, 'q')", "part_summ WHERE contains(part_summary, 'q')"),
    "extracted_part_topics": ("article_summary_id >= 800", "ans WHERE article_id >= 50"),
    "extracted_relations_raw": ("article_id >= 50", "raw WHERE article_id >= 50"),
    "relation_objects": ("object_name LIKE 'e1%'", "nodes WHERE object_name LIKE 'e1%'"),
    "relations": ("contains(relation_type, 'q')", "edges WHERE contains(relation_type, 'q')"),
}


def _key_rows() -> str:
    selects = [
        f"""SELECT {oracles.text(table)} AS table_name, {oracles.text(",".join(key))} AS key_columns, count(*) AS repeated_keys,
                   2 * count(*) AS key_rows FROM {_STORED_TWICE[table][1]}"""
        for keys in (schemas.PRIMARY_KEYS, schemas.UNIQUE_KEYS)
        for table, key in keys.items()
    ]
    return " UNION ALL ".join(selects)


@query(_key_rows())
def check_keys(t: SampleTables) -> DataFrame:
    """The 15 declared keys of the nine tables, with some rows stored twice."""
    return quality.check_keys({name: rows.union(rows.where(_STORED_TWICE[name][0])) for name, rows in t.content.items()})


@query(
    """SELECT article_id AS missing_value, count(*) AS rows FROM win WHERE article_id NOT IN (SELECT doc_id FROM labels)
       GROUP BY article_id"""
)
def check_foreign_key(t: SampleTables) -> DataFrame:
    return quality.check_foreign_key(t.register, "article_id", t.labels, "article_id")


# Rows that are missing: condition of those that stay, by table.
_STAYING = {
    "articles": "dataset <> 'fr'",
    "article_parts": "NOT contains(part_text, 'q')",
    "short_article_summary": "summary_variant = 1",
    "relation_objects": "object_name NOT LIKE 'e1%'",
}

# Orphans by reference; the others have none.
_ORPHANS = {
    ("article_part_register", "article_id"): "reg JOIN src USING (article_id) WHERE dataset = 'fr'",
    ("short_article_summary", "article_id"): "summ JOIN src USING (article_id) WHERE summary_variant = 1 AND dataset = 'fr'",
    ("short_part_summary", "part_id"): "part_summ JOIN win USING (part_id) WHERE contains(part_text, 'q')",
    ("short_part_summary", "article_summary_id"): "part_summ",
    ("extracted_part_topics", "part_id"): "ans JOIN win USING (part_id) WHERE contains(part_text, 'q')",
    ("extracted_part_topics", "article_summary_id"): "ans",
    ("extracted_relations_raw", "part_id"): "raw JOIN win USING (part_id) WHERE contains(part_text, 'q')",
    ("extracted_relations_raw", "article_summary_id"): "raw",
    ("relation_objects", "source_id"): "nodes WHERE object_name NOT LIKE 'e1%' AND source_id NOT IN (SELECT relation_id FROM raw)",
    ("relations", "source_id"): "edges WHERE source_id NOT IN (SELECT relation_id FROM raw)",
    ("relations", "object_id"): "edges JOIN nodes USING (object_id) WHERE object_name LIKE 'e1%'",
    ("relations", "subject_id"): "edges JOIN nodes ON nodes.object_id = subject_id WHERE object_name LIKE 'e1%'",
}


def _orphan_rows() -> str:
    selects = [
        f"SELECT {oracles.text(child)} AS child_table, {oracles.text(column)} AS child_column, {oracles.text(parent)} AS parent_table, "
        + (f"(SELECT count(*) FROM {_ORPHANS[child, column]})" if (child, column) in _ORPHANS else "0::BIGINT")
        + " AS orphan_rows"
        for child, column, parent, _ in schemas.FOREIGN_KEYS
    ]
    return " UNION ALL ".join(selects)


@query(_orphan_rows())
def check_references(t: SampleTables) -> DataFrame:
    """The 16 declared references between the nine tables, with some rows missing (all summaries of variant 0 among them)."""
    return quality.check_references({name: rows.where(_STAYING.get(name, "true")) for name, rows in t.content.items()})
