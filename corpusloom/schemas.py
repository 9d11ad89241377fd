"""Fixed schemas of the nine stored tables, with their keys and references.

Generated ids are LONG: they are packed or dense ids over a corpus that may hold billions of rows.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in columns.items()])


_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()

TABLES: dict[str, T.StructType] = {
    "articles": _table(article_id=_LONG, dataset=_TEXT, abstract=_TEXT, section_names=_TEXT),
    "article_part_register": _table(
        part_index=_LONG, chunk_size=_INT, chunk_overlap=_INT, article_id=_LONG, part_id=_LONG
    ),
    "article_parts": _table(part_id=_LONG, part_text=_TEXT),
    "short_article_summary": _table(
        article_id=_LONG, article_summary=_TEXT, summary_variant=_INT, summary_id=_LONG
    ),
    "short_part_summary": _table(
        part_id=_LONG, part_summary=_TEXT, summary_variant=_INT, summary_id=_LONG, article_summary_id=_LONG
    ),
    "extracted_part_topics": _table(
        part_id=_LONG, part_topics=_TEXT, topics_variant=_INT, topics_id=_LONG, article_summary_id=_LONG
    ),
    "extracted_relations_raw": _table(
        article_id=_LONG,
        part_id=_LONG,
        part_summary_id=_LONG,
        part_topics_id=_LONG,
        article_summary_id=_LONG,
        relation_id=_LONG,
        raw_relation_text=_TEXT,
        relations_variant=_INT,
    ),
    "relation_objects": _table(source_id=_LONG, object_id=_LONG, object_name=_TEXT),
    "relations": _table(
        relation_id=_LONG, source_id=_LONG, object_id=_LONG, subject_id=_LONG, relation_type=_TEXT
    ),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "articles": ("article_id",),
    "article_part_register": ("part_id",),
    "article_parts": ("part_id",),
    "short_article_summary": ("article_id", "summary_variant"),
    "short_part_summary": ("part_id", "summary_variant"),
    "extracted_part_topics": ("part_id", "topics_variant"),
    "extracted_relations_raw": ("relation_id", "relations_variant"),
    "relation_objects": ("object_id", "object_name"),
    "relations": ("relation_id",),
}

UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "article_part_register": ("part_index", "chunk_size", "chunk_overlap", "article_id"),
    "short_article_summary": ("summary_id",),
    "short_part_summary": ("summary_id",),
    "extracted_part_topics": ("topics_id",),
    "extracted_relations_raw": ("relation_id",),
    "relation_objects": ("object_id",),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("article_part_register", "article_id", "articles", "article_id"),
    ("article_parts", "part_id", "article_part_register", "part_id"),
    ("short_article_summary", "article_id", "articles", "article_id"),
    ("short_part_summary", "part_id", "article_parts", "part_id"),
    ("short_part_summary", "article_summary_id", "short_article_summary", "summary_id"),
    ("extracted_part_topics", "part_id", "article_parts", "part_id"),
    ("extracted_part_topics", "article_summary_id", "short_article_summary", "summary_id"),
    ("extracted_relations_raw", "article_id", "articles", "article_id"),
    ("extracted_relations_raw", "part_id", "article_parts", "part_id"),
    ("extracted_relations_raw", "part_summary_id", "short_part_summary", "summary_id"),
    ("extracted_relations_raw", "part_topics_id", "extracted_part_topics", "topics_id"),
    ("extracted_relations_raw", "article_summary_id", "short_article_summary", "summary_id"),
    ("relation_objects", "source_id", "extracted_relations_raw", "relation_id"),
    ("relations", "source_id", "extracted_relations_raw", "relation_id"),
    ("relations", "object_id", "relation_objects", "object_id"),
    ("relations", "subject_id", "relation_objects", "object_id"),
)

# Tables that are laid out on disk by a variant column, so one variant can be replaced alone.
PARTITION_COLUMNS: dict[str, str] = {
    "short_article_summary": "summary_variant",
    "short_part_summary": "summary_variant",
    "extracted_part_topics": "topics_variant",
    "extracted_relations_raw": "relations_variant",
}

WIDE_EXPORT = T.StructType(
    [
        T.StructField(name, _TEXT)
        for name in (
            "general_text_summary",
            "text_part",
            "extracted_relations",
            "dataset",
            "abstract",
            "section_names",
        )
    ]
)
CORE_EXPORT = T.StructType(WIDE_EXPORT.fields[:3])

RELATION = T.StructType(
    [
        T.StructField("description", _TEXT),
        T.StructField("source_entities", T.ArrayType(_TEXT)),
        T.StructField("target_entities", T.ArrayType(_TEXT)),
        T.StructField("strength", _TEXT),
    ]
)
RELATION_DOCUMENT = T.StructType(
    [
        T.StructField("list_of_entities", T.ArrayType(_TEXT)),
        T.StructField("relations", T.ArrayType(RELATION)),
        T.StructField("section_description", _TEXT),
    ]
)
