"""Entity nodes and relation edges of stored relation documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.documents import read_document
from corpusloom.operators.ordinals import exclusive_prefix_sums
from corpusloom.operators.rows import exploded


def read_documents(raw_relations: DataFrame, *keys: str) -> DataFrame:
    """Key columns and the parsed ``document`` of raw relation rows."""
    return raw_relations.select(*keys, read_document(F.col("raw_relation_text")).alias("document"))


def document_edges(document: Column) -> Column:
    """Edges of one document as positions in its own entity list.

    A name is looked up in the list of the same document only, so no join is needed. A pair with a name
    that is not listed is dropped; so is a relation without ends. The product of sources and targets is
    that of a single relation.
    """
    names = document["list_of_entities"]

    def positions(ends: Column) -> Column:
        found = F.transform(ends, lambda name: F.array_position(names, name))
        return F.filter(found, lambda at: at > 0)

    def edges(relation: Column) -> Column:
        targets = positions(relation["target_entities"])
        pairs = F.transform(
            positions(relation["source_entities"]),
            lambda source: F.transform(
                targets,
                lambda target: F.struct(
                    source.alias("source_at"),
                    target.alias("target_at"),
                    relation["description"].alias("relation_type"),
                ),
            ),
        )
        return F.flatten(pairs)

    return F.flatten(F.transform(document["relations"], edges))


def placed_documents(raw_relations: DataFrame) -> DataFrame:
    """``(source_id, names, edges, node_offset, edge_offset)`` per document.

    Ids are dense in (article, document, position) order. Both offsets come from one prefix sum; it shuffles every stored
    document once and parses it once, behind the shuffle. Nodes and edges are exploded from the result without a join.
    """

    def parsed(rows: DataFrame) -> DataFrame:
        documents = read_documents(rows, "article_id", "relation_id")
        names = F.col("document.list_of_entities").alias("names")
        return documents.select("article_id", "relation_id", names, document_edges(F.col("document")).alias("edges"))

    placed = exclusive_prefix_sums(
        raw_relations.select("article_id", "relation_id", "raw_relation_text"),
        ["article_id", "relation_id"],
        {"node_offset": F.size("names"), "edge_offset": F.size("edges")},
        derive=parsed,
    )
    return placed.withColumnRenamed("relation_id", "source_id")


def entity_nodes(placed: DataFrame, first_id: int = 1) -> DataFrame:
    """One node per entity of a document; equal names of two documents stay two nodes."""
    first = (F.col("node_offset") + first_id).alias("_first")
    rows = exploded(placed, ["source_id", first], "names", "_at", "object_name")
    return rows.select("source_id", (F.col("_first") + F.col("_at")).alias("object_id"), "object_name")


def relation_edges(placed: DataFrame, first_node_id: int = 1, first_id: int = 1) -> DataFrame:
    """Edges: ``object_id`` is the source entity, ``subject_id`` the target entity."""
    before_nodes = (F.col("node_offset") + first_node_id - 1).alias("_node")
    first = (F.col("edge_offset") + first_id).alias("_first")
    rows = exploded(placed, ["source_id", before_nodes, first], "edges", "_at", "_edge")
    return rows.select(
        (F.col("_first") + F.col("_at")).alias("relation_id"),
        "source_id",
        (F.col("_node") + F.col("_edge.source_at")).alias("object_id"),
        (F.col("_node") + F.col("_edge.target_at")).alias("subject_id"),
        F.col("_edge.relation_type").alias("relation_type"),
    )


def source_target_pairs(documents: DataFrame, key: str = "relation_id") -> DataFrame:
    """Every source name with every target name, inside one relation of one document."""
    source_id = F.col(key).alias("source_id")
    relations = exploded(documents, [source_id], "document.relations", "relation_no", "relation")
    sources = relations.select(
        "source_id",
        "relation_no",
        F.col("relation.description").alias("relation_type"),
        F.explode("relation.source_entities").alias("source_name"),
        F.col("relation.target_entities").alias("_targets"),
    )
    return sources.select(
        "source_id", "relation_no", "relation_type", "source_name", F.explode("_targets").alias("target_name")
    )


def resolve_entities(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Names to the ids of stored nodes of the same document; a pair with an unknown name is dropped.

    Joined on (document, name), so a name that occurs in every document is no hot key.
    """
    sources = nodes.select("source_id", F.col("object_name").alias("source_name"), "object_id")
    targets = nodes.select(
        "source_id", F.col("object_name").alias("target_name"), F.col("object_id").alias("subject_id")
    )
    return pairs.join(sources, ["source_id", "source_name"]).join(targets, ["source_id", "target_name"])


def nodes_among(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """Nodes whose document and name occur in ``names``; the IN list is data, so it is a semi join."""
    return nodes.join(names, ["source_id", "object_name"], "left_semi").select(*nodes.columns)
