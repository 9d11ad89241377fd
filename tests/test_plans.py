"""Physical plans: what must not be in them, and what must."""

import json
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.ingest import article_parts
from corpusloom.plans.queries import QUERIES
from corpusloom.plans.sample_tables import CHUNK_OVERLAP, CHUNK_SIZE, TOKENIZER, SampleTables, with_raw_answer

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"batch_infer", "stop_sequence", "isolate_failures", "spread_over_models"}
WRITING = {"summarise_articles", "extract_relations_from_parts", "corpus_to_graph", "create_tables"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in WRITING])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](SampleTables(spark, FOLDER)))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    if name not in PYTHON:
        assert "Python" not in text and "InPandas" not in text


def test_filters_reach_the_scan(spark):
    tables = SampleTables(spark, FOLDER)
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id" in plan(QUERIES["resume_after"](tables))
    assert "LessThan(doc_id,10000)" in plan(QUERIES["id_bound"](tables))


def test_columns_are_pruned(spark):
    tables = SampleTables(spark, FOLDER)
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan(QUERIES["id_bound"](tables))


def test_a_limit_is_a_filter(spark):
    """Ids are cut first; the texts of the chosen ones are not sorted, and no single task takes them."""
    tables = SampleTables(spark, FOLDER)
    for name in ("order_limit", "order_two_keys_limit", "pending_articles", "pending_parts"):
        text = plan(QUERIES[name](tables))
        assert "TakeOrderedAndProject" not in text and "GlobalLimit" not in text and "SinglePartition" not in text


def test_each_document_is_parsed_once(spark, monkeypatch):
    from corpusloom.operators import graph, ordinals

    seen = []
    monkeypatch.setattr(ordinals, "written", lambda df: seen.append(plan(df)) or df)
    raw = spark.range(3).select(F.col("id").alias("article_id"), F.col("id").alias("relation_id"), F.concat(F.lit('{"a": '), F.col("id"), F.lit("}")).alias("raw_relation_text"))
    graph.placed_documents(raw)
    assert len(seen) == 1 and seen[0].count("from_json(") == 1 and seen[0].count("Exchange rangepartitioning") == 1
    assert seen[0].index("from_json(") < seen[0].index("Exchange")  # above the shuffle


def shuffled_columns(spark, df) -> list[str]:
    """The columns of every shuffle, if nothing is broadcast."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", df._jdf.queryExecution().explainString(mode))


def test_abstracts_are_cut_before_texts_are_moved(spark):
    moved = shuffled_columns(spark, SampleTables(spark, FOLDER).articles)
    assert len(moved) == 1 and "abstract" in moved[0] and "text" not in moved[0]


def export_tables(spark):
    """Repeated and missing keys in all five tables; part 4 is given by relations of two articles."""
    topics = spark.createDataFrame([(1, 16), (1, 16), (2, 16), (3, 32), (4, 32), (5, None), (None, 16), (6, 99)], "part_id long, article_summary_id long")
    relations = spark.createDataFrame(
        [(1, 1, "r"), (1, 1, "r"), (2, 1, "s"), (3, 2, "t"), (4, 2, "u"), (4, 1, "v"), (4, 1, "w"), (5, 1, "x"), (6, 1, "y"), (None, 1, "z"), (3, None, "n"), (3, 9, "m")],
        "part_id long, article_id long, raw_relation_text string",
    )
    parts = spark.createDataFrame([(1, "p1"), (2, "p2"), (2, "p2 again"), (3, None), (4, "p4"), (5, "p5"), (None, "p")], "part_id long, part_text string")
    summaries = spark.createDataFrame([(16, "S1", 1), (32, "S2", 2), (32, "S2 again", 2), (None, "S", 3)], "summary_id long, article_summary string, article_id long")
    articles = spark.createDataFrame([(1, "d", "a1", "n"), (2, "d", "a2", "n"), (2, "e", "a2 again", None), (None, "d", "a", "n")], "article_id long, dataset string, abstract string, section_names string")
    return topics, relations, parts, summaries, articles


def test_export_moves_long_texts_once(spark):
    from corpusloom.operators.export import export_records

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = shuffled_columns(spark, export_records(*export_tables(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for name in ("raw_relation_text", "part_text"):
        assert sum(name in columns or {"raw_relation_text": "extracted_relations", "part_text": "text_part"}[name] in columns for columns in moved) == 1


def test_export_joins_repeated_and_missing_keys(spark):
    from corpusloom.operators.export import export_records

    topics, relations, parts, summaries, articles = [df.collect() for df in export_tables(spark)]
    wanted = [
        (t[0], s[1], p[1], r[2], a[1], a[2], a[3])
        for t in topics for r in relations if t[0] is not None and t[0] == r[0]
        for s in summaries if t[1] is not None and t[1] == s[0]
        for a in articles if r[1] is not None and r[1] == a[0]
        for p in parts if p[0] == t[0]
    ]
    found = [tuple(row) for row in export_records(*export_tables(spark)).collect()]
    assert len(wanted) > 10 and sorted(map(repr, found)) == sorted(map(repr, wanted))


def test_part_texts_are_shuffled_once(spark):
    from corpusloom.operators.pending import part_summary_feed

    register = spark.range(9).select(F.col("id").alias("part_id"), F.col("id").alias("article_id"))
    parts = spark.range(9).select(F.col("id").alias("part_id"), F.uuid().alias("part_text"))
    summaries = register.select("article_id", F.col("part_id").alias("summary_id"), F.lit("s").alias("article_summary"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = part_summary_feed(register, parts, summaries)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert len(shuffled) >= 3 and sum("part_text" in columns for columns in shuffled) == 1


def test_each_text_is_tokenized_once(spark):
    # The plan before it is stored.
    parts = article_parts(SampleTables(spark, FOLDER).source, CHUNK_SIZE, CHUNK_OVERLAP, TOKENIZER)
    assert plan(parts).count("regexp_extract_all") == 1


def test_a_filter_does_not_repeat_the_repair(spark):
    repaired = SampleTables(spark, FOLDER).repaired
    once = plan(repaired).count("parseJson")
    assert plan(repaired.where("status = 'accepted'")).count("parseJson") == once == 1


def test_each_json_text_is_built_once(spark):
    """Lists inside lists are measured by what is given: six texts are escaped, each at one place of the plan."""
    from corpusloom.functions.documents import read_document
    from corpusloom.functions.jsontext import pretty_answer

    df = spark.range(1).select(F.uuid().alias("text")).select(read_document(F.col("text")).alias("document"))
    assert plan(df.select(pretty_answer(F.col("document")).alias("answer"))).count("regexp_extract_all(") == 6


def test_a_relation_is_cast_once(spark):
    from corpusloom.functions.documents import relation_facts, relation_texts, variant_list

    df = spark.range(1).select(F.uuid().alias("text")).withColumn("parsed", F.try_parse_json("text"))
    facts = relation_facts(variant_list(F.col("parsed"), "$.relations"), relation_texts(F.col("text")))
    assert plan(df.select(facts.alias("facts"))).lower().count("map<string,variant>") <= 1


def test_answers_are_put_together_without_replacements(spark):
    answers = with_raw_answer(spark.range(1).selectExpr("id AS article_id", "id AS part_no", "uuid() AS part_text"))
    assert re.findall(r"(?<!regexp_)replace\(", plan(answers)) == []


def test_key_order_is_read_from_braces(spark):
    """Texts of relations are parsed only where the braces leave the order of the keys open."""
    from corpusloom.functions.documents import descriptions_open, relation_facts, relation_texts, variant_list

    described = '{"description": "d", "source_entity": "a", "target_entity": "b"}'
    opened = [
        '{"description": "x", "relations": [%s]}' % described,
        '{\n"description": "x", "relations": [{ "description": null}, 5, null, []]}',
        '{"description": "x", "relations": []}',
    ]
    left_open = [
        '{"description": "x", "relations": [{"source_entity": "a", "description": "d"}]}',
        '{"description": "x", "relations": [{}, {"d\\u0065scription": "d"}, %s]}' % described,
        '{"description": "{\\"description\\"", "relations": [%s]}' % described,
        '{"relations": [{"source_entity": {"description": "d"}, "description": "d"}], "relations": [%s]}' % described,
    ]
    rows = [(text, True) for text in opened] + [(text, False) for text in left_open]
    df = spark.createDataFrame(rows, "text string, opened boolean").withColumn("relations", variant_list(F.try_parse_json("text"), "$.relations"))
    untouched = F.when(descriptions_open(F.col("text")), F.raise_error("parsed").cast("array<string>")).otherwise(relation_texts(F.col("text")))
    both = df.select(
        "opened",
        descriptions_open(F.col("text")).alias("found"),
        relation_facts(F.col("relations"), relation_texts(F.col("text"))).alias("by_text"),
        relation_facts(F.col("relations"), untouched, descriptions_open(F.col("text"))).alias("by_braces"),
    )

    def known(name):
        return F.transform(F.filter(name, lambda r: r["described"]), lambda r: F.struct(r["first"], r["description"], r["object"]))

    for row in both.select("opened", "found", known("by_text").alias("by_text"), known("by_braces").alias("by_braces")).collect():
        assert row["opened"] == row["found"] and row["by_text"] == row["by_braces"]


def test_escapes_are_one_literal(monkeypatch):
    """A list of thousands of literals would be made and planned anew at every place that writes a JSON string."""
    from corpusloom.functions import jsontext

    made = []
    lit = F.lit
    monkeypatch.setattr(jsontext.F, "lit", lambda value: made.append(value) or lit(value))
    jsontext.json_string(F.col("text"))
    assert len(made) < 50


def test_every_listed_escape(spark):
    from corpusloom.functions.jsontext import json_string

    texts = [chr(code) + "a" for code in range(0x900)]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    for ascii_only in (True, False):
        for text, found in df.select("text", json_string(F.col("text"), ascii_only)).collect():
            assert found == json.dumps(text, ensure_ascii=ascii_only)


def test_answers_are_not_carried_along(spark):
    """The answer is read by the repair only: no later step copies it, unless the caller asks for it."""
    repaired = SampleTables(spark, FOLDER).repaired
    assert "part_topics" not in plan(repaired.select("part_id", "status", "document"))
    assert "part_topics" in plan(repaired.select("part_topics", "status"))


def test_doubled_rule_is_tested_once(spark):
    from corpusloom.functions.answers import replace_in_order

    rules = (("  ", " "), ("  ", " "), ("aa", "b"), ("  ", " "), ("bb", "a"), ("bb", "a"), ("bb", "a"))
    texts = ["", "a", "a    b", " " * 9, "aaaa     aaaa", "bbbbbbbbb", "aabaab  bb", None]
    df = spark.createDataFrame([(text,) for text in texts], "text string").select("text", replace_in_order(F.col("text"), rules).alias("done"))
    for text, done in df.collect():
        for find, put in rules if text else ():
            text = text.replace(find, put)
        assert done == text
    # The places of the rules in the plan: four runs of equal rules.
    steps = df._jdf.queryExecution().analyzed().toString()
    assert steps.count("struct(find") + steps.count("named_struct(find") == 4
