"""The whole flow with a model that answers in a fixed way, run twice and with failures."""

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import quality
from corpusloom.plans import pipeline
from corpusloom.sources.tables import StillReferenced


def _models():
    """Defined inside a function, so that they travel to the workers by value."""

    def summariser(_):
        def predict(texts):
            return [f"about {len(text)}" for text in texts]

        return predict

    def extractor(_):
        def predict(texts):
            if any("poison" in text for text in texts):
                raise RuntimeError("refused")
            relation = '{\n"description": "a to b",\n"source_entity": "a",\n"target_entity": "b"\n}'
            opening = "a long enough description of this part " * 6
            return [f'{opening}",\n"list_of_entities": ["a", "b"],\n"relations": [\n{relation}\n]\n}}<<END>>x' for _ in texts]

        return predict

    return summariser, extractor


summariser, extractor = _models()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return pipeline.open_tables(spark, str(tmp_path_factory.mktemp("tables")))


@pytest.fixture(scope="module")
def source(spark):
    texts = ["one two three four five six", "   ", "poison two", "x\0y z"]
    return spark.createDataFrame(
        [(i, text, f"abstract {i}", "s1\ns2") for i, text in enumerate(texts)],
        "article_id long, article string, abstract string, section_names string",
    )


def counts(tables):
    return {name: tables.read(name).count() for name in schemas.TABLES}


def test_ingest(tables, source):
    for _ in range(2):
        pipeline.insert_articles(tables, source, "first", 4, 1)
    assert {r["article_id"] for r in tables.read("articles").collect()} == {0, 2, 3}
    register = tables.read("article_part_register").orderBy("part_index").collect()
    assert [(r["part_index"], r["article_id"]) for r in register] == [(0, 0), (1, 0), (2, 2), (3, 3)]
    assert {r["part_text"] for r in tables.read("article_parts").collect()} == {
        "one two three four", "four five six", "poison two", "xy z"
    }


def test_ingest_goes_on(spark, tables, source):
    more = source.where("article_id = 0").withColumn("article_id", F.lit(10).cast("long"))
    pipeline.insert_articles(tables, source.unionByName(more), "first", 4, 1)
    register = tables.read("article_part_register").where("article_id = 10").orderBy("part_index").collect()
    assert [r["part_index"] for r in register] == [4, 5]


def test_interrupted_ingest_is_completed(spark, source, tmp_path):
    tables = pipeline.open_tables(spark, str(tmp_path))
    pipeline.insert_articles(tables, source, "first", 4, 1)
    halfway = pipeline.open_tables(spark, str(tmp_path / "halfway"))
    halfway.append("article_parts", tables.read("article_parts"))
    pipeline.insert_articles(halfway, source, "first", 4, 1)
    assert counts(halfway) == counts(tables)


def test_second_configuration_of_stored_articles(spark, source, tmp_path):
    tables = pipeline.open_tables(spark, str(tmp_path))
    pipeline.insert_articles(tables, source.where("article_id < 3"), "first", 4, 1)
    more = source.where("article_id = 0").withColumn("article_id", F.lit(10).cast("long"))
    for _ in range(2):
        pipeline.insert_articles(tables, source.unionByName(more), "first", 2, 0, config_no=1)
    register = tables.read("article_part_register").where("chunk_size = 2").orderBy("part_index").collect()
    assert [(r["part_index"], r["article_id"]) for r in register] == list(enumerate([0, 0, 0, 2, 3, 10, 10, 10]))
    assert sorted(r["article_id"] for r in tables.read("articles").collect()) == [0, 2, 3, 10]
    for _ in range(2):
        pipeline.insert_articles(tables, source.unionByName(more), "first", 4, 1)
    first = tables.read("article_part_register").where("chunk_size = 4").collect()
    assert sorted(r["article_id"] for r in first) == [0, 0, 2, 3, 10, 10]
    assert tables.read("article_parts").count() == len(first) + len(register)
    with pytest.raises(ValueError, match="another chunk size"):
        pipeline.insert_articles(tables, source, "first", 8, 1)


def test_generation_and_resume(tables):
    pipeline.summarise_articles(tables, summariser, 1000, models=2)
    assert tables.read("short_article_summary").count() == 4
    again = pipeline.summarise_articles(tables, summariser, 1000, models=2)
    assert again.count() == 0

    answers = pipeline.extract_topics(tables, extractor, 1000, models=2)
    failed = answers.where("error is not null").collect()
    assert len(failed) == 1 and failed[0]["output"] is None and "refused" in failed[0]["error"]
    assert tables.read("extracted_part_topics").count() == 5
    assert tables.read("extracted_part_topics").where(F.contains("part_topics", F.lit("<<END>>"))).count() == 0
    retried = pipeline.extract_topics(tables, summariser, 1000, granularity="part")
    assert retried.count() == 1 and tables.read("extracted_part_topics").count() == 6
    assert pipeline.extract_topics(tables, extractor, 6) is None


def test_overwriting_a_variant(tables):
    pipeline.summarise_articles(tables, summariser, 3, summary_variant=1)
    before = tables.read("short_article_summary").where("summary_variant = 0").count()
    pipeline.summarise_articles(tables, lambda _: lambda texts: ["new"] * len(texts), 3, 1, overwrite_variant=True)
    stored = tables.read("short_article_summary")
    assert {r["article_summary"] for r in stored.where("summary_variant = 1").collect()} == {"new"}
    assert stored.where("summary_variant = 0").count() == before


def test_stop_keeps_the_slices_before(spark, tables, tmp_path):
    """A model that cannot be loaded any more stops the call; the next one asks only for the rest."""
    stopped = pipeline.open_tables(spark, str(tmp_path / "stopped"))
    articles = spark.range(40).select(
        F.col("id").alias("article_id"), F.lit("t").alias("article"), F.lit("s").alias("section_names"),
        F.format_string("abstract %d", "id").alias("abstract"), F.lit("first").alias("dataset"),
    )
    stopped.append("articles", articles)
    marker = tmp_path / "asked"
    marker.mkdir()

    def failing(folder, most):
        def factory(_):
            import os
            import uuid

            if len(os.listdir(folder)) >= most:
                raise RuntimeError("out of memory")

            def predict(texts):
                for _ in texts:
                    open(f"{folder}/{uuid.uuid4().hex}", "w").close()
                return ["answer"] * len(texts)

            return predict

        return factory

    with pytest.raises(Exception, match="out of memory"):
        pipeline.summarise_articles(stopped, failing(str(marker), 15), 1000, models=1, tasks_per_model=1, slice_rows=10)
    kept = stopped.read("short_article_summary").count()
    asked = len(list(marker.iterdir()))
    assert 0 < kept < 40 and kept == asked
    rest = pipeline.summarise_articles(stopped, failing(str(marker), 1000), 1000, models=2, slice_rows=10)
    assert rest.count() == 40 - kept and len(list(marker.iterdir())) == 40
    assert stopped.read("short_article_summary").count() == 40


def test_slices_keep_articles_together(spark):
    from corpusloom.operators import inference

    df = spark.range(1000).select(F.col("id"), (F.col("id") % 50).alias("article"))
    placed, slices = inference.in_slices(df, F.col("article"), 100)
    assert slices == 10 and placed.count() == 1000
    assert placed.select("article", "slice").distinct().count() == 50
    assert placed.select("slice").distinct().count() > 5


def test_referenced_variant_is_not_removed(tables):
    before = counts(tables)
    with pytest.raises(StillReferenced):
        pipeline.summarise_articles(tables, summariser, 3, summary_variant=0, overwrite_variant=True)
    assert counts(tables) == before


def test_variant_without_new_rows_is_removed(spark, tables, tmp_path):
    other = pipeline.open_tables(spark, str(tmp_path / "other"))
    other.append("short_article_summary", tables.read("short_article_summary"))
    pipeline.summarise_articles(other, summariser, 3, summary_variant=1, overwrite_variant=True)
    left = {r[0] for r in other.select("short_article_summary", "summary_variant").distinct().collect()}
    assert left == {0}
    other.release()
    assert not (tmp_path / "other" / "_staged").exists()


def test_cleaning_graph_and_export(tables, tmp_path):
    report = pipeline.clean_relations(tables).first()
    assert (report["tested"], report["correct"], report["unfit"]) == (6, 5, 1)
    assert tables.read("short_part_summary").count() == 5
    assert tables.read("extracted_relations_raw").count() == 5
    pipeline.build_graph(tables)
    nodes, edges = tables.read("relation_objects"), tables.read("relations")
    assert (nodes.count(), edges.count()) == (10, 5)
    names = {(r["source_id"], r["object_id"]): r["object_name"] for r in nodes.collect()}
    for edge in edges.collect():
        assert names[edge["source_id"], edge["object_id"]] == "a"
        assert names[edge["source_id"], edge["subject_id"]] == "b"

    before = counts(tables)
    again = pipeline.clean_relations(tables).first()
    pipeline.build_graph(tables)
    # Only the answer that could not be repaired is tried again.
    assert again["tested"] == 1 and counts(tables) == before

    prompts = pipeline.export_dataset(tables, str(tmp_path))
    assert prompts.count() == 5 and len(prompts.columns) == 6


def test_constraints_hold(tables):
    content = {name: tables.read(name) for name in schemas.TABLES}
    orphans = quality.check_references(content).where("orphan_rows > 0").collect()
    assert orphans == []
    for keys in schemas.PRIMARY_KEYS, schemas.UNIQUE_KEYS:
        for name, key in keys.items():
            assert quality.check_unique(content[name], key).count() == 0


def test_graph_restart_stores_edges_once(spark, tables, tmp_path, monkeypatch):
    """A run that stopped inside its edges or after them: its folder goes, and the next run stores everything once."""
    halfway = pipeline.open_tables(spark, str(tmp_path / "stopped"))
    halfway.append("extracted_relations_raw", tables.read("extracted_relations_raw"))
    monkeypatch.setattr(pipeline.graph, "entity_nodes", lambda placed, first: placed.select(F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception):
        pipeline.build_graph(halfway)
    assert halfway.read("relations").count() == 5
    monkeypatch.undo()
    for _ in range(2):
        pipeline.build_graph(halfway)
    for name in ("relations", "relation_objects"):
        assert sorted(map(tuple, halfway.read(name).collect())) == sorted(map(tuple, tables.read(name).collect()))


def test_graph_goes_on_from_the_last_run(spark, tables, tmp_path, monkeypatch):
    """Numbers follow those of the run before, whose edges are not read."""
    other = pipeline.open_tables(spark, str(tmp_path / "two"))
    raw = tables.read("extracted_relations_raw")
    some = raw.orderBy("relation_id").limit(2)
    other.append("extracted_relations_raw", some)
    pipeline.build_graph(other)
    other.append("extracted_relations_raw", raw.join(some.select("relation_id"), "relation_id", "left_anti"))
    read, names = type(other).read, []
    monkeypatch.setattr(type(other), "read", lambda self, name: names.append(name) or read(self, name))
    pipeline.build_graph(other)
    assert "relations" not in names
    assert sorted(r.relation_id for r in read(other, "relations").collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.object_id for r in read(other, "relation_objects").collect()) == list(range(1, 11))


def test_datasets_with_equal_and_distant_ids(spark, source, tmp_path):
    """Ids of each dataset are its own, however large; all six steps take them."""
    tables = pipeline.open_tables(spark, str(tmp_path))
    shifts = {"first": 0, "second": 0, "far": 1 << 40, "below": -(1 << 50)}
    for _ in range(2):
        for name, shift in shifts.items():
            pipeline.insert_articles(tables, source.withColumn("article_id", F.col("article_id") + shift), name, 4, 1)
    found = sorted((r.dataset, r.source_article_id) for r in tables.source_ids().collect())
    assert found == sorted((name, n + shift) for name, shift in shifts.items() for n in (0, 2, 3))
    assert sorted(r.article_id for r in tables.read("articles").where("dataset = 'first'").collect()) == [0, 2, 3]
    register = tables.read("article_part_register")
    assert sorted(r.part_index for r in register.collect()) == list(range(16))
    later = source.where("article_id = 0").withColumn("article_id", F.lit((1 << 40) + 7))
    pipeline.insert_articles(tables, later, "far", 4, 1)
    assert tables.read("articles").count() == 13
    pipeline.summarise_articles(tables, summariser, 1 << 62)
    pipeline.extract_topics(tables, extractor, 1000)
    pipeline.clean_relations(tables)
    pipeline.build_graph(tables)
    assert pipeline.export_dataset(tables, str(tmp_path / "export")).count() == tables.read("relations").count() == 14
    content = {name: tables.read(name) for name in schemas.TABLES}
    assert quality.check_references(content).where("orphan_rows > 0").collect() == []
    assert quality.check_keys(content).where("repeated_keys > 0").collect() == []


def test_articles_are_scanned_once_and_not_shuffled(spark, source, tmp_path, monkeypatch):
    """The long text goes from the scan to the parts; what lacks parts of a configuration and is not given is returned."""
    source.write.parquet(str(tmp_path / "source"))
    given = spark.read.parquet(str(tmp_path / "source"))
    tables = pipeline.open_tables(spark, str(tmp_path / "tables"))
    pipeline.insert_articles(tables, given, "first", 4, 1)
    append, plans = type(tables).append, {}
    monkeypatch.setattr(type(tables), "append", lambda self, name, rows: plans.update({name: rows._jdf.queryExecution().executedPlan().toString()}) or append(self, name, rows))
    more = given.withColumn("article_id", F.col("article_id") + 10)
    assert pipeline.insert_articles(tables, more, "first", 4, 1).collect() == []
    assert "Exchange" not in plans["article_parts"].replace("BroadcastExchange", "") and plans["article_parts"].count("article#") > 0
    assert "article:string" not in plans["articles"] and "article:string" not in plans["article_part_register"]
    left = pipeline.insert_articles(tables, more, "first", 2, 0, config_no=1)
    assert sorted(r.article_id for r in left.collect()) == [0, 2, 3]


def test_repeated_json_keys(spark):
    from corpusloom.functions.answers import json_from_free_text

    found = spark.range(1).select(json_from_free_text(F.lit('x {"a": 1, "a": 2} y')).cast("string").alias("v")).first()
    assert found["v"] == '{"a":2}'


def _articles(spark, number):
    return spark.range(number).select(
        F.col("id").alias("article_id"), F.lit("s").alias("section_names"), F.format_string("abstract %d", "id").alias("abstract"), F.lit("first").alias("dataset")
    )


def test_slices_are_the_tasks_of_one_job(spark, tmp_path, monkeypatch):
    """However many slices there are, the stored keys are compared once and the table is appended to once."""
    other = pipeline.open_tables(spark, str(tmp_path))
    other.append("articles", _articles(spark, 200))
    append, checks, names = type(other).append, [], []
    monkeypatch.setattr(type(other), "append", lambda self, name, rows: names.append(name) or append(self, name, rows))
    monkeypatch.setattr("corpusloom.sources.tables.key_collisions", lambda old, new, key: checks.append(key) or new.limit(0))
    answers = pipeline.summarise_articles(other, summariser, 1000, models=2, slice_rows=10)
    assert names == ["short_article_summary"] and len(checks) == 1
    assert answers.count() == other.read("short_article_summary").count() == 200


def test_ended_tasks_are_kept(spark, tmp_path):
    """One article stops its task for good; the other slices are stored, and the next call asks for the rest."""
    stopped = pipeline.open_tables(spark, str(tmp_path))
    stopped.append("articles", _articles(spark, 200))

    def factory(_):
        import os
        import time

        def predict(texts):
            if any("abstract 77\n" in text for text in texts):
                time.sleep(3)
                os._exit(1)
            return ["answer"] * len(texts)

        return predict

    with pytest.raises(Exception):
        pipeline.summarise_articles(stopped, factory, 1000, models=2, slice_rows=10)
    kept = stopped.read("short_article_summary").count()
    assert 0 < kept < 200
    assert pipeline.summarise_articles(stopped, summariser, 1000, models=2, slice_rows=10).count() == 200 - kept
    assert stopped.read("short_article_summary").count() == 200
