"""Exports in slices: whole, in order, and without the shuffle files of what is written already."""

import time

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import export
from corpusloom.plans import queries as registered
from corpusloom.sources import csvfiles
from test_plans import FOLDER, export_tables


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return sum(f.length() for f in found if f.getName().startswith("shuffle_"))


def left_over(spark, before, most):
    """Spark removes files beside the work, so a few seconds are given."""
    for _ in range(40):
        if shuffle_bytes(spark) - before <= most:
            break
        time.sleep(0.25)
    return shuffle_bytes(spark) - before


@pytest.mark.parametrize("name", ["export_prompts_csv", "export_wide_csv"])
def test_a_written_export_leaves_no_shuffled_texts(spark, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark._jvm.System.gc()
    time.sleep(1)
    before = shuffle_bytes(spark)
    try:
        rows = registered.queries()[name](spark, FOLDER)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Keys are counted by shuffles of a few bytes a row.
    assert left_over(spark, before, 40_000) <= 40_000
    assert rows.count() > 1_000


@pytest.mark.parametrize("summary_key", ["summary_id", "article_id"])
@pytest.mark.parametrize("slices", [1, 3, 16])
def test_slices_are_all_records_once(spark, slices, summary_key):
    tables = export_tables(spark)
    found = export.record_slices(*tables, summary_key=summary_key, slice_rows=1, slices=slices)
    assert len(found) == 1 if slices == 1 else len(found) > 1
    rows = [[tuple(row) for row in records.collect()] for records in found]
    wanted = [tuple(row) for row in export.export_records(*tables, summary_key=summary_key).collect()]
    assert sorted(map(repr, sum(rows, []))) == sorted(map(repr, wanted))
    keys = [[row[0] for row in some] for some in rows if some]
    assert all(max(a) < min(b) for a, b in zip(keys, keys[1:]))


def test_slices_of_chosen_variants_and_of_nothing(spark):
    topics, relations, parts, summaries, articles = export_tables(spark)
    topics = topics.withColumn("topics_variant", F.col("part_id").cast("int") % 2)
    relations = relations.withColumn("relations_variant", F.col("article_id").cast("int") % 2)
    tables = topics, relations, parts, summaries, articles
    chosen = {"topics_variant": 0, "relations_variant": 1}
    found = [tuple(row) for records in export.record_slices(*tables, **chosen, slice_rows=1) for row in records.collect()]
    wanted = [tuple(row) for row in export.export_records(*tables, **chosen).collect()]
    assert wanted and sorted(map(repr, found)) == sorted(map(repr, wanted))
    (nothing,) = export.record_slices(topics.limit(0), *tables[1:])
    assert nothing.count() == 0 and nothing.columns == export.export_records(*tables).columns


def test_a_slice_reads_the_texts_of_its_parts(spark, tmp_path):
    """A stored table in the order of its parts is read where the range is."""
    rows = spark.range(4_000)
    tables = {
        "topics": rows.selectExpr("id AS part_id", "id AS article_summary_id"),
        "relations": rows.selectExpr("id AS part_id", "id AS article_id", "uuid() AS raw_relation_text"),
        "parts": rows.selectExpr("id AS part_id", "uuid() AS part_text"),
        "summaries": rows.selectExpr("id AS summary_id", "id AS article_id", "'s' AS article_summary"),
        "articles": rows.selectExpr("id AS article_id", "'d' AS dataset", "'a' AS abstract", "'n' AS section_names"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    stored = [spark.read.parquet(str(tmp_path / name)) for name in tables]
    found = export.record_slices(*stored, slice_rows=1_000)
    counts = [records.count() for records in found]
    assert len(counts) == 4 and sum(counts) == 4_000 and max(counts) < 1_010
    plan = found[1]._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) >= 5 and all("GreaterThanOrEqual" in line and "LessThan" in line for line in scans)


def test_slices_make_one_folder_in_order(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.range(9_000).select(F.col("id").alias("part_id"), F.concat(F.lit("a\nb, "), F.col("id")).alias("text")).repartition(7)
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    csvfiles.write_csv(df, path)
    slices = [df.where(F.col("part_id").between(low, low + 2_999)).orderBy("part_id") for low in (0, 3_000, 6_000)]
    csvfiles.write_csv_slices(slices, path, rows_per_file=500)
    found = csvfiles.read_csv_in_order(spark, path, df.schema, "position")
    assert found.where("part_id = position").count() == found.count() == 9_000
    assert (tmp_path / "csv" / "_SUCCESS").exists()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before


def test_an_unfinished_folder_has_no_success_mark(spark, tmp_path):
    good = spark.range(9).selectExpr("id AS part_id")
    bad = spark.range(9).select(F.raise_error(F.lit("stopped")).cast("long").alias("part_id"))
    with pytest.raises(Exception, match="stopped"):
        csvfiles.write_csv_slices([good, bad], str(tmp_path / "csv"))
    assert not (tmp_path / "csv" / "_SUCCESS").exists()


def test_stored_windows_are_in_ranges(spark):
    """Files of stored windows have ranges of parts that do not overlap."""
    from corpusloom.plans.sample_tables import SampleTables

    windows = SampleTables(spark, FOLDER).windows
    ends = windows.groupBy(F.input_file_name().alias("file")).agg(F.min("part_id").alias("low"), F.max("part_id").alias("high")).orderBy("low").collect()
    assert len(ends) > 1 and all(a["high"] < b["low"] for a, b in zip(ends, ends[1:]))
