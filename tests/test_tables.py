import random

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import ordinals, quality
from corpusloom.sources import tables as stored
from corpusloom.sources.csvfiles import read_csv, write_csv


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def tables(spark, tmp_path):
    result = stored.Tables(spark, str(tmp_path))
    result.create()
    return result


def summaries(spark, *values):
    return spark.createDataFrame(
        list(values), "article_id long, article_summary string, summary_variant int, summary_id long"
    )


def test_create_twice_keeps_rows(spark, tables):
    tables.append("short_article_summary", summaries(spark, (1, "a", 0, 16)))
    tables.create()
    assert rows(tables.read("short_article_summary")) == [(1, "a", 0, 16)]


def test_strict_append(spark, tables):
    tables.append_strict("short_article_summary", summaries(spark, (1, "a", 0, 16), (1, "b", 1, 17)))
    for clash in [(1, "c", 0, 16)], [(2, "c", 0, 32), (2, "d", 0, 33)]:
        with pytest.raises(stored.KeyCollision):
            tables.append_strict("short_article_summary", summaries(spark, *clash))
    assert tables.read("short_article_summary").count() == 2


def test_variant_overwrite_and_upsert(spark, tables):
    tables.append("short_article_summary", summaries(spark, (1, "a", 0, 16), (2, "b", 0, 32), (1, "c", 1, 17)))
    tables.overwrite_variant("short_article_summary", summaries(spark, (2, "new", 0, 32)))
    assert rows(tables.read("short_article_summary")) == [(1, "c", 1, 17), (2, "new", 0, 32)]
    tables.upsert("short_article_summary", summaries(spark, (1, "d", 1, 17), (3, "e", 1, 49)))
    assert rows(tables.read("short_article_summary")) == [(1, "d", 1, 17), (2, "new", 0, 32), (3, "e", 1, 49)]


def test_insert_ignore(spark):
    known = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "k int, v string")
    assert rows(stored.insert_ignore(known, new, ["k"])) == [(2, "c")]


def test_csv_round_trip(spark, tmp_path):
    values = [(1, 'a "quoted", text'), (2, "line\nbreak\n"), (3, "back\\slash\\"), (4, ""), (5, " é,;\t "), (6, "a\r\nb")]
    df = spark.createDataFrame(values, "id int, t string")
    write_csv(df, str(tmp_path / "csv"))
    expected = [(i, None if t == "" else t) for i, t in values]
    assert rows(read_csv(spark, str(tmp_path / "csv"), df.schema)) == expected


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (9, "c")], "k int, v string")
    assert rows(quality.check_not_null(df, "t")) == [("t", "k", 0), ("t", "v", 1)]
    assert rows(quality.check_unique(df, ("k",))) == [(1, 2)]
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(quality.check_foreign_key(df, "k", parent, "id")) == [(9, 1)]
    assert rows(quality.key_collisions(df, "k", ("v",))) == [(1, 2)]


@pytest.mark.parametrize("span", [50, 100_000, 2**40])
def test_prefix_sum_one_key(spark, span):
    keys = random.Random(span).sample(range(span), 50)
    data = [(key, key % 7) for key in keys]
    df = spark.createDataFrame(data, "k long, v long").repartition(5)
    got = rows(ordinals.exclusive_prefix_sums(df, ["k"], {"s": F.col("v"), "n": F.lit(1)}))
    total, expected = 0, []
    for n, (key, amount) in enumerate(sorted(data)):
        expected.append((key, amount, total, n))
        total += amount
    assert got == expected


def test_ranking_two_keys_with_a_hot_key(spark):
    random.seed(3)
    pairs = [(7, n) for n in range(300)] + [(random.randrange(40), 1000 + n) for n in range(300)]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(4)
    ranked = rows(ordinals.ordinal_id(df, ["a", "b"], "r", start=5))
    assert ranked == [(a, b, n + 5) for n, (a, b) in enumerate(sorted(pairs))]
    assert rows(ordinals.first_n(df, ["a", "b"], 250)) == sorted(pairs)[:250]
    assert rows(ordinals.first_n(df, ["a", "b"], 10)) == sorted(pairs)[:10]
    assert rows(ordinals.row_at(df.select(F.col("b")).distinct(), "b", 20)) == [(20,)]


def test_first_rows_of_text_keys_for_any_number(spark):
    df = spark.range(30_000).select(F.format_string("k%05d", "id").alias("k")).repartition(7)
    for n in (0, 20_000, 20_001, 40_000):
        assert sorted(r.k for r in ordinals.first_n(df, ["k"], n).collect()) == [f"k{i:05d}" for i in range(min(n, 30_000))]
    assert rows(ordinals.row_at(df, "k", 25_000)) == [("k25000",)]


def test_positions_of_sparse_text_keys_with_nulls(spark):
    pairs = [(None, None), (None, "b"), ("", None), *[(f"k{n * 7919 % 1000:03d}", random.Random(n).choice("xyz")) for n in range(1000)]]
    df = spark.createDataFrame([(*pair, n) for n, pair in enumerate(dict.fromkeys(pairs))], "a string, b string, v long").repartition(5)
    ordered = sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or ""))
    placed = sorted(map(tuple, ordinals.ordinal_id(df, ["a", "b"], "at").collect()), key=lambda r: r[3])
    assert placed == [(*row, n) for n, row in enumerate(ordered)]
    sums = sorted(map(tuple, ordinals.exclusive_prefix_sums(df, ["a", "b"], {"s": F.col("v")}).collect()), key=lambda r: (r[3], r[2]))
    assert [r[3] for r in sums] == sorted(sum(r[2] for r in ordered[:n]) for n in range(len(ordered)))
    for n in (1, 2, 3, 4, 500, len(ordered)):
        assert sorted(map(tuple, ordinals.first_n(df, ["a", "b"], n).collect()), key=repr) == sorted(ordered[:n], key=repr)
        assert [tuple(r) for r in ordinals.row_at(df.select("b").distinct(), "b", n).collect()] == [(x,) for x in [None, "b", "x", "y", "z"][n : n + 1]]
    for empty in (ordinals.ordinal_id(df.limit(0), ["a"], "at"), ordinals.first_n(df.limit(0), ["a"], 5), ordinals.exclusive_prefix_sum(df.limit(0), ["a"], F.col("v"), "s")):
        assert empty.collect() == []


def test_limit_inside_a_key_of_many_rows(spark):
    """A key with most of the rows is one entry of the cut; of its rows any are taken, just as many as are asked for."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 8, 5).otherwise(F.col("id") % 10).alias("k"), "id").repartition(6)
    got = rows(ordinals.first_n(df, ["k"], 10_000))
    assert len(got) == len(set(got)) == 10_000 and {r[0] for r in got} == {5}
    got = rows(ordinals.first_n(df, ["k"], 17_000))
    assert [sum(r[0] == k for r in got) for k in (5, 8, 9)] == [16_000, 1_000, 0]


def test_no_task_takes_the_whole_of_a_limit(spark):
    """A limit beyond the range of one task is a filter: no sort or exchange holds the rows themselves."""
    df = spark.range(50_000).withColumn("text", F.lit("x")).repartition(6)
    plan = ordinals.first_n(df, ["id"], 40_000)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan and "SinglePartition" not in plan
    plan = ordinals.ordinal_id(df, ["id"], "at")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_exported_files_follow_the_order(spark, tmp_path):
    from corpusloom.sources.csvfiles import read_csv_in_order, write_csv

    df = spark.range(40_000).select(F.col("id").alias("part_id"), F.concat(F.lit("a\nb, "), F.col("id")).alias("text")).repartition(7)
    write_csv(df.orderBy("part_id"), str(tmp_path / "csv"), rows_per_file=3_000)
    found = read_csv_in_order(spark, str(tmp_path / "csv"), df.schema, "position")
    assert found.where("part_id = position").count() == found.count() == 40_000


def test_references_are_one_shuffle_and_one_scan_per_table(spark, tmp_path):
    from corpusloom.plans import pipeline

    tables = pipeline.open_tables(spark, str(tmp_path))
    content = {name: tables.read(name) for name in schemas.TABLES}
    plan = quality.check_references(content)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(content)
    plan = quality.check_keys(content)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(content)


def test_upsert_writes_only_files_with_its_keys(spark, tmp_path, monkeypatch):
    """Other files stay untouched; a call that stops at any place leaves the old rows or the new ones."""
    from corpusloom.plans import pipeline

    for table, names in {"articles": ("article_id", "abstract"), "short_article_summary": ("article_id", "article_summary")}.items():
        root = tmp_path / table
        tables = pipeline.open_tables(spark, str(root))
        schema = schemas.TABLES[table]

        def some(ids, text, schema=schema):
            values = {"dataset": "d x", "section_names": "", "summary_variant": 0}
            rows = [tuple(i if f.name in ("article_id", "summary_id") else values.get(f.name, text) for f in schema) for i in ids]
            return spark.createDataFrame(rows, schema)

        def state(tables=tables, table=table, names=names):
            return dict(map(tuple, tables.select(table, *names).collect()))

        for part in range(4):
            tables.append(table, some(range(part * 10, part * 10 + 10), "old").coalesce(1))
        before = {path: path.stat().st_mtime_ns for path in (root / table).rglob("*.parquet")}
        tables.upsert(table, some([13, 99], "new"))
        want = {i: "old" for i in range(40)} | {13: "new", 99: "new"}
        assert state() == want
        after = {path: path.stat().st_mtime_ns for path in (root / table).rglob("*.parquet")}
        stays = [path for path in before if after.get(path) == before[path]]
        assert len([path for path in before if path not in after]) == 1 and len(stays) == len(before) - 1
        delete = type(tables)._delete
        for stop_at in range(3):
            calls = []

            def failing(self, folder, calls=calls, stop_at=stop_at):
                calls.append(folder)
                if len(calls) > stop_at:
                    raise OSError("stopped")
                delete(self, folder)

            monkeypatch.setattr(type(tables), "_delete", failing)
            try:
                tables.upsert(table, some([5, 25], f"new {stop_at}"))
            except OSError:
                pass
            monkeypatch.undo()
            want |= {5: f"new {stop_at}", 25: f"new {stop_at}"}
            assert state() == want and tables.read(table).count() == len(want)


def test_csv_files_are_packed(spark, tmp_path):
    """Records whose texts repeat take a fraction of their characters on the disk, and read back as they were."""
    text = 'a "quoted", long\ntext of a prompt ' * 20
    df = spark.range(2_000).select(F.col("id"), F.concat(F.lit(text), F.col("id")).alias("prompt"))
    write_csv(df, str(tmp_path / "csv"))
    stored = sum(file.stat().st_size for file in (tmp_path / "csv").iterdir())
    assert stored < 2_000 * len(text) / 10
    found = read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.collect()))
