import pytest

from corpusloom.operators import pending


@pytest.fixture(scope="module")
def stored(spark):
    register = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], "part_id long, article_id long")
    parts = spark.createDataFrame([(n, f"text {n}") for n in range(1, 5)], "part_id long, part_text string")
    summaries = spark.createDataFrame(
        [(10, 100, "s", 0), (10, 101, "t", 1), (20, 200, "u", 0)],
        "article_id long, summary_id long, article_summary string, summary_variant int",
    )
    topics = spark.createDataFrame(
        [(1, 0, 1000, 100, "x")],
        "part_id long, topics_variant int, topics_id long, article_summary_id long, part_topics string",
    )
    return register, parts, summaries, topics


def pairs(df):
    return sorted((r["summary_id"], r["part_id"]) for r in df.collect())


def test_granularity(stored):
    assert pairs(pending.pending_parts(*stored, 10)) == [(101, 2), (200, 3)]
    assert pairs(pending.pending_parts(*stored, 10, "part")) == [(100, 2), (101, 2), (200, 3)]
    assert pairs(pending.pending_parts(*stored, 2, "part")) == [(100, 2), (101, 2)]
    assert pairs(pending.pending_parts(*stored, 10, "part", one_summary=True)) == [(100, 2), (200, 3)]
    assert pairs(pending.pending_parts(*stored, 0, "part")) == []
    with pytest.raises(ValueError):
        pending.pending_parts(*stored, 1, "page")


def test_filters(stored):
    assert pairs(pending.pending_parts(*stored, 10, "part", topics_variant=1)) == [(100, 1), (100, 2), (101, 1), (101, 2), (200, 3)]
    assert pairs(pending.pending_parts(*stored, 10, "part", topics_variant=0, summary_variant=1)) == [(101, 2)]
    assert pairs(pending.pending_parts(*stored, 10, "part", config_no=1)) == []


@pytest.mark.parametrize("target, left", [(5, 4), (1, 0), (0, 0)])
def test_budget(stored, target, left):
    row = pending.remaining_budget(stored[3], 0, target).first()
    assert (row["already_processed"], row["still_to_process"]) == (1, left)


def test_part_summaries_are_done_only_with_both(spark, stored):
    topics = spark.createDataFrame(
        [(1, 0, 100), (2, 0, 100), (3, 0, 999), (4, 1, 100)],
        "part_id long, topics_variant int, article_summary_id long",
    )
    done = spark.createDataFrame([(1, 0, 100), (3, 0, 100), (2, 1, 100)], "part_id long, summary_variant int, article_summary_id long")
    rows = pending.pending_part_summaries(topics, done, 0, 0)
    assert sorted(r["part_id"] for r in rows.collect()) == [2, 3]


def test_coverage_of_nothing(spark, stored):
    empty = stored[1].where("false")
    assert pending.coverage(empty, empty).first()["ratio"] is None
