"""Quality operators on held-out labels and against plain Python; every pipeline stage against brute force."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import quality_classifier, quality_rules, tables
from llm import samples, test_best_fit_packing, test_decontamination, test_simhash_neardup, test_substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_statistics_and_base_rules(spark):
    docs, rows = samples.documents(spark, 9, 120, 150)
    rows = rows + [(None, "\xe9\U0001f600# a|b\na\n a\na\n", None, None, None)]
    docs = spark.createDataFrame(rows, samples.SCHEMA).withColumn("unit", F.lit(1)).withColumn("n_words", F.lit("x"))
    got = quality_rules.apply_quality_rules(docs, min_rows=20).collect()
    assert sorted(repr(tuple(r)[:6]) for r in got) == sorted(repr((r[0], *statistics(r[1]))) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
        assert r.kept or r.base_failed or r.distance > quality_rules.CUTOFF
    assert all((r.distance is None) == r.base_failed for r in got) and any(r.distance is not None for r in got)
    assert quality_rules.apply_quality_rules(samples.empty(spark)).collect() == []


def test_estimate_resists_outliers(spark):
    """A quarter of far outliers moves the estimate of the others by little; a plain mean is far off."""
    rng = np.random.default_rng(2)
    clean = rng.multivariate_normal([1500, 300, 200, 400], np.diag([150, 100, 200, 120]) ** 2, 4000)
    bad = rng.normal(6000, 100, (1200, 4))
    rows = [("u", *map(int, x)) for x in np.concatenate([clean, bad]).round()]
    (row,) = quality_rules.estimate(spark.createDataFrame(rows, "unit string, f0 long, f1 long, f2 long, f3 long")).collect()
    assert np.abs(np.array(row["mean"]) - clean.mean(axis=0)).max() < 40
    kept = np.einsum("ni,ij,nj->n", bad - row["mean"], np.array(row.inverse).reshape(4, 4), bad - row["mean"])
    assert kept.min() > 10 * quality_rules.CUTOFF


def concentrated(rows, share):
    """Brute force of the estimate over one unit: both starts, concentration steps until the chosen rows stay, least determinant."""
    floor = np.diag((np.array(quality_rules.LEAST_SPREAD) * quality_rules.UNIT) ** 2)

    def median(column):
        return np.sort(column)[int(np.ceil(len(column) / 2)) - 1]

    middle = np.array([median(column) for column in rows.T], dtype=float)
    spread = np.array([median(column) for column in np.abs(rows - middle).T])
    starts = [(middle, np.linalg.inv(np.diag((spread * 1.4826) ** 2) + floor))]
    starts.append((rows.mean(axis=0), np.linalg.inv(rows.T @ rows / len(rows) - np.outer(rows.mean(axis=0), rows.mean(axis=0)) + floor)))
    found = []
    for mean, inverse in starts:
        before = None
        while True:
            distance = np.einsum("ni,ij,nj->n", rows - mean, inverse, rows - mean).round(6)
            bins = np.minimum(np.floor(np.log1p(distance) * 500), 20_000)
            chosen = bins <= np.sort(bins)[int(np.ceil(len(rows) * share)) - 1]
            if before is not None and (chosen == before).all():
                break
            before, own = chosen, rows[chosen]
            covariance = own.T @ own / len(own) - np.outer(own.mean(axis=0), own.mean(axis=0)) + floor
            mean, inverse = own.mean(axis=0), np.linalg.inv(covariance)
        found.append((round(np.linalg.slogdet(covariance)[1], 6), mean, inverse))
    return min(found, key=lambda x: x[0])[1:]


def test_verdict_of_every_unit(spark):
    """Large sources by themselves, small ones by their language, a small language by all rows: none is left out."""
    rng = np.random.default_rng(8)
    rows = []
    for lang, source, n in (("en", "big", 150), ("en", "tiny", 5), ("de", "one", 60), ("fr", "few", 4)):
        for _ in range(n):
            size = int(rng.integers(60, 90))
            words = ["w" * int(rng.integers(2, 9)) + str(k) for k in range(size)]
            if rng.random() < 0.08:
                words = [w + "#|" * 30 for w in words]
            rows.append((len(rows), " ".join(words), lang, source, 0))
    found = {r.doc_id: r for r in quality_rules.apply_quality_rules(spark.createDataFrame(rows, samples.SCHEMA), min_rows=40).collect()}
    # The features by hand; no line or window of three words repeats here.
    features = np.array([[round(1000 * np.log((found[n].word_chars + 1) / found[n].n_words)), round(1000 * np.sqrt(found[n].n_symbols / found[n].n_words)), 0, 0] for n in range(len(rows))], dtype=float)
    units = {"big": [r[3] == "big" for r in rows], "tiny": [r[2] == "en" for r in rows], "one": [r[3] == "one" for r in rows], "few": [True] * len(rows)}
    for source, part in units.items():
        mean, inverse = concentrated(features[np.array(part)], quality_rules.SHARE)
        for number, row in enumerate(rows):
            if row[3] == source:
                distance = (features[number] - mean) @ inverse @ (features[number] - mean)
                assert abs(found[number].distance - distance) < 1e-3 * max(1, distance) and found[number].kept == (distance <= quality_rules.CUTOFF)
    assert {r.kept for r in found.values()} == {True, False}


def test_good_documents_stay(spark):
    found = quality_rules.op2_quality_rules(spark, LARGE).join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").where("not base_failed")
    shares = {r.quality: r.share for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.995 and shares[0] < 0.05


def test_classifier_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/labels.parquet")
    train = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0)
    held = quality_classifier.classify(docs, train).join(labels.join(train, "doc_id", "left_anti"), "doc_id")
    good = F.expr("quality = 1 and toxic = 0")
    rates = {r.good: r.rate for r in held.groupBy(good.alias("good")).agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rates[True] > 0.97 and rates[False] < 0.2


def test_classifier_edges(spark):
    docs, rows = samples.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 0), (3, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        found = quality_classifier.classify(docs.withColumn("score", F.lit("x")), labels, keep=["score", "text"]).collect()
        assert len(found) == len(rows) and all(r.kept and r.score == 1.0 for r in found)
    both = spark.createDataFrame([(i * 3, i % 2, 0) for i in range(40)] * 2, "doc_id long, quality int, toxic int")
    found = quality_classifier.classify(docs, both).collect()
    assert len(found) == len(rows) and len({(r.doc_id, r.score) for r in found if r.doc_id == rows[5][0]}) == 1
    assert quality_classifier.classify(samples.empty(spark), both).collect() == []


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = tables.table(spark, SMALL, "documents", "*"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = tables.written(stage(spark, docs, SMALL))
    return [*out, docs]


def as_rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(stages):
    assert len({str(df.schema.simpleString()) for df in stages[:-1]}) == 1
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_classifier" and len(stages) == 6


def test_quality_stage(spark, stages):
    labels = {r.doc_id: r.quality * (1 - r.toxic) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r[0] for r in as_rows(stages[1])}
    assert np.mean([n in kept for n, good in labels.items() if good]) > 0.9


def test_near_duplicate_stage(stages):
    found = test_simhash_neardup.expected(as_rows(stages[1]))
    assert sorted(r[0] for r in as_rows(stages[2])) == sorted({r[2] for r in found})


def test_passage_stage(stages):
    want = [(a, d) for a, _, _, d in test_substring_dedup.expected(as_rows(stages[2]), corpus_pipeline.REPEAT_WORDS)]
    assert sorted((n, " ".join(WORD.findall(text))) for n, text in as_rows(stages[3])) == want
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_decontamination_stage(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = [r[0] for r in test_decontamination.expected(as_rows(stages[3]), items) if not r[2]]
    assert sorted(r[0] for r in as_rows(stages[4])) == sorted(want)


def test_packing_stage(stages):
    test_best_fit_packing.check(stages[5], as_rows(stages[4]), 2048)


def test_stages_on_hard_rows(spark):
    docs, rows = samples.documents(spark, 3)
    docs = docs.union(spark.createDataFrame([(None, "no id at all", None, None, None)] * 2, samples.SCHEMA))
    for given in (docs, samples.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            given = tables.written(stage(spark, given, SMALL))
        assert given.columns[:2] == ["doc_id", "piece"]
