import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.functions.jsontext import json_string, pretty_answer, serialise_document
from corpusloom.functions.prompts import PROMPT_FORMATS, fit_prompt, render_template, training_prompt
from corpusloom.functions.text import (
    LOSSLESS,
    ModelTokenizer,
    PatternTokenizer,
    before_stop,
    chunk_articles,
    drop_reference_markers,
    strip_blanks,
    strip_nul,
    window_count,
)
from corpusloom.schemas import RELATION_DOCUMENT


def words(n):
    return " ".join(f"w{i}" for i in range(n))


def chunks(spark, texts, size, overlap, tokenizer=PatternTokenizer(), tail=False):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, article string")
    rows = chunk_articles(df, "article", size, overlap, tokenizer, tail).orderBy("id", "part_no").collect()
    return {i: [r["part_text"] for r in rows if r["id"] == i] for i in range(len(texts))}


@pytest.mark.parametrize("tail", [False, True])
@pytest.mark.parametrize("size, overlap", [(4, 1), (4, 0), (5, 4)])
def test_windows_against_brute_force(spark, size, overlap, tail):
    lengths = [0, 1, size - 1, size, size + 1, 2 * size - overlap, 2 * size - overlap + 1, 23]
    got = chunks(spark, [words(n) for n in lengths], size, overlap, tail=tail)
    counts = spark.createDataFrame([(n,) for n in lengths], "n long")
    counted = [r[0] for r in counts.select(window_count(F.col("n"), size, overlap, tail)).collect()]
    for i, n in enumerate(lengths):
        tokens = words(n).split()
        starts = [s for s in range(0, n, size - overlap) if not tail or s == 0 or s + overlap < n]
        assert got[i] == [" ".join(tokens[s : s + size]) for s in starts]
        assert counted[i] == len(got[i])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té", max_size=40), min_size=1, max_size=5))
def test_lossless_windows_rebuild_the_text(spark, texts):
    got = chunks(spark, texts, 3, 1, LOSSLESS, tail=True)
    for i, text in enumerate(texts):
        if not text.split():
            assert got[i] == []
            continue
        rebuilt = got[i][0]
        for window in got[i][1:]:
            first = LOSSLESS_TOKEN.match(window).group(0)
            rebuilt += window[len(first) :]
        assert rebuilt == text


import re  # noqa: E402

LOSSLESS_TOKEN = re.compile(r"[ \t\n]*[^ \t\n]+")


def _letters():
    class Letters:
        def encode(self, text):
            return [ord(letter) for letter in text]

        def decode(self, numbers):
            return "".join(map(chr, numbers))

    return Letters


def test_model_tokenizer(spark):
    tokenizer = ModelTokenizer(_letters())
    assert chunks(spark, ["abcdefg", "", "ab"], 4, 1, tokenizer) == {0: ["abcd", "defg", "g"], 1: [], 2: ["ab"]}
    assert chunks(spark, ["abcdefg"], 4, 1, tokenizer, tail=True) == {0: ["abcd", "defg"]}
    row = spark.createDataFrame([("abcdefg",)], "t string").select(tokenizer.count(F.col("t")), tokenizer.head(F.col("t"), 3))
    assert tuple(row.first()) == (7, "abc")


def test_bad_overlap(spark):
    with pytest.raises(ValueError):
        chunks(spark, ["a"], 4, 4)


def value(spark, column, **fields):
    names = ", ".join(f"{name} string" for name in fields)
    return spark.createDataFrame([tuple(fields.values())], names).select(column).first()[0]


def test_small_functions(spark):
    assert value(spark, strip_nul(F.col("t")), t="a\0b\0") == "ab"
    assert value(spark, strip_blanks(F.col("t")), t="　\n a b\xa0\t") == "a b"
    assert value(spark, before_stop(F.col("t")), t='{"a": 1}<<END>> more <<END>>') == '{"a": 1}'
    kept = drop_reference_markers(F.split("t", " "))
    assert value(spark, kept, t="@xmath1 a @xcite @xlink b@xref") == ["a", "@xcite", "b@xref"]


SPECIAL = ['plain', 'q"b\\', "a\nb\tc\rd\be\ff", "é ü ß", "\x01\x1f\x7f", "😀 and 漢", "", "[x]", "a/b"]


@pytest.mark.parametrize("text", SPECIAL)
def test_json_string(spark, text):
    assert value(spark, json_string(F.col("t")), t=text) == json.dumps(text)
    assert value(spark, json_string(F.col("t"), ascii_only=False), t=text) == json.dumps(text, ensure_ascii=False)


def test_documents_as_json(spark):
    relations = [
        {"description": "d\n1", "source_entities": ["é"], "target_entities": [], "strength": "weak"},
        {"description": "2", "source_entities": ["a", "b"], "target_entities": ["c"]},
    ]
    document = {"list_of_entities": ["é", "b"], "relations": relations, "section_description": "s"}
    row = spark.createDataFrame([(document,)], f"doc {RELATION_DOCUMENT.simpleString()}")
    line, pretty = row.select(serialise_document(F.col("doc")), pretty_answer(F.col("doc"))).first()
    assert line == json.dumps(document)
    ordered = {key: document[key] for key in ("section_description", "list_of_entities", "relations")}
    assert pretty == json.dumps(ordered, indent=2)


def test_templates_keep_braces_and_percent(spark):
    column = render_template("{{x}} {t} 100% {t}", t=F.col("t"))
    assert value(spark, column, t="{y} %s") == "{x} {y} %s 100% {y} %s"


def test_prompt_is_cut_to_budget(spark):
    df = spark.createDataFrame([(1, words(30), "s"), (2, words(3), ""), (3, words(30), "")], "id int, a string, b string")
    rows = fit_prompt(df, "go {x} | {y}", {"x": "a", "y": "b"}, PatternTokenizer(), budget=20, keep=5).orderBy("id").collect()
    assert [r["prompt"] for r in rows] == [f"go {words(5)} | s", f"go {words(3)} | ", f"go {words(5)} | "]
    assert [r["prompt_tokens"] for r in rows] == [33, 5, 32]


def test_training_formats(spark):
    columns = [training_prompt(name, F.lit("SUMMARY"), F.lit("PART"), F.lit("ANSWER")) for name in PROMPT_FORMATS]
    rendered = dict(zip(PROMPT_FORMATS, spark.range(1).select(*columns).first()))
    for name, text in rendered.items():
        assert text.endswith("PART\n### Extracted Relations:\nANSWER")
        assert ("json-schema" in text) == ("schema" in name)
        assert ("SUMMARY" in text) == ("no_summary" not in name)
        assert ("### General Text Summary:\nSUMMARY\n" in text) == name.startswith("prompt_with_summary")


def test_packed_ids(spark):
    row = spark.range(7, 8).select(ids.part_id(F.col("id"), F.lit(5), 2).alias("p"))
    part = row.first()["p"]
    assert part == ((7 * 16 + 2) << 20) + 5
    back = row.select(ids.owner_of_part(F.col("p")), ids.config_of_part(F.col("p"))).first()
    assert tuple(back) == (7, 2)
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(ids.part_id(F.col("id"), F.lit(1 << 20))).collect()
