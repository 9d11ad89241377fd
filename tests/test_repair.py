"""The repair job on literal answers with hand-traced results."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.answers import json_from_free_text, repair_stages
from corpusloom.operators.repair import repair_answers, repair_report

LONG = "this part is about things " * 10


def relation(description, source, target, *more):
    fields = [f'"description": "{description}"', f'"source_entity": "{source}"', f'"target_entity": "{target}"', *more]
    return "        {\n            " + ",\n            ".join(fields) + "\n        }"


def answer(*relations, description=LONG, entities='["a", "b"]', end="\n    ]\n}"):
    return f'{description}",\n    "list_of_entities": {entities},\n    "relations": [\n' + ",\n".join(relations) + end


X = relation("x", "a", "b")
NO_DESCRIPTION = '        {\n            "source_entity": "a",\n            "target_entity": "b"\n        }'
DESCRIPTION_LAST = (
    '        {\n            "source_entity": "a",\n            "target_entity": "b",\n            "description": "x"\n        }'
)
ARRAYS = (
    '        {\n            "description": "x",\n            "source_entities": [\n                "a",\n                "b"\n'
    '            ],\n            "target_entities": [\n                "c"\n            ]\n        }'
)

CASES = {
    "complete": (answer(X), "accepted"),
    "short description": (answer(X, description="Short."), "unfit"),
    "prose": ("There are no relations.", "unfit"),
    "description not first": (answer(DESCRIPTION_LAST), "description_not_first"),
    "no description": (answer(NO_DESCRIPTION), "no_relations"),
    "example relation": (answer(X, relation("dopamine is y", "a", "b")), "accepted"),
    "equal descriptions": (answer(X, relation("x", "c", "b")), "accepted"),
    "number among entities": (answer(X, entities='["a", 5]'), "entity_not_text"),
    "missing comma": (answer(X.replace('"x",\n', '"x"\n')), "accepted"),
    "prose after": (answer(X) + "\nThat is all.", "accepted"),
    "list not closed": (answer(X, relation("y", "c", "b"), end=""), "accepted"),
    "cut off": (answer(X, '        {\n            "description": "y', end=""), "accepted"),
    "one line": (answer('        {"description": "x", "source_entities": ["a"], "target_entities": ["b"]}'), "invalid_json"),
    "prose before": ('Here: {\n    "description": "' + answer(X), "accepted"),
    "example entity": (answer(relation("x", "caffeine", "b"), entities='["a", "caffeine"]'), "accepted"),
    "arrays": (answer(ARRAYS), "accepted"),
}


@pytest.fixture(scope="module")
def repaired(spark):
    rows = [(name, text) for name, (text, _) in CASES.items()]
    result = repair_answers(spark.createDataFrame(rows, "name string, part_topics string"))
    return {row["name"]: row for row in result.collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_outcome(repaired, name):
    row = repaired[name]
    assert (row["reject_reason"] or row["status"]) == CASES[name][1]
    assert (row["document"] is not None) == (row["status"] == "accepted")


def ends(row):
    return [(r["description"], r["source_entities"], r["target_entities"]) for r in row["document"]["relations"]]


def test_documents(repaired):
    assert ends(repaired["complete"]) == [("x", ["a"], ["b"])]
    assert repaired["complete"]["document"]["section_description"] == LONG
    assert ends(repaired["example relation"]) == [("x", ["a"], ["b"])]
    assert ends(repaired["equal descriptions"]) == [("x", ["a", "c"], ["b"])]
    assert repaired["equal descriptions"]["document"]["list_of_entities"] == ["a", "b", "c"]
    assert len(ends(repaired["list not closed"])) == 2
    assert ends(repaired["cut off"]) == [("x", ["a"], ["b"])]
    assert repaired["example entity"]["document"]["list_of_entities"] == ["a", "b"]
    assert ends(repaired["example entity"]) == [("x", ["caffeine"], ["b"])]
    assert ends(repaired["arrays"]) == [("x", ["a", "b"], ["c"])]


def test_report(spark):
    rows = spark.createDataFrame([(text,) for text, _ in CASES.values()], "part_topics string")
    report = repair_report(repair_answers(rows)).first()
    assert (report["tested"], report["unfit"], report["correct"]) == (16, 2, 10)
    assert report["achievable"] == pytest.approx(10 / 14) and report["all"] == pytest.approx(10 / 16)


def test_report_of_nothing(spark):
    report = repair_report(repair_answers(spark.createDataFrame([], "part_topics string"))).first()
    assert report["tested"] == 0 and report["all"] is None


def one(spark, text, **options):
    return repair_answers(spark.createDataFrame([(text,)], "part_topics string"), **options).first()


def test_options(spark):
    assert one(spark, answer(DESCRIPTION_LAST), strict_key_order=False)["status"] == "accepted"
    misspelt = answer(relation("x", "a", "b", '"strenght": "weak"'))
    assert one(spark, misspelt)["document"]["relations"][0]["strength"] is None
    aliased = one(spark, misspelt, key_aliases={"strenght": "strength"})
    assert aliased["document"]["relations"][0]["strength"] == "weak"


def test_types(spark):
    number = answer(relation("x", "a", "b").replace('"source_entity": "a"', '"source_entities": [1]'))
    assert one(spark, number)["reject_reason"] in ("non_string_endpoint", "invalid_json")
    ignored = answer(relation("x", "a", "b", '"source_count": 3'))
    assert one(spark, ignored)["document"]["relations"][0]["source_entities"] == ["a"]
    bracketed = answer(relation("x", "[a", "b"))
    assert one(spark, bracketed)["document"]["relations"][0]["source_entities"] == ["[a"]


def test_lost_description_is_recovered(spark):
    text = 'junk {\n"description": "' + LONG + '",\n{\n"list_of_entities": ["a"],\n"relations": [\n' + X + "\n]\n}"
    stages = repair_stages(spark.createDataFrame([(text,)], "part_topics string")).first()
    assert stages["rejoined"].startswith('{",')
    assert stages["completed"].startswith('{"description": "' + LONG[:20])


@pytest.mark.parametrize(
    "text, name",
    [
        ('Sure.\n```json\n{"name": "x"}\n```\nBye.', "x"),
        ('{"list": ["a"], "name": "x", "more": [1] \nBye', "x"),
        ('{"name": "x"', "x"),
        ("nothing here", None),
        ("} {", None),
    ],
)
def test_json_from_free_text(spark, text, name):
    rows = spark.createDataFrame([(text,)], "t string")
    found = rows.select(F.try_variant_get(json_from_free_text(F.col("t")), "$.name", "string").alias("n")).first()
    assert found["n"] == name


def test_many_relations_in_one_answer(spark):
    """20,000 relations in one document: merged in order of first appearance, in time that grows with their number."""
    from corpusloom.functions.documents import merge_relations

    rng = random.Random(4)
    own = [(f"d{rng.randrange(12_000)}", [f"s{i % 7}"], [f"t{i}"], rng.choice([None, "a", "b"])) for i in range(20_000)]
    kind = "array<struct<description:string,sources:array<string>,targets:array<string>,strength:string>>"
    df = spark.createDataFrame([(1, own), (2, []), (3, None)], f"id long, own {kind}")
    found = {r["id"]: r["merged"] for r in df.select("id", merge_relations(F.col("own")).alias("merged")).collect()}
    expected = {}
    for description, sources, targets, strength in own:
        entry = expected.setdefault(description, ([], [], []))
        for have, more in zip(entry, (sources, targets, [strength] if strength else []), strict=True):
            have += [x for x in more if x not in have]
    got = [(r["description"], r["source_entities"], r["target_entities"], r["strength"]) for r in found[1]]
    assert got == [(name, s, t, min(k, default=None)) for name, (s, t, k) in expected.items()]
    assert found[2] == [] and not found[3]


def test_every_character_is_escaped_as_python_does(spark):
    """Listed, rare and paired ones, alone and inside a text, and a text of one plain character."""
    from corpusloom.functions.jsontext import json_string

    codes = [*range(0, 0x1000), 0x7FF, 0x800, 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]
    texts = [chr(code) for code in codes] + ["".join(map(chr, codes)), "", "plain text", 'a"b\\c\n\x00\x1fé中']
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    for ascii_only in (True, False):
        for text, found in df.select("text", json_string(F.col("text"), ascii_only)).collect():
            assert found == json.dumps(text, ensure_ascii=ascii_only)


def test_breaks_stay_only_behind_a_quote_and_a_comma(spark):
    from corpusloom.functions.answers import rejoin_lines

    texts = ["a\nb", '"a",\n"b"', '"a",', '"a",\n', '"a",\n\n', "\n", "", ",\n", '"\n",\n\nx",']
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    for text, found in df.select("text", rejoin_lines(F.col("text"))).collect():
        assert found == re.sub(r'",\Z', '",\n', re.sub(r'(?<!",)\n', "", text))
