"""License scans against Python's regexes over the same words."""

import re

from corpusloom.llm import license_scan
from llm import samples

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "Released under the MIT License.", "under the  mit\nlicense. Under THE MIT license, again", "Apache-License, Version 2.0; cc-by-nc 4.0",
    "licensed under the GNU General Public License version 3 or later", "SPDX-License-Identifier: Apache-2.0", "the mitlicense under", "accción cc by éa nc",
    "under the terms of the Mozilla Public License v2.0 and cc by sa 4.0 all rights reserved", "cc by nc cc by nc cc by nc", "underthe mit license", "license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy " * 3, "x " * 3000 + "cc by nc " * 40, "unlicense; the Unlicense", "éunder the mit license",
]


def expected(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    line = " " + " ".join(words) + " "

    def places(regex):
        for m in re.finditer(f"(?<= )(?:{regex})(?= )", line):
            start = line[: m.start()].count(" ") - 1
            yield start, start + m[0].count(" ") + 1

    base = [(start, label) for phrase, label in license_scan.BASE.items() for start, _ in places(phrase)]
    rules = license_scan.rules()
    hits = [(r.priority, a - b, i, a, b, r.label, r.score) for i, r in enumerate(rules) if r.keyword in line for a, b in places(r.regex)]
    kept = [h for h in hits if not any(o[3] <= h[3] and o[4] >= h[4] and o[:3] < h[:3] for o in hits)]
    starts = [s for s, _ in base]
    labels = {n for _, n in base}
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
        ",".join(sorted(labels | {h[5] for h in kept})), 1.0 if base else max((h[6] for h in kept), default=0.0),
    )


def test_scan(spark):
    _, rows = samples.documents(spark, 8, 60, 60)
    rows = rows + [(2000 + i, text, None, "s", 1) for i, text in enumerate(TEXTS)] + [(None, TEXTS[0], None, None, None)] * 2
    docs = spark.createDataFrame(rows, samples.SCHEMA).withColumnRenamed("lang", "line").withColumnRenamed("source", "labels")
    got = license_scan.scan_licenses(docs, keep=("line", "labels")).drop("line", "detections").collect()
    want = sorted(repr((r[0], *expected(r[1]))) for r in rows)
    assert sorted(repr(tuple(r)) for r in got) == want
    assert 150 < len(license_scan.rules())


def test_suppression(spark):
    text = "SPDX-License-Identifier: Apache-2.0. This is licensed under the Mozilla Public License."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = license_scan.scan_licenses(docs).collect()
    assert row.labels == "apache-2,mpl" and len(row.detections) == 2 and row.score == 1.0


def test_empty(spark):
    assert license_scan.scan_licenses(samples.empty(spark)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = sorted(tuple(r) for r in license_scan.op3_license_scan(spark, folder).collect())
    assert got == sorted((r.doc_id, *expected(r.text)) for r in rows) and any(r[2] for r in got)


def examples(regex):
    """Texts of a rule's words: optional groups left out and put in, the first of each choice taken."""
    regex = regex.replace("[cs]", "s").replace("\\d", "4")
    choice = re.compile(r"\(\?:([^()]*)\)(\??)")
    for taken in (True, False):
        text = regex
        while found := choice.search(text):
            inside = found[1].split("|")[0] if taken or not found[2] else ""
            text = text[: found.start()] + inside + text[found.end() :]
        yield text.strip()


def test_gate_passes_every_rule_in_any_form(spark):
    """Words that are wrapped, set apart by signs or by underscores are the same words."""
    forms = [" ", "\n", "  ", "-", "_", ", "]
    rows = []
    for rule in license_scan.rules():
        for text in examples(rule.regex):
            assert re.fullmatch(rule.regex, text)
            rows += [f"x. {edge}{sep.join(text.split())}{edge} y" for sep in forms for edge in ("", "_")]
    rows = [(i, text) for i, text in enumerate(rows + ["MPL-2.0", "All rights\nreserved", "_hereby_"])]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.labels, r.score) for r in got} == {i: expected(text)[5:] for i, text in rows}
    assert {r.labels for r in got if r.doc_id == rows[-3][0]} == {"mpl-2"}
