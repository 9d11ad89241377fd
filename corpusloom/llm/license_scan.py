"""License scans by ordered signature rules, in DataFrame operations only and without a shuffle.

A text is read twice at most: a keyword prefilter decides whether any rule can match; only then its words are
lower-cased, joined by single spaces and matched. Every rule is a regex over that line and names one keyword that must
be there, so a text meets only the rules of its keywords. Rules have a priority (identifiers, full grants, names with
a version, bare names). A detection inside the interval of one of better priority, or of a longer one of the same, is
suppressed. The base phrases are counted at all their places, whatever suppresses them, and their labels stay.

Defined cases: a null or blank text has no words, no labels and score 0. Places count words from 0.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import tables
from corpusloom.operators.rows import settle

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Name as words, label, versions of the family. Rules are made of these, so that one more license is one more line.
FAMILIES = [
    ("mit", "mit", ()), ("mit no attribution", "mit-0", ()), ("apache", "apache", ("1", "1 1", "2")), ("gnu general public", "gpl", ("1", "2", "3")),
    ("gnu lesser general public", "lgpl", ("2", "2 1", "3")), ("gnu library general public", "lgpl", ("2",)), ("gnu affero general public", "agpl", ("3",)),
    ("gnu free documentation", "gfdl", ("1 1", "1 2", "1 3")), ("mozilla public", "mpl", ("1", "1 1", "2")), ("eclipse public", "epl", ("1", "2")),
    ("eclipse distribution", "edl", ("1",)), ("common development and distribution", "cddl", ("1", "1 1")), ("common public", "cpl", ("1",)),
    ("european union public", "eupl", ("1 1", "1 2")), ("bsd", "bsd", ()), ("2 clause bsd", "bsd-2-clause", ()), ("3 clause bsd", "bsd-3-clause", ()),
    ("4 clause bsd", "bsd-4-clause", ()), ("simplified bsd", "bsd-2-clause", ()), ("new bsd", "bsd-3-clause", ()), ("modified bsd", "bsd-3-clause", ()),
    ("isc", "isc", ()), ("zlib", "zlib", ()), ("boost software", "bsl", ("1",)), ("artistic", "artistic", ("1", "2")), ("academic free", "afl", ("2 1", "3")),
    ("open software", "osl", ("2 1", "3")), ("python software foundation", "psf", ("2",)), ("microsoft public", "ms-pl", ()), ("microsoft reciprocal", "ms-rl", ()),
    ("postgresql", "postgresql", ()), ("openssl", "openssl", ()), ("php", "php", ("3", "3 1")), ("ruby", "ruby", ()), ("perl", "perl", ()),
    ("sil open font", "ofl", ("1", "1 1")), ("creative commons attribution", "cc-by", ("2", "3", "4")), ("creative commons zero", "cc0", ("1",)),
    ("open database", "odbl", ("1",)), ("universal permissive", "upl", ("1",)), ("university of illinois ncsa open source", "ncsa", ()),
    ("unlicense", "unlicense", ()), ("do what the fuck you want to public", "wtfpl", ("2",)), ("server side public", "sspl", ("1",)), ("elastic", "elastic", ("2",)),
]
#: Ways to name a license, with priority and score; {n} is the name, {v} the version.
GRANTS = [
    ("(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{n} licen[cs]e", 2, 0.95),
    ("(?:under|subject to) (?:the )?(?:terms of )?(?:the )?{n} licen[cs]e", 2, 0.9),
    ("{n} licen[cs]e", 4, 0.6),
]
VERSIONED = [("{n} licen[cs]e (?:version |v)?{v}(?: 0)?(?: or (?:any )?later)?", 3, 0.8)]
#: Short forms as words, label; after an SPDX tag, or by themselves where they cannot be other words.
IDENTIFIERS = [
    ("mit", "mit"), ("mit 0", "mit-0"), ("apache 2 0", "apache-2"), ("apache 1 1", "apache-1-1"), ("gpl 2 0", "gpl-2"), ("gpl 3 0", "gpl-3"), ("lgpl 2 1", "lgpl-2-1"),
    ("lgpl 3 0", "lgpl-3"), ("agpl 3 0", "agpl-3"), ("mpl 2 0", "mpl-2"), ("epl 1 0", "epl-1"), ("epl 2 0", "epl-2"), ("cddl 1 0", "cddl-1"), ("bsd 2 clause", "bsd-2-clause"),
    ("bsd 3 clause", "bsd-3-clause"), ("isc", "isc"), ("zlib", "zlib"), ("bsl 1 0", "bsl-1"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("cc0 1 0", "cc0-1"), ("eupl 1 2", "eupl-1-2"),
]
COMMONS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]


class Rule(NamedTuple):
    regex: str
    label: str
    keyword: str
    priority: int
    score: float


def rules() -> list[Rule]:
    """All rules, best first."""
    out = []
    for form, label in IDENTIFIERS:
        out.append(Rule(f"spdx licen[cs]e identifier {form}(?: only| or later)?", label, "spdx", 1, 1.0))
        if " " in form and form != "mit 0":
            out.append(Rule(form, label, form.split()[0], 3, 0.7))
    for parts in COMMONS:
        label = "cc-" + parts.replace(" ", "-")
        out.append(Rule(f"spdx licen[cs]e identifier cc {parts} \\d \\d", label, "spdx", 1, 1.0))
        out.append(Rule(f"cc {parts} \\d(?: \\d)?", label, "cc", 3, 0.85))
        out.append(Rule(f"cc {parts}", label, "cc", 4, 0.7))
    for name, label, versions in FAMILIES:
        word = "unlicense" if name == "unlicense" else "licen"
        for template, priority, score in GRANTS:
            out.append(Rule(template.format(n=name), label, word, priority, score))
        for version in versions:
            for template, priority, score in VERSIONED:
                out.append(Rule(template.format(n=name, v=version), f"{label}-{version.replace(' ', '-')}", word, priority, score))
    out.append(Rule("the unlicense", "unlicense", "unlicense", 3, 0.8))
    out.append(Rule("permission is hereby granted free of charge to any person obtaining a copy", "mit", "hereby", 2, 0.9))
    out.append(Rule("redistribution and use in source and binary forms", "bsd", "redistribution", 2, 0.9))
    out.append(Rule("all rights reserved", "proprietary", "rights", 5, 0.3))
    return sorted(out, key=lambda r: r.priority)


#: What a text must hold for any rule or base phrase: parts of single words, or whole words where they also occur inside others.
#: Never two words, which a text may part by any separators, and never \b, for which "_" is a letter.
_GATE = r"(?i)licen[cs]|spdx|unlicense|redistribution|(?<![0-9A-Za-z\x{80}-\x{10FFFF}])(?:hereby|reserved|cc0?|apache|[al]?gpl|mpl|epl|cddl|bsd|bsl|eupl)(?![0-9A-Za-z\x{80}-\x{10FFFF}])"


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _places(line: Column, regex: Column) -> Column:
    """``(start, stop)`` in words of every match in a line of words, each after a space."""
    whole = F.concat(F.lit("(?<= )(?:"), regex, F.lit(")(?= )"))
    found = F.call_function("regexp_extract_all", line, whole, F.lit(0))
    span = "struct<start:bigint,stop:bigint>"

    def add(state, pair):
        start = state["at"] + _spaces(pair["before"]) - 1
        stop = start + _spaces(pair["match"]) + 1
        return F.struct((state["at"] + _spaces(pair["before"]) + _spaces(pair["match"])).alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), stop.alias("stop")))).alias("out"))

    pairs = F.filter(F.arrays_zip(F.split(line, whole).alias("before"), found.alias("match")), lambda p: p["match"].isNotNull())
    walked = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("out")), add, lambda s: s["out"])
    return F.when(F.size(found) > 0, walked).otherwise(F.array().cast(f"array<{span}>"))


def _literal(given: list[Rule]) -> Column:
    return F.array(*[
        F.struct(F.lit(r.regex).alias("regex"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(r.priority).alias("priority"), F.lit(r.score).alias("score"), F.lit(i).alias("number"))
        for i, r in enumerate(given)
    ])


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (), given: list[Rule] | None = None) -> DataFrame:
    """Per row: the id, ``keep``, ``n_words``, ``detections`` (those that stay), ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score``."""
    text = F.coalesce(tables.exactly(docs, text_column), F.lit(""))
    base = docs.select(tables.exactly(docs, id_column).alias("id"), tables.carried(docs, list(keep)), text.alias("text"))
    words = F.call_function("regexp_extract_all", F.translate("text", string.ascii_uppercase, string.ascii_lowercase), F.lit(WORD), F.lit(0))
    line = F.when(F.col("text").rlike(_GATE), F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))).otherwise(F.lit(" "))
    lines = settle(base.select("id", "carried", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), line.alias("line")))

    phrases = F.array(*[F.struct(F.lit(p).alias("regex"), F.lit(n).alias("label")) for p, n in BASE.items()])
    base_hits = F.flatten(F.transform(phrases, lambda r: F.transform(_places(F.col("line"), r["regex"]), lambda p: F.struct(p["start"].alias("start"), p["stop"].alias("stop"), r["label"].alias("label")))))
    likely = F.filter(_literal(rules() if given is None else given), lambda r: F.contains(F.col("line"), r["keyword"]))

    def hits(rule):
        return F.transform(
            _places(F.col("line"), rule["regex"]),
            lambda p: F.struct(rule["priority"].alias("priority"), (p["start"] - p["stop"]).alias("size"), rule["number"].alias("number"), p["start"].alias("start"), p["stop"].alias("stop"), rule["label"].alias("label"), rule["score"].alias("score")),
        )

    some = F.length("line") > 1
    none_base, none = "array<struct<start:bigint,stop:bigint,label:string>>", "array<struct<priority:int,size:bigint,number:int,start:bigint,stop:bigint,label:string,score:double>>"
    found = settle(
        lines.select(
            "id", "carried", "n_words",
            F.when(some, base_hits).otherwise(F.array().cast(none_base)).alias("base"),
            F.when(some, F.flatten(F.transform(likely, hits))).otherwise(F.array().cast(none)).alias("all_hits"),
        )
    )

    def stays(hit):
        def better(other):
            rank = F.struct(other["priority"], other["size"], other["number"]) < F.struct(hit["priority"], hit["size"], hit["number"])
            return (other["start"] <= hit["start"]) & (other["stop"] >= hit["stop"]) & rank

        return ~F.exists("all_hits", better)

    kept = settle(found.withColumn("detections", F.filter("all_hits", stays)))
    starts = F.transform("base", lambda h: h["start"])
    base_labels = F.array_distinct(F.transform("base", lambda h: h["label"]))
    labels = F.array_distinct(F.concat(base_labels, F.transform("detections", lambda h: h["label"])))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("detections", lambda h: h["score"])), F.lit(0.0)))
    own = {id_column, "n_words", "detections", "n_base", "first_word", "last_word", "base_labels", "labels", "score"}
    return kept.select(
        F.col("id").alias(id_column), *tables.released(list(keep), own), "n_words", "detections",
        F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"), score.alias("score"),
    )


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(tables.table(spark, folder, "documents", "doc_id", "text")).drop("detections")
