"""Repair of malformed JSON answers as a chain of projections.

The answers were generated behind a prefilled opening, so most of them start inside the first string
value. Every stage is one projection over the stage before it. A stage that reads its input more than
once is kept apart by the optimizer, so the expression tree grows with the number of stages only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import strip_blanks

# Ordered replacements, find -> put. They do not commute.
LAYOUT_RULES: tuple[tuple[str, str], ...] = (
    ("    ", ""),
    ('"]\n"', '"],\n"'),
    ('"\n"', '",\n"'),
    ('\n",\n', '",\n'),
    ('\n",\n"', '",\n"'),
    ('\n" ,\n', '",\n'),
    ("\n\n", "\n"),
    ('",\n]', '"\n]'),
)
JOINT_RULES: tuple[tuple[str, str], ...] = (("]}", "]"), (" \n", " "))
DOUBLE_BLANK_RULES: tuple[tuple[str, str], ...] = (("  ", " "), ("  ", " "))
PUNCTUATION_RULES: tuple[tuple[str, str], ...] = (
    (']"', '],"'),
    ("},]", "}]"),
    ("}{", "},{"),
    ("]]", "]"),
    ('"] "', '"], "'),
    ("]{", '],"relations":{'),
    ("}}", "}"),
    ('" ', '"'),
)
DESCRIPTION_KEY = '"description":'
DESCRIPTION_WITHIN = 200
PREFILL = '{\n"description": "'
ENTITIES_KEY = '"list_of_entities"'
# Quoted names known to occur inside string values; callers may pass others.
QUOTED_NAMES: tuple[str, ...] = ("Ekmann-Hilton",)


def replace_in_order(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply literal replacements one after the other.

    Most texts hold few of them, and a test for one costs a fraction of a replacement that finds nothing.
    """
    steps = F.array(*[F.struct(F.lit(find).alias("find"), F.lit(put).alias("put"), F.lit(len([*run])).alias("times")) for (find, put), run in groupby(rules)])

    def applied(done: Column, rule: Column) -> Column:
        once = F.replace(done, rule["find"], rule["put"])
        # A rule that is given twice in a row finds nothing the second time if it found nothing the first time.
        again = F.aggregate(F.sequence(F.lit(2), rule["times"]), once, lambda text, _: F.replace(text, rule["find"], rule["put"]))
        return F.when(F.contains(done, rule["find"]), F.when(rule["times"] > 1, again).otherwise(once)).otherwise(done)

    return F.aggregate(steps, text, applied)


def normalise_layout(text: Column) -> Column:
    """Indentation, missing commas at line ends, stray quotes on their own line."""
    return replace_in_order(text, LAYOUT_RULES)


def opens_itself(text: Column) -> Column:
    """Does the answer carry its own description key near the start?"""
    return F.contains(F.substring(text, 1, DESCRIPTION_WITHIN), F.lit(DESCRIPTION_KEY))


def restore_prefill(text: Column, own: Column) -> Column:
    """Put the prefilled opening back, or start at the first brace if the answer opened itself."""
    return F.when(own, F.regexp_extract(text, r"(?s)\{.*", 0)).otherwise(F.concat(F.lit(PREFILL), text))


def before_last_brace(text: Column) -> Column:
    """Text up to, not including, the last closing brace; empty if there is none."""
    return F.regexp_extract(text, r"(?s)^(.*)\}", 1)


def close_object(text: Column, own: Column) -> Column:
    """Close the object again after the tail was cut off."""
    return (
        F.when(text == "", text)
        .when(own, F.concat(text, F.lit("}")))
        .when(F.endswith(text, F.lit("}")), text)
        .otherwise(F.concat(text, F.lit("\n}")))
    )


def is_fit(text: Column) -> Column:
    """An answer without an entity list cannot be repaired."""
    return F.contains(text, F.lit(ENTITIES_KEY))


def description_line(lead: Column) -> Column:
    """The description on one line, from what stands before the entity list."""
    line = F.replace(F.substring_index(lead, "{\n", -1), F.lit("\n"), F.lit(" "))
    return replace_in_order(strip_blanks(line), DOUBLE_BLANK_RULES)


def end_description(line: Column) -> Column:
    """Make the description end in a quote and a comma."""
    closed = F.when(F.endswith(line, F.lit('"')), F.concat(line, F.lit(",")))
    complete = F.endswith(line, F.lit('" ,')) | F.endswith(line, F.lit('",'))
    return closed.when(complete, line).otherwise(F.concat(line, F.lit('",')))


def rejoin_lines(text: Column) -> Column:
    """Keep a line break only after a quote and a comma, the end of the text counting as one."""
    joined = F.regexp_replace(text, r'\n(?<!",\n)', "")
    return F.when(F.endswith(joined, F.lit('",')), F.concat(joined, F.lit("\n"))).otherwise(joined)


def close_array(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("]")), F.concat(text, F.lit("}"))).otherwise(text)


def recover_description(text: Column, lead: Column) -> Column:
    """Take the description from the second piece when the last piece before the entity list was empty."""
    piece = F.split_part(lead, F.lit("{\n"), F.lit(2))
    # Fixed value: a slash and an n, not a line break.
    opening = F.concat(F.lit("{"), replace_in_order(piece, (("/n", ""), ("}", ""))))
    opening = strip_blanks(opening)
    rest = F.substr(text, F.lit(4))
    found = F.concat(opening, F.when(F.endswith(opening, F.lit('"')), F.lit(",")).otherwise(F.lit("")), rest)
    return F.when(F.startswith(text, F.lit('{",')), found).otherwise(text)


def close_relations(text: Column) -> Column:
    """Close a relation list that was cut after one of its objects."""
    open_list = F.endswith(text, F.lit("}")) & ~F.endswith(text, F.lit("]}"))
    return F.when(open_list, F.concat(text, F.lit("]}"))).otherwise(text)


def repair_punctuation(text: Column, quoted_names: Sequence[str] = QUOTED_NAMES) -> Column:
    """Commas, brackets and quotes; last of the text stages."""
    escapes = tuple((f'"{name}" ', f'\\"{name}\\" ') for name in quoted_names)
    return replace_in_order(text, escapes + DOUBLE_BLANK_RULES + PUNCTUATION_RULES)


def repair_stages(
    df: DataFrame, answer: str = "part_topics", quoted_names: Sequence[str] = QUOTED_NAMES
) -> DataFrame:
    """All text stages, each as a column: ``normalised``, ``own_description``, ``opened``, ``closed``,
    ``fit``, ``lead``, ``rest``, ``description``, ``rejoined``, ``completed``, ``repaired_text``."""
    c = F.col
    steps: tuple[tuple[str, Column], ...] = (
        ("normalised", normalise_layout(c(answer))),
        ("own_description", opens_itself(c("normalised"))),
        ("opened", restore_prefill(c("normalised"), c("own_description"))),
        ("_cut", before_last_brace(c("opened"))),
        ("closed", close_object(c("_cut"), c("own_description"))),
        ("fit", is_fit(c("closed"))),
        ("lead", F.split_part(c("closed"), F.lit(ENTITIES_KEY), F.lit(1))),
        ("rest", F.split_part(c("closed"), F.lit(ENTITIES_KEY), F.lit(2))),
        ("_line", description_line(c("lead"))),
        ("description", end_description(c("_line"))),
        (
            "rejoined",
            rejoin_lines(
                replace_in_order(
                    F.concat(F.lit("{\n"), c("description"), F.lit("\n" + ENTITIES_KEY), c("rest")), JOINT_RULES
                )
            ),
        ),
        ("_arrayed", close_array(c("rejoined"))),
        ("_recovered", recover_description(c("_arrayed"), c("lead"))),
        ("completed", close_relations(c("_recovered"))),
        ("repaired_text", repair_punctuation(c("completed"), quoted_names)),
    )
    for name, value in steps:
        df = df.withColumn(name, value)
    return df.drop("_cut", "_line", "_arrayed", "_recovered")


def json_from_free_text(text: Column) -> Column:
    """JSON object found in free text as a variant: first brace to last brace, else first brace to last
    bracket (to the end, if there is no bracket) plus a closing brace, else NULL."""
    to_brace = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    to_bracket = F.when(F.contains(text, F.lit("]")), F.regexp_extract(text, r"(?s)\{.*\]", 0)).otherwise(
        F.regexp_extract(text, r"(?s)\{.*", 0)
    )
    return F.coalesce(F.try_parse_json(to_brace), F.try_parse_json(F.concat(to_bracket, F.lit("}"))))
