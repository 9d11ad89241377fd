"""Cleaned relation documents as JSON text, laid out as a Python JSON writer lays them out.

Spark's own JSON writer uses other blanks and cannot escape non-ASCII characters in lower case, so the
few fixed shapes are put together from column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short escapes of JSON strings.
SHORT_ESCAPES = (
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
)
# Printable ASCII without quote and backslash, one by one: a regular expression tests single characters by one look into a table.
_PLAIN = "".join(f"\\x{code:02x}" for code in range(0x20, 0x7F) if chr(code) not in '"\\')


def _escape(code: int, last_plain: int) -> str:
    short = dict(SHORT_ESCAPES).get(chr(code))
    return short or (chr(code) if 0x20 <= code <= last_plain else f"\\u{code:04x}")


# Characters below this one, escaped, stand in a literal list; the codes of surrogates follow much later.
_LISTED = 0x800


def _unit(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escaped(run: Column, last_plain: int) -> Column:
    """A run of plain characters as it is; any other run is one character, which is escaped."""
    # One literal, cut when the plan is optimized: thousands of them would be planned at every place. NUL itself is escaped.
    listed = F.split(F.lit("\0".join(_escape(code, last_plain) for code in range(_LISTED))), r"\x00")
    code = F.ascii(run)
    above = code - 0x10000
    pair = F.concat(
        _unit(F.lit(0xD800) + F.floor(above / F.lit(0x400)).cast("int")),
        _unit(F.lit(0xDC00) + F.pmod(above, F.lit(0x400))),
    )
    rare = F.when(code.between(0x20, last_plain), run).when(code < 0x10000, _unit(code)).otherwise(pair)
    return F.when(F.length(run) > 1, run).otherwise(F.coalesce(F.get(listed, code), rare))


def json_string(text: Column, ascii_only: bool = True) -> Column:
    """Quoted JSON string. A text without special characters is taken as it is; any other one is cut, into runs of plain
    characters and single ones to be escaped."""
    plain = _PLAIN if ascii_only else r'^\x00-\x1f"\\'
    other = "^" + _PLAIN if ascii_only else r'\x00-\x1f"\\'
    runs = F.regexp_extract_all(text, F.lit(f"[{plain}]++|[{other}]"), F.lit(0))
    escaped = F.array_join(F.transform(runs, lambda run: _escaped(run, 0x7E if ascii_only else 0x10FFFF)), "")
    body = F.when(text.rlike(rf"\A[{plain}]*+\z"), text).otherwise(escaped)
    return F.concat(F.lit('"'), body, F.lit('"'))


def _lines(items: Column, opening: str, closing: str, indent: int) -> Column:
    """A list that is not empty, over several lines."""
    inner, outer = "\n" + " " * (indent + 2), "\n" + " " * indent
    return F.concat(F.lit(opening + inner), F.array_join(items, "," + inner), F.lit(outer + closing))


def _block(given: Column, text: Callable[[Column], Column], indent: int) -> Column:
    """``text`` of every element over several lines; an empty list is closed on the spot. What is given is measured, not its
    texts: they would be built a second time, on every level that has lists inside."""
    return F.when(F.size(given) == 0, F.lit("[]")).otherwise(_lines(F.transform(given, text), "[", "]", indent))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}": '), value)


def _fields(relation: Column, ascii_only: bool, layout: Callable[[Column], Column]) -> Column:
    """The fields of a relation, NULL where it has none; ``layout`` writes a list of names."""
    return F.array(
        _field("description", json_string(relation["description"], ascii_only)),
        _field("source_entities", layout(relation["source_entities"])),
        _field("target_entities", layout(relation["target_entities"])),
        _field("strength", json_string(relation["strength"], ascii_only)),
    )


def _object(fields: Column, given: Sequence[Column], indent: int) -> Column:
    """Fields that are not NULL over several lines; without a given value there are none."""
    nothing = reduce(and_, [value.isNull() for value in given])
    return F.when(nothing, F.lit("{}")).otherwise(_lines(fields, "{", "}", indent))


def pretty_answer(document: Column, ascii_only: bool = True) -> Column:
    """Training answer: description, entities, relations, indented by two; a missing strength is left out."""

    def name(value: Column) -> Column:
        return json_string(value, ascii_only)

    def relation(value: Column) -> Column:
        given = [value[field] for field in ("description", "source_entities", "target_entities", "strength")]
        return _object(_fields(value, ascii_only, lambda names: _block(names, name, 6)), given, 4)

    given = [document[field] for field in ("section_description", "list_of_entities", "relations")]
    fields = F.array(
        _field("section_description", name(given[0])),
        _field("list_of_entities", _block(given[1], name, 2)),
        _field("relations", _block(given[2], relation, 2)),
    )
    return _object(fields, given, 0)


def _line(items: Column, opening: str, closing: str) -> Column:
    return F.concat(F.lit(opening), F.array_join(items, ", "), F.lit(closing))


def serialise_document(document: Column, ascii_only: bool = True) -> Column:
    """Stored form: entities, relations, description on one line."""

    def listed(names: Column) -> Column:
        return _line(F.transform(names, lambda name: json_string(name, ascii_only)), "[", "]")

    relations = F.transform(document["relations"], lambda relation: _line(_fields(relation, ascii_only, listed), "{", "}"))
    fields = F.array(
        _field("list_of_entities", listed(document["list_of_entities"])),
        _field("relations", _line(relations, "[", "]")),
        _field("section_description", json_string(document["section_description"], ascii_only)),
    )
    return _line(fields, "{", "}")
