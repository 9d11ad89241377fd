"""Validation and unification of parsed relation documents, row by row on variants and arrays.

All relations of one document came out of one bounded model answer, so merging them inside the row needs
no shuffle and no group can become hot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.schemas import RELATION_DOCUMENT

# Entity names and description words that leak from the prompt's example.
EXAMPLE_ENTITIES = (
    "dopamine",
    "D1",
    "D2",
    "D3",
    "D4",
    "D5",
    "dopamine receptors",
    "adenosine",
    "A1",
    "A2A",
    "A2B",
    "A3",
    "caffeine",
)
EXAMPLE_WORDS = ("dopamine", "adenosine")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it for every element of an array."""
    return F.transform(F.array(value), body)[0]


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _is_list(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))


def _is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def variant_list(document: Column, path: str) -> Column:
    """Elements of a list inside a variant; NULL if the path is missing or no list."""
    return F.try_variant_get(document, path, "array<variant>")


def relation_texts(text: Column) -> Column:
    """Raw JSON text of every relation, keys in their original order (a variant would sort them)."""
    return F.from_json(text, "relations array<string>")["relations"]


def first_key(relation_text: Column) -> Column:
    return F.get(F.json_object_keys(relation_text), F.lit(0))


def description_first(relation_text: Column) -> Column:
    """Is the first key the description? Seen from the start of the text, unless the key is written with escapes."""
    return relation_text.rlike(r'\A\{\s*+"description"') | (first_key(relation_text) == "description")


def endpoint_values(fields: Column, prefix: str) -> Column:
    """Values of every key that starts with ``prefix``, as one array of variants: a text counts as one
    element, a list as its elements, anything else is ignored."""
    chosen = F.map_values(F.map_filter(fields, lambda key, _: F.startswith(key, F.lit(prefix))))
    nothing = F.array().cast("array<variant>")
    return F.flatten(
        F.transform(
            chosen,
            lambda value: F.when(_is_text(value), F.array(value))
            .when(_is_list(value), F.try_variant_get(value, "$", "array<variant>"))
            .otherwise(nothing),
        )
    )


def _texts(values: Column) -> Column:
    return F.array_distinct(F.transform(values, lambda value: F.try_variant_get(value, "$", "string")))


def descriptions_open(text: Column) -> Column:
    """Is the description the first key behind every brace of the text? A quote inside a JSON string is escaped, so a string
    cannot look like that; whatever else stands behind a brace says no."""
    return ~text.rlike(r'\{(?!\s*+"description")')


def relation_facts(relations: Column, texts: Column, opened: Column | None = None) -> Column:
    """What validation needs to know of every relation: array of structs (object, described, first, description, sources, targets,
    clean, strength, plain). Where ``opened`` says that every description comes first, ``texts`` are not looked at.
    """

    def facts(relation: Column, first: Column) -> Column:
        """The relation is cast once, its ends are collected once."""
        return _bound(F.try_variant_get(relation, "$", "map<string,variant>"), lambda fields: of_fields(fields, first))

    def of_fields(fields: Column, first: Column) -> Column:
        values = F.struct(
            F.try_element_at(fields, F.lit("description")).alias("description"),
            endpoint_values(fields, "source_").alias("sources"),
            endpoint_values(fields, "target_").alias("targets"),
            F.try_element_at(fields, F.lit("strength")).alias("strength"),
        )
        return _bound(values, lambda value: of_values(fields, first, *[value[n] for n in ("description", "sources", "targets", "strength")]))

    def of_values(fields: Column, first: Column, description: Column, sources: Column, targets: Column, strength: Column) -> Column:
        return F.struct(
            fields.isNotNull().alias("object"),
            # A JSON null is a value, not a missing one.
            F.when(fields.isNotNull(), description.isNotNull()).alias("described"),
            first.alias("first"),
            F.when(_is_text(description), F.try_variant_get(description, "$", "string")).alias("description"),
            _texts(sources).alias("sources"),
            _texts(targets).alias("targets"),
            F.forall(F.concat(sources, targets), _is_text).alias("clean"),
            F.try_variant_get(strength, "$", "string").alias("strength"),
            (strength.isNull() | ~(_is_list(strength) | _is_object(strength))).alias("plain"),
        )

    by_text = F.zip_with(relations, texts, lambda relation, text: facts(relation, description_first(text)))
    if opened is None:
        return by_text
    # Only the text has the order of the keys; it is parsed a second time where its braces leave that open.
    return F.when(opened, F.transform(relations, lambda relation: facts(relation, F.lit(True)))).otherwise(by_text)


def described(facts: Column) -> Column:
    """Relations without a description key are skipped."""
    return F.filter(facts, lambda relation: relation["described"])


def mentions_example(description: Column, words: Sequence[str] = EXAMPLE_WORDS) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(description, F.lit(word))
    return found


def pick_strength(strengths: Column) -> Column:
    """The smallest of the merged strengths; NULL if there is none."""
    return F.array_min(strengths)


def own_relations(facts: Column) -> Column:
    """Described relations that do not repeat the prompt's example."""
    return F.filter(described(facts), lambda relation: ~mentions_example(relation["description"]))


def merge_relations(own: Column) -> Column:
    """One relation per description, in order of first appearance, with the union of the ends.

    Relations are sorted by description, so equal ones are a run, and each run is cut out once: the work grows with the
    number of relations times its logarithm, however many descriptions there are.
    """
    placed = F.transform(
        own,
        lambda r, i: F.struct(r["description"].alias("description"), i.alias("at"), r["sources"].alias("sources"), r["targets"].alias("targets"), r["strength"].alias("strength")),
    )

    def starts(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda i: (i == 0) | ~F.get(ordered, i)["description"].eqNullSafe(F.get(ordered, i - 1)["description"]))

    def runs(ordered: Column) -> Column:
        def cut(begins: Column) -> Column:
            return F.transform(begins, lambda begin, n: F.slice(ordered, begin + 1, F.coalesce(F.get(begins, n + 1), F.size(ordered)) - begin))

        return _bound(starts(ordered), cut)

    def merged(run: Column) -> Column:
        first = F.get(run, F.lit(0))
        return F.struct(
            first["at"].alias("at"),
            first["description"].alias("description"),
            F.array_distinct(F.flatten(F.transform(run, lambda r: r["sources"]))).alias("source_entities"),
            F.array_distinct(F.flatten(F.transform(run, lambda r: r["targets"]))).alias("target_entities"),
            pick_strength(F.transform(run, lambda r: r["strength"])).alias("strength"),
        )

    def plain(relation: Column) -> Column:
        return F.struct(
            relation["description"].alias("description"),
            F.array_distinct(relation["sources"]).alias("source_entities"),
            F.array_distinct(relation["targets"]).alias("target_entities"),
            relation["strength"].alias("strength"),
        )

    found = F.array_sort(F.transform(_bound(F.array_sort(placed), runs), merged))
    in_runs = F.transform(
        found,
        lambda r: F.struct(r["description"].alias("description"), r["source_entities"].alias("source_entities"), r["target_entities"].alias("target_entities"), r["strength"].alias("strength")),
    )
    descriptions = F.transform(own, lambda r: r["description"])
    # Most answers have no two relations of one description: nothing to sort or merge then.
    return F.when(F.size(F.array_distinct(descriptions)) == F.size(own), F.transform(own, plain)).otherwise(in_runs)


def close_entities(
    entities: Column, relations: Column, excluded: Sequence[str] = EXAMPLE_ENTITIES
) -> Column:
    """Listed entities plus every end of a kept relation, once each, without the prompt's example names."""
    ends = F.flatten(
        F.transform(relations, lambda r: F.array_union(r["source_entities"], r["target_entities"]))
    )
    return F.array_except(F.concat(entities, ends), F.array(*[F.lit(name) for name in excluded]))


def read_document(text: Column) -> Column:
    """Stored JSON text back to a relation document, with the fixed schema."""
    return F.from_json(text, RELATION_DOCUMENT)
