"""Shapes of raw model answers, used to derive an answer table from a corpus without a model.

Every shape is a template over ``{D}`` (the part's own text as a description), ``{a}``, ``{b}`` and ``{c}``
(three entity names taken from the part). Between them they reach every branch of the repair job.
"""

from __future__ import annotations


def _relation(description: str, source: str, target: str, *more: str) -> str:
    lines = [f'"description": "{description}"', f'"source_entity": "{source}"', f'"target_entity": "{target}"', *more]
    inner = ",\n            ".join(lines)
    return "        {{\n            " + inner + "\n        }}"


def _answer(
    relations: list[str], entities: str = '["{a}", "{b}"]', description: str = "{D}", end: str = "\n    ]\n}}"
) -> str:
    head = f'{description}",\n    "list_of_entities": {entities},\n    "relations": [\n'
    return head + ",\n".join(relations) + end


_PLAIN = _relation("{a} acts on {b}", "{a}", "{b}")
_SECOND = _relation("{c} limits {b}", "{c}", "{b}")
_MULTILINE = (
    '        {{\n            "description": "{a} with {b} forms {c}",\n'
    '            "source_entities": [\n                "{a}",\n                "{b}"\n            ],\n'
    '            "target_entities": [\n                "{c}"\n            ]\n        }}'
)
_ONE_LINE = '{{"description": "{a} is {b}", "source_entities": ["{a}"], "target_entities": ["{b}"]}}'

SHAPES: tuple[str, ...] = (
    # 0: complete behind the prefilled opening
    _answer([_PLAIN]),
    # 1: a short description, so the relation's own key is taken for the opening
    _answer([_PLAIN], description="Short."),
    # 2: prose
    "{D} This part names no relations.",
    # 3: description is not the first key
    _answer(
        [
            '        {{\n            "source_entity": "{a}",\n            "target_entity": "{b}",\n'
            '            "description": "{a} acts on {b}"\n        }}'
        ]
    ),
    # 4: the only relation has no description
    _answer(['        {{\n            "source_entity": "{a}",\n            "target_entity": "{b}"\n        }}']),
    # 5: the second relation repeats the prompt's example
    _answer([_PLAIN, _relation("{c} blocks dopamine", "{c}", "{b}")]),
    # 6: two relations with one description
    _answer([_PLAIN, _relation("{a} acts on {b}", "{c}", "{b}")]),
    # 7: a number among the entities
    _answer([_PLAIN], entities='["{a}", 5]'),
    # 8: a comma is missing after a description
    _answer([_PLAIN.replace('{b}",\n            "source', '{b}"\n            "source', 1)]),
    # 9: prose after the last brace
    _answer([_PLAIN]) + "\nI hope this helps.",
    # 10: ends after the last relation
    _answer([_PLAIN, _SECOND], end=""),
    # 11: cut inside the second relation
    _answer([_PLAIN, '        {{\n            "description": "{c} lim'], end=""),
    # 12: a relation on one line whose last value is an array
    _answer(["        " + _ONE_LINE]),
    # 13: prose, then a complete object with its own description
    'Here: {{\n    "description": "' + _answer([_PLAIN, _SECOND]),
    # 14: an example entity in the list and as a source
    _answer([_relation("{a} meets caffeine", "caffeine", "{b}"), _SECOND], entities='["{a}", "caffeine"]'),
    # 15: arrays over several lines, with a strength
    _answer([_MULTILINE, _relation("{b} helps {c}", "{b}", "{c}", '"strength": "weak"')], entities='["{c}"]'),
)
