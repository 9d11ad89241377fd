"""DuckDB statements that say independently what every registered query must return.

The statements share common table expressions; a statement gets those it names, and what these name.
"""

from __future__ import annotations

import re
from string import Formatter

from corpusloom.functions import answers, documents, prompts
from corpusloom.functions.jsontext import SHORT_ESCAPES
from corpusloom.functions.text import BLANK_CHARACTERS, REFERENCE_MARKERS
from corpusloom.plans.sample_answers import SHAPES


def text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("'", "''") + "'"


def replaced(column: str, rules) -> str:
    for find, put in rules:
        column = f"replace({column}, {text(find)}, {text(put)})"
    return column


def rendered(template: str, **fields: str) -> str:
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(text(literal))
        if name is not None:
            pieces.append(fields[name])
    return "(" + " || ".join(pieces) + ")"


def names(values) -> str:
    return "(" + ", ".join(text(value) for value in values) + ")"


def stripped(column: str) -> str:
    return f"trim({column}, {text(BLANK_CHARACTERS)})"


_shape = " ".join(
    f"WHEN {number} THEN {rendered(shape, D='d', a='a', b='b', c='c')}" for number, shape in enumerate(SHAPES)
)
_nl = "chr(10)"

COMMON: dict[str, str] = {
    "src": """
        SELECT doc_id AS article_id, text AS article, split_part(text, chr(10), 1) AS abstract,
               concat('intro', chr(10), source, chr(10), lang) AS section_names, lang AS dataset
        FROM documents""",
    "tok": r"SELECT article_id, regexp_extract_all(article, '\S+') AS t FROM src",
    "win": """
        SELECT article_id, s // 48 AS part_no, article_id * 16777216 + s // 48 AS part_id,
               array_to_string(t[s + 1 : s + 64], ' ') AS part_text, len(t[s + 1 : s + 64]) AS n_tokens
        FROM (SELECT article_id, t, unnest(range(0, len(t), 48)) AS s FROM tok)""",
    "reg": """
        SELECT row_number() OVER (ORDER BY article_id, part_no) - 1 AS part_index, 64 AS chunk_size,
               16 AS chunk_overlap, article_id, part_id
        FROM win""",
    "summ": """
        SELECT article_id, 'Summary: ' || abstract AS article_summary, 0 AS summary_variant,
               article_id * 16 AS summary_id
        FROM src WHERE article_id IN (SELECT doc_id FROM labels)
        UNION ALL
        SELECT article_id, 'Summary: ' || abstract, 1, article_id * 16 + 1
        FROM src WHERE article_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "all_summ": """
        SELECT article_id, 'Summary: ' || abstract AS article_summary, 0 AS summary_variant,
               article_id * 16 AS summary_id
        FROM src""",
    "filled": r"""
        SELECT article_id, part_id, part_no, n_tokens,
               plain || repeat('x', greatest(220 - length(plain), 0)) AS d,
               'e1' || regexp_replace(coalesce(w[1], ''), '[^A-Za-z0-9]', '', 'g') AS a,
               'e2' || regexp_replace(coalesce(w[2], ''), '[^A-Za-z0-9]', '', 'g') AS b,
               'e3' || regexp_replace(coalesce(w[3], ''), '[^A-Za-z0-9]', '', 'g') AS c
        FROM (SELECT *, regexp_replace(part_text, '["\\\[\]{}]', '', 'g') AS plain, string_split(part_text, ' ') AS w
              FROM win)""",
    "ans": f"""
        SELECT article_id, part_id, part_id * 16 AS topics_id, article_id * 16 AS article_summary_id, n_tokens,
               CASE (article_id + part_no) % {len(SHAPES)} {_shape} END AS part_topics
        FROM filled""",
    "topics": """
        SELECT ans.* FROM ans JOIN labels ON doc_id = article_id WHERE quality = 1 AND n_tokens = 64""",
    # The repair rules, stage by stage.
    "r1": f"SELECT part_id, {replaced('part_topics', answers.LAYOUT_RULES)} AS normalised FROM ans",
    "r2": f"""
        SELECT *, CASE WHEN own THEN regexp_extract(normalised, '(?s)\\{{.*')
                       ELSE {text(answers.PREFILL)} || normalised END AS opened
        FROM (SELECT *, contains(substr(normalised, 1, 200), {text(answers.DESCRIPTION_KEY)}) AS own FROM r1)""",
    "r3": f"""
        SELECT *, CASE WHEN cut = '' THEN '' WHEN own OR NOT ends_with(cut, '}}')
                       THEN cut || CASE WHEN own THEN '' ELSE {_nl} END || '}}' ELSE cut END AS closed
        FROM (SELECT *, regexp_extract(opened, '(?s)^(.*)\\}}', 1) AS cut FROM r2)""",
    "r4": f"""
        SELECT *, contains(closed, {text(answers.ENTITIES_KEY)}) AS fit,
               split_part(closed, {text(answers.ENTITIES_KEY)}, 1) AS lead,
               split_part(closed, {text(answers.ENTITIES_KEY)}, 2) AS rest
        FROM r3""",
    "r5": f"""
        SELECT *, CASE WHEN line LIKE '%"' THEN line || ',' WHEN line LIKE '%" ,' OR line LIKE '%",' THEN line
                       ELSE line || '",' END AS description
        FROM (SELECT *, {replaced(stripped("replace(split_part(lead, '{' || chr(10), -1), chr(10), ' ')"),
                                  answers.DOUBLE_BLANK_RULES)} AS line FROM r4)""",
    # chr(1) stands for a line break that is kept.
    "r6": f"""
        SELECT *, CASE WHEN ends_with(one, '",') THEN one || {_nl} ELSE one END AS rejoined
        FROM (SELECT *, replace(replace(replace(
                  {replaced("'{' || chr(10) || description || chr(10) || " + text(answers.ENTITIES_KEY) + " || rest",
                            answers.JOINT_RULES)},
                  '",' || {_nl}, '",' || chr(1)), {_nl}, ''), chr(1), {_nl}) AS one FROM r5)""",
    "r7": """
        SELECT *, CASE WHEN ends_with(found, '}') AND NOT ends_with(found, ']}') THEN found || ']}'
                       ELSE found END AS completed
        FROM (SELECT *, CASE WHEN starts_with(arrayed, '{",')
                             THEN opening || CASE WHEN ends_with(opening, '"') THEN ',' ELSE '' END || substr(arrayed, 4)
                             ELSE arrayed END AS found
              FROM (SELECT *, CASE WHEN ends_with(rejoined, ']') THEN rejoined || '}' ELSE rejoined END AS arrayed, """
    + stripped("'{' || replace(replace(split_part(lead, '{' || chr(10), 2), '/n', ''), '}', '')")
    + """ AS opening FROM r6))""",
    "r8": f"""
        SELECT *, {replaced('completed', (('"Ekmann-Hilton" ', chr(92) + '"Ekmann-Hilton' + chr(92) + '" '),)
                            + answers.DOUBLE_BLANK_RULES + answers.PUNCTUATION_RULES)} AS repaired_text
        FROM r7""",
    "parsed": r"""
        SELECT part_id, fit, repaired_text, json,
               json_type(json, '$.description') AS description_type,
               json_type(json, '$.list_of_entities') AS entities_type,
               json_type(json, '$.relations') AS relations_type
        FROM (SELECT *, CASE WHEN fit AND json_valid(repaired_text)
                              AND NOT regexp_matches(repaired_text, ',\s*[\]}]') THEN repaired_text::JSON END AS json
              FROM r8)""",
    "listed": """
        SELECT part_id, ix, json_type(e) AS kind, json_extract_string(e, '$') AS name
        FROM (SELECT part_id, unnest(es) AS e, unnest(range(len(es))) AS ix
              FROM (SELECT part_id, json_extract(json, '$.list_of_entities[*]') AS es FROM parsed
                    WHERE entities_type = 'ARRAY'))""",
    "rel": """
        SELECT part_id, pos, r, json_type(r) AS kind, json_keys(r)[1] AS first_key,
               list_contains(json_keys(r), 'description') AS described,
               json_type(r, '$.description') AS description_type,
               json_extract_string(r, '$.description') AS description,
               json_extract_string(r, '$.strength') AS strength
        FROM (SELECT part_id, unnest(rs) AS r, unnest(range(len(rs))) AS pos
              FROM (SELECT part_id, json_extract(json, '$.relations[*]') AS rs FROM parsed
                    WHERE relations_type = 'ARRAY'))""",
    "relkey": """
        SELECT part_id, pos, description, k, json_extract(r, '$.' || k) AS v
        FROM (SELECT part_id, pos, description, r, unnest(json_keys(r)) AS k FROM rel WHERE described)""",
    "ends": """
        SELECT part_id, pos, description, k, 0 AS ix, CASE WHEN k LIKE 'source\\_%' ESCAPE '\\' THEN 's' ELSE 't' END AS side,
               json_type(v) AS kind, json_extract_string(v, '$') AS name
        FROM relkey WHERE regexp_matches(k, '^(source|target)_') AND json_type(v) = 'VARCHAR'
        UNION ALL
        SELECT part_id, pos, description, k, ix, side, json_type(e), json_extract_string(e, '$')
        FROM (SELECT part_id, pos, description, k, CASE WHEN starts_with(k, 'source_') THEN 's' ELSE 't' END AS side,
                     unnest(vs) AS e, unnest(range(len(vs))) AS ix
              FROM (SELECT *, json_extract(v, '$[*]') AS vs FROM relkey
                    WHERE regexp_matches(k, '^(source|target)_') AND json_type(v) = 'ARRAY'))""".replace("\\\\", "\\"),
    "kept_rel": f"""
        SELECT * FROM rel WHERE described AND NOT contains(description, {text(documents.EXAMPLE_WORDS[0])})
                            AND NOT contains(description, {text(documents.EXAMPLE_WORDS[1])})""",
    "merged": """
        SELECT part_id, description, row_number() OVER (PARTITION BY part_id ORDER BY min(pos)) - 1 AS relation_no,
               min(strength) AS strength
        FROM kept_rel GROUP BY part_id, description""",
    # Ends of kept relations, once per relation and side, in order of first appearance.
    "end_order": """
        SELECT part_id, relation_no, side, name, row_number() OVER (PARTITION BY part_id, relation_no, side ORDER BY o) AS ix
        FROM (SELECT m.part_id, m.relation_no, e.side, e.name, min(row(e.pos, e.k, e.ix)) AS o
              FROM ends e JOIN merged m ON m.part_id = e.part_id AND m.description = e.description
              GROUP BY ALL)""",
    "merged_ends": """
        SELECT part_id, relation_no, list(name ORDER BY ix) FILTER (WHERE side = 's') AS sources,
               list(name ORDER BY ix) FILTER (WHERE side = 't') AS targets
        FROM end_order GROUP BY part_id, relation_no""",
    "entity_order": f"""
        SELECT part_id, name, row_number() OVER (PARTITION BY part_id ORDER BY min(o)) AS ix
        FROM (SELECT part_id, name, row(0, 0, '', ix) AS o FROM listed
              UNION ALL
              SELECT part_id, name, row(1, relation_no, side, ix) FROM end_order)
        WHERE name NOT IN {names(documents.EXAMPLE_ENTITIES)}
        GROUP BY part_id, name""",
    "judged": """
        SELECT p.part_id, p.repaired_text, json_extract_string(json, '$.description') AS section_description,
               CASE WHEN NOT fit THEN 'unfit'
                    WHEN json IS NULL THEN 'invalid_json'
                    WHEN description_type IS DISTINCT FROM 'VARCHAR' THEN 'description_not_text'
                    WHEN entities_type IS DISTINCT FROM 'ARRAY' THEN 'entities_not_a_list'
                    WHEN relations_type IS DISTINCT FROM 'ARRAY' THEN 'relations_not_a_list'
                    WHEN bad_entities > 0 THEN 'entity_not_text'
                    WHEN bad_relations > 0 THEN 'relation_not_object'
                    WHEN not_first > 0 THEN 'description_not_first'
                    WHEN bad_descriptions > 0 THEN 'relation_description_not_text'
                    WHEN bad_ends > 0 THEN 'non_string_endpoint'
                    WHEN coalesce(n_entities, 0) = 0 THEN 'no_entities'
                    WHEN coalesce(n_relations, 0) = 0 THEN 'no_relations' END AS reject_reason
        FROM parsed p
        LEFT JOIN (SELECT part_id, count_if(kind <> 'VARCHAR') AS bad_entities FROM listed GROUP BY 1) l USING (part_id)
        LEFT JOIN (SELECT part_id, count_if(kind <> 'OBJECT') AS bad_relations,
                          count_if(described AND first_key <> 'description') AS not_first,
                          count_if(described AND description_type <> 'VARCHAR') AS bad_descriptions
                   FROM rel GROUP BY 1) r USING (part_id)
        LEFT JOIN (SELECT part_id, count_if(kind <> 'VARCHAR') AS bad_ends FROM ends GROUP BY 1) e USING (part_id)
        LEFT JOIN (SELECT part_id, count(*) AS n_entities FROM entity_order GROUP BY 1) n USING (part_id)
        LEFT JOIN (SELECT part_id, count(*) AS n_relations FROM merged GROUP BY 1) m USING (part_id)""",
    "good": "SELECT part_id, section_description FROM judged WHERE reject_reason IS NULL",
    "good_rel": """
        SELECT m.part_id, m.relation_no, m.description, coalesce(e.sources, []) AS sources,
               coalesce(e.targets, []) AS targets, m.strength
        FROM merged m JOIN good USING (part_id) LEFT JOIN merged_ends e USING (part_id, relation_no)""",
    "good_ent": """
        SELECT part_id, list(name ORDER BY ix) AS entities FROM entity_order JOIN good USING (part_id) GROUP BY part_id""",
    # Stored relation documents as JSON text, on one line and indented.
    "line_rel": """
        SELECT part_id, list('{"description": ' || js(description) || ', "source_entities": ' || js_list(sources)
               || ', "target_entities": ' || js_list(targets)
               || CASE WHEN strength IS NULL THEN '' ELSE ', "strength": ' || js(strength) END || '}'
               ORDER BY relation_no) AS rels
        FROM good_rel GROUP BY part_id""",
    "stored": """
        SELECT part_id, '{"list_of_entities": ' || js_list(entities) || ', "relations": ['
               || array_to_string(rels, ', ') || '], "section_description": ' || js(section_description) || '}' AS raw_relation_text
        FROM good JOIN good_ent USING (part_id) JOIN line_rel USING (part_id)""",
    "pretty_rel": """
        SELECT part_id, list('    {' || chr(10) || '      "description": ' || js(description) || ',' || chr(10)
               || '      "source_entities": ' || js_block(sources, '      ') || ',' || chr(10)
               || '      "target_entities": ' || js_block(targets, '      ')
               || CASE WHEN strength IS NULL THEN '' ELSE ',' || chr(10) || '      "strength": ' || js(strength) END
               || chr(10) || '    }' ORDER BY relation_no) AS rels
        FROM good_rel GROUP BY part_id""",
    "pretty": """
        SELECT part_id, '{' || chr(10) || '  "section_description": ' || js(section_description) || ',' || chr(10)
               || '  "list_of_entities": ' || js_block(entities, '  ') || ',' || chr(10)
               || '  "relations": [' || chr(10) || array_to_string(rels, ',' || chr(10)) || chr(10) || '  ]' || chr(10)
               || '}' AS answer
        FROM good JOIN good_ent USING (part_id) JOIN pretty_rel USING (part_id)""",
    "nodes": """
        SELECT part_id * 256 AS source_id, row_number() OVER (ORDER BY part_id, ix) AS object_id, name AS object_name
        FROM entity_order JOIN good USING (part_id)""",
    "pairs": """
        SELECT part_id * 256 AS source_id, relation_no, description AS relation_type, s.name AS source_name,
               t.name AS target_name, s.ix AS source_at, t.ix AS target_at
        FROM good_rel
        JOIN (FROM end_order WHERE side = 's') s USING (part_id, relation_no)
        JOIN (FROM end_order WHERE side = 't') t USING (part_id, relation_no)""",
    "edges": """
        SELECT row_number() OVER (ORDER BY p.source_id, relation_no, source_at, target_at) AS relation_id,
               p.source_id, a.object_id, b.object_id AS subject_id, relation_type
        FROM pairs p JOIN nodes a ON a.source_id = p.source_id AND a.object_name = p.source_name
        JOIN nodes b ON b.source_id = p.source_id AND b.object_name = p.target_name""",
    # The stored part of the flow, for the selection of pending work.
    "part_summ": """
        SELECT t.part_id, section_description AS part_summary, t.part_id * 16 AS summary_id, t.article_summary_id, t.article_id
        FROM topics t JOIN good USING (part_id) JOIN src USING (article_id) WHERE dataset = 'en'""",
    "raw": """
        SELECT article_id, part_id, part_id * 16 AS part_summary_id, part_id * 16 AS part_topics_id, article_summary_id,
               part_id * 256 AS relation_id
        FROM part_summ WHERE article_id IN (SELECT doc_id FROM labels WHERE toxic = 0)""",
    "wide": """
        SELECT part_id, 'Summary: ' || abstract AS general_text_summary, part_text AS text_part,
               raw_relation_text AS extracted_relations, dataset, abstract, section_names
        FROM stored JOIN win USING (part_id) JOIN src USING (article_id)""",
}


def _json_escaped(column: str) -> str:
    short = replaced(column, SHORT_ESCAPES)
    unit = "chr(92) || 'u' || format('{:04x}', %s)"
    pair = (
        unit % "55296 + ((unicode(ch) - 65536) // 1024)" + " || " + unit % "56320 + ((unicode(ch) - 65536) % 1024)"
    )
    return f"""('"' || array_to_string(list_transform(string_split({short}, ''), lambda ch:
        CASE WHEN unicode(ch) BETWEEN 32 AND 126 OR ch = '' THEN ch WHEN unicode(ch) < 65536
             THEN {unit % 'unicode(ch)'} ELSE {pair} END), '') || '"')"""


def _expand(sql: str) -> str:
    """``js(x)``, ``js_list(x)`` and ``js_block(x, indent)`` stand for JSON text of a text or a text list."""
    sql = re.sub(
        r"js_block\((\w+), ('\s*')\)",
        lambda m: "CASE WHEN len({0}) = 0 THEN '[]' ELSE '[' || chr(10) || array_to_string(list_transform({0}, "
        "lambda s: {1} || '  ' || {2}), ',' || chr(10)) || chr(10) || {1} || ']' END".format(
            m[1], m[2], _json_escaped("s")
        ),
        sql,
    )
    sql = re.sub(
        r"js_list\((\w+)\)",
        lambda m: f"'[' || array_to_string(list_transform({m[1]}, lambda s: {_json_escaped('s')}), ', ') || ']'",
        sql,
    )
    return re.sub(r"\bjs\((\w+)\)", lambda m: _json_escaped(m[1]), sql)


def statement(select: str) -> str:
    """A complete statement: the common table expressions that ``select`` needs, then ``select``."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        words = set(re.findall(r"\w+", sql))
        for name in COMMON:
            if name in words and name not in needed:
                needed.add(name)
                visit(COMMON[name])

    visit(select)
    parts = ",\n".join(f"{name} AS ({_expand(COMMON[name])})" for name in COMMON if name in needed)
    return (f"WITH {parts}\n" if parts else "") + _expand(select)


MARKER_PATTERN = "^(" + "|".join(REFERENCE_MARKERS) + ")"


def training_prompt(name: str) -> str:
    """One fine-tuning format over columns ``general_text_summary``, ``text_part`` and ``answer``."""
    introduction, with_schema, place = prompts.PROMPT_FORMATS[name]
    opening = f"{introduction} {prompts.TASK}"
    opening += f" as follows:\n```json-schema\n{prompts.ANSWER_SCHEMA}\n```\n" if with_schema else ".\n"
    summary = {
        "own heading": f"{prompts.SUMMARY_HEADING}\n{{summary}}\n{prompts.PART_HEADING}\n",
        "above the part": f"{prompts.PART_HEADING}\n{{summary}}\n",
        "absent": f"{prompts.PART_HEADING}\n",
    }[place]
    escaped = opening.replace("{", "{{").replace("}", "}}")
    return rendered(
        escaped + summary + "{part}\n" + prompts.ANSWER_HEADING + "\n{answer}",
        summary="general_text_summary",
        part="text_part",
        answer="answer",
    )
