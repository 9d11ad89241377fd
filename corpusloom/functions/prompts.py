"""Prompt texts as column expressions.

Templates that go *to* a model are parameters; the defaults below are this library's own wording. The six
fine-tuning formats are an output, their texts are fixed.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMMARY_TEMPLATE = """[INST]
Write a summary of a scientific article from its abstract and its section titles. Name the main ideas, concepts and people, not only the main sentences.

Abstract: ```
{abstract}
```

Section titles: ```
{list_of_sections}
```

Answer with nothing but Summary: ```text of the summary```
[/INST]
Summary:
"""

EXTRACTION_TEMPLATE = """[INST]
Read one part of a scientific article and return the relations between its entities as JSON.
Summary of the whole article, for context: ```
{summary}
```

Part to read: ```
{text_to_extract}
```

Layout of the answer:
```json
{{
    "description": "What this part is about.",
    "list_of_entities": ["first entity", "second entity"],
    "relations": [
        {{
            "description": "How the first entity acts on the second.",
            "source_entity": "first entity",
            "target_entity": "second entity",
            "strength": "strong"
        }}
    ]
}}
```
Keep every description short, leave out unimportant relations, and write <<END>> after the JSON.
[/INST]
Relations found in the part:
{{
    "description": "
"""

CATEGORY_TEMPLATE = """[INST]
List the technical terms and ideas of a text segment; they will become nodes of a graph of semantic relations.

Layout of the answer:
{{"segment_summary": "summary", "extracted_categories": {{"category": [{{"description": "what the idea is", "name": "idea"}}]}}}}
Use general categories.

Segment: ```
{text_to_extract}
```

Return the JSON within json``` {{...}} ```
[/INST]
Categories that suit the nodes of a semantic graph:
"""

# Texts of the six fine-tuning formats. The schema is reproduced as published, including
# its two misplaced commas.
ANSWER_SCHEMA = """{
  "$schema": "extraction_schema.json",
  "type": "object",
  "properties": {
    "section_description": {
      "type": "string"
    }
    "list_of_entities": {
      "type": "array",
      "items": {
        "type": "string"
      }
    },
    "relations": {
      "type": "array",
      "items": {
        "type": "object",
        "properties": {
          "description": {
            "type": "string"
          },
          "source_entities": {
            "type": "array",
            "items": {
              "type": "string"
            }
          },
          "target_entities": {
            "type": "array",
            "items": {
              "type": "string"
            }
          },
          "strength": {
            "type": "string",
            "enum": ["strong", "moderate", "weak"]
          }
        },
        "required": ["description", "source_entities", "target_entities"]
      }
    },
    
  },
  "required": ["list_of_entities", "relations", "section_description"]
}"""
SUMMARY_INTRODUCTION = "Below is an summary and excerpt from an article."
PART_INTRODUCTION = "Below is an part of larger text."
TASK = "Your task is to extract information about entities and relations to the JSON format"
SUMMARY_HEADING = "### General Text Summary:"
PART_HEADING = "### Text Part to Extract From:"
ANSWER_HEADING = "### Extracted Relations:"

# Format name -> (introduction, schema shown?, where the summary goes), in export order.
PROMPT_FORMATS: dict[str, tuple[str, bool, str]] = {
    "prompt_with_summary_and_schema": (SUMMARY_INTRODUCTION, True, "own heading"),
    "prompt_with_summary": (SUMMARY_INTRODUCTION, False, "own heading"),
    "prompt_with_merged_text": (PART_INTRODUCTION, False, "above the part"),
    "prompt_with_merged_text_with_schema": (PART_INTRODUCTION, True, "above the part"),
    "prompt_no_summary_with_schema": (PART_INTRODUCTION, True, "absent"),
    "prompt_no_summary": (PART_INTRODUCTION, False, "absent"),
}


def render_template(template: str, **fields: Column) -> Column:
    """Fill ``{name}`` places with columns; ``{{`` and ``}}`` are literal braces."""
    pieces: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(fields[name])
    return F.concat(*pieces)


def fit_prompt(
    df: DataFrame,
    template: str,
    fields: dict[str, str],
    tokenizer,
    budget: int = 2048,
    keep: int = 1536,
    out: str = "prompt",
) -> DataFrame:
    """Render a prompt per row; one that is over ``budget`` tokens is rendered again from the first
    ``keep`` tokens of every field. The second prompt is not measured again.

    Adds ``prompt_tokens`` (of the full prompt) and ``out``. ``fields`` maps template names to columns.
    """
    full = df.withColumn("_full", render_template(template, **{k: F.col(c) for k, c in fields.items()}))
    counted = full.withColumn("prompt_tokens", tokenizer.count(F.col("_full")))
    cut = render_template(template, **{k: tokenizer.head(F.col(c), keep) for k, c in fields.items()})
    return counted.withColumn(out, F.when(F.col("prompt_tokens") > budget, cut).otherwise(F.col("_full"))).drop(
        "_full"
    )


def training_prompt(name: str, summary: Column, part: Column, answer: Column) -> Column:
    """One of the six fine-tuning formats."""
    introduction, with_schema, summary_place = PROMPT_FORMATS[name]
    if with_schema:
        head = f"{introduction} {TASK} as follows:\n```json-schema\n{ANSWER_SCHEMA}\n```\n"
    else:
        head = f"{introduction} {TASK}.\n"
    if summary_place == "own heading":
        body = [F.lit(f"{head}{SUMMARY_HEADING}\n"), summary, F.lit(f"\n{PART_HEADING}\n"), part]
    elif summary_place == "above the part":
        body = [F.lit(f"{head}{PART_HEADING}\n"), summary, F.lit("\n"), part]
    else:
        body = [F.lit(f"{head}{PART_HEADING}\n"), part]
    return F.concat(*body, F.lit(f"\n{ANSWER_HEADING}\n"), answer)
