"""The repair job: raw answers in, accepted / rejected / unfit documents out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import answers as A
from corpusloom.functions import documents as D
from corpusloom.operators.rows import exploded, settle

ACCEPTED, REJECTED, UNFIT = "accepted", "rejected", "unfit"


def rename_keys(facts_text: Column, aliases: dict[str, str]) -> Column:
    """Spell known misspelt keys the expected way before parsing."""
    return A.replace_in_order(facts_text, tuple((f'"{bad}":', f'"{good}":') for bad, good in aliases.items()))


def parse_stages(
    df: DataFrame, text: str = "repaired_text", fit: str = "fit", strict_key_order: bool = True
) -> DataFrame:
    """Parse repaired text and unify it: adds ``reject_reason`` (NULL if accepted), ``document``."""
    c = F.col
    kept = df.columns
    # Of a repeated JSON key the last one counts.
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    steps: tuple[tuple[str, Column], ...] = (
        ("_parsed", F.when(c(fit), F.try_parse_json(c(text)))),
        ("_description", F.try_variant_get(c("_parsed"), "$.description", "variant")),
        ("_entities", D.variant_list(c("_parsed"), "$.list_of_entities")),
        ("_relations", D.variant_list(c("_parsed"), "$.relations")),
        ("_description", F.when(D._is_text(c("_description")), F.try_variant_get(c("_description"), "$", "string"))),
        ("_facts", D.relation_facts(c("_relations"), D.relation_texts(c(text)), D.descriptions_open(c(text)))),
        ("_own", D.own_relations(c("_facts"))),
        ("_merged", D.merge_relations(c("_own"))),
        ("_listed", F.transform(c("_entities"), lambda name: F.try_variant_get(name, "$", "string"))),
        ("_closed", D.close_entities(c("_listed"), c("_merged"))),
        ("_checked", D.described(c("_facts"))),
    )
    for name, value in steps:
        df = df.withColumn(name, value)

    def every(rows: str, test) -> Column:
        return F.forall(c(rows), test)

    reasons: list[tuple[str, Column]] = [
        ("invalid_json", c("_parsed").isNull()),
        ("description_not_text", c("_description").isNull()),
        ("entities_not_a_list", c("_entities").isNull()),
        ("relations_not_a_list", c("_relations").isNull()),
        ("entity_not_text", ~every("_entities", D._is_text)),
        ("relation_not_object", ~every("_facts", lambda r: r["object"])),
    ]
    if strict_key_order:
        reasons.append(("description_not_first", ~every("_checked", lambda r: r["first"])))
    reasons += [
        ("relation_description_not_text", ~every("_checked", lambda r: r["description"].isNotNull())),
        ("non_string_endpoint", ~every("_checked", lambda r: r["clean"])),
        ("strength_not_scalar", ~every("_checked", lambda r: r["plain"])),
        ("no_entities", F.size("_closed") == 0),
        ("no_relations", F.size("_merged") == 0),
    ]
    reason = F.when(~c(fit), F.lit(UNFIT))
    for label, failed in reasons:
        reason = reason.when(failed, F.lit(label))
    judged = df.withColumn("reject_reason", reason)
    document = F.struct(
        c("_closed").alias("list_of_entities"),
        c("_merged").alias("relations"),
        c("_description").alias("section_description"),
    )
    return judged.select(*kept, "reject_reason", F.when(c("reject_reason").isNull(), document).alias("document"))


def repair_answers(
    df: DataFrame,
    answer: str = "part_topics",
    strict_key_order: bool = True,
    quoted_names: Sequence[str] = A.QUOTED_NAMES,
    key_aliases: dict[str, str] | None = None,
) -> DataFrame:
    """Repair, parse, validate and unify every answer in one pass, without a shuffle.

    Returns the columns of ``df`` with ``repaired_text``, ``status`` (accepted, rejected or unfit),
    ``reject_reason`` and ``document`` (NULL unless accepted).
    """
    repaired = A.repair_stages(df, answer, quoted_names).select(*df.columns, "fit", "repaired_text")
    if key_aliases:
        repaired = repaired.withColumn("repaired_text", rename_keys(F.col("repaired_text"), key_aliases))
    parsed = parse_stages(repaired, strict_key_order=strict_key_order)
    status = (
        F.when(F.col("reject_reason").isNull(), ACCEPTED)
        .when(F.col("reject_reason") == UNFIT, UNFIT)
        .otherwise(REJECTED)
    )
    return settle(
        parsed.select(*df.columns, "repaired_text", status.alias("status"), "reject_reason", "document"), given=df.columns
    )


def accepted(repaired: DataFrame) -> DataFrame:
    return repaired.where(F.col("status") == ACCEPTED)


def repair_report(repaired: DataFrame) -> DataFrame:
    """One row: tested, correct, unfit, and the two ratios (NULL instead of a division by zero)."""
    tested = F.count("*")
    correct = F.count_if(F.col("status") == ACCEPTED)
    unfit = F.count_if(F.col("status") == UNFIT)
    return repaired.agg(
        tested.alias("tested"),
        correct.alias("correct"),
        unfit.alias("unfit"),
        F.try_divide(correct, tested - unfit).alias("achievable"),
        F.try_divide(correct, tested).alias("all"),
    )


def relation_rows(df: DataFrame, *keys: str, text: str = "repaired_text", fit: str = "fit") -> DataFrame:
    """One row per relation as the model gave it, before merging, of every answer that parses."""
    parsed = df.select(*keys, text, F.when(F.col(fit), F.try_parse_json(text)).alias("_parsed"))
    relations = D.variant_list(F.col("_parsed"), "$.relations")
    found = D.relation_facts(relations, D.relation_texts(F.col(text)), D.descriptions_open(F.col(text)))
    facts = parsed.select(*keys, found.alias("_facts"))
    rows = exploded(facts, list(keys), "_facts", "relation_no", "_fact")
    return rows.select(*keys, "relation_no", "_fact.*")


def exploded_relations(repaired: DataFrame, *keys: str) -> DataFrame:
    """One row per relation of every accepted document."""
    rows = exploded(accepted(repaired), list(keys), "document.relations", "relation_no", "relation")
    return rows.select(*keys, "relation_no", "relation.*")
