"""Carrying forward: rows of codes that left a release."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetables.functions.rows import COLUMNS, status_rows
from codetables.functions.scalars import HISTORY, code_iri, code_of, replacements_from_history, table_row_name
from codetables.operators.relations import system_of


def codes_named(rows: DataFrame) -> DataFrame:
    """(code): all codes that rows name: sources and targets of mappings, the subjects of other forms."""
    mapping = F.col("form").isin("mapping", "member")
    named = F.when(mapping, F.array("subject_id", "object_id")).otherwise(F.array(F.coalesce("subject", "variation")))
    return rows.select(F.explode(named).alias("code")).where("code is not null").distinct()


def subject_of() -> Column:
    return F.coalesce("subject_id", "subject", "variation")


def carry_forward(built: DataFrame, current: DataFrame, series: list[str], registry: DataFrame) -> DataFrame:
    """The current rows of carrying series whose subject no built row names and that lies in a registered space."""
    own = current.where(F.col("series").isin(series)).withColumn("code", subject_of()).where("code is not null")
    left = own.join(codes_named(built), "code", "left_anti")
    return system_of(left, "code", registry).where("system is not null").select(*COLUMNS)


def carry_status(built: DataFrame, carried: DataFrame, status: DataFrame, registry: DataFrame, system: str) -> tuple[DataFrame, DataFrame]:
    """Status rows of codes that aren't named any more, and the codes to look up: carried and not yet retired."""
    named = codes_named(built).withColumnRenamed("code", "subject")
    kept = system_of(status.join(named, "subject", "left_anti"), "subject", registry).where("system is not null").select(*COLUMNS)
    subjects = carried.select(subject_of().alias("subject")).distinct().join(status.select("subject"), "subject", "left_anti")
    codes = subjects.select(code_of(system, "subject").alias("code")).where("code is not null").distinct().orderBy("code")
    return kept, codes


def rekey_carried(rows: DataFrame, property_iri: str) -> DataFrame:
    """Carried mapping rows take their kind's present property, and so a new key."""
    sequence = F.when(F.col("form") == "member", F.col("sequence"))
    named = F.when(
        sequence.isNull(), table_row_name("subject_id", F.lit(property_iri), "object_id")
    ).otherwise(table_row_name("subject_id", F.lit(property_iri), "object_id", "sequence"))
    old = F.col("form").isin("mapping", "member") & (F.col("predicate_id") != property_iri)
    return rows.withColumns({"key": F.when(old, named).otherwise(F.col("key")), "predicate_id": F.when(old, F.lit(property_iri)).otherwise(F.col("predicate_id"))})


def apply_history(answers: DataFrame, series: str, system: str) -> tuple[DataFrame, DataFrame]:
    """Status rows from history answers (value: JSON), and violations: a status that isn't mapped."""
    parsed = answers.select(F.from_json("value", HISTORY).alias("p"))
    got = replacements_from_history("p")
    out = parsed.select(F.col("p.code").alias("code"), *[c.alias(k) for k, c in got.items()])
    wrong = out.where("retired is null").select(F.col("code").alias("key"), F.concat(F.lit("has the unknown status "), F.coalesce("status", F.lit("null"))).alias("message"))
    good = out.where("retired").select(code_iri(system, "code").alias("subject"), F.transform("replaced_by", lambda c: code_iri(system, c)).alias("replaced"))
    return status_rows(good, series, "subject", "replaced"), wrong


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
