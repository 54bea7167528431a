"""Checks of rows, versions and declarations. Each gives violations as a table (series, key, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetables.functions.rows import FORMS
from codetables.operators.summaries import unique_across_rows
from codetables.operators.versions import diff

# Fixed value: the form of an address. White space is listed (\s means the same), since a class of single characters is
# looked up in a table.
IRI = r"^[a-z][a-z0-9+.-]*:[^ \t\n\x0B\f\r<>\"{}|\\^`]+$"
_IRIS = {"subject_id", "predicate_id", "object_id", "mapping_justification", "subject", "variation", "reviewStatus"}
_IRI_LISTS = {"replacedBy", "hgvs", "classification"}
_REQUIRED = {
    "mapping": ["subject_id", "predicate_id", "object_id", "mapping_justification"],
    "member": ["subject_id", "predicate_id", "object_id", "mapping_justification", "sequence"],
    "names": ["subject", "prefLabel", "notation"],
    "status": ["subject"],
    "termType": ["subject", "termType"],
    "classification": ["variation"],
}


def check_row_schema(rows: DataFrame) -> DataFrame:
    """One boolean expression for each rule of each form; a linear pass in which a row meets the rules of its own form."""
    by: dict[str, list[tuple[Column, str]]] = {}
    for form, columns in FORMS.items():
        rules = by[form] = [(F.col(c).isNull(), f"{c} is missing") for c in _REQUIRED[form]]
        for c in columns:
            if c in _IRIS:
                rules.append((F.col(c).isNotNull() & ~F.col(c).rlike(IRI), f"{c} is no address"))
            elif c in _IRI_LISTS:
                rules.append((F.exists(c, lambda x: ~x.rlike(IRI)), f"{c} holds what is no address"))
            elif c in ("prefLabel", "notation", "termType", "required"):
                rules.append((F.col(c) == "", f"{c} is empty"))
    by["mapping"].append((~F.col("mapping_cardinality").isin("1:1", "1:n", "n:1", "n:n"), "mapping_cardinality is none of 1:1, 1:n, n:1, n:n"))
    by["classification"] += [
        (F.size("hgvs") == 0, "hgvs is an empty list"),
        (F.size("classification") == 0, "classification is an empty list"),
        (F.col("contributingSubmitterCount").isNotNull() & F.col("submitterCount").isNotNull(), "has both counts"),
        ((F.col("contributingSubmitterCount") < 0) | (F.col("submitterCount") < 0), "has a negative count"),
        (F.coalesce(*[F.col(c).cast("string") for c in FORMS["classification"][1:]]).isNull(), "says nothing"),
    ]
    found, may = F.when(F.lit(False), F.array().cast("array<string>")), F.when(F.lit(False), F.lit(False))
    # A lambda is not compiled, nor is what stands beside it: a list that is there may break a rule.
    lists = {f"{c} holds what is no address": F.col(c).isNotNull() for c in _IRI_LISTS}
    for form, rules in by.items():
        found = found.when(F.col("form") == form, _broken(rules))
        may = may.when(F.col("form") == form, reduce(Column.__or__, [F.coalesce(lists.get(m, c), F.lit(False)) for c, m in rules]))
    # Messages are made of the rows that may break a rule, and of no others.
    return _said(rows.where(may), found, "key", "series")


def _broken(rules: list[tuple[Column, str]]) -> Column:
    """The messages of the rules that a row breaks."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in rules]), lambda m: m.isNotNull())


def _said(df: DataFrame, found: Column, key: str, series: str | None) -> DataFrame:
    head = F.col(series) if series else F.lit(None).cast("string")
    # Of an inner explode Spark infers filters, which would evaluate all rules twice more.
    return df.select(head.alias("series"), F.col(key).cast("string").alias("key"), F.explode_outer(found).alias("message")).where("message is not null")


def violations(df: DataFrame, rules: list[tuple[Column, str]], key: str = "key", series: str | None = "series") -> DataFrame:
    """(series, key, message) for each rule that a row breaks."""
    return _said(df, _broken(rules), key, series)


def check_constraints(
    rows: DataFrame,
    predicate: str | None = None,
    term_types: list[str] | None = None,
    hgvs_form: str | None = None,
    schemes: dict[str, DataFrame] | None = None,
    unique: str | None = None,
) -> DataFrame:
    """A kind's constraints: its fixed property, other names unlike the preferred one, allowed term types, the form of
    expressions, concepts of their schemes (column: table of concepts), and a column whose values are on one row only."""
    rules = [(F.array_contains("altLabel", F.col("prefLabel")), "altLabel repeats prefLabel")]
    if predicate:
        rules.append((F.col("predicate_id") != predicate, f"predicate_id is not {predicate}"))
    if term_types:
        rules.append((~F.col("termType").isin(term_types), f"termType is none of {', '.join(term_types)}"))
    if hgvs_form:
        rules.append((F.exists("hgvs", lambda x: ~x.rlike(hgvs_form)), "hgvs is of another form"))
    parts = [violations(rows, rules)]
    for column, concepts in (schemes or {}).items():
        each = rows.select("series", "key", F.explode(column).alias("c")) if column in ("classification", "hgvs") else rows.select("series", "key", F.col(column).alias("c")).where("c is not null")
        foreign = each.join(concepts.select(F.col(concepts.columns[0]).alias("c")), "c", "left_anti")
        parts.append(foreign.select("series", "key", F.concat(F.lit(f"{column} is no concept of its scheme: "), "c").alias("message")))
    if unique:
        each = rows.select("key", F.explode(unique).alias("value")) if dict(rows.dtypes)[unique].startswith("array") else rows.select("key", F.col(unique).alias("value"))
        parts.append(unique_across_rows(each, "value", "key").select(F.lit(None).cast("string").alias("series"), "key", "message"))
    return reduce(DataFrame.unionByName, parts)


def check_catalog(series: DataFrame, versions: DataFrame, inputs: DataFrame, version_inputs: DataFrame) -> DataFrame:
    """Cardinalities, patterns and references of the catalog."""

    def missing(df: DataFrame, column: str, dim: DataFrame, key: str, what: str) -> DataFrame:
        named = df.select(F.lit(None).cast("string").alias("series"), F.col(column).alias("key")).where("key is not null")
        return named.join(dim.select(F.col(key).alias("key")), "key", "left_anti").select("series", "key", F.lit(what).alias("message"))

    def twice(df: DataFrame, column: str, what: str) -> DataFrame:
        return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(None).cast("string").alias("series"), F.col(column).alias("key"), F.lit(what).alias("message"))

    name = r"^ni:///sha-256;[A-Za-z0-9_-]{43}$"
    parts = [
        violations(versions, [(~F.col("iri").rlike(name), "is no version name"), (F.col("iri") == F.col("revises"), "revises itself"), (F.col("label").isNull(), "has no label"), (F.col("issued").isNull(), "has no time of issue")], key="iri"),
        violations(series, [(~F.col("iri").rlike("^urn:uuid:"), "is no series name"), (F.col("label").isNull(), "has no label")], key="iri", series=None),
        violations(inputs, [(~F.col("checksum").rlike("^[0-9a-f]{64}$"), "has no SHA-256 checksum"), (F.col("title").isNull(), "has no title")], key="iri", series=None),
        twice(series, "iri", "is there twice"),
        twice(versions, "iri", "is there twice"),
        twice(versions.where("revises is not null"), "revises", "is revised twice"),
        missing(versions, "series", series, "iri", "is a series that isn't there"),
        missing(versions, "revises", versions, "iri", "is a version that isn't there"),
        missing(series, "current_version", versions, "iri", "is a version that isn't there"),
        missing(version_inputs, "input", inputs, "iri", "is an input that isn't there"),
    ]
    return reduce(DataFrame.unionByName, parts)


def check_sources(sources: DataFrame, source_series: DataFrame, licences: DataFrame) -> DataFrame:
    """Declarations: a licence whose policy publishes, one detection method, one label and kind for each series, no
    carrying status series, and for a history lookup one status and at least one carrying series."""
    free = licences.where("publishes").select("licence")
    parts = [
        sources.join(free, "licence", "left_anti").select(F.lit(None).cast("string").alias("series"), F.col("source").alias("key"), F.lit("has no licence that publishes").alias("message")),
        violations(sources, [(F.size(F.array_compact(F.coalesce("methods", F.array().cast("array<string>")))) != 1, "has not one detection method")], key="source", series=None),
        violations(source_series, [(F.col("label").isNull(), "has no label"), (F.col("kind").isNull(), "has no kind"), (F.col("carries") & F.col("kind").endswith("RetiredCodes"), "is a status series that carries")], key="iri", series=None),
    ]
    counted = source_series.groupBy("source").agg(F.count(F.when(F.col("kind").endswith("RetiredCodes"), 1)).alias("status"), F.count(F.when(F.col("carries"), 1)).alias("carrying"))
    lookup = sources.where("history_lookup").join(counted, "source", "left").where("status is null or status <> 1 or carrying = 0")
    parts.append(lookup.select(F.lit(None).cast("string").alias("series"), F.col("source").alias("key"), F.lit("looks up a history without one status and one carrying series").alias("message")))
    return reduce(DataFrame.unionByName, parts)


def check_checks(checks: DataFrame) -> DataFrame:
    """A reason is there exactly when nothing was checked; sources and checksums have their forms."""
    sums = F.exists("inputs", lambda i: i["checksum"].isNotNull() & ~i["checksum"].rlike("^[0-9a-f]{64}$"))
    return violations(checks, [((F.col("found") == "not checked") != F.col("reason").isNotNull(), "has a reason or lacks one"), (~F.col("source").rlike("^[a-z0-9-]+$"), "is no source name"), (F.col("at").isNull(), "has no time"), (sums, "has a checksum of another form")], key="source", series=None)


def assert_same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """What differs between the rows (with content) of two builds; empty if nothing does."""
    return diff(a, b)


def declared_series_only(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Violations: rows of series that the source doesn't declare."""
    foreign = rows.select("series").distinct().join(declared.select(F.col("iri").alias("series")), "series", "left_anti")
    return foreign.select("series", F.lit(None).cast("string").alias("key"), F.lit("is not declared by the source").alias("message"))
