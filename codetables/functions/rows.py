"""Row forms: projections, their triples, contents and merging.

A rows DataFrame is wide: series, key, form and the form's columns. Its triples are a long table (series, key, predicate,
object, kind) with kind `iri`, or the datatype of a literal (null: a plain text). Lists that are null or empty give the
same triples, so rows are compared by the hash of their sorted triple lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetables.functions.scalars import literal_text, table_row_name
from codetables.sources.shared import written

# Vocabularies.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
OWL = "http://www.w3.org/2002/07/owl#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
SSSOM = "https://w3id.org/sssom/"
DCT = "http://purl.org/dc/terms/"
XSD = "http://www.w3.org/2001/XMLSchema#"
PROV = "http://www.w3.org/ns/prov#"
VOCABULARY = "https://ns.cascadeprotocol.org/cascade#"
CURATED = "https://w3id.org/semapv/vocab/ManualMappingCuration"
CHAINED = "https://w3id.org/semapv/vocab/MappingChaining"
MEMBER_OF = "http://purl.obolibrary.org/obo/RO_0002350"
HAS_MEMBER = "http://purl.obolibrary.org/obo/RO_0002351"

#: The columns of all forms together.
COLUMNS = {
    "series": "string", "key": "string", "form": "string", "subject_id": "string", "predicate_id": "string",
    "object_id": "string", "mapping_justification": "string", "mapping_cardinality": "string", "sequence": "long",
    "required": "string", "subject": "string", "prefLabel": "string", "altLabel": "array<string>", "notation": "string",
    "replacedBy": "array<string>", "termType": "string", "variation": "string", "hgvs": "array<string>",
    "classification": "array<string>", "reviewStatus": "string", "lastEvaluated": "string",
    "contributingSubmitterCount": "long", "submitterCount": "long",
}
FORMS = {
    "mapping": ["subject_id", "predicate_id", "object_id", "mapping_justification", "mapping_cardinality"],
    "member": ["subject_id", "predicate_id", "object_id", "mapping_justification", "sequence", "required"],
    "names": ["subject", "prefLabel", "altLabel", "notation"],
    "status": ["subject", "replacedBy"],
    "termType": ["subject", "termType"],
    "classification": ["variation", "hgvs", "classification", "reviewStatus", "lastEvaluated", "contributingSubmitterCount", "submitterCount"],
}
#: The predicate and kind of each column, by form.
_MAPPING = [
    ("subject_id", OWL + "annotatedSource", "iri"),
    ("predicate_id", OWL + "annotatedProperty", "iri"),
    ("object_id", OWL + "annotatedTarget", "iri"),
    ("mapping_justification", SSSOM + "mapping_justification", "iri"),
    ("mapping_cardinality", SSSOM + "mapping_cardinality", None),
    ("sequence", VOCABULARY + "panelSequence", XSD + "integer"),
    ("required", VOCABULARY + "observationRequiredInPanel", None),
]
PREDICATES = {
    "mapping": _MAPPING,
    "member": _MAPPING,
    "names": [("prefLabel", SKOS + "prefLabel", None), ("altLabel", SKOS + "altLabel", None), ("notation", SKOS + "notation", None)],
    "status": [("replacedBy", DCT + "isReplacedBy", "iri")],
    "termType": [("termType", VOCABULARY + "termType", None)],
    "classification": [
        ("hgvs", VOCABULARY + "hgvsExpression", "iri"),
        ("classification", VOCABULARY + "clinvarClassification", "iri"),
        ("reviewStatus", VOCABULARY + "clinvarReviewStatus", "iri"),
        ("lastEvaluated", VOCABULARY + "lastEvaluated", XSD + "date"),
        ("contributingSubmitterCount", VOCABULARY + "contributingSubmitterCount", XSD + "integer"),
        ("submitterCount", VOCABULARY + "submitterCount", XSD + "integer"),
    ],
}

#: What each form says of every row.
_FIXED = {"mapping": (RDF + "type", OWL + "Axiom", "iri"), "member": (RDF + "type", OWL + "Axiom", "iri"), "status": (OWL + "deprecated", "true", XSD + "boolean")}


def rows_of(df: DataFrame, form: str, series: str | Column, **columns: str | Column) -> DataFrame:
    """The form's rows, with columns given by name or expression; the others are null."""
    named = {k: F.col(v) if isinstance(v, str) else v for k, v in columns.items()}
    value = lambda c: named.get(c, F.lit(None)).cast(COLUMNS[c])
    if form in ("mapping", "member"):
        key = table_row_name(value("subject_id"), value("predicate_id"), value("object_id"), value("sequence") if form == "member" else None)
    else:
        key = value("variation" if form == "classification" else "subject")
    heads = {"series": F.lit(series) if isinstance(series, str) else series, "key": key, "form": F.lit(form)}
    return df.select(*[(heads[c] if c in heads else value(c)).cast(kind).alias(c) for c, kind in COLUMNS.items()])


def names_rows(df: DataFrame, series, subject, pref_label, alt_label, notation) -> DataFrame:
    return rows_of(df, "names", series, subject=subject, prefLabel=pref_label, altLabel=alt_label, notation=notation)


def mapping_rows(df: DataFrame, series, subject_id, predicate_id, object_id, justification=CURATED, cardinality=None) -> DataFrame:
    return _mapping(df, "mapping", series, subject_id, predicate_id, object_id, justification, mapping_cardinality=cardinality)


def member_rows(df: DataFrame, series, subject_id, predicate_id, object_id, sequence, required=None, justification=CURATED) -> DataFrame:
    return _mapping(df, "member", series, subject_id, predicate_id, object_id, justification, sequence=sequence, required=required)


def _mapping(df, form, series, subject_id, predicate_id, object_id, justification, **more) -> DataFrame:
    fixed = lambda x: F.lit(x) if isinstance(x, str) and ":" in x else x  # noqa: E731  an address is a value, not a column
    given = {k: v for k, v in more.items() if v is not None}
    return rows_of(df, form, series, subject_id=subject_id, predicate_id=fixed(predicate_id), object_id=object_id, mapping_justification=fixed(justification), **given)


def status_rows(df: DataFrame, series, subject, replaced_by=None) -> DataFrame:
    return rows_of(df, "status", series, subject=subject, **({} if replaced_by is None else {"replacedBy": replaced_by}))


def term_type_rows(df: DataFrame, series, subject, term_type) -> DataFrame:
    return rows_of(df, "termType", series, subject=subject, termType=term_type)


def classification_rows(df: DataFrame, series, variation, **columns) -> DataFrame:
    return rows_of(df, "classification", series, variation=variation, **columns)


def _statements(form: str) -> Column:
    """All statements of a row as an array of (predicate, object, kind), those without an object left out."""

    def one(predicate: str, value: Column, kind: str | None) -> Column:
        return F.struct(F.lit(predicate).alias("predicate"), value.cast("string").alias("object"), F.lit(kind).cast("string").alias("kind"))

    def each(predicate: str, kind: str | None):
        return lambda v: one(predicate, v, kind)

    parts = []
    if form in _FIXED:
        predicate, value, kind = _FIXED[form]
        parts.append(F.array(one(predicate, F.lit(value), kind)))
    for column, predicate, kind in PREDICATES[form]:
        if COLUMNS[column].startswith("array"):
            none = F.array().cast("array<string>")
            parts.append(F.transform(F.coalesce(F.col(column), none), each(predicate, kind)))
        else:
            parts.append(F.array(one(predicate, F.col(column), kind)))
    return F.filter(F.concat(*parts), lambda s: s["object"].isNotNull())


def statements() -> Column:
    out = F.lit(None)
    for form in FORMS:
        out = F.when(F.col("form") == form, _statements(form)) if form == "mapping" else out.when(F.col("form") == form, _statements(form))
    return out


def to_triples(rows: DataFrame) -> DataFrame:
    return rows.select("series", "key", "form", F.explode(statements()).alias("s")).select("series", "key", "form", "s.*")


def line_of(key: Column, s: Column) -> Column:
    """A statement as an N-Triples line."""
    text = F.concat(F.lit('"'), literal_text(s["object"]), F.lit('"'))
    value = F.when(s["kind"] == "iri", F.concat(F.lit("<"), s["object"], F.lit(">"))).when(s["kind"].isNull(), text).otherwise(F.concat(text, F.lit("^^<"), s["kind"], F.lit(">")))
    return F.concat(F.lit("<"), key, F.lit("> <"), s["predicate"], F.lit("> "), value, F.lit(" ."))


def row_lines() -> Column:
    """A row's lines, each once, in order."""
    return F.array_sort(F.array_distinct(F.transform(statements(), lambda s: line_of(F.col("key"), s))))


def _joined_lines(form: str) -> Column:
    """The same lines joined by line ends. A row's lines differ in their predicates first, so their order is known and
    only the values of a list are sorted: an expression of built-in functions without lambdas for all other columns."""

    def line(predicate: str, value: Column, kind: str | None) -> Column:
        before = F.concat(F.lit("<"), F.col("key"), F.lit(f"> <{predicate}> "))
        text = value.cast("string")
        if kind == "iri":
            return F.concat(before, F.lit("<"), text, F.lit("> ."))
        return F.concat(before, F.lit('"'), literal_text(text), F.lit('" .' if kind is None else f'"^^<{kind}> .'))

    def lines(predicate: str, column: str, kind: str | None) -> Column:
        if COLUMNS[column].startswith("array"):
            each = F.transform(column, lambda v: line(predicate, v, kind))
            return F.when(F.size(column) > 0, F.array_join(F.array_sort(F.array_distinct(F.array_compact(each))), "\n"))
        return line(predicate, F.col(column), kind)

    parts = {predicate: lines(predicate, column, kind) for column, predicate, kind in PREDICATES[form]}
    if form in _FIXED:
        predicate, value, kind = _FIXED[form]
        parts[predicate] = line(predicate, F.lit(value), kind)
    # A list of nothing but nulls has no line.
    return F.concat_ws("\n", *[F.nullif(parts[p], F.lit("")) for p in sorted(parts, key=lambda p: f"{p}> ".encode())])


def row_content() -> Column:
    """The hash of a row's sorted lines; no shuffle is needed for it."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for form in FORMS:
        out = out.when(F.col("form") == form, F.sha2(_joined_lines(form), 256))
    return out


def from_triples(triples: DataFrame) -> DataFrame:
    """Triples to wide rows; the form is told by the predicates."""
    by: dict[str, list[tuple[str, str]]] = {}
    for form, columns in PREDICATES.items():
        for column, predicate, _ in columns:
            if (column, COLUMNS[column]) not in by.setdefault(predicate, []):
                by[predicate].append((column, COLUMNS[column]))
    aggs = []
    for predicate, columns in by.items():
        for column, kind in columns:
            value = F.when(F.col("predicate") == predicate, F.col("object"))
            aggs.append(F.when(F.count(value) > 0, F.array_sort(F.collect_set(value))).alias(column) if kind.startswith("array") else F.max(value).cast(kind).alias(column))
    has = lambda p: F.max(F.when(F.col("predicate") == p, 1))
    form = (
        F.when(has(VOCABULARY + "panelSequence") == 1, "member").when(has(OWL + "annotatedSource") == 1, "mapping").when(has(SKOS + "prefLabel") == 1, "names")
        .when(has(OWL + "deprecated") == 1, "status").when(has(VOCABULARY + "termType") == 1, "termType").otherwise("classification")
    )
    found = triples.groupBy("series", "key").agg(form.alias("form"), *aggs)
    key_of = {"subject": ["names", "status", "termType"], "variation": ["classification"]}
    for column, forms in key_of.items():
        found = found.withColumn(column, F.when(F.col("form").isin(forms), F.col("key")))
    return found.select(*[F.col(c).cast(kind).alias(c) for c, kind in COLUMNS.items()])


#: Keys of several rows that are broadcast at most, to fetch those rows; more of them are joined.
MAX_BROADCAST_KEYS = 200_000


def merge_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal rows merged, and what can't be: keys with different contents, series of two forms; mapping and member count
    as one form. Rows are counted by hashes of their keys alone, which are all that is shuffled of most of them; the rows
    whose hash occurs several times are then told apart by their keys."""
    hashed = rows if "content" in rows.columns else rows.withColumn("content", row_content())
    kind = F.when(F.col("form") == "member", "mapping").otherwise(F.col("form"))
    names = [c for c in COLUMNS if c not in ("series", "key")]
    ordered = [*COLUMNS, "content"]
    hashed = hashed.select(*ordered, F.xxhash64("series", "key").alias("_hash"))
    often = written(hashed.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1").select("_hash"), "double-keys")
    often = F.broadcast(often) if often.count() <= MAX_BROADCAST_KEYS else often
    # A row without a series or a key is no other's double.
    named = F.col("series").isNotNull() & F.col("key").isNotNull()
    close = hashed.join(often, "_hash", "left_semi")
    several = close.where(named).groupBy("series", "key").agg(F.min_by(F.struct(*names, "content"), "content").alias("r")).select("series", "key", "r.*")
    merged = hashed.join(often, "_hash", "left_anti").select(*ordered).unionByName(close.where(~named).select(*ordered)).unionByName(several.select(*ordered))
    per = close.groupBy("series", "key").agg(F.min("content").alias("least"), F.max("content").alias("most"))
    differ = per.where("least <> most").select("series", "key", F.lit("a row of the same key has other content").alias("message"))
    # Counted, since a distinct before min and max is left out, and all rows are sorted for those of texts.
    kinds = rows.groupBy("series", kind.alias("kind")).agg(F.count("*").alias("n")).where("n > 0")
    forms = kinds.groupBy("series").agg(F.min("kind").alias("a"), F.max("kind").alias("b")).where("a <> b")
    mixed = forms.select("series", F.lit(None).cast("string").alias("key"), F.concat_ws(" ", F.lit("rows of two forms:"), "a", F.lit("and"), "b").alias("message"))
    return merged, differ.union(mixed)
