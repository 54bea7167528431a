"""Scalar expressions on codes, labels, dates and keys. All of them are built-in functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespace and rule of row names.
ROW_NAMESPACE = "90c60849-c5ef-4ca6-bfb8-8662bd07d2b5"
ROW_RULE = "https://ns.cascadeprotocol.org/cascade#TableRowNamingRule"
# Spaces of code systems.
SPACES = {
    "cvx": "https://ns.cascadeprotocol.org/codes/cvx/",
    "icd10cm": "https://ns.cascadeprotocol.org/codes/icd10cm/",
    "rxnorm": "https://ns.cascadeprotocol.org/codes/rxnorm/",
    "medrt": "https://ns.cascadeprotocol.org/codes/medrt/",
    "loinc": "https://ns.cascadeprotocol.org/codes/loinc/",
    "hgvs": "https://ns.cascadeprotocol.org/codes/hgvs/",
    "clinvar": "https://identifiers.org/clinvar:",
    "mesh": "http://id.nlm.nih.gov/mesh/",
}
# Forms of codes.
ICD = r"^[A-Z][0-9A-Z]{2}(\.[0-9A-Z]{1,4})?$"
LOINC = r"^[0-9]+-[0-9]$"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

C = str | Column


def _c(x: C) -> Column:
    return F.col(x) if isinstance(x, str) else x


def encode_for_uri(code: C) -> Column:
    """All but letters, digits and -._~ as percent escapes of their UTF-8 bytes."""
    out = F.url_encode(_c(code))
    for had, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(had), F.lit(wanted))
    return out


def code_iri(system: str, code: C) -> Column:
    """A code's address in the space of its system (a name in SPACES, or a space)."""
    return F.concat(F.lit(SPACES.get(system, system)), encode_for_uri(code))


def code_of(system: str, iri: C) -> Column:
    """The code in an address; null outside the system's space."""
    space = SPACES.get(system, system)
    rest = F.substring(_c(iri), len(space) + 1, 1 << 30)
    return F.when(F.startswith(_c(iri), F.lit(space)), F.url_decode(F.replace(rest, F.lit("+"), F.lit("%2B"))))


def dotted(code: C) -> Column:
    c = _c(code)
    return F.when(F.length(c) > 3, F.concat(F.substring(c, 1, 3), F.lit("."), F.substring(c, 4, 1 << 30))).otherwise(c)


def split_codes(cell: C, form: str = ICD) -> Column:
    """The codes in a cell, cut at commas, semicolons, & and the word and; other text names none."""
    parts = F.transform(F.split(_c(cell), r"\s*(?:,|;|&|\band\b)\s*"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p.rlike(form))


def has_form(code: C, pattern: str) -> Column:
    """False for codes of another form; a null code has none."""
    return F.coalesce(_c(code).rlike(pattern), F.lit(False))


def status_of(word: C, retired: dict[str, bool]) -> Column:
    """Whether a status word means retired; null for a word that isn't mapped."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in retired.items() for x in kv]), _c(word))


def alt_labels(preferred: C, others: C) -> Column:
    """Other names in order, each once, without the preferred one; null if there are none."""
    rest = F.array_sort(F.array_except(F.array_compact(_c(others)), F.array(_c(preferred))))
    return F.when(F.size(rest) > 0, rest)


def parse_month_day_year(text: C) -> Column:
    """`Mon DD, YYYY` as a date text YYYY-MM-DD; null for a dash or another form. The day is not checked."""
    m = [F.regexp_extract(_c(text), r"^([A-Z][a-z]{2}) (\d{2}), (\d{4})$", k) for k in (1, 2, 3)]
    month = F.element_at(F.create_map(*[F.lit(x) for k, name in enumerate(MONTHS, 1) for x in (name, f"{k:02d}")]), m[0])
    return F.when(month.isNotNull(), F.concat_ws("-", m[2], month, m[1]))


def name_expression(name: C) -> Column:
    """The expression in a variation's name: the reference sequence and its change, without the gene between."""
    pattern = r"^(NM_\d+\.\d+)(\([^)]*\))?:(c\.\S+)"
    a, b = (F.regexp_extract(_c(name), pattern, k) for k in (1, 3))
    return F.when(a != "", F.concat(a, F.lit(":"), b))


def split_terms(text: C) -> Column:
    """Terms in order, cut at `; ` and then at slashes; a lone dash is itself a term."""
    parts = F.flatten(F.transform(F.split(_c(text), "; "), lambda p: F.split(p, "/")))
    return F.filter(parts, lambda t: t != "")


def count_listed(text: C, sep: str = "|") -> Column:
    """How many ids a list names; a dash names none, a missing list is null."""
    return F.when(_c(text) == "-", F.lit(0)).otherwise(F.when(_c(text).isNotNull(), F.size(F.split(_c(text), f"\\Q{sep}\\E", -1)))).cast("long")


def is_coding_expression(iri: C) -> Column:
    """Whether an address is that of a coding expression in its normal form."""
    space = SPACES["hgvs"].replace(".", r"\.")
    return F.coalesce(_c(iri).rlike(rf"^{space}NM_[0-9]+\.[0-9]+%3Ac\.([A-Za-z0-9._~-]|%[0-9A-F]{{2}})+$"), F.lit(False))


def number_key(digits: Column) -> Column:
    """(length, digits) of a whole number without leading zeros: compares by value, whatever the length."""
    bare = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.struct(F.length(bare).alias("n"), bare.alias("digits"))


def parse_version(text: C) -> Column:
    """The leading dotted number as an array of number_key, without zeros at the end, so that arrays compare as versions do."""
    lead = F.regexp_extract(_c(text), r"^(\d+(?:\.\d+)*)", 1)
    bare = F.regexp_replace(lead, r"(?:\.0+)+$", "")
    return F.when(lead != "", F.transform(F.split(bare, r"\."), number_key))


def month_after(month: C, n: int | Column = 1) -> Column:
    return F.date_format(F.add_months(F.to_date(_c(month), "yyyy-MM"), n), "yyyy-MM")


def http_date(text: C) -> Column:
    """`Thu, 13 Aug 2026 14:25:00 GMT` as a timestamp; null if it can't be read."""
    bare = F.regexp_extract(_c(text), r"^(?:[A-Z][a-z]{2}, )?(\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2})(?: GMT)?$", 1)
    return F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss"))


def listing_time(text: C) -> Column:
    """`8/13/2026  2:25 PM` as a timestamp; null if it can't be read."""
    return F.try_to_timestamp(F.trim(F.regexp_replace(_c(text), r"\s+", " ")), F.lit("M/d/yyyy h:mm a"))


#: What is read of a status history's answer.
HISTORY = "struct<code:string,answer:struct<rxcuiStatusHistory:struct<metaData:struct<status:string>,derivedConcepts:struct<remappedConcept:array<struct<remappedRxCui:string>>,quantifiedConcept:array<struct<quantifiedRxcui:string>>>>>>"


def replacements_from_history(parsed: C) -> dict[str, Column]:
    """Of a history answer parsed by HISTORY: status, whether the code is retired (null: not mapped), its replacements."""
    base = _c(parsed)["answer"]["rxcuiStatusHistory"]
    status = base["metaData"]["status"]
    remapped = F.coalesce(base["derivedConcepts"]["remappedConcept"]["remappedRxCui"], F.array().cast("array<string>"))
    quantified = F.coalesce(base["derivedConcepts"]["quantifiedConcept"]["quantifiedRxcui"], F.array().cast("array<string>"))
    codes = F.when(status == "Remapped", remapped).when(status == "Quantified", quantified).otherwise(F.array().cast("array<string>"))
    retired = status_of(status, {"Active": False, "Remapped": True, "Quantified": True, "Obsolete": True, "NotCurrent": True})
    return {"status": status, "retired": retired, "replaced_by": F.array_sort(F.array_distinct(F.array_compact(codes)))}


def natural_sort_key(text: C) -> Column:
    """A text that sorts as people do: numbers in it by value, told by their length and then their digits."""
    parts = F.regexp_extract_all(_c(text), F.lit(r"\d+|\D+"), F.lit(0))

    def sized(t: Column) -> Column:
        key = number_key(t)
        return F.concat(F.lpad(key["n"].cast("string"), 10, "0"), key["digits"])

    return F.array_join(F.transform(parts, lambda t: F.when(t.rlike(r"^\d"), sized(t)).otherwise(t)), "")


def short_code(iri: C) -> Column:
    """An address's last part, without the prefix of its registry."""
    last = F.element_at(F.split(_c(iri), "[/#]"), -1)
    return F.regexp_replace(last, "^(clinvar|unii):", "")


def escape_markdown(label: C) -> Column:
    """A label as it reads: marks that would format it, name someone or link are escaped, white space is one space."""
    return F.regexp_replace(F.regexp_replace(_c(label), r"([\\`*_\[\]<>&|@~#])", r"\\$1"), r"\s+", " ")


def literal_text(value: C) -> Column:
    """A literal's characters with the escapes of N-Triples."""
    out = _c(value)
    for had, wanted in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(had), F.lit(wanted))
    return out


def nt_object(value: C, datatype: C | None = None, is_iri: bool = False) -> Column:
    if is_iri:
        return F.concat(F.lit("<"), _c(value), F.lit(">"))
    text = F.concat(F.lit('"'), literal_text(value), F.lit('"'))
    return text if datatype is None else F.concat(text, F.lit("^^<"), _c(datatype), F.lit(">"))


def nt_line(subject: C, predicate: C, obj: Column) -> Column:
    return F.concat(F.lit("<"), _c(subject), F.lit("> <"), _c(predicate), F.lit("> "), obj, F.lit(" ."))


def table_row_name(subject: C, predicate: C, obj: C, sequence: C | None = None) -> Column:
    """A mapping row's key: a UUID of version 8 from the SHA-256 of what it maps."""

    def safe(c: Column) -> Column:
        held = F.contains(c, F.lit("%")) | F.contains(c, F.lit("|"))
        return F.when(held, F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("|"), F.lit("%7C"))).otherwise(c)

    parts = [F.lit(f"{ROW_NAMESPACE}|{ROW_RULE}|"), safe(_c(subject)), F.lit("|"), safe(_c(predicate)), F.lit("|"), safe(_c(obj))]
    if sequence is not None:
        parts.append(F.coalesce(F.concat(F.lit("|"), _c(sequence).cast("long").cast("string")), F.lit("")))
    # Null if a part is; without a condition around its pieces, the hash is a common expression and computed once.
    h = F.sha2(F.concat(*parts), 256)
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"), F.substring(h, 14, 3),
        F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def require_fields(fields: C, n: int, code_at: int = 0) -> tuple[Column, Column]:
    """The fields without outer spaces, and what is wrong with a line of another number of them or without a code."""
    trimmed = F.transform(_c(fields), lambda f: F.trim(f))
    wrong = F.when(F.size(_c(fields)) != n, F.concat(F.lit("has "), F.size(_c(fields)).cast("string"), F.lit(f" fields, not {n}")))
    return trimmed, wrong.when(F.get(trimmed, F.lit(code_at)) == "", F.lit("has no code"))


def month_address(template: C, label: C) -> Column:
    """{month} filled from the label's year and month; null if it names none."""
    month = F.regexp_extract(_c(label), r"(\d{4}-\d{2})", 1)
    return F.when(month != "", F.replace(_c(template), F.lit("{month}"), month))
