"""Builders: publishers' releases to rows. Each takes DataFrames as the readers give them, and writes what it reads more
than once to a scratch table first, so that a release is read and cut once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetables.functions.rows import (
    VOCABULARY, CHAINED, CURATED, DCT, HAS_MEMBER, MEMBER_OF, SKOS,
    classification_rows, mapping_rows, member_rows, names_rows, status_rows, term_type_rows,
)
from codetables.functions.scalars import (
    ICD, LOINC, SPACES, alt_labels, code_iri, count_listed, dotted, is_coding_expression, name_expression,
    parse_month_day_year, require_fields, split_terms, status_of,
)
from codetables.operators import relations as R
from codetables.operators import summaries as S
from codetables.plans.build import BuildResult
from codetables.sources.shared import written


def _say(df: DataFrame, message: Column | str, key: str = "number") -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def _fields(lines: DataFrame, file: str, names: list[str], code_at: int) -> tuple[DataFrame, DataFrame]:
    """Named fields of delimited lines, and the lines that are refused."""
    trimmed, wrong = require_fields("fields", len(names), code_at)
    cut = lines.select("number", trimmed.alias("_f"), wrong.alias("_wrong"))
    cut = written(cut.select("number", "_wrong", *[F.get("_f", F.lit(k)).alias(n) for k, n in enumerate(names)]), "fields")
    bad = cut.where("_wrong is not null").select(F.col("number").cast("string").alias("key"), F.concat(F.lit(f"{file} line "), "number", F.lit(" "), "_wrong").alias("message"))
    return cut.where("_wrong is null").select("number", *names), bad


def _status(df: DataFrame, word: str, mapped: dict[str, bool], file: str) -> tuple[DataFrame, DataFrame]:
    out = df.withColumn("retired", status_of(word, mapped))
    said = F.concat(F.lit(f"{file} line "), F.col("number").cast("string"), F.lit(' has the status "'), word, F.lit('", which this builder does not map'))
    return out, _say(out.where("retired is null"), said)


def code_list(lines: DataFrame, series: dict[str, str], system: str = "cvx") -> BuildResult:
    """A delimited list: code, name, full name, group, status. series: names, groups, status."""
    df, bad = _fields(lines, "codes.txt", ["code", "name", "full_name", "group", "status"], 0)
    df, unmapped = _status(df, "status", {"Active": False, "Retired": True}, "codes.txt")
    df = df.withColumns({"iri": code_iri(system, "code"), "other": alt_labels("name", F.array("full_name"))})
    names = names_rows(df, series["names"], "iri", "name", "other", "code")
    groups = mapping_rows(df.where("group <> ''").withColumn("to", code_iri(system, "group")), series["groups"], "iri", MEMBER_OF, "to")
    return BuildResult(names.unionByName(groups).unionByName(status_rows(df.where("retired"), series["status"], "iri")), [bad, unmapped])


def vaccines(cvx: DataFrame, vg: DataFrame, series: dict[str, str]) -> BuildResult:
    """Vaccine codes: names, status and groups. series: names, status, groups."""
    codes, bad = _fields(cvx, "CVX.txt", ["code", "short", "full", "notes", "status", "nonvaccine", "updated"], 0)
    # Which status words retire a code.
    words = {"Active": False, "Inactive": False, "Non-US": False, "Never Active": True, "Pending": False}
    codes, unmapped = _status(codes, "status", words, "CVX.txt")
    codes = codes.withColumns({"iri": code_iri("cvx", "code"), "other": F.when(F.col("full") != F.col("short"), F.array("full"))})
    pairs, bad_pairs = _fields(vg, "VG.txt", ["short", "code", "status", "group_name", "group"], 1)
    no_group = _say(pairs.where(F.col("group") == ""), F.concat(F.lit("VG.txt line "), F.col("number").cast("string"), F.lit(" has no vaccine group CVX code")))
    both = pairs.select("code").union(pairs.select("group")).where("code <> ''").distinct()
    unknown = R.require_known(both, "code", codes, "code", "is named by VG.txt, but CVX.txt lacks it")
    mapped = pairs.withColumns({"from": code_iri("cvx", "code"), "to": code_iri("cvx", "group")})
    rows = names_rows(codes, series["names"], "iri", "short", "other", "code")
    rows = rows.unionByName(status_rows(codes.where("retired"), series["status"], "iri")).unionByName(mapping_rows(mapped, series["groups"], "from", MEMBER_OF, "to"))
    return BuildResult(rows, [bad, unmapped, bad_pairs, no_group, unknown])


_CUT = r"\s*(?:,|;|&|\band\b)\s*"


def diagnoses(order: DataFrame, table: DataFrame, series: dict[str, str]) -> BuildResult:
    """Diagnosis codes: names, status and conversions. order(number, code, flag, short, long), table(number, fields)."""
    codes = written(order.withColumn("code", dotted(F.trim("code"))), "codes")
    wrong = codes.where(~(F.col("code").rlike(ICD) & F.col("flag").isin("0", "1") & (F.col("long") != "")))
    bad = _say(wrong, F.concat(F.lit("icd10cm-order.txt line "), F.col("number").cast("string"), F.lit(" is not a code, its flag and its titles")))
    named = codes.withColumns({"iri": code_iri("icd10cm", "code"), "other": F.when((F.col("short") != F.col("long")) & (F.col("short") != ""), F.array("short"))})
    rows = names_rows(named, series["names"], "iri", "long", "other", "code")
    field = lambda k: F.trim(F.coalesce(F.get("fields", F.lit(k)), F.lit("")))
    cells = table.select(field(0).alias("next"), field(2).alias("cell")).where(F.col("next").rlike(ICD))
    parts = cells.select("next", F.explode(F.split("cell", _CUT)).alias("prev")).where("prev <> ''").distinct()
    parts = written(parts, "previous-codes")
    edges = parts.where(F.col("prev").rlike(ICD))
    # An edge merges if its target is given other text than its source as previous codes.
    given = parts.groupBy("next").agg(F.count("*").alias("given"))
    marked = edges.join(given, "next").withColumn("merges", F.col("given") > 1).drop("given")
    valid = named.where("flag = '1'").select("code")
    found = written(R.resolve_replacements(marked, valid), "replaced")
    retired = edges.select(F.col("prev").alias("code")).distinct().join(valid, "code", "left_anti")
    to = found.withColumns({"from_iri": code_iri("icd10cm", "code"), "to_iri": code_iri("icd10cm", "target"), "why": F.when(F.col("direct"), CURATED).otherwise(CHAINED)})
    status = retired.join(to.groupBy("code").agg(F.array_sort(F.collect_set("to_iri")).alias("ends")), "code", "left").withColumn("iri", code_iri("icd10cm", "code"))
    rows = rows.unionByName(status_rows(status, series["status"], "iri", "ends"))
    return BuildResult(rows.unionByName(mapping_rows(to, series["conversions"], "from_iri", DCT + "isReplacedBy", "to_iri", F.col("why"), F.col("cardinality"))), [bad])


# Ways from term types to ingredients, relation and type of the target one after another.
INGREDIENT_PATHS: dict[str, list[R.Path]] = {
    "SCDC": [[("has_ingredient", "IN")]],
    "SCDF": [[("has_ingredient", "IN")]],
    "SCDG": [[("has_ingredient", "IN")]],
    "BN": [[("tradename_of", "IN")]],
    "PIN": [[("form_of", "IN")]],
    "SCD": [[("consists_of", "SCDC"), ("has_ingredient", "IN")]],
    "SBD": [[("consists_of", "SCDC"), ("has_ingredient", "IN")]],
    "SBDC": [[("tradename_of", "SCDC"), ("has_ingredient", "IN")]],
    "SBDF": [[("tradename_of", "SCDF"), ("has_ingredient", "IN")]],
    "SBDG": [[("tradename_of", "SCDG"), ("has_ingredient", "IN")]],
    "SCDFP": [[("form_of", "SCDF"), ("has_ingredient", "IN")]],
    "SCDGP": [[("form_of", "SCDG"), ("has_ingredient", "IN")]],
    "SBDFP": [[("form_of", "SBDF"), ("tradename_of", "SCDF"), ("has_ingredient", "IN")]],
}
# Ways to precise ingredients.
PRECISE_PATHS: dict[str, list[R.Path]] = {
    "SCDC": [[("has_precise_ingredient", "PIN")]],
    "BN": [[("has_precise_ingredient", "PIN")]],
    "SCDFP": [[("has_boss", "PIN")]],
    "SCD": [[("consists_of", "SCDC"), ("has_precise_ingredient", "PIN")]],
    "SBD": [[("consists_of", "SCDC"), ("has_precise_ingredient", "PIN")]],
    "SBDC": [[("tradename_of", "SCDC"), ("has_precise_ingredient", "PIN")]],
    "SCDGP": [[("inverse_isa", "SCDFP"), ("has_boss", "PIN")]],
    "SBDFP": [[("tradename_of", "SCDFP"), ("has_boss", "PIN")]],
    "SBDF": [[("has_ingredient", "BN"), ("has_precise_ingredient", "PIN")]],
    "SBDG": [[("has_ingredient", "BN"), ("has_precise_ingredient", "PIN")]],
}
_ACTIVE, _BROAD, _PRECISE = "http://purl.obolibrary.org/obo/RO_0002248", SKOS + "broadMatch", VOCABULARY + "hasPreciseIngredient"


def drugs(conso: DataFrame, rels: DataFrame, series: dict[str, str]) -> BuildResult:
    """Drug codes: names, products, ingredients, brand generics. conso, rels: delimited lines (number, fields)."""
    at = lambda k: F.get("fields", F.lit(k))
    terms = conso.select("number", at(0).alias("code"), at(11).alias("sab"), at(12).alias("type"), at(14).alias("name"), at(16).alias("suppress"))
    terms = written(R.filter_equal(terms, sab="RXNORM", suppress="N"), "terms")
    other_types = ["SY", "TMSY", "PSN"]
    own = terms.where(~F.col("type").isin(other_types)).groupBy("code").agg(F.max_by(F.struct("type", "name"), "number").alias("t")).select("code", "t.*")
    others = terms.where(F.col("type").isin(other_types)).groupBy("code").agg(F.collect_set("name").alias("others"))
    rel = rels.select(at(2).alias("stype"), at(4).alias("from"), at(7).alias("relation"), at(0).alias("to"), at(10).alias("sab"))
    rel = R.filter_equal(rel, sab="RXNORM", stype="CUI").select("relation", "from", "to").distinct()
    own, rel = written(own, "own-terms"), written(rel, "relations")
    concepts = own.select("code", "type")
    iri = lambda c: code_iri("rxnorm", c)

    found = written(R.follow(concepts, rel, INGREDIENT_PATHS), "ingredients")
    counted = found.join(found.groupBy("code").agg(F.count("*").alias("n")), "code")
    single = counted.where("n = 1").select("code", "target", F.when(F.col("chained"), CHAINED).otherwise(CURATED).alias("why"))
    parts = R.hop(concepts.where("type = 'MIN'").select("code", F.col("code").alias("at")), rel, "has_part", concepts, "IN").toDF("code", "target")
    several, double = R.match_sets(counted.where("n > 1"), parts, "code", "target")
    several = several.select(F.col("key").alias("code"), F.col("match").alias("target"), F.lit(CHAINED).alias("why"))
    itself = concepts.where("type in ('IN', 'MIN')").select("code", F.col("code").alias("target"), F.lit(CURATED).alias("why"))
    active = single.union(several).union(itself).withColumn("property", F.lit(_ACTIVE))
    precise = R.follow(concepts, rel, PRECISE_PATHS).select("code", "target", F.when(F.col("chained"), CHAINED).otherwise(CURATED).alias("why")).withColumn("property", F.lit(_PRECISE))
    reached = rel.where("relation = 'has_precise_ingredient'").select(F.col("to").alias("target")).distinct()
    _, wrong = R.require_type(reached, "target", concepts, "PIN")
    pairs = conso.sparkSession.createDataFrame([("SBD", "SCD"), ("BPCK", "GPCK")], "type string, target_type string")
    generic = R.typed_targets(concepts, rel, "tradename_of", pairs)

    mapped = active.union(precise).withColumns({"a": iri("code"), "b": iri("target")})
    rows = mapping_rows(mapped, series["ingredients"], "a", F.col("property"), "b", F.col("why"))
    rows = rows.unionByName(mapping_rows(generic.withColumns({"a": iri("code"), "b": iri("target")}), series["generics"], "a", _BROAD, "b"))
    products = concepts.where(F.col("type").isin("SCD", "SBD", "GPCK", "BPCK")).withColumn("iri", iri("code"))
    rows = rows.unionByName(term_type_rows(products, series["products"], "iri", "type"))
    named = own.join(others, "code", "left").withColumns({"iri": iri("code"), "also": alt_labels("name", F.coalesce("others", F.array().cast("array<string>")))})
    return BuildResult(rows.unionByName(names_rows(named, series["names"], "iri", "name", "also", "code")), [wrong, double])


def drug_history(answers: DataFrame, series: str) -> BuildResult:
    from codetables.operators.carry import apply_history

    rows, wrong = apply_history(answers, series, "rxnorm")
    return BuildResult(rows, [wrong])


# Relations to classes and how the names of their classes end.
CLASS_RELATIONS = [
    ("has_MoA", False, "[MoA]", VOCABULARY + "mechanismOfActionClass"),
    ("has_PE", False, "[PE]", VOCABULARY + "physiologicEffectClass"),
    ("has_SC", False, "[EXT]", VOCABULARY + "chemicalStructureClass"),
    ("Parent Of", True, "[EPC]", VOCABULARY + "establishedPharmacologicClass"),
]


def drug_classes(associations: DataFrame, concepts: DataFrame, series: dict[str, str]) -> BuildResult:
    """Drug classes and their names. associations(name, from_namespace, from_name, from_code, to_namespace, to_name,
    to_code, qualifier), concepts(code, name)."""
    rules = associations.sparkSession.createDataFrame(CLASS_RELATIONS, "relation string, reversed boolean, suffix string, property string")
    said = R.filter_authority(associations).withColumnRenamed("name", "relation").join(F.broadcast(rules), "relation")
    back = F.col("reversed")
    said = said.where(~back | ((F.col("from_namespace") == "MED-RT") & (F.col("to_namespace") == "RxNorm")))
    side = lambda a, b: F.when(back, F.col(b)).otherwise(F.col(a))
    use = said.select("relation", "suffix", "property", "reversed", side("from_namespace", "to_namespace").alias("drug_space"), side("from_code", "to_code").alias("drug"), side("to_namespace", "from_namespace").alias("space"), side("to_code", "from_code").alias("class"), side("to_name", "from_name").alias("class_name"))
    mesh = (F.col("space") == "MeSH") & (F.col("relation") == "has_SC")
    why = (
        F.when(~back & ((F.col("drug_space") != "RxNorm") | (F.col("drug") == "") | (F.col("class") == "")), "of Authority FDASPL is not from an RxNorm code to a class")
        .when((F.col("space") == "MED-RT") & ~F.endswith("class_name", "suffix"), F.concat(F.lit("of Authority FDASPL is not of a "), "suffix", F.lit(" class")))
        .when(mesh & (F.col("class_name") == ""), "names no MeSH name")
        .when((F.col("space") != "MED-RT") & ~mesh, F.concat(F.lit("of Authority FDASPL goes to a "), "space", F.lit(" code")))
    )
    use = written(use.withColumn("why", why), "associations")
    bad = use.where("why is not null").select(F.concat_ws(" ", "relation", "drug", "class").alias("key"), F.col("why").alias("message"))
    good = use.where("why is null").withColumns({"a": code_iri("rxnorm", "drug"), "b": F.when(mesh, code_iri("mesh", "class")).otherwise(code_iri("medrt", "class"))})
    rows = mapping_rows(good, series["classes"], "a", F.col("property"), "b")
    mesh_names, two = R.names_for_used(good.where("space = 'MeSH'").select(F.col("class").alias("code")), good.where("space = 'MeSH'").select(F.col("class").alias("code"), F.col("class_name").alias("name")))
    first = concepts.groupBy("code").agg(F.min("name").alias("name"))
    med_names, none = R.names_for_used(good.where("space = 'MED-RT'").select(F.col("class").alias("code")), first)
    named = mesh_names.withColumn("iri", code_iri("mesh", "code")).union(med_names.withColumn("iri", code_iri("medrt", "code")))
    return BuildResult(rows.unionByName(names_rows(named, series["names"], "iri", "name", F.lit(None), "code")), [bad, two, none])


def labs(terms: DataFrame, panels: DataFrame, map_to: DataFrame, series: dict[str, str], shipped: list[str] = ("1", "2"), retired_words: dict[str, bool] | None = None) -> BuildResult:
    """Lab codes: names, status, panel members, from the columns of the publisher's three files."""
    # Which status words retire a code.
    words = retired_words or {"ACTIVE": False, "TRIAL": False, "DISCOURAGED": False, "DEPRECATED": True}
    term = terms.select(F.col("LOINC_NUM").alias("code"), F.col("CLASSTYPE").isin(list(shipped)).alias("ships"), F.col("STATUS").alias("status"), (F.col("EXTERNAL_COPYRIGHT_NOTICE") != "").alias("noticed"), F.col("LONG_COMMON_NAME").alias("name"))
    twice = term.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select(F.col("code").alias("key"), F.lit("is repeated in Loinc.csv").alias("message"))
    unknown_panel = R.require_known(panels, "ParentLoinc", terms, "LOINC_NUM", "is a panel that Loinc.csv lacks")
    parent = term.select(F.col("code").alias("ParentLoinc"), F.col("ships").alias("panel_ships"), F.col("noticed").alias("panel_noticed"))
    line = written(panels.join(parent, "ParentLoinc").where("panel_ships"), "panel-lines")
    noticed = (F.col("EXTERNAL_COPYRIGHT_NOTICE") != "") | (F.col("AdditionalCopyright") != "")
    wrong = F.when(~F.col("ParentId").rlike("^[0-9]+$"), "has a ParentId that is no number").when(~F.col("SEQUENCE").rlike("^-?[0-9]+$"), "has a SEQUENCE that is no integer").when(~F.col("Loinc").rlike(LOINC), "has a member that is no LOINC code")
    bad_line = line.withColumn("message", wrong).where("message is not null").select(F.col("ParentLoinc").alias("key"), "message")
    own = line.groupBy("ParentLoinc", "ParentId").agg(F.max(F.col("ID") == F.col("ParentId")).alias("root"))
    copy = S.pick_copy(line.join(own, ["ParentLoinc", "ParentId"]), "ParentLoinc", F.col("root"), "ParentId").where("Loinc <> ParentLoinc")
    copy = written(copy, "panel-members")
    member_term = term.select(F.col("code").alias("Loinc"), F.col("noticed").alias("member_noticed"))
    unknown_member = R.require_known(copy, "Loinc", terms, "LOINC_NUM", "is a member that Loinc.csv lacks")
    flagged = line.select("ParentLoinc", (noticed | F.col("panel_noticed")).alias("f")).union(copy.join(member_term, "Loinc").select("ParentLoinc", "member_noticed"))
    free = copy.join(flagged.groupBy("ParentLoinc").agg(F.max("f").alias("f")).where("f"), "ParentLoinc", "left_anti")
    member = free.select(F.col("ParentLoinc").alias("panel"), F.col("Loinc").alias("code"), F.col("SEQUENCE").cast("long").alias("sequence"), F.when(F.col("ObservationRequiredInPanel") != "", F.col("ObservationRequiredInPanel")).alias("required"))
    member = written(member, "members")
    named = term.where("ships and not noticed").select("code").union(member.select("panel")).union(member.select("code")).distinct()
    full = written(term.join(named, "code", "left_semi").withColumn("retired", status_of("status", words)), "lab-terms")
    bad_term = full.withColumn("message", F.when(~F.col("code").rlike(LOINC), "is no LOINC code").when(F.col("name") == "", "has no LONG_COMMON_NAME").when(F.col("retired").isNull(), F.concat(F.lit('has the status "'), "status", F.lit('", which this builder does not map')))).where("message is not null").select(F.col("code").alias("key"), "message")
    gone = full.where("retired").select("code")
    target = map_to.select(F.col("LOINC").alias("code"), F.col("MAP_TO").alias("target")).join(gone, "code", "left_semi")
    unknown_target = R.require_known(target, "target", terms, "LOINC_NUM", "replaces a code, but Loinc.csv lacks it")
    replaced = S.collect_replacements(gone, target.join(named.select(F.col("code").alias("target")), "target", "left_semi"), "code", "target")
    iri = lambda c: code_iri("loinc", c)
    rows = names_rows(full.withColumn("iri", iri("code")), series["names"], "iri", "name", F.lit(None), "code")
    rows = rows.unionByName(status_rows(replaced.withColumns({"iri": iri("code"), "to": F.transform("replaced_by", iri)}), series["status"], "iri", "to"))
    members = member.withColumns({"a": iri("code"), "b": iri("panel")})
    return BuildResult(rows.unionByName(member_rows(members, series["members"], "b", HAS_MEMBER, "a", "sequence", "required")), [twice, unknown_panel, bad_line, unknown_member, bad_term, unknown_target])


def variants(summary: DataFrame, snapshot: DataFrame, genes: list[str], classes: DataFrame, statuses: DataFrame, series: dict[str, str]) -> BuildResult:
    """Variant classifications and names. summary and snapshot as read_headed_tsv gives them (write them to Parquet
    once: a gzip file is one task); classes and statuses(label, concept)."""
    mine = R.filter_any_of(summary, "GeneSymbol", genes)
    has_scvs = "SCVsForAggregateGermlineClassification" in summary.columns
    said = ["ClinicalSignificance", "ReviewStatus", "LastEvaluated", "NumberSubmitters", *["SCVsForAggregateGermlineClassification"] * has_scvs]
    chosen = S.prefer_source(mine, "VariationID", "Assembly", ["GRCh38", "GRCh37"], "number", said)
    names = S.first_by_order(mine, "VariationID", "Name", "number")
    listed = names.select("VariationID")

    # A simple allele's expressions, submitted now or before.
    simple = snapshot.where(~F.col("Type").contains(",") & F.startswith(F.col("NucleotideExpression"), F.lit("NM_")))
    submitted = simple.where(F.col("Submitted").isin("Current", "Previous")).join(listed, "VariationID", "left_semi").select("VariationID", F.col("NucleotideExpression").alias("expression")).distinct()
    of_names = names.select("VariationID", name_expression("Name").alias("expression")).where("expression is not null")
    candidates = submitted.select("expression").union(of_names.select("expression")).distinct()
    owners = [
        simple.select(F.col("NucleotideExpression").alias("expression"), "VariationID").join(candidates, "expression", "left_semi"),
        summary.select(name_expression("Name").alias("expression"), "VariationID").where("expression is not null").join(candidates, "expression", "left_semi"),
    ]
    ambiguous = S.ambiguous_keys(owners, "expression", "VariationID")
    each = submitted.union(of_names).distinct().join(ambiguous, "expression", "left_anti").withColumn("iri", code_iri("hgvs", "expression"))
    each = each.withColumn("coding", is_coding_expression("iri"))
    hgvs = each.where("coding").groupBy("VariationID").agg(F.array_sort(F.collect_set("iri")).alias("hgvs"))

    terms = chosen.withColumn("terms", split_terms("ClinicalSignificance"))
    concepts, unmapped, double = R.lookup_labels(terms, "VariationID", "terms", classes)
    status = chosen.select("VariationID", F.when(F.col("ReviewStatus") != "-", F.col("ReviewStatus")).alias("label")).where("label is not null").join(statuses, "label", "left")
    date = parse_month_day_year("LastEvaluated")
    unread = chosen.where(F.col("LastEvaluated") != "-").where(date.isNull())
    out = names.join(chosen, "VariationID").join(hgvs, "VariationID", "left").join(concepts, "VariationID", "left").join(status.select("VariationID", F.col("concept").alias("review")), "VariationID", "left")
    out = out.withColumns({
        "iri": F.concat(F.lit(SPACES["clinvar"]), "VariationID"),
        "classes": F.when(F.size("concepts") > 0, F.array_distinct("concepts")),
        "evaluated": date,
        "scvs": count_listed("SCVsForAggregateGermlineClassification") if has_scvs else F.lit(None).cast("long"),
        "submitters": F.lit(None).cast("long") if has_scvs else F.col("NumberSubmitters").cast("long"),
    })
    rows = classification_rows(out, series["classifications"], "iri", hgvs="hgvs", classification="classes", reviewStatus="review", lastEvaluated="evaluated", contributingSubmitterCount="scvs", submitterCount="submitters")
    rows = rows.unionByName(names_rows(out, series["names"], "iri", "Name", F.lit(None), "VariationID"))

    genes_in = snapshot.where(F.col("Symbol").isin(genes))
    finding = lambda df, kind, term, ident: df.select(F.lit(kind).alias("kind"), F.col(term).alias("term"), F.col(ident).cast("string").alias("id"))
    found = [
        finding(ambiguous, "ambiguous", "expression", "expression"),
        finding(each.where("not coding"), "not coding", "expression", "VariationID"),
        finding(terms.select("VariationID", F.explode("terms").alias("t")).join(unmapped.select(F.col("label").alias("t")), "t", "left_semi"), "classification", "t", "VariationID"),
        finding(status.where("concept is null"), "review status", "label", "VariationID"),
        finding(S.disagreements(chosen, "VariationID").withColumn("t", F.lit("")), "disagreeing", "t", "VariationID"),
        finding(R.unlisted(genes_in, "VariationID", summary, "VariationID").withColumn("t", F.lit("")), "unlisted", "t", "VariationID"),
        finding(unread, "date", "LastEvaluated", "VariationID"),
    ]
    return BuildResult(rows, [double], [S.group_findings(reduce(DataFrame.union, found), "kind", "term", "id")])
