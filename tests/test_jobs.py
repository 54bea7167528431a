"""Readers, scalar functions and builders on small releases."""

import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from codetables.functions import scalars as X
from codetables.operators import relations as R
from codetables.operators import versions as V
from codetables.plans import jobs as J
from codetables.sources import readers, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_scalars(spark):
    assert one(spark, X.code_iri("hgvs", F.lit("NM_1.2:c.3A>G *~"))).endswith("NM_1.2%3Ac.3A%3EG%20%2A~")
    assert one(spark, X.code_of("cvx", F.lit(X.SPACES["cvx"] + "a%2Bb+c"))) == "a+b+c"
    assert one(spark, X.dotted(F.lit("C880"))) == "C88.0" and one(spark, X.dotted(F.lit("C88"))) == "C88"
    assert one(spark, X.split_codes(F.lit("A00.0, B01 and C02.1; None & D03"))) == ["A00.0", "B01", "C02.1", "D03"]
    assert one(spark, X.parse_month_day_year(F.lit("Dec 11, 2024"))) == "2024-12-11"
    assert one(spark, X.parse_month_day_year(F.lit("-"))) is None
    assert one(spark, X.name_expression(F.lit("NM_000249.4(MLH1):c.2042C>T (p.A)"))) == "NM_000249.4:c.2042C>T"
    assert one(spark, X.split_terms(F.lit("a/b; c"))) == ["a", "b", "c"] and one(spark, X.split_terms(F.lit("-"))) == ["-"]
    assert one(spark, X.count_listed(F.lit("a|b"))) == 2 and one(spark, X.count_listed(F.lit("-"))) == 0
    assert one(spark, X.parse_version(F.lit("2.10-x")) > X.parse_version(F.lit("2.9")))
    assert one(spark, X.month_after(F.lit("2025-12"))) == "2026-01"
    assert str(one(spark, X.listing_time(F.lit("8/13/2026  2:25 PM")))) == "2026-08-13 14:25:00"
    assert str(one(spark, X.http_date(F.lit("Thu, 13 Aug 2026 14:25:00 GMT")))) == "2026-08-13 14:25:00"
    assert one(spark, X.natural_sort_key(F.lit("a9")) < X.natural_sort_key(F.lit("a10")))
    long = "9" * 25
    assert one(spark, X.natural_sort_key(F.lit("a" + long)) < X.natural_sort_key(F.lit("a1" + long[:-1] + "10")))
    assert one(spark, X.natural_sort_key(F.lit("a" + long + "8")) < X.natural_sort_key(F.lit("a" + long + "9")))
    assert one(spark, X.parse_version(F.lit("1.2.3.4.5.6.7.9")) > X.parse_version(F.lit("1.2.3.4.5.6.7.8")))
    assert one(spark, X.parse_version(F.lit("2.0.0")) == X.parse_version(F.lit("2"))) and one(spark, X.parse_version(F.lit("x"))) is None
    assert one(spark, X.parse_version(F.lit("1." + long)) > X.parse_version(F.lit("1." + long[:-1])))
    assert one(spark, X.month_address(F.lit("x/{month}/y"), F.lit("as of 2026-03"))) == "x/2026-03/y"


def test_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("﻿a|b|\r\n\r\n\"c|d|\r\n".encode())
    rows = readers.read_delimited(spark, str(tmp_path / "a.txt")).orderBy("number").collect()
    assert [(r["number"], r["fields"]) for r in rows] == [(1, ["a", "b", ""]), (3, ['"c', "d", ""])]
    with gzip.open(tmp_path / "a.txt.gz", "wb") as f:
        f.write((tmp_path / "a.txt").read_bytes())
    assert readers.read_delimited(spark, str(tmp_path / "a.txt.gz")).count() == 2


def test_xlsx_and_zip(spark, tmp_path):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    sheet = f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2.50</v></c></row><row r="3"><c r="B3" t="inlineStr"><is><t>in</t></is></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    rows = readers.read_xlsx_first_sheet(spark, str(tmp_path / "b.xlsx")).collect()
    assert [(r["number"], r["fields"]) for r in rows] == [(1, ["rich", "", "2.50"]), (3, ["", "in"])]
    assert readers.read_zip_entries(spark, str(tmp_path / "b.xlsx"), "SHEET1").count() == 1
    # The workbook names another sheet first; spoken forms are left out, and cells and rows without a place follow.
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "c.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets><sheet name="first" sheetId="9" r:id="rId7"/><sheet name="other" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId7" Target="worksheets/sheet12.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>kanji</t><rPh sb="0" eb="1"><t>kana</t></rPh></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/worksheets/sheet12.xml", f'<worksheet xmlns="{ns}"><sheetData><row><c t="s"><v>0</v></c><c><v>2</v></c></row><row><c r="B2"><v>3</v></c></row></sheetData></worksheet>')
    assert [(r["number"], r["fields"]) for r in readers.read_xlsx_first_sheet(spark, str(tmp_path / "c.xlsx")).collect()] == [(1, ["kanji", "2"]), (2, ["", "3"])]


def test_headed_tsv_and_quads(spark, tmp_path):
    (tmp_path / "t.txt").write_text("##prose\n#B\tA\n1\t2\n")
    assert [tuple(r) for r in readers.read_headed_tsv(spark, str(tmp_path / "t.txt"), ["A"], ["C"]).collect()] == [(3, "2", None)]
    (tmp_path / "q.nq").write_text('<s:1> <p:1> "a \\"b\\" \\u00e9"^^<t:1> <g:1> .\n<s:1> <p:1> <o:1> .\nwrong\n')
    rows = sorted(readers.read_nquads(spark, str(tmp_path / "q.nq")).collect(), key=lambda r: (not r["ok"], r["object"]))
    assert [(r["object"], r["kind"], r["ok"]) for r in rows][:2] == [('a "b" é', "t:1", True), ("o:1", "iri", True)] and not rows[2]["ok"]


def test_escapes_of_quads(spark, tmp_path):
    texts = {r"x\U0001F600y": "x😀y", r"\uD83D\uDE00\u00e9": "😀é", r"a\\U0001F600": r"a\U0001F600", r"t\tn\nq\"b\\": "t\tn\nq\"b\\", "plain": "plain", "": ""}
    (tmp_path / "q.nq").write_text("".join(f'<s:{k}> <p:1> "{t}" <g:1> .\n' for k, t in enumerate(texts)))
    got = {r["subject"]: r["object"] for r in readers.read_nquads(spark, str(tmp_path / "q.nq")).collect()}
    assert [got[f"s:{k}"] for k in range(len(texts))] == list(texts.values())


def test_diagnoses(spark):
    order = [("A000", "0"), ("B001", "0"), ("C002", "1"), ("C003", "1"), ("Z002", "1")]
    lines = [(k, c, f, "short", "long " + c) for k, (c, f) in enumerate(order, 1)]
    table = [("B00.1", "A00.0"), ("C00.2", "B00.1"), ("C00.3", "B00.1"), ("Z00.2", "X00.0, X00.9"), ("Y00.1", "None")]
    built = J.diagnoses(
        spark.createDataFrame(lines, "number long, code string, flag string, short string, long string"),
        spark.createDataFrame([(k, [n, "2020", p]) for k, (n, p) in enumerate(table)], "number long, fields array<string>"),
        {"names": "n", "status": "s", "conversions": "c"},
    )
    got = {(r["subject_id"].rsplit("/", 1)[1], r["object_id"].rsplit("/", 1)[1]): (r["mapping_cardinality"], r["mapping_justification"].endswith("Chaining")) for r in built.rows.where("series = 'c'").collect()}
    assert got == {
        ("A00.0", "C00.2"): ("1:n", True), ("A00.0", "C00.3"): ("1:n", True), ("B00.1", "C00.2"): ("1:n", False),
        ("B00.1", "C00.3"): ("1:n", False), ("X00.0", "Z00.2"): ("n:1", False), ("X00.9", "Z00.2"): ("n:1", False),
    }
    assert built.all_violations().isEmpty()


def test_drugs(spark):
    def conso(code, kind, name):
        f = [""] * 18
        f[0], f[11], f[12], f[14], f[16] = code, "RXNORM", kind, name, "N"
        return f

    def rel(a, name, b):
        f = [""] * 16
        f[0], f[2], f[4], f[7], f[10] = b, "CUI", a, name, "RXNORM"
        return f

    frame = lambda rows: spark.createDataFrame([(k, f) for k, f in enumerate(rows, 1)], "number long, fields array<string>")
    terms = [conso("1", "IN", "a"), conso("2", "IN", "b"), conso("3", "MIN", "a / b"), conso("4", "SCDC", "a 1"), conso("5", "SCDC", "b 1"), conso("6", "SCD", "a 1 / b 1"), conso("7", "SBD", "X"), conso("8", "PIN", "a salt"), conso("6", "SY", "other")]
    rels = [rel("4", "has_ingredient", "1"), rel("5", "has_ingredient", "2"), rel("3", "has_part", "1"), rel("3", "has_part", "2"), rel("6", "consists_of", "4"), rel("6", "consists_of", "5"), rel("7", "consists_of", "4"), rel("7", "tradename_of", "6"), rel("4", "has_precise_ingredient", "8")]
    built = J.drugs(frame(terms), frame(rels), {"names": "n", "products": "p", "ingredients": "i", "generics": "g"})
    last = lambda x: x.rsplit("/", 1)[1]
    got = {(last(r["subject_id"]), last(r["object_id"]), r["predicate_id"].endswith("hasPreciseIngredient")) for r in built.rows.where("series = 'i'").collect()}
    assert got == {("1", "1", False), ("2", "2", False), ("3", "3", False), ("4", "1", False), ("5", "2", False), ("6", "3", False), ("7", "1", False), ("4", "8", True), ("6", "8", True), ("7", "8", True)}
    assert [(last(r["subject_id"]), last(r["object_id"])) for r in built.rows.where("series = 'g'").collect()] == [("7", "6")]
    assert built.rows.where("series = 'n' and notation = '6'").first()["altLabel"] == ["other"]
    assert built.all_violations().isEmpty()


def test_labs(spark):
    terms = [("24318-8", "1", "ACTIVE", "", "panel"), ("1-1", "1", "ACTIVE", "", "a"), ("2-2", "4", "ACTIVE", "", "b"), ("9-9", "1", "DEPRECATED", "", "old"), ("5-5", "1", "ACTIVE", "noticed", "c")]
    panels = [("7", "24318-8", "7", "1", "24318-8", "", "", ""), ("7", "24318-8", "8", "2", "1-1", "R", "", ""), ("7", "24318-8", "9", "3", "2-2", "", "", ""), ("3", "24318-8", "4", "1", "5-5", "", "", "")]
    built = J.labs(
        spark.createDataFrame(terms, "LOINC_NUM string, CLASSTYPE string, STATUS string, EXTERNAL_COPYRIGHT_NOTICE string, LONG_COMMON_NAME string"),
        spark.createDataFrame(panels, "ParentId string, ParentLoinc string, ID string, SEQUENCE string, Loinc string, ObservationRequiredInPanel string, EXTERNAL_COPYRIGHT_NOTICE string, AdditionalCopyright string"),
        spark.createDataFrame([("9-9", "1-1"), ("9-9", "5-5")], "LOINC string, MAP_TO string"),
        {"names": "n", "status": "s", "members": "m"},
    )
    assert sorted(r["notation"] for r in built.rows.where("series = 'n'").collect()) == ["1-1", "2-2", "24318-8", "9-9"]
    assert sorted((r["sequence"], r["required"]) for r in built.rows.where("series = 'm'").collect()) == [(2, "R"), (3, None)]
    assert [x.rsplit("/", 1)[1] for x in built.rows.where("series = 's'").first()["replacedBy"]] == ["1-1"]
    assert built.all_violations().isEmpty()


def test_drug_classes(spark):
    schema = "name string, from_namespace string, from_name string, from_code string, to_namespace string, to_name string, to_code string, qualifier array<struct<name:string,value:string>>"
    fda = [("Authority", "FDASPL")]
    rows = [
        ("has_MoA", "RxNorm", "d", "1", "MED-RT", "x [MoA]", "N1", fda), ("Parent Of", "MED-RT", "y [EPC]", "N2", "RxNorm", "d", "1", fda),
        ("has_SC", "RxNorm", "d", "1", "MeSH", "mesh", "M1", fda), ("has_PE", "RxNorm", "d", "1", "MED-RT", "z [PE]", "N3", [("Authority", "other")]),
    ]
    concepts = spark.createDataFrame([("N1", "x [MoA]"), ("N2", "y [EPC]")], "code string, name string")
    built = J.drug_classes(spark.createDataFrame(rows, schema), concepts, {"classes": "c", "names": "n"})
    assert built.rows.where("series = 'c'").count() == 3 and built.rows.where("series = 'n'").count() == 3
    assert built.all_violations().isEmpty()
    wrong = spark.createDataFrame([("has_MoA", "RxNorm", "d", "1", "MED-RT", "x [PE]", "N1", fda)], schema)
    assert "is not of a [MoA] class" in J.drug_classes(wrong, concepts, {"classes": "c", "names": "n"}).all_violations().first()["message"]


def test_variants(spark):
    cols = "number long, VariationID string, GeneSymbol string, Name string, Assembly string, ClinicalSignificance string, ReviewStatus string, LastEvaluated string, NumberSubmitters string, SCVsForAggregateGermlineClassification string"
    name = "NM_1.1(G):c.1A>G"
    summary = [
        (2, "10", "A;G", name, "GRCh37", "old", "s", "-", "1", "-"), (3, "10", "A;G", name, "GRCh38", "p/q; made-up", "s", "Dec 11, 2024", "2", "a|b"),
        (4, "11", "G", "x", "na", "-", "-", "-", "1", "-"), (5, "12", "Z", "NM_2.2:c.5A>G", "na", "p", "s", "-", "1", "-"),
    ]
    snapshot = [("G", "10", "coding", "NM_1.1:c.2A>G", "Current"), ("G", "10", "coding", "NM_2.2:c.5A>G", "Previous"), ("G", "19", "coding", "NM_9.9:c.1A>G", "No")]
    built = J.variants(
        spark.createDataFrame(summary, cols),
        spark.createDataFrame([(k, *r) for k, r in enumerate(snapshot)], "number long, Symbol string, VariationID string, Type string, NucleotideExpression string, Submitted string"),
        ["G"],
        spark.createDataFrame([("p", "c:p"), ("q", "c:q"), ("-", "c:none")], "label string, concept string"),
        spark.createDataFrame([("s", "r:s")], "label string, concept string"),
        {"classifications": "c", "names": "n"},
    )
    rows = {r["variation"][-2:]: r for r in built.rows.where("series = 'c'").collect()}
    assert rows["10"]["classification"] == ["c:p", "c:q"] and rows["10"]["contributingSubmitterCount"] == 2 and rows["10"]["lastEvaluated"] == "2024-12-11"
    assert [h.rsplit("/", 1)[1] for h in rows["10"]["hgvs"]] == ["NM_1.1%3Ac.1A%3EG", "NM_1.1%3Ac.2A%3EG"]
    assert rows["11"]["classification"] == ["c:none"] and rows["11"]["hgvs"] is None and set(rows) == {"10", "11"}
    kinds = {(r["kind"], r["term"]): (r["n"], r["examples"]) for r in built.findings[0].collect()}
    assert kinds[("classification", "made-up")] == (1, "10") and kinds[("unlisted", "")] == (1, "19")
    assert kinds[("ambiguous", "NM_2.2:c.5A>G")][0] == 1 and kinds[("disagreeing", "")] == (1, "10")
    assert built.all_violations().isEmpty()


def test_vaccines_refusals(spark):
    frame = lambda rows: spark.createDataFrame([(k, f) for k, f in enumerate(rows, 1)], "number long, fields array<string>")
    series = {"names": "n", "status": "s", "groups": "g"}
    good = [["03 ", "MMR", "measles", "", "Never Active", "False", "x"]]
    built = J.vaccines(frame(good), frame([["MMR", "03", "Active", "MMR", "03"]]), series)
    assert built.all_violations().isEmpty() and built.rows.count() == 3
    bad = J.vaccines(frame(good), frame([["MMR", "03", "Active", "MMR", "04"]]), series)
    assert "CVX.txt lacks it" in bad.all_violations().first()["message"]


def test_replacement_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("x", "y")], "prev string, next string")
    found = R.resolve_replacements(edges, spark.createDataFrame([("d",)], "code string"))
    assert {(r["code"], r["target"], r["cardinality"], r["direct"]) for r in found.collect()} == {("a", "d", "n:n", False), ("b", "d", "1:n", False), ("c", "d", "1:n", True)}


def test_long_and_branching_replacements(spark):
    # 30 times a path splits and merges again: 2**30 paths.
    edges = [e for k in range(30) for e in ((f"n{k}", f"a{k}"), (f"n{k}", f"b{k}"), (f"a{k}", f"n{k + 1}"), (f"b{k}", f"n{k + 1}"))]
    found = R.resolve_replacements(spark.createDataFrame(edges, "prev string, next string"), spark.createDataFrame([("n30",)], "code string"))
    got = {r["code"]: (r["target"], r["cardinality"], r["direct"]) for r in found.where("code in ('n0', 'a29', 'n29')").collect()}
    assert got == {"n0": ("n30", "n:n", False), "a29": ("n30", "n:1", True), "n29": ("n30", "n:n", False)}
