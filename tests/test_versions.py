"""The code list end to end: golden keys and version names, differences, carrying forward, refusals."""

import pytest

from codetables.functions.rows import COLUMNS, MEMBER_OF, from_triples, merge_rows, names_rows, to_triples
from codetables.operators import versions as V
from codetables.operators.carry import carry_forward
from codetables.operators.checks import assert_same_rows, check_row_schema
from codetables.plans.build import BuildResult, build_version
from codetables.plans.jobs import code_list
from codetables.sources.readers import Refusal, read_delimited
from pyspark.sql import functions as F

GROUPS, NAMES, STATUS = "urn:uuid:c1a6678c-2b4d-4287-b852-9039e6a71afd", "urn:uuid:6e9c1dc9-8c36-49a8-929c-cd9f6701076c", "urn:uuid:57b9415b-3531-4995-8dfb-48b69ead096f"
SERIES = {"names": NAMES, "groups": GROUPS, "status": STATUS}
ONE = """141|flu, split|Influenza, split virus|88|Active
150|flu, quadrivalent|Influenza, quadrivalent|88|Active
88|flu|flu|88|Active
03|MMR|measles, mumps and rubella|03|Active
57|hantavirus|hantavirus vaccine||Retired
"""
TWO = """141|flu, split|Influenza, split virus|88|Active
150|flu, quadrivalent, PF|Influenza, quadrivalent, preservative free|88|Active
140|flu, split, PF|Influenza, split virus, preservative free|88|Active
88|flu|flu|88|Active
03|MMR|measles, mumps and rubella|03|Retired
"""


@pytest.fixture(scope="module")
def build(spark, tmp_path_factory):
    def made(text):
        path = tmp_path_factory.mktemp("release") / "codes.txt"
        path.write_text(text)
        return code_list(read_delimited(spark, str(path)), SERIES)

    return made


def test_golden_keys(build):
    rows = build(ONE).rows.where(F.col("series") == GROUPS).collect()
    keys = {(r["subject_id"][-3:].strip("/"), r["object_id"][-2:]): r["key"] for r in rows}
    assert keys["141", "88"] == "urn:uuid:064bdbda-7965-8c20-8ee0-417849048a81"
    assert {r["predicate_id"] for r in rows} == {MEMBER_OF} and len(rows) == 4


def test_golden_version_names(build):
    golden = {
        GROUPS: ("IPwCLHYeiU1z81lI2Aaz-K5g6TDTY2-wPcoMFEKQk5I", "68-WRpHcxt2OYRoYAZ-JjXN8uQUGuCm56i3PPOqgVeo"),
        NAMES: ("HUfdai7LDjJev4yjyDyPd1ay3DpcvGeJf0Slqz4mkdg", "l6tYv-yIaz3Us4A9eDJ00hOM0_sz0iO5bgAcoVr4jYA"),
        STATUS: ("VpYf5XnMmlW_BzKjBqkEoUKHLJNeOx6iS7EvaXbIHgg", "hTb7_IYmYWMe91gaiYP1CumDoUmNxjJd_VNCATPLp-0"),
    }
    one, two = build(ONE).rows, build(TWO).rows
    for series, (first, second) in golden.items():
        name = V.version_name(one, series)
        assert name == "ni:///sha-256;" + first
        assert V.version_name(two, series, name) == "ni:///sha-256;" + second
    shuffled = "\n".join(reversed(ONE.strip().split("\n"))) + "\n"
    assert V.version_name(build(shuffled).rows.repartition(3), NAMES) == "ni:///sha-256;" + golden[NAMES][0]


def test_differences(build):
    one, two = V.with_content(build(ONE).rows), V.with_content(build(TWO).rows)
    counts = {r["series"]: (r["added"], r["removed"], r["changed"]) for r in V.diff_counts(V.diff(one, two)).collect()}
    assert counts == {GROUPS: (1, 0, 0), NAMES: (1, 1, 1), STATUS: (1, 1, 0)}
    assert assert_same_rows(one, one).isEmpty()
    mirrored = {r["series"]: (r["removed"], r["added"], r["changed"]) for r in V.diff_counts(V.diff(two, one)).collect()}
    assert mirrored == counts
    assert V.content_fingerprint(one).first() == V.content_fingerprint(one.repartition(3)).first() != V.content_fingerprint(two).first()


def test_triples_round_trip(build):
    rows = build(ONE).rows
    back = from_triples(to_triples(rows))
    assert assert_same_rows(V.with_content(rows), V.with_content(back)).isEmpty()


def test_build_version_and_carry(spark, build, tmp_path):
    one, two = build(ONE), build(TWO)
    registry = spark.createDataFrame([("cvx", "https://ns.cascadeprotocol.org/codes/cvx/")], "system string, space string")
    built = build_version(two, one.rows, {GROUPS: None, NAMES: "ni:///sha-256;x", STATUS: None}, [NAMES], registry, path=str(tmp_path / "v"))
    assert built.notes[NAMES] == "1 added, 0 removed, 1 changed"  # 57 left the release and is carried
    assert built.rows.where("notation = '57'").count() == 1
    carried = carry_forward(two.rows, one.rows, [NAMES], registry)
    assert [r["notation"] for r in carried.collect()] == ["57"]
    same = build_version(one, one.rows, {NAMES: "ni:///sha-256;x"})
    assert same.names == {NAMES: None} and same.notes == {}


@pytest.mark.parametrize(("text", "message"), [
    ("141|a|b|88|Gone\n", 'codes.txt line 1 has the status "Gone", which this builder does not map'),
    ("141|a|b|88\n", "codes.txt line 1 has 4 fields, not 5"),
    ("\n|a|b|88|Active\n", "codes.txt line 2 has no code"),
    ("141|a|b|88|Active\n141|c|b|88|Active\n", "a row of the same key has other content"),
])
def test_refusals(spark, build, tmp_path, text, message):
    with pytest.raises(Refusal, match=message.replace("(", r"\(")):
        build_version(build(text), spark.createDataFrame([], _schema()), {NAMES: None}, path=str(tmp_path / "v"))
    assert not (tmp_path / "v").exists()


def _schema():
    return ", ".join(f"{c} {k}" for c, k in COLUMNS.items())


def test_merge_and_schema(spark):
    df = spark.createDataFrame([("x:a", "n", "c"), ("x:a", "n", "c"), ("no address", "", "c")], "i string, n string, c string")
    rows = names_rows(df, "s", "i", "n", F.lit(None), "c")
    merged, wrong = merge_rows(rows)
    assert merged.count() == 2 and wrong.isEmpty()
    assert {r["message"] for r in check_row_schema(rows).collect()} == {"subject is no address", "prefLabel is empty"}


def _rows(spark, form, rows):
    from codetables.functions.rows import rows_of

    names = {"names": ["subject", "prefLabel", "altLabel", "notation"], "mapping": ["subject_id", "object_id", "mapping_justification"], "status": ["subject", "replacedBy"], "classification": ["variation", "hgvs", "classification", "reviewStatus", "lastEvaluated", "contributingSubmitterCount"]}[form]
    kinds = ", ".join(f"{n} {COLUMNS[n]}" for n in names)
    more = {"predicate_id": F.lit("http://purl.obolibrary.org/obo/RO_0002350")} if form == "mapping" else {}
    return rows_of(spark.createDataFrame(rows, kinds), form, "s", **{n: n for n in names}, **more)


def _lines(spark, form, before, after, labels=None):
    a, b = _rows(spark, form, before), _rows(spark, form, after)
    found = V.describe_changes(V.diff(V.with_content(a), V.with_content(b)), a, b, labels)
    out = {"added": [], "removed": [], "changed": []}
    for r in found.orderBy("order").collect():
        out[r["change"]].append(r["line"])
    return out


def test_lines_of_changes(spark):
    c = "https://ns.cascadeprotocol.org/codes/cvx/"
    name = lambda k, label, *also: (c + k, label, list(also) or None, k)
    mapping = lambda a, b, why="ManualMappingCuration": (c + a, c + b, "https://w3id.org/semapv/vocab/" + why)
    assert _lines(spark, "names", [name("9", "nine")], [name("10", "ten"), name("45", "forty"), name("7", "x")]) == {"added": ["`7`: x", "`10`: ten", "`45`: forty"], "removed": ["`9`: nine"], "changed": []}
    assert _lines(spark, "mapping", [mapping("77", "222")], [mapping("88", "88"), mapping("8", "88")]) == {"added": ["`8` → `88` (RO_0002350)", "`88` → `88` (RO_0002350)"], "removed": ["`77` → `222` (RO_0002350)"], "changed": []}
    assert _lines(spark, "status", [], [(c + "57", None), (c + "17", [c + "88", c + "45"])])["added"] == ["`17`: retired, replaced by `45`, `88`", "`57`: retired"]
    v = "https://ns.cascadeprotocol.org/cascade#"
    row = lambda classes, n: ("https://identifiers.org/clinvar:90011", [f"https://ns.cascadeprotocol.org/codes/hgvs/NM_1.{k}" for k in range(n)], [v + x for x in classes], v + "ClinVarExpertPanel", "2024-12-11", 5)
    labels = spark.createDataFrame([(v + "Pathogenic", "Pathogenic"), (v + "LikelyPathogenic", "Likely pathogenic"), (v + "ClinVarExpertPanel", "reviewed by expert panel")], "concept string, label string")
    assert _lines(spark, "classification", [row(["Pathogenic"], 1)], [row(["Pathogenic", "LikelyPathogenic"], 2)], labels)["changed"] == [
        "`90011`: Likely pathogenic, Pathogenic (reviewed by expert panel), 2024-12-11, 2 expressions (was `90011`: Pathogenic (reviewed by expert panel), 2024-12-11, 1 expression)"
    ]
    assert _lines(spark, "names", [name("45", "old <label>")], [name("45", "new label")])["changed"] == ["`45`: new label (was `45`: old \\<label\\>)"]
    assert _lines(spark, "names", [name("45", "Hep B", "hepatitis B")], [name("45", "Hep B", "hepatitis B vaccine")])["changed"] == ["`45`: Hep B, also called hepatitis B vaccine (was `45`: Hep B, also called hepatitis B)"]
    assert _lines(spark, "mapping", [mapping("1", "2")], [mapping("1", "2", "LexicalMatching")])["changed"] == ["`1` → `2` (RO_0002350, justified by LexicalMatching) (was `1` → `2` (RO_0002350, justified by ManualMappingCuration))"]
    assert _lines(spark, "names", [], [name("a1", "@octocat ~~fixes~~ #12"), name("a%zz", "plain")])["added"] == ["`a%zz`: plain", "`a1`: \\@octocat \\~\\~fixes\\~\\~ \\#12"]


def test_report_and_budget(spark, build):
    from codetables.operators.summaries import share_budget

    one, two = build(ONE).rows, build(TWO).rows
    found = V.diff(V.with_content(one), V.with_content(two))
    text = V.change_report(V.describe_changes(found, one, two), "By the publisher", {NAMES: "1 added, 1 removed, 1 changed"}, ["a finding"], labels={NAMES: "Names", STATUS: "Status"}, names={NAMES: ("ni:2", "ni:1"), STATUS: (None, None)})
    assert text.startswith("By the publisher\n\n") and "## Names\n\n`ni:2`, revising `ni:1`: 1 added, 1 removed, 1 changed.\n\nAdded (1):\n\n- `140`: " in text
    assert "## Status\n\nNothing new: its rows equal the current version's.\n" in text and text.endswith("\n## Findings\n\n- a finding\n")
    assert share_budget(100, [10, 200, 300]) == [10, 45, 45]
    many = lambda n: _rows(spark, "names", [(f"https://x.org/{k}", f"label {k}", None, str(k)) for k in range(n)])
    lines = V.describe_changes(V.diff(V.with_content(many(0)), V.with_content(many(2000))), many(0), many(2000))
    text = V.change_report(lines, "", {"s": "2000 added, 0 removed, 0 changed"}, budget=6000)
    assert "<details><summary>Added (2000)</summary>\n\n- `0`: label 0\n- `1`: label 1\n" in text and len(text) < 6300
    shown = text.count("\n- `")
    assert f"- and {2000 - shown} more; the complete rows are in the release's rows files" in text and shown > 250
