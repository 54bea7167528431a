"""What grew faster than its input: each step reads, parses and shuffles its rows once, and one task or the driver takes no table whole."""

import base64
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import codetables.file_queries as Q
from codetables.functions.rows import COLUMNS, FORMS, names_rows, mapping_rows, merge_rows, row_content, row_lines
from codetables.functions.scalars import ROW_NAMESPACE, ROW_RULE, table_row_name
from codetables.operators import checks
from codetables.operators import relations as R
from codetables.operators import versions as V
from codetables.plans import jobs as J
from codetables.plans.build import BuildResult
from codetables.sources import readers
from codetables.sources.shared import shared_root, written


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def lines(spark, *rows):
    return spark.createDataFrame([("|".join(r),) for r in rows], "value string").select(F.monotonically_increasing_id().alias("number"), F.split("value", r"\|").alias("fields"))


def test_f1_parts_that_share_a_code(spark, tmp_path):
    spark.createDataFrame([(100_000, "a", "x"), (1_000_000, "b", "y"), (7, "c", "z")], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1_000_000, 5), (100_000, 5), (7, 5), (7, 6)], "l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(tuple(r) for r in Q.builder_diagnoses(spark, str(tmp_path)).collect() if r["series"] != "status")
    shared = [("conversions", "B00.0005", "A00.0007", "n:n"), ("conversions", "B00.0005", "A10.0000", "1:n"), ("conversions", "B00.0006", "A00.0007", "n:1")]
    assert got[:3] == shared and [r[1] for r in got[3:]] == ["A00.0007", "A10.0000", "A10.0000"]


def test_f2_classes_are_parsed_once(spark):
    kind = "name string, from_namespace string, from_name string, from_code string, to_namespace string, to_name string, to_code string, qualifier array<struct<name:string,value:string>>"
    text = '{"name":"has_MoA","from_namespace":"RxNorm","from_name":"d","from_code":"1","to_namespace":"MED-RT","to_name":"x [MoA]","to_code":"N1","qualifier":[{"name":"Authority","value":"FDASPL"}]}'
    said = spark.createDataFrame([(text,)], "value string").select(F.from_json("value", kind).alias("p")).select("p.*")
    built = J.drug_classes(said, spark.createDataFrame([("N1", "x [MoA]")], "code string, name string"), {"classes": "c", "names": "n"})
    assert "from_json" not in plan(built.rows) and built.rows.count() == 2 and built.all_violations().isEmpty()


def test_f2_contents_are_the_hashes_of_sorted_lines(spark):
    texts, lists = [None, "a", "", 'q"u\n\\x', "é"], [None, [], ["b", "a", "a"], [None], [None, "c", ""]]
    rows = []
    for form in [*FORMS, None]:
        for k in range(25):
            value = lambda i, t: lists[(k + i) % 5] if t.startswith("array") else (k + i) % 3 or None if t == "long" else texts[(k * i + k // 5) % 5]  # noqa: B023, E731
            rows.append(tuple(form if c == "form" else value(i, t) for i, (c, t) in enumerate(COLUMNS.items())))
    df = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))
    assert df.where(~F.sha2(F.array_join(row_lines(), "\n"), 256).eqNullSafe(row_content())).isEmpty()


def test_f3_merging_shuffles_hashes_and_lines_are_cut_once(spark):
    one = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("b", "z"), ("c", "w")], "iri string, name string")
    merged, differ = merge_rows(names_rows(one, "s", "iri", "name", F.lit(None), "iri"))
    assert sorted(r["key"] for r in merged.collect()) == ["a", "b", "c"] and [r["key"] for r in differ.collect()] == ["b"]
    good = lines(spark, ["03", "MMR", "measles", "", "Active", "False", "x"])
    built = J.vaccines(good, lines(spark, ["MMR", "03", "Active", "MMR", "03"]), {"names": "n", "status": "s", "groups": "g"})
    assert "split(" not in plan(built.rows) and built.rows.count() == 2


def test_f4_drugs_are_counted_without_a_window(spark):
    conso = lines(spark, ["1", *[""] * 10, "RXNORM", "IN", "", "a", "", "N", ""], ["2", *[""] * 10, "RXNORM", "SCDC", "", "b", "", "N", ""])
    rels = lines(spark, ["1", "", "CUI", "", "2", "", "", "has_ingredient", "", "", "RXNORM", ""])
    built = J.drugs(conso, rels, {"names": "n", "products": "p", "ingredients": "i", "generics": "g"})
    assert "Window" not in plan(built.rows) and "split(" not in plan(built.rows)
    assert built.rows.where("series = 'i'").count() == 2


def test_f5_f10_names_are_hashed_in_a_task(spark, monkeypatch):
    def no(self, *_, **__):
        raise AssertionError("lines come to the driver")

    monkeypatch.setattr(DataFrame, "toLocalIterator", no)
    monkeypatch.setattr(V, "NAME_BLOCK", 200)
    rows = names_rows(spark.range(500).select(F.concat(F.lit("urn:x:"), "id").alias("iri"), F.col("id").cast("string").alias("code")).repartition(5), "s", "iri", "code", F.lit(None), "code")
    text = "".join(r["line"] + "\n" for r in V.version_lines(rows, "s", None).collect())
    assert V.version_name(rows, "s") == "ni:///sha-256;" + base64.urlsafe_b64encode(hashlib.sha256(text.encode()).digest()).decode().rstrip("=")


def test_f6_rules_are_broadcast(spark):
    assoc = spark.range(100).select((F.col("id") % 2).cast("string").alias("relation"), "id", F.lit("x").alias("from_name"), F.lit("y").alias("to_name")).select("relation", F.col("id").alias("from_code"), "from_name", F.col("id").alias("to_code"), "to_name")
    rules = assoc.select("relation").distinct().select("relation", F.lit(False).alias("reversed"), F.lit(None).cast("string").alias("suffix"))
    found = R.class_assignments(assoc, rules)[0]
    assert "strategy=broadcast" in plan(found) and found.count() == 100


def test_f7_headers_of_several_files(spark, tmp_path):
    for k, text in enumerate(("##prose\n#B\tA\n1\t2\n", "#B\tA\n3\t4\n5\t6\n")):
        (tmp_path / f"{k}.tsv").write_text(text)
    assert sorted(r["A"] for r in readers.read_headed_tsv(spark, str(tmp_path), ["A"]).collect()) == ["2", "4", "6"]
    (tmp_path / "2.tsv").write_text("#A\tB\n1\t2\n")
    with pytest.raises(readers.Refusal, match="different headers"):
        readers.read_headed_tsv(spark, str(tmp_path), ["A"])
    (tmp_path / "2.tsv").write_text("only prose\n")
    with pytest.raises(readers.Refusal, match="2.tsv has no header"):
        readers.read_headed_tsv(spark, str(tmp_path), ["A"])


def test_f8_panels_are_picked_once(spark):
    terms = spark.createDataFrame([("1-1", "1", "ACTIVE", "", "a"), ("2-2", "1", "ACTIVE", "", "b")], "LOINC_NUM string, CLASSTYPE string, STATUS string, EXTERNAL_COPYRIGHT_NOTICE string, LONG_COMMON_NAME string")
    panels = spark.createDataFrame([("7", "1-1", "7", "1", "1-1", "", "", ""), ("7", "1-1", "8", "2", "2-2", "R", "", "")], "ParentId string, ParentLoinc string, ID string, SEQUENCE string, Loinc string, ObservationRequiredInPanel string, EXTERNAL_COPYRIGHT_NOTICE string, AdditionalCopyright string")
    built = J.labs(terms, panels, spark.createDataFrame([], "LOINC string, MAP_TO string"), {"names": "n", "status": "s", "members": "m"})
    assert "Window" not in plan(built.rows) and built.rows.count() == 3 and built.all_violations().isEmpty()


def test_f9_links_are_read_once(spark):
    pages = spark.createDataFrame([(1, "https://x.org/a/", '<a href="./b&amp;c/../d/">d</a>')], "page long, base string, html string")
    found = V.list_links(pages, "page", "html", "base")
    assert "regexp_extract" not in plan(found) and [tuple(r)[1:4] for r in found.collect()] == [("d", "https://x.org/a/d/", True)]


def test_r04_f1_scratch_of_drug_classes(spark, tmp_path):
    spark.range(300).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(60_000).selectExpr("id % 300 AS l_partkey", "(id div 300) % 100 AS l_suppkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    root = Path(shared_root(spark).removeprefix("file://"), "codetables")
    before = set(root.iterdir()) if root.exists() else set()
    rows = Q.builder_drug_classes(spark, str(tmp_path))
    assert rows.where("series = 'classes'").distinct().count() == 30_000 and rows.where("series = 'names'").count() == 300
    made = [f for d in set(root.iterdir()) - before for f in d.rglob("part-*")]
    assert sum(f.stat().st_size for f in made) < 100 * 30_000  # 310 bytes a pair before
    assert not any(f.suffix == ".txt" for f in made)


def test_r04_f1_text_in_files_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(Q, "TEXT_FILE_LINES", 10)
    path = Q._text(spark.range(0, 35, 1, 1), F.concat(F.lit("n"), "id"), "bounded")
    found = readers.read_lines(spark, path)
    assert found.groupBy("file").count().select("count").distinct().count() == 2 and found.select("file").distinct().count() == 4
    assert {r["value"] for r in found.collect()} == {f"n{k}" for k in range(35)}


def test_r04_f1_shuffles_go_when_a_table_is_written(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*")}
    before = files()
    assert len(written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted").collect()) == 7
    assert files() <= before


def test_r04_f1_contents_are_those_of_double_keys_and_versions(spark):
    rows = names_rows(spark.createDataFrame([("u:1", "a"), ("u:1", "b"), ("u:2", "c"), ("u:2", "c")], "iri string, name string"), "s", "iri", "name", F.lit(None), "name")
    staged = BuildResult(rows).staged()
    assert "content" not in staged.rows.columns and staged.staged() is staged
    assert [r["key"] for r in staged.all_violations().collect()] == ["u:1"]
    assert [r["content"] for r in merge_rows(staged.rows)[0].where("key = 'u:2'").collect()] == [r["c"] for r in rows.where("key = 'u:2'").select(row_content().alias("c")).distinct().collect()]


def test_r04_f1_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":"1","b":"x"}\r\nno json\n\n\r\n{"a":"2"}\r')
    parsed = readers.read_json_lines(spark, str(tmp_path), "a string, b string").select(F.inline_outer(F.array("parsed")))
    assert sorted(tuple(r) for r in parsed.fillna("-").collect()) == [("-", "-"), ("1", "x"), ("2", "-")]
    assert plan(parsed.where("a = '1' and b is not null")).count("from_json") == 1


def test_r04_f1_names_of_rows(spark):
    def by_rule(s, p, o, n):
        safe = [x.replace("%", "%25").replace("|", "%7C") for x in (s, p, o)]
        h = hashlib.sha256("|".join([ROW_NAMESPACE, ROW_RULE, *safe, *([str(n)] if n is not None else [])]).encode()).hexdigest()
        return f"urn:uuid:{h[:8]}-{h[8:12]}-8{h[13:16]}-{'89ab'[int(h[16], 16) % 4]}{h[17:20]}-{h[20:32]}"

    given = [("a|b", "p%", "o", 3), ("a", "p", "%7C|", None), ("", "", "", 0), *[(str(k), "p", "o", k) for k in range(40)]]
    df = spark.createDataFrame([*given, (None, "p", "o", 1), ("s", None, "o", 1), ("s", "p", None, 1)], "s string, p string, o string, n long")
    assert [r[0] for r in df.select(table_row_name("s", "p", "o", "n")).collect()] == [*[by_rule(*g) for g in given], None, None, None]


def test_r04_f1_rows_of_all_forms_are_checked(spark):
    said = mapping_rows(spark.createDataFrame([("u:a", "u:b"), ("u:a", "no address"), (None, "u:b")], "a string, b string"), "s", "a", F.lit("u:p"), "b")
    listed = names_rows(spark.createDataFrame([("u:a", "x"), ("u:b", "")], "a string, b string"), "s", "a", "b", F.lit(None), "a")
    lists = said.limit(1).select(*[{"form": F.lit("status"), "subject": F.lit("u:a"), "replacedBy": F.array(F.lit("u:x"), F.lit("bad one"))}.get(c, F.lit(None).cast(t)).alias(c) for c, t in COLUMNS.items()])
    found = checks.check_row_schema(said.unionByName(listed).unionByName(lists))
    assert sorted(r["message"] for r in found.collect()) == ["object_id is no address", "prefLabel is empty", "replacedBy holds what is no address", "subject_id is missing"]
    assert "lambda" not in plan(found).split("Filter")[-1]
