"""Publishing: what a source may not publish, what a version covers, history, and two publishers at once."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from codetables.functions.rows import COLUMNS, names_rows
from codetables.functions.scalars import code_iri
from codetables.plans.build import BuildResult, Publication, build_version
from codetables.sources import commits
from codetables.sources.readers import Refusal
from codetables.sources.sinks import read_version


@pytest.fixture
def rows(spark):
    def make(series, *pairs):
        df = spark.createDataFrame(list(pairs), "code string, name string").withColumn("iri", code_iri("cvx", "code"))
        return names_rows(df, series, "iri", "name", F.lit(None), "code")

    return make


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in COLUMNS.items()))


def test_refused_before_anything_is_written(spark, rows, nothing, tmp_path):
    place = str(tmp_path / "p")
    to = lambda **more: Publication(f"{place}/c", "1", "b", "1", {"s": "CodeNames"}, **more)
    for result, where, message in (
        (rows("t", ("1", "a")), to(), "a row of t, which the source does not declare"),
        (rows("s", ("1", "a")), to(publishes=False), "doesn't publish"),
        (rows("s", ("1", "a"), ("1", "b")), to(), "a row of the same key has other content"),
        (rows("s", ("1", "")), to(), "prefLabel is empty"),
    ):
        with pytest.raises(Refusal, match=message):
            build_version(BuildResult(result), nothing, {"s": None}, path=f"{place}/rows", publish=where)
        assert not (tmp_path / "p").exists()
    build_version(BuildResult(rows("s", ("1", "a"))), nothing, {"s": None}, path=f"{place}/rows", publish=to())
    other = Publication(f"{place}/c", "1", "b", "1", {"s": "RetiredCodes"})
    with pytest.raises(Refusal, match="the catalog gives s the table kind CodeNames, not RetiredCodes"):
        build_version(BuildResult(rows("s", ("2", "a"))), nothing, {"s": None}, publish=other)


def test_history_and_labels(spark, rows, nothing, tmp_path):
    place = str(tmp_path)
    to = Publication(f"{place}/c", "2026-10", "b", "4", {"names": "CodeNames", "status": "RetiredCodes"})
    answer = lambda code, status, *to: (json.dumps({"code": code, "answer": {"rxcuiStatusHistory": {"metaData": {"status": status}, "derivedConcepts": {"remappedConcept": [{"remappedRxCui": x} for x in to]}}}}),)
    answers = spark.createDataFrame([answer("1", "Remapped", "3", "2"), answer("2", "Active")], "value string")
    with pytest.raises(Refusal, match="2 has the unknown status Odd"):
        build_version(BuildResult(rows("names", ("1", "a"))), nothing, {"names": None}, history=(spark.createDataFrame([answer("2", "Odd")], "value string"), "status", "rxnorm"))
    built = build_version(BuildResult(rows("names", ("1", "a"), ("2", "b"))), nothing, {"names": None, "status": None}, path=f"{place}/rows", history=(answers, "status", "rxnorm"), publish=to)
    assert built.labels == {"names": "2026-10", "status": "2026-10"} and built.notes == {"names": "2 added, 0 removed, 0 changed", "status": "1 added, 0 removed, 0 changed"}
    status = read_version(spark, f"{place}/rows", "status", built.names["status"]).collect()
    assert [[x.rsplit("/", 1)[1] for x in r["replacedBy"]] for r in status] == [["2", "3"]]
    again = build_version(BuildResult(rows("names", ("1", "a"), ("2", "c"))), built.rows.where("series = 'names'"), {"names": built.names["names"]}, publish=to)
    assert again.labels == {"names": "2026-10 (builder 4)"} and again.notes == {"names": "0 added, 0 removed, 1 changed"}
    more = build_version(BuildResult(rows("names", ("1", "a"), ("2", "d"))), again.rows, {"names": again.names["names"]}, publish=to)
    assert more.labels == {"names": "2026-10 (builder 4)"}


def test_two_publishers(spark, rows, nothing, tmp_path):
    place, results = str(tmp_path), {}

    def publish(series):
        to = Publication(f"{place}/c", "1", series, "1", {series: "CodeNames"}, inputs=spark.createDataFrame([("shared",)], "iri string"))
        results[series] = build_version(BuildResult(rows(series, ("1", series))), nothing, {series: None}, path=f"{place}/rows-{series}", publish=to)

    threads = [threading.Thread(target=publish, args=(s,)) for s in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = commits.read_catalog(spark, f"{place}/c")
    assert {r["iri"]: r["current_version"] for r in got["series"].collect()} == {s: results[s].names[s] for s in "ab"}
    assert sorted(results[s].commit for s in "ab") == [0, 1] and got["inputs"].count() == 1 and got["version_inputs"].count() == 2
