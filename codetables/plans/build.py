"""From a builder's rows to a version: checks, carrying forward, difference, name, rows and catalog.

A builder is a callable that takes DataFrames and gives a BuildResult; it may write what it reads several times to scratch
tables. build_version writes its rows to one: all that follows reads that. Nothing is published before every check has passed; then rows go to the folder of their version, which nothing points to yet,
and one commit makes versions, inputs and pointers appear together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetables.functions.rows import COLUMNS, merge_rows
from codetables.operators.carry import apply_history, carry_forward, rekey_carried
from codetables.operators.checks import check_row_schema
from codetables.operators.versions import add_version, content_fingerprint, diff, diff_counts, notes, version_label, version_name, with_content
from codetables.sources.commits import Snapshot, commit
from codetables.sources.readers import Refusal
from codetables.sources.shared import without_shuffles, written
from codetables.sources.sinks import write_version

VIOLATION = ["series", "key", "message"]


@dataclass
class BuildResult:
    rows: DataFrame
    violations: list[DataFrame] = field(default_factory=list)  # (key, message), and series where it is known
    findings: list[DataFrame] = field(default_factory=list)  # (kind, term, n, examples)

    kept: bool = False  # whether rows are those of a scratch table

    def staged(self) -> BuildResult:
        """The same with its rows written to a scratch table. Contents, the most of a row's bytes, are not kept there:
        checks compute those of double keys, and a version's rows get theirs when they are merged."""
        if self.kept:
            return self
        return BuildResult(written(self.rows.select(*COLUMNS), "built-rows"), self.violations, self.findings, kept=True)

    def all_violations(self) -> DataFrame:
        rows = self.staged().rows
        parts = [check_row_schema(rows), merge_rows(rows)[1], *self.violations]
        return reduce(DataFrame.unionByName, [_shaped(p) for p in parts])


Builder = Callable[..., BuildResult]


def _shaped(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in VIOLATION])


def refuse(violations: DataFrame, limit: int = 5) -> None:
    """Raises a Refusal with the first violations, if there are any."""
    with without_shuffles(violations.sparkSession):
        found = violations.orderBy(*VIOLATION).limit(limit).collect()
    if found:
        raise Refusal("; ".join(" ".join(str(x) for x in (r["series"], r["key"], r["message"]) if x is not None) for r in found))


@dataclass
class Publication:
    """What a source declares, and the catalog that takes its versions."""

    catalog: str
    label: str
    builder: str
    builder_version: str
    kinds: dict[str, str]  # of each series that the source declares
    publishes: bool = True  # whether its licence's policy does
    covers: dict[str, list[str]] = field(default_factory=dict)
    inputs: DataFrame | None = None  # iri and more
    at: str | None = None


@dataclass
class Built:
    rows: DataFrame
    changes: DataFrame
    notes: dict[str, str]
    names: dict[str, str | None]  # null: nothing new
    labels: dict[str, str] = field(default_factory=dict)
    commit: int | None = None


def _check_declared(result: BuildResult, to: Publication, held: dict[str, DataFrame]) -> None:
    """Refuses what the source may not publish: its licence, series that it doesn't declare, kinds that differ."""
    if not to.publishes:
        raise Refusal(f"{to.builder}: its licence's policy doesn't publish")
    undeclared = result.rows.where(~F.col("series").isin(list(to.kinds))).select("series").limit(1).collect()
    if undeclared:
        raise Refusal(f"a row of {undeclared[0]['series']}, which the source does not declare")
    if "series" in held:
        declared = held["series"].sparkSession.createDataFrame(list(to.kinds.items()), "iri string, _declared string")
        for r in held["series"].where("kind is not null").join(F.broadcast(declared), "iri").where("kind <> _declared").orderBy("iri").limit(1).collect():
            raise Refusal(f"the catalog gives {r['iri']} the table kind {r['kind']}, not {r['_declared']}, which its source declares, so it takes no new version")


def build_version(
    result: BuildResult,
    current: DataFrame,
    previous: dict[str, str | None],
    carrying: list[str] = (),
    registry: DataFrame | None = None,
    properties: dict[str, str] | None = None,
    path: str | None = None,
    history: tuple[DataFrame, str, str] | None = None,
    publish: Publication | None = None,
) -> Built:
    """Versions of all series that changed. current: the current rows of all series; previous: each series' current
    version; carrying: series that carry forward, with the code systems' registry (system, space); history: answers
    (value), the status series and the code system that they are of. Rows are written to path, a folder of versions, if
    one is given, and versions are committed to publish.catalog. A series has a new version if a row changed or what it
    covers did."""
    spark = result.rows.sparkSession
    result = result.staged()
    held = Snapshot(spark, publish.catalog).tables() if publish else {}
    if publish:
        _check_declared(result, publish, held)
    refuse(result.all_violations())
    rows = result.rows.select(*COLUMNS)
    if carrying and registry is not None:
        carried = carry_forward(rows, current, list(carrying), registry)
        for series, prop in (properties or {}).items():
            mine = F.col("series") == series
            carried = carried.where(~mine).unionByName(rekey_carried(carried.where(mine), prop))
        rows = rows.unionByName(carried)
    if history is not None:
        answered, wrong = apply_history(*history)
        refuse(_shaped(wrong))
        rows = rows.unionByName(answered)
    more = bool(carrying and registry is not None) or history is not None
    rows = written(rows, "carried-rows") if more else result.rows
    merged, wrong = merge_rows(rows)
    refuse(_shaped(wrong))
    merged = written(merged, "merged")  # what follows reads it again for each series
    changes = written(diff(with_content(current), merged), "changes")
    said = {r["series"]: r["notes"] for r in notes(diff_counts(changes)).collect()}
    about: dict[str, tuple[str | None, list[str]]] = {}
    if "versions" in held:
        now = held["series"].select(F.col("current_version").alias("iri")).join(held["versions"], "iri").where(F.col("series").isin(list(previous)))
        about = {r["series"]: (r["label"], r["covers"] or []) for r in now.select("series", "label", "covers").collect()}  # the source's series
    names: dict[str, str | None] = {}
    labels: dict[str, str] = {}
    for series, was in previous.items():
        covers = sorted(publish.covers.get(series, [])) if publish else []
        recovered = publish is not None and was is not None and covers != sorted(about.get(series, (None, []))[1])
        if recovered:
            said.setdefault(series, "0 added, 0 removed, 0 changed")
        names[series] = version_name(merged, series, was) if series in said or was is None else None
        if publish and names[series]:
            labels[series] = version_label(publish.label, publish.builder_version, about.get(series, (None, []))[0])
    for series, name in names.items():
        if name and path:
            write_version(merged.where(F.col("series") == series), path, name)
    number = _commit(spark, merged, previous, names, labels, said, held, publish) if publish and any(names.values()) else None
    return Built(merged, changes, said, names, labels, number)


def _commit(spark, merged: DataFrame, previous, names, labels, said, held: dict[str, DataFrame], to: Publication) -> int:
    prints = {r["series"]: r for r in content_fingerprint(merged, by=["series"]).collect()}  # one for each series
    rows = []
    for series, name in names.items():
        if name:
            p = prints.get(series)
            f = (p["n"], str(p["f1"]), str(p["f2"])) if p else (0, None, None)
            rows.append((name, series, labels[series], previous[series], said.get(series, "0 added, 0 removed, 0 changed"), sorted(to.covers.get(series, [])), to.builder, to.builder_version, to.at, *f))
    version = spark.createDataFrame(rows, "iri string, series string, label string, revises string, notes string, covers array<string>, builder string, builder_version string, issued string, n long, f1 string, f2 string")
    known = spark.createDataFrame([(s, previous[s], to.kinds.get(s)) for s in names], "iri string, current_version string, kind string")
    inputs = to.inputs if to.inputs is not None else spark.createDataFrame([], "iri string")
    return commit(spark, to.catalog, add_version({**held, "series": known}, version, inputs))


def fingerprints(rows: DataFrame) -> DataFrame:
    return content_fingerprint(with_content(rows), by=["series"])
