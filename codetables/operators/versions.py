"""Versions: difference, name and fingerprint by content, labels, the catalog's bookkeeping, and the report of changes."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetables.functions.addresses import decoded, links, resolved
from codetables.functions.rows import COLUMNS, PROV, row_content, row_lines
from codetables.functions.scalars import escape_markdown, listing_time, natural_sort_key, parse_version, short_code
from codetables.operators.scans import running
from codetables.operators.summaries import current_and_previous, share_budget
from codetables.sources.shared import written

# Fixed value: the name that a version has in its own content.
THIS_VERSION = "urn:cascade:this-version"


def diff(before: DataFrame, after: DataFrame, keys: list[str] = ["series", "key"], content: str = "content") -> DataFrame:  # noqa: B006
    """Keys added, removed or changed. Only keys and content hashes are shuffled; texts are fetched afterwards."""
    a = before.select(*keys, F.col(content).alias("_a"))
    b = after.select(*keys, F.col(content).alias("_b"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, keys, "full_outer").select(*keys, change.alias("change")).where("change is not null")


def diff_counts(found: DataFrame, by: str = "series") -> DataFrame:
    count = lambda c: F.count(F.when(F.col("change") == c, 1)).alias(c)
    return found.groupBy(by).agg(count("added"), count("removed"), count("changed"))


def notes(counts: DataFrame) -> DataFrame:
    part = lambda c: F.concat(F.col(c).cast("string"), F.lit(f" {c}"))
    return counts.withColumn("notes", F.concat_ws(", ", part("added"), part("removed"), part("changed")))


def is_unchanged(counts: DataFrame, covers_before: list[str] | None, covers_after: list[str] | None) -> bool:
    """Whether a series needs no version: no row and no covered list changed."""
    return counts.where("added + removed + changed > 0").isEmpty() and sorted(covers_before or []) == sorted(covers_after or [])


def version_lines(rows: DataFrame, series: str, previous: str | None) -> DataFrame:
    """The sorted distinct lines that name a version."""
    spark = rows.sparkSession
    own = [(f"<{THIS_VERSION}> <{PROV}specializationOf> <{series}> .",)]
    if previous is not None:
        own.append((f"<{THIS_VERSION}> <{PROV}wasRevisionOf> <{previous}> .",))
    lines = rows.where(F.col("series") == series).select(F.explode(row_lines()).alias("line"))
    return lines.union(spark.createDataFrame(own, "line string")).distinct().orderBy("line")


#: Bytes of lines that are packed together for the task that hashes them.
NAME_BLOCK = 1 << 16


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a sorted part as numbered, compressed blocks."""
    part, n, held = TaskContext.get().partitionId(), 0, bytearray()

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int32()), "block": pa.array([zlib.compress(held, 1)], pa.binary())})

    for batch in batches:
        for line in batch.column(0).to_pylist():
            held += line.encode() + b"\n"
            if len(held) >= NAME_BLOCK:
                yield block()
                n, held = n + 1, bytearray()
    if held:
        yield block()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = hashlib.sha256()
    for batch in batches:
        for block in batch.column("block"):
            digest.update(zlib.decompress(block.as_py()))
    yield pa.RecordBatch.from_pydict({"digest": [digest.digest()]})


def version_name(rows: DataFrame, series: str, previous: str | None = None) -> str:
    """A version's name: the SHA-256 of its sorted lines, which is serial by definition. Lines are sorted and packed in
    parts; one task takes the packed blocks in order into a running hash, and only the digest comes to the driver.
    content_fingerprint() says first whether it's needed."""
    blocks = written(version_lines(rows, series, previous).mapInArrow(_packed, "part int, n int, block binary"), "name-blocks")
    digest = blocks.repartition(1).sortWithinPartitions("part", "n").mapInArrow(_digested, "digest binary").first()["digest"]
    return "ni:///sha-256;" + base64.urlsafe_b64encode(bytes(digest)).decode().rstrip("=")


def content_fingerprint(df: DataFrame, content: str | Column = "content", by: list[str] | None = None) -> DataFrame:
    """Number of rows and two order-free sums of hash slices: equal for equal sets of rows, made in parallel."""
    c = F.col(content) if isinstance(content, str) else content
    piece = lambda k: F.sum(F.conv(F.substring(c, k, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)")
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n"), piece(1).alias("f1"), piece(17).alias("f2"))


def version_label(label: str | Column, builder_version: str, current_label: str | Column | None) -> str | Column:
    """The label, with the builder's version where the current version has that label already, with or without one.
    Columns give a column."""
    if isinstance(current_label, Column) or isinstance(label, Column):
        name = F.lit(label) if isinstance(label, str) else label
        taken = (current_label == name) | F.startswith(current_label, F.concat(name, F.lit(" (builder ")))
        return F.when(taken, F.concat(name, F.lit(f" (builder {builder_version})"))).otherwise(name)
    taken = current_label is not None and (current_label == label or current_label.startswith(f"{label} (builder "))
    return f"{label} (builder {builder_version})" if taken else label


def add_version(catalog: dict[str, DataFrame], version: DataFrame, inputs: DataFrame) -> dict[str, DataFrame]:
    """What a commit adds for new versions (iri, series, ...): their rows, inputs that the catalog lacks, links, and the
    series that move, with the version they were at (`was`). inputs with a column `version` are linked with it, others
    (a release's files, a handful) with each version."""
    moved = version.select(F.col("series").alias("iri"), F.col("iri").alias("_new"))
    series = catalog["series"].join(moved, "iri").withColumn("was", F.col("current_version")).withColumn("current_version", F.col("_new")).drop("_new")
    if "version" in inputs.columns:
        links = inputs.select("version", F.col("iri").alias("input")).distinct()
    else:
        files = [r["iri"] for r in inputs.select("iri").distinct().collect()]
        links = version.select(F.col("iri").alias("version"), F.explode(F.array(*[F.lit(f) for f in files]).cast("array<string>")).alias("input")).distinct()
    new = inputs.drop("version").dropDuplicates(["iri"])
    if "inputs" in catalog:
        new = new.join(catalog["inputs"].select("iri"), "iri", "left_anti")
    return {"versions": version, "inputs": new, "version_inputs": links, "series": series}


def needs_build(series: DataFrame, versions: DataFrame, builder: str, builder_version: str, seen_nothing: bool) -> bool:
    """A series has no version, or none of the current ones is by this builder version and the last check saw more."""
    current = series.join(versions.select(F.col("iri").alias("current_version"), "builder", "builder_version"), "current_version", "left")
    got = current.agg(
        F.max(F.col("builder").isNull()).alias("none"),
        F.max((F.col("builder") == builder) & (F.col("builder_version") == builder_version)).alias("same"),
    ).first()
    return bool(got["none"]) or not (got["same"] or seen_nothing)


def changed_inputs(seen: DataFrame, recorded: DataFrame) -> DataFrame:
    """Seen files (title, checksum, modified) whose checksum isn't recorded, or, without one, whose time isn't."""
    by_sum = seen.where("checksum is not null").join(recorded, ["title", "checksum"], "left_anti").select("title")
    by_time = seen.where("checksum is null").join(recorded, ["title", "modified"], "left_anti").select("title")
    return by_sum.union(by_time).distinct()


def newer_versions(pages: DataFrame, held: DataFrame, page: str, text: str, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(page, newest) where a page names a version newer than all held ones, and pages that name none. held(page,
    version)."""
    named = pages.select(page, F.explode_outer(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("version")).withColumn("v", parse_version("version"))
    newest = named.groupBy(page).agg(F.max_by("version", "v").alias("newest"), F.max("v").alias("v"))
    most = held.groupBy(page).agg(F.max(parse_version("version")).alias("held"))
    found = newest.where("v is not null").join(most, page, "left").where(F.col("held").isNull() | (F.col("v") > F.col("held")))
    return found.select(page, "newest"), newest.where("v is null").select(page)


def list_links(pages: DataFrame, page: str, html: str, base: str) -> DataFrame:
    """(page, name, href, is_folder, modified), each once: the links of a folder listing that lie directly below its own
    address, with their time where the line gives one. base: the listing's address, ending in a slash."""
    # Written before it is filtered: filters that are pushed below would read and resolve each link again.
    each = pages.select(page, F.col(base).alias("_base"), F.explode_outer(links(F.col(html))).alias("l"))
    out = each.select(page, "_base", resolved(F.col("_base"), F.col("l.reference")).alias("href"), listing_time("l.before").alias("modified"))
    out = written(out, "links")
    below = F.startswith("href", F.col("_base")) & (F.col("href") != F.col("_base"))
    rest = F.substring(F.col("href"), F.length("_base") + 1, F.length("href"))
    named = out.where(below).withColumn("name", decoded(F.regexp_replace(rest, "/$", "")))
    return named.where(~F.col("name").contains("/")).select(page, "name", "href", F.endswith("href", F.lit("/")).alias("is_folder"), "modified").distinct()


def verify_versions(series: DataFrame, versions: DataFrame, rows: DataFrame, kinds: DataFrame | None = None) -> DataFrame:
    """Violations: current and previous versions whose rows don't have the recorded fingerprint (versions.n, f1, f2).
    rows has series, version and content. Series of an undeclared kind are skipped."""
    if kinds is not None:
        from codetables.operators.relations import active_series

        series = active_series(series, kinds)
    wanted = current_and_previous(series, versions)
    have = content_fingerprint(rows.join(wanted, ["series", "version"], "left_semi"), by=["series", "version"])
    said = wanted.join(versions.select(F.col("iri").alias("version"), F.col("n").alias("n0"), F.col("f1").alias("g1"), F.col("f2").alias("g2")), "version")
    both = said.join(have, ["series", "version"], "left")
    same = F.col("n").eqNullSafe(F.col("n0")) & F.col("f1").eqNullSafe(F.col("g1")) & F.col("f2").eqNullSafe(F.col("g2"))
    return both.where(~same).select("series", "version", F.lit("the rows are not those of the version").alias("message"))


def _code(iri: Column) -> Column:
    return F.concat(F.lit("`"), short_code(iri), F.lit("`"))


def _described(whole: bool) -> Column:
    """(text, order) of a row by its form: what it says as one readable line, and the parts that it is sorted by. whole: also
    with the parts that a line leaves out otherwise. _labels has the labels of its concepts."""
    c = F.col
    named = lambda iri: escape_markdown(F.coalesce(F.element_at("_labels", iri), short_code(iri)))
    said = lambda before, part: F.coalesce(F.concat(F.lit(before), part), F.lit(""))
    predicate = short_code(c("predicate_id"))
    place = F.when(c("sequence").isNotNull(), F.concat(F.lit(", at "), c("sequence").cast("string"), said(", ", c("required")))).otherwise("")
    reason = said(", justified by ", short_code(c("mapping_justification"))) if whole else F.lit("")
    mapping = F.concat(_code(c("subject_id")), F.lit(" → "), _code(c("object_id")), F.lit(" ("), predicate, place, reason, F.lit(")"))
    others = F.array_join(F.transform(F.array_sort("altLabel"), escape_markdown), "; ")
    names = F.concat(F.lit("`"), c("notation"), F.lit("`: "), escape_markdown(c("prefLabel")), F.when(F.size("altLabel") > 0, F.concat(F.lit(", also called "), others)).otherwise("") if whole else F.lit(""))
    replaced = F.array_join(F.transform(F.array_sort("replacedBy"), _code), ", ")
    retired = F.concat(_code(c("subject")), F.lit(": retired"), F.when(F.size("replacedBy") > 0, F.concat(F.lit(", replaced by "), replaced)).otherwise(""))
    classes = F.array_join(F.array_sort(F.transform("classification", named)), ", ")
    count = F.greatest(F.size("hgvs"), F.lit(0))
    classified = F.concat(
        _code(c("variation")), F.lit(": "), F.when(F.size("classification") > 0, classes).otherwise("no classification"), F.coalesce(F.concat(F.lit(" ("), named(c("reviewStatus")), F.lit(")")), F.lit("")),
        said(", ", c("lastEvaluated")), F.lit(", "), count.cast("string"), F.when(count == 1, " expression").otherwise(" expressions"),
    )
    is_mapping, is_names, is_class = c("form").isin("mapping", "member"), c("form") == "names", c("form") == "classification"
    text = F.when(is_mapping, mapping).when(is_names, names).when(is_class, classified).otherwise(retired)
    parts = F.when(is_mapping, F.array(short_code(c("subject_id")), predicate, short_code(c("object_id")), F.coalesce(c("sequence").cast("string"), F.lit(""))))
    parts = parts.when(is_names, F.array("notation")).when(is_class, F.array(short_code(c("variation")))).otherwise(F.array(short_code(c("subject"))))
    return F.struct(text.alias("text"), F.transform(F.array_append(parts, text), natural_sort_key).alias("order"))


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """rows with _labels, a map of the concepts that each names to their labels."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    if labels is None:
        return rows.withColumn("_labels", none)
    concepts = F.concat(F.coalesce("classification", F.array().cast("array<string>")), F.array("reviewStatus"))
    used = rows.where("form = 'classification'").select("series", "key", F.explode(F.array_distinct(concepts)).alias("concept")).join(labels.dropDuplicates(["concept"]), "concept")
    held = used.groupBy("series", "key").agg(F.map_from_entries(F.collect_list(F.struct("concept", "label"))).alias("_labels"))  # a row's own concepts
    return rows.join(held, ["series", "key"], "left").withColumn("_labels", F.coalesce("_labels", none))


def describe_changes(found: DataFrame, before: DataFrame, after: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(series, key, change, order, line): one line for each changed row, by its codes; a changed one in whole, and what it
    was. order: what lists are sorted by, numbers by value. labels(concept, label)."""
    changed = lambda rows: _labelled(rows.join(found.select("series", "key"), ["series", "key"], "left_semi"), labels)
    old = changed(before).select("series", "key", _described(False).alias("old"), _described(True)["text"].alias("old_whole"))
    new = changed(after).select("series", "key", _described(False).alias("new"), _described(True)["text"].alias("new_whole"), _described(True)["order"].alias("new_order"))
    both = found.join(old, ["series", "key"], "left").join(new, ["series", "key"], "left")
    is_changed = F.col("change") == "changed"
    line = F.when(is_changed, F.concat("new_whole", F.lit(" (was "), "old_whole", F.lit(")"))).otherwise(F.coalesce("new.text", "old.text"))
    order = F.when(is_changed, F.col("new_order")).otherwise(F.coalesce("new.order", "old.order"))
    return both.select("series", "key", "change", order.alias("order"), line.alias("line"))


def change_report(described: DataFrame, credit: str, note: dict[str, str], findings: list[str] = (), budget: int = 60_000, fold: int = 10, labels: dict[str, str] | None = None, names: dict[str, tuple[str | None, str | None]] | None = None) -> str:
    """A text of the changes: credit, and for each series its label, version and notes and three lists, folded from `fold`
    lines on and cut to the budget, which short lists leave to longer ones; then findings. note: of the series that have
    a new version; names: each series' version and the one it revises, null where there is none. Only lines that fit come
    to the driver."""
    tail = "\n## Findings\n\n" + "\n".join(f"- {f}" for f in findings) + "\n" if findings else ""
    names = names if names is not None else {s: ("", None) for s in note}
    sizes = {(r["series"], r["change"]): (r["size"], r["n"]) for r in described.groupBy("series", "change").agg(F.sum(F.length("line") + 3).alias("size"), F.count("*").alias("n")).collect()}
    groups = sorted(k for k in sizes if k[0] in note)
    shares = dict(zip(groups, share_budget(max(0, budget - len(tail)), [sizes[g][0] for g in groups])))
    # Every list is cut to its own share in one pass over all of them.
    limits = described.sparkSession.createDataFrame([(*g, s) for g, s in shares.items()], "series string, change string, _share long")
    lists = described.withColumn("_cost", F.length("line") + 3).join(F.broadcast(limits), ["series", "change"])
    shown: dict[tuple[str, str], list[str]] = {}
    for r in running(lists, ["series", "change"], ["order", "line"], "_cost").where("running <= _share").orderBy("series", "change", "rank").collect():
        shown.setdefault((r["series"], r["change"]), []).append(f"- {r['line']}")
    out = [credit, ""] if credit else []
    for series in sorted(names):
        version, previous = names[series]
        out += [f"## {(labels or {}).get(series, series)}", ""]
        if series not in note:
            out += ["Nothing new: its rows equal the current version's.", ""]
            continue
        out += [(f"`{version}`" + (f", revising `{previous}`" if previous else "") + ": " if version else "") + f"{note[series]}.", ""]
        for change in ("added", "removed", "changed"):
            n = sizes.get((series, change), (0, 0))[1]
            lines = shown.get((series, change), [])
            if n > len(lines):
                lines = [*lines, f"- and {n - len(lines)} more; the complete rows are in the release's rows files"]
            if n and n < fold:
                out += [f"{change.capitalize()} ({n}):", "", *lines, ""]
            elif n:
                out += [f"<details><summary>{change.capitalize()} ({n})</summary>", "", *lines, "", "</details>", ""]
    return "\n".join(out) + tail


def release_manifests(inputs: DataFrame) -> DataFrame:
    """(source, tag, titles): for each source its files, and the source with 12 digits of the hash of their checksums in the
    order of their titles. inputs(source, title, checksum); a release has a handful of files."""
    listed = inputs.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("title", "checksum"))).alias("x"))
    digest = F.sha2(F.array_join(F.col("x.checksum"), "\n"), 256)
    return listed.select("source", F.concat("source", F.lit("-"), F.substring(digest, 1, 12)).alias("tag"), F.col("x.title").alias("titles"))


def with_content(rows: DataFrame) -> DataFrame:
    if "content" in rows.columns:
        return rows.select(*COLUMNS, "content")
    return rows.select(*COLUMNS).withColumn("content", row_content())


def union_rows(*rows: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)
