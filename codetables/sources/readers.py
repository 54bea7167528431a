"""Readers of messy release files. Everything is read as text; nothing is inferred."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetables.sources.shared import written


#: Blocks of files whose starts are broadcast at most; more of them are joined.
MAX_BROADCAST_BLOCKS = 200_000


class Refusal(Exception):
    """A release that can't be built: nothing is written."""


def numbered(df: DataFrame) -> DataFrame:
    """df (file, block, value) with `number`, the line's number in its file from 1, by the sizes of the blocks before it.

    Lines keep their order within a partition, and a partition holds whole blocks of a file. The blocks' starts are a row
    each and are broadcast, up to a number of them, so no line is shuffled."""
    placed = df.withColumn("_row", F.monotonically_increasing_id())
    firsts = placed.groupBy("file", "block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.select("file", "block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    starts = written(starts, "block-starts")
    few = starts.count() <= MAX_BROADCAST_BLOCKS
    return placed.join(F.broadcast(starts) if few else starts, ["file", "block"]).withColumn("number", F.col("_row") - F.col("_first") + F.col("_before") + 1)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, number and value of the lines that aren't empty; blank ones count. BOM, CR before LF and gzip are undone."""
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    # Only lines that hold a CR meet the pattern.
    bare = F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    out = numbered(lines).select("file", "number", bare.alias("value"))
    bare = F.when(F.col("number") == 1, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    return out.withColumn("value", bare).where("value <> ''")


def read_delimited(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """file, number, fields: each line cut at a literal separator; empty fields stay and quotes are ordinary."""
    return read_lines(spark, path).select("file", "number", F.split("value", f"\\Q{sep}\\E", -1).alias("fields"))


def read_fixed_width(spark: SparkSession, path: str, fields: dict[str, tuple[int, int | None]]) -> DataFrame:
    """number and the named fields, cut by columns (from 0, end excluded; None: to the line's end)."""

    def cut(start: int, end: int | None) -> Column:
        return F.trim(F.substring("value", start + 1, (1 << 30) if end is None else end - start))

    return read_lines(spark, path).select("number", *[cut(*at).alias(name) for name, at in fields.items()])


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """number, parsed (null where a line isn't of the schema) and the line."""
    return read_lines(spark, path).select("number", F.from_json("value", schema).alias("parsed"), "value")


def read_xml_elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The elements of a name, nested children as structs and arrays; mismatched tags fail the job."""
    return spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST").schema(schema).load(path)


_CELL = re.compile(r"([A-Z]+)\d+")
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_TARGETS = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"


def _text_of(item) -> str:
    """The text of a string item, without its phonetic runs."""
    spoken = {t for run in item.iter(f"{_NS}rPh") for t in run.iter(f"{_NS}t")}
    return "".join(t.text or "" for t in item.iter(f"{_NS}t") if t not in spoken)


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The part of the sheet that the workbook names first; without a workbook part the sheet of least number."""
    names = book.namelist()
    if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= set(names):
        sheet = next(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_NS}sheet"), None)
        parts = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter(_TARGETS)}
        if sheet is not None and sheet.get(_RELATION) in parts:
            target = parts[sheet.get(_RELATION)]
            return target[1:] if target.startswith("/") else f"xl/{target}"
    return min((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))


def _sheet_rows(content: bytes):
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_NS}si"):
                shared.append(_text_of(item))
        with book.open(_first_sheet(book)) as sheet:
            number = 0
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_NS}row":
                    continue
                cells: dict[int, str] = {}
                column, number = 0, int(row.get("r", number + 1))
                for cell in row.iter(f"{_NS}c"):
                    named = _CELL.match(cell.get("r", ""))
                    if named:
                        column = 0
                        for letter in named[1]:
                            column = column * 26 + ord(letter) - 64
                    else:
                        column += 1
                    value = cell.find(f"{_NS}v")
                    kind = cell.get("t")
                    if kind == "s":
                        text = shared[int(value.text)]
                    elif kind == "inlineStr":
                        text = _text_of(cell)
                    else:
                        text = value.text or "" if value is not None else ""
                    cells[column - 1] = text
                yield number, [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]
                row.clear()


def read_xlsx_first_sheet(spark: SparkSession, path: str) -> DataFrame:
    """file, number and fields of the first sheet's rows; one task reads a workbook."""
    import pandas as pd

    def emit(batches):
        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"]):
                rows = list(_sheet_rows(content))
                yield pd.DataFrame({"file": file, "number": [n for n, _ in rows], "fields": [f for _, f in rows]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(emit, "file string, number long, fields array<string>")


def read_zip_entries(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """zip, entry and content of the entries whose name matches; a false zip fails the job."""
    import pandas as pd

    def emit(batches):
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for entry in archive.namelist():
                        if re.search(pattern, entry, re.IGNORECASE):
                            yield pd.DataFrame([(name, entry, archive.read(entry))], columns=["zip", "entry", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(emit, "zip string, entry string, content binary")


#: Names of a release's listing, or files of a table, that are broadcast at most.
MAX_BROADCAST_FILES = 100_000


def read_headed_tsv(spark: SparkSession, path: str | list[str], required: list[str], optional: list[str] = ()) -> DataFrame:
    """number and the wanted columns by name, whatever their order. The header is a file's first line of several fields,
    its first character dropped; lines before it are prose. A missing optional column is null. A table in several files
    has the same header in each."""
    lines = read_lines(spark, path)
    tabbed = F.when(F.col("value").contains("\t"), F.col("number"))
    starts = written(lines.groupBy("file").agg(F.min(tabbed).alias("_start")), "headers")
    none = starts.where("_start is null").select("file").orderBy("file").limit(1).collect()
    files = starts.count()
    if none or not files:
        raise Refusal(f"{none[0]['file'] if files > 1 else path} has no header")
    lines = lines.join(F.broadcast(starts) if files <= MAX_BROADCAST_FILES else starts, "file")
    heads = [r["value"] for r in lines.where("number = _start").select("value").distinct().orderBy("value").limit(2).collect()]
    if len(heads) > 1:
        raise Refusal(f"{path} has files of different headers")
    names = heads[0][1:].split("\t")
    missing = [c for c in required if c not in names]
    if missing:
        raise Refusal(f"{path} has no column {missing[0]}")
    fields = F.split("value", "\t", -1)
    wanted = [(F.get(fields, F.lit(names.index(c))) if c in names else F.lit(None).cast("string")).alias(c) for c in [*required, *optional]]
    return lines.where("number > _start").select("number", *wanted)


def pick_release_files(files: DataFrame, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The one file (name) for each title whose pattern it matches, whatever its case; titles with none or several."""
    few = files.limit(MAX_BROADCAST_FILES + 1).count() <= MAX_BROADCAST_FILES
    matched = patterns.join(F.broadcast(files) if few else files, F.expr("name rlike concat('(?i)', pattern)"), "left")
    found = matched.groupBy("title").agg(F.count("name").alias("n"), F.min("name").alias("name"))
    wrong = found.where("n <> 1").select("title", F.when(F.col("n") == 0, "no file matches").otherwise("several files match").alias("message"))
    return found.where("n = 1").select("title", "name"), wrong


_TERM = r'(<[^>]*>|"(?:[^"\\]|\\.)*"(?:\^\^<[^>]*>|@[A-Za-z-]+)?)'
_QUAD = rf"^<([^>]*)> <([^>]*)> {_TERM}(?: <([^>]*)>)? \.$"


_ESCAPED = r"\\U[0-9A-Fa-f]{8}|(?:\\u[0-9A-Fa-f]{4})+|\\.|[^\\]+"


def unescaped(text: Column) -> Column:
    """A literal's characters: code points of four digits (also as surrogate pairs) and of eight, and single letters."""
    letters = F.create_map(*[F.lit(x) for kv in {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}.items() for x in kv])

    def plain(t: Column) -> Column:
        last = F.substring(t, 2, 1)
        wide = F.decode(F.unhex(F.substring(t, 3, 8)), "UTF-32")
        short = F.decode(F.unhex(F.replace(t, F.lit("\\u"), F.lit(""))), "UTF-16BE")
        return F.when(~F.startswith(t, F.lit("\\")), t).when(F.startswith(t, F.lit("\\U")) & (F.length(t) == 10), wide).when(F.startswith(t, F.lit("\\u")) & (F.length(t) > 2), short).otherwise(F.coalesce(F.try_element_at(letters, last), last))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_ESCAPED), F.lit(0)), plain), "")


def read_nquads(spark: SparkSession, path: str) -> DataFrame:
    """subject, predicate, object, kind (iri, a datatype, @language or null), graph, with escapes undone, and `ok`:
    false for a line of another form."""
    lines = read_lines(spark, path)
    part = lambda k: F.regexp_extract("value", _QUAD, k)
    term = part(3)
    text = F.regexp_extract(term, r'^"((?:[^"\\]|\\.)*)"', 1)
    plain = F.when(text.contains("\\"), unescaped(text)).otherwise(text)
    suffix = F.regexp_extract(term, r'"(?:\^\^<([^>]*)>)?(@[A-Za-z-]+)?$', 1)
    language = F.regexp_extract(term, r'"(@[A-Za-z-]+)$', 1)
    iri = F.startswith(term, F.lit("<"))
    return lines.select(
        part(1).alias("subject"),
        part(2).alias("predicate"),
        F.when(iri, F.substring(term, 2, F.length(term) - 2)).otherwise(plain).alias("object"),
        F.when(iri, "iri").when(suffix != "", suffix).when(language != "", language).alias("kind"),
        part(4).alias("graph"),
        F.col("value").rlike(_QUAD).alias("ok"),
    )
