"""Strict quoted CSV in many tasks, however large a file is and wherever it is split.

Whether a line begins inside a quoted field depends on all quotes before it, so a split can't know by itself. But what a
split does to that state is one bit: it keeps it or flips it, as its number of quotes is even or odd. The splits' bits
and numbers of lines are scanned in the order of the file, one row a split; then each split cuts its own records, from
its known state on. The pieces of a record that crosses splits are put together by the record's number; they are two a
split at most. No other line is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetables.sources.readers import Refusal
from codetables.sources.shared import written

#: Splits whose starts are broadcast at most; more of them are joined.
MAX_BROADCAST_SPLITS = 200_000
_FIELD = re.compile(r'(?:"((?:[^"]|"")*)"|([^",]*))(,|\Z)')
_QUOTED = re.compile(r'"(?:[^"]|"")*("?)')
STRAY = "a quote is inside a field that isn't quoted"
BEHIND = "a character follows a closing quote"
OPEN = "a quote is open at the end"
_CUT = "file string, block long, number long, kind string, fields array<string>, text string, problem string, line long"


def fields_of(text: str) -> tuple[list[str], str | None, int]:
    """The fields of a record, what is wrong with it and at which of its lines (from 0)."""
    if '"' not in text:
        return text.split(","), None, 0
    out, at = [], 0
    while True:
        m = _FIELD.match(text, at)
        if m is None:
            whole = _QUOTED.match(text, at)
            if whole is None:
                return out, STRAY, text.count("\n", 0, text.index('"', at))
            return out, OPEN if whole.end() == len(text) and not whole[1] else BEHIND, text.count("\n", 0, whole.end())
        out.append(m[2] if m[1] is None else m[1].replace('""', '"'))
        if not m[3]:
            return out, None, 0
        at = m.end()


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def split_starts(lines: DataFrame) -> DataFrame:
    """file, block, before (lines in earlier splits), open (whether a quoted field goes on at its start), n, odd; written,
    a row for each split."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    each = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.sum(quotes).bitwiseAND(1).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    opened = F.coalesce(F.sum("odd").over(earlier), F.lit(0)).bitwiseAND(1) == 1
    return written(each.select("file", "block", before.alias("before"), opened.alias("open"), "n", "odd"), "csv-splits")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From lines (file, block, before, open, value), whole splits in order, to records and pieces of records. Kinds: record;
    end, the rest of a record that began earlier; begin, the start of one that goes on; middle, a split without a record's end."""
    names = [x.split()[0] for x in _CUT.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64()]
    out: list[tuple] = []
    split, number, held, inside, crossed = None, 0, [], False, False

    def record(text: str) -> None:
        text = text.removesuffix("\r")
        if text:
            fields, problem, at = fields_of(text)
            out.append((*split, number, "record", fields, None, problem, number - text.count("\n") + at if problem else None))

    def leave() -> None:
        if held and crossed:
            out.append((*split, number, "middle", None, "\n".join(held), None, None))
        elif held:
            # What is wrong already can't be mended by what follows.
            _, problem, at = fields_of("\n".join(held))
            wrong = problem not in (None, OPEN)
            out.append((*split, number, "begin", None, None if wrong else "\n".join(held), problem if wrong else None, number - len(held) + 1 + at if wrong else None))

    for batch in batches:
        for file, block, before, opened, value in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != split:
                leave()
                split, number, held, inside, crossed = (file, block), before, [], opened, opened
            number += 1
            if number == 1:
                value = value.removeprefix("﻿")
            held.append(value)
            inside ^= value.count('"') % 2 == 1
            if not inside:
                if crossed:
                    out.append((*split, number, "end", None, "\n".join(held), None, None))
                    crossed = False
                else:
                    record("\n".join(held))
                held = []
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                out = []
    leave()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def read_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(file, number, fields, problem, line) of all records that aren't empty, numbered by the line they end on, with what is
    wrong and on which line; and the starts of the splits."""
    lines = _lines(spark, path)
    starts = split_starts(lines)
    few = starts.count() <= MAX_BROADCAST_SPLITS
    known = starts.select("file", "block", "before", "open")
    if few:
        placed = lines.join(F.broadcast(known), ["file", "block"])
    else:  # a join that shuffles mixes lines: their order is that of their places in the scan
        placed = lines.withColumn("_row", F.monotonically_increasing_id()).join(known, ["file", "block"])
        placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "_row")
    cut = written(placed.select("file", "block", "before", "open", "value").mapInArrow(_cut, _CUT), "csv-records")
    # A record's pieces: its beginning, whole splits, its end. Beginnings up to a piece are its record's number.
    pieces = cut.where("kind <> 'record'")
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("kind") == "end", 0).otherwise(1))
    nth = F.sum(F.when(F.col("kind") == "begin", 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    pieces = written(pieces.withColumn("nth", nth), "csv-pieces")
    # A quote in a wrong place may open a record that never ends: such pieces are not gathered.
    bad = pieces.where("problem is not null")
    whole = pieces.join(bad.select("file", "nth"), ["file", "nth"], "left_anti").groupBy("file", "nth").agg(
        F.max("number").alias("number"), F.max(F.col("kind") == "end").alias("ended"),
        F.when(F.max(F.col("kind") == "end"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n")).alias("text"),
    )

    @F.pandas_udf("fields array<string>, problem string, line long")
    def parsed(text: pd.Series) -> pd.DataFrame:
        found = [(x, fields_of(x)) for x in (t.removesuffix("\r") for t in text)]
        return pd.DataFrame([(f, p, at - t.count("\n")) for t, (f, p, at) in found], columns=["fields", "problem", "line"])

    stitched = whole.where("ended").withColumn("p", parsed("text")).select("file", "number", "p.fields", "p.problem", F.when(F.col("p.problem").isNotNull(), F.col("number") + F.col("p.line")).alias("line"))
    cols = ["file", "number", "fields", "problem", "line"]
    return cut.where("kind = 'record'").select(*cols).unionByName(bad.select(*cols)).unionByName(stitched), starts


def read_csv_strict(spark: SparkSession, path: str | list[str], required: list[str] = ()) -> DataFrame:
    """A quoted CSV (or several of one header): all columns as text, and number, the line in its file that a record ends
    on. Refused by file and line: a record of another width, a quote where none may be, a quote that is open at the end;
    by file: no record, no header, a missing required column, another header than the first file's."""
    records, starts = read_records(spark, path)
    name = lambda file: file.rsplit("/", 1)[-1]
    header = records.groupBy("file").agg(F.min_by("fields", "number").alias("header"), F.min_by("problem", "number").alias("problem"), F.min_by("line", "number").alias("line"), F.min("number").alias("first"), F.count("*").alias("n"))
    header = written(header, "csv-headers")
    for bad in header.where("problem is not null").orderBy("file").limit(1).collect():
        raise Refusal(f"{name(bad['file'])} line {bad['line']}: {bad['problem']}")
    heads = header.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").limit(2).collect()
    if not heads:
        raise Refusal(f"{path} is empty")
    columns = heads[0]["header"]
    for column in required:
        if column not in columns:
            raise Refusal(f"{name(heads[0]['file'])} has no column {column}")
    if len(heads) > 1:
        raise Refusal(f"{name(heads[1]['file'])} has another header than {name(heads[0]['file'])}")
    wide = F.size("fields") != len(columns)
    said = F.concat(F.lit("the record has "), F.size("fields").cast("string"), F.lit(f" fields, not {len(columns)}"))
    message = F.coalesce("problem", F.when(wide, said))
    ends = starts.groupBy("file").agg((F.sum("odd") % 2 == 1).alias("open"), F.sum("n").alias("number")).where("open")
    wrong = records.withColumn("message", message).where("message is not null").select("file", F.coalesce("line", "number").alias("number"), "message")
    wrong = wrong.unionByName(ends.select("file", "number", F.lit(OPEN).alias("message")))
    # What a reader from the first line on would meet first.
    found = wrong.orderBy("file", "number").limit(1).collect()
    if found:
        raise Refusal(f"{name(found[0]['file'])} line {found[0]['number']}: {found[0]['message']}")
    if header.where("n > 1").isEmpty():
        raise Refusal(f"{path} is empty")
    body = records.join(header.select("file", F.col("first").alias("number")), ["file", "number"], "left_anti")
    return body.select(*[F.get("fields", F.lit(k)).alias(c) for k, c in enumerate(columns)], "number")
