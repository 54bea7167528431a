"""Writers: canonical lines, versions, the catalog, and digests of input files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.functions.rows import COLUMNS, row_lines


def write_rows_nquads(rows: DataFrame, graph: str, path: str, parts: int | None = None) -> None:
    """The rows' lines in the graph of their version, each once, in order over all parts, gzipped."""
    lines = rows.select(F.explode(row_lines()).alias("line")).distinct()
    quads = lines.select(F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit(f"<{graph}> .")).alias("value"))
    ordered = quads.repartitionByRange(parts, "value") if parts else quads.repartitionByRange("value")
    ordered.sortWithinPartitions("value").write.text(path, compression="gzip")


def write_version(rows: DataFrame, path: str, version: str) -> None:
    """Each series' rows in the folder of their version. Writing a version again replaces its folder and no other."""
    out = rows.select(*COLUMNS).withColumn("version", F.lit(version)).write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("series", "version").parquet(path)


def read_version(spark: SparkSession, path: str, series: str, version: str) -> DataFrame:
    """The rows of a version; only its folder is read."""
    found = spark.read.parquet(path).where((F.col("series") == series) & (F.col("version") == version))
    return found.select(*COLUMNS)


def file_digests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, sha256 (hex) and name (ni:) of each file's bytes."""
    files = spark.read.format("binaryFile").load(paths)
    digest = F.sha2("content", 256)
    named = F.concat(F.lit("ni:///sha-256;"), F.translate(F.regexp_replace(F.base64(F.unhex(digest)), "=+$", ""), "+/", "-_"))
    return files.select("path", digest.alias("sha256"), named.alias("name"))
