"""Versions that are compared without reading what they share, and tables that are joined without an exchange.

A version is stored in buckets by the first digits of its keys' hashes. A hash tree goes with it: a leaf's hash covers
the keys and contents of its bucket, whatever their order, a node's those of its sixteen children. Two versions are
compared from the root down, only below nodes that differ, and then only the rows of leaves that differ are read. What a
comparison costs so goes with what has changed, up to a bucket's size, and not with the versions' size.

Bucketed tables keep rows hashed and sorted by their key: comparing, merging or carrying forward such tables of one
number of buckets is a sort-merge join in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.operators.versions import diff
from codetables.sources.shared import shared_path

#: Levels of a tree below its root: 256 buckets.
DEPTH = 2


def _bucket(depth: int):
    return F.substring(F.sha2("key", 256), 1, depth)


def write_tree_version(rows: DataFrame, path: str, version: str, depth: int = DEPTH) -> None:
    """Rows (series, key, content and others) in buckets, sorted by key, and each series' tree: (series, prefix, hash, n)."""
    placed = rows.withColumns({"version": F.lit(version), "bucket": _bucket(depth)})
    placed.repartition("series", "bucket").sortWithinPartitions("series", "bucket", "key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("series", "version", "bucket").parquet(f"{path}/rows")
    half = lambda k: F.sum(F.conv(F.substring("h", k, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    each = rows.select("series", _bucket(depth).alias("prefix"), F.sha2(F.concat_ws("|", "key", "content"), 256).alias("h"))
    level = each.groupBy("series", "prefix").agg(F.count("*").alias("n"), half(1).alias("f1"), half(17).alias("f2"))
    level = level.select("series", "prefix", F.sha2(F.concat_ws("|", "n", "f1", "f2"), 256).alias("hash"), "n")
    tree = level
    for size in range(depth - 1, -1, -1):
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("prefix", "hash"))), lambda c: F.concat(c["prefix"], c["hash"])), "|")  # sixteen
        level = level.groupBy("series", F.substring("prefix", 1, size).alias("up")).agg(F.sha2(children, 256).alias("hash"), F.sum("n").alias("n")).withColumnRenamed("up", "prefix")
        tree = tree.unionByName(level)
    tree.coalesce(1).write.mode("overwrite").parquet(f"{path}/trees/version={version}")


def read_tree(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{path}/trees/version={version}")


def differing_leaves(before: DataFrame, after: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(series, prefix) of the leaves whose hashes differ, from the root down."""
    open_ = before.select("series").union(after.select("series")).distinct().withColumn("up", F.lit(""))
    for size in range(depth + 1):
        level = lambda t, name: t.where(F.length("prefix") == size).select("series", "prefix", F.col("hash").alias(name))  # noqa: E731, B023
        both = level(before, "a").join(level(after, "b"), ["series", "prefix"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        both = both.withColumn("up", F.substring("prefix", 1, max(0, size - 1)))
        open_ = both.join(open_, ["series", "up"], "left_semi").select("series", F.col("prefix").alias("up"))
    return open_.withColumnRenamed("up", "prefix")


def tree_diff(spark: SparkSession, path: str, before: str, after: str, depth: int = DEPTH) -> tuple[DataFrame, dict[str, int]]:
    """The changes (series, key, change) between two stored versions, and how many buckets there are and were read."""
    a, b = read_tree(spark, path, before), read_tree(spark, path, after)
    leaves = differing_leaves(a, b, depth)
    prefixes = sorted({r["prefix"] for r in leaves.select("prefix").distinct().collect()})  # at most 16**depth
    every = a.where(F.length("prefix") == depth).select("prefix").union(b.where(F.length("prefix") == depth).select("prefix")).distinct().count()
    stored = spark.read.option("basePath", f"{path}/rows").schema(_stored_schema(spark, path)).parquet(f"{path}/rows")
    read = lambda version: stored.where((F.col("version") == version) & F.col("bucket").isin(prefixes)).select("series", "key", "content")
    return diff(read(before), read(after)), {"buckets": every, "read": len(prefixes)}


def _stored_schema(spark: SparkSession, path: str):
    """The stored rows' schema with its partition columns as text: a bucket such as 10 is no number."""
    found = spark.read.parquet(f"{path}/rows").schema
    for f in found.fields:
        if f.name in ("series", "version", "bucket"):
            f.dataType = type(found["key"].dataType)()
    return found


# ---- tables that need no exchange


def write_bucketed(rows: DataFrame, keys: list[str], buckets: int, name: str | None = None) -> str:
    """A table of rows hashed into buckets by their keys and sorted by them inside; its name."""
    spark = rows.sparkSession
    table = name or f"bucketed_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", shared_path(spark, table))
    writer.saveAsTable(table)
    return table


def diff_bucketed(spark: SparkSession, before: str, after: str) -> DataFrame:
    """V1 on two tables bucketed by (series, key): a join without an exchange."""
    return diff(spark.table(before).hint("merge"), spark.table(after).hint("merge"))


def conflicts_bucketed(spark: SparkSession, table: str) -> DataFrame:
    """E3's violations on a table bucketed by (series, key): keys of two contents, grouped in place."""
    kept = spark.table(table).groupBy("series", "key").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    return kept.where("a <> b").select("series", "key", F.lit("a row of the same key has other content").alias("message"))


def left_bucketed(spark: SparkSession, current: str, named: str) -> DataFrame:
    """V6's anti-join: the current rows, bucketed by code, of codes that the table of named codes, bucketed the same, lacks."""
    return spark.table(current).hint("merge").join(spark.table(named).hint("merge"), "code", "left_anti")
