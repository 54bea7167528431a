"""Aggregations, ranks and budgets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetables.operators.scans import least, running


def ambiguous_keys(pairs: list[DataFrame], key: str, owner: str) -> DataFrame:
    """Keys that more than one owner has over all inputs, with the least and the greatest of them."""
    both = reduce(DataFrame.union, [p.select(key, owner) for p in pairs])
    return both.groupBy(key).agg(F.min(owner).alias("first_owner"), F.max(owner).alias("last_owner")).where("first_owner <> last_owner")


def unique_across_rows(df: DataFrame, value: str, key: str) -> DataFrame:
    """Violations: values on more than one row, naming both."""
    found = ambiguous_keys([df], value, key)
    return found.select(F.col(value).cast("string").alias("key"), F.concat_ws(" ", F.lit("is on"), "first_owner", F.lit("and"), "last_owner").alias("message"))


def prefer_source(df: DataFrame, key: str, source: str, order: list[str], line: str, columns: list[str]) -> DataFrame:
    """One statement for each key: the last of the most preferred source that has one, else the first seen. Preferred
    statements come as structs s0, s1, ... for disagreements()."""
    value = F.struct(*columns)
    last = [F.max_by(value, F.when(F.col(source) == s, F.col(line))).alias(f"s{k}") for k, s in enumerate(order)]
    has = [F.max(F.col(source) == s).alias(f"h{k}") for k, s in enumerate(order)]
    found = df.groupBy(key).agg(*last, *has, F.min_by(value, line).alias("first"))
    held = [F.when(F.col(f"h{k}"), F.col(f"s{k}")) for k in range(len(order))]
    out = found.withColumns({f"s{k}": h for k, h in enumerate(held)})
    chosen = F.coalesce(*[F.col(f"s{k}") for k in range(len(order))], "first")
    return out.withColumn("chosen", chosen).select(key, "chosen.*", *[f"s{k}" for k in range(len(order))])


def disagreements(preferred: DataFrame, key: str) -> DataFrame:
    """Keys whose two preferred statements differ in any column."""
    return preferred.where("s0 is not null and s1 is not null").where(~F.col("s0").eqNullSafe(F.col("s1"))).select(key)


def last_by_order(df: DataFrame, key: str, value: str, line: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, line).alias(value))


def first_by_order(df: DataFrame, key: str, value: str, line: str) -> DataFrame:
    return df.groupBy(key).agg(F.min_by(value, line).alias(value))


def group_findings(df: DataFrame, kind: str, term: str, ident: str, examples: int = 5) -> DataFrame:
    """For each kind and term the number of ids and the first examples; ids that are numbers in their order, behind others.
    Every task counts and keeps its first ones, so no term's ids meet in one task."""
    number = F.expr(f"try_cast({ident} as long)")
    # As text in the order of the numbers: sixteen digits of the number above the least one.
    ordered = F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    sortable = F.when(number.isNull(), F.concat(F.lit("0"), F.col(ident).cast("string"))).otherwise(F.concat(F.lit("1"), ordered, F.col(ident).cast("string")))
    distinct = df.select(kind, term, sortable.alias("_id")).distinct()
    found = least(distinct, [kind, term], "_id", examples)
    named = F.transform("least", lambda x: F.when(F.startswith(x, F.lit("0")), F.substring(x, 2, 1 << 30)).otherwise(F.substring(x, 18, 1 << 30)))
    return found.select(kind, term, "n", F.array_join(named, ", ").alias("examples"))


def collect_replacements(retired: DataFrame, mapped: DataFrame, code: str, replacement: str) -> DataFrame:
    """Each retired code with its sorted distinct replacements; an empty list if it has none."""
    both = retired.select(code).distinct().join(mapped, code, "left")
    return both.groupBy(code).agg(F.array_sort(F.collect_set(replacement)).alias("replaced_by"))


def set_expressions(parts: list[DataFrame], key: str, value: str, ambiguous: DataFrame) -> DataFrame:
    """The sorted distinct values of each key over all parts, without ambiguous ones."""
    both = reduce(DataFrame.union, [p.select(key, value) for p in parts]).where(F.col(value).isNotNull()).distinct()
    return both.join(ambiguous.select(value), value, "left_anti").groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("values"))


def exclude_groups_with(df: DataFrame, key: str, flag: Column) -> DataFrame:
    """Drops whole groups that have the flag on any row."""
    flagged = df.groupBy(key).agg(F.max(F.coalesce(flag, F.lit(False))).alias("f")).where("f").select(key)
    return df.join(flagged, key, "left_anti")


def latest_check(checks: DataFrame, order: str = "n") -> DataFrame:
    """Each source's latest check; of several at a time the first."""
    return checks.groupBy("source").agg(F.max_by(F.struct(*[c for c in checks.columns if c != "source"]), F.struct(F.col("at"), -F.col(order))).alias("c")).select("source", "c.*")


def inputs_held(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy("title").agg(F.array_sort(F.collect_set("checksum")).alias("checksums"), F.max("modified").alias("modified"))


def exactly_one_current(entries: DataFrame) -> DataFrame:
    """Violations: lists that don't mark exactly one complete entry as current. entries(list, current, complete)."""
    found = entries.groupBy("list").agg(F.sum(F.when(F.col("current") & F.col("complete"), 1).otherwise(0)).alias("n"))
    return found.where("n <> 1").select(F.col("list").alias("key"), F.concat(F.lit("marks "), F.col("n").cast("string"), F.lit(" entries as current")).alias("message"))


def release_label(inputs: DataFrame, source: str = "source") -> DataFrame:
    """A release's label: the day of the newest modified time, else unlabelled."""
    return inputs.groupBy(source).agg(F.coalesce(F.date_format(F.max("modified"), "yyyy-MM-dd"), F.lit("unlabelled")).alias("label"))


def listing_label(taken: DataFrame) -> DataFrame:
    """(source, day, label): the newest date of the folders that a listing's files were taken from."""
    return taken.groupBy("source", "day").agg(F.date_format(F.max("effective"), "yyyy-MM-dd").alias("label"))


def pick_copy(copies: DataFrame, group: str, root: Column, parent: str) -> DataFrame:
    """Of several copies of a group its own one, else that of the lowest parent."""
    one = copies.select(group, parent, root.alias("_root")).distinct()
    one = one.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.col("_root").desc(), F.expr(f"try_cast({parent} as long)").asc_nulls_last(), parent))).where("_r = 1")
    return copies.join(one.select(group, parent), [group, parent], "left_semi")


def budget_lines(lines: DataFrame, group: str, order: str, text: str, share: int) -> tuple[DataFrame, DataFrame]:
    """The lines of each list, with their rank, that fit in a share (a line costs its length and 3), and how many more
    there are. A list of any length is many tasks: see `running`."""
    placed = running(lines.withColumn("_cost", F.length(text) + 3), [group], [order, text], "_cost")
    shown = placed.where(F.col("running") <= share)
    more = placed.groupBy(group).agg(F.sum(F.when(F.col("running") <= share, 0).otherwise(1)).alias("more"))
    return shown.select(*lines.columns, "rank"), more


def share_budget(budget: int, sizes: list[int]) -> list[int]:
    """One budget over lists: what short lists leave goes to longer ones. A handful of numbers."""
    shares = [0] * len(sizes)
    left, open_ = budget, sorted(range(len(sizes)), key=lambda k: sizes[k])
    for n, k in enumerate(open_):
        shares[k] = min(sizes[k], left // (len(open_) - n))
        left -= shares[k]
    return shares


def current_and_previous(series: DataFrame, versions: DataFrame) -> DataFrame:
    """(series, version, role): each series' current version and the one it revises."""
    current = series.select(F.col("iri").alias("series"), F.col("current_version").alias("version")).where("version is not null")
    revised = current.join(versions.select(F.col("iri").alias("version"), "revises"), "version").where("revises is not null")
    return current.withColumn("role", F.lit("current")).unionByName(revised.select("series", F.col("revises").alias("version"), F.lit("previous").alias("role")))
