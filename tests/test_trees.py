"""Comparing stored versions: the same rows as a full comparison, few buckets read, no exchange."""

import random

from codetables.operators import versions as V
from codetables.sources import trees


def frames(spark):
    rng = random.Random(1)
    rows = [(rng.choice("st"), f"k{k}", f"c{rng.randrange(5)}") for k in range(2000)]
    after = [(s, k, c if n % 400 else c + "x") for n, (s, k, c) in enumerate(rows) if n % 700] + [("s", "new", "c"), ("u", "only", "c")]
    return [spark.createDataFrame(r, "series string, key string, content string") for r in (rows, after)]


def test_trees(spark, tmp_path):
    before, after = frames(spark)
    path = str(tmp_path)
    trees.write_tree_version(before, path, "1")
    trees.write_tree_version(after, path, "2")
    trees.write_tree_version(before.repartition(7), path, "3")
    found, said = trees.tree_diff(spark, path, "1", "2")
    want = sorted(map(tuple, V.diff(before, after).collect()))
    assert sorted(map(tuple, found.collect())) == want and 0 < said["read"] <= len(want) < said["buckets"] / 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1]
    same, said = trees.tree_diff(spark, path, "1", "3")
    assert said["read"] == 0 and same.isEmpty()
    assert trees.read_tree(spark, path, "1").where("prefix = ''").count() == 2  # a root for each series


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange(spark):
    before, after = frames(spark)
    a, b = (trees.write_bucketed(df, ["series", "key"], 4) for df in (before, after))
    found = trees.diff_bucketed(spark, a, b)
    assert "Exchange" not in plan_of(found) and sorted(map(tuple, found.collect())) == sorted(map(tuple, V.diff(before, after).collect()))
    double = trees.write_bucketed(before.union(spark.createDataFrame([("s", "k0", "other"), ("t", "k0", "other")], before.schema)), ["series", "key"], 4)
    wrong = trees.conflicts_bucketed(spark, double)
    assert "Exchange" not in plan_of(wrong) and [r["key"] for r in wrong.collect()] == ["k0"]
    current = trees.write_bucketed(before.withColumnRenamed("key", "code"), ["code"], 4)
    named = trees.write_bucketed(after.selectExpr("key AS code").distinct(), ["code"], 4)
    left = trees.left_bucketed(spark, current, named)
    assert "Exchange" not in plan_of(left) and {r["code"] for r in left.collect()} == {"k0", "k700", "k1400"}
    for name in (a, b, double, current, named):
        spark.sql(f"DROP TABLE {name}")
