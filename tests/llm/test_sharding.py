"""Shards against all sums of the sorted documents, with heavy groups, equal rows and parts of any size."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from codetables.llm import sharding

SCHEMA = "doc_id long, text string, shard string, _h string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.Generator(np.random.PCG64(8))
    out = [(k, "w" * int(rng.integers(0, 200)) + str(k)) for k in range(400)]
    out += [(1000 + k, "a group of copies, a third of all") for k in range(250)]
    out += [(7, "the same row")] * 40 + [(None, None), (None, "é" * 50), (None, None), (5000, ""), (5001, "x" * 3000)]
    return out


def by_hand(rows, shards, percent=0.5):
    """(doc_id, text, shard, slot) by the sums of all documents in order."""
    h = lambda t: int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16)
    size = lambda t: len((t or "").encode()) + 8
    order = sorted(rows, key=lambda r: (h(r[1]), -(1 << 63) if r[0] is None else r[0]))
    below = np.cumsum([0, *[size(t) for _, t in order]])
    groups = [h(t) for _, t in order]
    cuts = []
    for k in range(1, shards):
        want = below[-1] * k / shards
        r = int(np.searchsorted(below, want, "right")) - 1
        a, b = groups.index(groups[r]), len(groups) - groups[::-1].index(groups[r])
        off, cut = min((abs(below[x] - want), x) for x in (a, b))
        if off > percent / 100 * below[-1] / shards:
            cut = r if want - below[r] <= below[r + 1] - want else r + 1
        cuts.append(cut)
    slots, out = defaultdict(int), []
    for r, (i, t) in enumerate(order):
        s = sum(c <= r for c in cuts)
        out.append((i, t, s, slots[s]))
        slots[s] += 1
    return out


@pytest.mark.parametrize(("shards", "part_rows"), [(24, 10**6), (5, 20), (1, 10**6)])
def test_shards(spark, rows, shards, part_rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).withColumn("lang", F.lit("x")).repartition(4)
    out = sharding.shard_documents(df, shards, part_rows=part_rows)
    assert set(out.columns) == {"doc_id", "text", "lang", "shard", "slot"}
    key = lambda r: (r[2], r[3])
    got = sorted(((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in out.collect()), key=key)
    assert got == by_hand(rows, shards)
    if shards == 5:
        assert out.rdd.getNumPartitions() > shards  # parts, not shards, are tasks


def test_tolerance(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(df, 4, tolerance=2000).groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).collect()
    total = sum(b for _, b in got)
    assert len(got) == 4 and all(abs(b - total / 4) <= 4000 + 0.01 * total for _, b in got)


def test_one_group(spark):
    df = spark.createDataFrame([(k, "same") for k in range(1000)], "doc_id long, text string")
    got = {r["shard"]: r["n"] for r in sharding.shard_documents(df, 24).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert len(got) == 24 and max(got.values()) - min(got.values()) <= 1


def test_query_and_files(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    got = sharding.op12_sharding(spark, str(tmp_path)).collect()
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "bytes", s, n, None) for i, t, s, n in by_hand(rows, 24)]
    assert sorted(map(tuple, got), key=lambda r: r[4:6]) == want
    empty = sharding.op12_sharding(spark, f"{tmp_path}/none")
    assert empty.count() == 0 and empty.dtypes == sharding.op12_sharding(spark, str(tmp_path)).dtypes
    sharding.write_shards(sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(rows)
