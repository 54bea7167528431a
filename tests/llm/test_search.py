"""Ranked search against the scores of all documents, with ties, copies, odd rows and small rows of the index."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from codetables.llm import search

SCHEMA = "doc_id long, text string, score string, rank string"


def by_hand(docs, items, limit):
    """{item_id: [(rank, doc_id, score)]} by scoring every document; docs of unique ids."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))
    held = {i: Counter(terms(t)) for i, t in docs}
    held = {i: c for i, c in held.items() if c}
    n, length = len(held), sum(c.total() for c in held.values())
    df = Counter(t for c in held.values() for t in c)
    out = {}
    for item, text in items:
        found = []
        for i, c in held.items():
            m = 100 - 50 + (50 * c.total() * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, -(1 << 63) if i is None else i, i))
        out[item] = [(k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found)[:limit])]
    return {k: v for k, v in out.items() if v}


@pytest.fixture(scope="module")
def tables():
    rng = np.random.Generator(np.random.PCG64(4))
    vocab = [f"t{k}" if k % 7 else f"Ünü{k}" for k in range(400)]
    odds = 1 / np.arange(1, 401)
    odds /= odds.sum()
    text = lambda n: " ".join(rng.choice(vocab, n, p=odds))
    docs = [(k, text(int(rng.integers(1, 80)))) for k in range(600)]
    docs += [(2000 + k, docs[5][1]) for k in range(150)]  # ties
    docs += [(None, docs[9][1]), (3000, None), (3001, ""), (3002, "?!, \x00"), (3003, "t1 " * 20000), (3004, "T1_T2-t3\tT1é"), (-4, docs[5][1])]
    items = [(k, text(int(rng.integers(1, 30)))) for k in range(25)]
    items += [(90, docs[5][1]), (91, docs[9][1]), (92, None), (93, "nowhere else"), (94, "t1 T1 t1"), (95, "")]
    return docs, items


@pytest.mark.parametrize(("limit", "block"), [(50, 2000), (3, 4)])
def test_search(spark, tables, limit, block):
    docs, items = tables
    df = spark.createDataFrame([(*r, "clash", "clash") for r in docs], SCHEMA).repartition(3)
    out = search.search(df, spark.createDataFrame(items, "item_id long, text string"), limit=limit, item_block=block)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["item_id"], r["rank"])):
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert got == by_hand(docs, items, limit)


def test_rows_of_the_index(spark, tables, monkeypatch):
    docs, items = tables
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(search.build_index, "__defaults__", ("doc_id", "text", 37, 500))
    out = search.search(df, spark.createDataFrame(items, "item_id long, text string"), limit=10)
    got = sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in out.where("doc_id is not null").collect())
    assert got == sorted((i, *x) for i, found in by_hand(docs, items, 10).items() for x in found if x[1] is not None)


def test_searches_leave_intervals_closed(spark):
    rng = np.random.Generator(np.random.PCG64(6))
    docs = [(k, " ".join(f"w{x}" for x in rng.integers(0, 50, 30)) + (" needle pin" if k % 100 == 7 else "")) for k in range(2000)]
    vocabulary = {b"needle": 0, b"pin": 1, b"w1": 2}
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), vocabulary)
    weight, n, length = search.weights(index, 3)
    batch = index.toArrow().combine_chunks()
    block = search.Block({c: batch.column(c).chunk(0)[0].values for c in batch.column_names}, weight, n, length)
    best = []
    assert block.search([0, 1, 2], best, 5) < 400 and len(best) == 5
    assert {-i % 100 for _, i in best} == {7}
    assert block.search([0, 1, 2], best, 5) <= search.AT_ONCE  # nothing beats what is known


def test_no_rows(spark, tables):
    docs, items = tables
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(items, "item_id long, text string")
    assert search.search(none, some).count() == 0
    assert search.search(spark.createDataFrame(docs, "doc_id long, text string"), some.limit(0)).count() == 0
