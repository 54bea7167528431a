"""Replacement chains: long ones in few rounds, and cycles of any density against all paths."""

import random

from pyspark.sql import functions as F

from codetables.operators import relations as R


def by_hand(edges, valid):
    """{(code, target): (cardinality, direct)} by following every path that holds no code twice."""
    edges = set(edges)
    after, into = {}, {}
    for p, q in edges:
        after.setdefault(p, set()).add(q)
        into.setdefault(q, set()).add(p)
    out = {}

    def follow(code, at, seen, merged, split, n):
        for to in after.get(at, ()):
            m, s = merged or len(into[to]) > 1, split or len(after[at]) > 1
            if to in valid:
                old = out.get((code, to), (False, False, False))
                out[code, to] = (old[0] or m, old[1] or s, old[2] or n == 1)
            elif to not in seen:
                follow(code, to, seen | {to}, m, s, n + 1)

    for code in after:
        if code not in valid:
            follow(code, code, {code}, False, False, 1)
    return {k: (f"{'n' if m else '1'}:{'n' if s else '1'}", d) for k, (m, s, d) in out.items()}


def resolved(spark, edges, valid):
    found = R.resolve_replacements(spark.createDataFrame(list(edges), "prev string, next string"), spark.createDataFrame([(v,) for v in valid], "code string"))
    return {(r["code"], r["target"]): (r["cardinality"], r["direct"]) for r in found.collect()}


def test_random_graphs(spark):
    # Many small graphs beside each other in one: with cycles, dead ends, loops and codes in effect.
    rng = random.Random(9)
    edges, valid = [], set()
    for g in range(40):
        n = rng.randrange(3, 8)
        edges += [(f"{g}.{rng.randrange(n)}", f"{g}.{rng.randrange(n)}") for _ in range(rng.randrange(2, 2 * n))]
        valid |= {f"{g}.{k}" for k in range(n) if rng.random() < 0.3}
    assert resolved(spark, edges, valid) == by_hand(edges, valid)


def test_blocked_paths():
    # The only marked edge, c to a, would need a twice.
    assert ("a", "c", False, False) in R.ways_inside([("a", "b", 0, 0), ("b", "c", 0, 0), ("c", "a", 1, 1)])
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(2, 7)
        edges = {(p, q): (rng.random() < 0.2, rng.random() < 0.2) for p in range(n) for q in range(n) if p != q and rng.random() < 0.5}
        said = {}

        def follow(a, at, seen, m, s):
            old = said.get((a, at), (False, False))
            said[a, at] = (old[0] or m, old[1] or s)
            for (p, q), (fm, fs) in edges.items():
                if p == at and q not in seen:
                    follow(a, q, seen | {q}, m or fm, s or fs)

        for a in {x for e in edges for x in e}:
            follow(a, a, {a}, False, False)
        found = {(a, b): (m, s) for a, b, m, s in R.ways_inside([(*e, *f) for e, f in edges.items()])}
        assert all(found[k] == v for k, v in said.items())


def test_a_dense_cycle(spark):
    nodes = [f"n{k}" for k in range(25)]
    edges = [(a, b) for a in nodes for b in nodes if a != b] + [("n3", "end"), ("in", "n7"), ("end", "n1")]
    found = resolved(spark, edges, {"end"})
    assert found == {(a, "end"): ("n:n", False) for a in nodes} | {("n3", "end"): ("1:n", True)} | {("in", "end"): ("n:n", False)}


def test_a_long_chain(spark):
    steps = spark.range(10_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(False).alias("merged"), F.lit(False).alias("split"))
    open_ = steps.where("b < 10000").withColumn("direct", F.lit(False))
    found, far, rounds = R.double_paths(open_, steps.where("b = 10000").withColumn("direct", F.lit(True)), 10_000)
    assert far is None and rounds <= 14 and found.count() == 10_000
