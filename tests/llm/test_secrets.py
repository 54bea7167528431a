"""The registered query on texts that hold secrets, and long candidates, against scans of every window."""

import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from codetables.llm import secrets

BASE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (pattern, group, least) in enumerate(BASE.values()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found)


def test_query(spark, tmp_path):
    rng = random.Random(12)
    word = lambda n, a="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789": "".join(rng.choice(a) for _ in range(n))
    made = [
        lambda: f'password = "{word(rng.randrange(5, 14))}"', lambda: f"API_KEY:{word(9)}", lambda: f"token='{word(20)}'x", lambda: "AKIA" + word(rng.randrange(9, 20), "ABCDEFGH0123"),
        lambda: word(rng.randrange(28, 70), "0123456789abcdef"), lambda: "é plain words here", lambda: "secret=" * 3 + word(8), lambda: word(30), lambda: "passwd : " + word(8) + " Secret=" + word(7),
    ]
    texts = [" \n".join(rng.choice(made)() for _ in range(rng.randrange(0, 12))) for _ in range(150)] + [None, "", "deadbeef" * 4 + "AKIA" + "B" * 12 + "\nAKIAAKIA" + "C" * 12]
    rows = [(k if k % 40 else 7, t, "clash") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, spans_found string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r)[:6] for r in secrets.op2_secret_scans(spark, str(tmp_path)).collect())
    want = []
    for k, t, _ in rows:
        found = base_spans(t or "")
        said = ",".join(f"{list(BASE)[kind]}:{a}:{b}" for a, kind, b in found)
        want.append((k, *[sum(x[1] == kind for x in found) for kind in range(3)], hashlib.sha256(said.encode()).hexdigest(), said))
    want.sort()
    assert [r[:5] for r in got] == [r[:5] for r in want] and sum(sum(r[1:4]) for r in want) > 200
    for r, w in zip(got, want):
        spans = r[5].split(",") if r[5] else []
        assert [s for s in spans if not s.startswith("entropy")] == (w[5].split(",") if w[5] else [])
    assert any("entropy" in r[5] for r in got)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert secrets.op2_secret_scans(spark, f"{tmp_path}/none").count() == 0


def test_long_candidates(spark):
    rng = random.Random(3)
    alphabet = secrets._ALPHABET
    texts = ["".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(10, 60))) + "ab" * rng.randrange(0, 40) for _ in range(60)) for _ in range(4)]
    texts.append("".join(rng.choice(alphabet) for _ in range(5000)))
    df = spark.createDataFrame(list(enumerate(texts)), "k long, s string").select("k", secrets.hot_windows(F.col("s")).alias("hot"))
    got = {r["k"]: [(x["start"], x["end"]) for x in r["hot"]] for r in df.collect()}
    for k, t in enumerate(texts):
        spans = []
        for i in range(len(t) - 23):
            bits = -sum(c / 24 * math.log2(c / 24) for c in Counter(t[i : i + 24]).values())
            if bits >= secrets.LIMITS["wide"] - 1e-9:
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + 24
                else:
                    spans.append([i, i + 24])
        assert got[k] == [tuple(s) for s in spans], k
