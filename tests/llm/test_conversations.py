"""Repairs of conversations against the cheapest edits by a table, for parts of any length and odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from codetables.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost string"
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}


def cheapest(rows):
    """(cost, audit, repaired) of rows (initial, fault, role, text), by a table over all rows and states."""
    ways = {0: (0, "", ())}

    def inserted(ways):
        for _ in range(3):
            for s, (c, audit, made) in list(ways.items()):
                t = _NEXT[s]
                way = (c + 2, audit + "I", (*made, ("user" if t == 2 else "assistant", "")))
                ways[t] = min(ways.get(t, way), way, key=lambda x: x[:2])
        return ways

    for initial, fault, role, text in rows:
        then = {}
        for s, (c, audit, made) in inserted(ways).items():
            options = [(s, 3, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                t = _NEXT[s]
                options.append((t, 2 + more, "R", (("user" if t == 2 else "assistant", text),)))
                if (s, initial) in _STEP:
                    options.append((_STEP[s, initial], int(more), "K", ((role, text),)))
            for t, w, letter, one in options:
                way = (c + w, audit + letter, made + one)
                then[t] = min(then.get(t, way), way, key=lambda x: x[:2])
        ways = then
    ways = inserted(ways)
    return min((ways[s] for s in (0, 3) if s in ways), key=lambda x: x[:2])


def by_hand(rows):
    """The contract's columns for one conversation's rows (turn, role, text)."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).digest()))
    seen, judged = set(), []
    for _, role, text in rows:
        bare = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role[:1], fault, role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = lambda kind: sum(f == kind for _, f, _, _ in judged)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    cost, audit, made = cheapest(judged)
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest()
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha


def test_search():
    rng = random.Random(5)
    fault = {0: "", 4: "blank", 8: "duplicate", 16: "truncated"}
    for _ in range(1500):
        marks = bytes(rng.choice([0, 1, 1, 2, 2, 3]) | rng.choice([0, 0, 0, 4, 8, 16]) for _ in range(rng.randrange(0, 14)))
        want = cheapest([("sua-"[x & 3], fault[x & ~3], "", "") for x in marks])[:2]
        assert conversations.edits(marks, 0, [0, 3], True)[:2] == want
        size, parts = rng.randrange(1, 5), []
        for at in range(0, len(marks), size):
            found = {(a, b): conversations.edits(marks[at : at + size], a, [b], False) for a in range(4) for b in range(4)}
            parts.append({k: x[:2] for k, x in found.items() if x})
        assert conversations.joined(parts) == want


def conversations_of(rng):
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn + rng.choice([0, 0, 0, 2]), role, rng.choice(["Yes.", "No", f"text {turn}.", "", "é!\n"])))
    rows += [(100, t, ["system", "user", "assistant"][t % 3], f"long {t % 40}{'.' * (t % 5 > 0)}") for t in range(90)]
    rows += [(101, None, None, None), (101, None, "user", "a"), (101, 3, "tool", "b."), (None, 1, "user", "hello."), (None, 2, "", "hello."), (102, 5, "user", " \t\n")]
    rows += [(103, 1, "user", "same.")] * 9 + [(103, 2, "assistant", "x" * 50_000 + ".")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return conversations_of(random.Random(2))


@pytest.mark.parametrize("block", [1024, 3])
def test_repairs(spark, rows, block):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(5)
    audits = conversations.repair(df, block=block)
    got = {r["conv_id"]: tuple(r)[1:] for r in audits.collect()}
    shas = {r["conv"]: r["repaired_sha256"] for r in conversations.repaired_digests(df, audits).collect()}
    want = {c: by_hand([r[1:4] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert {c: (*x, shas[c]) for c, x in got.items()} == want
    turns = {}
    for r in sorted(conversations.repaired_turns(df, audits).collect(), key=lambda r: (r["conv"] or -1, r["place"])):
        turns.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(turns.get(c, [])).encode()).hexdigest() == s for c, s in shas.items())
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in t)) for t in turns.values())


def test_query(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    held = {c: [] for c in {r[0] for r in rows}}
    one = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        kind, role, text = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20, one(role), one(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = conversations.op11_conversation_repair(spark, str(tmp_path))
    assert {r["conv_id"]: tuple(r)[1:] for r in found.collect()} == {c: by_hand(x) if x else empty for c, x in held.items()}
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert conversations.op11_conversation_repair(spark, f"{tmp_path}/none").count() == 0
