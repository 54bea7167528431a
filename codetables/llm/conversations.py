"""Repairs the structure of conversations with the cheapest edits, found by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, state); the states are those of `(s?(ua)+)?` over role initials. A row is kept
(cost 0), given the role user or assistant that fits (2) or deleted (3, the only edit of blank and duplicate rows);
a turn with an empty text can be inserted anywhere (2); a truncated row that stays costs 1 more. A search runs from
both ends with a heap each. It ends when the two least open costs exceed the best path together, so every path of that
cost has a crossing that is known, and of those paths the one whose edits' initials are ASCII-least is followed. Two
cheapest ways to one node never have one a prefix of the other (between them would lie inserts alone, which cost), so
the least initial at each node gives the least audit as a whole.

Rows are sorted by range, not by conversation, so a conversation of any length is many tasks. A part of at most
`block` rows that does not hold a whole conversation is solved for each state at its start and its end; what the parts
of a conversation cost is put together by the same search over a lattice of parts. Texts are shuffled once, to emit the
repaired turns in order; a task streams through them and holds no conversation.

Defined results: null role and text count as one space, a null turn comes before all others, rows without a conv_id are
one conversation. Rows of one turn are taken by role, then by the SHA-256 of their text; of equal rows the first is
judged and the others are duplicates (blank if it is blank). A role is judged by its first character; one that is
neither s, u nor a (also an empty one) can't be kept. An empty table gives an empty table; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import SPACE_CHARS, arrow_schema, staged, table

#: Rows that one search covers at most.
BLOCK = 1024
#: States: nothing yet, after s, after u, after a. What a row of each initial leads to (s, u, a, others), -1 being refused.
_KEEP = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
#: The state behind a turn that is inserted or gets another role: an assistant's after a user's, else a user's.
_NEXT = (2, 2, 3, 2)
_BEFORE = ((), (), (0, 1, 3), (2,))
_ROLE = {2: "user", 3: "assistant"}
#: A row as a byte: its initial (0 to 3) and its fault.
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16
_FOREVER = 1 << 60

Steps = Callable[[int, int], list[tuple[int, str, int, int]]]


def search(n: int, starts: list[int], ends: list[int], after: Steps, before: Steps) -> tuple[int, list[tuple[str, int]]] | None:
    """The cheapest path from (0, a state of starts) to (n, a state of ends), of least letters: its cost, and each step's
    letter and the state that it leads to. after and before give a node's steps as (cost, letter, place, state) of the
    other end; a step without cost must lead to a later place."""
    width = 4 * (n + 1)
    cost = [{s: 0 for s in starts}, {4 * n + s: 0 for s in ends}]
    # Of nodes of one cost those come first from which a step without cost may lead to the others.
    heaps = [sorted(cost[0]), sorted(width - 1 - x for x in cost[1])]
    settled: list[dict[int, int]] = [{}, {}]
    best, steps = _FOREVER, (after, before)
    while heaps[0] and heaps[1] and heaps[0][0] // width + heaps[1][0] // width <= best:
        side = 0 if heaps[0][0] // width <= heaps[1][0] // width else 1
        c, at = divmod(heapq.heappop(heaps[side]), width)
        node = width - 1 - at if side else at
        if node in settled[side]:
            continue
        settled[side][node] = c
        best = min(best, c + cost[1 - side].get(node, _FOREVER))
        for w, _, i, s in steps[side](node >> 2, node & 3):
            to, known = 4 * i + s, cost[side]
            if c + w < known.get(to, _FOREVER):
                known[to] = c + w
                heapq.heappush(heaps[side], (c + w) * width + (width - 1 - to if side else to))
    if best == _FOREVER:
        return None
    ahead, behind = settled[0], dict.fromkeys([4 * n + s for s in ends], 0) | settled[1]
    # Nodes of the forward half that lie on a cheapest path, from the crossings back to the start.
    good: dict[int, tuple[str, int]] = {}
    for node, c in sorted(ahead.items(), key=lambda x: (-x[1], -x[0])):
        if behind.get(node, _FOREVER) + c == best:
            good[node] = ("", -1)  # from here the other half knows the way
            continue
        for w, letter, i, s in after(node >> 2, node & 3):
            to = 4 * i + s
            if (to in behind and c + w + behind[to] == best or to in good and ahead[to] == c + w) and (node not in good or letter < good[node][0]):
                good[node] = (letter, to)
    node, path = next(s for s in starts if s in good or behind.get(s) == best), []
    while node in good and good[node][1] >= 0 and node not in behind:
        letter, node = good[node]
        path.append((letter, node & 3))
    while node >> 2 < n or behind[node]:
        letter, node = min((letter, 4 * i + s) for w, letter, i, s in after(node >> 2, node & 3) if behind.get(4 * i + s, _FOREVER) + w == behind[node])
        path.append((letter, node & 3))
    return best, path


def edits(rows: bytes, start: int, ends: list[int], closed: bool) -> tuple[int, str, int] | None:
    """(cost, audit, state at the end) of the cheapest edits of rows, each a byte of initial and fault. Turns are inserted behind the
    last row only if closed: else they belong to the part that follows."""
    n = len(rows)

    def after(i: int, s: int) -> list[tuple[int, str, int, int]]:
        out = []
        if i < n:
            x = rows[i]
            out.append((3, "D", i + 1, s))
            if not x & (BLANK | DUPLICATE):
                more = 1 if x & TRUNCATED else 0
                if _KEEP[s][x & 3] >= 0:
                    out.append((more, "K", i + 1, _KEEP[s][x & 3]))
                out.append((2 + more, "R", i + 1, _NEXT[s]))
        if i < n or closed:
            out.append((2, "I", i, _NEXT[s]))
        return out

    def before(i: int, t: int) -> list[tuple[int, str, int, int]]:
        out = [(2, "I", i, s) for s in _BEFORE[t]] if i < n or closed else []
        if i:
            x = rows[i - 1]
            out.append((3, "D", i - 1, t))
            if not x & (BLANK | DUPLICATE):
                more = 1 if x & TRUNCATED else 0
                out += [(more, "K", i - 1, s) for s in range(4) if _KEEP[s][x & 3] == t]
                out += [(2 + more, "R", i - 1, s) for s in _BEFORE[t]]
        return out

    found = search(n, [start], ends, after, before)
    return found and (found[0], "".join(letter for letter, _ in found[1]), found[1][-1][1] if found[1] else start)


def joined(parts: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, str]:
    """(cost, audit) of a conversation from its parts in order, each with the (cost, audit) of every start and end state."""
    # What is inserted behind the last row.
    parts = [*parts, {(0, 0): (0, ""), (3, 0): (0, ""), (2, 0): (2, "I"), (1, 0): (4, "II")}]

    def after(i: int, s: int) -> list[tuple[int, str, int, int]]:
        return [(c, audit, i + 1, t) for (a, t), (c, audit) in parts[i].items() if a == s] if i < len(parts) else []

    def before(i: int, t: int) -> list[tuple[int, str, int, int]]:
        return [(c, audit, i - 1, a) for (a, b), (c, audit) in parts[i - 1].items() if b == t] if i else []

    cost, path = search(len(parts), [0], [0], after, before)
    return cost, "".join(audit for audit, _ in path)


def roles(audit: str, rows: Iterator) -> Iterator[tuple[str, str | None, object]]:
    """(edit, new role or None, row or None) for each edit of an audit over the rows' initials with their rows."""
    state = 0
    for edit in audit:
        row = None
        if edit != "I":
            row = next(rows)
        if edit == "K":
            state = _KEEP[state][row[0]]
        elif edit != "D":
            state = _NEXT[state]
        yield edit, _ROLE[state] if edit in "RI" else None, row


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _rows(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn (null first in its order), role, text, h (the text's SHA-256), initial."""
    text, role = F.coalesce(F.col(text_col), F.lit(" ")), F.coalesce(F.col(role_col), F.lit(" "))
    out = convs.select(F.col(conv_col).alias("conv"), F.col(turn_col).try_cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return out.withColumns({"h": F.unhex(F.sha2("text", 256)), "initial": _initial(F.col("role")).cast("tinyint")})


def judged(rows: DataFrame) -> DataFrame:
    """One row for each (conv, turn, role, h) with its number of copies n, its initial and its own fault."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE_CHARS)), -1, 1)
    fault = F.when(F.trim(F.col("text"), F.lit(SPACE_CHARS)) == "", BLANK).when(last.isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    each = rows.select("conv", "turn", "role", "h", "initial", fault.cast("tinyint").alias("fault"))
    each = staged(each.groupBy("conv", "turn", "role", "h", "initial", "fault").agg(F.count("*").alias("n")), "conversation-rows")
    # Equal rows of several turns: their first turn, null being the least.
    least = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    again = each.where(F.col("fault") != BLANK).groupBy("conv", "role", "h").agg(F.count("*").alias("turns"), least)
    again = again.where("turns > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("d"), F.col("first.turn").alias("first"))
    found = each.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("d")), "left")
    late = F.col("d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    return found.withColumn("fault", F.when(late, DUPLICATE).otherwise(F.col("fault")).cast("tinyint")).select("conv", "turn", "role", "h", "initial", "fault", "n")


_PART = (
    "conv {id}, nth long, turn long, role string, h binary, whole boolean, first_turn long, last_turn long, turns long, first_initial int, last_initial int, "
    "blank long, duplicate long, truncated long, illegal long, ways array<struct<a:int,b:int,cost:long,audit:string>>"
)


def parts(faults: DataFrame, block: int) -> DataFrame:
    """The solved parts of at most `block` rows of each conversation, of rows sorted by range. A part whose conversation
    begins and ends inside one task's rows is whole and has one way, others have one from each state to each."""
    ordered = faults.withColumn("known", F.col("turn").isNotNull()).repartitionByRange("conv", "known", "turn", "role", "h").sortWithinPartitions("conv", "known", "turn", "role", "h")

    def solve(conv, nth: int, key, marks: bytearray, turns: list, whole: bool) -> dict:
        legal = {(0, 1), (1, 2), (2, 1)}
        initials = [x & 3 for x in marks]
        known = [t for t in turns if t is not None]
        if whole:
            cost, audit, _ = edits(bytes(marks), 0, [0, 3], True)
            ways = [{"a": 0, "b": 0, "cost": cost, "audit": audit}]
        else:
            found = {(a, b): edits(bytes(marks), a, [b], False) for a in range(4) for b in range(4)}
            ways = [{"a": a, "b": b, "cost": x[0], "audit": x[1]} for (a, b), x in found.items() if x]
        return {
            "conv": conv, "nth": nth, "turn": key[0], "role": key[1], "h": key[2], "whole": whole, "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
            "turns": len(set(known)), "first_initial": initials[0], "last_initial": initials[-1], "blank": sum(x & BLANK > 0 for x in marks),
            "duplicate": sum(x & DUPLICATE > 0 for x in marks), "truncated": sum(x & TRUNCATED > 0 for x in marks),
            "illegal": sum(p not in legal for p in zip(initials, initials[1:])), "ways": ways,
        }

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, marks, turns, seen, opened, out = None, bytearray(), [], 0, False, []
        conv, numbers = None, itertools.count()

        def flush(ends: bool) -> None:
            """ends: the conversation's rows end inside this task. The task's first and last ones may go on elsewhere."""
            nonlocal key, marks, turns, opened
            if marks:
                out.append(solve(conv, next(numbers), key, marks, turns, ends and not opened))
                opened = True
            key, marks, turns = None, bytearray(), []

        for batch in batches:
            for c, turn, role, h, initial, fault, n in zip(*[batch.column(k).to_pylist() for k in range(7)]):
                if seen and c != conv:
                    flush(True)
                    opened = False
                elif not seen:
                    opened = True  # its beginning may be in another task
                seen, conv = 1, c
                copy = fault if fault == BLANK else DUPLICATE
                for k in range(n):
                    if len(marks) == block:
                        flush(False)
                    if key is None:
                        key = (turn, role, h)
                    marks.append(initial | (fault if k == 0 else copy))
                    turns.append(turn)
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out.clear()
        flush(False)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    id_type = faults.schema["conv"].dataType.simpleString()
    schema = arrow_schema(_PART.format(id=id_type))
    return ordered.select("conv", "turn", "role", "h", "initial", "fault", "n").mapInArrow(emit, _PART.format(id=id_type))


_RESULT = "conv {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def solved(faults: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation that has rows."""
    made = staged(parts(faults, block), "conversation-parts")
    counts = ["blank", "duplicate", "truncated", "illegal"]
    gap = lambda first, last, turns: F.coalesce(last - first + 1 - turns, F.lit(0).cast("long"))
    one = F.col("ways")[0]
    whole = made.where("whole").select("conv", gap(F.col("first_turn"), F.col("last_turn"), F.col("turns")).alias("gaps"), *counts, one["cost"].alias("cost"), one["audit"].alias("audit"))
    id_type = faults.schema["conv"].dataType.simpleString()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def result() -> dict:
            total = {k: sum(p[k] for p in held) for k in (*counts, "turns")}
            for x, y in zip(held, held[1:]):
                total["illegal"] += (x["last_initial"], y["first_initial"]) not in {(0, 1), (1, 2), (2, 1)}
                total["turns"] -= x["last_turn"] is not None and x["last_turn"] == y["first_turn"]
            ends = [t for p in held for t in (p["first_turn"], p["last_turn"]) if t is not None]
            cost, audit = joined([{(w["a"], w["b"]): (w["cost"], w["audit"]) for w in p["ways"]} for p in held])
            gaps = ends[-1] - ends[0] + 1 - total.pop("turns") if ends else 0
            return {"conv": held[0]["conv"], "gaps": gaps, **{k: total[k] for k in counts}, "cost": cost, "audit": audit}

        out = []
        for batch in batches:
            for p in batch.to_pylist():
                if held and held[0]["conv"] != p["conv"]:
                    out.append(result())
                    held.clear()
                held.append(p)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if held:
            yield pa.RecordBatch.from_pylist([result()], schema=schema)

    schema = arrow_schema(_RESULT.format(id=id_type))
    pieces = made.where("not whole").withColumn("known", F.col("turn").isNotNull())
    # Parts that begin with copies of one row are of one task, which has numbered them.
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "known", "turn", "role", "h", "nth").drop("known")
    return whole.unionByName(ordered.mapInArrow(combine, _RESULT.format(id=id_type)))


def repair(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """conv_col, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation, written."""
    faults = judged(_rows(convs, conv_col, turn_col, role_col, text_col))
    return staged(solved(faults, block).withColumnRenamed("conv", conv_col), "conversation-audits")


def _edited(convs: DataFrame, audits: DataFrame, cols: tuple[str, str, str, str], handle: Callable, returns: str) -> DataFrame:
    """Streams through each conversation's audit and its rows in order; handle(conv, edits) yields the result's rows."""
    conv_col = cols[0]
    rows = _rows(convs, *cols).withColumns({"audit": F.lit(None).cast("string"), "known": F.col("turn").isNotNull()})
    heads = audits.select(F.col(conv_col).alias("conv"), *[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes[1:6]], "audit", F.lit(None).cast("boolean").alias("known"))
    # The audit sorts first: it alone has no `known`.
    every = rows.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "known", "turn", "role", "h")
    schema = arrow_schema(returns)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, len(batch), 256):
                    part = batch.slice(at, 256)
                    yield from zip(*[part.column(k).to_pylist() for k in range(5)])

        source, out = lines(), []
        head = next(source, None)
        while head is not None:
            conv, audit, then = head[0], head[1] or "", []

            def own() -> Iterator[tuple]:
                for line in source:
                    if line[1] is not None:
                        then.append(line)
                        return
                    yield line[2], line[3], line[4]

            mine = own()
            for row in handle(conv, roles(audit, mine)):
                out.append(row)
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            for _ in mine:
                pass
            head = then[0] if then else None
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return every.select("conv", "audit", "initial", "role", "text").mapInArrow(emit, returns)


def repaired_turns(convs: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: conv, place (from 0), edit (K, R or I), role and text of each turn."""

    def turns(conv, edited) -> Iterator[dict]:
        place = 0
        for edit, role, row in edited:
            if edit != "D":
                yield {"conv": conv, "place": place, "edit": edit, "role": role or row[1], "text": "" if row is None else row[2]}
                place += 1

    id_type = dict(convs.dtypes)[conv_col]
    return _edited(convs, audits, (conv_col, turn_col, role_col, text_col), turns, f"conv {id_type}, place long, edit string, role string, text string")


def repaired_digests(convs: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv and repaired_sha256, of the lines `role:text` of each repaired conversation."""

    def digest(conv, edited) -> Iterator[dict]:
        made, first = hashlib.sha256(), True
        for edit, role, row in edited:
            if edit != "D":
                made.update(("" if first else "\n").encode() + f"{role or row[1]}:{'' if row is None else row[2]}".encode("utf-8", "surrogatepass"))
                first = False
        yield {"conv": conv, "repaired_sha256": made.hexdigest()}

    id_type = dict(convs.dtypes)[conv_col]
    return _edited(convs, audits, (conv_col, turn_col, role_col, text_col), digest, f"conv {id_type}, repaired_sha256 string")


def damaged(convs: DataFrame) -> DataFrame:
    """conversations with faults planted by the CRC-32 of conv_id and turn: rows dropped, emptied, without their ends of
    sentences, repeated, and given the role user."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(one("conv_id"), F.lit(":"), one("turn")), "UTF-8")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    out = convs.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(convs)
    audits = repair(rows)
    digests = repaired_digests(rows, audits).withColumnRenamed("conv", "same")
    every = convs.select(F.col("conv_id").alias("original")).distinct()
    found = every.join(audits, F.col("original").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("original").eqNullSafe(F.col("same")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    numbers = [zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return found.select(F.col("original").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


_CRC = """
bit(i, k, v) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bit WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bit WHERE k = 8)"""

#: The same edits by a table of the cheapest way to each state, row by row.
ORACLE = (
    "WITH RECURSIVE "
    + _CRC.strip()
    + r""",
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hashed AS (
  SELECT keyed.*, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ord(substr(k, i, 1)) AS BIGINT)),
         lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
  FROM keyed, crc),
harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         CASE substr(role, 1, 1) WHEN 's' THEN 's' WHEN 'u' THEN 'u' WHEN 'a' THEN 'a' ELSE '-' END AS c
  FROM harmed WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN substr(bare, -1, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS p
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (p IS NOT NULL AND p || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM judged GROUP BY conv_id),
-- A way is its cost in nine digits and its audit. Inserted turns are added before a row and at the end.
step(conv_id, i, w0, w1, w2, w3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM counted
  UNION ALL
  SELECT conv_id, i + 1, d0,
         least(d1, CASE WHEN may AND c = 's' THEN k0 END),
         least(d2, CASE WHEN may AND c = 'u' THEN least(k0, k1, k3) END, CASE WHEN may THEN least(r0, r1, r3) END),
         least(d3, CASE WHEN may AND c = 'a' THEN k2 END, CASE WHEN may THEN r2 END)
  FROM (
    SELECT *, fault NOT IN ('b', 'd') AS may,
           lpad(CAST(CAST(v0[:9] AS BIGINT) + 3 AS VARCHAR), 9, '0') || v0[10:] || 'D' AS d0, lpad(CAST(CAST(v1[:9] AS BIGINT) + 3 AS VARCHAR), 9, '0') || v1[10:] || 'D' AS d1,
           lpad(CAST(CAST(v2[:9] AS BIGINT) + 3 AS VARCHAR), 9, '0') || v2[10:] || 'D' AS d2, lpad(CAST(CAST(v3[:9] AS BIGINT) + 3 AS VARCHAR), 9, '0') || v3[10:] || 'D' AS d3,
           lpad(CAST(CAST(v0[:9] AS BIGINT) + f AS VARCHAR), 9, '0') || v0[10:] || 'K' AS k0, lpad(CAST(CAST(v1[:9] AS BIGINT) + f AS VARCHAR), 9, '0') || v1[10:] || 'K' AS k1,
           lpad(CAST(CAST(v2[:9] AS BIGINT) + f AS VARCHAR), 9, '0') || v2[10:] || 'K' AS k2, lpad(CAST(CAST(v3[:9] AS BIGINT) + f AS VARCHAR), 9, '0') || v3[10:] || 'K' AS k3,
           lpad(CAST(CAST(v0[:9] AS BIGINT) + 2 + f AS VARCHAR), 9, '0') || v0[10:] || 'R' AS r0, lpad(CAST(CAST(v1[:9] AS BIGINT) + 2 + f AS VARCHAR), 9, '0') || v1[10:] || 'R' AS r1,
           lpad(CAST(CAST(v2[:9] AS BIGINT) + 2 + f AS VARCHAR), 9, '0') || v2[10:] || 'R' AS r2, lpad(CAST(CAST(v3[:9] AS BIGINT) + 2 + f AS VARCHAR), 9, '0') || v3[10:] || 'R' AS r3
    FROM (
      SELECT *, w0 AS v0, w1 AS v1, least(x2, lpad(CAST(CAST(x3[:9] AS BIGINT) + 2 AS VARCHAR), 9, '0') || x3[10:] || 'I') AS v2,
             least(x3, lpad(CAST(CAST(x2[:9] AS BIGINT) + 2 AS VARCHAR), 9, '0') || x2[10:] || 'I') AS v3
      FROM (
        SELECT s.conv_id, s.i, s.w0, s.w1, s.w3 AS x3, j.fault, j.c, CASE WHEN j.fault = 't' THEN 1 ELSE 0 END AS f,
               least(s.w2, lpad(CAST(CAST(s.w0[:9] AS BIGINT) + 2 AS VARCHAR), 9, '0') || s.w0[10:] || 'I',
                     lpad(CAST(CAST(s.w1[:9] AS BIGINT) + 2 AS VARCHAR), 9, '0') || s.w1[10:] || 'I') AS x2
        FROM step s JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = s.i + 1)))),
best AS (
  SELECT s.conv_id, least(w0, w3, lpad(CAST(CAST(w2[:9] AS BIGINT) + 2 AS VARCHAR), 9, '0') || w2[10:] || 'I',
         lpad(CAST(CAST(w1[:9] AS BIGINT) + 4 AS VARCHAR), 9, '0') || w1[10:] || 'II') AS way
  FROM step s JOIN counted n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND s.i = n.n),
edit AS (
  SELECT conv_id, k, way[9 + k : 9 + k] AS e, count(*) FILTER (way[9 + k : 9 + k] <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i
  FROM (SELECT conv_id, way, unnest(range(1, length(way) - 8)) AS k FROM best)),
turn AS (
  SELECT e.conv_id, e.k, e.e, j.role, j.text, row_number() OVER (PARTITION BY e.conv_id ORDER BY e.k) AS place, bool_or(e.e = 'K' AND j.c = 's') OVER (PARTITION BY e.conv_id) AS led
  FROM edit e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.i = j.i AND e.e <> 'I'
  WHERE e.e <> 'D'),
hash AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (place + led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS h
  FROM turn GROUP BY conv_id)
SELECT o.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate, coalesce(n.truncated, 0) AS truncated,
       coalesce(n.illegal, 0) AS illegal, coalesce(CAST(b.way[:9] AS BIGINT), 0) AS cost, coalesce(b.way[10:], '') AS audit, coalesce(h.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON o.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN hash h ON o.conv_id IS NOT DISTINCT FROM h.conv_id
"""
)
