"""Shards of nearly equal bytes by histogram sort: splitters of the sorted keys are found by counting, then rows move once.

Rows sort by (key, id, row number); the key is 60 bits of the text's MD5, so equal texts stand together and all else is
mixed. A splitter's bracket is two boundaries with the bytes below them, one at or below and one above the bytes that
are wanted in front of it. A round counts the exact bytes and rows below candidate boundaries over all partitions: first
evenly spaced keys, then keys of rows drawn inside each bracket, until a bracket holds one row or a boundary lies within
the tolerance. After the first count only rows inside brackets are read. The driver holds a bounded number of
candidates a splitter; no sample decides anything, it only says where to count next.

Of the boundaries of its bracket a splitter takes the nearer one, at equal distance the lower. A boundary that leaves a
group of equal texts whole is preferred while it is not further off than `group_percent` of a shard; a larger group
is cut. So shards are uneven by that much and half a document at most at each end. Each shard is many parts of equal
bytes; rows are exchanged once, by part, and numbered inside the part behind the exact number of rows before it, so no
task holds a shard.

Defined results: a null text has 8 bytes of overhead alone and the key of an empty text; rows of missing or equal id
are rows of their own. An empty table gives an empty table. Columns of the input stay, but for shard and slot, which replace
columns of the same name (so do _h, _i, _n, _size and _part, which are used inside).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import arrow_schema, dropped, id_or_least, staged, table

#: Bytes that a document takes besides its text.
OVERHEAD = 8
#: Candidates a bracket and round.
PROBES = 64
#: Rows of a part of a shard, about; each part is a task's.
PART_ROWS = 1_000_000
KEYS = 1 << 60


def packed(h: np.ndarray, i: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Keys as 24 bytes that sort like (h, i, n)."""
    parts = np.stack([h, i, n], axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(parts.astype(">u8")).view("S24").ravel()


def boundary(h: int, i: int = -(1 << 63), n: int = 0) -> bytes:
    return packed(np.array([h]), np.array([i]), np.array([n]))[0].ljust(24, b"\0")


def key_of(at: bytes) -> int:
    return int.from_bytes(at[:8], "big") - (1 << 63)


def _batches(rows: DataFrame, handle, returns: str) -> DataFrame:
    return rows.select("_h", "_i", "_n", "_size").mapInArrow(handle, returns)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    h, i, n, size = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
    return packed(h, i, n), size


def counted(rows: DataFrame, candidates: list[bytes]) -> dict[bytes, tuple[int, int]]:
    """The bytes and rows below each candidate boundary, counted over all rows."""
    spark = rows.sparkSession
    probes = spark.sparkContext.broadcast(np.array(sorted(set(candidates)), "S24"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = probes.value
        size, count = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
        for batch in batches:
            key, own = _columns(batch)
            place = np.searchsorted(at, key, "right")
            size += np.bincount(place, own, len(at) + 1).astype(np.int64)
            count += np.bincount(place, minlength=len(at) + 1)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(size[full]), pa.array(count[full])], names=["bin", "size", "n"])

    found = _batches(rows, emit, "bin int, size long, n long").groupBy("bin").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    sizes = np.zeros((len(probes.value) + 1, 2), np.int64)
    for r in found.collect():  # at most one row a candidate
        sizes[r["bin"]] = r["size"], r["n"]
    below = np.cumsum(sizes, axis=0)
    return {at.ljust(24, b"\0"): (int(s), int(n)) for at, (s, n) in zip(probes.value.tolist(), below)}


def drawn(rows: DataFrame, brackets: list[tuple[bytes, bytes]], each: int, seed: int = 0) -> list[list[bytes]]:
    """For each bracket (disjoint, in order) about `each` of its rows' keys: those of least hash."""
    if not brackets:
        return []
    spark = rows.sparkSession
    low = np.array([a for a, _ in brackets], "S24")
    high = np.array([b for _, b in brackets], "S24")
    edges = spark.sparkContext.broadcast((low, high))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = edges.value
        held = pd.DataFrame({"b": np.empty(0, np.int32), "r": np.empty(0, np.uint64), "k": np.empty(0, object)})
        for batch in batches:
            key, _ = _columns(batch)
            b = np.searchsorted(low, key, "right") - 1
            inside = np.flatnonzero((b >= 0) & (key < high[b]))
            words = np.frombuffer(key[inside].tobytes(), ">u8").reshape(-1, 3).astype(np.uint64)
            with np.errstate(over="ignore"):
                r = (words @ np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64) + np.uint64(seed)) * np.uint64(0xFF51AFD7ED558CCD)
                r ^= r >> np.uint64(32)
            new = pd.DataFrame({"b": b[inside].astype(np.int32), "r": r, "k": [x.ljust(24, b"\0") for x in key[inside].tolist()]})
            held = pd.concat([held, new]).sort_values(["b", "r"]).groupby("b").head(each)
        yield pa.RecordBatch.from_arrays([pa.array(held["b"].to_numpy(np.int32)), pa.array(held["r"].to_numpy(np.uint64).view(np.int64)), pa.array(held["k"].tolist(), pa.binary())], names=["b", "r", "k"])

    # The least of all are among the least of every task; the second cut is made where tasks' rows meet.
    found = _batches(rows, emit, "b int, r long, k binary")
    spread = found.groupBy("b", F.pmod("r", F.lit(16)).alias("s")).agg(F.slice(F.array_sort(F.collect_list(F.struct("r", "k"))), 1, -(-each // 16)).alias("some"))
    out: list[list[bytes]] = [[] for _ in brackets]
    for row in spread.collect():  # at most about `each` a bracket
        out[row["b"]] += [bytes(x["k"]) for x in row["some"]]
    return out


class Splitter:
    """The bracket of one splitter: bytes and rows below its low and its high boundary."""

    def __init__(self, want: float, low: tuple[bytes, int, int], high: tuple[bytes, int, int]):
        self.want, self.low, self.high = want, low, high

    def narrow(self, known: dict[bytes, tuple[int, int]], order: list[bytes]) -> None:
        at = bisect_right(order, self.want, key=lambda k: known[k][0])
        if at and order[at - 1] > self.low[0]:
            self.low = (order[at - 1], *known[order[at - 1]])
        if at < len(order) and order[at] < self.high[0]:
            self.high = (order[at], *known[order[at]])

    def settled(self, tolerance: float) -> bool:
        return self.high[2] - self.low[2] <= 1 or min(self.want - self.low[1], self.high[1] - self.want) <= tolerance

    def nearest(self) -> tuple[bytes, int, int]:
        return self.low if self.want - self.low[1] <= self.high[1] - self.want else self.high


def splitters(rows: DataFrame, wants: list[float], total: tuple[int, int], tolerance: float = 0, probes: int = PROBES) -> list[Splitter]:
    """Brackets of the boundaries that have `wants` bytes below them, over written rows (_h, _i, _n, _size)."""
    first, last = boundary(0), boundary(KEYS)
    found = [Splitter(w, (first, 0, 0), (last, *total)) for w in wants]
    known = counted(rows, [boundary(KEYS * k // (probes * (len(wants) + 1))) for k in range(1, probes * (len(wants) + 1))])
    inside, made, base = rows, [], {}
    for turn in range(1000):
        order = sorted(known)
        for s in found:
            s.narrow(known, order)
        open_ = [s for s in found if not s.settled(tolerance)]
        if not open_:
            break
        spans = sorted({(s.low[0], s.high[0]) for s in open_})
        if turn == 0 or turn % 3 == 0:
            # From here on only rows inside brackets are read.
            is_in = reduce(or_, [F.col("_h").between(key_of(a), key_of(b)) for a, b in spans])
            inside = staged(inside.select("_h", "_i", "_n", "_size").where(is_in), "bracketed")
            made.append(inside)
        base = {s.low[0]: s.low for s in open_}
        picks = drawn(inside, spans, probes, turn)
        candidates = [k for some in picks for k in some]
        # Groups' ends beside rows: a heavy group is passed in one step.
        candidates += [boundary(key_of(k) + d) for k in candidates for d in (0, 1)]
        known = {}
        within = counted(inside, [*candidates, *[a for a, _ in spans]])
        for a, b in spans:
            # Counted among the rows inside brackets, so as differences from the bracket's low end.
            for k, (size, n) in within.items():
                if a < k < b:
                    known[k] = (base[a][1] + size - within[a][0], base[a][2] + n - within[a][1])
    dropped(*made)
    return found


def keyed(docs: DataFrame, id_col: str, text_col: str, size: Column) -> DataFrame:
    """docs with _h (60 bits of the text's MD5), _i, _n (a stored number) and _size, written."""
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(text_col), F.lit(""))), 1, 15), 16, 10).cast("long")
    return docs.withColumns({"_h": h, "_i": id_or_least(id_col), "_size": size.cast("long"), "_n": F.monotonically_increasing_id()})


def byte_shards(rows: DataFrame, shards: int, group_percent: float = 0.5, tolerance: float = 0, part_rows: int = PART_ROWS) -> DataFrame:
    """rows (keyed and written) with shard and slot; exchanged once, by part."""
    spark = rows.sparkSession
    total, n = rows.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count("*")).first()
    each = -(-n // (shards * part_rows)) or 1
    if n == 0:
        return rows.withColumns({"shard": F.lit(None).cast("int"), "slot": F.lit(None).cast("long")}).drop("_h", "_i", "_n", "_size")
    ends = splitters(rows, [total * k / shards for k in range(1, shards)], (total, n), tolerance)
    # Each end of the group of equal texts that the splitter's row is of.
    spans = sorted({(s.low[0], s.high[0]) for s in ends})
    group = {span: key_of(keys[0]) for span, keys in zip(spans, drawn(rows, spans, 1))}
    whole = counted(rows, [boundary(h + d) for h in group.values() for d in (0, 1)])
    chosen: list[tuple[bytes, int, int]] = []
    for s in ends:
        h = group[s.low[0], s.high[0]]
        off, best = min((abs(whole[b][0] - s.want), b) for b in (boundary(h), boundary(h + 1)))
        chosen.append((best, *whole[best]) if off <= group_percent / 100 * total / shards else s.nearest())
    starts = {boundary(0): 0} | {b: count for b, _, count in chosen}
    shard_starts = [0, *[count for _, _, count in chosen]]
    order, counts = sorted(starts), {b: (0, count) for b, count in starts.items()}
    if each > 1:
        # Parts of shards: their borders are keys of rows drawn, the rows below them are counted exactly.
        picks = drawn(rows, list(zip(order, [*order[1:], boundary(KEYS)])), 16 * each)
        order = sorted({*order, *[sorted(keys)[len(keys) * k // each] for keys in picks if keys for k in range(1, each)]})
        counts = counted(rows, order)
    bounds = np.array([boundary(0), *[b for b, _, _ in chosen]], "S24")
    # A shard that is empty (two equal splitters) has no part.
    shard_at = (np.searchsorted(bounds, np.array(order, "S24"), "right") - 1).tolist()
    before = [counts[b][1] - shard_starts[s] for b, s in zip(order, shard_at)]
    held = spark.sparkContext.broadcast((np.array(order, "S24"), np.array(shard_at, np.int32), np.array(before, np.int64)))

    @F.pandas_udf("int")
    def part_of(h: pd.Series, i: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(held.value[0], packed(h.to_numpy(), i.to_numpy(), n.to_numpy()), "right").astype(np.int32) - 1)

    placed = rows.withColumn("_part", part_of("_h", "_i", "_n")).repartitionById(len(order), "_part").sortWithinPartitions("_part", "_h", "_i", "_n")
    keep = [c for c in rows.columns if c not in ("_h", "_i", "_n", "_size", "shard", "slot")]
    slim = placed.select(*[F.col(f"`{c}`") for c in keep], "_part")
    returns = ", ".join([*[f"`{c}` {t}" for c, t in slim.dtypes if c != "_part"], "shard int", "slot long"])
    schema = arrow_schema(returns)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, shard_at, before = held.value
        next_: dict[int, int] = {}
        for batch in batches:
            part = batch.column(batch.num_columns - 1).to_numpy()
            slot = np.empty(len(part), np.int64)
            for p in np.unique(part).tolist():
                own = part == p
                at = next_.get(p, int(before[p]))
                slot[own] = at + np.arange(own.sum())
                next_[p] = at + int(own.sum())
            arrays = [*batch.columns[:-1], pa.array(shard_at[part]), pa.array(slot)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return slim.mapInArrow(number, returns)


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", group_percent: float = 0.5, tolerance: float = 0, part_rows: int = PART_ROWS) -> DataFrame:
    """docs, all columns and whole texts, with shard and slot."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + OVERHEAD
    return byte_shards(staged(keyed(docs, id_col, text_col, size), "shard-rows"), shards, group_percent, tolerance, part_rows)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes sharded documents to a folder a shard; the files of each hold runs of consecutive slots in order."""
    sharded.write.partitionBy("shard").parquet(path)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    size = F.octet_length(data) + OVERHEAD
    rows = keyed(docs.withColumns({"size": size.cast("long"), "text_crc32": F.crc32(data)}), "doc_id", "text", size).drop("text")
    out = byte_shards(staged(rows, "shard-rows"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_CRC = """
bit(i, k, v) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bit WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bit WHERE k = 8)"""

ORACLE = (
    "WITH RECURSIVE "
    + _CRC.strip()
    + r""",
doc AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(strlen(coalesce(text, '')) AS BIGINT) + 8 AS size,
         CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
ordered AS (
  SELECT *, row_number() OVER w AS r, coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM doc WINDOW w AS (ORDER BY h, doc_id NULLS FIRST)),
total AS (SELECT sum(size) AS bytes, count(*) AS n FROM doc),
split AS (SELECT k, bytes * k / 24.0 AS want, bytes, n FROM total, range(1, 24) t(k)),
-- The row in which the wanted byte lies, the rows of its text, and where each begins.
hit AS (
  SELECT s.k, s.want, s.bytes, o.h, o.r, o.below, o.below + o.size AS above
  FROM split s JOIN ordered o ON o.below <= s.want AND s.want < o.below + o.size),
grouped AS (SELECT h, min(r) AS r, min(below) AS below, max(r) + 1 AS next, max(below + size) AS above FROM ordered GROUP BY h),
cut AS (
  SELECT t.k, CASE
    WHEN least(t.want - g.below, g.above - t.want) <= 0.005 * t.bytes / 24.0 THEN CASE WHEN t.want - g.below <= g.above - t.want THEN g.r ELSE g.next END
    WHEN t.want - t.below <= t.above - t.want THEN t.r ELSE t.r + 1 END AS r
  FROM hit t JOIN grouped g USING (h)),
placed AS (SELECT o.*, (SELECT count(*) FROM cut WHERE cut.r <= o.r) AS shard FROM ordered o)
SELECT doc_id, size, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
         lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32,
       'bytes' AS law, CAST(shard AS INT) AS shard, row_number() OVER (PARTITION BY shard ORDER BY r) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM placed, crc
"""
)
