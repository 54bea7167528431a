"""Packs tokenized documents into as few sequences of a fixed capacity as it can: linear grouping, then best fit.

1. Each document becomes its ids and one separator; only longer ones are cut, into pieces of the capacity, the first of
   which may be shorter. Pieces are written once to the shared folder (lengths and checksums, no text).
2. The plan needs nothing but the number of pieces of each length, at most `capacity` numbers, so its size does not grow
   with the input. Large lengths are sorted down and rounded up to the largest of their group, groups of equal
   cardinality; the few sizes that remain are packed by a linear program over configurations (column generation with
   a knapsack by dynamic programming); its whole part is kept. Then actual lengths take the places of the rounded ones,
   the last of a bin as long as fits, and what the program left over and the small pieces go, longest first, into the
   fullest bin that holds them.
3. The plan is a list of runs "so many bins with exactly these lengths". A piece's rank among those of its length
   names its run, its bin and its offset. Ranks are counted in salted buckets, so a length that most pieces share is
   not one task.

Defined results: a null text is empty, a document without tokens is its separator alone. Rows are packed one by one:
equal ids or equal rows are separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetables.llm.common import staged, table

CAPACITY = 2048
SEPARATOR = 0
#: Pieces up to this length are small: they are placed by best fit.
SMALL = 256
#: Sizes that remain after rounding.
GROUPS = 32
#: Unused tokens up to which a bin of a configuration is kept: bounds that are tried for the fewest sequences.
KEPT_WASTE = (CAPACITY, 512, 128, 64, 32, 16, 8, 4, 2, 1, 0)


# ---- tokens


def byte_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Bytes -> id of a byte-level BPE file, whose printable stand-ins for bytes are undone, and its added tokens."""
    import json

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    added = {t["content"]: t["id"] for t in parsed.get("added_tokens", ())}
    return {bytes(byte_of[c] for c in t): i for t, i in parsed["model"]["vocab"].items() if t not in added}, added


class Tokens:
    """Token ids (little-endian unsigned 32-bit numbers) of texts.

    The same vocabulary as ranks, which is several times faster; strings of added tokens become their ids. Where a very
    long run of white space is too much for the pattern there, the file's own library takes the text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path = path
        ranks, added = byte_ranks(path)
        self.model = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        try:
            ids = self.model.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            from tokenizers import Tokenizer

            ids = np.array(Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids)
        return ids.astype("<u4", copy=False).tobytes()


_TOKENS: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """One tokenizer for each path and Python worker."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32 (and ids, on request)."""
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids binary" * with_ids

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = tokens_of(tokenizer), np.array([SEPARATOR], "<u4").tobytes()
        for batch in batches:
            ids_col, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 1000):
                cols: list[list] = [[] for _ in range(5 + with_ids)]
                for doc, text in zip(ids_col[at : at + 1000], texts[at : at + 1000]):
                    ids = tokens.of(text) + end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    start = 0
                    for k, stop in enumerate(range(first, n + 1, capacity)):
                        part = ids[4 * start : 4 * stop]
                        for c, v in zip(cols, (doc, k, start, stop - start, zlib.crc32(part), part)):
                            c.append(v)
                        start = stop
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names[: len(cols)])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(emit, schema)


# ---- the plan: from numbers of pieces by length to runs of equal bins


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of most value: how often each size, any number of times, within the capacity."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    order = [i for i in range(len(sizes)) if values[i] > 1e-12]
    least = min((int(sizes[i]) for i in order), default=capacity + 1)
    s, v, which = sizes[order], values[order], np.array(order)
    for c in range(least, capacity + 1):
        fits = s <= c
        gain = best[c - s[fits]] + v[fits]
        k = int(gain.argmax())
        if gain[k] > best[c - 1] + 1e-12:
            best[c], took[c] = gain[k], which[fits][k]
        else:
            best[c] = best[c - 1]
    config, c = np.zeros(len(sizes), dtype=np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
            continue
        config[took[c]] += 1
        c -= int(sizes[took[c]])
    return float(best[capacity]), config


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Whole part of the best fractional use of configurations that covers the demand of each size."""
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))  # columns: configurations
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        used = inverse @ demand
        prices = np.ones(n) @ inverse
        value, config = _knapsack(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ config
        ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratios.argmin())
        if not np.isfinite(ratios[leave]):
            break
        old = basis[:, leave].copy()
        basis[:, leave] = config
        if abs(np.linalg.det(basis / capacity**0.5)) == 0 and np.linalg.matrix_rank(basis) < n:
            basis[:, leave] = old
            break
    used = np.linalg.solve(basis, demand)
    return [(basis[:, j].astype(np.int64), int(np.floor(used[j] + 1e-9))) for j in range(n) if used[j] >= 1]


def linear_groups(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Lengths sorted down and dealt into groups of equal cardinality: [[length, count], ...] for each group."""
    total, out, room = sum(counts.values()), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append([])
                room = -(-total // groups)
            n = min(left, room)
            out[-1].append([length, n])
            left, room = left - n, room - n
    return out


class _Stock:
    """How many pieces of each length each group still has."""

    def __init__(self, dealt: list[list[list[int]]]):
        self.groups = [{length: n for length, n in g} for g in dealt]
        self.holders: dict[int, list[int]] = {}
        for k, g in enumerate(self.groups):
            for length in g:
                self.holders.setdefault(length, []).append(k)
        self.lengths = sorted(self.holders)

    def longest(self, groups: list[int], taken: dict[tuple[int, int], int]) -> tuple[int, int] | None:
        """(group, length) of the longest piece that these groups have besides those taken."""
        for k in groups:
            for length, n in self.groups[k].items():  # longest first
                if n > taken.get((k, length), 0):
                    return k, length
        return None

    def fitting(self, room: int, taken: dict[tuple[int, int], int]) -> tuple[int, int] | None:
        """The longest piece of any group that the room holds."""
        at = bisect.bisect_right(self.lengths, room)
        while at:
            at -= 1
            for k in self.holders[self.lengths[at]]:
                if self.groups[k].get(self.lengths[at], 0) > taken.get((k, self.lengths[at]), 0):
                    return k, self.lengths[at]
        return None

    def take(self, taken: dict[tuple[int, int], int], most: int) -> int:
        """Takes them as often as there are, `most` times at most."""
        times = min([most, *[self.groups[k][length] // n for (k, length), n in taken.items()]])
        for (k, length), n in taken.items():
            self.groups[k][length] -= n * times
            if not self.groups[k][length]:
                del self.groups[k][length]
                self.holders[length].remove(k)
                if not self.holders[length]:
                    del self.holders[length], self.lengths[bisect.bisect_left(self.lengths, length)]
        return times

    def left(self) -> dict[int, int]:
        out: dict[int, int] = {}
        for g in self.groups:
            for length, n in g.items():
                out[length] = out.get(length, 0) + n
        return out


def configured(large: dict[int, int], capacity: int, groups: int) -> tuple[list[tuple[int, list[int]]], dict[int, int]]:
    """Bins that configurations of rounded lengths give, with actual lengths in their places, and what is left over.

    Each place takes the longest piece of its group; the last one of a bin takes the longest that is left and fits, also
    of another group, so that what rounding left unused is used."""
    dealt = linear_groups(large, groups)
    rounded = [g[0][0] for g in dealt]
    sizes = np.array(sorted(set(rounded), reverse=True))
    of_size = {int(s): [k for k, r in enumerate(rounded) if r == s] for s in sizes}
    demand = np.array([sum(n for k in of_size[int(s)] for _, n in dealt[k]) for s in sizes], dtype=float)
    stock, bins = _Stock(dealt), []
    for config, times in sorted(configurations(sizes, demand, capacity), key=lambda x: -int(x[0] @ sizes)):
        places = [int(s) for s, k in zip(sizes, config) for _ in range(k)]
        while times > 0 and places:
            taken: dict[tuple[int, int], int] = {}
            lengths: list[int] = []
            for n, size in enumerate(places, 1):
                last = n == len(places)
                found = stock.fitting(capacity - sum(lengths), taken) if last else stock.longest(of_size[size], taken)
                if found is None:
                    break
                taken[found] = taken.get(found, 0) + 1
                lengths.append(found[1])
            if len(lengths) < len(places):
                break
            run = stock.take(taken, times)
            bins.append((run, lengths))
            times -= run
    return bins, stock.left()


def plan(counts: dict[int, int], capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS, kept_waste: tuple[int, ...] = KEPT_WASTE) -> list[tuple[int, list[int]]]:
    """Runs (number of bins, lengths in each), using each length as often as it occurs.

    Small pieces fill what configurations leave unused. Where there are too few of them, bins with more unused tokens
    than a bound are better opened again, and their pieces placed by best fit with the rest. Several bounds are tried,
    and also best fit alone, so configurations never cost a sequence; then as many configured bins are taken back, those
    of least waste first, as leave the number of sequences what it is."""
    runs: list[tuple[int, list[int]]] = []
    full = counts.get(capacity, 0)
    if full:
        runs.append((full, [capacity]))
    large = {x: n for x, n in counts.items() if small < x < capacity and n}
    rest = {x: n for x, n in counts.items() if 0 < x <= small and n}
    bins: list[tuple[int, list[int]]] = []
    if large:
        bins, left = configured(large, capacity, groups)
        rest |= left
    bins.sort(key=lambda b: capacity - sum(b[1]))

    def packed(kept: int) -> list[tuple[int, list[int]]]:
        others = dict(rest)
        for times, lengths in bins[kept:]:
            for length in lengths:
                others[length] = others.get(length, 0) + times
        return _best_fit(bins[:kept], others, capacity)

    number = lambda made: sum(n for n, _ in made)
    tried = {k: packed(k) for k in {0, *[sum(capacity - sum(b) <= waste for _, b in bins) for waste in kept_waste]}}
    fewest = min(map(number, tried.values()))
    low = max(k for k, made in tried.items() if number(made) == fewest)
    high = min((k for k in tried if k > low), default=low)
    while high - low > 1:
        middle = (low + high) // 2
        made = packed(middle)
        if number(made) <= fewest:
            low, tried[middle], fewest = middle, made, number(made)
        else:
            high = middle
    return runs + tried[low]


def _best_fit(bins: list[tuple[int, list[int]]], rest: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Longest first, each into the fullest bin that holds it; whole runs of equal bins at a time."""
    by_room: dict[int, list[tuple[int, list[int]]]] = {}
    rooms: list[int] = []  # sorted

    def put(times: int, lengths: list[int]) -> None:
        room = capacity - sum(lengths)
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append((times, lengths))

    for times, lengths in bins:
        put(times, lengths)
    for length in sorted(rest, reverse=True):
        left = rest[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if left >= each:
                    put(left // each, [length] * each)
                if left % each:
                    put(1, [length] * (left % each))
                break
            room = rooms[at]
            times, lengths = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            each = room // length
            whole = min(times, left // each)
            if whole:
                put(whole, lengths + [length] * each)
                left -= whole * each
                times -= whole
            if times and left and left < each:
                put(1, lengths + [length] * left)
                times, left = times - 1, 0
            if times:
                put(times, lengths)
    return [run for room in rooms for run in by_room[room]]


def slots(runs: list[tuple[int, list[int]]]) -> pd.DataFrame:
    """For each length its places in order: ranks from first_rank on go to sequence, sequence + 1, ... at offset."""
    rows, seen, sequence = [], {}, 0
    for times, lengths in runs:
        offset = 0
        for length in lengths:
            first = seen.get(length, 0)
            rows.append((length, first, sequence, offset))
            seen[length] = first + times
            offset += length
        sequence += times
    made = pd.DataFrame(rows, columns=["length", "first_rank", "sequence", "offset"], dtype="int64")
    return made.sort_values(["length", "first_rank"], ignore_index=True)


# ---- from the plan to each piece's place


def place(cut: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS, bucket_rows: int = 500) -> DataFrame:
    """cut (a written table with doc_id, piece, length) with sequence_id and offset."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = slots(plan(counts, capacity, small, groups))
    held = spark.sparkContext.broadcast({c: found[c].to_numpy() for c in found})

    # A bucket holds bucket_rows pieces, or a 4096th of all where that is more.
    salts = max(1, -(-max(counts.values(), default=1) // max(bucket_rows, sum(counts.values()) // 4096)))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_row", F.row_number().over(inside))
        .join(starts, ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
    )

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s = held.value
        wide = np.int64(1) << 44  # more than the pieces of one length
        at = np.searchsorted(s["length"] * wide + s["first_rank"], length.to_numpy("int64") * wide + rank.to_numpy("int64"), "right") - 1
        return pd.DataFrame({"sequence_id": s["sequence"][at] + rank.to_numpy() - s["first_rank"][at], "offset": s["offset"][at]})

    out = ranked.withColumn("_place", placed(F.col("length"), F.col("_rank")))
    return out.withColumns({"sequence_id": F.col("_place.sequence_id"), "offset": F.col("_place.offset")}).drop("_salt", "_row", "_before", "_rank", "_place")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of docs."""
    return place(staged(pieces(docs, tokenizer, id_col, text_col, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids ARRAY<INT>, documents ARRAY<LONG> (by offset). Needs unique
    document ids. A group is one sequence, so it is bounded by the capacity."""
    ids = pieces(docs, tokenizer, capacity=capacity, with_ids=True).select("doc_id", "piece", "ids")
    rows = packed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id")
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))

    @F.pandas_udf("array<int>")
    def joined(parts: pd.Series) -> pd.Series:
        return parts.map(lambda p: np.frombuffer(b"".join(p), "<i4"))

    got = rows.agg(inside.alias("parts"))
    return got.select("sequence_id", joined(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
