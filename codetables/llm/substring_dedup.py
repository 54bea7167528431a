"""Removes word passages that were seen before, with suffix trees partitioned by variable-length prefixes.

A window is `length` consecutive words of one document; a word goes if a window that covers it starts earlier elsewhere
(smaller document id, or earlier in the same document). Windows are judged on the input.

1. Anchors. Of the grams of `gram` words inside a window, the one of least hash is its anchor. Equal windows have equal
   anchors at equal places, and neighbouring windows mostly share theirs, so a run of windows is known by one anchor
   and anchors are sparse. Only 8-byte gram hashes are counted over all documents; a window whose anchor occurs once
   repeats nothing and is never shuffled.
2. Groups. A run goes, with its words as 32-bit hashes and the 64-bit hash of each window's path, to the group of its
   prefix: the anchor gram. Prefixes with few
   runs share a group, hashed so that a group fits in memory. Prefixes with too many runs are made longer, `GROW` words
   at a time, by the words of the window that follow the anchor (or precede it, where the window ends), and counted
   anew: a run so becomes several shorter ones, each in the group of its own longer prefix. Suffixes that agree in the
   whole window and are still too many are known by its path's hash alone; their earliest is found by partial
   aggregates, for any number of them.
3. Subtrees. In a group the suffixes (one for each window, to its run's end) are sorted by prefix doubling, and the
   words that neighbours share are the depths of the tree above them. Of the suffixes below an internal node all but the
   earliest repeat it; each suffix's longest repeat is the depth of its deepest node in which it isn't the earliest
   (Subtree.repeats; the nodes themselves, as maximal repeats: Subtree.maximal). Each window of a repeat is confirmed by
   its path's hash, so words of equal 32-bit hash do no harm. Overlapping repeats are joined.
4. Each document gets its repeated stretches and is put together without the words they cover.

Windows are equal if the 64-bit hashes of their paths are, which are made of 64-bit hashes of words: a wrong match has a
chance of 5e-20 for each pair of windows that meet in a node.

Defined results: a null, empty or short text loses nothing. Each row is a document of its own: rows without an id come
before all others, and rows of equal or missing id follow each other by their text's hash and then as they are stored.
Where ids are not unique, rows are therefore stored once more, in that order, with a key of their own. Columns of the
input stay, but for the text and for n_words and n_removed, which replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import WordHashes, dropped, gram_hashes, id_or_least, signed, staged, table, to_bytes

LENGTH, GRAM = 20, 8
#: Words by which a prefix of too many runs is made longer.
GROW = 4
#: Windows in a run at most; longer stretches of one anchor are several runs.
RUN_WINDOWS = 64
#: Runs of one prefix beyond which it is made longer: what a group of it holds fits in a task's memory.
HEAVY = 60_000
#: Runs in a group, on average.
GROUP_ROWS = 20_000
#: Keys of prefixes that are broadcast at most, to find the windows of too common ones; more of them are joined.
MAX_BROADCAST_PREFIXES = 500_000
#: Bytes of repeated stretches that are broadcast at most, to meet their texts; more of them are joined.
MAX_BROADCAST_BYTES = 16_000_000


def _doubled(x: np.ndarray, k: int, join) -> np.ndarray:
    """join over each run of k neighbours of x, from runs of 1, 2, 4, ... (join may see a neighbour twice)."""
    size, out = 1, x
    while size < k:
        step = min(size, k - size)
        out = join(out[: len(out) - step], out[step:])
        size += step
    return out


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, number of windows) of each run of windows with the same anchor: the least hash of the grams
    in a window."""
    if len(h) < length:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    least = _doubled(_doubled(h, gram, _mix), length - gram + 1, np.minimum)
    new = np.concatenate([[True], least[1:] != least[:-1]])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(least)))
    if sizes.max() > RUN_WINDOWS:  # cut long stretches
        inside = np.arange(len(least)) - np.repeat(first, sizes)
        first = np.flatnonzero(new | (inside % RUN_WINDOWS == 0))
        sizes = np.diff(np.append(first, len(least)))
    return least[first], first, sizes


def anchor_grams(h: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The hash of each gram that is an anchor, once for each place: a gram is the least of a window exactly if the
    greatest of the least values of all windows around it is its own."""
    if len(h) < length:
        return np.empty(0, np.uint64)
    span = length - gram + 1
    g = _doubled(h, gram, _mix)
    least = np.zeros(len(g) + span - 1, np.uint64)
    least[span - 1 : len(g)] = _doubled(g, span, np.minimum)
    return g[_doubled(least, span, np.maximum) == g]


def _words(text: str | None) -> list[bytes]:
    return to_bytes(text).split()


def document_anchors(docs: DataFrame, text_col: str, length: int, gram: int) -> DataFrame:
    """(_id, anchor, n): the anchors of each document, with their number of places."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), 1000):
                found, counts = [], []
                for text in batch.column(1)[at : at + 1000].to_pylist():
                    a, n = np.unique(anchor_grams(hashes.of(_words(text)), length, gram), return_counts=True)
                    found.append(a)
                    counts.append(n)
                ids = np.repeat(batch.column(0)[at : at + 1000].to_numpy(), [len(x) for x in found])
                cols = [pa.array(ids), pa.array(signed(np.concatenate(found))), pa.array(np.concatenate(counts).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["_id", "anchor", "n"])

    return docs.select("_id", F.col(text_col).alias("text")).mapInArrow(emit, "_id long, anchor long, n int")


RUN = "anchor long, _id long, start int, windows int, words binary, paths binary"
WINDOW = "path long, path2 long, _id long, start int, keys array<long>, words binary, paths binary"


def prefixes(h: np.ndarray, length: int, gram: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the key and the place of its prefix of `size` words: those from the anchor on, or the last ones of
    the window where fewer follow. The key of equal windows is equal, and equal keys have equal shorter prefixes."""
    if len(h) < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    g = _doubled(h, gram, _mix)
    least = _doubled(g, length - gram + 1, np.minimum)
    if size == gram:
        return least, np.arange(len(least))
    start = np.arange(len(least))
    anchor = np.full(len(least), -1)
    for k in range(length - gram, -1, -1):
        anchor = np.where(g[start + k] == least, start + k, anchor)
    place = np.minimum(anchor, start + length - size)
    return _mix(gram_hashes(h, size)[place], (anchor - place).astype(np.uint64)), place


def _member(values: np.ndarray, own: list[int] | None, held) -> np.ndarray:
    """Which values are in the document's own list or, if there is one, in the broadcast sorted keys."""
    if held is None:
        return np.isin(values, np.array(own or (), np.int64))
    keys = held.value
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def _runs(docs: DataFrame, text_col: str, length: int, gram: int) -> DataFrame:
    """Runs of windows whose anchor is in _known."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        names = [x.split()[0] for x in RUN.split(", ")]
        for batch in batches:
            for top in range(0, len(batch), 500):
                part = batch.slice(top, 500)
                cols: list[list] = [[] for _ in names]
                for doc, text, known in zip(*(c.to_pylist() for c in part.columns)):
                    h = hashes.of(_words(text))
                    found, first, windows = anchors(h, length, gram)
                    a = signed(found)
                    use = np.flatnonzero(_member(a, known, None))
                    if not len(use):
                        continue
                    every, path = (h >> np.uint64(32)).astype("<u4").tobytes(), gram_hashes(h, length).astype("<u8").tobytes()
                    begins, counts = first[use].tolist(), windows[use].tolist()
                    words = [every[4 * i : 4 * (i + n + length - 1)] for i, n in zip(begins, counts)]
                    paths = [path[8 * i : 8 * (i + n)] for i, n in zip(begins, counts)]
                    for c, v in zip(cols, (a[use].tolist(), [doc] * len(use), begins, counts, words, paths)):
                        c += v
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return docs.select("_id", F.col(text_col).alias("text"), "_known").mapInArrow(emit, RUN)


def _windows(docs: DataFrame, text_col: str, length: int, gram: int, sizes: list[int], held) -> DataFrame:
    """Each window whose anchor is too common (in _hot, or held), with the keys of its prefixes of the given sizes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        names = [x.split()[0] for x in WINDOW.split(", ")]
        for batch in batches:
            for top in range(0, len(batch), 500):
                part = batch.slice(top, 500)
                cols: list[list] = [[] for _ in names]
                for doc, text, hot in zip(*(c.to_pylist() for c in part.columns)):
                    h = hashes.of(_words(text))
                    starts = np.flatnonzero(_member(signed(prefixes(h, length, gram, gram)[0]), hot, held))
                    if not len(starts):
                        continue
                    keys = np.stack([signed(prefixes(h, length, gram, size)[0])[starts] for size in sizes], axis=1)
                    path, other = gram_hashes(h, length)[starts], gram_hashes(h ^ np.uint64(0xA5A5A5A5A5A5A5A5), length)[starts]
                    every, own = (h >> np.uint64(32)).astype("<u4").tobytes(), path.astype("<u8").tobytes()
                    words = [every[4 * i : 4 * (i + length)] for i in starts.tolist()]
                    values = (signed(path).tolist(), signed(other).tolist(), [doc] * len(starts), starts.tolist(), keys.tolist(), words, [own[8 * i : 8 * i + 8] for i in range(len(starts))])
                    for c, v in zip(cols, values):
                        c += v
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return docs.select("_id", F.col(text_col).alias("text"), "_hot").mapInArrow(emit, WINDOW)


class Subtree:
    """The suffixes of one group (one for each window, to its run's end) in order, with the depths of the tree above them."""

    def __init__(self, group: pa.Table):
        windows = group["windows"].to_numpy()
        words = [np.frombuffer(w, "<u4") for w in group["words"].to_pylist()]
        inside = np.concatenate([np.arange(n) for n in windows])
        self.path = np.concatenate([np.frombuffer(p, "<u8") for p in group["paths"].to_pylist()])
        self.doc = np.repeat(group["_id"].to_numpy(), windows)
        self.start = np.repeat(group["start"].to_numpy().astype(np.int64), windows) + inside
        sizes = np.array([len(w) for w in words])
        begins = np.cumsum(np.append(0, sizes[:-1] + 1))
        at = np.repeat(begins, windows) + inside
        # Behind each run a word that is nowhere else, so that nothing is shared beyond its end.
        known, rank = np.unique(np.concatenate(words), return_inverse=True)
        flat = np.empty(len(rank) + len(words), np.int64)
        ends = begins + sizes
        flat[ends] = len(known) + np.arange(len(words))
        mask = np.ones(len(flat), bool)
        mask[ends] = False
        flat[mask] = rank
        # Prefix doubling: ranks of one word, then of 2, 4, ... till all suffixes are told apart.
        levels, size = [flat.astype(np.int32)], 1
        while size < sizes.max() + 1 and len(levels[-1]) > 1:
            last = levels[-1].astype(np.int64)
            after = np.append(last[size:], np.full(min(size, len(last)), -1))
            new = np.unique((last + 1) * (len(flat) + len(known) + 2) + after + 1, return_inverse=True)[1].astype(np.int32)
            levels.append(new)
            size *= 2
            if new.max() + 1 == len(new):
                break
        self.order = np.argsort(levels[-1][at], kind="stable")
        # Words that neighbours share, from the longest stretches down.
        a, b = at[self.order][:-1].copy(), at[self.order][1:].copy()
        self.depth = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inner = np.minimum(a, b) >= 0
            same = inner & (levels[k][np.minimum(a, len(flat) - 1)] == levels[k][np.minimum(b, len(flat) - 1)])
            step = same * (1 << k)
            self.depth, a, b = self.depth + step, a + step, b + step
        before = np.where(inside > 0, flat[at - 1], -1 - np.arange(len(at)))  # where it isn't known, it is like no other
        self.before = before[self.order]

    def repeats(self, length: int) -> pa.Table:
        """_id, start, windows: for each suffix that is below an internal node of at least that depth and isn't its
        earliest, the windows in the deepest such node; those that lie beside each other are joined."""
        rank = np.empty(len(self.order), np.int64)
        rank[np.lexsort((self.start, self.doc))] = np.arange(len(rank))
        at = np.empty(len(rank), np.int64)
        at[rank] = np.arange(len(rank))
        # By rank: the depth of the deepest node in which an earlier suffix is, and that suffix.
        lost, earlier = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        deep = np.flatnonzero(np.concatenate([self.depth >= length, [False]]))
        # Suffixes that share nothing of that depth with a neighbour are no part of it.
        part = np.union1d(deep, deep + 1)
        stack: list[tuple[int, int]] = []  # depth, the earliest suffix below so far
        for least, depth in zip(rank[self.order[part]].tolist(), np.append(self.depth, 0)[part].tolist()):
            while stack and stack[-1][0] >= depth:
                node, other = stack.pop()
                least, late = min(least, other), max(least, other)
                lost[late], earlier[late] = node, least
            if depth >= length:
                stack.append((depth, least))
        late = np.flatnonzero(lost)
        n = lost[late] - length + 1
        each = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        mine, theirs = at[late][each] + k, at[earlier[late]][each] + k
        same = self.path[mine] == self.path[theirs]
        if not same.all():  # different words of equal 32-bit hashes: look for the window's path itself
            by = np.lexsort((rank, self.path))
            again = np.zeros(len(rank), bool)
            again[by[1:]] = self.path[by[1:]] == self.path[by[:-1]]
            same |= again[mine]
        gone = np.zeros(len(rank), bool)
        gone[mine[same]] = True
        spot = at[gone[at]]  # by document and start
        d, s = self.doc[spot], self.start[spot]
        fresh = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1)])) if len(d) else np.empty(0, np.int64)
        last = np.append(fresh[1:], len(d)) - 1 if len(d) else fresh
        return pa.table({"_id": pa.array(d[fresh], pa.int64()), "start": pa.array(s[fresh].astype(np.int32)), "windows": pa.array((s[last] - s[fresh] + 1).astype(np.int32))})

    def maximal(self, length: int) -> pa.Table:
        """depth, n, _id, start: the internal nodes of at least that depth whose suffixes don't all follow one word: what n
        suffixes share and no longer stretch does. The place is that of the earliest."""
        out: list[tuple[int, int, int, int]] = []
        stack: list[list] = []  # depth, first suffix

        def close(depth: int, first: int, last: int) -> None:
            if len(set(self.before[first : last + 1].tolist())) > 1:
                below = self.order[first : last + 1]
                least = below[np.lexsort((self.start[below], self.doc[below]))[0]]
                out.append((depth, last - first + 1, int(self.doc[least]), int(self.start[least])))

        for k, depth in enumerate([*self.depth.tolist(), 0]):
            first = k
            while stack and stack[-1][0] > depth:
                top, first = stack.pop()
                close(top, first, k)
            if depth >= length and (not stack or stack[-1][0] < depth):
                stack.append([depth, first])
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.table({name: pa.array(c, kind) for name, c, kind in zip(("depth", "n", "_id", "start"), cols, (pa.int32(), pa.int64(), pa.int64(), pa.int32()))})


def subtree_repeats(group: pa.Table, length: int = LENGTH) -> pa.Table:
    return Subtree(group).repeats(length)


def repeated_runs(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY, group_rows: int = GROUP_ROWS, max_broadcast_prefixes: int = MAX_BROADCAST_PREFIXES) -> DataFrame:
    """(_id, start, windows): windows that start earlier elsewhere. docs has a column _id, unique."""
    spark, few = docs.sparkSession, F.col("n") <= heavy
    repeats = "_id long, start int, windows int"
    found = [spark.createDataFrame([], repeats)]

    def in_groups(runs: DataFrame, key, n: int) -> DataFrame:
        groups = max(1, -(-n // group_rows))
        placed = runs.select(F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("bucket"), "_id", "start", "windows", "words", "paths")
        return placed.groupBy("bucket").applyInArrow(lambda t: subtree_repeats(t, length), repeats)

    def numbers(counted: DataFrame) -> dict[str, int]:
        return counted.agg(F.coalesce(F.sum(F.when(few, F.col("n"))), F.lit(0)).alias("runs"), F.count(F.when(~few, 1)).alias("many"), F.count("*").alias("keys")).first().asDict()

    def listed(keys: DataFrame, name: str) -> DataFrame:
        """docs with the anchors of `keys` that each of them holds, if any."""
        own = mine.select("_id", "anchor").join(keys.select("anchor"), "anchor").groupBy("_id").agg(F.collect_list("anchor").alias(name))
        return docs.select("_id", text_col).join(staged(own, "document-anchors"), "_id")

    mine = staged(document_anchors(docs, text_col, length, gram), "anchors")
    counted = staged(mine.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"), "repeated-anchors")
    total = numbers(counted)
    found.append(in_groups(_runs(listed(counted.where(few), "_known"), text_col, length, gram), "anchor", total["runs"]))
    if not total["many"]:
        dropped(mine, counted)
        return reduce(DataFrame.union, found)

    # Too common anchors are few: no text is shuffled for them till there are very many. Their windows are written with
    # the keys of all their longer prefixes, so texts are read once more, however long a prefix has to grow.
    if total["many"] <= max_broadcast_prefixes:
        hot = np.sort(counted.where(~few).select("anchor").toPandas()["anchor"].to_numpy(np.int64))
        common, held = docs.select("_id", text_col, F.lit(None).cast("array<long>").alias("_hot")), spark.sparkContext.broadcast(hot)
    else:
        common, held = listed(counted.where(~few), "_hot"), None
    dropped(mine, counted)
    sizes = list(range(gram + GROW, length, GROW))
    rest = staged(_windows(common, text_col, length, gram, sizes, held).withColumn("windows", F.lit(1)), "common-windows")
    for k in range(len(sizes)):
        keyed = rest.withColumn("key", F.get("keys", F.lit(k)))
        counted = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated-prefixes")
        total = numbers(counted)
        keyed = keyed.join(F.broadcast(counted) if total["keys"] <= max_broadcast_prefixes else counted, "key")
        found.append(in_groups(keyed.where(few), "key", total["runs"]))
        if not total["many"]:
            return reduce(DataFrame.union, found)
        rest = keyed.where(~few).drop("key", "n")
    where = F.struct("_id", "start")
    earliest = staged(rest.groupBy("path", "path2").agg(F.min(where).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), "nodes")
    later = rest.join(earliest, ["path", "path2"]).where(where > F.col("first"))
    return reduce(DataFrame.union, [*found, later.select("_id", "start", "windows")])


def _stretches(starts, windows, length: int) -> bytes:
    """The words that runs cover, as joined stretches (start, end) of 32-bit numbers."""
    a = np.asarray(starts, np.int64)
    order = np.argsort(a, kind="stable")
    a, b = a[order], (a + np.asarray(windows, np.int64) + length - 1)[order]
    reach = np.maximum.accumulate(b)
    first = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
    return np.stack([a[first], reach[np.append(first[1:], len(a)) - 1]], axis=1).astype("<i4").tobytes()


def _without(text: str | None, gone: bytes | None) -> tuple[str, int, int]:
    words = _words(text)
    n = len(words)
    if gone:
        kept, at = [], 0
        for start, end in np.frombuffer(gone, "<i4").reshape(-1, 2).tolist():
            kept += words[at:start]
            at = end
        words = kept + words[at:]
    return b" ".join(words).decode("utf-8", "surrogatepass"), n, n - len(words)


def with_own_keys(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with an _id that no two rows share, in the order of _id. Numbers given after a sort grow with its order; they
    are stored, so that all later stages see the same."""
    if docs.groupBy("_id").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        return docs
    placed = docs.withColumn("_row", F.monotonically_increasing_id()).orderBy("_id", F.xxhash64(text_col), "_row")
    return staged(placed.withColumn("_id", F.monotonically_increasing_id()).drop("_row"), "own-keys")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY, max_broadcast_bytes: int = MAX_BROADCAST_BYTES, max_broadcast_prefixes: int = MAX_BROADCAST_PREFIXES) -> DataFrame:
    """docs with the words that stay (joined by one space) as text, n_words and n_removed."""
    docs = with_own_keys(docs.withColumn("_id", id_or_least(id_col)), text_col)
    found = repeated_runs(docs.select("_id", text_col), text_col, length, gram, heavy, max_broadcast_prefixes=max_broadcast_prefixes)

    @F.pandas_udf("binary")
    def stretches(starts: pd.Series, windows: pd.Series) -> pd.Series:
        return pd.Series([_stretches(s, w, length) for s, w in zip(starts, windows)], dtype=object)

    by_doc = found.groupBy("_id").agg(F.collect_list("start").alias("s"), F.collect_list("windows").alias("w"))
    by_doc = staged(by_doc.select("_id", stretches("s", "w").alias("_gone")), "repeats")
    size = by_doc.agg(F.sum(F.length("_gone") + 40)).first()[0] or 0

    @F.pandas_udf("text string, n_words long, n_removed long")
    def shortened(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_without(t, g) for t, g in zip(texts, gone)], columns=["text", "n_words", "n_removed"])

    out = docs.join(F.broadcast(by_doc) if size <= max_broadcast_bytes else by_doc, "_id", "left")
    out = out.withColumn("_kept", shortened(F.col(text_col), "_gone"))
    added = {text_col: F.col("_kept.text"), "n_words": F.col("_kept.n_words"), "n_removed": F.col("_kept.n_removed")}
    return out.withColumns(added).drop("_id", "_gone", "_kept")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH worded AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, i AS pos, array_to_string(ws[i + 1 : i + 20], ' ') AS w
  FROM worded, unnest(range(0, greatest(len(ws) - 19, 0))) AS t(i)),
judged AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1 AS later FROM windows),
word AS (
  SELECT doc_id, i AS pos, ws[i + 1] AS word FROM worded, unnest(range(0, len(ws))) AS t(i)),
covered AS (
  SELECT word.doc_id, word.pos, word.word,
         coalesce(bool_or(j.later) OVER (PARTITION BY word.doc_id ORDER BY word.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM word LEFT JOIN judged j ON word.doc_id = j.doc_id AND word.pos = j.pos)
SELECT d.doc_id, CAST(count(c.pos) AS BIGINT) AS n_words, CAST(count(*) FILTER (WHERE c.gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.pos) FILTER (WHERE NOT c.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN covered c ON d.doc_id = c.doc_id GROUP BY d.doc_id
"""
