"""Ranked lexical search by range-maximum queries over posting lists.

The index is a table with a row for each run of documents of one task: their ids, their lengths, and for each term of
the queries a posting list of places and counts. No text and no posting is shuffled; totals (documents, terms, documents
of a term) are sums over the rows of the index.

A search takes one row of the index. Each posting list has a sparse table: for every place and power of two the
place of the maximum score among so many postings. An interval of documents is bounded by the sum of its lists' maxima.
Intervals are opened best first, a few at a time: each is split at the document of the largest maximum, whose score is
computed from all lists, and what remains on its two sides is bounded again. A search ends when no open interval can
hold a document of the best `limit`; documents stand in the order of their ids, so an interval of equal bound is out
where its first id is too late. A task keeps each item's best over all rows of the index that it reads, so later
searches begin with that bound; the tasks' best are ranked together.

Items come in blocks of at most `item_block`, each with its own index, so neither a broadcast nor the driver holds more
terms than a block has.

Defined results: null texts and texts without a term are in no total and are never found; items without a term find
nothing; equal texts are documents of their own, and so are rows of equal id (their order is open); documents without an
id stand before all others. Repeated items are ranked each. Empty tables give an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetables.llm.common import dropped, staged, table, to_bytes

#: What separates terms becomes a space, A-Z become a-z; bytes of other characters stay.
_TERMS = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))
#: A row of the index ends at so many documents or postings.
MAX_DOCS, MAX_POSTINGS = 16_384, 1 << 20
#: Items that are searched together at most.
ITEM_BLOCK = 2_000
#: Intervals that are opened together.
AT_ONCE = 24
_INDEX = "ids array<long>, lengths array<long>, terms array<int>, sizes array<int>, places array<int>, counts array<int>"


def terms_of(text: str | None) -> list[bytes]:
    return to_bytes(text).translate(_TERMS).split()


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """The written index of all documents with a term, with posting lists of the vocabulary's terms."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        ids, lengths, terms, places, counts = [], [], [], [], []
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())

        def row() -> pa.RecordBatch:
            order = np.argsort(np.array([-(1 << 63) if i is None else i for i in ids], np.int64), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            t, p, c = np.array(terms, np.int32), rank[np.array(places, np.int64)] if places else np.empty(0, np.int32), np.array(counts, np.int32)
            by = np.lexsort((p, t))
            own, sizes = np.unique(t, return_counts=True)
            values = [[ids[k] for k in order], np.array(lengths, np.int64)[order], own, sizes.astype(np.int32), p[by], c[by]]
            arrays = [pa.array([v], longs if k < 2 else ints) for k, v in enumerate(values)]
            for part in (ids, lengths, terms, places, counts):
                part.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["ids", "lengths", "terms", "sizes", "places", "counts"])

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = terms_of(text)
                    if not found:
                        continue
                    of = Counter(map(known.get, found))
                    of.pop(None, None)
                    terms.extend(of)
                    counts.extend(of.values())
                    places.extend([len(ids)] * len(of))
                    ids.append(i)
                    lengths.append(len(found))
                    if len(ids) >= max_docs or len(terms) >= max_postings:
                        yield row()
        if ids:
            yield row()

    return staged(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(emit, _INDEX), "search-index")


def weights(index: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """Each term's weight, the number of documents N and of terms L, of all rows of the index."""
    total = index.agg(F.sum(F.size("ids").cast("long")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n, length = total[0] or 0, total[1] or 0
    found = np.full(n_terms, 0, np.int64)
    per = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes").alias("df"))
    for r in per.collect():  # one row for each term of the block's items
        found[r["terms"]] = r["df"]
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in found], np.int64), n, length


class Block:
    """One row of the index, ready to be searched."""

    def __init__(self, row: dict, weight: np.ndarray, n: int, length: int):
        self.ids = np.array([-(1 << 63) if i is None else i for i in row["ids"].to_pylist()], np.int64) if row["ids"].null_count else row["ids"].to_numpy()
        lengths = row["lengths"].to_numpy().astype(np.int64)
        if int(lengths.max()) * 50 * n < 1 << 63:
            m = 50 + 50 * lengths * n // length
        else:
            m = np.array([50 + 50 * int(x) * n // length for x in lengths.tolist()], np.int64)
        terms, sizes = row["terms"].to_numpy(), row["sizes"].to_numpy().astype(np.int64)
        self.docs = row["places"].to_numpy().astype(np.int64)
        tf = row["counts"].to_numpy().astype(np.int64)
        self.score = np.repeat(weight[terms], sizes) * (1_000_000_000 * tf // (1000 * tf + 20 * m[self.docs]))
        ends = np.cumsum(sizes)
        self.lists = dict(zip(terms.tolist(), zip((ends - sizes).tolist(), ends.tolist())))
        #: Every posting as (list, document) in one sorted array; a list is named by its number here.
        self.number = {t: k for k, t in enumerate(terms.tolist())}
        self.width = len(self.ids) + 1
        self.keys = np.repeat(np.arange(len(terms), dtype=np.int64), sizes) * self.width + self.docs
        # The sparse tables of all lists lie in one array a level; a query never crosses the end of its list.
        self.tables = [np.arange(len(self.docs), dtype=np.int32)]
        half = 1
        while 2 * half <= (int(sizes.max()) if len(sizes) else 0):
            under = self.tables[-1]
            other = np.concatenate([under[half:], under[-1:].repeat(min(half, len(under)))])[: len(under)]
            self.tables.append(np.where(self.score[other] > self.score[under], other, under))
            half *= 2
        self.table = np.stack(self.tables) if len(self.docs) else np.zeros((1, 0), np.int32)
        self.log = np.concatenate([[0, 0], np.floor(np.log2(np.arange(2, len(self.docs) + 2))).astype(np.int64)])

    def maxima(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ranges of postings the maximum score (0 if empty) and its place, the first one among equals."""
        size = end - first
        level = self.log[np.maximum(size, 0)]
        some = size > 0
        left = self.table[level, np.where(some, first, 0)]
        right = self.table[level, np.where(some, end - (1 << level), 0)]
        at = np.where(self.score[right] > self.score[left], right, left)
        return np.where(some, self.score[at], 0), at

    def search(self, terms: list[int], best: list[tuple[int, int]], limit: int) -> int:
        """Adds the block's documents to best, a heap of the `limit` best (score, -id) of one item; the number of
        intervals that were opened."""
        lists = [self.lists[t] for t in terms if t in self.lists]
        if not lists:
            return 0
        base = np.array([self.number[t] for t in terms if t in self.lists], np.int64) * self.width
        first, end = np.array(lists, np.int64).T

        def out(bound: int, l: int) -> bool:
            return bound <= 0 or len(best) == limit and (bound, -int(self.ids[l])) <= best[0]

        pool: dict[int, tuple] = {}
        heap: list[tuple[int, int, int]] = []
        opened, keys = 0, itertools.count()

        def add(l: np.ndarray, r: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            value, at = self.maxima(a, b)
            bound, top = value.sum(axis=1), value.argmax(axis=1)
            split = self.docs[at[np.arange(len(top)), top]]
            for k in np.flatnonzero(bound > 0).tolist():
                x, start = int(bound[k]), int(l[k])
                if not out(x, start):
                    key = next(keys)
                    pool[key] = (start, int(r[k]), int(split[k]), a[k], b[k])
                    heapq.heappush(heap, (-x, start, key))

        add(np.array([0]), np.array([len(self.ids)]), first[None], end[None])
        while heap:
            now = []
            while heap and len(now) < AT_ONCE:
                bound, l, key = heapq.heappop(heap)
                if out(-bound, l):
                    if len(best) == limit and -bound < best[0][0]:
                        heap.clear()  # all others are bounded by less
                    continue
                now.append(pool.pop(key))
            if not now:
                break
            opened += len(now)
            l, r, d = (np.array([x[k] for x in now], np.int64) for k in range(3))
            a, b = np.array([x[3] for x in now]), np.array([x[4] for x in now])
            wanted = base[None] + d[:, None]
            at = np.searchsorted(self.keys, wanted)
            hit = (at < b) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)
            scores = np.where(hit, self.score[np.minimum(at, len(self.keys) - 1)], 0).sum(axis=1)
            for doc, score in zip(d.tolist(), scores.tolist()):
                one = (score, -int(self.ids[doc]))
                if score > 0 and len(best) < limit:
                    heapq.heappush(best, one)
                elif score > 0 and one > best[0]:
                    heapq.heapreplace(best, one)
            at = np.clip(at, a, b)
            add(np.concatenate([l, d + 1]), np.concatenate([d, r]), np.concatenate([a, at + hit]), np.concatenate([at, b]))
        return opened


def ranked(index: DataFrame, items: dict[int, list[int]], n_terms: int, limit: int) -> DataFrame:
    """(item, doc_id, score, rank): each item's best documents over all rows of the index. items: number to its terms."""
    weight, n, length = weights(index, n_terms)
    held = index.sparkSession.sparkContext.broadcast((items, weight))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = held.value
        best: dict[int, list[tuple[int, int]]] = {k: [] for k in items}
        for batch in batches:
            for at in range(len(batch)):
                block = Block({name: batch.column(k)[at].values for k, name in enumerate(batch.schema.names)}, weight, n, length)
                for item, terms in items.items():
                    block.search(terms, best[item], limit)
        rows = [(k, -i, s) for k, heap in best.items() for s, i in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["item", "doc_id", "score"])

    found = index.mapInArrow(emit, "item long, doc_id long, score long")
    by = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    out = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= limit)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))


def search(docs: DataFrame, items: DataFrame, item_col: str = "item_id", item_text: str = "text", limit: int = 50, id_col: str = "doc_id", text_col: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """item_col, rank, doc_id, score: for each item its `limit` best documents of a score above 0."""
    spark = docs.sparkSession
    numbered = staged(items.select(F.col(item_col).alias("own"), F.col(item_text).alias("query")).withColumn("item", F.monotonically_increasing_id()), "search-items")
    results: list[DataFrame] = []
    low = -1
    while True:  # blocks of items, in the order of their numbers
        rows = numbered.where(F.col("item") > low).orderBy("item").limit(item_block).collect()
        if not rows:
            break
        low = rows[-1]["item"]
        vocabulary: dict[bytes, int] = {}
        wanted = {r["item"]: sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(r["query"])}) for r in rows}
        index = build_index(docs, vocabulary, id_col, text_col)
        results.append(staged(ranked(index, wanted, len(vocabulary), limit), "search-results"))
        dropped(index)
    if not results:
        return spark.createDataFrame([], f"{item_col} {dict(items.dtypes)[item_col]}, rank int, doc_id long, score long")
    found = reduce(DataFrame.unionByName, results)
    return found.join(numbered.select("item", "own"), "item").select(F.col("own").alias(item_col), "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
total AS (SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM doc WHERE len(ts) > 0),
posting AS (
  SELECT r, doc_id, t, count(*) AS tf, len AS n FROM (SELECT r, doc_id, len(ts) AS len, unnest(ts) AS t FROM doc) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM posting GROUP BY t),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
scored AS (
  SELECT w.item_id, p.r, p.doc_id, sum(CAST(floor(1000 * ln((2 * total.n + 2) / (2 * df.df + 1)::DOUBLE)) AS BIGINT) *
         ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * p.n * total.n) // total.l))))::BIGINT AS score
  FROM wanted w JOIN posting p USING (t) JOIN df USING (t), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""
