"""Near-duplicate documents by min-max hashing, with exact confirmation and components.

A document's set is its distinct shingles of k words, A-Z in lower case. Every permutation of the hashed shingles gives
two values, the least and the greatest, so half as many hash evaluations fill a signature. `bands` bands of `rows`
values (minima in one half of the bands, maxima in the other) name the buckets; with 48 bands of 6 values a pair at
similarity 0.8 misses all of them with a probability of 5e-7. Buckets only propose pairs: every link is confirmed on
the full sets.

No bucket is paired out. Documents of equal sets are one node. In each bucket the node that meets most others is
compared with all others; linked nodes are then one component, and only pairs that still lie in different components
are compared. Before that, pairs whose signatures differ far more than those of linked pairs can are left out, first by
two bits of each value of the signature, in the second round by those of a finer sketch and by what both share with the
hub: a pair at the wanted similarity is left out with a probability of 3e-7 (5 deviations), of the order of what banding
loses, and far less above it.

Defined results: a null, empty or wordless text has an empty set and is linked with nothing; fewer than k words are
one shingle. Rows of equal or missing id are documents of their own, and of a component's rows the first (missing ids
before all others, equal ids as they are stored) is the one that is kept; where ids are not unique, rows are therefore
stored once more with a key of their own. The component of a row without an id in front has no id either. Columns of the
input stay, but for n_shingles, component_id and kept, which replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import dropped, gram_hashes, id_or_least, mixed, signed, staged, table, to_bytes, word_hashes

BANDS, ROWS = 48, 6
#: Bits of each value in a sketch, and values of the finer sketch, which has one bit of each.
BITS, VALUES = 2, 2048
#: Deviations above the mean at which a pair's sketches differ too much: values differ with a probability of
#: 1 - similarity, and then their bits with 1 - 2**-bits.
FAR = 5.0
#: Ids of documents in shared buckets that are broadcast at most, to fetch their texts; more of them are joined.
MAX_BROADCAST_IDS = 500_000
#: Members of a bucket that one task pairs with others at most.
SALT_ROWS = 2048


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = [to_bytes(t).lower() for t in texts]
    for text, h in zip(data, word_hashes(data)):
        if len(h) >= k:
            yield np.unique(gram_hashes(h, k))
        elif len(h):
            yield np.array([xxhash.xxh64_intdigest(b" ".join(text.split()), seed=k)], np.uint64)
        else:
            yield np.empty(0, np.uint64)


class MinMax:
    """Signatures of sets: permutations of 32 bits of the shingle hashes."""

    CHUNK = 256

    def __init__(self, bands: int, rows: int, seed: int = 1):
        random = np.random.Generator(np.random.PCG64(seed))
        n = bands * rows // 2
        self.bands, self.rows = bands, rows
        self.times = random.integers(0, 1 << 31, size=(n, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.plus = random.integers(0, 1 << 32, size=(n, 1), dtype=np.uint32)
        self.within = random.integers(0, 1 << 63, size=(1, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = mixed(np.arange(bands, dtype=np.uint64) + np.uint64(77))
        self.room = np.empty(n * self.CHUNK, np.uint32)

    def values(self, found: np.ndarray) -> np.ndarray:
        """The least and the greatest of each permutation."""
        items, n = (found >> np.uint64(32)).astype(np.uint32), len(self.times)
        low, high = np.full(n, (1 << 32) - 1, np.uint32), np.zeros(n, np.uint32)
        for at in range(0, len(items), self.CHUNK):
            part = items[None, at : at + self.CHUNK]
            space = self.room[: n * part.shape[1]].reshape(n, -1)
            np.multiply(part, self.times, out=space)
            np.add(space, self.plus, out=space)
            np.minimum(low, space.min(axis=1), out=low)
            np.maximum(high, space.max(axis=1), out=high)
        return mixed(np.concatenate([low, high]).astype(np.uint64))

    def keys(self, values: np.ndarray) -> np.ndarray:
        """Band keys."""
        with np.errstate(over="ignore"):
            return mixed((values.reshape(self.bands, self.rows) * self.within).sum(axis=1, dtype=np.uint64) ^ self.band)


def sketch(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The upper bits of each value, in whole 64-bit numbers."""
    each = 64 // bits
    upper = np.zeros(-(-len(values) // each) * each, np.uint64)
    upper[: len(values)] = values >> np.uint64(64 - bits)
    return np.bitwise_or.reduce(upper.reshape(-1, each) << np.arange(0, 64, bits, dtype=np.uint64), axis=1)


def most_differing(values: int, bits: int, least_percent: int) -> int:
    """Of so many values, those that differ at most in sketches of pairs that may reach the similarity."""
    p = (1 - least_percent / 100) * (1 - 0.5**bits)
    return int(values * p + FAR * (values * p * (1 - p)) ** 0.5)


def near_sketches(x: str, y: str, values: int, least_percent: int) -> Column:
    """Whether two sketches of two bits differ in so few values that the similarity may be reached."""

    def differ(i: int) -> Column:
        both = F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))
        return F.bit_count(both.bitwiseOR(F.shiftright(both, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    counts = [differ(i) for i in range(-(-values * BITS // 64))]
    return sum(counts[1:], counts[0]) <= F.lit(most_differing(values, BITS, least_percent))


def signatures(docs: DataFrame, text_col: str, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """_key, _id, n (size of the set), same (16-byte digest of the set; null if empty), keys (one for each band), sketch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minmax = MinMax(bands, rows)
        for batch in batches:
            n, same, keys, sketches = [], [], [], []
            for at in range(0, len(batch), 500):
                for found in shingle_sets(batch.column(2)[at : at + 500].to_pylist(), k):
                    values = minmax.values(found)
                    n.append(len(found))
                    same.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    keys.append(signed(minmax.keys(values)) if len(found) else None)
                    sketches.append(signed(sketch(values)) if len(found) else None)
            longs = pa.list_(pa.int64())
            cols = [pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(keys, longs), pa.array(sketches, longs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["_key", "_id", "n", "same", "keys", "sketch"])

    return docs.select("_key", "_id", F.col(text_col).alias("text")).mapInArrow(emit, "_key long, _id long, n long, same binary, keys array<long>, sketch array<long>")


def sets_of(docs: DataFrame, nodes: DataFrame, text_col: str, k: int, values: int) -> DataFrame:
    """node, items, finer (sketch of that many values) for the documents whose key is in nodes (a written table)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finer = MinMax(1, values, seed=2)
        for batch in batches:
            for at in range(0, len(batch), 500):
                found = list(shingle_sets(batch.column(1)[at : at + 500].to_pylist(), k))
                longs = pa.list_(pa.int64())
                sketches = [signed(sketch(finer.values(x), 1)) if values else None for x in found]
                cols = [pa.array([signed(x) for x in found], longs), pa.array(sketches, longs)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 500], *cols], names=["node", "items", "finer"])

    few = nodes.count() <= MAX_BROADCAST_IDS
    source = docs.select(F.col("_key").alias("node"), F.col(text_col).alias("text"))
    wanted = source.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    return wanted.mapInArrow(emit, "node long, items array<long>, finer array<long>")


def similar(both: Column, n_a: Column, n_b: Column, least_percent: int) -> Column:
    return 100 * both >= least_percent * (n_a + n_b - both)


def _ends(pairs: DataFrame, about: DataFrame, cols: list[str]) -> DataFrame:
    """pairs (a, b) with columns of both nodes, named with _a and _b behind."""
    for end in ("a", "b"):
        pairs = pairs.join(about.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in cols]), end)
    return pairs


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, n_a, n_b) with `both`, the number of items that their full sets share; written."""
    full = _ends(pairs, sets, ["items"])
    return staged(full.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("items_a", "items_b")).alias("both")), "overlaps")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the least node of each component as root, for a written table of edges (a, b).

    Each vertex points to its least neighbour, pointers are followed to their ends, the ends become the vertices of the
    contracted graph, until no edge is left."""
    mapping, used = None, []
    while True:
        both = edges.union(edges.select("b", "a"))
        parent = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up")), "parents")
        while True:
            used.append(parent)
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = staged(parent.join(above, "up").select("node", "up", "top"), "jumps")
            moved = not jumped.where("up <> top").isEmpty()
            parent = jumped.select("node", F.col("top").alias("up"))
            if not moved:
                break
        used.append(jumped)
        if mapping is None:
            mapping = parent.select("node", F.col("up").alias("root"))
        else:
            up = parent.select(F.col("node").alias("root"), "up")
            mapping = mapping.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        ends = parent.select(F.col("node").alias("a"), F.col("up").alias("top_a"))
        ends_b = ends.toDF("b", "top_b")
        edges = edges.join(ends, "a").join(ends_b, "b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
        edges = staged(edges.where("a <> b").distinct(), "contracted")
        if edges.isEmpty():
            out = staged(mapping, "components")
            dropped(*used, edges)
            return out
        used.append(edges)


def with_own_keys(docs: DataFrame, id_col: str) -> DataFrame:
    """docs with _id and a _key that no two rows share: the id, or where ids are not unique a stored number."""
    docs = docs.withColumn("_id", id_or_least(id_col))
    if docs.groupBy("_id").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        return docs.withColumn("_key", F.col("_id"))
    return staged(docs.withColumn("_key", F.monotonically_increasing_id()), "own-keys")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, least_percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """docs with n_shingles, component_id (the least id that links reach) and kept (one row of each component)."""
    docs = with_own_keys(docs, id_col)
    made = staged(signatures(docs, text_col, k, bands, rows), "signatures")
    # Documents of equal sets are one node, named by their least key.
    first = made.where("same is not null").groupBy("same").agg(F.min("_key").alias("node"))
    placed = staged(made.select("_key", "_id", "n", "same").join(first, "same", "left").select("_key", "_id", "n", "node"), "placed")
    nodes = staged(made.join(placed.where("_key = node").select("_key"), "_key", "left_semi").select(F.col("_key").alias("node"), "n", "keys", "sketch"), "nodes")
    dropped(made)
    member = _members(nodes)
    hubs, pairs = _hub_pairs(member, nodes, least_percent, bands * rows)
    chosen = staged(_nodes_of(pairs), "compared-nodes")
    sets = staged(sets_of(docs, chosen, text_col, k, 0), "set-items")
    tested = overlaps(pairs, sets)
    dropped(pairs, chosen, sets)
    edges = _links(tested, least_percent)
    root = None if edges.isEmpty() else components(edges)
    opened = _open_members(member, hubs, root)
    dropped(member, hubs)
    if opened is not None:
        chosen = staged(opened.select("node").distinct(), "open-nodes")
        sets = staged(sets_of(docs, chosen, text_col, k, VALUES), "open-items")
        pairs = _open_pairs(opened, nodes, sets, tested, least_percent)
        more = overlaps(pairs, sets)
        dropped(opened, chosen, sets, pairs)
        edges = edges.union(_links(more, least_percent))
        root = None if edges.isEmpty() else components(edges)
    dropped(nodes)

    found = placed.withColumn("_c", F.coalesce("node", "_key"))
    if root is not None:
        found = found.join(root.select(F.col("node").alias("_c"), "root"), "_c", "left").withColumn("_c", F.coalesce("root", "_c"))
    least = found.groupBy("_c").agg(F.min(F.struct("_id", "_key")).alias("_first"))
    verdict = found.join(least, "_c").select("_key", F.col("n").alias("_n"), "_first")
    real = F.when(F.col("_first._id") == F.lit(-(1 << 63)), F.lit(None)).otherwise(F.col("_first._id"))
    added = {"n_shingles": F.col("_n"), "component_id": real, "kept": F.col("_key") == F.col("_first._key")}
    return docs.join(verdict, "_key").withColumns(added).drop("_id", "_key", "_n", "_first")


def _members(nodes: DataFrame) -> DataFrame:
    """(key, node, c) for the buckets with c > 1 nodes."""
    each = nodes.select("node", F.explode("keys").alias("key"))
    shared = staged(each.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "buckets")
    out = staged(each.join(shared, "key").select("key", "node", "c"), "members")
    dropped(shared)
    return out


def _links(compared: DataFrame, least_percent: int) -> DataFrame:
    return compared.where(similar(F.col("both"), F.col("n_a"), F.col("n_b"), least_percent)).select("a", "b")


def _hub_pairs(member: DataFrame, nodes: DataFrame, least_percent: int, values: int) -> tuple[DataFrame, DataFrame]:
    """The hub of each bucket (key, hub), its node that meets most others, and each node with the hubs of its buckets
    as pairs (a, b, n_a, n_b) whose sizes and sketches allow the similarity."""
    met = member.groupBy("node").agg(F.sum("c").alias("met"))
    hubs = staged(member.join(met, "node").groupBy("key").agg(F.max_by("node", F.struct("met", "node")).alias("hub")), "hubs")
    pair = member.join(hubs, "key").where("node <> hub")
    pair = pair.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    known = _ends(pair, nodes, ["n", "sketch"])
    sized = similar(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b"), least_percent)
    return hubs, staged(known.where(sized & near_sketches("sketch_a", "sketch_b", values, least_percent)).select("a", "b", "n_a", "n_b"), "pairs")


def _open_members(member: DataFrame, hubs: DataFrame, root: DataFrame | None) -> DataFrame | None:
    """key, node, part (its component), main (the bucket's largest one), total (the bucket's members) and hub, for the
    buckets that hold several components."""
    inside = member.withColumn("part", F.col("node")) if root is None else member.join(root, "node", "left").withColumn("part", F.coalesce("root", "node"))
    parts = inside.groupBy("key", "part").agg(F.count("*").alias("size"))
    main = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("size").alias("total"), F.max_by("part", F.struct("size", "part")).alias("main"))
    # In a bucket of two, the hub was compared with all.
    main = staged(main.where("parts > 1 and total > 2"), "open-buckets")
    out = None if main.isEmpty() else staged(inside.join(main, "key").join(hubs, "key").select("key", "node", "part", "main", "total", "hub"), "open-members")
    dropped(main)
    return out


def _open_pairs(opened: DataFrame, nodes: DataFrame, sets: DataFrame, tested: DataFrame, least_percent: int) -> DataFrame:
    """Pairs of nodes of a bucket that are in different components, but for hubs', which have been compared. Two sets
    have no more in common than the smaller of their parts inside the hub and the smaller of those outside."""
    known = opened.where("node <> hub").withColumns({"a": F.least("hub", "node"), "b": F.greatest("hub", "node")})
    known = known.join(tested.select("a", "b", "both"), ["a", "b"], "left").join(nodes.select("node", "n", "keys"), "node").join(sets.select("node", "finer"), "node")
    # One column a number, so that comparing them stays a short compiled loop.
    bits = {f"f{i}": F.coalesce(F.get("finer", F.lit(i)), F.lit(0).cast("long")) for i in range(VALUES // 64)}
    known = known.withColumns(bits).select("key", "node", "part", "main", "total", "n", "both", "keys", *bits)
    known = staged(known, "open-sketches")
    # The nodes outside the largest component are dealt to tasks, which see all the other nodes of the bucket.
    salts = F.ceil(F.col("total") / SALT_ROWS).cast("int")
    side = lambda df, s, *more: df.select("key", "salt", *more, *[F.col(c).alias(f"{c}_{s}") for c in ("node", "part", "n", "both", "keys", *bits)])
    outer = side(known.where("part <> main").withColumn("salt", F.pmod(F.xxhash64("node"), salts).cast("int")), "x")
    other = side(known.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))), "y", (F.col("part") == F.col("main")).alias("y_main"))
    most = F.expr("if(both_x is null or both_y is null, least(n_x, n_y), least(both_x, both_y) + least(n_x - both_x, n_y - both_y))")
    differ = [F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in bits]
    near = similar(most, F.col("n_x"), F.col("n_y"), least_percent) & (sum(differ[1:], differ[0]) <= F.lit(most_differing(VALUES, 1, least_percent)))
    # A pair that shares several buckets is of the first of them alone.
    near = near & (F.get(F.array_intersect("keys_x", "keys_y"), F.lit(0)) == F.col("key"))
    pair = outer.join(other, ["key", "salt"]).where(F.expr("part_x <> part_y and (y_main or node_x < node_y)") & near)
    swap = F.col("node_x") > F.col("node_y")
    pick = lambda c, s, t: F.when(swap, F.col(f"{c}_{t}")).otherwise(F.col(f"{c}_{s}"))
    out = pair.select(pick("node", "x", "y").alias("a"), pick("node", "y", "x").alias("b"), pick("n", "x", "y").alias("n_a"), pick("n", "y", "x").alias("n_b"))
    out = staged(out.distinct(), "open-pairs")
    dropped(known)
    return out


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, k=2, least_percent=80).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
         ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS items
  FROM worded),
item AS (SELECT doc_id, len(items) AS n, unnest(items) AS s FROM shingled),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n_a, any_value(y.n) AS n_b, count(*) AS n_both
  FROM item x JOIN item y ON x.s = y.s AND x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY ALL),
link AS (SELECT a, b FROM pair WHERE 100 * n_both >= 80 * (n_a + n_b - n_both)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept
FROM shingled s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON s.doc_id = r.a
"""
