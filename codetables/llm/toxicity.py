"""Toxicity by class-conditional Kneser-Ney models of words.

Two bigram models, of toxic and of ordinary labelled texts, interpolate discounted counts (modified Kneser-Ney): bigrams
back off to their class's words, and those to continuation counts that both classes share. An expression counts once a
text, so that a text that repeats itself weighs no more than others. Words that one text of a class has, and pairs that
fewer than LEAST have, are discounted wholly: they pass their mass to the backoff, so that an expression seen seldom or
never says as much as the shared counts do.
Counts are made over all labelled rows that are not held out; they and the models are tables that grow with the input,
with no cap on words or pairs.

A text's log-likelihoods under both models are normalised by its length and compared: a sum of what each word, each
word as a context, and each pair that the models hold adds. What the greatest single word says is kept besides, so that
one insult in a long text counts. The most frequent expressions are looked up in a broadcast table of at most HEAD rows;
others meet the models' table in a join, if a filter of at most FILTER_BITS bits doesn't rule them out first. Both change
what is shuffled and nothing else.

Both differences are combined by a logistic function. That is fitted (on at most SAMPLE labelled rows of scores, chosen
by a hash) on scores from models that did not see the row, and shifted so that 0.7 is the best cut on them.

Defined results: a text without words, empty or null, has differences of 0. Rows are scored one by one, so ids may
repeat or be missing; for learning, labels are joined by id. Without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import dropped, signed, staged, table, word_hashes

SAMPLE = 50_000
#: Rows of the models that are broadcast at most, and bits of the filter for the others.
HEAD, FILTER_BITS = 500_000, 1 << 28
#: Texts of a class that must have a word, and a pair, for more than its backoff; fewer are discounted wholly.
LEAST = {"word": 2, "pair": 20}
#: Contexts that every word is given in the shared counts, so that the rarest words say least.
FLOOR = 100.0
#: Labels that are broadcast at most (12 bytes each), to meet their texts; more of them are joined.
MAX_BROADCAST_LABELS = 1_000_000
CUT = 0.7
#: For each byte whether it is no letter (bytes of other characters than ASCII are).
NO_LETTER = np.array([c < 128 and not chr(c).isalpha() for c in range(256)])
#: The models: of all rows that learn, and of either half of them, by fold.
MODELS = {"all": ("0", "2"), "from0": ("0",), "from2": ("2",)}
#: Count columns: of ordinary (0) and toxic (1) texts in the folds 0 and 2, which learn.
COLUMNS = ["c00", "c01", "c20", "c21"]
_TURN = 23


def letter_words(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Hashes of the runs of letters of each text, in lower case; never 0."""
    for h in word_hashes([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts], NO_LETTER):
        yield h | np.uint64(1)


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return h ^ (w << np.uint64(_TURN) | w >> np.uint64(64 - _TURN))


def _pair_key(h: str, w: str) -> Column:
    turned = F.shiftleft(F.col(w), _TURN).bitwiseOR(F.shiftrightunsigned(F.col(w), 64 - _TURN))
    return F.col(h).bitwiseXOR(turned)


def fold(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)).cast("int")


# ---- counts and models, as tables


def counted(rows: DataFrame) -> DataFrame:
    """(h, w, COLUMNS): texts of rows (text, toxic, fold) that have the word w behind h, and with h = 0 at all. Batches are
    counted before they are shuffled."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = batch.column(1).to_numpy() + np.where(batch.column(2).to_numpy() == 2, 2, 0)
            for at in range(0, len(batch), 4000):
                before, words, keys, sizes = [], [], [], []
                for h in letter_words(batch.column(0)[at : at + 4000].to_pylist()):
                    pair, place = np.unique(pair_keys(h[:-1], h[1:]), return_index=True)
                    single = np.unique(h)
                    before += [np.zeros(len(single), np.uint64), h[place]]
                    words += [single, h[place + 1]]
                    keys += [single, pair]
                    sizes.append(len(single) + len(pair))
                key, place, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
                where = np.repeat(side[at : at + 4000], sizes)
                counts = np.bincount(inverse * 4 + where, minlength=4 * len(key)).reshape(-1, 4).astype(np.int64)
                cols = [pa.array(signed(np.concatenate(x)[place])) for x in (before, words)]
                # Two counts to a number, 32 bits each, and rows of one context together: fewer bytes to shuffle.
                both = [pa.array(counts[:, k] + (counts[:, k + 1] << 32)) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*cols, *both], names=["h", "w", "f0", "f2"]).sort_by("h")

    part = rows.select("text", "toxic", "fold").mapInArrow(emit, "h long, w long, f0 long, f2 long")
    dealt = part.withColumn("p", F.when(F.col("h") == 0, F.col("w")).otherwise(F.col("h"))).repartition("p")
    sums = dealt.groupBy("p", "h", "w").agg(F.sum("f0").alias("f0"), F.sum("f2").alias("f2"))
    low = F.lit((1 << 32) - 1)
    apart = {f"c{f}{c}": (F.shiftrightunsigned(f"f{f}", 32) if c else F.col(f"f{f}").bitwiseAND(low)) for f in "02" for c in (0, 1)}
    return sums.withColumns(apart).select("h", "w", *COLUMNS)


def _count(model: str, side: int) -> Column:
    folds = MODELS[model]
    return sum((F.col(f"c{f}{side}") for f in folds[1:]), F.col(f"c{folds[0]}{side}"))


def _less(count: Column, off: list[float]) -> Column:
    """A count without its discount: off[k - 1] of k, the last of it and all above."""
    out = F.when(count < 1, F.lit(0.0))
    for k, x in enumerate(off[:-1], 1):
        out = out.when(count == k, F.lit(k - x))
    return out.otherwise(count - F.lit(off[-1]))


def discounts(n: list[int], least: int) -> list[float]:
    """Modified Kneser-Ney discounts of counts of 1, 2, ... from how many counts of 1 to 4 there are. Counts below
    `least` are discounted wholly, and so are no less than that by those above."""
    n = [max(1, x) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    usual = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.5 * k**0.5), 0.95 * k) for k in (1, 2, 3)]
    return [float(k) if k < least else usual[min(k, 3) - 1] for k in range(1, max(3, least) + 1)]


@dataclass
class Learned:
    model: DataFrame  # key, word (or a pair), of (how many texts have it), and for each of MODELS: add_, back_, peak_
    unseen: dict[str, float]  # what a word that the models don't hold adds
    weights: np.ndarray | None = None  # of a constant and the differences


def build(rows: DataFrame) -> Learned | None:
    """The models for rows (text, toxic, fold); None without words of both classes."""
    counts = staged(counted(rows).sortWithinPartitions("h"), "expressions")  # equal contexts take little space
    sides = [(m, c) for m in MODELS for c in (0, 1)]
    numbers = [F.count("*").alias("rows")]
    for m, c in sides:
        x = _count(m, c)
        numbers += [F.sum(x).alias(f"sum_{m}{c}"), F.count(F.when(x > 0, 1)).alias(f"some_{m}{c}"), *[F.count(F.when(x == k, 1)).alias(f"n{k}_{m}{c}") for k in (1, 2, 3, 4)]]
    stats = {bool(r["pair"]): r.asDict() for r in counts.groupBy((F.col("h") != 0).alias("pair")).agg(*numbers).collect()}
    word = stats.get(False)
    if not word or not all(word[f"sum_{m}{c}"] for m, c in sides):
        return None
    pair = stats.get(True) or dict.fromkeys(word, 0)
    off = {(kind, m, c): discounts([s[f"n{k}_{m}{c}"] for k in (1, 2, 3, 4)], LEAST[kind]) for kind, s in (("word", word), ("pair", pair)) for m, c in sides}
    # Share of a class's words that its discounts leave to the shared counts.
    assert max(LEAST["word"], 3) <= 4

    def left_of(m: str, c: int) -> float:
        x, last = off["word", m, c], len(off["word", m, c])
        exact = [word[f"n{k}_{m}{c}"] for k in range(1, last)]
        taken = sum(d * n for d, n in zip(x, exact)) + x[-1] * (word[f"some_{m}{c}"] - sum(exact))
        return max(taken / word[f"sum_{m}{c}"], 1e-6)

    left = {(m, c): left_of(m, c) for m, c in sides}
    all_contexts = pair["rows"] + FLOOR * (word["rows"] + 1)

    pairs = counts.where("h <> 0")
    contexts = pairs.groupBy("w").agg(F.count("*").alias("contexts"))
    words = counts.where("h = 0").drop("h").join(contexts, "w", "left")
    shared = (F.coalesce("contexts", F.lit(0)) + FLOOR) / all_contexts
    p = {f"p_{m}{c}": _less(_count(m, c), off["word", m, c]) / word[f"sum_{m}{c}"] + left[m, c] * shared for m, c in sides}
    words = staged(words.withColumns(p).select("w", *COLUMNS, *p), "word-models")

    held = {kind: (_count("all", 0) >= n) | (_count("all", 1) >= n) for kind, n in LEAST.items()}
    kept = {f"k_{m}{c}": _less(_count(m, c), off["pair", m, c]) for m, c in sides}
    seen = pairs.groupBy("h").agg(*[F.sum(c).alias(f"s{c[1:]}") for c in COLUMNS], *[F.sum(k).alias(f"of_{n}") for n, k in kept.items()])
    seen = seen.where(" or ".join(f"of_{n} > 0" for n in kept))

    def rest(m: str, c: int) -> Column:
        """Of what follows a context, the share that the pairs' discounts leave to the backoff."""
        total = F.greatest(F.lit(1), sum(F.col(f"s{f}{c}") for f in MODELS[m]))
        return F.greatest(F.lit(1e-3), 1 - F.col(f"of_k_{m}{c}") / total)

    behind = seen.select("h", *[rest(m, c).alias(f"rest_{m}{c}") for m, c in sides], *[F.greatest(F.lit(1), sum(F.col(f"s{f}{c}") for f in MODELS[m])).alias(f"total_{m}{c}") for m, c in sides])
    behind = staged(behind, "contexts")

    def ratio(x: dict[int, Column]) -> Column:
        return F.log(x[1] / x[0])

    back = {m: ratio({c: F.col(f"rest_{m}{c}") for c in (0, 1)}) for m in MODELS}
    says = {m: ratio({c: F.col(f"p_{m}{c}") for c in (0, 1)}) for m in MODELS}
    texts_of = sum(F.col(c) for c in COLUMNS)
    single = words.join(behind.withColumnRenamed("h", "w"), "w", "left").where(held["word"] | F.col("rest_all0").isNotNull())
    single = single.select(F.col("w").alias("key"), F.lit(True).alias("word"), texts_of.alias("of"), *[x for m in MODELS for x in (says[m].alias(f"add_{m}"), F.coalesce(back[m], F.lit(0.0)).alias(f"back_{m}"), says[m].alias(f"peak_{m}"))])

    chances = {m: {c: F.col(f"k_{m}{c}") / F.col(f"total_{m}{c}") + F.col(f"rest_{m}{c}") * F.col(f"p_{m}{c}") for c in (0, 1)} for m in MODELS}
    double = pairs.where(held["pair"]).withColumns({**kept, "of": texts_of}).drop(*COLUMNS).join(behind, "h").join(words.drop(*COLUMNS), "w")
    double = double.select(_pair_key("h", "w").alias("key"), F.lit(False).alias("word"), "of", *[x for m in MODELS for x in ((ratio(chances[m]) - says[m] - back[m]).alias(f"add_{m}"), F.lit(0.0).alias(f"back_{m}"), F.lit(None).cast("double").alias(f"peak_{m}"))])
    model = staged(single.union(double), "models")
    dropped(counts, words, behind)
    return Learned(model, {m: float(np.log(left[m, 1] / left[m, 0])) for m in MODELS})


# ---- differences of texts


class Keyed:
    """Rows of numbers by 64-bit keys, looked up by the keys' first bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(0))
        self.values = np.concatenate([values[order], np.zeros((1, values.shape[1]), values.dtype)])
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys[:-1], np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each key; the last row, of zeros, for others."""
        at, none = self.first[x >> self.shift], len(self.keys) - 1
        out, todo = np.full(len(x), none), np.arange(len(x))
        while len(todo):
            here = self.keys[at[todo]]
            found = (here == x[todo]) & (at[todo] < none)
            out[todo[found]] = at[todo[found]]
            todo = todo[(here < x[todo]) & (at[todo] < none)]
            at[todo] += 1
        return out


def _places(key: Column, bits: int) -> list[Column]:
    """The two bits of the filter that a key sets."""
    return [key.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(key, 34).bitwiseAND(F.lit(bits - 1))]


def _may_hold(filter_words: np.ndarray, x: np.ndarray, bits: int) -> np.ndarray:
    out = np.ones(len(x), bool)
    for at in (x & np.uint64(bits - 1), (x >> np.uint64(34)) & np.uint64(bits - 1)):
        out &= (filter_words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _split(model: DataFrame, head: int) -> tuple[DataFrame, DataFrame]:
    """The rows of most texts, `head` at most, and the others."""
    by = model.groupBy(F.floor(F.log2("of") * 8).alias("b")).agg(F.count("*").alias("n")).collect()
    least, room = 1 << 30, head
    for r in sorted(by, key=lambda r: -r["b"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["b"]
    frequent = F.floor(F.log2("of") * 8) >= least
    return model.where(frequent), model.where(~frequent)


def differences(docs: DataFrame, learned: Learned, id_col: str, text_col: str, head: int = HEAD, filter_bits: int = FILTER_BITS) -> DataFrame:
    """For each row of docs its id, and d0_ (length-normalised difference) and d1_ (of the greatest word) by
    each of MODELS; written."""
    spark, names = docs.sparkSession, list(MODELS)
    parts = [f"{part}_{m}" for part in ("add", "back", "peak") for m in names]
    often, seldom = _split(learned.model, head)
    top = often.select("key", *[F.col(c).cast("float") for c in parts]).toArrow()
    n_seldom = seldom.count()
    bits = 1 << min(max(16, (12 * n_seldom).bit_length()), int(filter_bits).bit_length() - 1)
    marks = np.zeros(bits // 64, np.uint64)
    if n_seldom:
        at = seldom.select(F.explode(F.array(*_places(F.col("key"), bits))).alias("at"))
        one = F.expr("shiftleft(1L, cast(at & 63 as int))")
        got = at.groupBy(F.shiftright("at", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
        marks[got["at"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
        del got
    unseen = np.array([learned.unseen[m] for m in names])
    # In the table and the sums, what words add is against an unseen word.
    rows = np.column_stack([top[c].fill_null(0.0).to_numpy() for c in parts])
    held = spark.sparkContext.broadcast((Keyed(top["key"].to_numpy().view(np.uint64), rows), marks, bits, bool(n_seldom)))
    del top, rows, marks
    n = len(names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed, filter_words, size, more = held.value
        none = len(keyed.keys) - 1
        for batch in batches:
            for start in range(0, len(batch), 500):
                found = list(letter_words(batch.column(1)[start : start + 500].to_pylist()))
                sizes = np.array([len(h) for h in found])
                h = np.concatenate(found)
                ends = np.cumsum(sizes)
                begins = ends - sizes
                doc = np.repeat(np.arange(len(found)), sizes)
                inner = np.ones(len(h), bool)  # with a word behind it
                inner[ends[sizes > 0] - 1] = False
                context = np.flatnonzero(inner)
                pair = pair_keys(h[context], h[context + 1])
                at_word, at_pair = keyed.find(h), keyed.find(pair)
                v = keyed.values
                sums = np.zeros((len(found), n))
                peaks = np.zeros((len(found), n))
                full = np.flatnonzero(sizes)
                for m in range(n):
                    adds = np.where(at_word == none, unseen[m], v[at_word, m])
                    adds[context] += v[at_word[context], n + m] + v[at_pair, m]
                    peak = np.where(at_word == none, unseen[m], v[at_word, 2 * n + m])
                    if len(full):
                        sums[full, m] = np.add.reduceat(adds, begins[full])
                        peaks[full, m] = np.maximum.reduceat(peak, begins[full])
                # What the broadcast rows don't have, by document: how often as a word or pair and how often as a context.
                ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
                lists = [pa.nulls(len(found), longs), pa.nulls(len(found), ints), pa.nulls(len(found), ints)]
                if more:
                    w, c = np.flatnonzero(at_word == none), np.flatnonzero(at_pair == none)
                    keys = np.concatenate([h[w], pair[c]])
                    docs_of = np.concatenate([doc[w], doc[context[c]]])
                    follows = np.concatenate([inner[w], np.zeros(len(c), bool)])
                    may = _may_hold(filter_words, keys, size)
                    keys, docs_of, follows = keys[may], docs_of[may], follows[may]
                    if len(keys):
                        order = np.lexsort((keys, docs_of))
                        keys, docs_of, follows = keys[order], docs_of[order], follows[order]
                        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (docs_of[1:] != docs_of[:-1])]))
                        times = np.diff(np.append(new, len(keys))).astype(np.int32)
                        before = np.add.reduceat(follows.astype(np.int32), new).astype(np.int32)
                        places = np.append(0, np.cumsum(np.bincount(docs_of[new], minlength=len(found)))).astype(np.int32)
                        lists = [pa.ListArray.from_arrays(pa.array(places), pa.array(x)) for x in (signed(keys[new]), times, before)]
                cols = [batch.column(0)[start : start + 500], batch.column(2)[start : start + 500], *lists, pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array(x[:, m]) for x in (sums, peaks) for m in range(n)]], names=columns)

    columns = ["_id", "_row", "keys", "times", "before", "words", *[f"sum_{m}" for m in names], *[f"peak_{m}" for m in names]]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, _row long, keys array<long>, times array<int>, before array<int>, words long, " + ", ".join(f"{c} double" for c in columns[6:])
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn("_row", F.monotonically_increasing_id())
    made = staged(source.mapInArrow(emit, schema), "scored-texts")
    out = made.drop("keys", "times", "before")
    if n_seldom:
        each = made.select("_row", F.explode(F.arrays_zip("keys", "times", "before")).alias("e"))
        rest = each.select("_row", F.col("e.keys").alias("key"), F.col("e.times").alias("times"), F.col("e.before").alias("before")).join(seldom, "key")
        # Words were counted as unseen ones before.
        is_word = F.col("word")
        more = rest.groupBy("_row").agg(
            *[F.sum(F.col("times") * (F.col(f"add_{m}") - F.when(is_word, F.lit(float(u))).otherwise(0.0)) + F.col("before") * F.col(f"back_{m}")).alias(f"more_{m}") for m, u in zip(names, unseen)],
            *[F.max(f"peak_{m}").alias(f"most_{m}") for m in names],
        )
        out = out.join(more, "_row", "left")
        for m in names:
            out = out.withColumns({f"sum_{m}": F.col(f"sum_{m}") + F.coalesce(f"more_{m}", F.lit(0.0)), f"peak_{m}": F.greatest(f"peak_{m}", f"most_{m}")})
    d = [x for m in names for x in (F.when(F.col("words") > 0, F.col(f"sum_{m}") / F.col("words")).otherwise(0.0).alias(f"d0_{m}"), F.col(f"peak_{m}").alias(f"d1_{m}"))]
    out = staged(out.select("_id", *d), "differences")
    dropped(made)
    return out


# ---- from differences to scores


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic function of (1, differences), whose value at the best F1 cut is CUT."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (a.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    z = a @ w
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    ends = np.append(z[order][1:] < z[order][:-1], True)  # only where the next score differs
    best = int(np.argmax(np.where(ends, f1, -1)))
    below = z[order][best + 1] if best + 1 < len(z) else z[order][best] - 1
    cut = (z[order][best] + below) / 2
    w[0] += np.log(CUT / (1 - CUT)) - cut
    return np.array([w[0], *(w[1:] / scale)])


def _marks(labels: DataFrame) -> DataFrame:
    """_id, toxic and fold of the labelled rows that learn."""
    marks = labels.where("toxic is not null").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    return marks.withColumn("fold", fold("_id")).where("fold <> 1")


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    marks = _marks(labels)
    few = marks.count() <= MAX_BROADCAST_LABELS
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(marks) if few else marks, "_id")


def weights(found: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights from the differences of rows that learn, each by the models of the other fold."""
    of = lambda d: F.when(F.col("fold") == 0, F.col(f"{d}_from2")).otherwise(F.col(f"{d}_from0")).alias(d)
    cross = found.join(_marks(labels), "_id").select("toxic", of("d0"), of("d1"))
    fit = cross.orderBy(F.xxhash64("d0", "d1")).limit(sample).toPandas()
    return calibrate(fit[["d0", "d1"]].to_numpy(float), fit["toxic"].to_numpy(float))


def _score(w: np.ndarray) -> Column:
    z = F.lit(float(w[0])) + F.lit(float(w[1])) * F.col("d0_all") + F.lit(float(w[2])) * F.col("d1_all")
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Learned | None:
    """Models and weights from labelled rows, to score other documents with."""
    rows = _labelled(docs, labels, id_col, text_col)
    learned = build(rows)
    if learned is not None:
        learned.weights = weights(differences(rows.select("_id", "text"), learned, "_id", "text"), labels)
    return learned


def score(docs: DataFrame, learned: Learned | None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The id and score (0 to 1) of each row of docs."""
    if learned is None:
        return docs.select(id_col, F.lit(0.0).alias("score"))
    return differences(docs, learned, id_col, text_col, **options).select(F.col("_id").alias(id_col), _score(learned.weights).alias("score"))


def learn_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The id and score of each row of docs, by models of its labelled rows; all texts are read once for both."""
    learned = build(_labelled(docs, labels, id_col, text_col))
    if learned is None:
        return score(docs, None, id_col)
    found = differences(docs, learned, id_col, text_col, **options)
    return found.select(F.col("_id").alias(id_col), _score(weights(found, labels)).alias("score"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = learn_and_score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
