"""Quality rules: an ordered decision list of threshold conjunctions, learned from labelled statistics.

Every text is described by counts over its whole words and lines, with DataFrame expressions only. Rules that reject
are learned by sequential covering: a rule grows by the condition of most information gain over the labelled rows that
no earlier rule covers, is pruned on rows kept apart for that, and is accepted if it is precise enough there. What the
learner sees are numbers of rows for each feature and bin, from one aggregation a step, so all labelled rows count and
nothing but these few numbers reaches the driver. The list becomes one ordered Spark conditional expression.

Defined results: a null, empty or wordless text has counts of 0 and fails the base rule (fewer than 20 words). Without
usable labels the list is empty and the base rule alone decides. Rows are judged one by one, so ids may repeat or be
missing; for learning, labels are joined by id. Columns of the input stay, but for those this operator adds, which
replace columns of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import SPACE, SPACE_CHARS, staged, table

WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_marks", "n_digits"]
FEATURES = ["f_words", "f_length", "f_symbols", "f_dup_lines", "f_repeats", "f_distinct", "f_upper", "f_marks", "f_digits"]


def _left(text: Column, but: str) -> Column:
    """Characters that remain without runs of those in `but`."""
    return F.length(F.regexp_replace(text, but, "")).cast("long")


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with COUNTS; native expressions, one pass, no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("_bare", F.trim(text, F.lit(SPACE_CHARS)))
    words = F.when(F.col("_bare") == "", F.array().cast("array<string>")).otherwise(F.split("_bare", SPACE, -1))
    out = out.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    out = out.withColumn("n_words", F.size("_h").cast("long"))
    window = F.transform(
        F.sequence(F.lit(0), F.size("_h") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(WINDOW)]),
    )
    out = out.withColumn("_w", F.when(F.size("_h") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    # Most texts repeat no window; only the others are sorted.
    twice = F.size(F.array_distinct("_w")) < F.size("_w")
    ordered = F.array_sort(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_s", F.when(twice, ordered))
    near = lambda j, d: F.get(F.col("_s"), j + d)["h"]
    repeated = F.filter(
        F.sequence(F.lit(0), F.size("_s") - 1),
        lambda j: F.coalesce(near(j, 0) == near(j, -1), F.lit(False)) | F.coalesce(near(j, 0) == near(j, 1), F.lit(False)),
    )
    starts = F.array_sort(F.transform(repeated, lambda j: F.get(F.col("_s"), j)["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total")),
        lambda a, x: F.struct(x.alias("last"), (a["total"] + F.least(F.lit(WINDOW), x - a["last"])).alias("total")),
        lambda a: a["total"],
    )
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != "")
    out = out.withColumn("_lines", F.transform(lines, lambda x: F.xxhash64(x)))
    counts = {
        "word_chars": _left(text, SPACE),
        "n_symbols": _left(text, r"[^#*$%&|<>]+"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("_s").isNull(), F.lit(0)).otherwise(covered).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_distinct": F.size(F.array_distinct("_h")).cast("long"),
        "n_upper": _left(text, r"[^A-Z]+"),
        "n_marks": _left(text, r"[^!?]+"),
        "n_digits": _left(text, r"[^0-9]+"),
    }
    return out.withColumns(counts).drop("_bare", "_h", "_w", "_s", "_lines")


def features() -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0)).cast("double")

    return {
        "f_words": F.col("n_words").cast("double"),
        "f_length": share("word_chars", "n_words"),
        "f_symbols": share("n_symbols", "n_words"),
        "f_dup_lines": share("n_dup_lines", "n_lines"),
        "f_repeats": share("n_repeat_words", "n_words"),
        "f_distinct": share("n_distinct", "n_words"),
        "f_upper": share("n_upper", "word_chars"),
        "f_marks": share("n_marks", "n_words"),
        "f_digits": share("n_digits", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > cut, else feature <= cut
    cut: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def decision(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds; null if none does."""
    out = F.lit(None).cast("int")
    for n, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all(rule), F.lit(n)).otherwise(out)
    return out


def learn(labelled: DataFrame, bad: str = "bad", bins: int = 32, min_precision: float = 0.9, min_rows: int = 5) -> list[Rule]:
    """The decision list for a table with FEATURES, a boolean `bad` and a boolean `prune` (rows kept for pruning).

    Cuts are quantiles (`bins` of them) of all rows, of the bad ones and of values other than 0, so that a rare kind of
    junk and features that are mostly 0 have cuts of their own. A rule grows while a condition gains more bits than it
    takes to name one; the list grows while a rule holds up on the rows kept apart. Where one doesn't, no later rule
    begins with that feature and direction, and the next best is tried, until none is left."""
    shares = [k / bins for k in range(1, bins)]
    of = {"all": lambda f: F.col(f), "bad": lambda f: F.when(F.col(bad), F.col(f)), "some": lambda f: F.when(F.col(f) > 0, F.col(f))}
    found = labelled.agg(*[F.percentile_approx(x(f), shares, 10_000).alias(f"{k}_{f}") for f in FEATURES for k, x in of.items()]).first()
    cuts = {f: sorted({c for k in of for c in found[f"{k}_{f}"] or ()}) for f in FEATURES}

    def bin_of(f: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts[f]]), lambda c: c < F.col(f))) if cuts[f] else F.lit(0)

    binned = F.array(*[F.struct(F.lit(f).alias("f"), bin_of(f).alias("b")) for f in FEATURES])
    rows = staged(labelled.select(*FEATURES, bad, "prune", binned.alias("binned")), "labelled")
    is_bad = F.when(F.col(bad), 1).otherwise(0)
    rules: list[Rule] = []
    failed: set[tuple[str, bool]] = set()
    free = F.lit(True)
    while True:
        rule: Rule = ()
        left = rows.where(free & ~F.col("prune"))
        while True:
            counts = left.where(_all(rule)).select(F.explode("binned").alias("x"), is_bad.alias("p")).groupBy("x.f", "x.b").agg(F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("n"))
            best = _best_condition(counts.collect(), cuts, min_rows, set() if rule else failed)
            if best is None:
                break
            rule += (best,)
        if not rule:
            return rules
        kept = rows.where(free & F.col("prune"))
        heads = [rule[: k + 1] for k in range(len(rule))]
        sums = kept.agg(*[F.sum(F.when(_all(h), is_bad if want else 1 - is_bad)).alias(f"{'p' if want else 'n'}{k}") for k, h in enumerate(heads) for want in (True, False)]).first()
        scored = []
        for k in range(len(heads)):
            p, n = sums[f"p{k}"] or 0, sums[f"n{k}"] or 0
            if p + n >= min_rows:
                scored.append(((p + 1) / (p + n + 2), p, k, p / (p + n)))
        good = [s for s in scored if s[3] >= min_precision]
        if not good:
            failed.add((rule[0].feature, rule[0].above))
            continue
        # Of the precise enough ones the one that rejects most: the shortest that holds up.
        rule = heads[max(good, key=lambda s: (s[1], s[0], -s[2]))[2]]
        rules.append(rule)
        free = free & ~_all(rule)


def _best_condition(counts: list, cuts: dict[str, list[float]], min_rows: int, failed: set[tuple[str, bool]]) -> Condition | None:
    """The condition of most FOIL information gain that hasn't failed, for numbers of bad (p) and other (n) rows in each bin."""
    by = {f: [[0, 0] for _ in range(len(cuts[f]) + 1)] for f in cuts}
    for r in counts:
        by[r["f"]][r["b"]] = [r["p"], r["n"]]
    total = [sum(x[i] for x in next(iter(by.values()))) for i in (0, 1)]
    if total[0] < min_rows or not total[1]:
        return None
    before = math.log2(total[0] / sum(total))
    best, most = None, math.log2(2 + 2 * sum(map(len, cuts.values())))
    for f, bins in by.items():
        p = n = 0
        for k, cut in enumerate(cuts[f]):
            p, n = p + bins[k][0], n + bins[k][1]
            for above, (a, b) in ((False, (p, n)), (True, (total[0] - p, total[1] - n))):
                if a >= min_rows and b < total[1]:
                    gain = a * (math.log2(a / (a + b)) - before)
                    if gain > most + 1e-9 and (f, above) not in failed:
                        best, most = Condition(f, above, float(cut)), gain
    return best


def count_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and COUNTS of each document, written: conditions on them are then tests of columns and not pushed into the
    expressions that make them."""
    return staged(text_counts(docs.select(id_col, text_col), text_col).drop(text_col), "text-counts")


def learn_from(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> list[Rule]:
    rated = labels.where("quality is not null").select(F.col("doc_id").alias(id_col), (F.col("quality") == 0).alias("bad"))
    apart = F.pmod(F.xxhash64(F.lit("prune"), F.col(id_col)), F.lit(3)) == 0
    labelled = counts.select(id_col, *COUNTS).where(~base_failed()).join(rated, id_col).withColumn("prune", apart).withColumns(features())
    return learn(labelled.select(*FEATURES, "bad", "prune"), **options)


def with_verdict(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    out = counted.withColumns(features()).withColumns({"base_failed": base_failed(), "rule": decision(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop(*FEATURES)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with COUNTS, base_failed, rule (number of the rule that rejects it, null if none) and kept. docs is stored
    once with its counts, so that texts are counted once."""
    counted = staged(text_counts(docs, text_col), "counted-documents")
    return with_verdict(counted, learn_from(counted, labels, id_col, **options))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, labels = count_table(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")
    out = with_verdict(counts, learn_from(counts, labels))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
