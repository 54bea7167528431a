"""Secrets in texts, by patterns and by sliding-window Shannon entropy; DataFrame expressions only.

Base spans, leftmost non-overlapping for each kind: assign (a name such as password, a separator and a value of 8 or
more characters; the span is the whole match), access (AKIA...) and hex (32 or more digits). Entropy spans are added:
in each candidate string, a run of 16 or more key-like characters, or of letters and digits within it, that is not
explained, a window of 24 characters (16 in shorter candidates) moves along; the counts of its characters change by the one that leaves and the one that enters, and with them the sum of
c*log2(c), in whole millionths, from which the window's entropy follows. Windows over the limit of the candidate's
character class are joined to spans of kind entropy; spans within a base span, or within another of entropy, add nothing
and are left out. Offsets are code points, ends exclusive.

Each class has its own alphabet, and as its limit what about 99 of 100 random windows over that alphabet reach. A
candidate is explained if it is a number, a UUID, a ruler, or made of words: no digit before a letter, no number of more
than 8 digits, and two thirds of its pairs of letters common in European languages, which random letters are not.

Defined results: a null or empty text has no spans. Rows are scanned one by one, so ids may repeat or be missing.
Columns of the input stay, but for spans_found (and the redacted text), which replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import table

KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
WINDOW = 24
SHORT_WINDOW = 16
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{16,}"
#: Looked at by itself as well, so that a name or separators beside it don't hide its class.
PART = r"(?<![A-Za-z0-9])[A-Za-z0-9]{16,}"
#: Alphabets of the classes, the first that fits counts; all others are wide.
CLASSES = {
    "digits": r"^[0-9]+$",
    "hex": r"^([0-9a-f]+|[0-9A-F]+)$",
    "one_case": r"^([a-z=+/_-]+|[A-Z=+/_-]+)$",
    "base32": r"^([a-z2-7=]+|[A-Z2-7=]+)$",
    "base36": r"^([a-z0-9=+/_-]+|[A-Z0-9=+/_-]+)$",
    "letters": r"^[A-Za-z]+$",
}
#: Bits a character from which a window of a class is a secret.
LIMITS = {"digits": 2.6, "hex": 3.0, "one_case": 3.4, "base32": 3.5, "base36": 3.6, "letters": 3.75, "wide": 3.9}
SHORT_LIMITS = {"digits": 2.3, "hex": 2.65, "one_case": 2.95, "base32": 3.05, "base36": 3.15, "letters": 3.25, "wide": 3.35}
#: Candidates that are explained besides words: numbers of less than 24 digits, UUIDs, rulers.
ALLOWED = (
    r"^(?!.*[0-9]{24})[0-9=_+/-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(.{1,4}?)\1+$",
)
#: What words, also in identifiers, don't have.
NOT_WORDS = r"[0-9][A-Za-z]|[0-9]{9}"
#: Pairs of letters that are common in European languages: about a third of all pairs.
COMMON_PAIRS = (
    r"(?i)(?=a[bcdgilmnprstuvy]|b[aeiloru]|c[aehikloqrtu]|d[aeiorsu]|e[acdeghilmnprstuvwx]|f[aefiloru]|g[aehilnoru]|h[aeilnort]|i[abcdegklmnoprstvz]"
    r"|j[aeou]|k[aeilorst]|l[adeilostuy]|m[abeimopu]|n[acdegiknostuz]|o[bcdfglmnoprstuvw]|p[aehiloprstu]|qu|r[acdegiklmnorstuvy]|s[acehiklmopstu]"
    r"|t[aehilorstuwyz]|u[abcdegilmnprst]|v[aeio]|w[aehio]|x[eipt]|y[eos]|z[aeiou])"
)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
_BLOCK = 256


def _append(items: Column, item: Column) -> Column:
    return F.concat(items, F.array(item))


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _in_blocks(items: Column) -> Column:
    """items, which must be a column or bound, in arrays of at most _BLOCK."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _BLOCK).cast("int")), lambda b: F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)))


def located(text: Column, pattern: str, group: int, keep: bool = False) -> Column:
    """(start, end, part) of each match: what lies between matches and the matches themselves, added up. Sums go by
    blocks, so that a text with very many matches stays cheap. part: length of the given group; s, if kept: the match."""
    none = F.array().cast("array<struct<start:int,end:int,part:int" + (",s:string>>" if keep else ">>"))
    empty = F.array().cast("array<int>")
    text_of = lambda x: [x["m"].alias("s")] if keep else []

    def lengths(whole: Column) -> Column:
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
        return F.zip_with(
            F.arrays_zip(whole.alias("m"), parts.alias("p")) if group else F.transform(whole, lambda m: F.struct(m.alias("m"), m.alias("p"))),
            F.slice(F.split(text, pattern, -1), 1, F.size(whole)),
            lambda x, gap: F.struct(F.length(gap).alias("gap"), F.length(x["m"]).alias("n"), F.length(x["p"]).alias("p"), *([x["m"].alias("m")] if keep else [])),
        )

    def inside(block: Column, start: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(start.alias("at"), none.alias("all")),
            lambda a, x: F.struct(
                (a["at"] + x["gap"] + x["n"]).alias("at"),
                _append(a["all"], F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["n"]).alias("end"), x["p"].alias("part"), *text_of(x))).alias("all"),
            ),
            lambda a: a["all"],
        )

    def added(blocks: Column) -> Column:
        starts = F.aggregate(
            F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x["gap"] + x["n"])),
            F.struct(F.lit(0).alias("at"), empty.alias("all")),
            lambda a, s: F.struct((a["at"] + s).alias("at"), _append(a["all"], a["at"]).alias("all")),
            lambda a: a["all"],
        )
        return F.flatten(F.zip_with(blocks, starts, inside))

    found = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda whole: _let(lengths(whole), lambda each: _let(_in_blocks(each), added)))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _spans(found: Column, kind: int, least: int) -> Column:
    good = F.filter(found, lambda x: x["part"] >= least)
    return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def hot_windows(candidate: Column) -> Column:
    """(start, end) within a candidate of joined windows whose entropy reaches the limit of its class."""
    scaled = [0] + [round(c * math.log2(c) * 1e6) for c in range(1, WINDOW + 2)]
    weight = F.lit(scaled)
    chars = F.transform(F.regexp_extract_all(candidate, F.lit("(?s)."), F.lit(0)), lambda c: F.instr(F.lit(_ALPHABET), c) - 1)
    # Entropy >= limit exactly if the sum of c*log2(c) <= W * (log2(W) - limit).
    long = F.length(candidate) >= WINDOW
    size = F.when(long, F.lit(WINDOW)).otherwise(F.lit(SHORT_WINDOW))

    def most(kind: str) -> Column:
        return F.when(long, F.lit(math.floor(WINDOW * (math.log2(WINDOW) - LIMITS[kind]) * 1e6))).otherwise(F.lit(math.floor(SHORT_WINDOW * (math.log2(SHORT_WINDOW) - SHORT_LIMITS[kind]) * 1e6)))

    limit = F.coalesce(*[F.when(candidate.rlike(pattern), most(kind)) for kind, pattern in CLASSES.items()], most("wide"))
    packed = F.struct(chars.alias("c"), limit.alias("limit"), size.alias("w"))

    # Counts of 8 characters to a number, 5 bits each, so that a step changes few of them.
    unit = F.lit([1 << 5 * k for k in range(8)]).cast("array<long>")
    rise = F.lit([b - a for a, b in zip(scaled, scaled[1:])])  # of the sum, by the count that grows
    groups = -(-len(_ALPHABET) // 8)
    place = lambda c: F.shiftright(c, 3)
    one = lambda c: F.get(unit, c.bitwiseAND(7))
    count = lambda counts, c: F.call_function("shiftrightunsigned", F.get(counts, place(c)), c.bitwiseAND(7) * 5).bitwiseAND(F.lit(31)).cast("int")

    def sums(w: Column, chars: Column) -> Column:
        """The sum of c*log2(c) of each window of w of these characters."""
        none_yet = F.array(*[F.lit(0).cast("long")] * groups)
        head = F.aggregate(F.slice(chars, 1, w), none_yet, lambda a, c: F.transform(a, lambda v, j: F.when(j == place(c), v + one(c)).otherwise(v)))

        def begun(counts: Column) -> Column:
            each = F.transform(F.sequence(F.lit(0), F.lit(8 * groups - 1)), lambda k: count(counts, k))
            return F.struct(counts.alias("counts"), F.array(F.aggregate(each, F.lit(0), lambda a, c: a + F.get(weight, c))).alias("sums"))

        def step(a: Column, i: Column) -> Column:
            """From the window that starts at i - 1 to the next."""

            def moved(z: Column) -> Column:
                total = F.element_at(a["sums"], -1) - F.get(rise, count(a["counts"], z["out"]) - 1) + F.get(rise, count(a["counts"], z["new"]))
                counts = F.transform(a["counts"], lambda v, j: F.when(j == place(z["out"]), v - one(z["out"])).otherwise(v) + F.when(j == place(z["new"]), one(z["new"])).otherwise(F.lit(0)))
                same = z["out"] == z["new"]
                return F.struct(F.when(same, a["counts"]).otherwise(counts).alias("counts"), _append(a["sums"], F.when(same, F.element_at(a["sums"], -1)).otherwise(total)).alias("sums"))

            return _let(F.struct(F.get(chars, i - 1).alias("out"), F.get(chars, i + w - 1).alias("new")), moved)

        steps = F.slice(F.sequence(F.lit(0), F.size(chars) - w), F.lit(2), F.lit(_BLOCK))
        return F.aggregate(steps, _let(head, begun), step, lambda a: a["sums"])

    def hot(x: Column) -> Column:
        # Parts of so many windows: what a fold adds to stays short, so the cost grows with the candidate's length alone.
        starts = F.transform(F.sequence(F.lit(0), F.floor((F.size(x["c"]) - x["w"]) / _BLOCK).cast("int")), lambda b: b * _BLOCK)
        parts = F.transform(starts, lambda at: F.struct(at.alias("at"), F.slice(x["c"], at + 1, x["w"] + F.lit(_BLOCK - 1)).alias("c")))
        each = F.transform(parts, lambda y: F.transform(sums(x["w"], y["c"]), lambda s, k: F.when(s <= x["limit"], y["at"] + k)))
        return F.struct(x["w"].alias("w"), F.filter(F.flatten(each), lambda at: at.isNotNull()).alias("at"))

    def joined(x: Column) -> Column:
        """Hot windows that touch are one stretch."""
        first = F.filter(x["at"], lambda v, i: (i == 0) | (v > F.get(x["at"], i - 1) + x["w"]))
        last = F.filter(x["at"], lambda v, i: F.coalesce(F.get(x["at"], i + 1) > v + x["w"], F.lit(True)))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + x["w"]).alias("end")))

    return _let(_let(packed, hot), joined)


def of_words(candidate: Column) -> Column:
    pairs = F.regexp_count(candidate, F.lit("(?=[A-Za-z]{2})"))
    return ~candidate.rlike(NOT_WORDS) & (F.regexp_count(candidate, F.lit(COMMON_PAIRS)) * 3 >= pairs * 2)


def find_spans(docs: DataFrame, text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """docs with spans_found: array of (start, kind, end) in order, kind as its place in KINDS."""
    out = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    text = F.col("_text")
    out = out.withColumns({
        "_assign": _spans(located(text, ASSIGN, 2), 0, 8),
        "_access": _spans(located(text, ACCESS, 0), 1, 16),
        "_hex": _spans(located(text, HEX, 0), 2, 32),
    })
    out = out.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    # Candidates that are not explained: most texts have none.
    out = out.withColumn("_found", F.array_distinct(F.concat(located(text, CANDIDATE, 0, True), located(text, PART, 0, True))))

    def strange(x: Column) -> Column:
        ok = ~of_words(x["s"])
        for pattern in allowed:
            ok = ok & ~x["s"].rlike(pattern)
        return ok

    out = out.withColumn("_odd", F.when(F.size("_found") > 0, F.filter("_found", strange)))
    hot = F.flatten(F.transform("_odd", lambda x: F.transform(hot_windows(x["s"]), lambda w: F.struct((x["start"] + w["start"]).alias("start"), F.lit(3).alias("kind"), (x["start"] + w["end"]).alias("end")))))
    out = out.withColumn("_hot", F.when(F.size("_odd") > 0, hot))
    # In order of their starts, longest first: a span of entropy is within an earlier one if it ends no later than they do.
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    all_spans = F.array_sort(F.transform(F.concat("_base", F.coalesce("_hot", none)), lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"))))
    out = out.withColumn("_all", F.when(F.size("_hot") > 0, all_spans))

    def swept(blocks: Column) -> Column:
        reach = F.aggregate(
            F.transform(blocks, lambda block: F.array_max(F.transform(block, lambda x: -x["back"]))),
            F.struct(F.lit(-1).alias("end"), F.array().cast("array<int>").alias("all")),
            lambda a, m: F.struct(F.greatest(a["end"], m).alias("end"), _append(a["all"], a["end"]).alias("all")),
            lambda a: a["all"],
        )
        step = lambda a, x: F.struct(
            F.greatest(a["end"], -x["back"]).alias("end"),
            F.when((x["kind"] < 3) | (-x["back"] > a["end"]), _append(a["all"], F.struct(x["start"].alias("start"), x["kind"].alias("kind"), (-x["back"]).alias("end")))).otherwise(a["all"]).alias("all"),
        )
        kept = lambda block, end: F.aggregate(block, F.struct(end.alias("end"), none.alias("all")), step, lambda a: a["all"])
        return F.array_sort(F.flatten(F.zip_with(blocks, reach, kept)))

    out = out.withColumn("spans_found", F.when(F.size("_hot") > 0, _let(_in_blocks(F.col("_all")), swept)).otherwise(F.col("_base")))
    return out.drop("_text", "_assign", "_access", "_hex", "_base", "_found", "_odd", "_hot", "_all")


def as_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """docs with each span, or stretch of overlapping spans, of its text replaced by the mask."""
    out = find_spans(docs, text_col).withColumn("_parts", F.size("spans_found"))
    text = F.col(text_col)
    rebuilt = F.aggregate(
        "spans_found",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mask))).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return out.withColumn(text_col, F.when(F.col("_parts") > 0, rebuilt).otherwise(text)).drop("_parts")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("spans_found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans_found", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("spans_found")).alias("spans"),
        of(3).alias("n_entropy"),
    )
