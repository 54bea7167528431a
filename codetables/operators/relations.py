"""Filters and joins on codes and their relations.

Dimension tables (code systems, rules, labels) are joined as they come: Spark broadcasts those that its statistics show
to be small and shuffles others. Replacement chains are followed by doubling, each round two joins.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetables.operators.scans import running
from codetables.sources.shared import written

# ---- filters


def filter_any_of(df: DataFrame, column: str, wanted: list[str], sep: str = ";") -> DataFrame:
    """Rows whose separated symbols include a wanted one."""
    return df.where(F.arrays_overlap(F.split(column, f"\\Q{sep}\\E"), F.array(*[F.lit(w) for w in wanted])))


def filter_equal(df: DataFrame, **values: str) -> DataFrame:
    """Vocabulary filters: SAB='RXNORM' and SUPPRESS='N' and the like."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]) == kv[1]), values.items(), df)


def filter_authority(df: DataFrame, qualifiers: str = "qualifier", name: str = "Authority", value: str = "FDASPL") -> DataFrame:
    return df.where(F.exists(qualifiers, lambda q: (q["name"] == name) & (q["value"] == value)))


def filter_submitted(df: DataFrame, expression: str, submitted: str, kept: list[str]) -> DataFrame:
    return df.where(F.startswith(F.col(expression), F.lit("NM_")) & ~F.col(expression).contains(",") & F.col(submitted).isin(kept))


def shipped_unnoticed(df: DataFrame, class_type: str, kept: list[str], notice: str) -> DataFrame:
    return df.where(F.col(class_type).isin(kept) & (F.coalesce(F.col(notice), F.lit("")) == ""))


def licence_gate(rows: DataFrame, sources: DataFrame, licences: DataFrame) -> DataFrame:
    """Rows of sources whose licence's policy publishes (rows.source; source, licence; licence, publishes)."""
    free = sources.join(licences.where("publishes"), "licence").select("source").distinct()
    return rows.join(free, "source", "left_semi")


def active_series(series: DataFrame, kinds: DataFrame) -> DataFrame:
    """Series whose kind is declared; one without a kind stays."""
    undeclared = series.where("kind is not null").join(kinds, "kind", "left_anti").select("iri")
    return series.join(undeclared, "iri", "left_anti")


# ---- joins


def require_known(df: DataFrame, key: str, dim: DataFrame, dim_key: str, message: str = "is not known") -> DataFrame:
    """Violations: each key that the dimension lacks."""
    known = dim.select(F.col(dim_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    missing = df.where(F.col(key).isNotNull()).join(known, key, "left_anti")
    return missing.select(F.col(key).cast("string").alias("key"), F.lit(message).alias("message"))


def keep_known(df: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    return df.join(dim.select(F.col(dim_key).alias(key)), key, "left_semi")


def unlisted(df: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Keys named here but nowhere in the dimension, each once."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().join(dim.select(F.col(dim_key).alias(key)).where(F.col(key).isNotNull()), key, "left_anti")


def hop(start: DataFrame, rel: DataFrame, relation: str, concepts: DataFrame, target_type: str | None) -> DataFrame:
    """start (code, at) -> (code, at): one relation on, to concepts of a type. rel(relation, from, to), concepts(code, type)."""
    step = rel.where(F.col("relation") == relation).select(F.col("from").alias("at"), "to")
    out = start.join(step, "at").select("code", F.col("to").alias("at"))
    if target_type is not None:
        out = out.join(concepts.where(F.col("type") == target_type).select(F.col("code").alias("at")), "at", "left_semi")
    return out.select("code", "at").distinct()


#: For each term type, ways to its ingredients: (relation, type of the target) one after another.
Path = list[tuple[str, str]]


def follow(concepts: DataFrame, rel: DataFrame, paths: dict[str, list[Path]]) -> DataFrame:
    """(code, target, chained): where the paths of each concept's type lead; chained if a way has several hops."""
    ends = [concepts.where(F.lit(False)).select("code", F.col("code").alias("target"), F.lit(True).alias("chained"))]
    present = {r["type"] for r in concepts.select("type").distinct().collect()}  # types of concepts: a vocabulary of a few dozen
    for kind, ways in paths.items():
        start = concepts.where(F.col("type") == kind).select("code", F.col("code").alias("at"))
        for way in ways if kind in present else ():
            at = start
            for relation, target in way:
                at = hop(at, rel, relation, concepts, target)
            ends.append(at.select("code", F.col("at").alias("target"), F.lit(len(way) > 1).alias("chained")))
    return reduce(DataFrame.union, ends).groupBy("code", "target").agg(F.min("chained").alias("chained"))


def require_type(pairs: DataFrame, target: str, concepts: DataFrame, wanted: str) -> tuple[DataFrame, DataFrame]:
    """Pairs whose target is a known concept of the type; violations for known ones of another (unknown ones are dropped)."""
    typed = pairs.join(concepts.select(F.col("code").alias(target), "type"), target)
    wrong = typed.where(F.col("type") != wanted).select(F.col(target).alias("key"), F.concat(F.lit(f"is no {wanted} but "), "type").alias("message"))
    return typed.where(F.col("type") == wanted).drop("type"), wrong


def _item_sets(df: DataFrame, key: str, item: str) -> tuple[DataFrame, DataFrame]:
    """(key, item) each once, and each key's set as (n, f1, f2): its size and sums of two halves of its items' hashes,
    which don't depend on an order and are added up map-side."""
    items = df.select(F.col(key).alias("key"), F.col(item).cast("string").alias("item")).where("key is not null and item is not null").distinct()
    part = lambda k: F.sum(F.conv(F.substring("h", k, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)")
    return items, items.withColumn("h", F.sha2("item", 256)).groupBy("key").agg(F.count("*").alias("n"), part(1).alias("f1"), part(17).alias("f2"))


def match_sets(left: DataFrame, right: DataFrame, key: str, item: str) -> tuple[DataFrame, DataFrame]:
    """(key, match): each left id and the right id with exactly the same set of items; and violations: right ids that
    share their set with another, the greatest of which is the one that matches. Sets are compared by hashes that need
    no order, so none is collected; what they propose is confirmed item by item."""
    a_items, a = _item_sets(left, key, item)
    b_items, b = _item_sets(right, key, item)
    b = b.groupBy("n", "f1", "f2").agg(F.max("key").alias("match"), F.min("key").alias("other"))
    double = b.where("match <> other").select(F.col("match").cast("string").alias("key"), F.concat(F.lit("has the same set as "), F.col("other").cast("string")).alias("message"))
    pairs = a.join(b, ["n", "f1", "f2"]).select("key", "match", "n")
    both = pairs.join(a_items, "key").join(b_items.withColumnRenamed("key", "match"), ["match", "item"])
    return both.groupBy("key", "match", "n").agg(F.count("*").alias("same")).where("same = n").select("key", "match"), double


def typed_targets(concepts: DataFrame, rel: DataFrame, relation: str, pairs: DataFrame) -> DataFrame:
    """brand_to_generic: (code, target) over one relation, for pairs of types (type, target_type)."""
    a = concepts.join(pairs, "type").select("code", "target_type")
    step = rel.where(F.col("relation") == relation).select(F.col("from").alias("code"), F.col("to").alias("target"))
    b = concepts.select(F.col("code").alias("target"), F.col("type").alias("target_type"))
    return a.join(step, "code").join(b, ["target", "target_type"]).select("code", "target").distinct()


#: Rules that are broadcast at most; more of them are joined.
MAX_BROADCAST_RULES = 100_000


def class_assignments(assoc: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(drug, class, relation, justification) by rules (relation, reversed, suffix); violations where a class's name
    doesn't end as its rule says. assoc(relation, from_code, from_name, to_code, to_name)."""
    # Relations are few and have many associations each: a shuffle by relation would bring those of one into one task.
    rules = written(rules, "rules")
    ruled = assoc.join(F.broadcast(rules) if rules.count() <= MAX_BROADCAST_RULES else rules, "relation")
    side = lambda a, b: F.when(F.col("reversed"), F.col(b)).otherwise(F.col(a))
    out = ruled.select("relation", side("from_code", "to_code").alias("drug"), side("to_code", "from_code").alias("class"), side("to_name", "from_name").alias("class_name"), "suffix")
    ok = F.col("suffix").isNull() | F.endswith(F.col("class_name"), F.col("suffix"))
    wrong = out.where(~ok).select(F.col("class").alias("key"), F.concat(F.lit("is no class of "), "relation").alias("message"))
    return out.where(ok).drop("suffix").distinct(), wrong


def names_for_used(used: DataFrame, concepts: DataFrame, key: str = "code", name: str = "name") -> tuple[DataFrame, DataFrame]:
    """The one name of each used code; violations for codes without a name or with two."""
    wanted = used.select(key).distinct()
    named = wanted.join(concepts, key, "left").groupBy(key).agg(F.min(name).alias(name), F.max(name).alias("other"))
    wrong = named.where(F.col(name).isNull() | (F.col(name) != F.col("other")))
    message = F.when(F.col(name).isNull(), "has no name").otherwise("has two names")
    return named.where(F.col(name) == F.col("other")).select(key, name), wrong.select(F.col(key).alias("key"), message.alias("message"))


def lookup_labels(df: DataFrame, key: str, terms: str, labels: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, concepts in the order of their terms), unmatched terms with their number of rows, labels of two concepts.
    labels(label, concept)."""
    unique = labels.groupBy("label").agg(F.min("concept").alias("concept"), F.max("concept").alias("other"))
    double = unique.where("concept <> other").select(F.col("label").alias("key"), F.lit("is the label of two concepts").alias("message"))
    each = df.select(key, F.posexplode(terms).alias("pos", "label")).join(unique.drop("other"), "label", "left")
    found = F.filter(F.array_sort(F.collect_list(F.struct("pos", "concept"))), lambda x: x["concept"].isNotNull())
    mapped = each.groupBy(key).agg(F.transform(found, lambda x: x["concept"]).alias("concepts"))
    missing = each.where("concept is null").groupBy("label").agg(F.countDistinct(key).alias("n"))
    return mapped, missing, double


def system_of(df: DataFrame, iri: str, registry: DataFrame) -> DataFrame:
    """df with `system`, that of the longest registered space the address begins with. registry(system, space); an
    address is looked up by its beginnings of the lengths that spaces have, so neither side needs to be small."""
    sizes = sorted(r["n"] for r in registry.select(F.length("space").alias("n")).distinct().collect())
    each = df.select(iri).where(F.col(iri).isNotNull()).distinct()
    starts = each.select(iri, F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<int>")).alias("_n")).where(F.length(iri) >= F.col("_n"))
    starts = starts.withColumn("space", F.substring(F.col(iri), F.lit(1), F.col("_n")))
    found = starts.join(registry, "space").groupBy(iri).agg(F.max_by("system", "_n").alias("system"))
    return df.join(found, iri, "left")


def replacement_flags(edges: DataFrame) -> DataFrame:
    """Edges (prev, next) with `merges` (the next code replaces other codes too; kept if given) and `splits` (prev has
    several successors)."""
    several = lambda key, other: edges.select(key, other).where(F.col(other).isNotNull()).distinct().groupBy(key).agg(F.count("*") > 1)
    outof = several("prev", "next").toDF("prev", "splits")
    if "merges" not in edges.columns:
        into = several("next", "prev").toDF("next", "merges")
        edges = edges.join(into, "next")
    return edges.join(outof, "prev").select("prev", "next", "merges", "splits")


def _merged(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) once, saying what any of them says."""
    return pairs.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("merged", "split", "direct")])


def _then(first: DataFrame, second: DataFrame) -> DataFrame:
    """a to c by a pair of first from a to b and one of second from b to c."""
    f = first.select("a", F.col("b").alias("m"), F.col("merged").alias("m1"), F.col("split").alias("s1"))
    s = second.select(F.col("a").alias("m"), "b", F.col("merged").alias("m2"), F.col("split").alias("s2"))
    return f.join(s, "m").select("a", "b", (F.col("m1") | F.col("m2")).alias("merged"), (F.col("s1") | F.col("s2")).alias("split"), F.lit(False).alias("direct"))


def double_paths(open_: DataFrame, ends: DataFrame, longest: int) -> tuple[DataFrame, DataFrame | None, int]:
    """Of steps (a, b, merged, split, direct) between open codes and to ends: all pairs of a code and an end; the pairs that
    are more than `longest` steps apart, if there are any (then there are cycles); and the rounds it took. Round k knows the pairs that
    are exactly 2**k steps apart and the ends within as many, so a chain of any length takes its logarithm in rounds."""
    rounds = 0
    while True:
        if open_.isEmpty():
            return ends, None, rounds
        if 1 << rounds > longest:
            return ends, open_, rounds
        ends = written(_merged(ends.unionByName(_then(open_, ends))), "ends")
        open_ = written(_merged(_then(open_, open_)), "steps")
        rounds += 1


def _components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of edges (a, b) that lie on cycles: comp is the least node of a strongly connected component.
    edges is what trimming has left around cycles; which of them reach each other is found by doubling, too."""
    reach = written(edges.select("a", "b").distinct(), "reach")
    n = reach.count()
    while True:
        more = reach.join(reach.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
        reach = written(reach.union(more).distinct(), "reach")
        now = reach.count()
        if now == n:
            break
        n = now
    both = reach.join(reach.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi")
    return both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))


def ways_inside(edges: list[tuple]) -> list[tuple]:
    """(a, b, merged, split) for all codes a, b of one component of edges (prev, next, merges, splits): whether a path from a
    to b that holds no code twice says so. A marked edge is on such a path if two paths that share no code lead to it and
    away from it; that is tried first with shortest paths, then by following all paths that can still arrive."""
    after: dict = {}
    for p, q, merges, splits in edges:
        after.setdefault(p, {})[q] = (bool(merges), bool(splits))
    nodes = sorted({x for e in edges for x in e[:2]}, key=str)

    def path(a, b, without: set) -> list | None:
        back, todo = {a: None}, [a]
        for at in todo:
            if at == b:
                out = [at]
                while back[at] is not None:
                    at = back[at]
                    out.append(at)
                return out
            for to in after.get(at, ()):
                if to not in back and to not in without:
                    back[to] = at
                    todo.append(to)
        return None

    def exists(a, b, flag: int) -> bool:
        marked = [(p, q) for p, to in after.items() for q, said in to.items() if said[flag]]
        for p, q in marked:
            if p == b or q == a:
                continue
            first = path(a, p, {q, b})
            if first is not None and (q == b or path(q, b, set(first)) is not None):
                return True
        stack = [(a, frozenset([a]), False)]  # by all paths: only where shortest ones block each other
        while stack:
            at, seen, said = stack.pop()
            for to, flags in after.get(at, {}).items():
                if to in seen:
                    continue
                now = said or flags[flag]
                if to == b:
                    if now:
                        return True
                elif path(to, b, set(seen)) is not None:
                    stack.append((to, seen | {to}, now))
        return False

    return [(a, b, a != b and exists(a, b, 0), a != b and exists(a, b, 1)) for a in nodes for b in nodes]


def _condensed(steps: DataFrame, comps: DataFrame) -> DataFrame:
    """The steps with those inside a component replaced: from each code of a component to wherever the component can be left."""
    kind = steps.schema["a"].dataType.simpleString()
    side = lambda end: comps.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
    placed = steps.join(side("a"), "a", "left").join(side("b"), "b", "left")
    placed = written(placed.withColumn("inside", F.coalesce(F.col("comp_a") == F.col("comp_b"), F.lit(False))), "placed-steps")

    def solve(group: pa.Table) -> pa.Table:
        edges = list(zip(*(group[c].to_pylist() for c in ("a", "b", "merged", "split"))))
        cols = list(zip(*ways_inside(edges)))
        return pa.table([pa.array(c, t) for c, t in zip(cols, [group.schema.field("a").type] * 2 + [pa.bool_()] * 2)], names=["from", "a", "m1", "s1"])

    inside = placed.where("inside").select("comp_a", "a", "b", "merged", "split")
    ways = written(inside.groupBy("comp_a").applyInArrow(solve, f"`from` {kind}, a {kind}, m1 boolean, s1 boolean"), "ways")
    leaving = placed.where("not inside and comp_a is not null").join(ways, "a")
    left = leaving.select(F.col("from").alias("a"), "b", (F.col("merged") | F.col("m1")).alias("merged"), (F.col("split") | F.col("s1")).alias("split"), (F.col("direct") & (F.col("from") == F.col("a"))).alias("direct"))
    return placed.where("comp_a is null").select("a", "b", "merged", "split", "direct").unionByName(left)


def resolve_replacements(edges: DataFrame, valid: DataFrame) -> DataFrame:
    """(code, target, cardinality, direct): from each code that isn't in effect to the codes in effect that replace it.

    Paths follow edges (prev, next) to any length, stop at the first code in effect and hold no code twice; dead ends
    are dropped. On the left a pair is `n` if any hop's target has other sources, on the right if any code on the way
    has several successors; over several paths, if any of them says so. Without cycles that is path doubling, in as
    many rounds as the longest path has binary digits. Where pairs are left that are further apart than there are
    codes, the components that lie on cycles are found among those, each is replaced by the ways through it, and the
    rest is doubled again; only inside a component are paths followed one by one."""
    flagged = replacement_flags(edges.distinct())
    good = valid.select("code").distinct().withColumn("ok", F.lit(True))
    step = flagged.join(good.withColumnRenamed("code", "next"), "next", "left").select("prev", "next", "merges", "splits", F.coalesce("ok", F.lit(False)).alias("stops"))
    step = step.join(good.select(F.col("code").alias("prev")), "prev", "left_anti")
    steps = written(step.select(F.col("prev").alias("a"), F.col("next").alias("b"), F.col("merges").alias("merged"), F.col("splits").alias("split"), "stops"), "replacements")
    split = lambda df: (df.where("not stops").drop("stops"), df.where("stops").drop("stops"))
    codes = steps.select("a").distinct().count()
    open_, ends = split(steps.withColumn("direct", F.lit(False)))
    found, far, _ = double_paths(open_, ends.withColumn("direct", F.lit(True)), codes)
    if far is not None:
        around = far.select(F.col("a").alias("node")).distinct().join(far.select(F.col("b").alias("node")).distinct(), "node", "left_semi")
        core = open_.join(around.withColumnRenamed("node", "a"), "a", "left_semi").join(around.withColumnRenamed("node", "b"), "b", "left_semi")
        comps = written(_components(core), "components")
        direct = steps.withColumn("direct", F.col("stops"))
        through = written(_condensed(direct.drop("stops"), comps).join(good.select(F.col("code").alias("b"), F.col("ok").alias("stops")), "b", "left").withColumn("stops", F.coalesce("stops", F.lit(False))), "condensed")
        open_, ends = split(through)
        found, _, _ = double_paths(written(_merged(open_), "steps"), written(_merged(ends), "ends"), codes + 1)
    side = lambda c: F.when(F.col(c), "n").otherwise("1")
    return _merged(found).select(F.col("a").alias("code"), F.col("b").alias("target"), F.concat(side("merged"), F.lit(":"), side("split")).alias("cardinality"), "direct")


def mapping_cardinality(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs with the cardinality of both sides."""
    distinct = pairs.select(a, b).distinct()
    many_b = distinct.groupBy(a).agg((F.count("*") > 1).alias("many_b"))
    many_a = distinct.groupBy(b).agg((F.count("*") > 1).alias("many_a"))
    side = lambda c: F.when(F.col(c), "n").otherwise("1")
    return distinct.join(many_b, a).join(many_a, b).select(a, b, F.concat(side("many_a"), F.lit(":"), side("many_b")).alias("cardinality"))


def files_taken(folders: DataFrame, files: DataFrame, patterns: DataFrame) -> DataFrame:
    """(source, title, folder, effective, name) of all files that a title would be taken from: those that match its
    pattern, or zips that match its archive's. folders(source, folder, effective), files(source, folder, name),
    patterns(source, title, pattern, archive)."""
    matching = lambda p: F.call_function("regexp", F.col("name"), F.concat(F.lit("(?i)"), F.col(p)))
    zipped = F.col("archive").isNotNull() & F.col("name").rlike(r"(?i)\.zip$") & matching("archive")
    named = files.join(patterns, "source").where(matching("pattern") | F.coalesce(zipped, F.lit(False)))
    return named.select("source", "title", "folder", "name").join(folders, ["source", "folder"]).select("source", "title", "folder", "effective", "name")


def newest_in_effect(folders: DataFrame, files: DataFrame, patterns: DataFrame, days: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source, day, title, folder, effective): for each day and title the newest folder in effect that has a file for it
    (of one date the last by name); and violations: titles that none has. days(source, day). Folders and days are one
    ordered sequence of each source and title, in which a day takes the last folder before it."""
    have = files_taken(folders, files, patterns).select("source", "title", "folder", "effective").distinct()
    ask = days.select("source", "day").distinct().join(patterns.select("source", "title").distinct(), "source")
    said = have.select("source", "title", F.col("effective").alias("at"), F.lit(0).alias("asks"), "folder", "effective")
    none = dict(said.dtypes)
    asked = ask.select("source", "title", F.col("day").alias("at"), F.lit(1).alias("asks"), F.lit(None).cast(none["folder"]).alias("folder"), F.lit(None).cast(none["effective"]).alias("effective"))
    found = running(said.unionByName(asked), ["source", "title"], ["at", "asks", "folder"], last=["folder", "effective"]).where("asks = 1")
    out = found.select("source", F.col("at").alias("day"), "title", F.col("last_folder").alias("folder"), F.col("last_effective").alias("effective"))
    message = F.concat(F.lit("no release folder in effect on "), F.col("day").cast("string"), F.lit(" has a file for "), "title")
    return out.where("folder is not null"), out.where("folder is null").select(F.col("source").cast("string").alias("key"), message.alias("message"))


def newest_month(held: DataFrame, available: DataFrame, this_month: str) -> DataFrame:
    """(source, month): the month after the newest held one if it is available, else the newest available of the last
    three. held(source, month), available(source, month)."""
    from codetables.functions.scalars import month_after

    wanted = held.groupBy("source").agg(month_after(F.max("month")).alias("month")).join(available, ["source", "month"], "left_semi").select("source", F.col("month").alias("next"))
    last = available.where((F.col("month") <= this_month) & (F.col("month") > month_after(F.lit(this_month), -3)))
    newest = last.groupBy("source").agg(F.max("month").alias("newest"))
    return wanted.join(newest, "source", "full").select("source", F.coalesce("next", "newest").alias("month"))


def numbered_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
