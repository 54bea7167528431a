"""The readers, writers and builders, on files that Spark writes from the tables of a sf_dir, and the same in SQL.

Each query writes its release to the folder that driver and executors share, as its publisher would, and reads it back.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetables.functions import scalars as X
from codetables.functions.rows import MEMBER_OF, names_rows
from codetables.operators import checks as Q
from codetables.operators import relations as R
from codetables.operators import summaries as S
from codetables.operators import versions as V
from codetables.plans import jobs as J
from codetables.plans.build import BuildResult, Publication, build_version, refuse
from codetables.queries import PART, SUPP, _t, query
from codetables.sources import commits, quoted, readers, sinks, trees
from codetables.sources.shared import shared_path, without_shuffles, written


#: Lines of a gzipped file, which one task reads.
TEXT_FILE_LINES = 500_000


def _text(df: DataFrame, line: Column, label: str) -> str:
    """Lines written as gzipped files of bounded length."""
    path = shared_path(df.sparkSession, label)
    with without_shuffles(df.sparkSession):
        df.select(line.alias("value")).write.options(**{"maxRecordsPerFile": TEXT_FILE_LINES, "zlib.compress.level": "BEST_SPEED"}).text(path, compression="gzip")
    return path


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# ---- readers


@query("SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_mktsegment AS segment FROM customer")
def delimited_lines(spark, sf):
    path = _text(_t(spark, sf, "customer"), F.concat_ws("|", _s("c_custkey"), "c_name", "c_mktsegment", F.lit("")), "delimited")
    f = lambda k: F.get("fields", F.lit(k))
    return readers.read_delimited(spark, path).where(F.size("fields") == 4).select(f(0).alias("code"), f(1).alias("name"), f(2).alias("segment"))


def _quoted_parts(spark, sf) -> str:
    """Parts as quoted CSV, whose names hold quotes and up to two line ends."""
    path = shared_path(spark, "csv")
    named = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'), F.repeat(F.lit("\n"), (F.col("p_partkey") % 3).cast("int")))
    out = _t(spark, sf, "part").select(_s("p_partkey").alias("code"), named.alias("name"), F.lit("").alias("nothing"))
    out.write.options(header=True, escape='"', emptyValue="", ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query("SELECT CAST(p_partkey AS VARCHAR) AS code, p_name || ', \"' || p_brand || '\"' || repeat(chr(10), CAST(p_partkey % 3 AS INT)) AS name, '' AS nothing FROM part")
def strict_csv(spark, sf):
    return quoted.read_csv_strict(spark, _quoted_parts(spark, sf), ["code", "name"]).drop("number")


@query("SELECT count(*) AS records, CAST(sum(1 + p_partkey % 3) AS BIGINT) AS lines FROM part")
def csv_line_numbers(spark, sf):
    """Records of several files, and the lines they take: a record's number is the line of its file that it ends on."""
    files = [f"{_quoted_parts(spark, sf)}/*.csv"]
    records, _ = quoted.read_records(spark, files)
    each = records.groupBy("file").agg(F.count("*").alias("n"), F.max("number").alias("last"), F.min("number").alias("header"))
    return each.agg(F.sum(F.col("n") - 1).alias("records"), F.sum(F.col("last") - F.col("header")).alias("lines"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS code, o_orderstatus AS flag, o_orderpriority AS title FROM orders")
def fixed_width_lines(spark, sf):
    path = _text(_t(spark, sf, "orders"), F.concat(F.rpad(_s("o_orderkey"), 14, " "), "o_orderstatus", F.lit(" "), "o_orderpriority"), "fixed")
    return readers.read_fixed_width(spark, path, {"code": (0, 14), "flag": (14, 15), "title": (16, None)}).drop("number")


@query("SELECT event_id, event_type, value FROM events")
def json_lines(spark, sf):
    e = _t(spark, sf, "events")
    path = _text(e, F.to_json(F.struct("event_id", "event_type", "value")), "json")
    kind = e.schema["value"].dataType.simpleString()
    return readers.read_json_lines(spark, path, f"event_id long, event_type string, value {kind}").where("parsed is not null").select("parsed.*")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def xml_elements(spark, sf):
    s = _t(spark, sf, "supplier")
    each = s.coalesce(1).select(F.format_string("<concept code=\"%s\"><name>%s</name><in><nation>%s</nation></in></concept>", _s("s_suppkey"), "s_name", _s("s_nationkey")).alias("value"))
    line = lambda text: spark.createDataFrame([(text,)], "value string").coalesce(1)
    path = shared_path(spark, "xml")
    line("<list>").union(each).union(line("</list>")).coalesce(1).write.text(path)
    found = readers.read_xml_elements(spark, path, "concept", "_code string, name string, `in` struct<nation:string>")
    return found.select(F.col("_code").alias("code"), "name", F.col("in.nation").alias("nation"))


@query("SELECT CAST(ps AS VARCHAR) AS supplier, CAST(pk AS VARCHAR) AS part FROM (SELECT DISTINCT l_suppkey AS ps, l_partkey AS pk FROM lineitem)")
def headed_tsv(spark, sf):
    pairs = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    path = shared_path(spark, "tsv")

    def headed(batches):
        yield pa.RecordBatch.from_pydict({"value": ["##prose", "#part\tsupplier"]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, names=["value"])

    pairs.select(F.concat_ws("\t", "l_partkey", "l_suppkey").alias("value")).mapInArrow(headed, "value string").write.text(path)
    return readers.read_headed_tsv(spark, path, ["supplier", "part"], ["more"]).where("more is null").select("supplier", "part")


@query(f"""
SELECT '{PART}' || p_partkey AS subject, 'http://www.w3.org/2004/02/skos/core#' || p AS predicate, v AS object, 'urn:version:1' AS graph
FROM part, LATERAL (VALUES ('prefLabel', p_name || ' "' || chr(128512) || '" ' || chr(92) || chr(10)), ('notation', CAST(p_partkey AS VARCHAR)), ('altLabel', p_brand)) AS x(p, v)""")
def nquads_written_and_read(spark, sf):
    named = F.concat("p_name", F.lit(' "😀" \\\n'))
    p = _t(spark, sf, "part").withColumns({"iri": X.code_iri(PART, _s("p_partkey")), "name": named, "other": F.array("p_brand"), "code": _s("p_partkey")})
    path = shared_path(spark, "quads")
    sinks.write_rows_nquads(names_rows(p, "names", "iri", "name", "other", "code"), "urn:version:1", path)
    return readers.read_nquads(spark, path).where("ok").select("subject", "predicate", "object", "graph")


@query("SELECT c_mktsegment AS series, CAST(c_custkey AS VARCHAR) AS notation FROM customer")
def versions_written_and_read(spark, sf):
    c = _t(spark, sf, "customer").withColumns({"iri": X.code_iri("https://example.org/customer/", _s("c_custkey")), "code": _s("c_custkey")})
    path = shared_path(spark, "versions")
    rows = names_rows(c, F.col("c_mktsegment"), "iri", "c_name", F.lit(None), "code")
    for _ in range(2):  # a repeated attempt replaces what it wrote
        sinks.write_version(rows, path, "v1")
    segments = [r["c_mktsegment"] for r in c.select("c_mktsegment").distinct().collect()]
    found = [sinks.read_version(spark, path, s, "v1") for s in segments]
    return V.union_rows(*found).select("series", "notation")


@query("""
WITH v AS (SELECT 'v' || o_orderkey AS iri, 's' || o_custkey AS series, o_orderdate < TIMESTAMP '1996-01-01' AS early, o_orderkey AS k, year(o_orderdate) AS y FROM orders),
e AS (SELECT series, max(k) AS k, arg_max(y, k) AS y FROM v WHERE early GROUP BY series), l AS (SELECT series, max(k) AS k, arg_max(y, k) AS y FROM v WHERE NOT early GROUP BY series)
SELECT coalesce(e.series, l.series) AS iri, 'v' || coalesce(l.k, e.k) AS current_version, CASE WHEN l.k IS NOT NULL THEN 'v' || e.k END AS revises,
  CAST((e.k IS NOT NULL)::INT + (l.k IS NOT NULL)::INT AS BIGINT) AS n, 'file ' || coalesce(l.y, e.y) AS input FROM e FULL JOIN l ON e.series = l.series""")
def catalog_of_two_releases(spark, sf):
    """Each customer's newest order before and since 1996 as versions of a series, from a file a year: two commits."""
    when = F.col("o_orderdate")
    o = _t(spark, sf, "orders").select(F.concat(F.lit("s"), "o_custkey").alias("series"), "o_orderkey", F.concat(F.lit("file "), F.year(when)).alias("file"), (when < F.lit("1996-01-01").cast("timestamp")).alias("early"))
    path = shared_path(spark, "catalog")
    commits.commit(spark, path, {"series": o.select(F.col("series").alias("iri")).distinct().withColumn("current_version", F.lit(None).cast("string"))})
    for early in (True, False):
        held = commits.read_catalog(spark, path)
        newest = o.where(F.col("early") == early).groupBy("series").agg(F.concat(F.lit("v"), F.max("o_orderkey")).alias("iri"), F.max_by("file", "o_orderkey").alias("file"))
        revised = held["series"].select(F.col("iri").alias("series"), F.col("current_version").alias("revises"))
        version = newest.join(revised, "series").select("iri", "series", "revises")
        files = newest.select(F.col("iri").alias("version"), F.col("file").alias("iri"))
        commits.commit(spark, path, V.add_version(held, version, files))
    got = commits.read_catalog(spark, path)
    counts = got["versions"].groupBy(F.col("series").alias("iri")).agg(F.count("*").alias("n"))
    about = got["versions"].join(got["version_inputs"].withColumnRenamed("version", "iri"), "iri").select(F.col("iri").alias("current_version"), "revises", "input")
    return got["series"].join(counts, "iri").join(about, "current_version").join(got["inputs"].select(F.col("iri").alias("input")), "input", "left_semi")


@query("""
SELECT p_type AS series, count(*) AS commits, 'v' || max(p_size) AS current_version, CAST(sum(p_size) AS BIGINT) AS total
FROM (SELECT DISTINCT p_type, p_size FROM part) GROUP BY p_type""")
def catalog_of_many_writers(spark, sf):
    """Types of parts as series, whose sizes are versions, committed by four writers at once: nobody loses anything."""
    import concurrent.futures

    p = _t(spark, sf, "part").select("p_type", "p_size").distinct()
    path = shared_path(spark, "catalog")
    commits.commit(spark, path, {"series": p.select(F.col("p_type").alias("iri")).distinct().withColumn("current_version", F.lit(None).cast("string"))})
    name = F.concat(F.lit("v"), "p_size", F.lit(" "), "p_type")
    kinds = F.pmod(F.hash("p_type"), F.lit(4))

    def one(k: int) -> None:
        mine = p.where(kinds == k)
        version = mine.select(name.alias("iri"), F.col("p_type").alias("series"), "p_size")
        newest = mine.groupBy("p_type").agg(F.concat(F.lit("v"), F.max("p_size")).alias("current_version")).withColumnRenamed("p_type", "iri")
        commits.commit(spark, path, {"versions": version, "series": newest.withColumn("was", F.lit(None).cast("string"))})

    with concurrent.futures.ThreadPoolExecutor(4) as pool:
        list(pool.map(one, range(4)))
    got = commits.read_catalog(spark, path)
    each = got["versions"].groupBy(F.col("series").alias("iri")).agg(F.count("*").alias("commits"), F.sum("p_size").cast("long").alias("total"))
    return got["series"].join(each, "iri").withColumnRenamed("iri", "series")


def _two_part_releases(spark, sf):
    """Parts as names, before and after: dear ones of a size are renamed, cheap ones of another have left."""
    p = _t(spark, sf, "part").withColumns({"iri": X.code_iri(PART, _s("p_partkey")), "code": _s("p_partkey"), "other": F.array("p_brand")})
    renamed = F.when((F.col("p_size") == 7) & (F.col("p_retailprice") > 994), F.concat("p_name", F.lit(" (new)"))).otherwise(F.col("p_name"))
    rows = lambda df: V.with_content(names_rows(df, "parts", "iri", "name", "other", "code"))
    left = (F.col("p_size") == 9) & (F.col("p_retailprice") < 906)
    return rows(p.withColumn("name", F.col("p_name"))), rows(p.where(~left).withColumn("name", renamed))


_PART_CHANGES = f"""
WITH c AS (SELECT '{PART}' || p_partkey AS key, CASE WHEN p_size = 7 AND p_retailprice > 994 THEN 'changed' WHEN p_size = 9 AND p_retailprice < 906 THEN 'removed' END AS change FROM part)"""


def _tree_diff(spark, sf):
    path = shared_path(spark, "trees")
    for name, rows in zip(("v1", "v2"), _two_part_releases(spark, sf)):
        trees.write_tree_version(rows, path, name, depth=1)
    return trees.tree_diff(spark, path, "v1", "v2", depth=1)


@query(f"{_PART_CHANGES} SELECT key, change FROM c WHERE change IS NOT NULL")
def tree_diff(spark, sf):
    """Two stored versions compared by their hash trees."""
    return _tree_diff(spark, sf)[0].select("key", "change")


@query(f"""{_PART_CHANGES}
SELECT CAST(count(DISTINCT sha256(key)[1:1]) AS BIGINT) AS buckets, CAST(count(DISTINCT CASE WHEN change IS NOT NULL THEN sha256(key)[1:1] END) AS BIGINT) AS read FROM c""")
def tree_pruning(spark, sf):
    """How many buckets two versions have, and how many a comparison reads: those that hold a change."""
    _, said = _tree_diff(spark, sf)
    return spark.createDataFrame([(said["buckets"], said["read"])], "buckets long, read long")


@query(f"{_PART_CHANGES} SELECT key, change FROM c WHERE change IS NOT NULL")
def bucketed_diff(spark, sf):
    """The same two versions as tables bucketed by their keys, compared without an exchange."""
    names = [trees.write_bucketed(rows, ["series", "key"], 8) for rows in _two_part_releases(spark, sf)]
    return trees.diff_bucketed(spark, *names).select("key", "change")


# ---- builders


def _rows_of(result: BuildResult, *cols: str) -> DataFrame:
    result = result.staged()
    refuse(result.all_violations())
    return result.rows.select("series", *cols)


@query(f"""
SELECT 'names' AS series, '{X.SPACES["cvx"]}' || p_partkey AS a, p_name AS b FROM part
UNION ALL SELECT 'groups', '{X.SPACES["cvx"]}' || p_partkey, '{X.SPACES["cvx"]}' || url_encode(p_brand) FROM part
UNION ALL SELECT 'status', '{X.SPACES["cvx"]}' || p_partkey, NULL FROM part WHERE p_size > 25""")
def builder_code_list(spark, sf):
    p = _t(spark, sf, "part")
    path = _text(p, F.concat_ws("|", _s("p_partkey"), "p_name", "p_type", "p_brand", F.when(F.col("p_size") > 25, "Retired").otherwise("Active")), "codes")
    rows = _rows_of(J.code_list(readers.read_delimited(spark, path), {"names": "names", "groups": "groups", "status": "status"}), "subject", "subject_id", "object_id", "prefLabel")
    return rows.select("series", F.coalesce("subject", "subject_id").alias("a"), F.coalesce("object_id", "prefLabel").alias("b"))


@query(f"""
SELECT 'names' AS series, '{X.SPACES["cvx"]}' || p_partkey AS a, p_name AS b FROM part
UNION ALL SELECT DISTINCT 'groups', '{X.SPACES["cvx"]}' || l_partkey, '{X.SPACES["cvx"]}' || l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT p_partkey FROM part) AND l_partkey IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'status', '{X.SPACES["cvx"]}' || p_partkey, NULL FROM part WHERE p_size > 40""")
def builder_vaccines(spark, sf):
    p = _t(spark, sf, "part")
    cvx = _text(p, F.concat_ws("|", _s("p_partkey"), "p_name", "p_type", F.lit(""), F.when(F.col("p_size") > 40, "Never Active").otherwise("Active"), F.lit("False"), F.lit("x")), "cvx")
    both = R.keep_known(R.keep_known(_t(spark, sf, "lineitem"), "l_suppkey", p, "p_partkey"), "l_partkey", p, "p_partkey").select("l_partkey", "l_suppkey").distinct()
    vg = _text(both, F.concat_ws("|", F.lit("x"), _s("l_partkey"), F.lit("Active"), F.lit("y"), _s("l_suppkey")), "vg")
    rows = _rows_of(J.vaccines(readers.read_delimited(spark, cvx), readers.read_delimited(spark, vg), {"names": "names", "status": "status", "groups": "groups"}), "subject", "subject_id", "object_id", "prefLabel")
    return rows.select("series", F.coalesce("subject", "subject_id").alias("a"), F.coalesce("object_id", "prefLabel").alias("b"))


_ICD = "'{1}' || lpad(CAST({0} // 10000 AS VARCHAR), 2, '0') || '.' || lpad(CAST({0} % 10000 AS VARCHAR), 4, '0')"


def _icd(key: str, dot: str = ".", letter: str = "A") -> Column:
    k = F.col(key)
    return F.concat(F.lit(letter), F.lpad(F.floor(k / 10000).cast("string"), 2, "0"), F.lit(dot), F.lpad((k % 10000).cast("string"), 4, "0"))


@query(f"""
WITH e AS (SELECT DISTINCT {_ICD.format("l_suppkey", "B")} AS prev, {_ICD.format("l_partkey", "A")} AS next FROM lineitem),
v AS (SELECT {_ICD.format("p_partkey", "A")} AS code FROM part),
g AS (SELECT *, count(*) OVER (PARTITION BY next) > 1 AS m, count(*) OVER (PARTITION BY prev) > 1 AS s FROM e),
o AS (SELECT DISTINCT prev, next, m, s FROM g WHERE prev NOT IN (SELECT code FROM v) AND next IN (SELECT code FROM v))
SELECT 'names' AS series, code AS a, NULL AS b, NULL AS cardinality FROM v
UNION ALL SELECT DISTINCT 'status', prev, NULL, NULL FROM e WHERE prev NOT IN (SELECT code FROM v)
UNION ALL SELECT 'conversions', prev, next, CASE WHEN m THEN 'n' ELSE '1' END || ':' || CASE WHEN s THEN 'n' ELSE '1' END FROM o""")
def builder_diagnoses(spark, sf):
    """Parts are the codes in effect; suppliers' codes were replaced by those of the parts that they supplied."""
    from codetables.sources.shared import shared_root

    shared_root(spark)
    # A code has room for keys below a million; a part beyond has the code of a smaller one and says its titles again.
    titles = F.min_by(F.struct("p_brand", "p_name"), "p_partkey").over(Window.partitionBy(_icd("p_partkey", "")))
    titled = _t(spark, sf, "part").select("p_partkey", titles.alias("t"))
    order = _text(titled, F.concat(F.rpad(_icd("p_partkey", ""), 8, " "), F.lit("1 "), F.rpad("t.p_brand", 60, " "), F.col("t.p_name")), "order")
    lines = readers.read_fixed_width(spark, order, {"code": (0, 8), "flag": (8, 9), "short": (10, 70), "long": (70, None)})
    pairs = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    cells = pairs.groupBy("l_partkey").agg(F.array_join(F.array_sort(F.collect_list(_icd("l_suppkey", letter="B"))), ", ").alias("cell"))
    table = readers.read_delimited(spark, _text(cells, F.concat_ws("|", _icd("l_partkey"), F.lit("2020"), "cell"), "table"))
    rows = _rows_of(J.diagnoses(lines, table, {"names": "names", "status": "status", "conversions": "conversions"}), "subject", "subject_id", "object_id", "mapping_cardinality")
    code = lambda c: X.code_of("icd10cm", c)
    return rows.select("series", code(F.coalesce("subject", "subject_id")).alias("a"), code("object_id").alias("b"), F.col("mapping_cardinality").alias("cardinality"))


@query("""
WITH d AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem),
n AS (SELECT p, count(*) AS n, min(s) AS s FROM d GROUP BY p)
SELECT 'names' AS series, 'p' || p_partkey AS a, p_name AS b FROM part UNION ALL SELECT 'names', 's' || s_suppkey, s_name FROM supplier
UNION ALL SELECT 'ingredients', 's' || s_suppkey, 's' || s_suppkey FROM supplier
UNION ALL SELECT 'ingredients', 'p' || p, 's' || s FROM n WHERE n = 1""")
def builder_drugs(spark, sf):
    """Suppliers as ingredients of the parts that they supply; parts of several suppliers have no single ingredient."""
    p, s = _t(spark, sf, "part"), _t(spark, sf, "supplier")
    term = lambda df, code, kind, name: df.select(F.concat(F.lit(code[0]), F.col(code[1])).alias("c"), F.lit(kind).alias("k"), F.col(name).alias("n"))
    terms = term(p, ("p", "p_partkey"), "SCDC", "p_name").union(term(s, ("s", "s_suppkey"), "IN", "s_name"))
    blank = F.lit("")
    conso = _text(terms, F.concat_ws("|", "c", *[blank] * 10, F.lit("RXNORM"), "k", blank, "n", blank, F.lit("N"), blank), "conso")
    pairs = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    rels = _text(pairs, F.concat_ws("|", F.concat(F.lit("s"), "l_suppkey"), blank, F.lit("CUI"), blank, F.concat(F.lit("p"), "l_partkey"), blank, blank, F.lit("has_ingredient"), blank, blank, F.lit("RXNORM"), blank), "rels")
    built = J.drugs(readers.read_delimited(spark, conso), readers.read_delimited(spark, rels), {"names": "names", "products": "products", "ingredients": "ingredients", "generics": "generics"})
    rows = _rows_of(built, "subject", "subject_id", "object_id", "prefLabel")
    code = lambda c: X.code_of("rxnorm", c)
    return rows.select("series", code(F.coalesce("subject", "subject_id")).alias("a"), F.coalesce(code("object_id"), "prefLabel").alias("b"))


@query("""
SELECT DISTINCT 'classes' AS series, 's' || l_suppkey AS a, 'c' || l_partkey AS b FROM lineitem
UNION ALL SELECT DISTINCT 'names', 'c' || l_partkey, p_name || ' [MoA]' FROM lineitem JOIN part ON p_partkey = l_partkey""")
def builder_drug_classes(spark, sf):
    """Parts as classes of the suppliers that supply them."""
    pairs = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct().join(_t(spark, sf, "part"), F.expr("p_partkey = l_partkey"))
    name = F.concat("p_name", F.lit(" [MoA]"))
    said = pairs.select(
        F.lit("has_MoA").alias("name"), F.lit("RxNorm").alias("from_namespace"), F.lit("d").alias("from_name"), F.concat(F.lit("s"), "l_suppkey").alias("from_code"),
        F.lit("MED-RT").alias("to_namespace"), name.alias("to_name"), F.concat(F.lit("c"), "l_partkey").alias("to_code"), F.array(F.struct(F.lit("Authority").alias("name"), F.lit("FDASPL").alias("value"))).alias("qualifier"),
    )
    concepts = _t(spark, sf, "part").select(F.concat(F.lit("c"), "p_partkey").alias("code"), name.alias("name"))
    path = _text(said, F.to_json(F.struct(*said.columns)), "associations")
    # An outer generator, below which no filter is pushed: there it would parse each line again.
    lines = readers.read_json_lines(spark, path, said._jdf.schema().toDDL()).select(F.inline_outer(F.array("parsed")))
    rows = _rows_of(J.drug_classes(lines, concepts, {"classes": "classes", "names": "names"}), "subject", "subject_id", "object_id", "prefLabel")
    return rows.select("series", F.coalesce(X.code_of("rxnorm", "subject_id"), X.code_of("medrt", "subject")).alias("a"), F.coalesce(X.code_of("medrt", "object_id"), "prefLabel").alias("b"))


@query("""
WITH m AS (SELECT l_orderkey || '-1' AS panel, l_partkey || '-2' AS code, CAST(min(l_linenumber) AS BIGINT) AS sequence FROM lineitem GROUP BY l_orderkey, l_partkey)
SELECT 'members' AS series, panel AS a, code AS b, sequence FROM m
UNION ALL SELECT DISTINCT 'names', panel, NULL, NULL FROM m UNION ALL SELECT DISTINCT 'names', code, NULL, NULL FROM m""")
def builder_labs(spark, sf):
    """Orders as panels of the parts in them; each part once, at its first line."""
    m = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min("l_linenumber").alias("n"))
    m = m.select(F.concat("l_orderkey", F.lit("-1")).alias("panel"), F.concat("l_partkey", F.lit("-2")).alias("code"), "n", _s("l_orderkey").alias("own"))
    blank = F.lit("")
    codes = m.select("panel").union(m.select("code")).distinct().toDF("LOINC_NUM")
    terms = codes.select("LOINC_NUM", F.lit("1").alias("CLASSTYPE"), F.lit("ACTIVE").alias("STATUS"), blank.alias("EXTERNAL_COPYRIGHT_NOTICE"), F.concat(F.lit("name of "), "LOINC_NUM").alias("LONG_COMMON_NAME"))
    head = m.select("panel", "own").distinct().select(F.col("own").alias("ParentId"), F.col("panel").alias("ParentLoinc"), F.col("own").alias("ID"), F.lit("0").alias("SEQUENCE"), F.col("panel").alias("Loinc"))
    rest = m.select(F.col("own").alias("ParentId"), F.col("panel").alias("ParentLoinc"), F.concat_ws("0", "own", "n").alias("ID"), _s("n").alias("SEQUENCE"), F.col("code").alias("Loinc"))
    panels = head.union(rest).select("*", blank.alias("ObservationRequiredInPanel"), blank.alias("EXTERNAL_COPYRIGHT_NOTICE"), blank.alias("AdditionalCopyright"))
    maps = codes.where("LOINC_NUM = ''").select(F.col("LOINC_NUM").alias("LOINC"), F.col("LOINC_NUM").alias("MAP_TO"))
    built = J.labs(written(terms, "terms"), written(panels, "panels"), maps, {"names": "names", "status": "status", "members": "members"})
    rows = _rows_of(built, "subject", "subject_id", "object_id", "sequence")
    code = lambda c: X.code_of("loinc", c)
    return rows.select("series", code(F.coalesce("subject", "subject_id")).alias("a"), code("object_id").alias("b"), "sequence")


@query("""
WITH v AS (SELECT user_id, arg_min(event_type, event_id) AS first_type, bool_or(event_type = 'purchase') AS known,
  coalesce(arg_max(strftime(ts, '%Y-%m-%d'), event_id) FILTER (WHERE event_type = 'purchase'), arg_max(strftime(ts, '%Y-%m-%d'), event_id) FILTER (WHERE event_type = 'click'), arg_min(strftime(ts, '%Y-%m-%d'), event_id)) AS day FROM events GROUP BY user_id)
SELECT 'https://identifiers.org/clinvar:' || user_id AS variation, day AS last_evaluated FROM v""")
def builder_variants(spark, sf):
    """Users as variants that events evaluate: of purchases the last, else of clicks, else the first event counts."""
    e = _t(spark, sf, "events")
    assembly = F.when(F.col("event_type") == "purchase", "GRCh38").when(F.col("event_type") == "click", "GRCh37").otherwise("na")
    day = F.date_format("ts", "MMM dd, yyyy")
    summary = e.select(F.col("event_id").alias("number"), _s("user_id").alias("VariationID"), F.lit("G").alias("GeneSymbol"), F.concat(F.lit("x"), "user_id").alias("Name"), assembly.alias("Assembly"), F.lit("p").alias("ClinicalSignificance"), F.lit("s").alias("ReviewStatus"), day.alias("LastEvaluated"), F.lit("1").alias("NumberSubmitters"), F.lit("a|b").alias("SCVsForAggregateGermlineClassification"))
    snapshot = e.where("event_id < 0").select(F.col("event_id").alias("number"), F.lit("G").alias("Symbol"), _s("user_id").alias("VariationID"), F.lit("coding").alias("Type"), F.lit("x").alias("NucleotideExpression"), F.lit("No").alias("Submitted"))
    classes, statuses = (spark.createDataFrame([(label, f"c:{label}")], "label string, concept string") for label in ("p", "s"))
    built = J.variants(written(summary, "summary"), snapshot, ["G"], classes, statuses, {"classifications": "classifications", "names": "names"})
    return _rows_of(built, "variation", "lastEvaluated").where("series = 'classifications'").select("variation", F.col("lastEvaluated").alias("last_evaluated"))


@query("""
WITH b AS (SELECT p_partkey AS k, p_name AS v FROM part WHERE p_size <= 40), a AS (SELECT p_partkey AS k, CASE WHEN p_size < 5 THEN p_name || ' (new)' ELSE p_name END AS v FROM part WHERE p_size > 2)
SELECT coalesce(a.k, b.k) AS code, CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v""")
def built_version(spark, sf):
    """Two releases of the parts, by size, to a version of the later one."""
    p = _t(spark, sf, "part").withColumns({"iri": X.code_iri(PART, _s("p_partkey")), "code": _s("p_partkey")})
    rows = lambda df, name: names_rows(df.withColumn("name", name), "parts", "iri", "name", F.lit(None), "code")
    later = F.when(F.col("p_size") < 5, F.concat("p_name", F.lit(" (new)"))).otherwise(F.col("p_name"))
    built = build_version(BuildResult(rows(p.where("p_size > 2"), later)), rows(p.where("p_size <= 40"), F.col("p_name")), {"parts": None})
    return built.changes.select(X.code_of(PART, "key").cast("long").alias("code"), "change")


@query("""
WITH one AS (SELECT p_partkey AS k FROM part WHERE p_size <= 40), two AS (SELECT p_partkey AS k FROM part WHERE p_size > 2),
c AS (SELECT (SELECT count(*) FROM one) AS n1, (SELECT count(*) FROM two) AS n2, (SELECT count(*) FROM two WHERE k NOT IN (SELECT k FROM one)) AS plus,
  (SELECT count(*) FROM one WHERE k NOT IN (SELECT k FROM two)) AS minus, (SELECT count(*) FROM part WHERE p_size > 2 AND p_size < 5) AS other)
SELECT '2026-10' AS label, n1 || ' added, 0 removed, 0 changed' AS notes, 1 AS covers, false AS revises, CAST(n1 AS BIGINT) AS n, 'a' AS inputs FROM c
UNION ALL SELECT '2026-10 (builder 1)', plus || ' added, ' || minus || ' removed, ' || other || ' changed', 1, true, n2, 'a|b' FROM c
UNION ALL SELECT '2026-10 (builder 1)', '0 added, 0 removed, 0 changed', 2, true, n2, 'a|d' FROM c""")
def published_versions(spark, sf):
    """Four builds into one catalog: parts, parts with changes, the same again (nothing new), and the same that cover more."""
    p = _t(spark, sf, "part").withColumns({"iri": X.code_iri(PART, _s("p_partkey")), "code": _s("p_partkey")})
    rows = lambda df, name: names_rows(df.withColumn("name", name), "parts", "iri", "name", F.lit(None), "code")
    later = F.when(F.col("p_size") < 5, F.concat("p_name", F.lit(" (new)"))).otherwise(F.col("p_name"))
    one, two = rows(p.where("p_size <= 40"), F.col("p_name")), rows(p.where("p_size > 2"), later)
    place = shared_path(spark, "published")
    current, version = one.where(F.lit(False)), None
    for file, release, covers in (("a", one, ["x"]), ("b", two, ["x"]), ("c", two, ["x"]), ("d", two, ["x", "y"])):
        files = spark.createDataFrame([("a",), (file,)], "iri string")
        to = Publication(f"{place}/catalog", "2026-10", "parts", "1", {"parts": "CodeNames"}, covers={"parts": covers}, inputs=files)
        built = build_version(BuildResult(release), current, {"parts": version}, path=f"{place}/rows", publish=to)
        version = built.names["parts"] or version
        current = built.rows
    got = commits.read_catalog(spark, f"{place}/catalog")
    files = got["version_inputs"].groupBy(F.col("version").alias("iri")).agg(F.array_join(F.array_sort(F.collect_list("input")), "|").alias("inputs"))
    return got["versions"].join(files, "iri").select("label", "notes", F.size("covers").alias("covers"), F.col("revises").isNotNull().alias("revises"), "n", "inputs")


# ---- expressions and joins that no other query runs


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def month_day_year(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", X.parse_month_day_year(F.date_format("o_orderdate", "MMM dd, yyyy")).alias("day"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%Y-%m-%d %H:%M') AS listed FROM events")
def file_times(spark, sf):
    e = _t(spark, sf, "events")
    http = X.http_date(F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss 'GMT'"))
    listed = X.listing_time(F.date_format("ts", "M/d/yyyy  h:mm a"))
    return e.select("event_id", F.date_format(http, "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.date_format(listed, "yyyy-MM-dd HH:mm").alias("listed"))


@query("SELECT l_orderkey, l_linenumber, 'NM_' || l_partkey || '.' || l_linenumber || ':c.' || l_suppkey || 'A>G' AS expression FROM lineitem")
def name_expressions(spark, sf):
    name = F.format_string("NM_%s.%s(GENE):c.%sA>G (p.x)", _s("l_partkey"), _s("l_linenumber"), _s("l_suppkey"))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", X.name_expression(name).alias("expression"))


@query("SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n, array_to_string(string_split(p_name, ' '), ',') AS terms FROM part")
def listed_terms(spark, sf):
    slashed = F.replace(F.col("p_name"), F.lit(" "), F.lit("/"))
    return _t(spark, sf, "part").select("p_partkey", X.count_listed("p_name", " ").alias("n"), F.array_join(X.split_terms(slashed), ",").alias("terms"))


@query(f"""
SELECT o_orderkey, array_to_string([{_ICD.format("o_custkey", "A")}, {_ICD.format("o_orderkey % 1000000", "A")}], '|') AS codes FROM orders""")
def codes_in_cells(spark, sf):
    o = _t(spark, sf, "orders").withColumn("k", F.col("o_orderkey") % 1000000)
    cell = F.concat(_icd("o_custkey"), F.lit(" and "), _icd("k"), F.lit("; None"))
    return o.select("o_orderkey", F.array_join(X.split_codes(cell), "|").alias("codes"))


@query("SELECT CAST(p_partkey AS BIGINT) AS k, row_number() OVER (ORDER BY p_brand[1:6], CAST(p_brand[7:] AS BIGINT), p_partkey) AS n FROM part")
def natural_order(spark, sf):
    p = _t(spark, sf, "part").withColumn("_key", X.natural_sort_key(F.concat_ws(" ", "p_brand", _s("p_partkey"))))
    # Numbers are given within each brand's prefix, and brands are few.
    brands = p.groupBy("p_brand").agg(F.count("*").alias("c"), F.min("_key").alias("b"))
    before = brands.withColumn("before", F.sum("c").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)))
    inside = p.withColumn("i", F.row_number().over(Window.partitionBy("p_brand").orderBy("_key"))).join(before.select("p_brand", F.coalesce("before", F.lit(0)).alias("before")), "p_brand")
    return inside.select(F.col("p_partkey").cast("long").alias("k"), (F.col("i") + F.col("before")).alias("n"))


@query("SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS target FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def typed_pairs(spark, sf):
    pairs = _t(spark, sf, "lineitem").select(_s("l_partkey").alias("code"), _s("l_suppkey").alias("target"))
    concepts = _t(spark, sf, "supplier").select(_s("s_suppkey").alias("code"), F.when(F.col("s_acctbal") > 0, "IN").otherwise("PIN").alias("type"))
    return R.require_type(pairs, "target", concepts, "IN")[0].select("target").distinct()


@query("""
SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS code, CAST(l_partkey AS VARCHAR) AS target FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def brand_targets(spark, sf):
    a = _t(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("code"), F.when(F.col("s_acctbal") > 0, "SBD").otherwise("IN").alias("type"))
    b = _t(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("code"), F.when(F.col("p_size") > 10, "SCD").otherwise("IN").alias("type"))
    rel = _t(spark, sf, "lineitem").select(F.lit("tradename_of").alias("relation"), F.concat(F.lit("s"), "l_suppkey").alias("from"), F.concat(F.lit("p"), "l_partkey").alias("to")).distinct()
    pairs = spark.createDataFrame([("SBD", "SCD")], "type string, target_type string")
    return R.typed_targets(a.union(b), rel, "tradename_of", pairs).select(F.substring("code", 2, 30).alias("code"), F.substring("target", 2, 30).alias("target"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_linestatus = 'F'")
def submitted_expressions(spark, sf):
    line = _t(spark, sf, "lineitem").withColumn("e", F.when(F.col("l_linestatus") == "F", F.concat(F.lit("NM_"), "l_partkey")).otherwise(F.concat(F.lit("NM_"), "l_partkey", F.lit(",x"))))
    return R.filter_submitted(line, "e", "l_returnflag", ["R", "A"]).select("l_orderkey", "l_linenumber")


@query("SELECT p_partkey FROM part WHERE p_type IN (SELECT min(p_type) FROM part) AND p_size < 20")
def unnoticed_parts(spark, sf):
    p = _t(spark, sf, "part").withColumn("notice", F.when(F.col("p_size") >= 20, "noticed"))
    least = p.agg(F.min("p_type").alias("t")).first()["t"]
    return R.shipped_unnoticed(p, "p_type", [least], "notice").select("p_partkey")


@query("SELECT event_id FROM events WHERE event_type = 'click'")
def authorities(spark, sf):
    e = _t(spark, sf, "events").withColumn("qualifier", F.array(F.struct(F.lit("Authority").alias("name"), F.when(F.col("event_type") == "click", "FDASPL").otherwise("other").alias("value"))))
    return R.filter_authority(e).select("event_id")


@query(f"SELECT '{SUPP}' || s_suppkey AS key FROM supplier WHERE s_acctbal > 0")
def retired_rows(spark, sf):
    from codetables.functions.rows import status_rows

    s = _t(spark, sf, "supplier").withColumn("iri", X.code_iri(SUPP, _s("s_suppkey")))
    return status_rows(s.where("s_acctbal > 0"), "status", "iri").select("key")
