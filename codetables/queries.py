"""The operators applied to the tables of a sf_dir, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.functions import scalars as X
from codetables.functions.rows import (
    CURATED, MEMBER_OF, from_triples, mapping_rows, member_rows, merge_rows, names_rows, row_content, row_lines, status_rows,
    term_type_rows, to_triples,
)
from codetables.operators import checks as Q
from codetables.operators import relations as R
from codetables.operators import summaries as S
from codetables.operators import versions as V
from codetables.operators.carry import apply_history, carry_forward, carry_status, rekey_carried
from codetables.operators.scans import running
from codetables.sources.readers import pick_release_files
from codetables.sources.shared import shared_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
PART, SUPP, CUST = "https://example.org/part/", "https://example.org/supplier/", "https://example.org/customer/"


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_KEY = """'urn:uuid:' || h[1:8] || '-' || h[9:12] || '-8' || h[14:16] || '-' ||
  translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32]"""
_HEAD = f"'{X.ROW_NAMESPACE}|{X.ROW_RULE}|'"


def _named_parts(spark, sf):
    p = _t(spark, sf, "part").withColumns({"iri": X.code_iri(PART, "p_name"), "code": F.col("p_partkey").cast("string"), "other": X.alt_labels("p_name", F.array("p_brand", "p_type", "p_name"))})
    return names_rows(p, "names", "iri", "p_name", "other", "code")


@query(f"""
SELECT '{PART}' || url_encode(p_name) AS subject, p_name AS pref_label, CAST(p_partkey AS VARCHAR) AS notation,
  array_to_string(list_sort(list_distinct(list_filter([p_brand, p_type], lambda x: x <> p_name))), '|') AS alt_label FROM part""")
def names_rows_parts(spark, sf):
    return _named_parts(spark, sf).select("subject", F.col("prefLabel").alias("pref_label"), "notation", F.coalesce(F.array_join("altLabel", "|"), F.lit("")).alias("alt_label"))


def _supplies(spark, sf):
    pairs = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    iris = pairs.withColumns({"a": X.code_iri(PART, F.col("l_partkey").cast("string")), "b": X.code_iri(SUPP, F.col("l_suppkey").cast("string"))})
    return mapping_rows(iris, "supplies", "a", MEMBER_OF, "b")


@query(f"""
WITH d AS (SELECT DISTINCT '{PART}' || l_partkey AS a, '{SUPP}' || l_suppkey AS b FROM lineitem),
k AS (SELECT a, b, sha256({_HEAD} || a || '|{MEMBER_OF}|' || b) AS h FROM d)
SELECT {_KEY} AS key, a AS subject_id, b AS object_id FROM k""")
def mapping_keys(spark, sf):
    return _supplies(spark, sf).select("key", "subject_id", "object_id")


@query(f"""
WITH d AS (SELECT '{SUPP}' || l_suppkey AS a, '{PART}' || l_partkey AS b, l_linenumber AS n, max(l_returnflag) AS r FROM lineitem GROUP BY ALL),
k AS (SELECT *, sha256({_HEAD} || a || '|{MEMBER_OF}|' || b || '|' || n) AS h FROM d)
SELECT {_KEY} AS key, CAST(n AS BIGINT) AS sequence, r AS required FROM k""")
def member_keys(spark, sf):
    d = _t(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey", "l_linenumber").agg(F.max("l_returnflag").alias("r"))
    d = d.withColumns({"a": X.code_iri(SUPP, F.col("l_suppkey").cast("string")), "b": X.code_iri(PART, F.col("l_partkey").cast("string"))})
    return member_rows(d, "members", "a", MEMBER_OF, "b", "l_linenumber", "r").select("key", "sequence", "required")


@query(f"""
WITH l AS (
  SELECT c_custkey, '<{CUST}' || c_custkey || '> <http://www.w3.org/2004/02/skos/core#' || p || '> "' ||
         replace(replace(v, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '" .' AS line
  FROM customer, LATERAL (VALUES ('prefLabel', c_name), ('altLabel', c_mktsegment), ('notation', CAST(c_custkey AS VARCHAR))) AS x(p, v))
SELECT '{CUST}' || c_custkey AS key, sha256(string_agg(line, chr(10) ORDER BY line)) AS content FROM l GROUP BY c_custkey""")
def row_content_hash(spark, sf):
    c = _t(spark, sf, "customer").withColumns({"iri": X.code_iri(CUST, F.col("c_custkey").cast("string")), "also": F.array("c_mktsegment"), "code": F.col("c_custkey").cast("string")})
    return names_rows(c, "names", "iri", "c_name", "also", "code").select("key", row_content().alias("content"))


@query(f"""
SELECT '{PART}' || url_encode(p_name) AS key FROM part GROUP BY p_name HAVING min(p_brand) <> max(p_brand)""")
def merge_conflicts(spark, sf):
    p = _t(spark, sf, "part").withColumn("iri", X.code_iri(PART, "p_name"))
    return merge_rows(names_rows(p, "names", "iri", "p_name", F.lit(None), "p_brand"))[1].where("key is not null").select("key")


def _snapshots(spark, sf):
    o = _t(spark, sf, "orders").withColumns({"key": F.col("o_orderkey").cast("string"), "series": F.col("o_orderstatus")})
    # Two releases: the earlier has no orders since 1998, the later no urgent ones of the first year, which it has dropped,
    # and it says other things of large orders. Every order is in one of them.
    a = o.where("o_orderdate < timestamp'1998-01-01'").select("series", "key", F.sha2("o_orderpriority", 256).alias("content"))
    later = F.when(F.col("o_totalprice") > 300000, F.lit("0-NEW")).otherwise(F.col("o_orderpriority"))
    stays = "o_orderdate >= timestamp'1993-01-01' or o_orderpriority <> '1-URGENT'"
    return a, o.where(stays).select("series", "key", F.sha2(later, 256).alias("content"))


_DIFF = """
WITH a AS (SELECT o_orderstatus AS s, o_orderkey AS k, o_orderpriority AS v FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b AS (SELECT o_orderstatus AS s, o_orderkey AS k, CASE WHEN o_totalprice > 300000 THEN '0-NEW' ELSE o_orderpriority END AS v FROM orders WHERE o_orderdate >= TIMESTAMP '1993-01-01' OR o_orderpriority <> '1-URGENT'),
d AS (SELECT coalesce(a.s, b.s) AS series, CAST(coalesce(a.k, b.k) AS VARCHAR) AS key,
  CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.v <> b.v THEN 'changed' END AS change
  FROM a FULL JOIN b ON a.s = b.s AND a.k = b.k)
"""


@query(_DIFF + "SELECT * FROM d WHERE change IS NOT NULL")
def version_diff(spark, sf):
    return V.diff(*_snapshots(spark, sf))


@query(_DIFF + """SELECT series, count(*) FILTER (WHERE change = 'added') || ' added, ' || count(*) FILTER (WHERE change = 'removed') || ' removed, ' ||
  count(*) FILTER (WHERE change = 'changed') || ' changed' AS notes FROM d WHERE change IS NOT NULL GROUP BY series""")
def version_notes(spark, sf):
    return V.notes(V.diff_counts(V.diff(*_snapshots(spark, sf)))).select("series", "notes")


def _customers(spark, sf):
    c = _t(spark, sf, "customer").withColumns({"iri": F.concat(F.lit("https://example.org/n"), "c_nationkey", F.lit("/"), F.col("c_custkey").cast("string")), "code": F.col("c_custkey").cast("string")})
    rows = lambda d: names_rows(d, "names", "iri", "c_name", F.lit(None), "code")
    # The registry holds the spaces of the nations of two regions.
    n = _t(spark, sf, "nation").where("n_regionkey in (1, 2)")
    registry = n.select(F.col("n_name").alias("system"), F.concat(F.lit("https://example.org/n"), "n_nationkey", F.lit("/")).alias("space"))
    # Customers in debt have left the release, those of one segment came after the current version.
    return rows(c.where("c_acctbal >= 0")), rows(c.where("c_mktsegment <> 'BUILDING'")), registry


@query("""
SELECT 'https://example.org/n' || c_nationkey || '/' || c_custkey AS key FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment <> 'BUILDING' AND c_acctbal < 0 AND n_regionkey IN (1, 2)""")
def carry_forward_rows(spark, sf):
    built, current, registry = _customers(spark, sf)
    return carry_forward(built, current, ["names"], registry).select("key")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS code FROM customer WHERE c_nationkey = 2 AND c_mktsegment <> 'BUILDING' AND c_acctbal < 0 AND c_mktsegment <> 'MACHINERY'
  AND 2 IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))""")
def carry_lookup(spark, sf):
    built, current, registry = _customers(spark, sf)
    carried = carry_forward(built, current, ["names"], registry)
    machinery = _t(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("notation"))
    retired = status_rows(current.join(machinery, "notation", "left_semi"), "status", "subject")
    return carry_status(built, carried, retired, registry, "https://example.org/n2/")[1]


@query(f"""
WITH d AS (SELECT DISTINCT '{PART}' || l_partkey AS a, '{SUPP}' || l_suppkey AS b FROM lineitem),
k AS (SELECT sha256({_HEAD} || a || '|https://example.org/p|' || b) AS h FROM d) SELECT {_KEY} AS key FROM k""")
def rekeyed(spark, sf):
    return rekey_carried(_supplies(spark, sf), "https://example.org/p").select("key")


@query("SELECT p_name, CAST(min(p_partkey) AS BIGINT) AS first_owner, CAST(max(p_partkey) AS BIGINT) AS last_owner FROM part GROUP BY p_name HAVING min(p_partkey) <> max(p_partkey)")
def ambiguous_names(spark, sf):
    return S.ambiguous_keys([_t(spark, sf, "part")], "p_name", "p_partkey")


def _preferred(spark, sf):
    return S.prefer_source(_t(spark, sf, "events"), "user_id", "event_type", ["purchase", "click"], "event_id", ["value", "props"])


@query("""
WITH s AS (SELECT user_id, arg_max(props, event_id) FILTER (WHERE event_type = 'purchase') AS s0,
  arg_max(props, event_id) FILTER (WHERE event_type = 'click') AS s1, arg_min(props, event_id) AS f FROM events GROUP BY user_id)
SELECT user_id, coalesce(s0, s1, f) AS props FROM s""")
def prefer_source(spark, sf):
    return _preferred(spark, sf).select("user_id", "props")


@query("""
WITH s AS (SELECT user_id, arg_max(event_id, event_id) FILTER (WHERE event_type = 'purchase') AS a, arg_max(event_id, event_id) FILTER (WHERE event_type = 'click') AS b FROM events GROUP BY user_id)
SELECT s.user_id FROM s JOIN events x ON x.event_id = a JOIN events y ON y.event_id = b WHERE x.value IS DISTINCT FROM y.value OR x.props IS DISTINCT FROM y.props""")
def disagreements(spark, sf):
    return S.disagreements(_preferred(spark, sf), "user_id")


@query("SELECT user_id, arg_max(props, event_id) AS last_props, arg_min(event_type, event_id) AS first_type FROM events GROUP BY user_id")
def last_and_first_by_order(spark, sf):
    e = _t(spark, sf, "events")
    return S.last_by_order(e, "user_id", "props", "event_id").withColumnRenamed("props", "last_props").join(S.first_by_order(e, "user_id", "event_type", "event_id").withColumnRenamed("event_type", "first_type"), "user_id")


@query("""
WITH s AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_suppkey)) AS x FROM lineitem GROUP BY l_orderkey),
c AS (SELECT o_custkey AS k, list_sort(list(DISTINCT l_suppkey)) AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
SELECT s.k AS key, max(c.k) AS match FROM s JOIN c ON s.x = c.x GROUP BY s.k""")
def set_match(spark, sf):
    line = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_suppkey")
    cust = _t(spark, sf, "lineitem").join(_t(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey")).select(F.col("o_custkey").alias("k"), "l_suppkey")
    return R.match_sets(line, cust, "k", "l_suppkey")[0]


@query("""
WITH c AS (SELECT o_custkey AS k, list_sort(list(DISTINCT o_orderpriority)) AS x FROM orders GROUP BY o_custkey)
SELECT CAST(max(k) AS VARCHAR) AS key, 'has the same set as ' || min(k) AS message FROM c GROUP BY x HAVING count(*) > 1""")
def set_doubles(spark, sf):
    """Customers whose sets of priorities another customer has, too."""
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderpriority")
    return R.match_sets(o, o, "k", "o_orderpriority")[1]


@query("""
SELECT DISTINCT c_custkey AS code, r_name AS target FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def hop_chain(spark, sf):
    s = lambda c, p: F.concat(F.lit(p), F.col(c).cast("string"))
    c, n, r = (_t(spark, sf, x) for x in ("customer", "nation", "region"))
    rel = c.select(F.lit("in").alias("relation"), s("c_custkey", "c").alias("from"), s("c_nationkey", "n").alias("to"))
    rel = rel.union(n.select(F.lit("part_of"), s("n_nationkey", "n"), s("n_regionkey", "r")))
    concepts = c.select(s("c_custkey", "c").alias("code"), F.lit("C").alias("type")).union(n.select(s("n_nationkey", "n"), F.lit("N"))).union(r.select(s("r_regionkey", "r"), F.lit("R")))
    found = R.follow(concepts, rel, {"C": [[("in", "N"), ("part_of", "R")]]})
    names = r.select(s("r_regionkey", "r").alias("target"), "r_name")
    return found.join(names, "target").select(F.expr("cast(substring(code, 2) as long)").alias("code"), F.col("r_name").alias("target"))


@query("""
WITH RECURSIVE e AS (SELECT p_partkey AS a, p_partkey + 1 AS b FROM part WHERE p_partkey % 5 <> 0 UNION SELECT p_partkey, p_partkey + 7 FROM part WHERE p_partkey % 9 = 1),
v AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 5 = 0),
f AS (SELECT a, b, (SELECT count(*) FROM e x WHERE x.b = e.b) > 1 AS m, (SELECT count(*) FROM e x WHERE x.a = e.a) > 1 AS s FROM e),
w(a, b, p, m, s, n) AS (
  SELECT a, b, [a, b], m, s, 1 FROM f WHERE a NOT IN (SELECT k FROM v)
  UNION ALL
  SELECT w.a, f.b, list_append(w.p, f.b), w.m OR f.m, w.s OR f.s, n + 1 FROM w JOIN f ON w.b = f.a WHERE w.b NOT IN (SELECT k FROM v) AND NOT list_contains(w.p, f.b))
SELECT a AS code, b AS target, CASE WHEN bool_or(m) THEN 'n' ELSE '1' END || ':' || CASE WHEN bool_or(s) THEN 'n' ELSE '1' END AS cardinality, bool_or(n = 1) AS direct
FROM w WHERE b IN (SELECT k FROM v) GROUP BY a, b""")
def resolve_replacements(spark, sf):
    shared_root(spark)
    p = _t(spark, sf, "part")
    k = F.col("p_partkey")
    edges = p.where(k % 5 != 0).select(k.alias("prev"), (k + 1).alias("next")).union(p.where(k % 9 == 1).select(k, k + 7))
    return R.resolve_replacements(edges, p.where(k % 5 == 0).select(k.alias("code")))


@query("""
WITH d AS (SELECT DISTINCT o_custkey AS c, o_orderpriority AS p FROM orders)
SELECT c AS o_custkey, p AS o_orderpriority, CASE WHEN count(*) OVER (PARTITION BY p) > 1 THEN 'n' ELSE '1' END || ':' || CASE WHEN count(*) OVER (PARTITION BY c) > 1 THEN 'n' ELSE '1' END AS cardinality FROM d""")
def mapping_cardinality(spark, sf):
    return R.mapping_cardinality(_t(spark, sf, "orders"), "o_custkey", "o_orderpriority")


@query("""
WITH c AS (SELECT DISTINCT l_partkey, CAST(l_suppkey AS VARCHAR) AS parent, l_partkey % 10 = l_suppkey % 10 AS root FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY root DESC, CAST(parent AS BIGINT)) AS n FROM c)
SELECT l_partkey, parent FROM r WHERE n = 1""")
def pick_copy(spark, sf):
    c = _t(spark, sf, "lineitem").select("l_partkey", F.col("l_suppkey").cast("string").alias("parent"), (F.col("l_partkey") % 10 == F.col("l_suppkey") % 10).alias("root")).distinct()
    return S.pick_copy(c, "l_partkey", F.col("root"), "parent").select("l_partkey", "parent").distinct()


@query("SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY l_orderkey")
def exclude_groups(spark, sf):
    return S.exclude_groups_with(_t(spark, sf, "lineitem"), "l_orderkey", F.col("l_returnflag") == "R").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("SELECT CAST(doc_id AS VARCHAR) AS key, 'is not labelled' AS message FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def require_known(spark, sf):
    return R.require_known(_t(spark, sf, "documents"), "doc_id", _t(spark, sf, "labels"), "doc_id", "is not labelled")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def keep_known(spark, sf):
    return R.keep_known(_t(spark, sf, "orders"), "o_custkey", _t(spark, sf, "customer").where("c_acctbal > 0"), "c_custkey").select("o_orderkey")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def unlisted(spark, sf):
    o = _t(spark, sf, "orders")
    return R.unlisted(o, "o_custkey", o.where("o_orderpriority = '1-URGENT'"), "o_custkey")


@query("SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE 'not mapped' END AS retired FROM orders GROUP BY o_orderstatus")
def status_map(spark, sf):
    o = _t(spark, sf, "orders").withColumn("retired", F.coalesce(X.status_of("o_orderstatus", {"F": True, "O": False}).cast("string"), F.lit("not mapped")))
    return o.groupBy("o_orderstatus", "retired").agg(F.count("*").alias("n"))


@query("""
WITH t AS (SELECT p_partkey AS id, unnest(string_split(p_name, ' ')) AS term FROM part)
SELECT 'name' AS kind, term, CAST(count(DISTINCT id) AS BIGINT) AS n, array_to_string(list_sort(list(DISTINCT id))[1:5], ', ') AS examples FROM t GROUP BY term""")
def term_findings(spark, sf):
    t = _t(spark, sf, "part").select(F.lit("name").alias("kind"), F.explode(F.split("p_name", " ")).alias("term"), F.col("p_partkey").alias("id"))
    return S.group_findings(t, "kind", "term", "id")


@query("""
WITH l AS (SELECT DISTINCT p_type AS label, 'c:' || md5(p_type) AS concept FROM part WHERE p_size > 10),
t AS (SELECT p_partkey, generate_subscripts(x, 1) AS i, unnest(x) AS label FROM (SELECT p_partkey, string_split(p_brand || '/' || p_type, '/') AS x FROM part)),
m AS (SELECT t.*, concept FROM t LEFT JOIN l USING (label))
SELECT p_partkey, coalesce(string_agg(concept, '|' ORDER BY i) FILTER (WHERE concept IS NOT NULL), '') AS concepts FROM m GROUP BY p_partkey""")
def lookup_labels(spark, sf):
    p = _t(spark, sf, "part")
    labels = p.where("p_size > 10").select(F.col("p_type").alias("label"), F.concat(F.lit("c:"), F.md5("p_type")).alias("concept")).distinct()
    terms = p.select("p_partkey", X.split_terms(F.concat("p_brand", F.lit("/"), "p_type")).alias("terms"))
    return R.lookup_labels(terms, "p_partkey", "terms", labels)[0].select("p_partkey", F.array_join("concepts", "|").alias("concepts"))


@query(f"""
SELECT '{X.SPACES["rxnorm"]}' || p_partkey AS key, CASE WHEN p_size > 40 THEN '' WHEN p_size > 30 THEN '{X.SPACES["rxnorm"]}' || p_size
  ELSE array_to_string(list_transform(list_sort(list_distinct(['{X.SPACES["rxnorm"]}' || (p_partkey + 1), '{X.SPACES["rxnorm"]}' || p_size])), lambda x: x), '|') END AS replaced_by
FROM part WHERE p_size > 20""")
def history_rows(spark, sf):
    """Status rows from history answers: codes of parts that are active, remapped, quantified or obsolete, by size."""
    p = _t(spark, sf, "part")
    status = F.when(F.col("p_size") > 40, "Obsolete").when(F.col("p_size") > 30, "Quantified").when(F.col("p_size") > 20, "Remapped").otherwise("Active")
    code, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    remapped = F.array(*[F.struct(c.alias("remappedRxCui")) for c in ((F.col("p_partkey") + 1).cast("string"), size, size)])
    derived = F.struct(remapped.alias("remappedConcept"), F.array(F.struct(size.alias("quantifiedRxcui"))).alias("quantifiedConcept"))
    history = F.struct(F.struct(status.alias("status")).alias("metaData"), derived.alias("derivedConcepts"))
    answers = p.select(F.to_json(F.struct(code.alias("code"), F.struct(history.alias("rxcuiStatusHistory")).alias("answer"))).alias("value"))
    return apply_history(answers, "status", "rxnorm")[0].select("key", F.array_join("replacedBy", "|").alias("replaced_by"))


@query("""
WITH f AS (SELECT o_custkey AS source, CAST(o_orderkey AS VARCHAR) AS title, md5(o_orderstatus || o_orderkey) AS checksum FROM orders)
SELECT 's' || source || '-' || sha256(string_agg(checksum, chr(10) ORDER BY title))[1:12] AS tag, array_to_string(list(title ORDER BY title), '|') AS titles FROM f GROUP BY source""")
def release_manifests(spark, sf):
    """The tag and the files of each customer's release, whose files are the orders."""
    o = _t(spark, sf, "orders").select(F.concat(F.lit("s"), "o_custkey").alias("source"), F.col("o_orderkey").cast("string").alias("title"), F.md5(F.concat("o_orderstatus", "o_orderkey").cast("binary")).alias("checksum"))
    return V.release_manifests(o).select("tag", F.array_join("titles", "|").alias("titles"))


@query(r"""
WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]+)"[^>]*>', 1)) AS r FROM pages)
SELECT DISTINCT page_id, replace(r[2:], '&amp;', '&') AS name, false AS is_folder FROM p WHERE r LIKE '/_%' AND NOT contains(r[2:], '/')""")
def page_links(spark, sf):
    """Links of the pages, as listings of their hosts, that lie directly below."""
    p = _t(spark, sf, "pages").withColumn("base", F.concat(F.regexp_extract("url", "^[a-z]+://[^/?#]+", 0), F.lit("/")))
    return V.list_links(p, "page_id", "html", "base").select("page_id", "name", "is_folder")


@query(r"""
WITH o AS (SELECT o_custkey AS page, o_orderkey AS k, 'https://example.org/pub/' || o_custkey || '/' AS base, o_orderdate AS d, o_orderkey % 7 AS kind FROM orders)
SELECT page, CASE WHEN kind IN (0, 1) THEN 'o' || k || '.txt' WHEN kind = 2 THEN 'o' || k WHEN kind = 4 THEN 'o ' || k || '+é.txt?v=1&w=2' ELSE '?C=' || k END AS name,
  base || CASE WHEN kind IN (0, 1) THEN 'o' || k || '.txt' WHEN kind = 2 THEN 'o' || k || '/' WHEN kind = 4 THEN 'o%20' || k || '+%C3%A9.txt?v=1&w=2' ELSE '?C=' || k END AS href,
  kind = 2 AS is_folder, CASE WHEN kind <> 6 THEN CAST(CAST(d AS DATE) AS TIMESTAMP) + INTERVAL 14 HOUR + INTERVAL 25 MINUTE END AS modified
FROM o WHERE kind NOT IN (3, 5)""")
def listing_links(spark, sf):
    """A customer's orders as a folder listing, with every kind of reference, entities and times."""
    o = _t(spark, sf, "orders").withColumns({"base": F.concat(F.lit("https://example.org/pub/"), "o_custkey", F.lit("/")), "n": F.col("o_orderkey").cast("string")})
    kind = F.col("o_orderkey") % 7
    reference = (
        F.when(kind == 0, F.concat(F.lit("o"), "n", F.lit(".txt"))).when(kind == 1, F.concat(F.lit("/x/../pub/"), "o_custkey", F.lit("/./o"), "n", F.lit(".txt")))
        .when(kind == 2, F.concat(F.lit("./a/b/../../o"), "n", F.lit("/"))).when(kind == 3, "../").when(kind == 4, F.concat(F.lit("HTTPS://EXAMPLE.org/pub/"), "o_custkey", F.lit("/o%20"), "n", F.lit("+&#233;.txt?v=1&amp;w=2")))
        .when(kind == 5, F.concat(F.lit("//elsewhere.org/pub/"), "o_custkey", F.lit("/o"))).otherwise(F.concat(F.lit("?C="), "n"))
    )
    time = F.when(kind == 6, "no time ").otherwise(F.concat(F.date_format("o_orderdate", "M/d/yyyy"), F.lit("  2:25 PM  ")))
    line = F.concat(time, F.lit('<A class="x" HREF="'), reference, F.lit('">'), "n", F.lit("</A><br/>"))
    pages = o.groupBy("o_custkey", "base").agg(F.concat(F.lit("<html>[To Parent]<br>"), F.array_join(F.collect_list(line), "\n")).alias("html"))
    return V.list_links(pages.withColumnRenamed("o_custkey", "page"), "page", "html", "base")


@query("""
WITH v AS (SELECT page_id, unnest(regexp_extract_all(html, '([0-9]+\\.[0-9]+)', 1)) AS version FROM pages),
s AS (SELECT page_id, regexp_replace(string_split(version, '.')[1], '^0+(.)', '\\1') AS a, regexp_replace(string_split(version, '.')[2], '^0+(.)', '\\1') AS b FROM v),
k AS (SELECT page_id, CASE WHEN b = '0' THEN [{'n': length(a), 'd': a}] ELSE [{'n': length(a), 'd': a}, {'n': length(b), 'd': b}] END AS n FROM s)
SELECT page_id, array_to_string(list_transform(max(n), lambda x: x.d), '.') AS newest FROM k JOIN pages USING (page_id) GROUP BY page_id, url
HAVING url NOT LIKE 'https:%' OR max(n) > [{'n': 2, 'd': '50'}]""")
def newest_version(spark, sf):
    pages = _t(spark, sf, "pages")
    held = pages.where(F.startswith("url", F.lit("https:"))).select("page_id", F.explode(F.array(F.lit("9.9"), F.lit("50.0"))).alias("version"))
    v = V.newer_versions(pages, held, "page_id", "html", r"([0-9]+\.[0-9]+)")[0]
    return v.select("page_id", F.array_join(X.parse_version("newest")["digits"], ".").alias("newest"))


_FILES = """
f AS (SELECT DISTINCT o_orderstatus AS source, CAST(o_orderdate AS DATE) AS effective, o_orderpriority[1:1] AS title FROM orders),
days AS (SELECT DISTINCT o_orderstatus AS source, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ask AS (SELECT source, day, title FROM days, (SELECT unnest(['1', '2', '3', '4', '5']) AS title) AS t)"""


def _listing(spark, sf):
    """Order dates as release folders of the order's status, each with a file (or a zip of many) for each priority."""
    o = _t(spark, sf, "orders").select(F.col("o_orderstatus").alias("source"), F.to_date("o_orderdate").alias("effective"), F.substring("o_orderpriority", 1, 1).alias("title"), "o_custkey")
    folder = F.date_format("effective", "yyyy-MM-dd")
    name = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("Pack-"), "title", F.lit(".ZIP"))).otherwise(F.concat(F.lit("file-"), "title", F.lit(".txt")))
    folders, files = o.select("source", folder.alias("folder"), "effective").distinct(), o.select("source", folder.alias("folder"), name.alias("name")).distinct()
    titles = o.select("source").distinct().select("source", F.explode(F.array(*[F.lit(str(k)) for k in range(1, 6)])).alias("title"))
    patterns = titles.select("source", "title", F.concat(F.lit(r"^FILE-"), "title", F.lit(r"\.txt$")).alias("pattern"), F.concat(F.lit("^pack-"), "title").alias("archive"))
    ship = _t(spark, sf, "lineitem").join(_t(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey"))
    return folders, files, patterns, ship.select(F.col("o_orderstatus").alias("source"), F.to_date("l_shipdate").alias("day")).distinct()


@query(f"""
WITH {_FILES.strip()}
SELECT a.source, a.day, a.title, f.effective, strftime(f.effective, '%Y-%m-%d') AS folder
FROM ask a ASOF JOIN f ON a.source = f.source AND a.title = f.title AND a.day >= f.effective""")
def newest_in_effect(spark, sf):
    return R.newest_in_effect(*_listing(spark, sf))[0]


@query(f"""
WITH {_FILES.strip()},
r AS (SELECT a.source, a.day, max(f.effective) AS label FROM ask a ASOF JOIN f ON a.source = f.source AND a.title = f.title AND a.day >= f.effective GROUP BY a.source, a.day)
SELECT source, day, strftime(label, '%Y-%m-%d') AS label FROM r""")
def listing_labels(spark, sf):
    """A listing's label on each day: the newest date of the folders used."""
    return S.listing_label(R.newest_in_effect(*_listing(spark, sf))[0])


@query("""
WITH m AS (SELECT DISTINCT c_nationkey AS source, strftime(o_orderdate, '%Y-%m') AS month FROM orders JOIN customer ON o_custkey = c_custkey),
h AS (SELECT source, max(month) AS month FROM m WHERE month <= '1995-12' GROUP BY source),
n AS (SELECT m.source, m.month FROM m JOIN h ON m.source = h.source AND m.month = strftime(CAST(h.month || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m')),
l AS (SELECT source, max(month) AS month FROM m WHERE month IN ('1996-04', '1996-05', '1996-06') GROUP BY source)
SELECT coalesce(n.source, l.source) AS source, coalesce(n.month, l.month) AS month FROM n FULL JOIN l ON n.source = l.source""")
def newest_month(spark, sf):
    m = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.expr("o_custkey = c_custkey")).select(F.col("c_nationkey").alias("source"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    return R.newest_month(m.where("month <= '1995-12'"), m, "1996-06")


@query("SELECT user_id AS source, arg_max(event_type, (ts, -event_id)) AS found FROM events GROUP BY user_id")
def latest_check(spark, sf):
    e = _t(spark, sf, "events").select(F.col("user_id").alias("source"), F.col("ts").alias("at"), F.col("event_type").alias("found"), F.col("event_id").alias("n"))
    return S.latest_check(e).select("source", "found")


@query("SELECT source AS title, array_to_string(list_sort(list(DISTINCT md5(coalesce(text, '')))), '|') AS checksums, CAST(max(n_chars) AS BIGINT) AS modified FROM documents GROUP BY source")
def inputs_held(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("source").alias("title"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("checksum"), F.col("n_chars").alias("modified"))
    return S.inputs_held(d).select("title", F.array_join("checksums", "|").alias("checksums"), "modified")


@query("""
WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS title, CASE WHEN o_orderpriority <> '5-LOW' THEN md5(CAST(o_totalprice AS VARCHAR)) END AS checksum, o_orderdate AS modified, o_orderstatus AS s FROM orders),
seen AS (SELECT * FROM f WHERE s <> 'F'), recorded AS (SELECT * FROM f WHERE s <> 'O')
SELECT DISTINCT title FROM seen WHERE
  CASE WHEN checksum IS NOT NULL THEN NOT EXISTS (SELECT 1 FROM recorded r WHERE r.title = seen.title AND r.checksum = seen.checksum)
       ELSE NOT EXISTS (SELECT 1 FROM recorded r WHERE r.title = seen.title AND r.modified = seen.modified) END""")
def changed_inputs(spark, sf):
    """Files of customers: seen are those of orders that are not filled, recorded those of orders that are not open."""
    total = F.md5(F.col("o_totalprice").cast("string").cast("binary"))
    f = _t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("title"), F.when(F.col("o_orderpriority") != "5-LOW", total).alias("checksum"), F.col("o_orderdate").alias("modified"), F.col("o_orderstatus").alias("s"))
    return V.changed_inputs(f.where("s <> 'F'").drop("s"), f.where("s <> 'O'").drop("s"))


def _suppliers(spark, sf):
    s = _t(spark, sf, "supplier").withColumns({"iri": X.code_iri(SUPP, F.col("s_suppkey").cast("string")), "code": F.col("s_suppkey").cast("string")})
    return names_rows(s, "names", "iri", "s_name", F.lit(None), "code")


@query(f"""
SELECT '{SUPP}' || s_suppkey AS key, p AS predicate, v AS object FROM supplier,
  LATERAL (VALUES ('http://www.w3.org/2004/02/skos/core#prefLabel', s_name), ('http://www.w3.org/2004/02/skos/core#notation', CAST(s_suppkey AS VARCHAR))) AS x(p, v)""")
def triples(spark, sf):
    return to_triples(_suppliers(spark, sf)).select("key", "predicate", "object")


@query(f"SELECT '{SUPP}' || s_suppkey AS key, 'names' AS form, s_name AS pref_label, CAST(s_suppkey AS VARCHAR) AS notation FROM supplier")
def rows_from_triples(spark, sf):
    return from_triples(to_triples(_suppliers(spark, sf))).select("key", "form", F.col("prefLabel").alias("pref_label"), "notation")


@query(f"""
SELECT '{CUST}' || CASE WHEN c_custkey % 4 = 0 THEN '<' ELSE '' END || c_custkey AS key, 'subject is no address' AS message FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT '{CUST}' || CASE WHEN c_custkey % 4 = 0 THEN '<' ELSE '' END || c_custkey, 'prefLabel is empty' FROM customer WHERE c_nationkey = 3""")
def schema_violations(spark, sf):
    c = _t(spark, sf, "customer").withColumns({
        "iri": F.concat(F.lit(CUST), F.when(F.col("c_custkey") % 4 == 0, "<").otherwise(""), F.col("c_custkey").cast("string")),
        "name": F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_name")),
        "code": F.col("c_custkey").cast("string"),
    })
    return Q.check_row_schema(names_rows(c, "names", "iri", "name", F.lit(None), "code")).select("key", "message")


@query(f"SELECT '{PART}' || p_partkey AS key, 'termType is none of SMALL' AS message FROM part WHERE p_size > 20")
def constraint_violations(spark, sf):
    p = _t(spark, sf, "part").withColumns({"iri": X.code_iri(PART, F.col("p_partkey").cast("string")), "kind": F.when(F.col("p_size") > 20, "LARGE").otherwise("SMALL")})
    return Q.check_constraints(term_type_rows(p, "types", "iri", "kind"), term_types=["SMALL"]).select("key", "message")


@query("SELECT CAST(p_name AS VARCHAR) AS key, 'is on ' || min(p_partkey) || ' and ' || max(p_partkey) AS message FROM part GROUP BY p_name HAVING min(p_partkey) <> max(p_partkey)")
def unique_values(spark, sf):
    return S.unique_across_rows(_t(spark, sf, "part"), "p_name", "p_partkey")


@query("""
WITH c AS (SELECT *, CAST(c_custkey AS VARCHAR) AS k, replace(c_name, '#', chr(92) || '#') AS name, c_mktsegment <> 'BUILDING' AS was, c_acctbal >= 0 OR c_mktsegment = 'MACHINERY' AS now FROM customer),
d AS (SELECT *, CASE WHEN now AND NOT was THEN 'added' WHEN was AND NOT now THEN 'removed' ELSE 'changed' END AS change FROM c WHERE was OR now),
l AS (
  SELECT 'names' AS series, change, c_custkey AS o, '`' || k || '`: ' || name || CASE WHEN c_nationkey = 3 AND change <> 'removed' THEN ' ' || chr(92) || '<new' || chr(92) || '>' ELSE '' END ||
    CASE WHEN change = 'changed' THEN ', also called ' || c_mktsegment || ' (was `' || k || '`: ' || name || ', also called ' || c_mktsegment || ')' ELSE '' END AS line
  FROM d WHERE change <> 'changed' OR c_nationkey = 3
  UNION ALL
  SELECT 'nations', change, c_custkey, '`' || k || '` → `' || c_nationkey || '` (RO_0002350' || CASE WHEN change = 'changed' THEN ', justified by LexicalMatching) (was `' || k || '` → `' || c_nationkey || '` (RO_0002350, justified by ManualMappingCuration))' ELSE ')' END
  FROM d WHERE change <> 'changed' OR c_acctbal > 5000)
SELECT series, change, line, row_number() OVER (PARTITION BY series, change ORDER BY o) AS rank FROM l""")
def describe_changes(spark, sf):
    """Customers of one segment came, others in debt left; those of a nation have a new name, rich ones another reason."""
    c = _t(spark, sf, "customer").withColumns({"iri": X.code_iri(CUST, F.col("c_custkey").cast("string")), "code": F.col("c_custkey").cast("string"), "other": F.array("c_mktsegment")})
    c = c.withColumn("nation", X.code_iri("https://example.org/nation/", F.col("c_nationkey").cast("string")))

    def release(df, new: bool):
        df = df.withColumn("name", F.when((F.col("c_nationkey") == 3) & F.lit(new), F.concat("c_name", F.lit(" <new>"))).otherwise(F.col("c_name")))
        why = F.when((F.col("c_acctbal") > 5000) & F.lit(new), "https://w3id.org/semapv/vocab/LexicalMatching").otherwise(CURATED)
        return names_rows(df, "names", "iri", "name", "other", "code").unionByName(mapping_rows(df.withColumn("why", why), "nations", "iri", MEMBER_OF, "nation", "why"))

    before, after = release(c.where("c_mktsegment <> 'BUILDING'"), False), release(c.where("c_acctbal >= 0 or c_mktsegment = 'MACHINERY'"), True)
    lines = V.describe_changes(V.diff(V.with_content(before), V.with_content(after)), before, after)
    return running(lines, ["series", "change"], ["order"]).select("series", "change", "line", "rank")


_BUDGET = """
WITH l AS (SELECT p_brand, p_name, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rank,
  sum(length(p_name) + 3) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS used FROM part)"""


@query(f"{_BUDGET} SELECT p_brand, p_partkey, rank FROM l WHERE used <= 200")
def budget_lines(spark, sf):
    p = _t(spark, sf, "part").select("p_brand", "p_partkey", "p_name")
    return S.budget_lines(p, "p_brand", "p_partkey", "p_name", 200)[0].select("p_brand", "p_partkey", "rank")


@query(f"{_BUDGET} SELECT p_brand, count(*) FILTER (used > 200) AS more FROM l GROUP BY p_brand")
def budget_more(spark, sf):
    p = _t(spark, sf, "part").select("p_brand", "p_partkey", "p_name")
    return S.budget_lines(p, "p_brand", "p_partkey", "p_name", 200)[1]


@query("""
SELECT event_id, row_number() OVER w AS rank, CAST(sum(user_id) OVER w AS BIGINT) AS running, last_value(CASE WHEN user_id % 5 = 0 THEN event_id END IGNORE NULLS) OVER w AS last_fifth
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_sums(spark, sf):
    """Numbers, sums and last values along the few, long lists of events of a type."""
    e = _t(spark, sf, "events").select("event_id", "event_type", "user_id").withColumn("fifth", F.when(F.col("user_id") % 5 == 0, F.col("event_id")))
    return running(e, ["event_type"], ["event_id"], "user_id", ["fifth"]).select("event_id", "rank", "running", "last_fifth")


@query("""
WITH h AS (SELECT sha256(l_orderkey || '|' || l_linenumber || '|' || l_returnflag) AS h FROM lineitem)
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST('0x' || h[1:15] AS BIGINT)) AS VARCHAR) AS f1, CAST(sum(CAST('0x' || h[17:31] AS BIGINT)) AS VARCHAR) AS f2 FROM h""")
def content_fingerprint(spark, sf):
    h = _t(spark, sf, "lineitem").select(F.sha2(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_returnflag"), 256).alias("content"))
    return V.content_fingerprint(h).select("n", F.col("f1").cast("string").alias("f1"), F.col("f2").cast("string").alias("f2"))


_SERIES = "urn:uuid:00000000-0000-4000-8000-000000000000"


@query(f"""
WITH l AS (SELECT DISTINCT '<{SUPP}' || s_suppkey || '> <http://www.w3.org/2004/02/skos/core#' || p || '> "' || v || '" .' AS line
  FROM supplier, LATERAL (VALUES ('prefLabel', s_name), ('notation', CAST(s_suppkey AS VARCHAR))) AS x(p, v)
  UNION ALL SELECT '<{V.THIS_VERSION}> <http://www.w3.org/ns/prov#specializationOf> <{_SERIES}> .')
SELECT 'ni:///sha-256;' || rtrim(translate(base64(unhex(sha256(string_agg(line, chr(10) ORDER BY line) || chr(10)))), '+/', '-_'), '=') AS name FROM l""")
def version_name(spark, sf):
    rows = _suppliers(spark, sf).withColumn("series", F.lit(_SERIES))
    return spark.createDataFrame([(V.version_name(rows, _SERIES),)], "name string")


@query("""
WITH s AS (SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS z FROM part)
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, regexp_replace(p_name, '([\\\\`*_{}\\[\\]()#+.!|<>-])', '\\\\\\1', 'g') AS label FROM s""")
def markdown_labels(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", X.escape_markdown("p_name").alias("label"))


@query("""
SELECT o_orderkey, CASE WHEN month(o_orderdate) = 12 THEN (year(o_orderdate) + 1) || '-01' ELSE year(o_orderdate) || '-' || lpad(CAST(month(o_orderdate) + 1 AS VARCHAR), 2, '0') END AS month FROM orders""")
def months_after(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", X.month_after(F.date_format("o_orderdate", "yyyy-MM")).alias("month"))


@query("SELECT event_id, CASE WHEN length(p) > 3 THEN p[1:3] || '.' || p[4:] ELSE p END AS code FROM (SELECT event_id, upper(event_type) AS p FROM events)")
def dotted_codes(spark, sf):
    return _t(spark, sf, "events").select("event_id", X.dotted(F.upper("event_type")).alias("code"))


@query("""
SELECT p_name, CAST(count(*) AS BIGINT) AS n FROM part WHERE list_has_any(string_split(p_name, ' '), (SELECT list(w) FROM (SELECT string_split(min(p_name), ' ')[1] AS w FROM part))) GROUP BY p_name""")
def filter_any_of(spark, sf):
    part = _t(spark, sf, "part")
    wanted = part.agg(F.split(F.min("p_name"), " ").alias("w")).first()["w"][:1]
    return R.filter_any_of(part, "p_name", wanted, " ").groupBy("p_name").agg(F.count("*").alias("n"))


@query("""
SELECT c_custkey, coalesce(array_to_string(list_sort(list(DISTINCT o_orderkey)), '|'), '') AS replaced_by FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def collect_replacements(spark, sf):
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return S.collect_replacements(c, o, "c_custkey", "o_orderkey").select("c_custkey", F.array_join(F.transform("replaced_by", lambda x: x.cast("string")), "|").alias("replaced_by"))


@query("""
SELECT 'https://example.org/n' || c_nationkey || '/' || c_custkey AS iri, n_name AS system FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey IN (1, 2)""")
def system_of(spark, sf):
    _, _, registry = _customers(spark, sf)
    c = _t(spark, sf, "customer").select(F.concat(F.lit("https://example.org/n"), "c_nationkey", F.lit("/"), F.col("c_custkey").cast("string")).alias("iri"))
    return R.system_of(c, "iri", registry)


@query(f"""
WITH p AS (SELECT '{PART}' || url_encode(p_name) AS key, * FROM part), skos AS (SELECT 'http://www.w3.org/2004/02/skos/core#' AS s)
SELECT key, '<' || key || '> <' || s || 'prefLabel> "' || p_name || '" .' AS line FROM p, skos
UNION ALL SELECT key, '<' || key || '> <' || s || 'notation> "' || p_partkey || '" .' FROM p, skos
UNION ALL SELECT key, '<' || key || '> <' || s || 'altLabel> "' || o || '" .' FROM (SELECT key, p_name, unnest(list_distinct([p_brand, p_type])) AS o FROM p), skos WHERE o <> p_name""")
def nquad_lines(spark, sf):
    return _named_parts(spark, sf).select("key", F.explode(row_lines()).alias("line"))


@query("SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name < 'B'")
def licence_gate(spark, sf):
    rows = _t(spark, sf, "supplier").withColumnRenamed("s_nationkey", "source")
    sources = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("source"), F.col("n_regionkey").alias("licence"))
    licences = _t(spark, sf, "region").select(F.col("r_regionkey").alias("licence"), (F.col("r_name") < "B").alias("publishes"))
    return R.licence_gate(rows, sources, licences).select("s_suppkey")


@query("SELECT CAST(c_custkey AS VARCHAR) AS iri FROM customer WHERE c_nationkey = 1 OR c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def active_series(spark, sf):
    series = _t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("iri"), F.when(F.col("c_nationkey") != 1, F.col("c_nationkey")).alias("kind"))
    return R.active_series(series, _t(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("kind"))).select("iri")


@query(f"SELECT DISTINCT '{PART}' || l_partkey AS code FROM lineitem UNION SELECT DISTINCT '{SUPP}' || l_suppkey FROM lineitem")
def codes_named(spark, sf):
    from codetables.operators.carry import codes_named as named

    return named(_supplies(spark, sf))


_LINKS = """
WITH v AS (SELECT o_orderkey AS k, o_custkey AS s, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS revises FROM orders),
c AS (SELECT s, max(k) AS k FROM v GROUP BY s)
"""


@query(_LINKS + """
SELECT c.s AS series, c.k AS version, 'current' AS role FROM c
UNION ALL SELECT c.s, v.revises, 'previous' FROM c JOIN v ON v.k = c.k WHERE v.revises IS NOT NULL""")
def current_and_previous(spark, sf):
    return S.current_and_previous(*_order_versions(spark, sf))


def _order_versions(spark, sf):
    from pyspark.sql.window import Window

    o = _t(spark, sf, "orders")
    versions = o.select(F.col("o_orderkey").alias("iri"), F.col("o_custkey").alias("series"), F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("revises"))
    return o.groupBy(F.col("o_custkey").alias("iri")).agg(F.max("o_orderkey").alias("current_version")), versions


@query(_LINKS + """, w AS (SELECT c.s, c.k FROM c UNION SELECT c.s, v.revises FROM c JOIN v ON v.k = c.k WHERE v.revises IS NOT NULL)
SELECT DISTINCT w.s AS series, w.k AS version FROM w JOIN lineitem ON l_orderkey = w.k WHERE w.k % 17 = 0""")
def verify_versions(spark, sf):
    series, versions = _order_versions(spark, sf)
    line = _t(spark, sf, "lineitem").join(_t(spark, sf, "orders").select(F.col("o_orderkey").alias("version"), F.col("o_custkey").alias("series")), F.expr("l_orderkey = version"))
    rows = line.select("series", "version", F.sha2(F.concat_ws("|", "l_partkey", "l_linenumber"), 256).alias("content"))
    # The record was made of these rows, but for the versions of every 17th order.
    said = rows.where("version % 17 <> 0").union(rows.where("version % 17 = 0").withColumn("content", F.sha2("content", 256)))
    recorded = V.content_fingerprint(said, by=["version"]).withColumnRenamed("version", "iri")
    return V.verify_versions(series, versions.join(recorded, "iri", "left"), rows).select("series", "version")


@query("SELECT source, strftime(max(TIMESTAMP '2026-01-01' + INTERVAL 1 HOUR * n_chars), '%Y-%m-%d') AS label FROM documents GROUP BY source")
def release_label(spark, sf):
    d = _t(spark, sf, "documents").select("source", F.expr("timestamp_ntz'2026-01-01' + make_dt_interval(0, n_chars)").alias("modified"))
    return S.release_label(d)


@query("""
WITH n AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'O' AND o_totalprice > 50000) AS n FROM orders GROUP BY o_custkey)
SELECT CAST(o_custkey AS VARCHAR) AS key, 'marks ' || n || ' entries as current' AS message FROM n WHERE n <> 1""")
def exactly_one_current(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("list"), (F.col("o_orderstatus") == "O").alias("current"), (F.col("o_totalprice") > 50000).alias("complete"))
    return S.exactly_one_current(o)


@query("""
WITH a AS (SELECT DISTINCT p_brand AS code FROM part WHERE p_size > 5), n AS (SELECT a.code, min(p_type) AS name, max(p_type) AS other FROM a LEFT JOIN part ON p_brand = code AND p_size > 48 GROUP BY a.code)
SELECT code AS key, CASE WHEN name IS NULL THEN 'has no name' ELSE 'has two names' END AS message FROM n WHERE name IS NULL OR name <> other""")
def names_for_used(spark, sf):
    p = _t(spark, sf, "part")
    return R.names_for_used(p.where("p_size > 5").select(F.col("p_brand").alias("code")), p.where("p_size > 48").select(F.col("p_brand").alias("code"), F.col("p_type").alias("name")))[1]


@query("""
WITH a AS (SELECT DISTINCT CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE l_partkey END AS drug, CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE l_suppkey END AS class, l_returnflag AS relation FROM lineitem WHERE l_returnflag IN ('R', 'A'))
SELECT * FROM a""")
def class_assignments(spark, sf):
    line = _t(spark, sf, "lineitem")
    assoc = line.select(F.col("l_returnflag").alias("relation"), F.col("l_partkey").alias("from_code"), F.lit("x").alias("from_name"), F.col("l_suppkey").alias("to_code"), F.lit("y").alias("to_name"))
    rules = line.select("l_returnflag").distinct().where("l_returnflag in ('R', 'A')").select(F.col("l_returnflag").alias("relation"), (F.col("l_returnflag") == "R").alias("reversed"), F.lit(None).cast("string").alias("suffix"))
    return R.class_assignments(assoc, rules)[0].select("drug", "class", "relation")


@query("""
SELECT CAST(event_id AS VARCHAR) AS iri, url_encode(event_type || ' ' || props) AS code FROM events""")
def encoded_codes(spark, sf):
    e = _t(spark, sf, "events")
    return e.select(F.col("event_id").cast("string").alias("iri"), X.encode_for_uri(F.concat_ws(" ", "event_type", "props")).alias("code"))


@query("SELECT event_id, event_type || ' ' || props AS code FROM events")
def decoded_codes(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", X.code_of(PART, X.code_iri(PART, F.concat_ws(" ", "event_type", "props"))).alias("code"))


@query("""
WITH s AS (SELECT l_orderkey AS k, l_partkey AS v FROM lineitem UNION SELECT o_orderkey, o_custkey FROM orders),
b AS (SELECT v FROM s GROUP BY v HAVING count(DISTINCT k) > 60)
SELECT k, array_to_string(list_sort(list(DISTINCT v)), '|') AS vals FROM s WHERE v NOT IN (SELECT v FROM b) GROUP BY k""")
def set_expressions(spark, sf):
    a = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v"))
    b = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    busy = a.union(b).distinct().groupBy("v").agg(F.count("*").alias("n")).where("n > 60")
    return S.set_expressions([a, b], "k", "v", busy).select("k", F.array_join(F.transform("values", lambda x: x.cast("string")), "|").alias("vals"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, 'is no version name' AS message FROM orders WHERE o_orderkey % 10 = 0")
def catalog_checks(spark, sf):
    series, versions = _order_versions(spark, sf)
    name = lambda c: F.concat(F.lit("ni:///sha-256;"), F.substring(F.sha2(F.col(c).cast("string"), 256), 1, 43))
    v = versions.select(F.when(F.col("iri") % 10 != 0, name("iri")).otherwise(F.col("iri").cast("string")).alias("iri"), F.concat(F.lit("urn:uuid:"), F.col("series").cast("string")).alias("series"), F.when(F.col("revises") % 10 != 0, name("revises")).otherwise(F.col("revises").cast("string")).alias("revises"), F.lit("x").alias("label"), F.lit("2026").alias("issued"))
    s = series.select(F.concat(F.lit("urn:uuid:"), F.col("iri").cast("string")).alias("iri"), F.lit("x").alias("label"), F.when(F.col("current_version") % 10 != 0, name("current_version")).otherwise(F.col("current_version").cast("string")).alias("current_version"))
    i = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("iri"), F.sha2("text", 256).alias("checksum"), F.col("source").alias("title"))
    return Q.check_catalog(s, v, i, i.select(F.lit("v").alias("version"), F.col("iri").alias("input"))).select("key", "message")


# ---- declarations, checks and release files


@query("""
WITH s AS (SELECT 'c' || c_custkey AS source, c_nationkey AS licence, c_acctbal < 0 AS two, c_nationkey = 5 AS lookup FROM customer),
k AS (SELECT 'c' || o_custkey AS source, 'o' || o_orderkey AS iri, o_orderstatus = 'P' AS unlabelled, o_orderpriority = '1-URGENT' AS unkind, o_orderpriority = '5-LOW' AS status, o_orderstatus = 'O' AS carries FROM orders),
n AS (SELECT source, count(*) FILTER (status) AS st, count(*) FILTER (carries) AS ca FROM k GROUP BY source)
SELECT source AS key, 'has no licence that publishes' AS message FROM s WHERE licence NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)
UNION ALL SELECT source, 'has not one detection method' FROM s WHERE two
UNION ALL SELECT iri, 'has no label' FROM k WHERE unlabelled
UNION ALL SELECT iri, 'has no kind' FROM k WHERE unkind
UNION ALL SELECT iri, 'is a status series that carries' FROM k WHERE status AND carries
UNION ALL SELECT s.source, 'looks up a history without one status and one carrying series' FROM s LEFT JOIN n ON s.source = n.source WHERE lookup AND (st IS NULL OR st <> 1 OR ca = 0)""")
def source_checks(spark, sf):
    """Customers as sources under their nations' licences, and their orders as series: every rule is broken by some."""
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    methods = F.when(F.col("c_acctbal") < 0, F.array(F.lit("api"), F.lit("page"))).otherwise(F.array(F.lit("api")))
    sources = c.select(F.concat(F.lit("c"), "c_custkey").alias("source"), F.col("c_nationkey").alias("licence"), methods.alias("methods"), (F.col("c_nationkey") == 5).alias("history_lookup"))
    kind = F.when(F.col("o_orderpriority") == "5-LOW", "x#RetiredCodes").when(F.col("o_orderpriority") != "1-URGENT", "x#CodeNames")
    series = o.select(F.concat(F.lit("c"), "o_custkey").alias("source"), F.concat(F.lit("o"), "o_orderkey").alias("iri"), F.when(F.col("o_orderstatus") != "P", "x").alias("label"), kind.alias("kind"), (F.col("o_orderstatus") == "O").alias("carries"))
    licences = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("licence"), (F.col("n_regionkey") < 3).alias("publishes"))
    return Q.check_sources(sources, series, licences).select("key", "message")


@query("""
WITH e AS (SELECT event_type AS key, user_id % 3 = 0 AS unseen, user_id % 5 = 0 AS reason, user_id % 7 = 0 AS short FROM events)
SELECT key, 'has a reason or lacks one' AS message, count(*) AS n FROM e WHERE unseen <> reason GROUP BY key
UNION ALL SELECT key, 'is no source name', count(*) FROM e WHERE NOT regexp_full_match(key, '[a-z0-9-]+') GROUP BY key
UNION ALL SELECT key, 'has a checksum of another form', count(*) FROM e WHERE short GROUP BY key""")
def check_checks(spark, sf):
    e = _t(spark, sf, "events")
    u = F.col("user_id")
    digest = F.when(u % 7 == 0, F.md5(F.col("props").cast("binary"))).otherwise(F.sha2("props", 256))
    found = F.when(u % 3 == 0, "not checked").otherwise("nothing new")
    checks = e.select(F.col("event_type").alias("source"), found.alias("found"), F.when(u % 5 == 0, "x").alias("reason"), F.col("ts").alias("at"), F.array(F.struct(digest.alias("checksum"))).alias("inputs"))
    return Q.check_checks(checks).groupBy("key", "message").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT p_type AS series, 'is not declared by the source' AS message FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_retailprice > 999.7)")
def undeclared_series(spark, sf):
    p = _t(spark, sf, "part")
    return Q.declared_series_only(p.withColumnRenamed("p_type", "series"), p.where("p_retailprice > 999.7").select(F.col("p_type").alias("iri")).distinct()).select("series", "message")


@query(r"""
WITH f AS (SELECT DISTINCT 'FILE-' || c_nationkey || CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey > 20 THEN 'b' ELSE '' END || '.txt' AS name FROM customer WHERE c_nationkey <> 4),
m AS (SELECT n_name AS title, count(name) AS n, min(name) AS name FROM nation LEFT JOIN f ON regexp_matches(name, '(?i)^file-' || n_nationkey || 'b?\.txt$') GROUP BY n_name)
SELECT title, CASE WHEN n = 1 THEN name WHEN n = 0 THEN 'no file matches' ELSE 'several files match' END AS said FROM m""")
def release_files(spark, sf):
    """The one file for each nation among those that customers name; of some nations there are none or two."""
    c = _t(spark, sf, "customer").where("c_nationkey <> 4")
    more = F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") > 20), "b").otherwise("")
    files = c.select(F.concat(F.lit("FILE-"), "c_nationkey", more, F.lit(".txt")).alias("name")).distinct()
    patterns = _t(spark, sf, "nation").select(F.col("n_name").alias("title"), F.concat(F.lit("^file-"), "n_nationkey", F.lit(r"b?\.txt$")).alias("pattern"))
    found, wrong = pick_release_files(files, patterns)
    return found.withColumnRenamed("name", "said").unionByName(wrong.withColumnRenamed("message", "said"))
