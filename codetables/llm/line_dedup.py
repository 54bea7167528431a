"""Drops lines that many documents share.

A line's key is the line without white space at its ends, A-Z in lower case. The keys of each document are made
distinct, counted over all documents with map-side partial counts, and the lines whose key reaches the threshold are
dropped; the others are put together again by their position. Only 16-byte hashes of keys are shuffled, never text.

Defined results: a null or empty text is one empty line. Each row is a document of its own, also if ids repeat or are
null. Columns of the input stay as they are, but for the text and the columns that this operator adds (n_lines,
n_dropped), which replace columns of the same name. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import SPACE_CHARS, staged, table, to_bytes

_STRIP = SPACE_CHARS.encode()
#: Shared keys that are broadcast at most (16 bytes each); more of them are joined instead.
MAX_BROADCAST_KEYS = 500_000


def _key(line: bytes, min_chars: int) -> bytes | None:
    """16-byte hash of the line's key; None if the key is too short to count. bytes.lower() changes A-Z alone."""
    key = line.strip(_STRIP).lower()
    if len(key) < min_chars or min_chars > 1 and len(key.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, text_col: str, min_chars: int) -> DataFrame:
    """One row (k1, k2) for each document and distinct key in it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            for text in batch.column(0).to_pylist():
                keys = {_key(line, min_chars) for line in to_bytes(text).split(b"\n")}
                keys.discard(None)
                found += keys
            halves = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["k1", "k2"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(emit, "k1 long, k2 long")


def shared_keys(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Keys (k1, k2) found in at least min_docs documents, with their number of documents n."""
    counts = line_keys(docs, text_col, min_chars).groupBy("k1", "k2").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_docs)


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """docs with its text replaced by the lines that stay, and n_lines (before dropping) and n_dropped."""
    spark = docs.sparkSession
    shared = staged(shared_keys(docs, text_col, min_docs, min_chars), "line-keys")
    few = shared.count() <= max_broadcast_keys
    if few:
        rows = shared.select("k1", "k2").toPandas()
        keys = np.ascontiguousarray(rows[["k1", "k2"]].to_numpy(dtype="<i8")).tobytes()
        held = spark.sparkContext.broadcast(frozenset(keys[i : i + 16] for i in range(0, len(keys), 16)))
    else:
        held = None

    def keep(text: str | None, drop) -> tuple[str, int, int]:
        lines = to_bytes(text).split(b"\n")
        kept = [line for line in lines if _key(line, min_chars) not in drop]
        return b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(kept)

    made = "text string, n_lines long, n_dropped long"
    if few:

        @F.pandas_udf(made)
        def reassembled(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([keep(t, held.value) for t in texts], columns=["text", "n_lines", "n_dropped"])

        out = docs.withColumn("_lines", reassembled(F.col(text_col)))
    else:
        # The same decision by joins: each document gets the shared keys that it holds.
        @F.pandas_udf("array<struct<k1:long,k2:long>>")
        def keys_of(texts: pd.Series) -> pd.Series:
            def one(text):
                keys = {_key(line, min_chars) for line in to_bytes(text).split(b"\n")} - {None}
                return [dict(zip(("k1", "k2"), np.frombuffer(k, "<i8").tolist())) for k in keys]

            return texts.map(one)

        def keys_joined(texts: pd.Series, hits: pd.Series) -> pd.DataFrame:
            rows = [keep(t, frozenset() if h is None else frozenset(map(bytes, h))) for t, h in zip(texts, hits)]
            return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

        reassembled = F.pandas_udf(keys_joined, made)
        holds = docs.select(F.col(id_col).alias("_id"), F.explode(keys_of(F.col(text_col))).alias("k"))
        packed = F.pandas_udf(lambda a, b: pd.Series([np.array(x, "<i8").tobytes() for x in zip(a, b)]), "binary")
        hits = (
            holds.select("_id", "k.k1", "k.k2")
            .distinct()
            .join(shared.select("k1", "k2"), ["k1", "k2"])
            .groupBy("_id")
            .agg(F.collect_list(packed("k1", "k2")).alias("_hits"))
        )
        out = docs.join(hits, docs[id_col].eqNullSafe(hits["_id"]), "left").drop("_id")
        out = out.withColumn("_lines", reassembled(F.col(text_col), F.col("_hits"))).drop("_hits")
    added = {text_col: F.col("_lines.text"), "n_lines": F.col("_lines.n_lines"), "n_dropped": F.col("_lines.n_dropped")}
    return out.withColumns(added).drop("_lines")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE k IN (SELECT k FROM shared)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE k NOT IN (SELECT k FROM shared)), ''))
         AS kept_sha256
FROM keyed GROUP BY doc_id
"""
