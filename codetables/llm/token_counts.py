"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A change row adds or takes away documents and tokens of one (source, lang, tokenizer): an insert is +1 document and +n
tokens, a delete the negative, a revised count the difference. Counts are additive, so a batch is reduced to partial
totals in parallel, and the current totals are the sum of all committed batches; nothing is read back to be updated.

A store is a folder of such partial totals, one subfolder a batch. A batch is written to a folder of its own attempt and
renamed into place, so it is there whole or not at all; a batch whose id is there already changes nothing, whoever sends
it again. compact() folds committed batches into one, whose list of ids keeps them committed.

Defined results: a null source or language is a group of its own; null texts have no tokens. Rows are counted one by
one, so a repeated row counts again (batches are idempotent, rows are not). Groups whose documents and tokens are all
taken away stay with totals of 0. An empty batch commits and changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import SPACE, SPACE_CHARS, shared_root, staged, table

KEYS = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def words_v1(text: Column) -> Column:
    """Tokens of version words-1: runs of other characters than white space."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE, -1))).cast("long")


def parts_v2(text: Column) -> Column:
    """Tokens of version parts-2: each run of letters and other characters, each digit, each punctuation mark."""
    marks = r"[!-/:-@\[-`{-~]"
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), rf"([0-9]|{marks})", " $1 ")
    return words_v1(spaced)


VERSIONS = {"words-1": words_v1, "parts-2": parts_v2}


def inserts(docs: DataFrame, version: str, text_col: str = "text") -> DataFrame:
    n = VERSIONS[version](F.col(text_col))
    return docs.select("source", "lang", F.lit(version).alias("tokenizer"), F.lit(1).cast("long").alias("n_docs"), n.alias("n_tokens"))


def deletes(docs: DataFrame, version: str, text_col: str = "text") -> DataFrame:
    return negated(inserts(docs, version, text_col))


def revisions(docs: DataFrame, version: str, old_col: str, new_col: str) -> DataFrame:
    """The same documents with new texts: no change of documents, the difference of tokens."""
    count = VERSIONS[version]
    return docs.select("source", "lang", F.lit(version).alias("tokenizer"), F.lit(0).cast("long").alias("n_docs"), (count(F.col(new_col)) - count(F.col(old_col))).alias("n_tokens"))


def negated(changes: DataFrame) -> DataFrame:
    return changes.withColumns({"n_docs": -F.col("n_docs"), "n_tokens": -F.col("n_tokens")})


def totals(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class Rollup:
    """A store of committed batches in a folder that all machines share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/batches"))

    def _place(self, batch: str) -> str:
        return f"{self.path}/batches/batch-{batch.encode().hex()}"

    def _names(self, folder: str, prefix: str) -> list[str]:
        return sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(folder))) if n.startswith(prefix))

    def _state(self) -> tuple[str | None, set[str], list[str]]:
        """The newest compacted folder, the ids that it holds, and the batches that are committed besides. Batches are
        listed before the base is looked for: one that compaction folds meanwhile is then in both, and counts once."""
        batches = [bytes.fromhex(n[6:]).decode() for n in self._names(f"{self.path}/batches", "batch-")]
        bases = self._names(self.path, "base-")
        if not bases:
            return None, set(), batches
        base = f"{self.path}/{bases[-1]}"
        ids = set(json.loads(self.spark.read.text(f"{base}/ids").first()[0]))
        return base, ids, [b for b in batches if b not in ids]

    def committed(self) -> set[str]:
        _, ids, batches = self._state()
        return ids | set(batches)

    def _renamed(self, attempt: str, place: str) -> bool:
        """Renames a folder into place unless one is there. Some file systems move it into that one instead; it is then
        taken out again."""
        if self._fs.exists(self._path(place)):
            return False
        name = attempt.rsplit("/", 1)[1]
        done = bool(self._fs.rename(self._path(attempt), self._path(place)))
        if done and self._fs.exists(self._path(f"{place}/{name}")):
            self._fs.delete(self._path(f"{place}/{name}"), True)
            return False
        return done

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds the changes unless a batch of this id is there; tells whether it did."""
        if batch in self.committed():
            return False
        attempt = f"{self.path}/attempts/{uuid.uuid4().hex}"
        totals(changes).write.parquet(attempt)
        return self._renamed(attempt, self._place(batch))

    def _totals(self, base: str | None, batches: list[str]) -> DataFrame:
        places = [self._place(b) for b in batches] + ([f"{base}/totals"] if base else [])
        return totals(self.spark.read.schema(TOTALS).parquet(*places)) if places else self.spark.createDataFrame([], TOTALS)

    def current(self) -> DataFrame:
        base, _, batches = self._state()
        return self._totals(base, batches)

    def compact(self) -> None:
        """Folds the batches of one listing into one base; what it replaces is removed after it is in place. Batches
        committed meanwhile stay beside it. One compaction runs at a time: of two, one finds the other's base there and
        changes nothing."""
        base, ids, batches = self._state()
        generation = int(base.rsplit("-", 1)[1]) + 1 if base else 0
        attempt = f"{self.path}/attempts/{uuid.uuid4().hex}"
        self._totals(base, batches).write.parquet(f"{attempt}/totals")
        self.spark.createDataFrame([(json.dumps(sorted(ids | set(batches))),)], "ids string").coalesce(1).write.text(f"{attempt}/ids")
        if self._renamed(attempt, f"{self.path}/base-{generation:08d}"):
            for b in batches:
                self._fs.delete(self._path(self._place(b)), True)
            if base:
                self._fs.delete(self._path(base), True)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollup of all documents after five batches: all are loaded, those labelled as of low quality are withdrawn, all
    that stay are counted by a second tokenizer version, their counts in the first version are revised for texts without
    runs of symbols, and a batch is sent twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    low = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct()
    # One pass over the texts: the counts that the batches need.
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), r"[#*$%&|<>]+", " ")
    counts = staged(docs.select("doc_id", "source", "lang", words_v1(F.col("text")).alias("words"), words_v1(clean).alias("clean"), parts_v2(F.col("text")).alias("parts")), "token-counts")
    stays, goes = counts.join(low, "doc_id", "left_anti"), counts.join(low, "doc_id", "left_semi")

    def change(rows: DataFrame, version: str, n_docs: int, n_tokens: Column) -> DataFrame:
        return rows.select("source", "lang", F.lit(version).alias("tokenizer"), F.lit(n_docs).cast("long").alias("n_docs"), n_tokens.alias("n_tokens"))

    store = Rollup(spark, f"{shared_root(spark)}/codetables/rollup-{uuid.uuid4().hex}")
    store.commit("load", change(counts, "words-1", 1, F.col("words")))
    withdrawn = change(goes, "words-1", -1, -F.col("words"))
    store.commit("withdraw", withdrawn)
    store.commit("second-version", change(stays, "parts-2", 1, F.col("parts")))
    store.compact()
    store.commit("revise", change(stays, "words-1", 0, F.col("clean") - F.col("words")))
    store.commit("withdraw", withdrawn)
    return store.current()


ORACLE = r"""
WITH counted AS (
  SELECT source, lang, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS low,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
         len(list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '[#*$%&|<>]+', ' ', 'g'),
             '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS clean,
         len(list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '([0-9]|[!-/:-@\[-`{-~])', ' \1 ', 'g'),
             '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS parts
  FROM documents)
SELECT source, lang, 'words-1' AS tokenizer, CAST(count(*) FILTER (WHERE NOT low) AS BIGINT) AS n_docs,
       CAST(coalesce(sum(clean) FILTER (WHERE NOT low), 0) AS BIGINT) AS n_tokens
FROM counted GROUP BY ALL
UNION ALL
SELECT source, lang, 'parts-2', CAST(count(*) AS BIGINT), CAST(sum(parts) AS BIGINT)
FROM counted WHERE NOT low GROUP BY ALL
"""
