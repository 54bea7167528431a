"""A training corpus from raw documents: quality rules, line deduplication, near duplicates, secrets, packing.

Each stage takes the documents that its predecessor kept, as written Parquet, and returns documents (the last one the
places of their token pieces in sequences). Stages don't fail on null columns, empty tables or extra columns: see the
operators' own notes. n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm import line_dedup, minhash, packing, quality_rules, secrets
from codetables.llm.common import staged, table


def _like(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, with n_chars of the present text."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects."""
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    return _like(line_dedup.drop_shared_lines(docs, min_docs=10), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near duplicates (five words, similarity 0.8)."""
    found = minhash.near_duplicates(docs, k=5, least_percent=80)
    return found.where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return _like(secrets.redact(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 tokens."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("pack", pack),
]

#: Learned rules, min-max hashing with components and the tokenizer can't be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
