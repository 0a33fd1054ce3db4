"""A training-data pipeline over ``documents``: five stages, each on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)``, calls one operator of ``safetylake.llm``
and lets its decisions take effect. All but the last return the columns of
``documents``. ``run`` writes each stage's result as Parquet in the shared folder
and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake.llm import bpe, decontaminate, line_dedup, quality, simhash
from safetylake.llm.common import numbered_rows, read, staged


def _rows(docs: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Each row under a lasting number, whole inside ``row``, and what operators read of it. A column named
    as the number stays what it is."""
    rows = numbered_rows(docs, label)
    return rows, rows.select("_uid", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Every row is judged by its own text: null and empty texts have a score like
    any other, null and repeated ids are rows of their own, and repeated rows are
    kept or go together. No documents give no documents. Columns of any name stay.
    """
    rows, texts = _rows(docs, "quality-docs")
    rejected = staged(quality.classify(texts, read(spark, sf_dir, "labels"), uid_col="_uid").where("predicted = 0").select("_uid"), "rejected")
    return rows.join(rejected.hint("shuffle_hash"), "_uid", "left_anti").select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document whose lines all went stays with an empty text.

    Of equal or linked lines the first by document id stays, null ids first; a
    repeated row is a later occurrence of its lines. A null text stays null.
    Where a text changes, ``n_chars`` (if there is one) is counted anew. Columns of any name stay.
    """
    out = line_dedup.dedup_lines(docs, short=True)
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return out.select(*[F.when(F.col("n_dropped") > 0, changed[c]).otherwise(F.col("row")[c]).alias(c)
                        if c in changed else F.col("row")[c].alias(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id.

    Null and empty texts are alike and form a group; of repeated rows or equal ids
    one row stays; a null id only where all ids of a group are null. Columns of any name stay.
    """
    rows, texts = _rows(docs, "simhash-docs")
    kept = staged(simhash.near_duplicates(texts, uid_col="_uid").where("kept").select("_uid"), "kept")
    return rows.join(kept.hint("shuffle_hash"), "_uid", "left_semi").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go.

    Null and empty texts hold none and stay; every row is judged by its own text,
    whatever its id. No benchmark items leave all documents. Columns of any name stay.
    """
    rows, texts = _rows(docs, "decon-docs")
    found = decontaminate.decontaminate(texts, read(spark, sf_dir, "benchmark"), uid_col="_uid")
    leaked = staged(found.where(F.size("hit") > 0).select("_uid"), "leaked")
    return rows.join(leaked.hint("shuffle_hash"), "_uid", "left_anti").select("row.*")


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text decoded from them.

    One row a document, repeated rows and null ids included; null and empty texts have no tokens.
    """
    return bpe.round_trip(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("lines", dedup_lines),
    ("near_duplicates", dedup_documents),
    ("decontamination", decontaminated),
    ("tokens", tokenized),
]

#: SimHash, the classifier and the tokenizer cannot be stated in SQL; tests/llm/test_corpus_pipeline.py
#: compares the rows with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
