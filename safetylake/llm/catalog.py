"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, byte_bpe, chat, decontaminate, embeddings, line_dedup, lm, merkle, quality, repair, simhash, toxicity, warc
from .common import read, staged
from safetylake.session import scratch_path


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", marked), (-7, 1, "assistant", marked)], turns.schema)
    return chat.report(chat.windows(turns.union(own)))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.decontaminate(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    records = staged(warc.read(spark, path, blocks=False), "warc-records")
    return warc.report(warc.assemble(records))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("_uid")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(line_dedup.dedup_lines(read(spark, sf_dir, "documents"), short=True))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"), quality.held_out("id", 1))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(merkle.manifest(merkle.leaves(read(spark, sf_dir, "documents"))))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    turns = repair.damage(conversations)
    return repair.report(turns, repair.repairs(turns, conversations))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc": op3_warc,
    "op4_bpe": op4_bpe,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_lm": op8_lm,
    "op9_embeddings": op9_embeddings,
    "op10_toxicity": op10_toxicity,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_merkle": op12_merkle,
    "op13_repair": op13_repair,
}

ORACLES: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op12_merkle": merkle.ORACLE,
}
