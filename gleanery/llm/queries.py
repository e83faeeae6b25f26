"""The registered queries of the llm operators, and SQL where it can express them.

Without SQL: op2 (iterations), op3 (byte-level BPE), op4 (XXH64 and reachability),
op5 and op6 (trained models), op8 (a tokenizer's ids), op9 (spans by overlapping
patterns), op12 (cheapest edits) and op13 (every string of 100 bytes); they are
tested against brute force, round trips or held-out labels.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (bpe, collocations, covertree, dialogue, linededup, mixing, oracles, passages, records, rules,
                          secret_scan, simhash, suffixdedup, toxicity)
from gleanery.llm.common import shared_folder, table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("op1_line_dedup", oracles.LINE_DEDUP)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coder = bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.digest(coder.encode(docs, decoded="decoded"))


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op7_quality_rules", oracles.QUALITY_RULES)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir))


@query("op8_records")
def op8_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    records.write(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"))
    return records.digests(spark, folder)


@query("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


@query("op10_cover_tree", oracles.TOP_K)
def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op11_collocations", oracles.COLLOCATIONS)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir).select("lang", "text"))


@query("op12_dialogue_repair")
def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.report(table(spark, sf_dir, "conversations"))


@query("op13_suffix_dedup")
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixdedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
