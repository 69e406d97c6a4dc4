"""Registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import (
    attention_quality,
    deep_shallow,
    merkle_manifest,
    oracle,
    pivotal_mix,
    prefix_bpe,
    risk_rules,
    separator_scan,
    simhash_balls,
    skip_chain,
    spelling_groups,
    token_files,
    uniform_threshold,
    wu_manber,
)
from arrears.llm.common import read_table
from arrears.llm.settings import END_OF_DOCUMENT, PATTERN, RANKS, TOKENIZER

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return skip_chain.personal_data(docs, skip_chain.train(docs))


@query
def op2_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniform_threshold.top_k(read_table(spark, sf_dir, "embeddings"))


@query
def op3_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pivotal_mix.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op4_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deep_shallow.remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op5_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_balls.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op6_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = risk_rules.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(read_table(spark, sf_dir, "documents"), TOKENIZER, 2)


@query
def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = separator_scan.token_counts(read_table(spark, sf_dir, "documents"), RANKS, PATTERN, END_OF_DOCUMENT)
    return counts.select("doc_id", "n_tokens")


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return prefix_bpe.encode_texts(docs, RANKS, PATTERN)


@query
def op10_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return attention_quality.score(docs, attention_quality.train(docs, read_table(spark, sf_dir, "labels")))


@query
def op11_bit_sliced_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(read_table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = merkle_manifest.manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": merkle_manifest.lower_ascii(F.col("text"))}, where_changed=tampered
    )
    return merkle_manifest.verify(leaves).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op13_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wu_manber.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_runs") > 0).alias("contaminated"),
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


ORACLE_SQL["op2_uniform_threshold"] = oracle.TOP_K
ORACLE_SQL["op6_risk_rules"] = oracle.risk_rules()
ORACLE_SQL["op11_bit_sliced_variants"] = oracle.SPELLING
ORACLE_SQL["op12_merkle_manifest"] = oracle.merkle()
ORACLE_SQL["op13_wu_manber"] = oracle.DECONTAMINATION
