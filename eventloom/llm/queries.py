"""The corpus operators as named queries over a folder of driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bestposition, bpe, lattice, merkle, mixing, packing, pii, quality, quotes, secrets, simhash, suffix_tree, tokenrows
from eventloom.llm.common import documents
from eventloom.llm.oracle import ORACLE

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def number_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@query
def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quotes.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return rows.select(
        "row.conv_id",
        "row.turn",
        "row.role",
        F.col("own").alias("text"),
        "levels",
        "quoted",
        "linked",
        "answers_conv",
        "answers_turn",
        "conversation",
        "root_turn",
        "depth",
    )


@query
def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.layout(documents(spark, sf_dir))


@query
def op4_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(documents(spark, sf_dir), keep=["doc_id"])
    return rows.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality.rejects(quality.BASE).alias("base_failed"),
        (~quality.rejects(quality.STANDARD)).alias("kept"),
        "failed",
    )


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.copies(documents(spark, sf_dir), keep=["doc_id"])
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op6_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenrows.packed_rows(documents(spark, sf_dir))


@query
def op7_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    repository = F.concat_ws("/", "source", "lang")
    rows = secrets.scan(documents(spark, sf_dir), repository=repository, owner="source", keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    counts = [number_of("spans", k).alias(f"n_{name}") for k, name in enumerate(secrets.BASE)]
    return rows.select(
        "row.doc_id",
        *counts,
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(secrets.reported(F.col("spans"))).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("bigint").alias("n_copied"),
    )


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.scan(documents(spark, sf_dir), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < len(pii.BASE))
    counts = [number_of("spans", k).alias(f"n_{name}") for k, name in enumerate(pii.BASE)]
    return rows.select(
        "row.doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


@query
def op9_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    rows = suffix_tree.scored(documents(spark, sf_dir), ~held_out, keep=["doc_id"])
    return rows.select(
        "row.doc_id",
        (F.crc32(F.col("row.doc_id").cast("string")) % 7 == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op10_lattice_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    original = merkle.leaf([F.col(c) for c in merkle.FIELDS])
    rows = merkle.manifest(docs, claim=F.when(tampered, merkle.leaf(changed)).otherwise(original))
    return rows.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


@query
def op12_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestposition.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op13_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encoded(documents(spark, sf_dir), keep=["doc_id"], decode=True)
    digests = [F.sha2(c, 256).alias(name) for c, name in (("packed", "ids_sha256"), ("bytes", "decoded_sha256"))]
    return rows.select("row.doc_id", "n_tokens", *digests)


__all__ = ["ORACLE", "QUERIES"]
