"""From raw documents to packed sequences: five corpus operators, one after the other.

Each stage reads the documents its predecessor kept, from Parquet, and its decisions take
effect: rejected documents go, one of each group of near copies stays, personal data
is replaced in the text, sources are repeated or thinned to their targets, and what is left is
packed. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import mixing, packing, pii, quality, shingles
from eventloom.llm.common import documents, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard quality policy accepts."""
    return quality.ledger(docs).where(~quality.rejects(quality.STANDARD)).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: SimHash over five-word shingles, then Jaccard 0.8 or more."""
    return shingles.representatives(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their text replaced by its kind."""
    hidden = pii.redact(docs)
    return hidden.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else hidden


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each with its sequence and its place there."""
    return packing.layout(docs)


STAGES = [
    ("quality", keep_good),
    ("simhash", keep_one_of_each),
    ("personal_data", hide_personal_data),
    ("mix", mix),
    ("pack", pack),
]

#: Fingerprints and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's result over the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
