"""From raw documents to packed training sequences: five stages, each one operator of tallyfold.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import mixture, packing, quality, simhash, surrogates
from tallyfold.llm.common import table, word_count
from tallyfold.session import stage

# Documents that score less are rejected.
ACCEPT = 0.3
# Stands for a secret kept outside the repository; reruns must give the same result.
PII_KEY = b"example key"


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, ACCEPT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the least id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by surrogates."""
    return surrogates.replaced_rows(docs, PII_KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes; a document taken more than once is several rows."""
    mixed = mixture.mix(docs, "doc_id", "source", word_count(F.col("text")), carry=True)
    return mixture.mixed_texts(mixed, "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: one row for each piece of text with its bin and its place in it."""
    packed = packing.best_fit(docs, "doc_id", word_count(F.col("text")), "text")
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", reject_bad),
    ("SimHash near-dedup", drop_near_duplicates),
    ("PII surrogates", replace_pii),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

# Compression, fingerprints and keyed streams are not expressible in SQL; tests/llm/test_pipeline.py has plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
