"""A corpus pipeline of four stages: quality rules, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept, written as Parquet and read again.
All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import nearcopies, packing, quality, toxicity
from tessella.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality.keep_quality(docs.select(*COLUMNS))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; labels are learnt from the usual two thirds of the ids."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    classifier = toxicity.fit(docs, labels, usable=lambda i: F.crc32(i.cast("string").cast("binary")) % 3 != 1)
    return toxicity.keep_clean(docs.select(*COLUMNS), classifier)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, similarity 0.8 or more): the one with the smallest id."""
    return nearcopies.keep_one(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("toxicity_filter", toxicity_filter), ("simhash_dedup", simhash_dedup), ("best_fit_packing", best_fit_packing)]

#: No stage but the first could be put in SQL; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
