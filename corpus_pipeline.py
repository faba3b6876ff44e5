"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of `documents`;
the last returns the pieces of packed sequences. `run` writes every stage as Parquet below the shared checkpoint
folder and reads it again for the next, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import decontamination, jaccard, language_id, packing, suffix_dedup
from scoreloom.llm.common import fold, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, learned from the labelled ones among them; NULL languages are filled in."""
    return language_id.keep_identified(docs, language_id.fit(docs.where(fold(docs.doc_id) != 0)))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every group of documents linked by shingle similarity."""
    return jaccard.keep_one_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 100 bytes that occurred before; those of which nothing is left go."""
    cut = suffix_dedup.remove_repeats(docs).where("length(text) > 0")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in passages of the benchmark."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1,024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_similar),
    ("suffix_dedup", without_repeats),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Learned languages, whole-corpus strings and tokenizer ids have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
