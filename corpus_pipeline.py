"""Corpus pipeline: filter toxic documents, drop near-duplicates and benchmark copies, mix, tokenize.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet and gives
it to the next one. All but the last return the columns of documents.

All stages take null and empty texts, null and repeated doc_ids, repeated rows, further columns of
any name and an empty table; what each does with them is said where it is defined.
"""

from pyspark.sql import DataFrame, SparkSession

from fareline.llm import decontam, minhash, mixing, tokens, toxicity
from fareline.llm.common import store, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. Null, empty and wordless texts score as no evidence and stay; repeated rows get one decision."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of least doc_id (nulls last; of repeated rows one). Texts without words stay."""
    return minhash.drop_near_duplicates(docs, words=5, threshold=0.8)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item. Null and wordless texts stay; items that are null or shorter than a seed find nothing."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix's proportions: repeated where a source is taken more than once, gone where none of their words are. Null sources are one source."""
    return mixing.mix_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and checksums read back from the written files; a null or empty text is its end id alone."""
    return tokens.round_trip(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: A trained network, shingle sketches and a tokenizer are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
