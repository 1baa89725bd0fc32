"""From raw documents to token ids: toxicity, exact copies, near copies, benchmark leaks, byte-pair encoding.

Every stage works on all that its predecessor kept, and its result is written as Parquet and read again before the next
one.  All but the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm import byte_bpe, decontaminate, digest_index, ngram_join, toxicity
from contactloom.llm.shared import crc_of_id, hold_batches, settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns as in op6_toxicity, with the same rows held out."""
    seen = crc_of_id() % 4 != 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs.filter(seen), labels.filter(seen)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return digest_index.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link by five-word shingles at 0.8 the one with the smallest id stays."""
    return ngram_join.one_of_each(docs, ngram_join.Measure(5, 80))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of them and of the text that they decode to."""
    codec = byte_bpe.Codec.build(docs, byte_bpe.vocabulary_path())
    return byte_bpe.digests(codec.decode(codec.encode(docs)), F.col("ids"))


def lean(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with small batches for Python: one session runs all stages, so what one needs at most the next ones
    find taken."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        hold_batches(spark, "4m")
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [("toxicity", lean(drop_toxic)), ("exact dedup", lean(drop_copies)), ("n-gram Jaccard join", lean(drop_near_copies)),
          ("benchmark decontamination", lean(drop_leaks)), ("BPE encoding and decoding", lean(encode))]

#: Classifier, components and token ids cannot be told in SQL; tests/llm compares each stage with a plain counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
