"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; all but the last
return the columns of `docs`. `run` writes every stage's result as Parquet in the shared folder and reads it
again, so a lost executor repeats no more than one stage.

ORACLE_SQL is None: perplexity, components of fingerprints and packing are not SQL. The tests compare
stages with brute-force versions.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from neudrift.llm.common import table
from neudrift.llm.decontaminate import decontaminate
from neudrift.llm.line_dedup import with_kept_lines
from neudrift.llm.packing import pack_documents
from neudrift.llm.quality import keep_good
from neudrift.llm.queries import QUALITY, WORD_TOKENIZER, tokenizer_file
from neudrift.llm.simhash import keep_firsts
from neudrift.session import workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are worse than their language's limit go."""
    return keep_good(docs, table(spark, sf_dir, "labels"), **QUALITY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that documents share stay in the first only."""
    return with_kept_lines(docs, min_chars=10, min_docs=2)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_firsts(docs, shingle=4, bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), min_words=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer_file(WORD_TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; the rows of the last."""
    docs, folder = table(spark, sf_dir, "documents"), f"{workspace(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
