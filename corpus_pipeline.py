"""Documents to shards of a training corpus, in stages that each call one operator.

Each stage's rows are written as Parquet and read again as the next one's documents.
A stage works on every row that its predecessor kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courierlens.llm import decontaminate, language_id, mixing, sharding, simhash
from courierlens.llm.common import scratch_path

#: Texts that fit no profile better than this are rejected as no language. Ordinary
#: texts of one word score above 0.4.
LEAST_SCORE = 0.2


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a language; null texts, texts without letters and junk go.

    Repeated rows are alike kept or dropped; null ids are as good as others.
    """
    return language_id.keep_known(docs, least=LEAST_SCORE)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one of the least doc_id.

    Null and empty texts have one fingerprint and are a group. Repeated rows of that id and
    fingerprint are one document. Where all ids of a group are null, one of its rows stays.
    """
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of the benchmark, each repeated row of them.

    Null and empty texts contain nothing and stay, and so does all if the benchmark is
    empty. Texts are searched as a whole.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that the sources' words come near their targets.

    A document is there as often as the mix takes it, some not at all. A null source is
    one like any other, null and empty texts have no words, rows of null ids share one coin.
    """
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row that is left.

    Rows of equal text share a shard, null counts as empty; repeated rows and null ids
    get slots of their own.
    """
    return sharding.assign(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed_sources),
    ("sharding", shards),
]

#: SQL can express neither the profiles nor the fingerprints' components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
