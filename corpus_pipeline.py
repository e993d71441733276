"""A training corpus from raw documents: quality, exact and near duplicates, mixing, packing.

Every stage takes what the one before kept, as a written table with the columns of documents;
the last gives the places of all pieces in the packed sequences. SQL can't express the learned
score, the signatures or the packing, so there is no ``ORACLE_SQL``; the tests hold the stages
against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import exact, minhash, mixing, packing, quality
from recordloom.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, rest=True).where(F.col("score") >= quality.KEEP).select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicated(docs, keep="largest")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return got.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), "offset")


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
