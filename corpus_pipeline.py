"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding, over whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellspan.llm import decontaminate, jaccard, mixing, sharding, toxicity
from wellspan.llm.common import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.5, by a model learned from the labels of documents given.

    Null and empty texts have no term and stay; repeated rows are judged alike; without labels all stay; an empty table
    stays empty.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.not_toxic(docs, model).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group that links at 0.8 on five-word shingles.

    Texts without words link with nothing and stay; rows with one id stay or go together; an empty table stays empty.
    """
    return jaccard.one_of_each(docs, 5, 80).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark.

    Texts without words are clean; repeated rows are judged alike; an empty benchmark drops nothing.
    """
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; copies are rows of their own.

    A null source is one of its own; rows with one id and text are taken alike; an empty table stays empty.
    """
    return mixing.mix(docs).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every row: doc_id, size, text_crc32, shard, slot.

    Null texts have size 1 and checksum 0; rows alike in id and text take places of their own, and which takes which
    doesn't matter; an empty table gives no rows.
    """
    return sharding.place(docs).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [("toxicity", reject_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix_sources), ("sharding", shard)]

#: Toxicity scores and the permutation aren't SQL; tests hold every stage against brute force on the stage's own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
