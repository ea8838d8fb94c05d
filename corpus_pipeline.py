"""The corpus pipeline: documents to sharded training data.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quireflow.llm import decontam, mixing, quality, sharding, simhash
from quireflow.llm.common import made, release, scratch, table
from quireflow.session import ship


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the ordinal classifier, fitted on the rated ones, rejects.

    Each row is judged by its own text, so equal rows go or stay together. Null, empty and blank texts go; nulls elsewhere, ids among them, don't matter; long texts count whole. An
    empty table stays empty. All columns stay as they are, whatever their names.
    """
    ship(spark)
    return quality.drop_low(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the least id.

    Rows that share id and text stay or go together, so equal rows stay if their document does. Rows without an id and null, empty and wordless texts are duplicates of nothing and
    stay. Long texts count whole. An empty table stays empty. All columns stay as they are, whatever their names.
    """
    ship(spark)
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark.

    Each row is judged by its own text. Null and empty texts stay, nulls elsewhere don't matter, and long texts are searched whole. An empty table, or benchmark, leaves all as it
    is. All columns stay as they are, whatever their names.
    """
    ship(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Selects and repeats documents so that sources meet their target weights.

    Equal texts are one document, for which the row with the least id stands, and of these that whose other columns have the least hash. Null, empty and blank texts and rows without an
    id are never selected; a null source counts as ''. An empty table stays empty. A selected row keeps all columns but its source, which is the one it serves.
    """
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the shards and reports where each row lies: (doc_id, shard, place, shard_rows).

    Every row is written with all its columns, be they null, repeated, empty or long, and reported, those without an id too. An empty table gives no rows. Two columns of one name are an error.
    """
    ship(spark)
    return sharding.assign(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix_sources), ("shard", shard)]

#: No SQL can express the fitted classifier, SimHash groups, the flow or the shards; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again. What a stage leaves there goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        begun = made()
        out = scratch(spark, f"pipeline-{name}")
        stage(ship(spark), docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        release(spark, begun if before is None else begun - 1, keep=(out,))  # the stage before is read no more
        before = out
    return STAGES[-1][1](spark, docs, sf_dir)
