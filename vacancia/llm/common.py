"""What the operators of this package share: reading tables, saving steps, row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.session import materialise

# What every step runs with: shuffle files go when a step is written; texts that a join will not
# keep are dropped by a Bloom filter (8 MB at most) before they are shuffled, on tables of any
# size and not only from the 10 GB of Spark's default on; tasks get a few megabytes of texts at once.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "16MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def tuned(spark: SparkSession) -> SparkSession:
    """The session with what the steps of this package run with."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tuned(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    The written step survives lost executors, so the shuffle files that led to it are
    released as soon as it is there instead of at some later collection of garbage.
    """
    tuned(df.sparkSession)
    return materialise(df, name)


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def groups(docs: DataFrame, size: int, each: int) -> int:
    """Groups of about ``each`` of ``size`` bytes, the session's shuffle partitions at least."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``copy`` and ``text``: what names a document.

    Rows of one doc_id and one text are one document. Where ids are unique ``copy`` is 0 and
    costs nothing; where an id has several texts (or is null) it tells them apart.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    several = not ids.where((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty()
    copy = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) if several else F.lit(0).cast("bigint")
    return docs.select("doc_id", copy.alias("copy"), "text")


def several(docs: DataFrame) -> bool:
    """Whether an id stands in more than one row, or is null; ``docs`` is identified."""
    return not docs.where("copy <> 0").isEmpty()


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["copy"] == right["copy"])
