"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Runtime re-planning does the size-dependent work: it turns a shuffle join into a
# broadcast join only when the measured side is under the threshold, and it splits
# a hot join partition otherwise.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a generated method over this size is not compiled by the JVM and runs slowly; wide
    # normalisation steps are then split into smaller ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # sightings of one posting are merged before they move
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def sized_for(shuffle_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for the bytes of the largest shuffle: partitions that fit a task's memory.

    Adaptive execution joins small partitions but makes no more than it starts with, so
    the start is sized for the largest exchange of a run.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def build_session(app: str = "vacancia", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Runs a step with settings and puts the session's own back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only on a local master, where the driver is the
    one executor; on a cluster the missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="vacancia-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a point that survives the loss of executors, and fixes the
    content of a frame that several later steps read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialise``, and aggregates over the rows that the writing pass took on its way."""
    seen = Observation(name)
    out = materialise(df.observe(seen, *[F.coalesce(c, F.lit(0)).alias(k) for k, c in counts.items()]), name)
    return out, dict(seen.get)
