"""The repeated snapshot cycle as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from vacancia.operators.dedup import keep_last
from vacancia.operators.merge import KEPT, next_table
from vacancia.session import configured, scratch_path

# State of long horizons lies on disk and in the checkpoint as changes, not in the executors' heap.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
COMPACT_EVERY = 16  # batches after which a streamed state is written as a whole


def landed_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def merge_stream(snapshots: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a batch merge for every micro-batch of landed snapshots.

    ``apply`` gets the batch id: it writes its result under that id, so a batch that is
    run again after a failure replaces its own output.
    """
    return (
        snapshots.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_state(spark: SparkSession, root: str, schema: str, upto: int | None = None, compact_every: int = COMPACT_EVERY,
                 key: str = "id") -> DataFrame:
    """The state under ``root`` after all batches, or after those before ``upto``.

    It is the last whole copy and, per key, the last change behind it.
    """
    if upto is None:
        upto = _batches(spark, root)
    base = upto // compact_every * compact_every - 1
    parts = [spark.read.schema(schema).parquet(f"{root}/base/batch={base}").withColumn("_batch", F.lit(base))] if base >= 0 else []
    parts += [
        spark.read.schema(schema).parquet(f"{root}/changes/batch={i}").withColumn("_batch", F.lit(i)) for i in range(base + 1, upto)
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    return keep_last(reduce(DataFrame.unionByName, parts), [key], ["_batch"]).drop("_batch")


def _batches(spark: SparkSession, root: str) -> int:
    """How many batches have written their changes: one row tells of each, behind its changes."""
    try:
        written = spark.read.schema("batch bigint").parquet(f"{root}/written")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return written.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]


def merge_snapshots(snapshots: DataFrame, root: str, schema: str, step: Callable[[DataFrame, DataFrame, int], DataFrame],
                    compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Merge every landed snapshot into a state that is kept as changes.

    ``step`` makes the staged rows (``merge_snapshot``) of the state before, the batch and
    its number. A batch writes only the rows that it changed, under its number, and every
    ``compact_every`` batches the whole state; a batch that is run again replaces its own
    output. The checkpoint is in ``root``, so that a restart goes on where the last run ended.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        before = stream_state(spark, root, schema, batch_id, compact_every)
        changed = next_table(step(before, batch, batch_id).where(F.col("action") != KEPT))
        # one file at least, so that a batch without changes is there too
        changed.select(*before.columns).write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            base = (batch_id + 1) // compact_every * compact_every - 1
            parts = stream_state(spark, root, schema, batch_id, compact_every)
            now = keep_last(
                parts.withColumn("_batch", F.lit(0)).unionByName(
                    spark.read.schema(schema).parquet(f"{root}/changes/batch={batch_id}").withColumn("_batch", F.lit(1))), ["id"], ["_batch"])
            now.drop("_batch").write.mode("overwrite").parquet(f"{root}/base/batch={base}")
        spark.range(batch_id, batch_id + 1).select(F.col("id").alias("batch")).coalesce(1).write.mode("append").parquet(f"{root}/written")

    return merge_stream(snapshots, apply, f"{root}/checkpoint")


def drop_repeated(postings: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """First sight of every posting; a key is remembered for ``delay`` of event time."""
    return postings.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def expired_postings(sightings: DataFrame, key: str, time: str, days: int = 7, delay: str = "0 seconds") -> DataFrame:
    """Postings not seen for ``days``: (key, first_seen, last_seen, expires_at, sightings).

    A posting's sightings form a session that ends when none follows for ``days``; the
    session closes in event time, so the state of a closed posting is dropped. Works on a
    stream and on a table. On a table the sightings of a posting are first reduced to one
    interval per stretch of ``days`` (two sightings in one stretch are never further apart),
    so that a posting with very many sightings does not go to one task as a whole.
    """
    first, last, n = F.min(time), F.max(time), F.count(F.lit(1))
    if sightings.isStreaming:
        spans = sightings.withWatermark(time, delay).groupBy(F.session_window(time, f"{days} days").alias("_w"), key).agg(
            first.alias("first_seen"), last.alias("last_seen"), n.alias("sightings"))
    else:
        stretch = F.floor(F.unix_seconds(F.col(time)) / F.lit(days * 86_400))
        short = sightings.groupBy(key, stretch.alias("_s")).agg(first.alias("_a"), last.alias("_b"), n.alias("_n"))
        seconds = ((F.unix_micros("_b") - F.unix_micros("_a")) / F.lit(1_000_000)).cast("decimal(18,6)")
        gap = F.make_interval(days=F.lit(days), secs=seconds)
        spans = short.groupBy(F.session_window("_a", gap).alias("_w"), key).agg(
            F.min("_a").alias("first_seen"), F.max("_b").alias("last_seen"), F.sum("_n").alias("sightings"))
    return spans.select(key, "first_seen", "last_seen", F.col("_w.end").alias("expires_at"), "sightings")


def run_to_table(stream: DataFrame, name: str, mode: str = "append", root: str | None = None) -> DataFrame:
    """Drive a stream over all landed files into a parquet table of the shared folder.

    Table and checkpoint are under ``root``, a new folder unless one is given; a stream that is
    run again on its root goes on where it ended. The state store is RocksDB, for this stream
    alone: a query keeps the settings that it began with.
    """
    spark = stream.sparkSession
    root = scratch_path(spark, name) if root is None else root
    with configured(spark, STATE_ON_DISK):
        query = (
            stream.writeStream.format("parquet").outputMode(mode).option("path", f"{root}/table")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table")
