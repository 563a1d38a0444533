"""Structured Streaming: resumable ingest, keyed de-dup, incremental enrichment,
stream scoring (ST1-ST4).

The reference's resumable crawl loop (load what exists, skip seen keys,
append, save periodically) becomes a file-source stream with a checkpoint:
each ``foreachBatch`` de-duplicates the batch (first occurrence per key), drops
the keys that a seen-key index knows (``seen.py``: what it reads follows the
batch, not the sink) and writes the rest.  ``foreachBatch`` is at-least-once:
a batch's rows go to a folder of its own, which a replay overwrites, and the
index commits them with all their keys or not at all, so restarts and lost
executors never duplicate keys.  Checkpoints and sinks live below the shared
checkpoint directory.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.operators.sampling import first_per_key
from sylvan.session import cut_lineage
from sylvan.sources.csv import path_exists
from sylvan.streaming.seen import SeenKeys, index_path

#: The folder name of a batch in a sink; readers see it as a column.
BATCH = "ingest_batch"


def ingest_batch(batch: DataFrame, batch_id: int, stream: str, sink: str, key: list[str], order: list[str]) -> None:
    """One micro-batch: first row per key in the batch, minus keys already in the sink, as a folder of its own."""
    index = SeenKeys(batch.sparkSession, index_path(sink), key)
    if index.has_done(stream, batch_id):
        return
    fresh, n = index.unseen(first_per_key(batch, key, order))
    if n:
        fresh.drop("_h").write.mode("overwrite").parquet(f"{sink.rstrip('/')}/{BATCH}={stream}-{batch_id}")
    index.add(fresh, n, stream, batch_id)


def index_sink(spark: SparkSession, sink: str, key: list[str]) -> None:
    """Build the key index of a sink that was filled otherwise (one pass over its keys)."""
    index = SeenKeys(spark, index_path(sink), key)
    keys = cut_lineage(index._keyed(spark.read.parquet(sink).select(*key).distinct()))
    index.add(keys, keys.count(), "sink", 0)


def run_ingest(spark: SparkSession, source_dir: str, schema, sink: str, checkpoint: str,
               key: list[str], order: list[str], max_files_per_trigger: int | None = None) -> None:
    """ST1: process everything that has arrived (availableNow) and stop; rerun to resume."""
    if path_exists(spark, sink) and not path_exists(spark, index_path(sink)):
        index_sink(spark, sink, key)
    stream_name = f"{zlib.crc32(checkpoint.encode()):08x}"  # batch ids count per checkpoint
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    q = (stream.writeStream.foreachBatch(lambda df, batch_id: ingest_batch(df, batch_id, stream_name, sink, key, order))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_dedupe(spark: SparkSession, source_dir: str, schema, key: list[str], sink: str, checkpoint: str,
               event_time: str | None = None, delay: str = "1 day") -> dict | None:
    """ST3: keyed stateful de-dup on a RocksDB state store.

    With ``event_time`` the state is bounded: a key is remembered until the watermark (the latest event time less
    ``delay``) passes the time of its first row, then it is dropped.  Repeats that arrive within the delay are found;
    rows older than the watermark are left out.  Without it every key is kept, like the reference's set.
    """
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(schema).parquet(source_dir)
        if event_time:
            names = stream.columns
            stream = (stream.withColumn("_at", F.col(event_time).cast("timestamp")).withWatermark("_at", delay)
                      .dropDuplicatesWithinWatermark(key).select(*names))
        else:
            stream = stream.dropDuplicates(key)
        q = (stream.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    finally:  # the query keeps the setting it started with; other streams keep theirs
        spark.conf.set(setting, before)
    q.awaitTermination()
    return q.lastProgress


def run_keyed_updates(spark: SparkSession, source_dir: str, schema, extract, sink: str, checkpoint: str) -> None:
    """ST2: each batch of pages is extracted by ``extract(df) -> (key.., fields..)`` and the
    result is appended to an update log tagged with the batch id (a replayed batch
    overwrites its own partition).  ``latest_updates`` folds the log, ``compact_updates``
    folds it into a snapshot from which later folds start."""
    def handle(df, batch_id):
        out = extract(df).withColumn("batch_id", F.lit(batch_id))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink))

    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _snapshots(sink: str) -> str:
    return f"{sink.rstrip('/')}-snapshots"


def latest_snapshot(spark: SparkSession, sink: str) -> tuple[str | None, int]:
    """The newest complete snapshot's path and the last batch in it (None, -1 without any)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(_snapshots(sink))
    found = at.getFileSystem(conf).globStatus(jvm.org.apache.hadoop.fs.Path(f"{_snapshots(sink)}/upto-*/_SUCCESS")) or []
    upto = max((int(s.getPath().getParent().getName().rpartition("-")[2]) for s in found), default=-1)
    return (f"{_snapshots(sink)}/upto-{upto}", upto) if upto >= 0 else (None, -1)


def pending_updates(spark: SparkSession, sink: str, key: list[str], fields: list[str]) -> DataFrame:
    """What a fold reads: the newest snapshot (as of its last batch) and the log's batches after it."""
    path, upto = latest_snapshot(spark, sink)
    log = spark.read.parquet(sink).select(*key, *fields, "batch_id")
    if path is None:
        return log
    snapshot = spark.read.parquet(path)
    return log.where(F.col("batch_id") > upto).unionByName(snapshot.withColumn("batch_id", F.lit(upto)))


def latest_updates(spark: SparkSession, sink: str, key: list[str], fields: list[str]) -> DataFrame:
    """Fold an update log: per key and field, the latest *truthy* value (non-null, non-empty).

    Of several values of a key in one batch the largest counts, whatever the row order.
    """
    log = pending_updates(spark, sink, key, fields)
    aggs = []
    for f in fields:
        truthy = F.nullif(F.col(f).cast("string"), F.lit(""))
        latest = F.max(F.when(truthy.isNotNull(), F.struct("batch_id", truthy.alias("value"))))
        aggs.append(latest["value"].alias(f))
    return log.groupBy(*key).agg(*aggs)


def compact_updates(spark: SparkSession, sink: str, key: list[str], fields: list[str]) -> int:
    """Fold snapshot and newer batches into a new snapshot version; returns the last batch it holds.

    The new version is complete when its success mark is there, so a failed compaction changes nothing, and the log
    and older versions stay as they are.
    """
    last = spark.read.parquet(sink).agg(F.max("batch_id")).first()[0]
    _, upto = latest_snapshot(spark, sink)
    if last is None or last <= upto:
        return upto
    latest_updates(spark, sink, key, fields).write.mode("overwrite").parquet(f"{_snapshots(sink)}/upto-{last}")
    return last


def run_scoring(spark: SparkSession, source_dir: str, schema, score, sink: str, checkpoint: str) -> None:
    """ST4: score a stream with a fitted model; ``score(df)`` uses stream-static joins."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (score(stream).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
