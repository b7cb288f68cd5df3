"""Incremental runs as Structured Streaming: windowed counts with a watermark and idempotent curation of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.urls import canonical_url
from presslens.sources.store import Store, insert_absent


def windowed_counts(events: DataFrame, time: str = "ts", size: str = "1 hour", slide: str | None = None, lateness: str = "2 hours") -> DataFrame:
    """Events and their value per window and type; state older than the lateness is dropped. Batch or stream."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    rows = events.withWatermark(time, lateness) if events.isStreaming else events
    return rows.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast("string").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each user: start, number of events."""
    rows = events.withWatermark("ts", "2 hours") if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("s.start").cast("string").alias("start"), "n")


def run_available(stream: DataFrame, name: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Drive a stream of corrected rows over what is there now into Parquet and return the latest row of each key.

    Each micro-batch is one folder named by its number, so a repeated batch overwrites itself and none passes the driver."""
    folder = f"{checkpoint}/{name}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("__batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    q = stream.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = stream.sparkSession.read.schema(stream.select("*", F.lit(0).cast("bigint").alias("__batch")).schema).parquet(f"{folder}/batch=*")
    others = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(*(F.max_by(c, "__batch").alias(c) for c in others)).select(*stream.columns)


class Curator:
    """A micro-batch sink that stores each page once; replaying a batch changes nothing."""

    def __init__(self, spark: SparkSession, folder: str):
        self.store = Store(spark, folder)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        """Store the new items of a batch by canonical address."""
        keyed = batch.where((F.length("title") > 0) & (F.length("link") > 0)).withColumn("canonical_url", canonical_url(F.col("link")))
        known = self.store.read("items")
        new = keyed.dropDuplicates(["canonical_url"]) if known is None else insert_absent(known, keyed, ["canonical_url"])
        self.store.append("items", new.withColumn("epoch", F.lit(epoch).cast("bigint")))

    def start(self, stream: DataFrame, checkpoint: str, every: str | None = None):
        """Start the query, once over what is there or in intervals."""
        w = stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
