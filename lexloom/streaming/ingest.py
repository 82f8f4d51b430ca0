"""Incremental ingest with Structured Streaming; an extension, as the reference has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.normalize import shard_letter, term


def watch(spark: SparkSession, path: str, schema: str, files_at_once: int = 100) -> DataFrame:
    """New JSON-lines files of entries as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(path)


def fresh(entries: DataFrame, when: str = "seen_at", late: str = "1 day") -> DataFrame:
    """Entries once by normal term and body within the time that state is kept."""
    keyed = entries.withColumn("key", F.xxhash64(term("term"), "body"))
    return keyed.withWatermark(when, late).dropDuplicatesWithinWatermark(["key"]).drop("key")


def counts(entries: DataFrame, when: str = "seen_at", width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Entries by letter and time window."""
    return entries.withWatermark(when, late).groupBy(F.window(when, width), shard_letter("term").alias("letter")).agg(F.count("*").alias("n"))


def into_shards(entries: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream to a store by letter; batches that run again replace themselves."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("letter", shard_letter("term")).write.mode("overwrite").partitionBy("letter").json(f"{path}/batch={number}")

    return entries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
