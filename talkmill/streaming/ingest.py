"""Incremental ingest: new transcript lines are cleaned and appended batch by batch, each at most once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract
from ..functions import text as X
from ..plans.queued import unnest_queued
from ..sources.stage import staged


LINES = "file string, line_no bigint, source_type string, session_id string, session_key string, line string"


def line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of transcript lines landed as JSON files."""
    return spark.readStream.schema(LINES).json(folder)


def accepted(lines: DataFrame) -> DataFrame:
    """The messages of a batch of lines that the rules accept, with their hash."""
    rows = unnest_queued(staged(extract.messages_of(lines, queued_parts=True), "messages")).where("not parse_error").withColumn("content_hash", X.content_hash(F.col("content")))
    return rows.where(X.reject_reason(F.col("role"), F.col("content")).isNull())


def append_once(stream: DataFrame, out: str, checkpoint: str):
    """Runs what is available now: every micro-batch overwrites a folder of its own, so a repeated batch changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        accepted(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_content(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """First rows of each role and hash within the watermark, by event time."""
    timed = stream.withColumn("event_time", F.timestamp_millis("ts_ms")).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(["role", "content_hash"])


def counts_by_month(stream: DataFrame) -> DataFrame:
    """Running counts per session and role."""
    return stream.groupBy("session_key", "role").agg(F.count("*").alias("n"), F.max("ts_ms").alias("last_ts"))
