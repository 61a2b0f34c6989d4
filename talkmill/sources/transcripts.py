"""Transcript files, memory-store exports and state files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEED_SCHEMA = (
    "metadata struct<month string, sourceType string, batchId string, offsetRounds int, limitRounds int>, "
    "sessions array<struct<sessionKey string, sessionId string, sourceFile string, conversations array<array<struct<role string, content string, timestamp bigint, sourceKey string, normalizedContentHash string>>>>>"
)
PROGRESS_SCHEMA = "sessions map<string, struct<totalL0 bigint, nextOffset bigint, completed boolean>>"


def source_meta(path: Column) -> Column:
    """struct(source_type, session_id, session_key) from a transcript's path; null for paths of neither kind."""
    channel = F.regexp_extract(path, r"/discord/sessions/(?:.*/)?([^/]+)/history\.jsonl$", 1)
    agent = F.regexp_extract(path, r"/agents/([^/]+)/sessions/(?:.*/)?([^/]+)\.jsonl$", 1)
    session = F.regexp_extract(path, r"/agents/([^/]+)/sessions/(?:.*/)?([^/]+)\.jsonl$", 2)
    make = lambda kind, ident, key: F.struct(kind.alias("source_type"), ident.alias("session_id"), key.alias("session_key"))
    return F.when(channel != "", make(F.lit("discord"), channel, F.concat(F.lit("discord:"), channel))).when(
        (agent != "") & ~path.endswith(".trajectory.jsonl"), make(F.concat(F.lit("agent:"), agent), session, F.concat(F.lit("agent:"), agent, F.lit(":"), session))
    )


def read_lines(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """(file, line_no, line): non-blank trimmed lines of all files under ``root``; line numbers count blank lines and start at 1.

    Large files are read by many tasks, split by split. Lines are numbered within their split as they are read and stored; the counts of a
    file's splits give where each begins.
    """
    from ..functions.semantics import trimmed
    from ..operators.ordered import narrow
    from .stage import staged

    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
    lines = staged(read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line")), "lines")
    splits = lines.groupBy("file", "split").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = narrow(staged(splits.select("file", "split", (before - F.col("first") + 1).alias("shift")), "splits"))
    return lines.join(starts, ["file", "split"]).select("file", (F.col("id") + F.col("shift")).alias("line_no"), trimmed(F.col("line")).alias("line")).where("line <> ''")


def read_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """read_lines of the transcript files under ``root``, with source_type, session_id and session_key."""
    lines = read_lines(spark, root).withColumn("meta", source_meta(F.col("file")))
    return lines.where("meta is not null").select("file", "line_no", "line", "meta.*")


def unsupported_paths(spark: SparkSession, root: str) -> DataFrame:
    """A reject for each JSON lines file under ``root`` that is no transcript, trajectories aside; nothing of the files is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(root).select(F.col("path").alias("file"))
    odd = files.where(source_meta(F.col("file")).isNull() & ~F.col("file").endswith(".trajectory.jsonl"))
    return odd.select(F.lit("unsupported_source_path").alias("reason"), "file")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a run's log."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_run_summary(spark: SparkSession, path: str) -> DataFrame:
    """A run's exit codes and whether it fell back; nulls for what is missing."""
    return spark.read.schema("officialExitCode long, fallbackUsed boolean, processExitCode long").json(path, multiLine=True).withColumn("officialCliFallbackUsed", F.coalesce("fallbackUsed", F.lit(False)))


def read_seed_input(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEED_SCHEMA).json(path, multiLine=True)


def read_seed_history(spark: SparkSession, folder: str, current: str) -> DataFrame:
    """Earlier seed inputs of a folder with their file, without configurations and the current one; broken files are skipped."""
    read = spark.read.schema(SEED_SCHEMA).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(folder, multiLine=True)
    named = read.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("_name"))
    return named.where(~F.col("_name").endswith(".seed-config.json") & (F.col("_name") != current) & F.col("sessions").isNotNull()).drop("_name")


def flatten_seed(seed: DataFrame) -> DataFrame:
    """A row per message of a seed input, in order (session, round and message places)."""
    sessions = seed.select(F.posexplode("sessions").alias("session_no", "s"))
    rounds = sessions.select("session_no", F.col("s.sessionKey").alias("session_key"), F.col("s.sessionId").alias("session_id"), F.posexplode("s.conversations").alias("round_no", "r"))
    return rounds.select("session_no", "session_key", "session_id", "round_no", F.posexplode("r").alias("message_no", "m")).select(
        "session_no", "session_key", "session_id", "round_no", "message_no", "m.role", "m.content", F.col("m.timestamp").alias("ts_ms"), F.col("m.sourceKey").alias("source_key"), F.col("m.normalizedContentHash").alias("content_hash")
    )


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """Memory records of JSON lines under ``root``, by either spelling of the fields; lines that do not parse have type parse_error."""
    lines = read_lines(spark, root).withColumn("v", F.try_parse_json("line"))
    field = lambda *names: F.coalesce(*(F.nullif(F.try_variant_get("v", f"$.{n}", "string"), F.lit("")) for n in names), F.lit(""))
    bad = F.col("v").isNull()
    return lines.select(
        "file",
        "line_no",
        field("record_id", "id").alias("record_id"),
        F.when(bad, "parse_error").otherwise(F.coalesce(F.nullif(F.try_variant_get("v", "$.type", "string"), F.lit("")), F.lit("unknown"))).alias("type"),
        field("session_key", "sessionKey").alias("session_key"),
        field("session_id", "sessionId").alias("session_id"),
        F.when(bad, F.substring("line", 1, 300)).otherwise(field("content", "text")).alias("content"),
    )


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.schema(PROGRESS_SCHEMA).json(path, multiLine=True)
    return read.select(F.explode("sessions").alias("session_key", "p")).select("session_key", F.col("p.totalL0").alias("total_l0"), F.col("p.nextOffset").alias("next_offset"), "p.completed")


def file_stats(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """(name, size, modified_ms) of files, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.unix_millis("modificationTime").alias("modified_ms"))
