"""Inventory of transcript files by month, the month rollup, and the choice and paging of batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import ratio
from .ordered import chunk_of, narrow, prefix_sums, running_sum


def inventory(messages: DataFrame) -> DataFrame:
    """A row per month, source_type, file and session_id. Users and assistants count if accepted; dirty users, too, dirty assistants always."""
    user, accepted, dirty = F.col("role") == "user", F.col("reject").isNull(), F.col("dirty")
    rows = messages.groupBy("month", "source_type", "file", "session_id").agg(
        F.count("*").alias("message_count"),
        F.count_if(user & accepted).alias("user_count"),
        F.count_if(~user & accepted).alias("assistant_count"),
        F.count_if(accepted).alias("accepted_count"),
        F.count_if(~accepted).alias("rejected_count"),
        F.count_if(dirty & (~user | accepted)).alias("dirty_count"),
        F.min("ts_ms").alias("first_ts"),
        F.max("ts_ms").alias("last_ts"),
        F.min_by(F.when(user & accepted & (F.col("content") != ""), F.substring("content", 1, 300)), F.when(user & accepted & (F.col("content") != ""), F.col("line_no"))).alias("sample_user_text"),
    )
    return rows.withColumn("dirty_ratio", ratio(F.col("dirty_count"), F.col("message_count"))).withColumn("rejected_ratio", ratio(F.col("rejected_count"), F.col("message_count")))


def month_rollup(rows: DataFrame, months: Sequence[str] = ()) -> DataFrame:
    """Sums per month of an inventory; months asked for without files get zeros."""
    sums = rows.groupBy("month").agg(F.count("*").alias("sessions"), F.sum("message_count").alias("messages"), F.sum("user_count").alias("users"), F.sum("assistant_count").alias("assistants"), F.sum("rejected_count").alias("rejected"))
    if not months:
        return sums
    asked = rows.sparkSession.createDataFrame([(m,) for m in months], "month string")
    return asked.join(sums, "month", "full").select("month", *(F.coalesce(c, F.lit(0)).alias(c) for c in sums.columns[1:]))


def select_files(rows: DataFrame, month: str, **equal: str) -> DataFrame:
    """The month's files, by equality filters, in batch order: channels first, then by size, then by path."""
    picked = rows.where(F.col("month") == month)
    for column, value in equal.items():
        picked = picked.where(F.col(column) == value)
    return picked.orderBy(*_batch_order("source_type", "message_count"))


def page_rounds(rounds: DataFrame, files: DataFrame, batch_size: int, batch_index: int) -> DataFrame:
    """The rounds of one page (1-based) over all files in batch order. ``rounds``: month, file, round_id; ``files``: an inventory.

    Only a file's number of rounds is summed up in order; rounds get their place from where their file starts.
    """
    counts = rounds.groupBy("month", "file").agg(F.count("*").alias("n"))
    placed = prefix_sums(counts.join(files.select("month", "file", "source_type", "message_count"), ["month", "file"]), [F.col("month"), *_batch_order("source_type", "message_count")], F.col("n"), "upto")
    months = placed.groupBy("month").agg(F.min("upto").alias("first"))
    starts = placed.join(narrow(months), "month").withColumn("before", F.col("upto") - F.col("first"))
    return rounds_between(rounds, starts, ["month", "file"], (batch_index - 1) * batch_size, batch_size)


def rounds_between(rounds: DataFrame, starts: DataFrame, keys: list[str], offset: int, size: int) -> DataFrame:
    """The rounds with a ``place`` from ``offset`` on, ``size`` of them; ``starts``: (*keys, n, before) of files. Rounds of other files are not put in order."""
    touched = starts.where((F.col("before") < offset + size) & (F.col("before") + F.col("n") > offset)).select(*keys, "before")
    numbered = running_sum(rounds.join(touched, keys), keys, chunk_of(F.col("round_id")), [F.col("round_id")], F.lit(1), "upto")
    placed = numbered.withColumn("place", F.col("before") + F.col("upto") - 1).drop("before", "upto")
    return placed.where((F.col("place") >= offset) & (F.col("place") < offset + size))


def _batch_order(source_type: str, size: str, file: str = "file") -> list[Column]:
    """Channels first, then by size, then by path."""
    return [F.when(F.col(source_type) == "discord", 0).otherwise(1), F.desc(size), F.col(file)]


def ordered_inventory(rows: DataFrame) -> DataFrame:
    """By month, source type and file, by Unicode collation."""
    return rows.orderBy(*(F.collate(F.col(c), "UNICODE") for c in ("month", "source_type", "file")))


def place_files(messages: DataFrame) -> DataFrame:
    """(file, before): how many line numbers the files before this one take up in batch order (channels first, then by messages, then by path).

    A row for each file is put in order, by ranges of that order.
    """
    files = messages.groupBy("file").agg(F.count("*").alias("n"), F.max("line_no").alias("lines"), F.max("source_type").alias("source_type"))
    return prefix_sums(files, _batch_order("source_type", "n"), F.coalesce("lines", F.lit(0)) + 1, "before").select("file", "before")


def offset_rejects(rounds_available: int, month: str, batch_id: str, offset_rounds: int, spark) -> DataFrame:
    """The reject of a page that begins beyond the rounds there are; no row otherwise."""
    rows = [("offset_beyond_available_rounds", month, batch_id, offset_rounds, rounds_available)] if 0 < rounds_available <= offset_rounds else []
    return spark.createDataFrame(rows, "reason string, month string, batch_id string, offset_rounds long, total_available_rounds long")


def input_summary(seed: DataFrame) -> DataFrame:
    """One row of a seed input's sessions, rounds and messages, from the nested form; missing parts count nothing."""
    per = seed.select(F.explode("sessions").alias("s")).select(F.col("s.conversations").alias("c"))
    sizes = F.aggregate(F.col("c"), F.lit(0).cast("long"), lambda n, r: n + F.coalesce(F.size(r), F.lit(0)))
    return per.agg(F.count("*").alias("sessions"), F.coalesce(F.sum(F.when(F.col("c").isNotNull(), F.size("c")).otherwise(0)), F.lit(0)).cast("long").alias("rounds"), F.coalesce(F.sum(sizes), F.lit(0)).alias("messages"))
