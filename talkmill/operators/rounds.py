"""Strict rounds: a user message opens a round, assistants attach to it; everything else is rejected with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stage import staged
from .ordered import first_rows, join_null_safe, join_unique, running_sum


def strict_rounds(messages: DataFrame, file: str = "file", ts: str = "ts_ms", line: str = "line_no", key: str = "dedupe_key", chunk: Column | None = None) -> DataFrame:
    """Adds ``round_id`` (a file's number of user messages so far) and ``reject`` (null for members of a round).

    A user whose key came before in the file is a duplicate, and its assistants are orphans like those before any user; a user without
    an assistant is unpaired. Rows of equal time go by line; a null file is a file like others, and a null key is like none before it.
    """
    is_user = (F.col("role") == "user").cast("int")
    by_hour = F.floor(F.col(ts) / 3_600_000) if chunk is None else chunk
    numbered = running_sum(messages, [file], by_hour, [F.col(ts), F.col(line)], is_user, "round_id")
    told = staged(numbered.select(file, "round_id", key, is_user.alias("_user"), F.struct(F.col(ts), F.col(line)).alias("_place")), "places")
    users = first_rows(told.where("_user = 1"), [file, key], "_place", F.col("_place"), "_first")
    openers = users.select(file, "round_id", (F.col("_place") != F.col("_first")).alias("_again"))
    sizes = told.groupBy(file, "round_id").agg(F.sum(F.lit(1) - F.col("_user")).alias("_assistants"), F.count("*").alias("_rows"))
    heads = join_null_safe(sizes, openers, [file, "round_id"], "left")
    reject = (
        F.when((F.col("role") == "user") & F.col("_again"), "duplicate_user_message")
        .when((F.col("role") == "user") & (F.col("_assistants") == 0), "unpaired_user_without_assistant")
        .when((F.col("role") != "user") & ((F.col("round_id") == 0) | F.col("_again")), "assistant_only_without_user")
    )
    return join_unique(numbered, heads, [file, "round_id"], "_rows").withColumn("reject", reject).drop("_again", "_assistants")


def round_sizes(rounds: DataFrame, file: str = "file") -> DataFrame:
    """Per file: rounds, orphans, unpaired users, duplicate users, messages kept."""
    count = lambda reason: F.count_if(F.col("reject") == reason)
    return rounds.groupBy(file).agg(
        F.count_if(F.col("reject").isNull() & (F.col("role") == "user")).alias("rounds"),
        count("assistant_only_without_user").alias("orphans"),
        count("unpaired_user_without_assistant").alias("unpaired"),
        count("duplicate_user_message").alias("duplicate_users"),
        F.count_if(F.col("reject").isNull()).alias("kept"),
    )


def nested_rounds(rounds: DataFrame, file: str = "file") -> DataFrame:
    """A row per kept round with its messages as an array in order."""
    member = F.struct(F.col("ts_ms"), F.col("line_no"), F.col("role"), F.col("content"))
    kept = rounds.where("reject is null").groupBy(file, "round_id").agg(F.array_sort(F.collect_list(member)).alias("messages"))
    return kept.select(file, "round_id", "messages", F.col("messages")[0]["content"].alias("first_user"), F.element_at(F.col("messages"), -1)["content"].alias("last_assistant"))


def round_replies(rounds: DataFrame, file: str = "file") -> DataFrame:
    """Per kept round: its messages' number, the first one's content and the last one's."""
    place = F.struct("ts_ms", "line_no")
    return rounds.where("reject is null").groupBy(file, "round_id").agg(F.count("*").alias("n"), F.min_by("content", place).alias("first_user"), F.max_by("content", place).alias("last_assistant"))
