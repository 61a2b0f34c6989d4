"""The flow from transcripts to seed batches: normalise, reject, deduplicate, pair into rounds, page, nest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract
from ..functions import text as X
from ..operators.dedupe import batch_duplicates_rejected, batch_duplicates_warned, source_duplicates
from ..operators.inventory import place_files
from ..operators.ordered import join_null_safe, narrow
from ..operators.rounds import strict_rounds
from ..sources.stage import staged
from .queued import unnest_queued


@dataclass
class Curated:
    """``places``: (file, before), where each file begins in batch order."""

    messages: DataFrame
    rejects: DataFrame
    places: DataFrame


REJECT = ("reason", "file", "session_key", "line_no", "role", "ts_ms", "content_hash", "preview", "duplicate_scope", "duplicate_of")


def _rejected(rows: DataFrame, reason, scope: str | None = None, duplicate_of=None) -> DataFrame:
    none = F.lit(None)
    out = rows.withColumn("reason", reason).withColumn("preview", F.substring("content", 1, 300)).withColumn("duplicate_scope", none.cast("string") if scope is None else F.lit(scope)).withColumn("duplicate_of", none.cast("long") if duplicate_of is None else duplicate_of)
    return out.where("reason is not null").select(*REJECT)


def clean_messages(lines: DataFrame, month: str | None = None, reject_batch_duplicates: bool = False) -> Curated:
    """Messages that may enter rounds, and what was rejected or warned about and why.

    ``lines``: read_transcripts. Rules and progress updates come before duplicates. Duplicates are judged in batch order: channels first,
    then files with more messages, then by path, and by line within a file. ``seq`` is a message's place in that order, and ``duplicate_of``
    the seq of the message that a duplicate repeats; its scope is the source session or the batch.
    """
    all_rows = unnest_queued(staged(extract.messages_of(lines, queued_parts=True), "messages"))
    broken = all_rows.where("parse_error").withColumn("content_hash", F.lit(None).cast("string")).withColumn("content", F.col("line"))
    rows = all_rows.where("not parse_error")
    if month:
        rows = rows.where(F.col("month") == month)
    places = narrow(staged(place_files(rows), "places"))
    rows = rows.withColumn("content_hash", X.content_hash(F.col("content"))).withColumn("normalised", X.normalised_content(F.col("content")))
    rows = rows.withColumn("scope", X.source_scope(F.col("session_key"), F.col("session_id"), F.col("file")))
    rows = rows.withColumn("dedupe_key", X.dedupe_key(F.col("scope"), F.col("role"), F.col("ts_ms"), F.col("content"), F.col("message_id")))
    progress = F.when((F.col("role") == "assistant") & X.is_progress_update(F.col("content")), "assistant_progress_update")
    rows = rows.withColumn("reject", F.coalesce(X.reject_reason(F.col("role"), F.col("content")), progress))
    rows = staged(rows, "judged")
    good = join_null_safe(rows.where("reject is null"), places, ["file"]).withColumn("seq", F.col("before") + F.col("line_no")).drop("before")
    rejects = _rejected(broken, F.lit("json_parse_error")).unionByName(_rejected(rows, F.col("reject")))
    again, warning = F.lit("duplicate_normalized_content"), F.lit("duplicate_normalized_content_warning")
    if reject_batch_duplicates:
        judged = batch_duplicates_rejected(good)
        kept = judged.where("verdict = 'keep'").drop("verdict", "duplicate_of")
        rejects = rejects.unionByName(_rejected(judged.where("verdict = 'duplicate_source'"), again, "source_session", F.col("duplicate_of")))
        rejects = rejects.unionByName(_rejected(judged.where("verdict = 'duplicate_batch'"), warning, "batch", F.col("duplicate_of")))
    else:
        repeated = source_duplicates(good).where(F.col("source_first") != F.col("seq"))
        warned = batch_duplicates_warned(good)
        rejects = rejects.unionByName(_rejected(repeated, again, "source_session", F.col("source_first")))
        rejects = rejects.unionByName(_rejected(warned.where("batch_previous is not null"), warning, "batch", F.col("batch_previous")))
        kept = warned.drop("source_first", "batch_previous")
    warnings = kept.withColumn("_reason", F.explode(extract.stripped_reasons(F.col("dirty_flags"))))
    return Curated(kept, rejects.unionByName(_rejected(warnings, F.col("_reason"))), places)


def curate(lines: DataFrame, month: str | None = None, reject_batch_duplicates: bool = False) -> Curated:
    """Clean messages with ``round_id`` and ``reject``; the rejects of rounds join those of cleaning."""
    clean = clean_messages(lines, month, reject_batch_duplicates)
    paired = strict_rounds(clean.messages.drop("reject"))
    return Curated(paired, clean.rejects.unionByName(_rejected(paired.where("reject is not null"), F.col("reject"))), clean.places)


def seed_rounds(rounds: DataFrame, month: str) -> DataFrame:
    """A row per kept round: sessionKey, sessionId, sourceFile, round_id and its messages in order. A round is one user message and what answers it."""
    message = F.struct("role", "content", F.col("ts_ms").alias("timestamp"), F.map_entries("metadata").alias("metadata"), F.col("dedupe_key").alias("sourceKey"), F.nullif("content_hash", F.lit("")).alias("normalizedContentHash"))
    kept = rounds.where("reject is null").groupBy("session_key", "session_id", "file", "round_id").agg(F.array_sort(F.collect_list(F.struct("ts_ms", "line_no", message.alias("m")))).alias("ms"))
    whole = lambda m: m.withField("metadata", F.when(F.size(m["metadata"]) > 0, F.map_from_entries(m["metadata"])))
    return kept.select(F.concat("session_key", F.lit(f":seed:{month}")).alias("sessionKey"), F.col("session_id").alias("sessionId"), F.col("file").alias("sourceFile"), "round_id", F.transform("ms", lambda x: whole(x["m"])).alias("messages"))


def seed_sessions(rounds: DataFrame, month: str) -> DataFrame:
    """A row per session: sessionKey, sessionId, sourceFile and conversations (rounds of messages in order), ready to be written as JSON.

    For a page of rounds, which its batch size bounds; ``seed_rounds`` is the form for any number.
    """
    per_round = seed_rounds(rounds, month).withColumn("messages", F.transform("messages", lambda m: m.withField("metadata", F.map_entries(m["metadata"]))))
    all_rounds = per_round.groupBy("sessionKey", "sessionId", "sourceFile").agg(F.array_sort(F.collect_list(F.struct("round_id", "messages"))).alias("rs"))
    whole = lambda m: m.withField("metadata", F.map_from_entries(m["metadata"]))
    return all_rounds.select("sessionKey", "sessionId", "sourceFile", F.transform("rs", lambda x: F.transform(x["messages"], whole)).alias("conversations"))
