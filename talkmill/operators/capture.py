"""What a capture keeps of seed messages, and comparison of what is expected with what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.semantics import sha24, utf16_length
from .dedupe import duplicate_surplus  # noqa: F401
from .ordered import chunk_of, running_sum


def expected_capture(raw: DataFrame) -> DataFrame:
    """Per message of ``raw`` (session_key, role, ts_ms, content): captured content, hashes, keys, whether the sanitiser changed it and why it is filtered."""
    out = raw.withColumn("captured", X.captured_content(F.col("role"), F.col("content")))
    out = out.withColumn("raw_hash", X.content_hash(F.col("content"))).withColumn("hash", X.content_hash(F.col("captured")))
    out = out.withColumn("filter_reason", X.filter_reason(F.col("captured"))).withColumn("transformed", (F.col("captured") != F.col("content")) | (F.col("raw_hash") != F.col("hash")))
    return out.withColumn("compare_key", X.compare_key(F.col("session_key"), F.col("role"), F.col("ts_ms"), F.col("hash"))).withColumn("relaxed_key", X.relaxed_key(F.col("session_key"), F.col("role"), F.col("hash")))


def capture_counts(expected: DataFrame) -> DataFrame:
    kept = F.col("filter_reason").isNull()
    return expected.agg(F.count("*").alias("raw"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("filtered"), F.count_if(kept & F.col("transformed")).alias("transformed"))


def planned_rows(expected: DataFrame) -> DataFrame:
    """The kept rows as they would be written, with stable record ids."""
    fingerprint = F.coalesce(F.nullif(F.col("hash"), F.lit("")), sha24(F.col("captured")))
    kept = expected.where("filter_reason is null").withColumn("fingerprint", fingerprint)
    return kept.withColumn("record_id", X.stable_record_id(F.col("session_key"), F.col("role"), F.col("ts_ms"), F.col("fingerprint"))).withColumn("chars", utf16_length(F.col("captured")))


def numbered_plan(planned: DataFrame, order: str, tokenize: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """``planned`` with their ordinal from 0 by the long column ``order``, the message id (the source key, else fast_l0_<ordinal>_<hash6>), index text and JSON record.

    ``tokenize`` makes the index text from the captured text, as a Column; by default it is the text itself.
    """
    numbered = running_sum(planned, [], chunk_of(F.col(order)), [F.col(order)], F.lit(1), "upto").withColumn("ordinal", F.col("upto") - 1).drop("upto")
    ident = F.coalesce(F.nullif(F.col("source_key"), F.lit("")), F.concat(F.lit("fast_l0_"), F.col("ordinal").cast("string"), F.lit("_"), F.substring("fingerprint", 1, 6)))
    named = numbered.withColumn("message_id", ident).withColumn("fts_text", tokenize(F.col("captured")))
    record = F.to_json(F.struct(F.col("session_key").alias("sessionKey"), F.coalesce("session_id", F.lit("")).alias("sessionId"), F.col("message_id").alias("id"), "role", F.col("captured").alias("content"), F.coalesce("ts_ms", F.lit(0)).alias("timestamp")))
    return named.withColumn("record", record)


def import_summary(plan: DataFrame, batch_id: str) -> DataFrame:
    """The rows of an import's summary: what identifies each planned row, without its text. Its file and line are null if the plan has none."""
    empty_to_null = lambda c: F.nullif(F.col(c), F.lit(""))
    file = empty_to_null("source_file") if "source_file" in plan.columns else F.lit(None).cast("string")
    line = F.nullif(F.col("source_line").cast("long"), F.lit(0).cast("long")) if "source_line" in plan.columns else F.lit(None).cast("long")
    return plan.select(F.lit(batch_id).alias("batchId"), F.col("record_id").alias("recordId"), F.col("session_key").alias("sessionKey"), "role", F.coalesce("ts_ms", F.lit(0)).alias("timestamp"), F.col("fingerprint").alias("contentHash"), empty_to_null("session_id").alias("sessionId"), "chars", empty_to_null("source_key").alias("sourceKey"), file.alias("sourceFile"), line.alias("sourceLine"))


def live_keys(rows: DataFrame, month: str, text: str = "message_text") -> DataFrame:
    """(compare_key) of a store's rows of one month: one scan of the columns that keys are made of, with the month's filter beside it."""
    of_month = rows.where(X.of_month(F.col("session_key"), month))
    return of_month.select(X.compare_key(F.col("session_key"), F.col("role"), F.col("ts_ms"), X.content_hash(F.col(text))).alias("compare_key"))


def multiset_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, delta): how many more times each key stands on the left. Counts meet, not rows."""
    a = left.groupBy(key).agg(F.count("*").alias("_l"))
    b = right.groupBy(key).agg(F.count("*").alias("_r"))
    delta = F.col("_l") - F.coalesce("_r", F.lit(0))
    return a.join(b, key, "left").select(key, delta.alias("delta")).where("delta > 0")


def compare_multisets(expected: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """One row: total missing and extra, rows on both sides, and whether they are the same multiset."""
    counts = expected.groupBy(key).agg(F.count("*").alias("l")).join(live.groupBy(key).agg(F.count("*").alias("r")), key, "full")
    l, r = F.coalesce("l", F.lit(0)), F.coalesce("r", F.lit(0))
    out = counts.agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(n) for x, n in ((F.greatest(l - r, F.lit(0)), "missing"), (F.greatest(r - l, F.lit(0)), "extra"), (l, "expected_rows"), (r, "live_rows"))))
    return out.withColumn("complete", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("expected_rows") == F.col("live_rows")))


def dataset_hash(rows: DataFrame, key: str = "compare_key", by: list[str] | None = None) -> DataFrame:
    """24 hex digits of the sorted keys of each batch in ``by``. For batches of bounded size only: the keys of one meet in one task."""
    return rows.groupBy(*(by or [])).agg(sha24(F.array_join(F.array_sort(F.collect_list(key)), "\n")).alias("dataset_hash"))


def dataset_digest(rows: DataFrame, key: str = "compare_key", by: list[str] | None = None) -> DataFrame:
    """Count and sum of 60-bit key hashes: insensitive to order, sensitive to repeats, and summed map-side at any size."""
    piece = F.conv(F.substring(F.md5(F.col(key)), 1, 15), 16, 10).cast("decimal(20,0)")
    return rows.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.sum(piece).cast("string").alias("digest"))
