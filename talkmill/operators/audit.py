"""Audit of seed inputs and memory stores: quality, overlap, coverage, pollution, progress and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..functions.semantics import ratio, utf16_length
from .keysearch import lines_with_keys


def _rates(out: DataFrame, duplicates: str) -> DataFrame:
    total = F.col("total_messages")
    rates = {"duplicate_rate": (duplicates, total), "duplicate_content_rate": ("duplicate_content", total), "progress_rate": ("progress_updates", total), "user_duplicate_content_rate": ("user_duplicate_content", F.col("user_messages")), "noise_rate": ("system_noise", total), "envelope_rate": ("metadata_envelopes", total)}
    return out.select("*", *(ratio(F.col(c), whole).alias(n) for n, (c, whole) in rates.items()))


def _flags(messages: DataFrame) -> DataFrame:
    return messages.agg(
        F.count("*").alias("total_messages"),
        F.count_if(F.col("role") == "user").alias("user_messages"),
        F.count_if((F.col("role") == "assistant") & X.is_progress_update(F.col("content"))).alias("progress_updates"),
        F.count_if(X.noise_class(F.col("content")).isNotNull()).alias("system_noise"),
        F.count_if(X.has_residual_envelope(F.col("content"))).alias("metadata_envelopes"),
    )


def _surplus(rows: DataFrame, key: Column, name: str) -> DataFrame:
    counts = rows.select(key.alias("_key")).where(F.coalesce("_key", F.lit("")) != "").groupBy("_key").agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))


def quality(messages: DataFrame) -> DataFrame:
    """One row of counts and rates over a seed input's ``messages`` (role, ts_ms, content, content_hash, source_key).

    Users without a source key are told apart by role, time and content. One pass, and a count by key for each kind of duplicate.
    """
    users = messages.where(F.col("role") == "user")
    key = F.coalesce(F.nullif(F.col("source_key"), F.lit("")), X.fallback_key(F.col("role"), F.col("ts_ms"), F.col("content")))
    parts = [_surplus(users, key, "duplicate_users"), _surplus(messages, F.col("content_hash"), "duplicate_content"), _surplus(users, F.col("content_hash"), "user_duplicate_content")]
    return _rates(reduce(lambda a, b: a.join(b, F.lit(True)), parts, _flags(messages)), "duplicate_users")  # one row each


def output_quality(rows: DataFrame) -> DataFrame:
    """The same for a store's rows (role, content, content_hash), which have no source keys: duplicates are those of content."""
    users = rows.where(F.col("role") == "user")
    parts = [_surplus(rows, F.col("content_hash"), "duplicate_content"), _surplus(users, F.col("content_hash"), "user_duplicate_content")]
    return _rates(reduce(lambda a, b: a.join(b, F.lit(True)), parts, _flags(rows)), "duplicate_content")


def overlap(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """One row: messages of ``current`` (source_key, role_hash) whose key or hash stands in ``earlier`` (the same and file)."""
    keys = earlier.where("source_key <> ''").groupBy("source_key").agg(F.min("file").alias("key_owner"))
    hashes = earlier.where("role_hash <> ''").groupBy("role_hash").agg(F.min("file").alias("hash_owner"))
    hit = current.join(keys, "source_key", "left").join(hashes, "role_hash", "left")
    any_hit = F.col("key_owner").isNotNull() | F.col("hash_owner").isNotNull()
    out = hit.agg(F.count("*").alias("total_messages"), F.count_if(any_hit).alias("overlapping"), F.count_distinct(F.when(F.col("key_owner").isNotNull(), F.col("source_key"))).alias("key_hits"), F.count_distinct(F.when(F.col("hash_owner").isNotNull(), F.col("role_hash"))).alias("hash_hits"))
    return out.withColumn("overlap_rate", ratio(F.col("overlapping"), F.col("total_messages"))).withColumn("warning", F.col("overlap_rate") > 0)


def type_distribution(records: DataFrame) -> DataFrame:
    return records.groupBy(F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"))


def length_stats(records: DataFrame, column: str = "content") -> DataFrame:
    n = utf16_length(F.coalesce(F.col(column), F.lit(""))).cast("long")
    return records.agg(F.count("*").alias("n"), F.coalesce(F.round(F.avg(n), 1), F.lit(0.0)).alias("avg_length"), F.coalesce(F.max(n), F.lit(0)).alias("max_length"), F.count_if(n > 800).alias("over_800"), F.count_if(n > 1200).alias("over_1200"))


def key_hits(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(file, key): keys that stand in one of a file's lines."""
    return lines_with_keys(lines.select("file", "line"), keys).select("file", "key").distinct()


def pollution(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(file, line_no, key, match_kind): session_field if one of the line's JSON session fields is the key, else content_mention if the line contains it."""
    value = F.try_parse_json(F.col("line"))
    field = lambda f: F.when(F.schema_of_variant(F.try_variant_get(value, f"$.{f}", "variant")) == "STRING", F.try_variant_get(value, f"$.{f}", "string"))
    fields = lines.select("file", "line_no", F.explode(F.array_distinct(F.array_compact(F.array(*map(field, fixed.SESSION_FIELDS))))).alias("key"))
    wanted = keys.select("key").where(F.coalesce("key", F.lit("")) != "").distinct()
    named = fields.join(wanted, "key", "left_semi").select("file", "line_no", "key", F.lit(True).alias("named"))
    mentioned = lines_with_keys(lines.select("file", "line_no", "line"), wanted).select("file", "line_no", "key", F.lit(False).alias("named"))
    hits = named.unionByName(mentioned).groupBy("file", "line_no", "key").agg(F.max("named").alias("named"))
    return hits.select("file", "line_no", "key", F.when(F.col("named"), "session_field").otherwise("content_mention").alias("match_kind"))


def pollution_summary(hits: DataFrame) -> DataFrame:
    """One row: whether the store is polluted (a session field is a key), field hits and mentions."""
    fields = F.count_if(F.col("match_kind") == "session_field")
    return hits.agg((fields > 0).alias("polluted"), fields.alias("field_hits"), F.count_if(F.col("match_kind") != "session_field").alias("mentions"))


def coverage(rows: DataFrame, index: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Per group: rows, rows that join the index (with its repeats), and rows whose key it holds."""
    entries = index.groupBy(key).agg(F.count("*").alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    return rows.join(entries, key, "left").groupBy(*by).agg(F.count("*").alias("n"), F.sum(n).alias("joined"), F.count_if(n > 0).alias("covered"))


def live_verify(l0: DataFrame, l1: DataFrame, l1_index: DataFrame, key: str = "record_id") -> DataFrame:
    """One row: counts, index coverage and whether the store passes."""
    a = l0.agg(F.count("*").alias("l0"))
    b = l1.agg(F.count("*").alias("l1"), F.count_if(F.col("embedding").isNull() | (F.octet_length("embedding") == 0)).alias("missing_embedding"))
    c = l1_index.join(l1.select(key), key, "left_semi").agg(F.count("*").alias("l1_indexed"))
    out = a.join(b, F.lit(True)).join(c, F.lit(True))
    return out.withColumn("passed", (F.col("l0") > 0) & (F.col("l1") > 0) & (F.col("l1_indexed") == F.col("l1")))


def missing_embeddings(l1: DataFrame, by: list[str]) -> DataFrame:
    """Per group: records, and those whose embedding is null or empty."""
    return l1.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("embedding").isNull() | (F.octet_length("embedding") == 0)).alias("missing"))


def session_progress(stored: DataFrame, progress: DataFrame) -> DataFrame:
    """Per session of either side: rows there, total (the store's rows, else the stated ones), offset (the total at most), and status.

    A session is completed if it is flagged so and its offset has reached a total that is not zero; running if it has an offset; else queued.
    """
    both = stored.join(progress, "session_key", "full")
    total = F.coalesce(F.nullif(F.col("l0"), F.lit(0)), F.col("total_l0"), F.lit(0))
    stated = F.coalesce("next_offset", F.lit(0))
    rows = both.select("session_key", F.coalesce("l0", F.lit(0)).alias("l0"), total.alias("total"), F.when(total > 0, F.least(stated, total)).otherwise(stated).alias("offset"), F.coalesce("completed", F.lit(False)).alias("_flag"))
    done = F.col("_flag") & ((F.col("total") == 0) | (F.col("offset") >= F.col("total")))
    return rows.withColumn("status", F.when(done, "completed").when(F.col("offset") > 0, "running").otherwise("queued")).drop("_flag")


def progress_order(sessions: DataFrame) -> DataFrame:
    """Sessions that are at work first, then queued ones, then completed ones; by offset and total, largest first, then by key."""
    return sessions.orderBy(F.col("status") == "completed", F.col("offset") == 0, F.desc("offset"), F.desc("total"), "session_key")


def progress_rollup(sessions: DataFrame, by: list[str]) -> DataFrame:
    """Per group (all of them if ``by`` is empty): sessions by status and left, rows done (offsets), total and remaining, and the share in whole percent, halves to even."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    out = sessions.groupBy(*by).agg(count("completed"), count("running"), count("queued"), F.coalesce(F.sum("offset"), F.lit(0)).alias("done"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"))
    left = F.greatest(F.col("total") - F.col("done"), F.lit(0))
    return out.withColumn("remaining", left).withColumn("percent", F.when(F.col("total") > 0, F.bround(F.col("done") * 100.0 / F.col("total"), 0)).otherwise(0.0))


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that were added, removed or changed between two snapshots."""
    a, b = before.select(key, F.struct(*columns).alias("_a")), after.select(key, F.struct(*columns).alias("_b"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return a.join(b, key, "full").select(key, change.alias("change")).where("change is not null")


def suspicious(column: str = "content") -> Column:
    return X.is_suspicious_memory(F.col(column))


def age_words(seconds: Column) -> Column:
    """An age as 5s, 5m 7s or 2h 5m ago; what lies ahead is 0s ago, and null is a dash."""
    n = F.greatest(F.floor(seconds), F.lit(0)).cast("long")
    two = lambda big, small, a, b: F.concat(F.floor(n / big).cast("string"), F.lit(a + " "), F.floor(n % big / small).cast("string"), F.lit(b + " ago"))
    return F.when(seconds.isNull(), "-").when(n < 60, F.concat(n.cast("string"), F.lit("s ago"))).when(n < 3600, two(60, 1, "m", "s")).otherwise(two(3600, 60, "h", "m"))


def latest_progress(files: DataFrame, now_ms: int, active_months: DataFrame | None = None) -> DataFrame:
    """One row over progress files' stats (name, modified_ms): the newest change and its age in words.

    ``active_months`` (month): if there are any, only files named after one of them count.
    """
    if active_months is not None:
        months = active_months.select("month").where("month <> '-'").distinct()
        if not months.isEmpty():
            files = files.withColumn("month", F.substring("name", 1, 7)).where(F.substring("name", 8, 1) == "-").join(months, "month", "left_semi")
    out = files.agg(F.max("modified_ms").alias("modified_ms"))
    return out.withColumn("age", age_words((F.lit(now_ms) - F.col("modified_ms")) / 1000))


def active_months(commands: DataFrame) -> DataFrame:
    """(month): months that running importers were started with, from their command lines."""
    month = F.regexp_extract("command", r"--month\s+(\d{4}-\d{2})", 1)
    return commands.select(month.alias("month")).where("month <> ''").distinct()


def ordered_types(records: DataFrame) -> DataFrame:
    """The histogram of types, most frequent first; equal ones by name."""
    return type_distribution(records).orderBy(F.desc("n"), "type")


def session_report(planned: DataFrame) -> DataFrame:
    """A plan's rows per session, in order of the session's key by Unicode collation."""
    return planned.groupBy("session_key").agg(F.count("*").alias("n")).orderBy(F.collate(F.col("session_key"), "UNICODE"))


def snapshot(l0: DataFrame, l1: DataFrame, files: DataFrame) -> DataFrame:
    """One row: the store's counts and its files' number, size and newest change."""
    parts = [l0.agg(F.count("*").alias("l0")), l1.agg(F.count("*").alias("l1")), files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.max("modified_ms").alias("modified_ms"))]
    return reduce(lambda a, b: a.join(b, F.lit(True)), parts)  # one row each


def samples(records: DataFrame, n: int = 20, suspicious_n: int = 50) -> DataFrame:
    """The first records in order of time and id, and the first suspicious ones cut to 240 characters, with their kind."""
    order = ["created_ms", "record_id"]
    first = records.orderBy(*order).limit(n).select(F.lit("sample").alias("kind"), "record_id", "type", "content")
    odd = records.where(suspicious()).orderBy(*order).limit(suspicious_n).select(F.lit("suspicious").alias("kind"), "record_id", "type", F.substring("content", 1, 240).alias("content"))
    return first.unionByName(odd)
