"""Queries over the driver's tables, one or more for each operator family. Noise is put into the texts by one SQL expression that both engines share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import extract
from .functions import text as X
from .functions.semantics import collapsed, epoch_ms, month_of, utf16_length
from .operators import audit, capture, dedupe, fulltext, inventory, merkle, rounds, state
from .plans import curate, seeds
from .sources import sinks
from .sources.stage import stage_path, staged
from .streaming import growing, importer
from .streaming import progress as streaming_progress

#: Decorated content: envelopes, noise, acknowledgements and repeats by conversation and turn. Valid in both dialects.
CONTENT = """CASE (conv_id * 7 + turn) % 29
 WHEN 1 THEN 'stdout ' || text
 WHEN 2 THEN 'System: switched' || chr(10) || text
 WHEN 3 THEN '[Startup context loaded by runtime] ' || text
 WHEN 4 THEN '{"type":"x","id":' || CAST(turn AS STRING) || '}'
 WHEN 5 THEN '{"type":"x","content":"hello"}'
 WHEN 6 THEN '{broken heartbeat}'
 WHEN 7 THEN 'the heartbeat ' || text
 WHEN 8 THEN '收到，' || text
 WHEN 9 THEN 'OK, ' || text
 WHEN 10 THEN '我先看 ' || text
 WHEN 11 THEN '> ' || text
 WHEN 12 THEN 'Replying to: someone' || chr(10) || text
 WHEN 13 THEN 'Conversation info (untrusted metadata): ' || text
 WHEN 14 THEN 'tool: ' || text
 WHEN 15 THEN 'Exec completed ' || text
 WHEN 16 THEN 'a <tool_use> ' || text
 WHEN 17 THEN '/reset ' || text
 WHEN 18 THEN 'NO_REPLY'
 WHEN 19 THEN 'x'
 WHEN 20 THEN ''
 WHEN 21 THEN '[[reply_to_current]] ' || text
 WHEN 22 THEN text || chr(10) || '```py' || chr(10) || 'code' || chr(10) || '```'
 WHEN 23 THEN '我看一下'
 WHEN 24 THEN 'shared text ' || CAST(conv_id % 3 AS STRING)
 WHEN 25 THEN 'shared text ' || CAST(conv_id % 3 AS STRING)
 WHEN 26 THEN '<user-persona>secret' || chr(10) || 'self</user-persona>' || text || '\u00a0\u3000'
 WHEN 27 THEN '[media attached: pic] ' || text
 ELSE text END"""

MESSAGES = {
    "conv_id": "conv_id",
    "role": "CASE WHEN (conv_id * 5 + turn) % 11 = 0 THEN CASE role WHEN 'user' THEN 'assistant' ELSE 'user' END ELSE role END",
    "content": CONTENT,
    "ts_ms": "1704067200000 + conv_id * 86400000 + (turn + 1) * 60000",
    "line_no": "turn + 1",
    "seq": "conv_id * 1000 + turn",
    "session_key": "'agent:a' || CAST(conv_id % 5 AS STRING) || ':' || CAST(conv_id AS STRING)",
    "session_id": "CAST(conv_id AS STRING)",
    "source_type": "CASE WHEN conv_id % 3 = 0 THEN 'discord' ELSE 'agent:x' END",
    "file": "'f' || lpad(CAST(conv_id AS STRING), 9, '0')",
}
KEPT_ROLES = "role IN ('user', 'assistant')"
#: What a store holds of them: some texts were edited.
LIVE = MESSAGES | {"content": f"CASE WHEN (conv_id + turn) % 5 = 0 THEN 'edited ' || ({CONTENT}) ELSE {CONTENT} END"}
#: Plain content for curation: noise, progress, repeats within and across sessions; no envelopes.
PLAIN = """CASE (conv_id * 7 + turn) % 8
 WHEN 1 THEN 'stdout ' || text
 WHEN 2 THEN 'shared text ' || CAST(conv_id % 3 AS STRING)
 WHEN 3 THEN 'shared text ' || CAST(turn % 2 AS STRING)
 WHEN 4 THEN '我看一下'
 WHEN 5 THEN 'OK, ' || text
 ELSE text END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str, columns: dict[str, str] = MESSAGES) -> DataFrame:
    """Conversations as canonical messages; some turns change sides so that orphans and unpaired users occur."""
    rows = table(spark, sf_dir, "conversations").where(KEPT_ROLES)
    return rows.selectExpr(*(f"{expr} AS {name}" for name, expr in columns.items()))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages of their source: many repeats within and across scopes."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("source").alias("scope"), F.when(F.col("doc_id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("text").alias("content"))
    return docs.withColumn("content_hash", X.content_hash(F.col("content")))


def hashed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and hashes alone, as a stored stage: duplicates are judged from these, and the patterns run once a text."""
    return staged(document_messages(spark, sf_dir).drop("content"), "hashes")


#: A run log's lines.
LINE = """CASE conv_id % 6
 WHEN 0 THEN '{"sessionKey":"' || session_key || '","n":1}'
 WHEN 1 THEN 'note about ' || session_key || ' here'
 WHEN 2 THEN 'see /x/' || session_key || ':5/log, or ' || session_key || '.'
 WHEN 3 THEN '{"metadata":{"session_key":"' || session_key || '"},"text":"before ' || session_key || '0"}'
 WHEN 4 THEN '关于' || session_key || '的记录@+'
 ELSE 'nothing' END"""
#: A line of a conversation's file.
LINE_TEXT = "role || ' ' || CAST(line_no AS STRING) || ' ' || md5(content)"
#: What customers state of their progress.
STATED = {
    "session_key": "CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 20000000 ELSE c_custkey END",
    "total_l0": "CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey % 17 + 3 END",
    "next_offset": "c_custkey % 19",
    "completed": "c_custkey % 2 = 0",
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- rounds, months, inventory, batches


@query
def q_strict_rounds(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumn("dedupe_key", F.concat_ws("|", "session_key", "content"))
    return rounds.round_sizes(rounds.strict_rounds(rows))


@query
def q_round_replies(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumn("dedupe_key", F.concat_ws("|", "session_key", "content"))
    return rounds.round_replies(rounds.strict_rounds(rows))


@query
def q_month_bucket(spark, sf_dir):
    return messages(spark, sf_dir).groupBy(month_of(F.col("ts_ms")).alias("month")).agg(F.count("*").alias("n"))


@query
def q_role_filter(spark, sf_dir):
    return table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant")).groupBy("role").agg(F.count("*").alias("n"), F.count_distinct("conv_id").alias("conversations"))


def judged(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumn("month", month_of(F.col("ts_ms")))
    return rows.withColumn("reject", X.reject_reason(F.col("role"), F.col("content"))).withColumn("dirty", F.col("content").startswith("["))


@query
def q_inventory(spark, sf_dir):
    return inventory.inventory(judged(spark, sf_dir))


@query
def q_month_rollup(spark, sf_dir):
    return inventory.month_rollup(inventory.inventory(judged(spark, sf_dir)), ["2023-12", "2024-01"])


@query
def q_batch_page(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumn("dedupe_key", F.concat_ws("|", "session_key", "content")).withColumn("month", month_of(F.col("ts_ms")))
    kept = rounds.strict_rounds(rows).where("reject is null and role = 'user'").select("month", "file", "round_id")
    files = rows.groupBy("month", "file", "source_type").agg(F.count("*").alias("message_count"))
    return inventory.page_rounds(kept, files, 10, 2).select("month", "file", "round_id", "place")


# ---------------------------------------------------------------- text


@query
def q_normalize_hash(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.normalised_content(F.col("content")).alias("normalised"), X.content_hash(F.col("content")).alias("content_hash"))


@query
def q_normalize_hash_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.content_hash(F.col("text")).alias("content_hash"))


@query
def q_dedupe_key(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.dedupe_key(F.col("session_key"), F.col("role"), F.col("ts_ms"), F.col("content")).alias("dedupe_key"), X.fallback_key(F.col("role"), F.col("ts_ms"), F.col("content")).alias("fallback_key"))


@query
def q_sanitize(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.sanitised(F.col("content")).alias("clean"))


@query
def q_strip_code(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.captured_content(F.col("role"), F.col("content")).alias("captured"))


@query
def q_utf16_length(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", utf16_length(F.concat("content", F.lit("😀"))).cast("bigint").alias("units"), collapsed(F.col("content")).alias("flat"))


@query
def q_timestamp_forms(spark, sf_dir):
    form = F.when(F.col("conv_id") % 3 == 0, F.floor(F.col("ts_ms") / 1000).cast("string")).when(F.col("conv_id") % 3 == 1, F.col("ts_ms").cast("string")).otherwise(F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return messages(spark, sf_dir).select("conv_id", "line_no", epoch_ms(form).alias("ts_ms"))


@query
def q_content_flatten(spark, sf_dir):
    """Content as a string, an array of parts with a tool part, or an object, by turn."""
    text = F.to_json(F.struct(F.col("content").alias("c")))
    quoted = text.substr(F.lit(6), F.length(text) - 6)
    shape = F.when(F.col("line_no") % 3 == 0, quoted).when(F.col("line_no") % 3 == 1, F.concat(F.lit('["a",{"type":"text","text":'), quoted, F.lit('},{"type":"tool_use","content":"no"}]'))).otherwise(F.concat(F.lit('{"text":'), quoted, F.lit("}")))
    return messages(spark, sf_dir).select("conv_id", "line_no", extract.content_text(F.try_parse_json(shape)).alias("flat"))


@query
def q_envelope_strip(spark, sf_dir):
    fence = F.concat(F.lit("Conversation info (untrusted metadata):\n```json\n{\"message_id\":\"m"), F.col("conv_id").cast("string"), F.lit('"}\n```\n'))
    rows = messages(spark, sf_dir).withColumn("content", F.when(F.col("line_no") % 2 == 0, F.concat(fence, F.lit("body "), F.col("line_no").cast("string"))).otherwise(F.concat(F.lit("body "), F.col("line_no").cast("string"))))
    out = extract.strip_envelopes(rows)
    return out.select("conv_id", "line_no", "content", F.array_join("dirty_flags", ",").alias("flags"), F.array_join(extract.stripped_reasons(F.col("dirty_flags")), ",").alias("reasons"), "message_id")


# ---------------------------------------------------------------- rules


@query
def q_noise_class(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.noise_class(F.col("content")).alias("label"))


@query
def q_reject_reason(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.reject_reason(F.col("role"), F.col("content")).alias("reason"))


@query
def q_reject_summary(spark, sf_dir):
    return judged(spark, sf_dir).groupBy("role", F.coalesce("reject", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@query
def q_progress_update(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.is_progress_update(F.col("content")).alias("progress"))


@query
def q_framework_noise(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.is_framework_noise(F.col("content")).alias("noise"))


@query
def q_filter_reason(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", "line_no", X.filter_reason(X.captured_content(F.col("role"), F.col("content"))).alias("reason"))


@query
def q_suspicious(spark, sf_dir):
    return messages(spark, sf_dir).where(audit.suspicious()).select("conv_id", "line_no", "content")


# ---------------------------------------------------------------- duplicates


@query
def q_dedupe_source(spark, sf_dir):
    return dedupe.source_duplicates(hashed_documents(spark, sf_dir)).select("seq", "source_first")


@query
def q_dedupe_batch_warn(spark, sf_dir):
    return dedupe.batch_duplicates_warned(hashed_documents(spark, sf_dir)).select("seq", "batch_previous")


@query
def q_dedupe_batch_reject(spark, sf_dir):
    return dedupe.batch_duplicates_rejected(hashed_documents(spark, sf_dir)).select("seq", "verdict", "duplicate_of")


@query
def q_dup_surplus(spark, sf_dir):
    return dedupe.duplicate_surplus(document_messages(spark, sf_dir))


@query
def q_top_duplicates(spark, sf_dir):
    return dedupe.top_duplicates(document_messages(spark, sf_dir).withColumn("normalised", X.normalised_content(F.col("content"))))


# ---------------------------------------------------------------- capture and import


def expected(spark, sf_dir, columns=MESSAGES):
    return capture.expected_capture(messages(spark, sf_dir, columns))


def both_captures(spark, sf_dir):
    """What capture keeps of the messages, and what the store holds; each computed once."""
    return staged(expected(spark, sf_dir), "expected"), staged(expected(spark, sf_dir, LIVE), "live")


@query
def q_capture_split(spark, sf_dir):
    return capture.capture_counts(expected(spark, sf_dir))


@query
def q_planned_rows(spark, sf_dir):
    return capture.planned_rows(expected(spark, sf_dir)).select("conv_id", "line_no", "record_id", F.col("chars").cast("bigint").alias("chars"), "compare_key")


@query
def q_compare_multiset(spark, sf_dir):
    return capture.compare_multisets(*both_captures(spark, sf_dir), "compare_key")


@query
def q_relaxed_compare(spark, sf_dir):
    raw, live = (rows.withColumn("role_hash", F.concat_ws(":", "role", "hash")) for rows in both_captures(spark, sf_dir))
    return capture.multiset_difference(raw, live, "role_hash")


@query
def q_dataset_hash(spark, sf_dir):
    return capture.dataset_hash(expected(spark, sf_dir), by=["session_key"])


@query
def q_dataset_digest(spark, sf_dir):
    return capture.dataset_digest(expected(spark, sf_dir), by=["role"])


@query
def q_merkle_roots(spark, sf_dir):
    """The root of each role's tree over the captured messages' keys."""
    return merkle.tree(expected(spark, sf_dir), by=["role"], digits=2).roots()


@query
def q_merkle_difference(spark, sf_dir):
    """Keys that only one of two captures holds, from the leaves in which their trees differ."""
    raw, live = (merkle.tree(rows, digits=3) for rows in both_captures(spark, sf_dir))
    return merkle.difference(raw, live)


@query
def q_compare_report(spark, sf_dir):
    """Missing and extra keys with their first samples, as text."""
    raw, live = (merkle.tree(rows, digits=3) for rows in both_captures(spark, sf_dir))
    shown = F.array_join(F.transform("samples", lambda s: F.concat(s["key"], F.lit("="), s["delta"].cast("string"))), ";")
    return merkle.comparison(raw, live).withColumn("samples", shown)


@query
def q_existing_keys(spark, sf_dir):
    planned, live = (rows.select("compare_key") for rows in both_captures(spark, sf_dir))
    return planned.join(live, "compare_key", "left_semi").distinct()


@query
def q_missing_keys(spark, sf_dir):
    planned, live = (rows.select("compare_key") for rows in both_captures(spark, sf_dir))
    return planned.join(live, "compare_key", "left_anti").distinct()


@query
def q_session_counts(spark, sf_dir):
    return expected(spark, sf_dir).where("filter_reason is null").groupBy("session_key").agg(F.count("*").alias("n"))


@query
def q_import_gate(spark, sf_dir):
    """A store that held documents gets the messages, some of them edited."""
    planned, live = (rows.select("compare_key") for rows in both_captures(spark, sf_dir))
    before = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("compare_key"))
    return state.import_gate(planned, before, before.unionByName(live), 0, fts_after=before.unionByName(planned).unionByName(live))


@query
def q_accept_existing(spark, sf_dir):
    planned, live = (rows.select("compare_key") for rows in both_captures(spark, sf_dir))
    return state.accept_existing(planned, live, planned, 0)


def imported(spark, sf_dir):
    """A store that got the even conversations, then the odd ones, and refused the even ones a second time."""
    planned = staged(capture.planned_rows(staged(expected(spark, sf_dir), "expected")).select("conv_id", "record_id", "session_key", "session_id", "role", "captured", "ts_ms", "compare_key"), "planned")
    store = importer.open_store(spark, stage_path(spark, "store"))
    for k, batch in enumerate(("batch-001", "batch-002", "batch-003")):
        importer.import_batch(store, planned.where(F.col("conv_id") % 2 == k % 2), "2024-01", batch)
    return store


@query
def q_import_published(spark, sf_dir):
    """What readers of the store's newest version see: rows joined with their index."""
    store = imported(spark, sf_dir)
    return store.read("rows").join(store.read("index").select("record_id", "fts_text"), "record_id").select("record_id", "session_key", "role", "ts_ms", "message_text", "fts_text", "compare_key")


@query
def q_import_journal(spark, sf_dir):
    """The last phase of each import, and the planned rows of its first one."""
    entries = imported(spark, sf_dir).journals()
    planned = entries.where("phase = 'planned'").select("batch", F.col("facts")["planned"].cast("bigint").alias("planned"), F.col("facts")["accepted_total"].cast("bigint").alias("accepted_before"))
    return state.latest_phase(entries, ["batch"]).select("batch", "seq", "phase").join(planned, "batch")


@query
def q_runtime_estimate(spark, sf_dir):
    n = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return n.select("source", *state.estimate_seconds(F.col("n")))


# ---------------------------------------------------------------- audit


@query
def q_input_quality(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumn("content_hash", X.content_hash(F.col("content"))).withColumn("source_key", F.concat_ws("|", "session_id", F.substring("content", 1, 3)))
    return audit.quality(rows)


@query
def q_overlap(spark, sf_dir):
    rows = hashed_documents(spark, sf_dir).select(F.col("seq"), F.concat(F.lit("k"), F.col("seq") % 300).alias("source_key"), F.when(F.col("content_hash") == "", "").otherwise(F.concat_ws(":", "role", "content_hash")).alias("role_hash"), F.concat(F.lit("file"), F.col("seq") % 4).alias("file"))
    # Earlier inputs: other source keys, and some roles exchanged.
    role = F.when(F.col("seq") % 4 == 3, F.col("role_hash")).otherwise(F.concat(F.lit("earlier "), "role_hash"))
    earlier = rows.select(F.concat(F.lit("k"), F.col("seq") % 700 + 150).alias("source_key"), F.when(F.col("role_hash") == "", "").otherwise(role).alias("role_hash"), "file")
    return audit.overlap(rows, earlier)


@query
def q_type_distribution(spark, sf_dir):
    return audit.type_distribution(l1_records(spark, sf_dir))


@query
def q_progress_ages(spark, sf_dir):
    """Ages of events in words, as of one moment; some lie ahead of it."""
    seconds = F.when(F.col("event_id") % 50 != 7, F.col("event_id") % 20000 - 500)
    return table(spark, sf_dir, "events").select("event_id", audit.age_words(seconds).alias("age"))


@query
def q_session_report(spark, sf_dir):
    return audit.session_report(expected(spark, sf_dir).where("filter_reason is null"))


@query
def q_output_top_duplicates(spark, sf_dir):
    """The store's most frequent repeated contents."""
    rows = staged(messages(spark, sf_dir).withColumn("normalised", X.normalised_content(F.col("content"))).withColumn("content_hash", X.content_hash(F.col("content"))).select("seq", "content_hash", "normalised"), "hashes")
    return dedupe.top_duplicates(rows)


@query
def q_length_stats(spark, sf_dir):
    return audit.length_stats(l1_records(spark, sf_dir))


def log_lines(spark, sf_dir):
    """Lines of JSON with session fields, lines that mention keys in paths, at ends of sentences and within longer words, and lines without either."""
    return messages(spark, sf_dir).selectExpr("file", "line_no", f"{LINE} AS line")


def wanted_keys(spark, sf_dir):
    return messages(spark, sf_dir).select(F.col("session_key").alias("key"))


@query
def q_key_hits(spark, sf_dir):
    return audit.key_hits(log_lines(spark, sf_dir), wanted_keys(spark, sf_dir))


@query
def q_pollution(spark, sf_dir):
    return audit.pollution(log_lines(spark, sf_dir), wanted_keys(spark, sf_dir)).select("file", "line_no", "key", "match_kind")


@query
def q_log_warnings(spark, sf_dir):
    phrase = F.element_at(F.array(*map(F.lit, ["LLM extraction failed", "Embedding FAILED now", "metadata-only write", "a Safety valve", "fine", "Background embedding failed; metadata-only"])), (F.col("event_id") % 6 + 1).cast("int"))
    per = table(spark, sf_dir, "events").select("event_type", *X.log_warning_counts(phrase))
    names = [c for c in per.columns if c != "event_type"]
    return per.groupBy("event_type").agg(*(F.sum(c).alias(c) for c in names))


@query
def q_snapshot_compare(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    after = docs.selectExpr("CASE WHEN doc_id % 10 = 1 THEN -doc_id ELSE doc_id END AS doc_id", "source", "CASE WHEN doc_id % 10 = 2 THEN n_chars + 1 ELSE n_chars END AS n_chars")
    return audit.snapshot_changes(docs, after, "doc_id", ["source", "n_chars"])


# ---------------------------------------------------------------- coverage, progress and state


def l1_records(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kind = F.when(F.col("toxic") == 1, "warning").when(F.col("quality") == 1, "fact").otherwise("")
    return docs.join(labels, "doc_id").select(F.col("doc_id").alias("record_id"), kind.alias("type"), F.col("source").alias("session_key"), F.col("text").alias("content"))


@query
def q_fts_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "source")
    index = docs.selectExpr("CASE WHEN record_id % 10 = 0 THEN -record_id - 1 ELSE record_id END AS record_id").unionByName(docs.selectExpr("CASE WHEN record_id % 7 = 0 THEN record_id ELSE -record_id - 1 END AS record_id"))
    return audit.coverage(docs, index, "record_id", ["source"])


def document_postings(spark, sf_dir):
    return fulltext.postings(table(spark, sf_dir, "documents"), {}, "doc_id", "text")


@query
def q_fts_terms(spark, sf_dir):
    """The index's terms over all documents: records and occurrences."""
    return fulltext.term_counts(document_postings(spark, sf_dir))


@query
def q_fts_search(spark, sf_dir):
    """Documents that hold all of two terms, from an index in which frequent terms are dealt over salts."""
    path = stage_path(spark, "index")
    fulltext.write_index(document_postings(spark, sf_dir), path, "doc_id", most=200)
    return fulltext.search(spark, path, ["the", "of"], "doc_id")


@query
def q_index_text(spark, sf_dir):
    """Messages' index text with a small dictionary; Han words by the likeliest path."""
    words = {"收到": 50, "我": 90, "先看": 30, "看": 60, "一下": 40, "看一下": 20, "我看": 5}
    return messages(spark, sf_dir).select("conv_id", "line_no", fulltext.index_text(spark, words)(F.col("content")).alias("terms"))


@query
def q_vec_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "lang")
    return audit.coverage(docs, table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("record_id")), "record_id", ["lang"])


@query
def q_live_verify(spark, sf_dir):
    l0 = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"))
    return audit.live_verify(l0, with_embedding(spark, sf_dir), l0.selectExpr("CASE WHEN record_id % 2 = 0 THEN record_id ELSE -record_id END AS record_id"))


def with_embedding(spark, sf_dir):
    return l1_records(spark, sf_dir).withColumn("embedding", F.when(F.col("record_id") % 5 == 0, F.lit(None)).when(F.col("record_id") % 5 == 1, F.lit("")).otherwise(F.lit("x")).cast("binary"))


@query
def q_missing_embedding(spark, sf_dir):
    return audit.missing_embeddings(with_embedding(spark, sf_dir), ["type"])


def progress_sessions(spark, sf_dir):
    """Orders as a store's rows, customers as the stated progress; some keys of either side are not in the other."""
    stored = table(spark, sf_dir, "orders").groupBy(F.expr("CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 10000000 ELSE o_custkey END").alias("session_key")).agg(F.count("*").alias("l0"))
    progress = table(spark, sf_dir, "customer").selectExpr(*(f"{e} AS {n}" for n, e in STATED.items()))
    return audit.session_progress(stored, progress)


@query
def q_session_progress(spark, sf_dir):
    return progress_sessions(spark, sf_dir)


def progress_events(spark, sf_dir):
    """Orders as stored rows and customers as statements, in one stage with a file for each task; earlier statements of a session are older ones."""
    rows = table(spark, sf_dir, "orders").selectExpr("CAST(CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS STRING) AS session_key", "1L AS n", "CAST(NULL AS BIGINT) AS seq", "CAST(NULL AS BIGINT) AS total_l0", "CAST(NULL AS BIGINT) AS next_offset", "CAST(NULL AS BOOLEAN) AS completed")
    stated = table(spark, sf_dir, "customer").selectExpr(*(f"CAST({STATED[n]} AS {t}) AS {n}" for n, t in (("session_key", "STRING"), ("total_l0", "BIGINT"), ("next_offset", "BIGINT"), ("completed", "BOOLEAN"))))
    older = stated.selectExpr("session_key", "CAST(NULL AS BIGINT) AS n", "1L AS seq", "99L AS total_l0", "1L AS next_offset", "true AS completed")
    newer = stated.selectExpr("session_key", "CAST(NULL AS BIGINT) AS n", "2L AS seq", "total_l0", "next_offset", "completed")
    return staged(rows.unionByName(newer).unionByName(older), "events")


@query
def q_stream_progress(spark, sf_dir):
    """The same facts as events, half of the files at a time through a stream that keeps a cursor for each session."""
    files = progress_events(spark, sf_dir).inputFiles()
    source = spark.readStream.schema(streaming_progress.EVENTS).option("maxFilesPerTrigger", (len(files) + 1) // 2).parquet(files[0].rsplit("/", 1)[0])
    out = stage_path(spark, "progress")
    streaming_progress.keep_states(source, f"{out}/states", f"{out}/checkpoint").awaitTermination()
    return streaming_progress.latest_progress(spark, f"{out}/states").withColumn("session_key", F.col("session_key").cast("bigint"))


@query
def q_dashboard_month(spark, sf_dir):
    return audit.progress_rollup(progress_sessions(spark, sf_dir).withColumn("month", F.concat(F.lit("2024-0"), F.col("session_key") % 9 + 1)), ["month"])


@query
def q_dashboard_total(spark, sf_dir):
    return audit.progress_rollup(progress_sessions(spark, sf_dir), [])


@query
def q_manifest_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("batch_id"), F.col("o_orderstatus").alias("status"))
    new = orders.selectExpr("CASE WHEN batch_id % 3 = 0 OR batch_id % 5 = 0 THEN batch_id ELSE -batch_id END AS batch_id", "'accepted' AS status")
    return state.upsert(orders, new, ["batch_id"])


@query
def q_index_merge(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.selectExpr("CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey", "c_mktsegment AS mode", "c_name AS report")
    new = c.select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, "execute").alias("mode"), F.lit(None).cast("string").alias("report"))
    return state.merge_fields(old, new, ["c_custkey"])


@query
def q_journal_latest(spark, sf_dir):
    return state.latest_phase(table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), F.col("event_type").alias("phase"), "value"), ["user_id"])


# ---------------------------------------------------------------- curation and its inputs


def transcript_lines(spark, sf_dir):
    """Conversations as transcript lines of both kinds, with plain content."""
    m = messages(spark, sf_dir, MESSAGES | {"content": PLAIN})
    said = F.when(F.col("source_type") == "discord", F.to_json(F.struct("role", "content", F.col("ts_ms").alias("ts"), F.col("line_no").alias("message_id"), F.lit("a").alias("author"))))
    line = said.otherwise(F.to_json(F.struct(F.struct("role", "content", F.lit("m1").alias("model")).alias("message"), F.col("ts_ms").alias("timestamp"), F.col("line_no").alias("id"))))
    return m.select("file", "line_no", "source_type", "session_id", "session_key", line.alias("line"))


@query
def q_stream_lines(spark, sf_dir):
    """A file of lines for each conversation, read by the stream over growing files."""
    out = stage_path(spark, "growing")
    lines = messages(spark, sf_dir).selectExpr("conv_id", "line_no", f"{LINE_TEXT} AS line")
    dealt = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id").sortWithinPartitions("conv_id", "line_no")
    sinks.write_line_files(dealt.select(F.concat(F.lit("conv_id="), "conv_id", F.lit(".txt")).alias("file"), "line"), f"{out}/files")
    stream = growing.growing_lines(spark, f"{out}/files", suffix=".txt")
    stream.writeStream.format("parquet").option("path", f"{out}/lines").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    read = spark.read.schema("file string, line_no bigint, line string").parquet(f"{out}/lines")
    return read.select(F.regexp_extract("file", "conv_id=(-?[0-9]+)", 1).cast("bigint").alias("conv_id"), "line_no", "line")


@query
def q_rejects(spark, sf_dir):
    rows = curate.curate(transcript_lines(spark, sf_dir), reject_batch_duplicates=True).rejects
    return rows.select("reason", "file", "line_no", "role", "duplicate_scope", "duplicate_of")


@query
def q_rejects_warned(spark, sf_dir):
    rows = curate.curate(transcript_lines(spark, sf_dir)).rejects
    return rows.select("reason", "file", "line_no", "role", "duplicate_scope", "duplicate_of")


@query
def q_seed_sessions_nested(spark, sf_dir):
    """The nested seed, flattened again: a row per session with its rounds, messages and a digest of the contents in order."""
    seed = curate.seed_sessions(curate.curate(transcript_lines(spark, sf_dir)).messages, "2024-01")
    flat = F.flatten("conversations")
    return seed.select("sessionKey", F.size("conversations").cast("bigint").alias("rounds"), F.size(flat).cast("bigint").alias("messages"), F.md5(F.array_join(F.transform(flat, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n").cast("binary")).alias("digest"))


@query
def q_seed_page(spark, sf_dir):
    """The second page of three rounds of a month, with what its document's metadata say."""
    page = seeds.seed_page(transcript_lines(spark, sf_dir), "2024-01", 3, 2)
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    of = {k: page.metadata[k] for k in ("rangeStartRound", "rangeEndRound", "totalAvailableRounds")}
    return page.rounds.select("sessionKey", F.col("sourceFile").alias("file"), "place", F.size("messages").cast("bigint").alias("messages"), F.md5(said.cast("binary")).alias("digest"), *(F.lit(v).cast("bigint").alias(k) for k, v in of.items()))


@query
def q_input_summary(spark, sf_dir):
    seed = curate.seed_sessions(curate.curate(transcript_lines(spark, sf_dir)).messages, "2024-01")
    return inventory.input_summary(seed.select(F.array(F.struct("sessionKey", "conversations")).alias("sessions")))


@query
def q_message_metadata(spark, sf_dir):
    rows = extract.messages_of(transcript_lines(spark, sf_dir))
    entries = F.array_sort(F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return rows.select("file", "line_no", F.array_join(entries, ",").alias("metadata"))


@query
def q_output_quality(spark, sf_dir):
    rows = staged(messages(spark, sf_dir).withColumn("content_hash", X.content_hash(F.col("content"))), "hashes")
    return audit.output_quality(rows)


@query
def q_session_like(spark, sf_dir):
    key = F.concat("session_key", F.when(F.col("conv_id") % 3 == 0, ":seed:2024-01").when(F.col("conv_id") % 3 == 1, ":Seed:2024-01-x").otherwise("seed:2024-02"))
    return messages(spark, sf_dir).select("conv_id", "line_no", X.of_month(key, "2024-01").alias("of_month"), X.of_month(key, "2024-01", at_end=True).alias("at_end"))


@query
def q_planned_ids(spark, sf_dir):
    rows = expected(spark, sf_dir).withColumn("source_key", F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("s"), F.col("seq").cast("string"))))
    plan = capture.numbered_plan(capture.planned_rows(rows), "seq")
    return plan.select("ordinal", "message_id", F.get_json_object("record", "$.id").alias("record_message"), F.get_json_object("record", "$.content").alias("content"), "fts_text")


@query
def q_import_summary(spark, sf_dir):
    rows = expected(spark, sf_dir).withColumn("source_key", F.lit(None).cast("string")).withColumn("source_file", F.col("file")).withColumn("source_line", F.col("line_no") - 1)
    return capture.import_summary(capture.planned_rows(rows), "batch-001").withColumn("chars", F.col("chars").cast("bigint"))


@query
def q_pollution_summary(spark, sf_dir):
    return audit.pollution_summary(audit.pollution(log_lines(spark, sf_dir), wanted_keys(spark, sf_dir)))


@query
def q_samples(spark, sf_dir):
    """The first records and the first suspicious ones."""
    rows = messages(spark, sf_dir).select(F.col("seq").alias("record_id"), F.col("role").alias("type"), "content", F.col("ts_ms").alias("created_ms"))
    return audit.samples(rows)
