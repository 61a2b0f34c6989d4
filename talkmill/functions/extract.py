"""Messages from transcript lines: roles, times, content of any JSON shape, and the envelopes around user text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .semantics import epoch_ms, extracted, found, month_of, replaced, text_or_empty, trimmed
from .text import noise_class

ENV = fixed.ENVELOPE


def content_text(v: Column) -> Column:
    """Text of a content variant: a string; an array of strings and parts joined by line feeds (tool parts count as empty); an object's text or content."""
    kind = F.schema_of_variant(v)
    get = lambda x, name: F.try_variant_get(x, f"$.{name}", "string")
    is_string = lambda x, name: F.schema_of_variant(F.try_variant_get(x, f"$.{name}", "variant")) == "STRING"

    def part(x: Column) -> Column:
        tool = F.coalesce(get(x, "type").isin("tool_use", "tool_result"), F.lit(False))
        return (
            F.when(F.schema_of_variant(x) == "STRING", x.cast("string"))
            .when((get(x, "type") == "text") & is_string(x, "text"), get(x, "text"))
            .when(is_string(x, "content") & ~tool, get(x, "content"))
            .otherwise("")
        )

    parts = F.array_join(F.transform(F.try_variant_get(v, "$", "array<variant>"), part), "\n")
    text = F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind.startswith("ARRAY"), parts).when(is_string(v, "text"), get(v, "text")).when(is_string(v, "content"), get(v, "content"))
    return trimmed(text_or_empty(text))


def _object(json: Column) -> Column:
    """The entries of a JSON object as text; none for what is no object."""
    return F.coalesce(F.map_entries(F.from_json(json, "map<string,string>")), _no_entries())


def _entry(name: str, value: Column) -> Column:
    return F.array(F.struct(F.lit(name).alias("key"), value.alias("value")))


def _no_entries() -> Column:
    return F.array().cast("array<struct<key:string,value:string>>")


def as_map(entries: Column) -> Column:
    """A map of entries, without those that are null or empty; of those with equal keys the last counts."""
    later = lambda i: F.transform(F.slice(entries, i + 2, F.size(entries)), lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(later(i), e["key"]))
    return F.map_from_entries(F.filter(last, lambda e: F.coalesce(e["value"], F.lit("")) != ""))


def strip_envelopes(df: DataFrame, text: str = "content", role: str = "role", queued_parts: bool = False) -> DataFrame:
    """Replaces ``text`` by what its sender wrote and adds ``dirty_flags``, ``metadata`` (of the envelopes, later ones count) and its ``message_id``.

    Envelopes go one after another from the start of the text; an external body replaces all that stands around it. ``queued_parts``: adds
    the parts of queued messages as they stand, for ``plans.queued``, which strips them in turn.
    """
    steps = df.withColumn("_t", replaced(trimmed(text_or_empty(F.col(text))), ENV["reply_tag"])).withColumn("_flags", F.array().cast("array<string>")).withColumn("_meta", _no_entries())
    first_line = F.substring(F.split("_t", "\r?\n", 2)[0], 1, 300)
    for name, flags in (("conversation", ["metadata-envelope"]), ("system_sender", ["system-envelope", "metadata-envelope"]), ("sender", ["metadata-envelope"])):
        hit = found(F.col("_t"), ENV[name])
        fields = _object(extracted(F.col("_t"), ENV[name]))
        if name == "system_sender":
            fields = F.concat(fields, _entry("systemEnvelope", first_line))
        steps = steps.withColumns({
            "_meta": F.when(hit, F.concat("_meta", fields)).otherwise(F.col("_meta")),
            "_flags": F.when(hit, F.concat("_flags", F.array(*map(F.lit, flags)))).otherwise(F.col("_flags")),
            "_t": F.when(hit, trimmed(replaced(F.col("_t"), ENV[name]))).otherwise(F.col("_t")),
        })
    line = found(F.col("_t"), ENV["system_line"])
    steps = steps.withColumns({
        "_meta": F.when(line, F.concat("_meta", _entry("systemEnvelope", F.substring(extracted(F.col("_t"), ENV["system_line"]), 1, 300)))).otherwise(F.col("_meta")),
        "_flags": F.when(line, F.concat("_flags", F.array(F.lit("system-envelope")))).otherwise(F.col("_flags")),
        "_t": F.when(line, trimmed(extracted(F.col("_t"), ENV["system_line"], 2))).otherwise(F.col("_t")),
    })
    reply = found(F.col("_t"), ENV["replied"])
    steps = steps.withColumns({
        "_meta": F.when(reply, F.concat("_meta", _entry("repliedMessage", F.to_json(as_map(_object(extracted(F.col("_t"), ENV["replied"]))))))).otherwise(F.col("_meta")),
        "_flags": F.when(reply, F.concat("_flags", F.array(F.lit("metadata-envelope"), F.lit("reply-context")))).otherwise(F.col("_flags")),
        "_t": F.when(reply, trimmed(replaced(F.col("_t"), ENV["replied"]))).otherwise(F.col("_t")),
    })
    context = found(F.col("_t"), ENV["untrusted"])
    tail = extracted(F.col("_t"), ENV["untrusted"], 0)
    body = found(tail, ENV["body"])
    channel = F.when(context & found(tail, ENV["channel"]), F.substring(extracted(tail, ENV["channel"]), 1, 1000))
    steps = steps.withColumns({
        "_flags": F.when(context & body, F.concat("_flags", F.array(F.lit("metadata-envelope"), F.lit("external-discord-body")))).when(context, F.concat("_flags", F.array(F.lit("metadata-envelope")))).otherwise(F.col("_flags")),
        "_meta": F.when(channel.isNotNull(), F.concat("_meta", _entry("channelContext", channel))).otherwise(F.col("_meta")),
        "channel_context": channel,
        "_t": F.when(context & body, trimmed(extracted(tail, ENV["body"]))).when(context, trimmed(replaced(F.col("_t"), ENV["untrusted"]))).otherwise(F.col("_t")),
    })
    inner = trimmed(replaced(trimmed(replaced(F.col("_t"), ENV["inner_sender"], "\n")), ENV["inner_conversation"], "\n"))
    steps = steps.withColumn("_t", inner)
    # Queued messages: the header goes, then each part that is not noise stays, joined by blank lines.
    queued = (F.col(role) == "user") & found(F.col("_t"), ENV["queued"])
    chunks = F.transform(F.split(replaced(F.col("_t"), ENV["queued"]), "\n---\n"), lambda c: trimmed(replaced(trimmed(c), ENV["queued_item"])))
    parts = F.filter(chunks, lambda c: (c != "") & noise_class(c).isNull())
    joined = F.array_join(parts, "\n\n")
    if queued_parts:
        steps = steps.withColumn("queued_parts", F.when(queued, parts).otherwise(F.array().cast("array<string>")))
    steps = steps.withColumns({"_flags": F.when(queued, F.concat("_flags", F.array(F.lit("queued-envelope")))).otherwise(F.col("_flags")), "_t": F.when(queued, joined).otherwise(F.col("_t"))})
    return steps.withColumn(text, F.col("_t")).withColumn("dirty_flags", F.array_distinct("_flags")).withColumn("metadata", as_map(F.col("_meta"))).withColumn("message_id", F.col("metadata")["message_id"]).drop("_t", "_flags", "_meta")


def stripped_reasons(flags: Column) -> Column:
    """The warnings that go with a message's flags, in order."""
    return F.array_compact(F.array(*(F.when(F.array_contains(flags, flag), F.lit(reason)) for flag, reason in fixed.STRIPPED)))


def messages_of(lines: DataFrame, queued_parts: bool = False) -> DataFrame:
    """Canonical messages of transcript lines (source_type and line among their columns) with their metadata, and ``parse_error`` rows for lines that are not JSON.

    Roles other than user and assistant and rows without a time are left out, as are times of zero.
    """
    v = F.col("v")
    get = lambda path, kind="string": F.try_variant_get(v, path, kind)
    first = lambda kind, *paths: F.coalesce(*(F.try_variant_get(v, p, kind) for p in paths))
    channel = F.col("source_type") == "discord"
    parsed = lines.withColumn("v", F.try_parse_json("line"))
    typed = parsed.select(
        "*",
        v.isNull().alias("parse_error"),
        F.when(channel, get("$.role")).otherwise(first("string", "$.message.role", "$.role")).alias("role"),
        F.when(channel, get("$.content", "variant")).otherwise(first("variant", "$.message.content", "$.content", "$.message.text", "$.text")).alias("_content"),
        epoch_ms(F.when(channel, first("string", "$.ts", "$.timestamp", "$.created_at")).otherwise(first("string", "$.timestamp", "$.message.timestamp", "$.ts", "$.message.ts"))).alias("ts_ms"),
        source_metadata(v, channel).alias("_source"),
    )
    kept = typed.where(F.col("parse_error") | (F.col("role").isin("user", "assistant") & (F.coalesce("ts_ms", F.lit(0)) != 0)))
    flat = kept.withColumn("content", content_text(F.col("_content"))).drop("_content", "v")
    out = strip_envelopes(flat, queued_parts=queued_parts).withColumn("month", month_of(F.col("ts_ms")))
    ident = F.coalesce("message_id", as_map(F.col("_source"))["message_id"])
    entries = F.concat(F.col("_source"), F.map_entries("metadata"), _entry("sourceMessageId", ident))
    return out.withColumn("metadata", as_map(entries)).withColumn("message_id", ident).drop("_source")


def source_metadata(v: Column, channel: Column) -> Column:
    """What a transcript line says about its message, as entries: a channel's ids, or an agent's type, ids, provider and model; null for what is missing."""
    get = lambda *paths: F.coalesce(*(F.try_variant_get(v, p, "string") for p in paths))
    entries = lambda fields: F.concat(*(_entry(k, get(*paths)) for k, paths in fields.items()))
    return F.when(channel, entries({k: (f"$.{k}",) for k in fixed.CHANNEL_METADATA})).otherwise(entries(fixed.AGENT_METADATA))
