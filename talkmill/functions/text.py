"""Content normalisation, keys and the ordered rule classifiers, as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .semantics import collapsed, found, replaced, sha12, sha24, text_or_empty, trimmed, utf16_length


def normalised_content(col: Column) -> Column:
    """Content for duplicate detection: reply tags, quote marks, reply headers and acknowledging openers go, white space collapses."""
    return collapsed(reduce(replaced, fixed.NORMALISE, trimmed(text_or_empty(col))))


def content_hash(col: Column) -> Column:
    """24 hex digits of the normalised content, or '' if nothing is left of it."""
    return F.replace(sha24(normalised_content(col)), F.lit(fixed.EMPTY_SHA24), F.lit(""))  # the chain of patterns stands once


def dedupe_key(scope: Column, role: Column, ts_ms: Column, content: Column, message_id: Column | None = None) -> Column:
    """``scope:message_id:<id>`` if there is an id, else ``scope:hash:<24 hex digits>`` of role, time and collapsed content."""
    hashed = F.concat(scope, F.lit(":hash:"), sha24(F.concat(role, F.lit("\n"), ts_ms.cast("string"), F.lit("\n"), collapsed(text_or_empty(content)))))
    if message_id is None:
        return hashed
    return F.when(text_or_empty(message_id) != "", F.concat(scope, F.lit(":message_id:"), message_id)).otherwise(hashed)


def source_scope(session_key: Column, session_id: Column, path: Column) -> Column:
    """The session key, else the session id, else the path with odd characters replaced."""
    odd = F.regexp_replace(F.coalesce(F.nullif(path, F.lit("")), F.lit("unknown-source")), r"[^A-Za-z0-9_:./~=-]+", "_")
    return F.coalesce(F.nullif(session_key, F.lit("")), F.nullif(session_id, F.lit("")), odd)


def sanitised(col: Column) -> Column:
    """Content as capture keeps it: memory tags, envelopes, stamps, media notes and inline images go."""
    return trimmed(reduce(lambda c, rule: replaced(c, *rule), fixed.SANITISE, text_or_empty(col)))


def without_code_blocks(col: Column) -> Column:
    return trimmed(replaced(replaced(text_or_empty(col), fixed.CODE_BLOCK), r"\n{3,}", "\n\n"))


def captured_content(role: Column, content: Column) -> Column:
    clean = sanitised(content)
    return F.when(role == "assistant", without_code_blocks(clean)).otherwise(clean)


def _case(rules: list[tuple[Column, Column]]) -> Column:
    """The value of the first rule whose condition holds, else null."""
    out = F
    for condition, value in rules:
        out = out.when(condition, value)
    return out


def _noise_rules(t: Column) -> list[tuple[Column, Column]]:
    rules = [(t == "", F.lit("empty"))]
    for label, must, must_not in fixed.NOISE:
        hits = [found(t, p) for p in must] + [~found(t, p) for p in must_not]
        rules.append((reduce(lambda a, b: a & b, hits), F.lit(label)))
    return rules


def noise_class(col: Column) -> Column:
    """The label of runtime or system noise, or null."""
    return _case(_noise_rules(trimmed(text_or_empty(col))))


def has_residual_envelope(col: Column) -> Column:
    return found(text_or_empty(col), fixed.RESIDUAL)


def is_likely_human(col: Column) -> Column:
    t = trimmed(text_or_empty(col))
    return noise_class(col).isNull() & ~found(t, fixed.RESIDUAL) & ~found(t, fixed.DATED_BRACKET)


def reject_reason(role: Column, content: Column) -> Column:
    """Why a message is not kept, or null. Text in braces that is not JSON is kept at once."""
    t = trimmed(text_or_empty(content))
    value = F.try_parse_json(t)
    envelope = reduce(lambda a, b: a | b, (F.coalesce(F.array_contains(F.json_object_keys(t), k), F.lit(False)) for k in fixed.JSON_ENVELOPE_KEYS))
    has_text = reduce(lambda a, b: a | b, (F.coalesce(F.schema_of_variant(F.try_variant_get(value, f"$.{k}", "variant")) == "STRING", F.lit(False)) for k in fixed.JSON_TEXT_KEYS))
    like = found(t, fixed.JSON_LIKE)
    first, *noise = _noise_rules(t)
    return _case(
        [first, (utf16_length(t) < 2, F.lit("too_short")), *noise, (found(t, fixed.RESIDUAL), F.lit("metadata_envelope_residual")), ((role == "user") & found(t, fixed.DATED_BRACKET), F.lit("not_human_user_message"))]
        + [(found(t, p), F.lit(label)) for label, p in fixed.REJECT_BEFORE_JSON]
        + [(like & value.isNull(), F.lit(None).cast("string")), (like & envelope & ~has_text, F.lit("json_envelope_metadata"))]
        + [(found(t, p), F.lit(label)) for label, p in fixed.REJECT_AFTER_JSON]
    )


def is_progress_update(col: Column) -> Column:
    """Whether an assistant's text only announces work."""
    t = collapsed(text_or_empty(col))
    size, done = utf16_length(t), found(t, fixed.COMPLETED)
    final = found(t, fixed.FINAL_SIGNAL[0]) | found(t, fixed.FINAL_SIGNAL[1])
    rules = [
        (t == "", F.lit(False)),
        (found(t, fixed.PROGRESS_ALWAYS), F.lit(True)),
        (found(t, fixed.PROGRESS_OPENERS) & (size <= 220) & ~done, F.lit(True)),
        (found(t, fixed.ACKNOWLEDGED) & (size <= 260) & ~done, F.lit(True)),
        (final, F.lit(False)),
        *((found(t, p) & (size <= most), F.lit(True)) for p, most in fixed.PROGRESS_SHORT),
    ]
    return F.coalesce(_case(rules), F.lit(False))


def is_suspicious_memory(col: Column) -> Column:
    return found(text_or_empty(col), fixed.SUSPICIOUS[0]) | found(text_or_empty(col), fixed.SUSPICIOUS[1])


def is_framework_noise(col: Column) -> Column:
    t = trimmed(text_or_empty(col))
    return reduce(lambda a, b: a | b, (found(t, p) for p in fixed.FRAMEWORK))


def filter_reason(col: Column) -> Column:
    """Why capture drops a row, or null if it keeps it."""
    t = text_or_empty(col)
    return _case([(trimmed(t) == "", F.lit("empty after sanitize/stripCodeBlocks")), (is_framework_noise(t), F.lit("framework noise")), (t.startswith("/"), F.lit("slash command"))])


def compare_key(session_key: Column, role: Column, ts_ms: Column, hash_: Column) -> Column:
    return F.concat_ws("\t", session_key, role, F.coalesce(ts_ms, F.lit(0)).cast("string"), hash_)


def relaxed_key(session_key: Column, role: Column, hash_: Column) -> Column:
    return F.concat_ws("\t", session_key, role, hash_)


def fallback_key(role: Column, ts_ms: Column, content: Column) -> Column:
    return F.concat_ws("\t", text_or_empty(role), text_or_empty(F.nullif(ts_ms.cast("string"), F.lit("0"))), collapsed(text_or_empty(content)))


def stable_record_id(session_key: Column, role: Column, ts_ms: Column, hash_: Column) -> Column:
    return F.concat(F.lit("l0_"), sha12(F.concat_ws("|", session_key, role, ts_ms.cast("string"), hash_)))


def log_warning_counts(col: Column) -> list[Column]:
    from .semantics import java

    return [F.regexp_count(text_or_empty(col), F.lit(java(p))).cast("long").alias(name) for name, p in fixed.LOG_WARNINGS]


def of_month(session_key: Column, month: str, at_end: bool = False) -> Column:
    """Whether a session key is that of a month's seed: ``seed:<month>`` anywhere in it, or ``:seed:<month>`` at its end; letters in either case."""
    return session_key.ilike(f"%:seed:{month}" if at_end else f"%seed:{month}%")
