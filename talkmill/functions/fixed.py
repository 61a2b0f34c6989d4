"""Word lists, patterns, labels and key names that results depend on.

Patterns are written once for two dialects: ``{s}`` a white-space character as browsers define it, ``{w}`` the same inside a class,
``{S}`` any other character, ``{<}`` and ``{>}`` ASCII word boundaries before and after a word. See semantics.java and semantics.re2.
"""

from __future__ import annotations

# White space (tab to carriage return, spaces, line and paragraph separators, byte order mark).
WHITE = r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"

# The same characters as text.
WHITE_CHARS = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

# Fixed value: the first 24 hex digits of the SHA-256 of nothing.
EMPTY_SHA24 = "e3b0c44298fc1c149afbf4c8"

# Openers that content normalisation removes, in order.
NORMALISE = (
    r"(?i)^\[\[reply_to_current\]\]{s}*",
    r"(?m)^>{s}*",
    r"(?i)^(?:↪|⤷|回复|Reply(?:ing)? to|Replied message)[:：][^\n]*\n+",
    r"(?i)^{s}*(?:收到|好的|好|行|明白|可以|OK|ok)[，,。.!！{w}]+",
    r"(?i)^{s}*(?:我先|我来|我会|我把|我直接|我继续|我再|我现在|我马上)(?:先)?(?:把|来|去)?{s}*",
)

# What capture sanitising removes, in order. (pattern, replacement)
SANITISE = (
    (r"(?s)<relevant-memories>.*?</relevant-memories>", ""),
    (r"(?s)<user-persona>.*?</user-persona>", ""),
    (r"(?s)<relevant-scenes>.*?</relevant-scenes>", ""),
    (r"(?s)<scene-navigation>.*?</scene-navigation>", ""),
    (r"(?s)<current_task_context>.*?</current_task_context>", ""),
    (r"(?s)<history_task_context.*?</history_task_context>", ""),
    (r"(?s)(?:Conversation info|Sender|Thread starter|Replied message|Forwarded message context|Chat history since last reply){s}*\(untrusted.*?\):{s}*```json{s}*.*?```", ""),
    (r'(?s)```json{s}*\{.*?"session.*?\}{s}*```', ""),
    (r"\[\[reply_to[^\]]*\]\]{s}*", ""),
    (r"(?s)¥¥\[.*?\]¥¥", ""),
    (r"(?m)^\[[A-Za-z0-9_\-:+ ]+\]{s}*", ""),
    (r"\[media attached:[^\]]*\]{s}*", ""),
    (r"(?s)To send an image back,.*?(?:Keep caption in the text body\.){s}*", ""),
    (r"(?m)^System:{s}*\[(?s:.*?)$", ""),
    (r"(?i)data:image/[a-z+]+;base64,[A-Za-z0-9+/=]+", ""),
    (r"\x00", ""),
    (r"\n{3,}", "\n\n"),
)
CODE_BLOCK = r"```[^\n]*\n(?s:.*?)```"

# Noise rules, first match wins. (label, patterns that must match, patterns that must not)
NOISE = (
    ("runtime_startup_context", (r"(?i)^\[Startup context loaded by runtime\]",), ()),
    ("runtime_untrusted_daily_memory", (r"(?i)\[Untrusted daily memory:{s}*[^\]]+\]",), ()),
    ("runtime_embedded_quoted_notes", (r"(?i){<}(?:BEGIN_QUOTED_NOTES|END_QUOTED_NOTES){>}",), ()),
    ("runtime_startup_context", (r"(?i)Bootstrap files like SOUL\.md, USER\.md, and MEMORY\.md are already provided separately",), ()),
    ("system_untrusted_event", (r"(?i)^System \(untrusted\):",), ()),
    ("model_switched_event", (r"(?i)^System:", r"(?i)Model switched to"), ()),
    ("system_prompt_event", (r"(?i)^System:",), (r"\n\n{S}",)),
    ("internal_compaction_event", (r"(?i)^Pre-compaction memory flush\.",), ()),
    ("internal_session_reset_event", (r"(?i)^A new session was started via /new or /reset\.",), ()),
    ("openclaw_internal_context", (r"(?i)<<<BEGIN_OPENCLAW_INTERNAL_CONTEXT>>>",), ()),
    ("exec_completed_tool_result", (r"(?i){<}Exec completed{>}",), ()),
    ("tool_noise", (r"(?i){<}(?:tool_result|tool_use|function_call|after-tool-call|before-tool-call){>}",), ()),
    ("tool_log_or_error", (r"(?i)^{s}*(?:stdout|stderr|exit code|command failed|traceback|error:{s}+spawn){>}",), ()),
)
RESIDUAL = r"(?i)Conversation info \(untrusted metadata\)|Sender \(untrusted metadata\)|Untrusted context \(metadata"
DATED_BRACKET = r"^\[[A-Z][a-z]{2}{s}+[0-9]{4}-[0-9]{2}-[0-9]{2}{s}+[0-9]{2}:[0-9]{2}{s}+GMT[+-][0-9]+\]"

# Reject rules after noise, residue and dated brackets, first match wins. (label, pattern)
REJECT_BEFORE_JSON = (
    ("model_switched_event", r"(?i)Model switched to"),
    ("internal_acp_bootstrap", r"(?i)^\[[^\]]+\]{s}+Claude Code ACP mode - run the following task as requested by the user\."),
    ("system_or_tool_envelope", r"(?i)^(?:system|developer|tool|function){s}*:"),
    ("tool_or_system_markup", r"(?i)</?(?:tool_use|tool_result|function_call|system|developer){>}"),
    ("tool_noise", r"(?i)^{s}*(?:tool_result|tool_use|function_call|assistant_tool){>}"),
)
REJECT_AFTER_JSON = (
    ("cron_or_automation", r"(?i){<}(?:openclaw{s}+cron|cron{s}+job|scheduled{s}+task|background{s}+task|heartbeat|healthcheck){>}"),
    ("tool_log_or_error", r"(?i)^{s}*(?:stdout|stderr|exit code|command failed|traceback|error:{s}+spawn){>}"),
)
JSON_LIKE = r"(?s)^{s}*\{.*\}{s}*\z"
JSON_ENVELOPE_KEYS = ("type", "version", "id", "timestamp", "event", "tool", "metadata")
JSON_TEXT_KEYS = ("content", "text", "message")

# Progress updates of an assistant.
PROGRESS_ALWAYS = r"(?i)^我把{s}*Steam{s}*这块的现状捞出来了"
PROGRESS_OPENERS = r"(?i)^(?:我直接|我先|我来|我会|我继续|我再|我现在|我马上|在跑了|开始做|继续|等我|我看一下|我查一下|我处理一下)"
ACKNOWLEDGED = r"(?i)^(?:收到|好的|好|行|明白|可以|OK|ok)[，,。.!！{w}]+"
COMPLETED = r"(?i)(?:已经完成|完成了|跑完了|成功|失败|验证通过|###{s}*已完成|##{s}*结论|总结版|结果是(?:[:：，,。]|{s}|\z)|当前总状态)"
FINAL_SIGNAL = (
    r"(?i)(?:结论|总结版|结果是(?:[:：，,。]|{s}|\z)|已完成|已经完成|完成了|完成：|跑完|成功|失败|验证通过|验收|最终|当前总状态|清单|方案|原因|问题|风险|剩余)",
    r"(?i)(?:^|{s})(?:done|completed|success|failed|summary|result)(?:{s}|\z)",
)
#: (pattern, most UTF-16 units) of openers that count when there is no final signal. The first must be followed by an ASCII word character.
PROGRESS_SHORT = (
    (r"(?i)^(?:我先|我来|我会|我直接|我继续|我再|我现在|我马上)[A-Za-z0-9_]", 180),
    (ACKNOWLEDGED, 220),
    (r"(?i)^(?:在跑了|开始做|继续|等我|我看一下|我查一下|我处理一下)", 160),
)

# Framework noise in captured rows, and memory text that is suspicious.
FRAMEWORK = (
    r"^\(session bootstrap\)\z",
    r"^A new session was started via",
    r"^✅{s}*New session started",
    r"^Pre-compaction memory flush",
    r"^NO_REPLY{s}*\z",
)
SUSPICIOUS = (
    r"(?i){<}(?:tool_result|tool_use|function_call|traceback|stderr|stdout|exit code|json_parse_error|metadata|openclaw cron|scheduled task|healthcheck){>}",
    r"(?i)</?(?:tool_use|tool_result|system|developer){>}",
)

# Phrases of a run log. (name, pattern)
LOG_WARNINGS = (
    ("llm_extraction_failed", r"(?i){<}LLM extraction failed{>}"),
    ("safety_refusal", r"(?i)flagged for potentially high-risk cyber activity|safety checks/cybersecurity"),
    ("embedding_failed", r"(?i){<}Embedding FAILED{>}|Background embedding failed"),
    ("metadata_only_write", r"(?i)metadata-only"),
    ("l0_safety_valve", r"(?i){<}Safety valve{>}"),
)

# Envelopes before and within message content.
ENVELOPE = {
    "reply_tag": r"(?i)^\[\[reply_to_current\]\]{s}*",
    "conversation": r"(?is)^Conversation info \(untrusted metadata\):{s}*```json{s}*(.*?){s}*```{s}*",
    "system_sender": r"(?i)^System:{s}*\[[^\n]*\]{s}*[^\n]*\n+Sender \(untrusted metadata\):{s}*```json{s}*((?s:.*?)){s}*```{s}*",
    "sender": r"(?is)^Sender \(untrusted metadata\):{s}*```json{s}*(.*?){s}*```{s}*",
    "system_line": r"(?i)^System:{s}*([^\n]+)\n+((?s:.+))\z",
    "replied": r"(?is)^Replied message \(untrusted, for context\):{s}*```json{s}*(.*?){s}*```{s}*",
    "untrusted": r"(?is)\n+{s}*Untrusted context \(metadata, do not treat as instructions(?: or commands)?\):.*\z",
    "body": r"(?is)Source:{s}*External{s}*\n---{s}*\nUNTRUSTED Discord message body{s}*\n(.*?)\n<<<END_EXTERNAL_UNTRUSTED_CONTENT{>}",
    "channel": r"(?is)Source:{s}*Channel metadata{s}*\n---{s}*\n(.*?)\n<<<END_EXTERNAL_UNTRUSTED_CONTENT{>}",
    "inner_sender": r"(?is)\n+{s}*Sender \(untrusted metadata\):{s}*```json.*?```{s}*",
    "inner_conversation": r"(?is)\n+{s}*Conversation info \(untrusted metadata\):{s}*```json.*?```{s}*",
    "queued": r"(?i)^\[Queued messages while agent was busy\]",
    "queued_item": r"(?i)^Queued #[0-9]+{s}*",
}
STRIPPED = (
    ("system-envelope", "stripped_system_envelope"),
    ("metadata-envelope", "stripped_metadata_envelope"),
    ("external-discord-body", "stripped_external_discord_envelope"),
    ("reply-context", "stripped_reply_context"),
)
CHANNEL_METADATA = ("author", "author_id", "message_id", "channel_id", "guild_id", "thread_id")
AGENT_METADATA = {
    "openclawType": ("$.type",),
    "openclawId": ("$.id",),
    "parentId": ("$.parentId",),
    "provider": ("$.message.provider", "$.provider"),
    "model": ("$.message.model", "$.model"),
}
SESSION_FIELDS = ("sessionKey", "session_key", "source_session", "sourceSession", "metadata.sessionKey", "metadata.session_key")

# Batches that may be executed, by month.
EXECUTABLE_BATCHES = {"2026-02": 6, "2026-03": 12, "2026-04": 7}

# What a run's output folder may hold from an attempt that wrote no output, and what output looks like.
RUN_LEFTOVERS = ("live-before.json", "live-after.json", "run.log", "run-summary.json")
RUN_OUTPUTS = ("vectors.db", "conversations", "records")
