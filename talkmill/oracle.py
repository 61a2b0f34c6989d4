"""The queries in DuckDB's SQL, over views of the same tables."""

from __future__ import annotations

from .functions import fixed
from .functions.semantics import re2
from .queries import KEPT_ROLES, LINE, LIVE, MESSAGES, PLAIN, STATED


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(re2(pattern))})"


def sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {q(re2(pattern))}, {q(by)}, 'g')"


def trimmed(x: str) -> str:
    return sub(x, r"^{s}+|{s}+\z")


def collapsed(x: str) -> str:
    return f"trim({sub(x, '{s}+', ' ')})"


def normalised(x: str) -> str:
    out = trimmed(x)
    for p in fixed.NORMALISE:
        out = sub(out, p)
    return collapsed(out)


def hashed(n: str) -> str:
    return f"CASE WHEN {n} = '' THEN '' ELSE substr(sha256({n}), 1, 24) END"


def sanitised(x: str) -> str:
    for p, by in fixed.SANITISE:
        x = sub(x, p, by)
    return trimmed(x)


def captured(role: str, x: str) -> str:
    clean = sanitised(x)
    return f"CASE WHEN {role} = 'assistant' THEN {trimmed(sub(sub(clean, fixed.CODE_BLOCK), '\\n{3,}', chr(10) * 2))} ELSE {clean} END"


def units(x: str) -> str:
    return f"(length({x}) + length({sub(x, r'[^\x{10000}-\x{10FFFF}]')}))"


def noise_rules(t: str) -> str:
    rules = [f"WHEN {t} = '' THEN 'empty'"]
    for label, must, must_not in fixed.NOISE:
        rules.append("WHEN " + " AND ".join([has(t, p) for p in must] + [f"NOT {has(t, p)}" for p in must_not]) + f" THEN '{label}'")
    return " ".join(rules)


def reject(role: str, t: str) -> str:
    head, *_ = noise_rules(t).split(" WHEN ", 1)
    rest = noise_rules(t)[len(head) + 1 :]
    envelope = " OR ".join(f"list_contains(json_keys({t}), '{k}')" for k in fixed.JSON_ENVELOPE_KEYS)
    has_text = " OR ".join(f"coalesce(json_type({t}, '$.{k}') = 'VARCHAR', false)" for k in fixed.JSON_TEXT_KEYS)
    rules = [head, f"WHEN {units(t)} < 2 THEN 'too_short'", rest, f"WHEN {has(t, fixed.RESIDUAL)} THEN 'metadata_envelope_residual'", f"WHEN {role} = 'user' AND {has(t, fixed.DATED_BRACKET)} THEN 'not_human_user_message'"]
    rules += [f"WHEN {has(t, p)} THEN '{label}'" for label, p in fixed.REJECT_BEFORE_JSON]
    rules += [f"WHEN {has(t, fixed.JSON_LIKE)} AND NOT json_valid({t}) THEN NULL", f"WHEN {has(t, fixed.JSON_LIKE)} AND ({envelope}) AND NOT ({has_text}) THEN 'json_envelope_metadata'"]
    rules += [f"WHEN {has(t, p)} THEN '{label}'" for label, p in fixed.REJECT_AFTER_JSON]
    return "CASE " + " ".join(rules) + " END"


def progress(t: str) -> str:
    done, size = has(t, fixed.COMPLETED), units(t)
    short = " ".join(f"WHEN {has(t, p)} AND {size} <= {most} THEN true" for p, most in fixed.PROGRESS_SHORT)
    return (
        f"CASE WHEN {t} = '' THEN false WHEN {has(t, fixed.PROGRESS_ALWAYS)} THEN true WHEN {has(t, fixed.PROGRESS_OPENERS)} AND {size} <= 220 AND NOT {done} THEN true "
        f"WHEN {has(t, fixed.ACKNOWLEDGED)} AND {size} <= 260 AND NOT {done} THEN true WHEN {' OR '.join(has(t, p) for p in fixed.FINAL_SIGNAL)} THEN false {short} ELSE false END"
    )


def framework(t: str) -> str:
    return "(" + " OR ".join(has(t, p) for p in fixed.FRAMEWORK) + ")"


def filter_reason(x: str, t: str) -> str:
    return f"CASE WHEN {t} = '' THEN 'empty after sanitize/stripCodeBlocks' WHEN {framework(t)} THEN 'framework noise' WHEN starts_with({x}, '/') THEN 'slash command' END"


def messages(name: str, columns: dict[str, str]) -> str:
    return f"{name} AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM conversations WHERE {KEPT_ROLES})"


M = messages("m", MESSAGES)
# Stages are separate CTEs so that each expression stands once.
T = f"{M}, t AS (SELECT *, {trimmed('content')} AS t, {collapsed('content')} AS flat, {normalised('content')} AS norm, strftime(make_timestamp(ts_ms * 1000), '%Y-%m') AS month FROM m), r AS (SELECT *, {reject('role', 't')} AS reject FROM t)"
D = f"d AS (SELECT doc_id AS seq, source AS scope, CASE WHEN doc_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role, text AS content, {normalised('text')} AS norm FROM documents), dm AS (SELECT *, {hashed('norm')} AS h FROM d)"
def capture(x: str, columns: dict[str, str]) -> str:
    """CTEs that end in ``x``: what capture keeps of the messages."""
    return (
        f"{messages(x + 'm', columns)}, {x}1 AS MATERIALIZED (SELECT *, {captured('role', 'content')} AS captured FROM {x}m), {x}2 AS MATERIALIZED (SELECT *, {normalised('content')} AS n1, {normalised('captured')} AS n2, {trimmed('captured')} AS ct FROM {x}1), "
        f"{x}3 AS (SELECT *, {hashed('n1')} AS raw_hash, {hashed('n2')} AS hash, {filter_reason('captured', 'ct')} AS filter_reason FROM {x}2), "
        f"{x} AS (SELECT *, captured <> content OR raw_hash <> hash AS transformed, concat_ws(chr(9), session_key, role, CAST(ts_ms AS VARCHAR), hash) AS compare_key, CASE WHEN hash = '' THEN substr(sha256(captured), 1, 24) ELSE hash END AS fingerprint FROM {x}3)"
    )


C = capture("x", MESSAGES)
BOTH = f"{C}, {capture('y', LIVE)}"
RECORD_ID = "'l0_' || substr(sha256(concat_ws('|', session_key, role, CAST(ts_ms AS VARCHAR), fingerprint)), 1, 12)"
R = """rr AS (SELECT *, session_key || '|' || content AS k, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY ts_ms, line_no ROWS UNBOUNDED PRECEDING) AS rid FROM m),
u AS (SELECT file, rid, row_number() OVER (PARTITION BY file, k ORDER BY ts_ms, line_no) > 1 AS again FROM rr WHERE role = 'user'),
a AS (SELECT file, rid, count(*) FILTER (role <> 'user') AS na FROM rr GROUP BY ALL),
j AS (SELECT rr.*, CASE WHEN role = 'user' AND again THEN 'duplicate_user_message' WHEN role = 'user' AND na = 0 THEN 'unpaired_user_without_assistant' WHEN role <> 'user' AND (rr.rid = 0 OR again) THEN 'assistant_only_without_user' END AS reject
 FROM rr JOIN a ON a.file = rr.file AND a.rid = rr.rid LEFT JOIN u ON u.file = rr.file AND u.rid = rr.rid)"""
L1 = "l1 AS (SELECT d.doc_id AS record_id, CASE WHEN toxic = 1 THEN 'warning' WHEN quality = 1 THEN 'fact' ELSE '' END AS type, source AS session_key, text AS content FROM documents d JOIN labels USING (doc_id))"
INV = """i AS (SELECT month, source_type, file, session_id, count(*) AS message_count, count(*) FILTER (role = 'user' AND reject IS NULL) AS user_count, count(*) FILTER (role <> 'user' AND reject IS NULL) AS assistant_count,
 count(*) FILTER (reject IS NULL) AS accepted_count, count(*) FILTER (reject IS NOT NULL) AS rejected_count, count(*) FILTER (starts_with(content, '[') AND (role <> 'user' OR reject IS NULL)) AS dirty_count,
 min(ts_ms) AS first_ts, max(ts_ms) AS last_ts, arg_min(substr(content, 1, 300), line_no) FILTER (role = 'user' AND reject IS NULL AND content <> '') AS sample_user_text FROM r GROUP BY ALL)"""
FIELD = lambda path: f"coalesce(json_extract_string(j, '{path}') = key, false)"
LINES = f"""ll AS (SELECT file, line_no, {LINE} AS line FROM m), kk AS (SELECT DISTINCT session_key AS key FROM m),
pairs AS (SELECT file, line_no, key, contains(line, key) AS mentioned, CASE WHEN json_valid(line) THEN line END AS j FROM ll, kk),
hits AS (SELECT file, line_no, key, CASE WHEN named THEN 'session_field' ELSE 'content_mention' END AS match_kind
 FROM (SELECT *, {FIELD('$.sessionKey')} OR {FIELD('$.metadata.session_key')} AS named FROM pairs) WHERE named OR mentioned)"""
PROGRESS = f"""s AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS session_key, count(*) AS l0 FROM orders GROUP BY 1),
p AS (SELECT {', '.join(f'{e} AS {n}' for n, e in STATED.items())} FROM customer),
st AS (SELECT session_key, coalesce(l0, 0) AS l0, CASE WHEN coalesce(l0, 0) > 0 THEN l0 ELSE coalesce(total_l0, 0) END AS total, coalesce(next_offset, 0) AS stated, coalesce(completed, false) AS flag FROM s FULL JOIN p USING (session_key)),
so AS (SELECT *, CASE WHEN total > 0 AND stated > total THEN total ELSE stated END AS "offset" FROM st),
sp AS (SELECT session_key, l0, total, "offset", CASE WHEN flag AND (total = 0 OR "offset" >= total) THEN 'completed' WHEN "offset" > 0 THEN 'running' ELSE 'queued' END AS status FROM so)"""
SUMS = """count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'running') AS running, count(*) FILTER (status = 'queued') AS queued, CAST(sum("offset") AS BIGINT) AS done, CAST(sum(total) AS BIGINT) AS total"""
LEFT = "greatest(total - done, 0) AS remaining, CASE WHEN total > 0 THEN round_even(done * 100.0 / total, 0) ELSE 0.0 END::DOUBLE AS percent"
# Curation of plain lines: rules, then duplicates in batch order, then rounds.
PLAIN_ROWS = f"""{messages('pm', MESSAGES | {'content': PLAIN})}, pt AS (SELECT *, {trimmed('content')} AS t FROM pm), pf AS (SELECT *, {collapsed('t')} AS flat, {normalised('t')} AS norm FROM pt),
pj AS (SELECT *, {hashed('norm')} AS h, coalesce({reject('role', 't')}, CASE WHEN role = 'assistant' AND {progress('flat')} THEN 'assistant_progress_update' END) AS reject FROM pf),
fl AS (SELECT file, CASE WHEN max(source_type) = 'discord' THEN 0 ELSE 1 END AS channel, count(*) AS n, max(line_no) AS lines FROM pj GROUP BY 1),
pl AS (SELECT file, coalesce(sum(lines + 1) OVER (ORDER BY channel, n DESC, file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM fl),
g AS (SELECT pj.* EXCLUDE (seq), CAST(before + line_no AS BIGINT) AS seq FROM pj JOIN pl USING (file) WHERE reject IS NULL)"""


def paired(rows: str) -> str:
    """CTEs that end in ``pr``: the rows with what rounds reject (no user repeats another's key here)."""
    return f"""p1 AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY ts_ms, line_no ROWS UNBOUNDED PRECEDING) AS rid FROM {rows}),
p2 AS (SELECT file, rid, count(*) FILTER (role <> 'user') AS na FROM p1 GROUP BY ALL),
pr AS (SELECT p1.*, CASE WHEN role = 'user' AND na = 0 THEN 'unpaired_user_without_assistant' WHEN role <> 'user' AND rid = 0 THEN 'assistant_only_without_user' END AS unfit FROM p1 JOIN p2 USING (file, rid))"""


WARNED = f"""{PLAIN_ROWS}, g1 AS (SELECT *, CASE WHEN h <> '' THEN min(seq) OVER (PARTITION BY session_key, role, h) ELSE seq END AS fs FROM g), k1 AS (SELECT * FROM g1 WHERE seq = fs),
k2 AS (SELECT *, CASE WHEN h <> '' THEN lag(seq) OVER (PARTITION BY role, h ORDER BY seq) END AS previous FROM k1), {paired('k2')}"""
REJECTED = f"""{PLAIN_ROWS}, g1 AS (SELECT *, CASE WHEN h <> '' THEN min(seq) OVER (PARTITION BY role, h) ELSE seq END AS fs, first_value(session_key) OVER (PARTITION BY role, h ORDER BY seq) AS fscope FROM g), k1 AS (SELECT * FROM g1 WHERE seq = fs), {paired('k1')}"""
JUDGED = "SELECT reject AS reason, file, line_no, role, CAST(NULL AS VARCHAR) AS duplicate_scope, CAST(NULL AS BIGINT) AS duplicate_of FROM pj WHERE reject IS NOT NULL UNION ALL SELECT unfit, file, line_no, role, NULL, NULL FROM pr WHERE unfit IS NOT NULL"
KEPT = "kp AS (SELECT session_key || ':seed:2024-01' AS sessionKey, count(DISTINCT rid) AS rounds, count(*) AS messages, md5(string_agg(role || ':' || t, chr(10) ORDER BY ts_ms, line_no)) AS digest FROM pr WHERE unfit IS NULL GROUP BY 1)"


def rate(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round({part} / {whole}, 4) ELSE 0.0 END"


def differ(left: str, right: str, key: str) -> str:
    return f"SELECT l.{key} AS {key}, l.n - coalesce(r.n, 0) AS delta FROM (SELECT {key}, count(*) AS n FROM {left} GROUP BY 1) l LEFT JOIN (SELECT {key}, count(*) AS n FROM {right} GROUP BY 1) r ON l.{key} = r.{key} WHERE l.n > coalesce(r.n, 0)"


WARN = """kept AS (SELECT * FROM (SELECT *, CASE WHEN h <> '' THEN row_number() OVER (PARTITION BY scope, role, h ORDER BY seq) ELSE 1 END AS k FROM dm) WHERE k = 1)"""

# The same for one month's lines only.
OF_MONTH = WARNED.replace("FROM pm)", "FROM pm WHERE strftime(make_timestamp(ts_ms * 1000), '%Y-%m') = '2024-01')", 1)
KEY_DELTAS = "a AS (SELECT compare_key AS key, count(*) AS n FROM x GROUP BY 1), b AS (SELECT compare_key AS key, count(*) AS n FROM y GROUP BY 1), d AS (SELECT key, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta FROM a FULL JOIN b USING (key) WHERE key IS NOT NULL AND coalesce(a.n, 0) <> coalesce(b.n, 0))"
ORACLE = {
    "q_strict_rounds": f"WITH {M}, {R} SELECT file, count(*) FILTER (reject IS NULL AND role = 'user') AS rounds, count(*) FILTER (reject = 'assistant_only_without_user') AS orphans, count(*) FILTER (reject = 'unpaired_user_without_assistant') AS unpaired, count(*) FILTER (reject = 'duplicate_user_message') AS duplicate_users, count(*) FILTER (reject IS NULL) AS kept FROM j GROUP BY file",
    "q_round_replies": f"WITH {M}, {R} SELECT file, CAST(rid AS BIGINT) AS round_id, count(*) AS n, arg_min(content, line_no) AS first_user, arg_max(content, line_no) AS last_assistant FROM j WHERE reject IS NULL GROUP BY file, rid",
    "q_month_bucket": f"WITH {T} SELECT month, count(*) AS n FROM t GROUP BY 1",
    "q_role_filter": "SELECT role, count(*) AS n, count(DISTINCT conv_id) AS conversations FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1",
    "q_inventory": f"WITH {T}, {INV} SELECT *, {rate('dirty_count', 'message_count')} AS dirty_ratio, {rate('rejected_count', 'message_count')} AS rejected_ratio FROM i",
    "q_month_rollup": f"WITH {T}, {INV}, w AS (SELECT month, count(*) AS sessions, CAST(sum(message_count) AS BIGINT) AS messages, CAST(sum(user_count) AS BIGINT) AS users, CAST(sum(assistant_count) AS BIGINT) AS assistants, CAST(sum(rejected_count) AS BIGINT) AS rejected FROM i GROUP BY 1) SELECT month, coalesce(sessions, 0) AS sessions, coalesce(messages, 0) AS messages, coalesce(users, 0) AS users, coalesce(assistants, 0) AS assistants, coalesce(rejected, 0) AS rejected FROM w FULL JOIN (SELECT unnest(['2023-12', '2024-01']) AS month) USING (month)",
    "q_batch_page": f"WITH {M}, {R}, f AS (SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m') AS month, file, source_type, count(*) AS n FROM m GROUP BY ALL), k AS (SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m') AS month, file, rid FROM j WHERE reject IS NULL AND role = 'user'), o AS (SELECT k.month, k.file, CAST(rid AS BIGINT) AS round_id, row_number() OVER (PARTITION BY k.month ORDER BY CASE WHEN source_type = 'discord' THEN 0 ELSE 1 END, n DESC, k.file, rid) - 1 AS place FROM k JOIN f ON f.month = k.month AND f.file = k.file) SELECT * FROM o WHERE place >= 10 AND place < 20",
    "q_normalize_hash": f"WITH {T} SELECT conv_id, line_no, norm AS normalised, {hashed('norm')} AS content_hash FROM t",
    "q_normalize_hash_documents": f"WITH {D} SELECT seq AS doc_id, h AS content_hash FROM dm",
    "q_dedupe_key": f"WITH {T} SELECT conv_id, line_no, session_key || ':hash:' || substr(sha256(role || chr(10) || CAST(ts_ms AS VARCHAR) || chr(10) || flat), 1, 24) AS dedupe_key, concat_ws(chr(9), role, CAST(ts_ms AS VARCHAR), flat) AS fallback_key FROM t",
    "q_sanitize": f"WITH {M} SELECT conv_id, line_no, {sanitised('content')} AS clean FROM m",
    "q_strip_code": f"WITH {M} SELECT conv_id, line_no, {captured('role', 'content')} AS captured FROM m",
    "q_utf16_length": f"WITH {M}, e AS (SELECT *, content || '😀' AS ce FROM m) SELECT conv_id, line_no, {units('ce')} AS units, {collapsed('content')} AS flat FROM e",
    "q_timestamp_forms": f"WITH {M} SELECT conv_id, line_no, ts_ms // 1000 * 1000 AS ts_ms FROM m",
    "q_content_flatten": f"WITH {M} SELECT conv_id, line_no, CASE WHEN line_no % 3 = 1 THEN {trimmed("('a' || chr(10) || content || chr(10))")} ELSE {trimmed('content')} END AS flat FROM m",
    "q_envelope_strip": f"WITH {M} SELECT conv_id, line_no, 'body ' || CAST(line_no AS VARCHAR) AS content, CASE WHEN line_no % 2 = 0 THEN 'metadata-envelope' ELSE '' END AS flags, CASE WHEN line_no % 2 = 0 THEN 'stripped_metadata_envelope' ELSE '' END AS reasons, CASE WHEN line_no % 2 = 0 THEN 'm' || CAST(conv_id AS VARCHAR) END AS message_id FROM m",
    "q_noise_class": f"WITH {T} SELECT conv_id, line_no, CASE {noise_rules('t')} END AS label FROM t",
    "q_reject_reason": f"WITH {T} SELECT conv_id, line_no, reject AS reason FROM r",
    "q_reject_summary": f"WITH {T} SELECT role, coalesce(reject, 'accepted') AS reason, count(*) AS n FROM r GROUP BY ALL",
    "q_progress_update": f"WITH {T} SELECT conv_id, line_no, {progress('flat')} AS progress FROM t",
    "q_framework_noise": f"WITH {T} SELECT conv_id, line_no, {framework('t')} AS noise FROM t",
    "q_filter_reason": f"WITH {C} SELECT conv_id, line_no, filter_reason AS reason FROM x",
    "q_suspicious": f"WITH {M} SELECT conv_id, line_no, content FROM m WHERE {has('content', fixed.SUSPICIOUS[0])} OR {has('content', fixed.SUSPICIOUS[1])}",
    "q_dedupe_source": f"WITH {D} SELECT seq, CASE WHEN h <> '' THEN min(seq) OVER (PARTITION BY scope, role, h) END AS source_first FROM dm",
    "q_dedupe_batch_warn": f"WITH {D}, {WARN} SELECT seq, CASE WHEN h <> '' THEN lag(seq) OVER (PARTITION BY role, h ORDER BY seq) END AS batch_previous FROM kept",
    "q_dedupe_batch_reject": f"WITH {D}, f AS (SELECT *, min(seq) OVER (PARTITION BY role, h) AS fs, first_value(scope) OVER (PARTITION BY role, h ORDER BY seq) AS fscope FROM dm) SELECT seq, CASE WHEN h = '' OR seq = fs THEN 'keep' WHEN scope = fscope THEN 'duplicate_source' ELSE 'duplicate_batch' END AS verdict, CASE WHEN h <> '' AND seq <> fs THEN fs END AS duplicate_of FROM f",
    "q_dup_surplus": f"WITH {D}, n AS (SELECT h, count(*) AS n FROM dm WHERE h <> '' GROUP BY 1) SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus, count(*) FILTER (n > 1) AS repeated_hashes FROM n",
    "q_progress_ages": "WITH a AS (SELECT event_id, greatest(event_id % 20000 - 500, 0) AS n FROM events) SELECT event_id, CASE WHEN event_id % 50 = 7 THEN '-' WHEN n < 60 THEN n || 's ago' WHEN n < 3600 THEN (n // 60) || 'm ' || (n % 60) || 's ago' ELSE (n // 3600) || 'h ' || (n % 3600 // 60) || 'm ago' END AS age FROM a",
    "q_session_report": f"WITH {C} SELECT session_key, count(*) AS n FROM x WHERE filter_reason IS NULL GROUP BY 1",
    "q_output_top_duplicates": f"WITH {T}, h AS (SELECT *, {hashed('norm')} AS h FROM t) SELECT h AS content_hash, count(*) AS n, min(seq) AS first_seq, arg_min(substr(norm, 1, 180), seq) AS content FROM h WHERE h <> '' GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, first_seq LIMIT 10",
    "q_top_duplicates": f"WITH {D} SELECT h AS content_hash, count(*) AS n, min(seq) AS first_seq, arg_min(substr(norm, 1, 180), seq) AS content FROM dm WHERE h <> '' GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, first_seq LIMIT 10",
    "q_capture_split": f"WITH {C} SELECT count(*) AS raw, count(*) FILTER (filter_reason IS NULL) AS kept, count(*) FILTER (filter_reason IS NOT NULL) AS filtered, count(*) FILTER (filter_reason IS NULL AND transformed) AS transformed FROM x",
    "q_import_published": f"WITH {C} SELECT {RECORD_ID} AS record_id, session_key, role, ts_ms, captured AS message_text, captured AS fts_text, compare_key FROM x WHERE filter_reason IS NULL",
    "q_import_journal": f"WITH {C}, n AS (SELECT count(*) FILTER (conv_id % 2 = 0) AS even, count(*) FILTER (conv_id % 2 = 1) AS odd FROM x WHERE filter_reason IS NULL) SELECT batch, seq, phase, planned, accepted_before FROM n, LATERAL (VALUES ('2024-01-batch-001', 3, 'verified-ok', even, 0), ('2024-01-batch-002', 3, 'verified-ok', odd, even), ('2024-01-batch-003', 3, 'stop', even, even + odd)) AS v(batch, seq, phase, planned, accepted_before)",
    "q_planned_rows": f"WITH {C} SELECT conv_id, line_no, {RECORD_ID} AS record_id, {units('captured')} AS chars, compare_key FROM x WHERE filter_reason IS NULL",
    "q_compare_multiset": f"WITH {BOTH}, a AS (SELECT compare_key, count(*) AS l FROM x GROUP BY 1), b AS (SELECT compare_key, count(*) AS r FROM y GROUP BY 1), n AS (SELECT coalesce(l, 0) AS l, coalesce(r, 0) AS r FROM a FULL JOIN b USING (compare_key)), s AS (SELECT CAST(coalesce(sum(greatest(l - r, 0)), 0) AS BIGINT) AS missing, CAST(coalesce(sum(greatest(r - l, 0)), 0) AS BIGINT) AS extra, CAST(coalesce(sum(l), 0) AS BIGINT) AS expected_rows, CAST(coalesce(sum(r), 0) AS BIGINT) AS live_rows FROM n) SELECT *, missing = 0 AND extra = 0 AND expected_rows = live_rows AS complete FROM s",
    "q_relaxed_compare": f"WITH {BOTH}, xe AS (SELECT concat_ws(':', role, hash) AS role_hash FROM x), ye AS (SELECT concat_ws(':', role, hash) AS role_hash FROM y) {differ('xe', 'ye', 'role_hash')}",
    "q_dataset_hash": f"WITH {C} SELECT session_key, substr(sha256(string_agg(compare_key, chr(10) ORDER BY compare_key)), 1, 24) AS dataset_hash FROM x GROUP BY 1",
    "q_dataset_digest": f"WITH {C} SELECT role, count(*) AS n, CAST(sum(CAST('0x' || substr(md5(compare_key), 1, 15) AS BIGINT)) AS VARCHAR) AS digest FROM x GROUP BY 1",
    "q_merkle_roots": f"WITH {C}, c AS (SELECT role, compare_key AS k, count(*) AS n FROM x WHERE compare_key IS NOT NULL GROUP BY 1, 2), leaf AS (SELECT role, left(md5(k), 2) AS p, sha256(string_agg(k || ':' || CAST(n AS VARCHAR), chr(10) ORDER BY k || ':' || CAST(n AS VARCHAR))) AS h FROM c GROUP BY 1, 2), up AS (SELECT role, left(p, 1) AS p1, sha256(string_agg(p || '=' || h, chr(10) ORDER BY p)) AS h FROM leaf GROUP BY 1, 2) SELECT role, sha256(string_agg(p1 || '=' || h, chr(10) ORDER BY p1)) AS hash FROM up GROUP BY 1",
    "q_merkle_difference": f"WITH {BOTH}, {KEY_DELTAS} SELECT key, delta FROM d",
    "q_compare_report": f"WITH {BOTH}, {KEY_DELTAS}, r AS (SELECT CASE WHEN delta > 0 THEN 'missing' ELSE 'extra' END AS direction, key, abs(delta) AS delta FROM d), s AS (SELECT *, row_number() OVER (PARTITION BY direction ORDER BY delta DESC, key) AS n FROM r) SELECT direction, count(key) AS keys, CAST(coalesce(sum(delta), 0) AS BIGINT) AS total, coalesce(string_agg(key || '=' || CAST(delta AS VARCHAR), ';' ORDER BY n) FILTER (n <= 20), '') AS samples FROM (VALUES ('missing'), ('extra')) AS v(direction) LEFT JOIN s USING (direction) GROUP BY 1",
    "q_existing_keys": f"WITH {BOTH} SELECT DISTINCT compare_key FROM x WHERE compare_key IN (SELECT compare_key FROM y)",
    "q_missing_keys": f"WITH {BOTH} SELECT DISTINCT compare_key FROM x WHERE compare_key NOT IN (SELECT compare_key FROM y)",
    "q_session_counts": f"WITH {C} SELECT session_key, count(*) AS n FROM x WHERE filter_reason IS NULL GROUP BY 1",
    "q_import_gate": f"WITH {BOTH}, g AS (SELECT (SELECT count(*) FROM x) AS planned, (SELECT count(DISTINCT compare_key) FROM x) AS planned_keys, (SELECT count(*) FROM documents) AS before, (SELECT count(*) FROM documents) + (SELECT count(*) FROM y) AS after, 0::BIGINT AS already_live, (SELECT count(DISTINCT compare_key) FROM x WHERE compare_key NOT IN (SELECT compare_key FROM y)) AS missing_after, (SELECT count(*) FROM x) + (SELECT count(*) FROM y) AS delta_fts) SELECT *, after - before AS delta, greatest(after - before - planned, 0) AS extra, before = 0 AND planned > 0 AS may_run, before = 0 AND after - before = planned AND delta_fts = planned AND missing_after = 0 AS verified FROM g",
    "q_runtime_estimate": "SELECT source, CAST(greatest(5, ceil(count(*) * 0.01)) AS BIGINT) AS l0_seconds, CAST(greatest(60, ceil(count(*) * 0.12)) AS BIGINT) AS l0_embedding_seconds FROM documents GROUP BY 1",
    "q_input_quality": f"WITH {T}, z AS (SELECT *, {hashed('norm')} AS h, concat_ws('|', session_id, substr(content, 1, 3)) AS sk FROM t), s AS (SELECT count(*) AS total_messages, count(*) FILTER (role = 'user') AS user_messages, count(*) FILTER (role = 'assistant' AND {progress('flat')}) AS progress_updates, count(*) FILTER (CASE {noise_rules('t')} END IS NOT NULL) AS system_noise, count(*) FILTER ({has('content', fixed.RESIDUAL)}) AS metadata_envelopes, count(*) FILTER (role = 'user' AND sk <> '') - count(DISTINCT sk) FILTER (role = 'user' AND sk <> '') AS duplicate_users, count(*) FILTER (h <> '') - count(DISTINCT h) FILTER (h <> '') AS duplicate_content, count(*) FILTER (role = 'user' AND h <> '') - count(DISTINCT h) FILTER (role = 'user' AND h <> '') AS user_duplicate_content FROM z) SELECT *, {rate('duplicate_users', 'total_messages')} AS duplicate_rate, {rate('duplicate_content', 'total_messages')} AS duplicate_content_rate, {rate('progress_updates', 'total_messages')} AS progress_rate, {rate('user_duplicate_content', 'user_messages')} AS user_duplicate_content_rate, {rate('system_noise', 'total_messages')} AS noise_rate, {rate('metadata_envelopes', 'total_messages')} AS envelope_rate FROM s",
    "q_overlap": f"WITH {D}, y AS (SELECT seq, 'k' || CAST(seq % 300 AS VARCHAR) AS sk, CASE WHEN h = '' THEN '' ELSE role || ':' || h END AS rh FROM dm), e AS (SELECT 'k' || CAST(seq % 700 + 150 AS VARCHAR) AS sk, CASE WHEN rh = '' THEN '' WHEN seq % 4 = 3 THEN rh ELSE 'earlier ' || rh END AS rh FROM y), cur AS (SELECT *, sk IN (SELECT sk FROM e) AS kh, rh <> '' AND rh IN (SELECT rh FROM e) AS hh FROM y), s AS (SELECT count(*) AS total_messages, count(*) FILTER (kh OR hh) AS overlapping, count(DISTINCT sk) FILTER (kh) AS key_hits, count(DISTINCT rh) FILTER (hh) AS hash_hits FROM cur), r AS (SELECT *, {rate('overlapping', 'total_messages')} AS overlap_rate FROM s) SELECT *, overlap_rate > 0 AS warning FROM r",
    "q_type_distribution": f"WITH {L1} SELECT coalesce(nullif(type, ''), 'unknown') AS type, count(*) AS n FROM l1 GROUP BY 1",
    "q_length_stats": f"WITH {L1}, n AS (SELECT {units('content')} AS n FROM l1) SELECT count(*) AS n, coalesce(round(avg(n.n), 1), 0.0) AS avg_length, coalesce(max(n.n), 0) AS max_length, count(*) FILTER (n.n > 800) AS over_800, count(*) FILTER (n.n > 1200) AS over_1200 FROM n",
    "q_key_hits": f"WITH {M}, {LINES} SELECT DISTINCT file, key FROM hits",
    "q_pollution": f"WITH {M}, {LINES} SELECT file, line_no, key, match_kind FROM hits",
    "q_log_warnings": "WITH l AS (SELECT event_type, ['LLM extraction failed', 'Embedding FAILED now', 'metadata-only write', 'a Safety valve', 'fine', 'Background embedding failed; metadata-only'][event_id % 6 + 1] AS line FROM events) SELECT event_type, "
    + ", ".join(f"CAST(sum(len(regexp_extract_all(line, {q(re2(p))}))) AS BIGINT) AS {name}" for name, p in fixed.LOG_WARNINGS)
    + " FROM l GROUP BY 1",
    "q_snapshot_compare": "WITH b AS (SELECT doc_id, source, n_chars FROM documents), a AS (SELECT CASE WHEN doc_id % 10 = 1 THEN -doc_id ELSE doc_id END AS doc_id, source, CASE WHEN doc_id % 10 = 2 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents) SELECT doc_id, CASE WHEN b.source IS NULL THEN 'added' WHEN a.source IS NULL THEN 'removed' ELSE 'changed' END AS change FROM b FULL JOIN a USING (doc_id) WHERE b.source IS DISTINCT FROM a.source OR b.n_chars IS DISTINCT FROM a.n_chars",
    "q_fts_terms": "WITH t AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{f900}-\\x{faff}]|[\\p{L}\\p{N}]+')) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS records, count(*) AS occurrences FROM t GROUP BY 1",
    "q_fts_search": "WITH t AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{N}]+')) AS term FROM documents) SELECT doc_id, 2 AS terms, count(*) AS n FROM t WHERE term IN ('the', 'of') GROUP BY 1 HAVING count(DISTINCT term) = 2",
    "q_index_text": f"WITH {messages('m', MESSAGES)}, t AS (SELECT conv_id, line_no, regexp_extract_all(content, '[\\x{{4e00}}-\\x{{9fff}}]+|[a-zA-Z0-9À-ÿ]+') AS w FROM m) SELECT conv_id, line_no, array_to_string([CASE x WHEN '我看一下' THEN '我 一下 看一下' WHEN '我先看' THEN '我 先看' ELSE x END FOR x IN w], ' ') AS terms FROM t",
    "q_fts_coverage": "WITH i AS (SELECT CASE WHEN doc_id % 10 = 0 THEN -doc_id - 1 ELSE doc_id END AS id FROM documents UNION ALL SELECT CASE WHEN doc_id % 7 = 0 THEN doc_id ELSE -doc_id - 1 END FROM documents), c AS (SELECT id, count(*) AS n FROM i GROUP BY 1), x AS (SELECT source, coalesce(n, 0) AS n FROM documents LEFT JOIN c ON id = doc_id) SELECT source, count(*) AS n, CAST(sum(x.n) AS BIGINT) AS joined, count(*) FILTER (x.n > 0) AS covered FROM x GROUP BY 1",
    "q_vec_coverage": "SELECT lang, count(*) AS n, count(vec_id) AS joined, count(vec_id) AS covered FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY 1",
    "q_live_verify": f"WITH {L1}, s AS (SELECT (SELECT count(*) FROM documents) AS l0, (SELECT count(*) FROM l1) AS l1, (SELECT count(*) FROM l1 WHERE record_id % 5 <= 1) AS missing_embedding, (SELECT count(*) FROM documents WHERE CASE WHEN doc_id % 2 = 0 THEN doc_id ELSE -doc_id END IN (SELECT record_id FROM l1)) AS l1_indexed) SELECT *, l0 > 0 AND l1 > 0 AND l1_indexed = l1 AS passed FROM s",
    "q_session_progress": f"WITH {PROGRESS} SELECT * FROM sp",
    "q_stream_progress": f"WITH {PROGRESS} SELECT * FROM sp",
    "q_dashboard_month": f"WITH {PROGRESS}, g AS (SELECT '2024-0' || CAST(session_key % 9 + 1 AS VARCHAR) AS month, {SUMS} FROM sp GROUP BY 1) SELECT *, {LEFT} FROM g",
    "q_manifest_upsert": "WITH n AS (SELECT CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN o_orderkey ELSE -o_orderkey END AS batch_id FROM orders) SELECT batch_id, 'accepted' AS status FROM n UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT batch_id FROM n)",
    "q_index_merge": "WITH o AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_mktsegment, c_name FROM customer), n AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'execute' END AS mode FROM customer) SELECT c_custkey, coalesce(mode, c_mktsegment) AS mode, c_name AS report FROM o FULL JOIN n USING (c_custkey)",
    "q_journal_latest": "SELECT user_id, max(event_id) AS seq, arg_max(event_type, event_id) AS phase, arg_max(value, event_id) AS value FROM events GROUP BY 1",
    "q_accept_existing": f"WITH {BOTH}, g AS (SELECT (SELECT count(*) FROM x) AS planned, (SELECT count(DISTINCT compare_key) FROM x) AS planned_keys, (SELECT count(*) FROM y) AS live, (SELECT count(*) FROM x) AS fts, (SELECT count(DISTINCT compare_key) FROM x WHERE compare_key IN (SELECT compare_key FROM y)) AS there) SELECT *, live AS delta, fts AS delta_fts, planned_keys - there AS missing, live = planned AND fts = planned AND planned_keys = there AS acceptable FROM g",
    "q_missing_embedding": f"WITH {L1} SELECT type, count(*) AS n, count(*) FILTER (record_id % 5 <= 1) AS missing FROM l1 GROUP BY 1",
    "q_dashboard_total": f"WITH {PROGRESS}, g AS (SELECT {SUMS} FROM sp) SELECT *, {LEFT} FROM g",
    "q_stream_lines": f"WITH {messages('m', MESSAGES)} SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY line_no) AS line_no, role || ' ' || CAST(line_no AS VARCHAR) || ' ' || md5(content) AS line FROM m",
    "q_rejects": f"WITH {REJECTED} {JUDGED} UNION ALL SELECT CASE WHEN session_key = fscope THEN 'duplicate_normalized_content' ELSE 'duplicate_normalized_content_warning' END, file, line_no, role, CASE WHEN session_key = fscope THEN 'source_session' ELSE 'batch' END, fs FROM g1 WHERE seq <> fs",
    "q_rejects_warned": f"WITH {WARNED} {JUDGED} UNION ALL SELECT 'duplicate_normalized_content', file, line_no, role, 'source_session', fs FROM g1 WHERE seq <> fs UNION ALL SELECT 'duplicate_normalized_content_warning', file, line_no, role, 'batch', previous FROM k2 WHERE previous IS NOT NULL",
    "q_seed_page": f"WITH {OF_MONTH}, sr AS (SELECT session_key || ':seed:2024-01' AS sessionKey, file, rid, count(*) AS messages, md5(string_agg(role || ':' || t, chr(10) ORDER BY ts_ms, line_no)) AS digest FROM pr WHERE unfit IS NULL GROUP BY ALL), sp AS (SELECT sr.*, row_number() OVER (ORDER BY before, rid) - 1 AS place, count(*) OVER () AS total FROM sr JOIN pl USING (file)) SELECT sessionKey, file, place, messages, digest, 4 AS rangeStartRound, least(total, 6) AS rangeEndRound, total AS totalAvailableRounds FROM sp WHERE place >= 3 AND place < 6",
    "q_seed_sessions_nested": f"WITH {WARNED}, {KEPT} SELECT * FROM kp",
    "q_input_summary": f"WITH {WARNED}, {KEPT} SELECT count(*) AS sessions, CAST(coalesce(sum(rounds), 0) AS BIGINT) AS rounds, CAST(coalesce(sum(messages), 0) AS BIGINT) AS messages FROM kp",
    "q_message_metadata": f"WITH {M} SELECT file, line_no, CASE WHEN source_type = 'discord' THEN 'author=a,message_id=' || CAST(line_no AS VARCHAR) || ',sourceMessageId=' || CAST(line_no AS VARCHAR) ELSE 'model=m1,openclawId=' || CAST(line_no AS VARCHAR) END AS metadata FROM m",
    "q_output_quality": f"WITH {T}, z AS (SELECT *, {hashed('norm')} AS h FROM t), s AS (SELECT count(*) AS total_messages, count(*) FILTER (role = 'user') AS user_messages, count(*) FILTER (role = 'assistant' AND {progress('flat')}) AS progress_updates, count(*) FILTER (CASE {noise_rules('t')} END IS NOT NULL) AS system_noise, count(*) FILTER ({has('content', fixed.RESIDUAL)}) AS metadata_envelopes, count(*) FILTER (h <> '') - count(DISTINCT h) FILTER (h <> '') AS duplicate_content, count(*) FILTER (role = 'user' AND h <> '') - count(DISTINCT h) FILTER (role = 'user' AND h <> '') AS user_duplicate_content FROM z) SELECT *, {rate('duplicate_content', 'total_messages')} AS duplicate_rate, {rate('duplicate_content', 'total_messages')} AS duplicate_content_rate, {rate('progress_updates', 'total_messages')} AS progress_rate, {rate('user_duplicate_content', 'user_messages')} AS user_duplicate_content_rate, {rate('system_noise', 'total_messages')} AS noise_rate, {rate('metadata_envelopes', 'total_messages')} AS envelope_rate FROM s",
    "q_session_like": f"WITH {M}, k AS (SELECT conv_id, line_no, session_key || CASE WHEN conv_id % 3 = 0 THEN ':seed:2024-01' WHEN conv_id % 3 = 1 THEN ':Seed:2024-01-x' ELSE 'seed:2024-02' END AS key FROM m) SELECT conv_id, line_no, key ILIKE '%seed:2024-01%' AS of_month, key ILIKE '%:seed:2024-01' AS at_end FROM k",
    "q_planned_ids": f"WITH {C}, o AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS ordinal FROM x WHERE filter_reason IS NULL), i AS (SELECT *, CASE WHEN conv_id % 2 = 0 THEN 's' || CAST(seq AS VARCHAR) ELSE 'fast_l0_' || CAST(ordinal AS VARCHAR) || '_' || substr(fingerprint, 1, 6) END AS message_id FROM o) SELECT ordinal, message_id, message_id AS record_message, captured AS content, captured AS fts_text FROM i",
    "q_import_summary": f"WITH {C} SELECT 'batch-001' AS batchId, {RECORD_ID} AS recordId, session_key AS sessionKey, role, ts_ms AS timestamp, fingerprint AS contentHash, session_id AS sessionId, {units('captured')} AS chars, CAST(NULL AS VARCHAR) AS sourceKey, file AS sourceFile, nullif(line_no - 1, 0) AS sourceLine FROM x WHERE filter_reason IS NULL",
    "q_pollution_summary": f"WITH {M}, {LINES} SELECT count(*) FILTER (match_kind = 'session_field') > 0 AS polluted, count(*) FILTER (match_kind = 'session_field') AS field_hits, count(*) FILTER (match_kind <> 'session_field') AS mentions FROM hits",
    "q_samples": f"WITH {M} (SELECT 'sample' AS kind, seq AS record_id, role AS type, content FROM m ORDER BY ts_ms, seq LIMIT 20) UNION ALL (SELECT 'suspicious', seq, role, substr(content, 1, 240) FROM m WHERE {has('content', fixed.SUSPICIOUS[0])} OR {has('content', fixed.SUSPICIOUS[1])} ORDER BY ts_ms, seq LIMIT 50)",
}
