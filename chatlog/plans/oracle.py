"""SQL twins of the queries, for DuckDB.

They say directly what the operators compute: plain windows, recursive CTEs and
string functions over whole tables, without the operators' blocks and salts.
"""

from __future__ import annotations

from chatlog import fixed
from chatlog.plans.inputs import AS_OF, duckdb_with

WS = "concat(" + ", ".join(f"chr({ord(c)})" for c in fixed.WHITESPACE) + ")"
NOW = f"TIMESTAMP '{AS_OF}'"
STARTED = "created_at - to_milliseconds(duration_ms)"
OPEN, CLOSE = f"'{fixed.THINK_OPEN}'", f"'{fixed.THINK_CLOSE}'"
TOOL, CALLS = f"'{fixed.TOOL_OPEN}'", f"'{fixed.CALLS_OPEN}'"
SQL: dict[str, str] = {}

USAGE = """
usage AS (
  SELECT a.*, CAST(coalesce(sum(l.prompt_tokens), 0) AS BIGINT) AS total_prompt_tokens,
         CAST(coalesce(sum(l.completion_tokens), 0) AS BIGINT) AS total_completion_tokens,
         count(l.id) AS total_requests
  FROM accounts a LEFT JOIN request_logs l ON a.id = l.account_id GROUP BY ALL)"""
BUSY = f"""
busy AS (
  SELECT a.*, (SELECT count(*) FROM request_logs l
               WHERE l.account_id = a.id AND l.{STARTED} <= {NOW} AND l.created_at > {NOW}) AS active_requests
  FROM accounts a)""".replace("l.created_at - to_milliseconds(duration_ms)", "l.created_at - to_milliseconds(l.duration_ms)")

SQL["usage_by_account"] = f"""
WITH {USAGE} SELECT id, alias, is_active, total_prompt_tokens, total_completion_tokens, total_requests FROM usage"""
SQL["monitor_summary"] = f"""
WITH {USAGE}, {BUSY}
SELECT count(*) FILTER (WHERE u.is_active) AS active_accounts,
       CAST(sum(b.active_requests) AS BIGINT) AS active_requests, CAST(sum(u.total_requests) AS BIGINT) AS total_requests
FROM usage u JOIN busy b ON u.id = b.id"""
SQL["token_totals_rollup"] = f"""
WITH {USAGE}
SELECT id AS account_id, CAST(sum(total_prompt_tokens) AS BIGINT) AS prompt_tokens,
       CAST(sum(total_completion_tokens) AS BIGINT) AS completion_tokens,
       CAST(sum(total_prompt_tokens) + sum(total_completion_tokens) AS BIGINT) AS total_tokens,
       grouping(id) = 1 AS is_grand_total
FROM usage GROUP BY ROLLUP (id)"""
TREND = """
SELECT epoch_us(date_trunc('hour', created_at)) AS bucket_us, endpoint, count(*) AS requests, {errors}
       CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS prompt_tokens,
       CAST(coalesce(sum(completion_tokens), 0) AS BIGINT) AS completion_tokens
FROM request_logs GROUP BY ALL"""
SQL["usage_trend_hourly"] = TREND.format(errors="count(*) FILTER (WHERE status = 'error') AS errors,")
SQL["stream_usage_trend"] = SQL["stream_usage_trend_late"] = TREND.format(errors="")
SQL["request_health"] = """
SELECT endpoint, count(*) AS requests, count(*) FILTER (WHERE status = 'error') AS errors,
       count(*) FILTER (WHERE status = 'success' AND prompt_tokens IS NULL) AS suspect_success,
       round(count(*) FILTER (WHERE status = 'error') / count(*), 9) AS error_rate,
       round(sum(reasoning_tokens) / sum(completion_tokens), 9) AS reasoning_share,
       quantile_cont(duration_ms, 0.5) AS p50_ms, quantile_cont(duration_ms, 0.95) AS p95_ms,
       quantile_cont(duration_ms, 0.99) AS p99_ms
FROM request_logs GROUP BY endpoint"""
SQL["request_health_by_account"] = """
SELECT account_id, count(*) AS requests, count(*) FILTER (WHERE status = 'error') AS errors,
       quantile_cont(duration_ms, 0.5) AS p50_ms, quantile_cont(duration_ms, 0.99) AS p99_ms
FROM (SELECT CASE WHEN account_id >= 1000000000 THEN NULL ELSE account_id END AS account_id, status, duration_ms FROM request_logs)
GROUP BY account_id"""
PAGE = "id, account_id, endpoint, status, duration_ms, error, epoch_us(created_at) AS created_us"
SQL["logs_page"] = f"""
SELECT {PAGE} FROM request_logs WHERE status = 'success' AND endpoint = 'openai'
ORDER BY created_at DESC, id LIMIT 50 OFFSET 100"""
SQL["logs_deep_page"] = f"""
SELECT {PAGE} FROM request_logs ORDER BY created_at DESC, id LIMIT 100 OFFSET 6000"""
SQL["logs_page_crowded"] = f"""
SELECT {PAGE} FROM (SELECT * REPLACE (date_trunc('day', created_at) AS created_at) FROM request_logs)
ORDER BY created_at DESC, id LIMIT 100 OFFSET 3000"""
SQL["logs_page_after"] = f"""
SELECT {PAGE} FROM request_logs
WHERE status = 'error' AND (created_at < {NOW} OR (created_at = {NOW} AND id > 0)) ORDER BY created_at DESC, id LIMIT 80"""
SQL["log_counts"] = """
SELECT count(*) AS total_all, count(*) FILTER (WHERE status = 'error' AND endpoint = 'anthropic') AS total_filtered
FROM request_logs"""
SQL["accounts_masked"] = """
SELECT id, coalesce(nullif(alias, ''), left(key_hash, 12)) AS label, coalesce(nullif(alias, ''), '-') AS alias,
       left(key_hash, 20) AS key_hash, epoch_us(created_at) AS created_us FROM accounts WHERE is_active"""
SQL["accounts_newest_first"] = """
SELECT id, alias, epoch_us(created_at) AS created_us FROM accounts ORDER BY created_at DESC, id"""
SQL["accounts_with_errors"] = """
SELECT id, alias, is_active FROM accounts
WHERE id IN (SELECT account_id FROM request_logs WHERE status = 'error')"""
SQL["least_busy_account"] = f"""
WITH {BUSY} SELECT id, alias, active_requests FROM busy WHERE is_active ORDER BY active_requests, id LIMIT 1"""
SWEEP = f"""
points AS (
  SELECT account_id, {STARTED} AS moment, 1 AS step FROM request_logs WHERE duration_ms > 0
  UNION ALL SELECT account_id, created_at, -1 FROM request_logs WHERE duration_ms > 0),
net AS (SELECT account_id, moment, sum(step) AS step FROM points GROUP BY ALL),
swept AS (
  SELECT account_id, moment, CAST(sum(step) OVER w AS BIGINT) AS in_flight, lead(moment) OVER w AS until
  FROM net WINDOW w AS (PARTITION BY account_id ORDER BY moment))"""
SQL["concurrency_profile"] = f"""
WITH {SWEEP} SELECT account_id, epoch_us(moment) AS at_us, in_flight FROM swept"""
SQL["concurrency_peaks"] = f"""
WITH {SWEEP}
SELECT account_id, max(in_flight) AS max_in_flight,
       CAST(coalesce(sum(epoch_us(until) - epoch_us(moment)) FILTER (WHERE in_flight >= 5), 0) AS BIGINT) AS us_at_cap,
       count(*) FILTER (WHERE in_flight >= 5) AS points_at_cap
FROM swept GROUP BY account_id"""
SQL["resolved_models"] = """
SELECT l.id, l.model_alias, coalesce(a.model, 'flash') AS model_effective, a.model IS NOT NULL AS alias_known,
       c.is_omni, c.default_temperature, c.max_tokens
FROM request_logs l LEFT JOIN model_aliases a ON a.alias = l.model_alias
LEFT JOIN model_capabilities c ON c.model = coalesce(a.model, 'flash')"""
SQL["session_usage"] = """
SELECT l.session_id, s.account_id AS session_account_id, count(*) AS logs,
       CAST(coalesce(sum(l.prompt_tokens), 0) AS BIGINT) AS prompt_tokens
FROM request_logs l LEFT JOIN sessions s ON s.id = l.session_id GROUP BY ALL"""
SQL["session_token_totals"] = """
SELECT session_id, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, count(*) AS requests,
       epoch_us(max(created_at)) AS last_used_us
FROM request_logs WHERE session_id IS NOT NULL AND prompt_tokens IS NOT NULL GROUP BY session_id"""
SQL["unique_key_report"] = """
SELECT account_id, client_session_id, count(*) AS copies FROM requests GROUP BY ALL HAVING count(*) > 1"""

# --- transcripts ---------------------------------------------------------------

RECENT = """
recent AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS from_end
  FROM conversations WHERE role <> 'system')"""
SQL["last_messages"] = f"""
WITH {RECENT}
SELECT conv_id, turn, role, CAST(from_end AS INT) AS from_end FROM recent WHERE from_end <= 3
UNION ALL SELECT conv_id, turn, role, NULL FROM conversations WHERE role = 'system'"""
SQL["last_texts"] = """
SELECT conv_id, coalesce(max_by(text, turn) FILTER (WHERE role = 'user'), '') AS last_user,
       max_by(role, turn) FILTER (WHERE role <> 'system') AS last_role,
       max_by(text, turn) FILTER (WHERE role <> 'system') AS last_text
FROM conversations GROUP BY conv_id"""


def _prompt(n: int, max_chars: int) -> str:
    return f"""
WITH {RECENT},
parts AS (
  SELECT c.conv_id,
    (SELECT string_agg(text, chr(10) ORDER BY turn) FROM conversations s WHERE s.conv_id = c.conv_id AND s.role = 'system') AS sys,
    (SELECT string_agg(role || ': ' || text, chr(10) ORDER BY turn) FROM recent r
     WHERE r.conv_id = c.conv_id AND from_end BETWEEN 2 AND {n}) AS hist,
    (SELECT any_value(text) FROM recent r WHERE r.conv_id = c.conv_id AND from_end = 1) AS cur
  FROM (SELECT DISTINCT conv_id FROM conversations) c),
labelled AS (
  SELECT conv_id, CASE WHEN sys <> '' THEN '{fixed.SYSTEM_LABEL}' || chr(10) || sys END AS sys,
         concat_ws(chr(10) || chr(10), '{fixed.HISTORY_LABEL}' || chr(10) || hist, '{fixed.CURRENT_LABEL}' || chr(10) || cur) AS rest
  FROM parts),
sized AS (SELECT *, {max_chars} - coalesce(length(sys), 0) - 2 AS room FROM labelled),
cut AS (
  SELECT conv_id, sys, CASE WHEN room > 0 AND length(rest) > room THEN right(rest, room) ELSE rest END AS rest FROM sized)
SELECT conv_id, coalesce(sys || chr(10) || chr(10), '') || rest AS prompt FROM cut"""


SQL["transcript_rendered"] = _prompt(fixed.MAX_REPLAY_MESSAGES, fixed.MAX_PROMPT_CHARS)
SQL["transcript_bounded"] = _prompt(4, 1500)
SQL["transcript_incremental"] = f"""
WITH parts AS (
  SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'system') AS sys,
         count(*) FILTER (WHERE role = 'system') AS n_sys,
         coalesce(max_by(text, turn) FILTER (WHERE role = 'user'), '') AS u
  FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN n_sys = 0 THEN u ELSE concat('{fixed.SYSTEM_LABEL}', chr(10), sys, chr(10), chr(10),
       '{fixed.CURRENT_LABEL}', chr(10), u) END AS prompt FROM parts"""
SQL["first_system_prompt"] = """
SELECT conv_id, coalesce(min_by(text, turn) FILTER (WHERE role = 'system'), '') AS system_prompt
FROM conversations GROUP BY conv_id"""
SQL["catalog_injected"] = """
WITH marked AS (
  SELECT *, min(CASE WHEN role = 'system' THEN turn END) OVER (PARTITION BY conv_id) AS first FROM conversations)
SELECT conv_id, turn, role,
       CASE WHEN turn = first THEN text || chr(10) || chr(10) || '- f(a*:string): short' ELSE text END AS text FROM marked
UNION ALL
SELECT DISTINCT conv_id, CAST(-1 AS BIGINT), 'system', '- f(a*:string): short' FROM marked WHERE first IS NULL"""
SQL["replay_savings"] = f"""
WITH reqs AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth FROM conversations WHERE role = 'user'),
msgs AS (
  SELECT q.conv_id, q.turn AS upto, q.nth, c.turn, c.role, c.text,
         row_number() OVER (PARTITION BY q.conv_id, q.turn, c.role = 'system' ORDER BY c.turn DESC) AS from_end
  FROM reqs q JOIN conversations c ON c.conv_id = q.conv_id AND c.turn <= q.turn),
parts AS (
  SELECT conv_id, upto, nth, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'system') AS sys,
         string_agg(role || ': ' || text, chr(10) ORDER BY turn) FILTER (WHERE role <> 'system' AND from_end BETWEEN 2 AND 4) AS hist,
         any_value(text) FILTER (WHERE role <> 'system' AND from_end = 1) AS cur
  FROM msgs GROUP BY ALL),
labelled AS (
  SELECT *, coalesce(CASE WHEN sys <> '' THEN '{fixed.SYSTEM_LABEL}' || chr(10) || sys END, '') AS s,
         concat_ws(chr(10) || chr(10), '{fixed.HISTORY_LABEL}' || chr(10) || hist, '{fixed.CURRENT_LABEL}' || chr(10) || cur) AS rest
  FROM parts),
cut AS (
  SELECT *, CASE WHEN 1500 - length(s) - 2 > 0 AND length(rest) > 1500 - length(s) - 2
                 THEN right(rest, 1500 - length(s) - 2) ELSE rest END AS kept FROM labelled),
sizes AS (
  SELECT conv_id, nth, length(CASE WHEN s = '' THEN kept ELSE s || chr(10) || chr(10) || kept END) AS full_chars,
         length(CASE WHEN sys IS NULL THEN cur ELSE concat('{fixed.SYSTEM_LABEL}', chr(10), sys, chr(10), chr(10),
                '{fixed.CURRENT_LABEL}', chr(10), cur) END) AS small FROM cut)
SELECT conv_id, count(*) AS requests, CAST(sum(full_chars) AS BIGINT) AS replay_chars,
       CAST(sum(CASE WHEN nth = 1 THEN full_chars ELSE small END) AS BIGINT) AS sent_chars,
       CAST(sum(CASE WHEN nth = 1 THEN 0 ELSE full_chars - small END) AS BIGINT) AS saved_chars
FROM sizes GROUP BY conv_id"""

# --- sessions --------------------------------------------------------------------


def _lane(i: int) -> str:
    return f"CAST('0x' || substr(d, {7 * i + 1}, 7) AS BIGINT) AS l{i}"


def _digest(n: str, sums: list[str]) -> str:
    return "sha256(concat_ws(':', " + ", ".join([f"CAST({n} AS VARCHAR)", *[f"CAST({s} AS VARCHAR)" for s in sums]]) + "))"


_SUMS = [f"sum(l{i}) OVER w" for i in range(8)]
HASHES = f"""
digests AS (SELECT conv_id, turn, sha256(concat_ws(':', turn, role, text)) AS d FROM conversations),
lanes AS (SELECT conv_id, turn, {", ".join(_lane(i) for i in range(8))} FROM digests),
hashes AS (
  SELECT conv_id, turn, count(*) OVER w AS n_messages, {_digest("count(*) OVER w", _SUMS)} AS list_hash,
         {_digest("count(*) OVER w - 1", [f"{s} - l{i}" for i, s in enumerate(_SUMS)])} AS history_hash
  FROM lanes WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"""
SQL["history_chain_hash"] = f"WITH {HASHES} SELECT conv_id, turn, n_messages, list_hash, history_hash FROM hashes"
CONTINUITY = f"""{HASHES},
left_behind AS (
  SELECT r.*, h.n_messages, h.list_hash, h.history_hash,
         lag(CASE WHEN prompt_tokens IS NOT NULL THEN list_hash ELSE history_hash END) OVER s AS stored,
         lag(CASE WHEN prompt_tokens IS NOT NULL THEN n_messages ELSE n_messages - 1 END) OVER s AS stored_n
  FROM requests r JOIN hashes h ON h.conv_id = r.conv_id AND h.turn = r.turn
  WINDOW s AS (PARTITION BY account_id, client_session_id ORDER BY request_id)),
checked AS (
  SELECT l.*, coalesce(l.stored = l.history_hash, false) AS strictly,
         coalesce(l.stored_n = 0 OR (l.stored_n < l.n_messages AND p.list_hash = l.stored), false) AS appends
  FROM left_behind l LEFT JOIN hashes p ON p.conv_id = l.conv_id AND p.n_messages = l.stored_n)"""
for _name, _flag in (("session_continuity", "appends"), ("session_continuity_strict", "strictly")):
    SQL[_name] = f"""
WITH {CONTINUITY} SELECT request_id, n_messages, list_hash, history_hash, {_flag} AS matches FROM checked"""


def _folded(source: str, matches: str) -> str:
    """Sessions by stepping through each key's requests; `matches` says whether one may continue."""
    return f"""
numbered AS (
  SELECT *, {matches} AS may, row_number() OVER (PARTITION BY account_id, client_session_id ORDER BY request_id) AS nth
  FROM {source}),
fold AS (
  SELECT *, false AS reused, CAST(0 AS BIGINT) AS generation, CAST(coalesce(prompt_tokens, 0) AS BIGINT) AS session_tokens
  FROM numbered WHERE nth = 1
  UNION ALL
  SELECT n.*, n.may AND f.session_tokens <= 1000,
         CASE WHEN n.may AND f.session_tokens <= 1000 THEN f.generation ELSE f.generation + 1 END,
         CASE WHEN n.may AND f.session_tokens <= 1000 THEN f.session_tokens ELSE 0 END + coalesce(n.prompt_tokens, 0)
  FROM fold f JOIN numbered n ON n.account_id = f.account_id AND n.client_session_id = f.client_session_id
   AND n.nth = f.nth + 1)"""


SQL["session_rollover"] = f"""
WITH RECURSIVE {_folded("requests", "true")}
SELECT request_id, account_id, client_session_id, generation, session_tokens FROM fold"""
SQL["session_history"] = f"""
WITH RECURSIVE {CONTINUITY}, {_folded("checked", "appends")}
SELECT request_id, reused, generation, session_tokens FROM fold"""
SQL["stream_sessions_append"] = SQL["session_history"]
SQL["stream_sessions"] = f"""
WITH RECURSIVE {CONTINUITY}, {_folded("checked", "strictly")}
SELECT request_id, reused, generation, session_tokens FROM fold"""
SQL["session_snapshot"] = f"""
WITH RECURSIVE {CONTINUITY}, {_folded("checked", "appends")}
SELECT sha256('conversation:' || account_id || ':' || client_session_id || ':' || generation) AS conversation_id,
       account_id, client_session_id, generation, count(*) AS requests,
       CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS prompt_tokens,
       max_by(list_hash, request_id) AS last_messages_hash, max_by(n_messages, request_id) AS last_msg_count,
       epoch_us(min(created_at)) AS created_us, epoch_us(max(created_at)) AS last_used_us
FROM fold f
WHERE generation = (SELECT max(generation) FROM fold g WHERE g.account_id = f.account_id AND g.client_session_id = f.client_session_id)
GROUP BY account_id, client_session_id, generation
HAVING max(created_at) >= {NOW} - INTERVAL 7 DAY"""
SQL["session_changes_applied"] = """
WITH late AS (
  SELECT * FROM session_changes c WHERE op <> 'delete' AND NOT EXISTS (
    SELECT 1 FROM session_changes d WHERE d.id = c.id AND d.op = 'delete' AND d.seq >= c.seq)),
kept AS (
  SELECT * FROM late c WHERE op <> 'update' OR EXISTS (
    SELECT 1 FROM late b WHERE b.id = c.id AND b.op <> 'update' AND b.seq < c.seq))
SELECT id, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS prompt_tokens, max_by(last_msg_count, seq) AS last_msg_count
FROM kept GROUP BY id"""

SQL["stream_session_changes"] = SQL["session_changes_applied"]

# --- outcomes ----------------------------------------------------------------------


def _case(pairs, other: str) -> str:
    return "CASE http_status " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in pairs) + f" ELSE {other} END"


_KINDS = _case([(k, v[0]) for k, v in fixed.OUTCOMES.items()], f"'{fixed.OTHER_OUTCOME[0]}'")
_TEXTS = _case(
    [(k, v[1].format(service="API", status=k)) for k, v in fixed.OUTCOMES.items()],
    "'" + fixed.OTHER_OUTCOME[1].format(service="API", status="") + "' || http_status",
)
CLASSES = f"""
failed AS (
  SELECT *, CASE WHEN http_status IS NULL THEN 'api_error' ELSE {_KINDS} END AS outcome_type,
         CASE WHEN http_status IS NULL THEN error ELSE {_TEXTS} END AS outcome_message
  FROM request_logs WHERE status = 'error'),
classes AS (
  SELECT *, CASE WHEN outcome_type = 'auth' THEN 401 WHEN outcome_type LIKE 'banned%' THEN 403
                 WHEN outcome_type = 'rate_limit' THEN 429 ELSE 502 END AS client_status,
         outcome_type = 'auth' OR outcome_type LIKE 'banned%'
           OR (http_status IS NULL AND (error LIKE '%401%' OR error LIKE '%403%')) AS deactivates
  FROM failed)"""
SQL["outcome_classes"] = f"""
WITH {CLASSES} SELECT id, http_status, outcome_type, outcome_message, client_status, deactivates FROM classes"""
BAN = "CASE outcome_type WHEN 'banned_temporary' THEN 'TEMPORARY' WHEN 'banned_permanent' THEN 'PERMANENT' END"
SQL["account_state_final"] = f"""
WITH {CLASSES},
hits AS (
  SELECT account_id, max_by({BAN}, struct_pack(a := created_at, b := id)) FILTER (WHERE {BAN} IS NOT NULL) AS ban
  FROM classes WHERE deactivates AND created_at <= {NOW} GROUP BY account_id)
SELECT a.id, a.alias, a.is_active AND h.account_id IS NULL AS is_active, coalesce(h.ban, a.banned_status) AS banned_status
FROM accounts a LEFT JOIN hits h ON h.account_id = a.id"""
SQL["account_state_history"] = f"""
WITH {CLASSES},
state AS (
  SELECT account_id, created_at, id,
         last_value({BAN} IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY created_at, id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ban
  FROM classes WHERE deactivates),
steps AS (
  SELECT *, row_number() OVER w AS nth, lag(ban) OVER w AS earlier FROM state
  WINDOW w AS (PARTITION BY account_id ORDER BY created_at, id))
SELECT account_id AS id, epoch_us(created_at) AS from_us,
       epoch_us(lead(created_at) OVER (PARTITION BY account_id ORDER BY created_at, steps.id)) AS to_us,
       false AS is_active, ban AS banned_status
FROM steps WHERE nth = 1 OR ban IS DISTINCT FROM earlier"""

SQL["account_changes_applied"] = """
WITH late AS (
  SELECT * FROM account_changes c WHERE op <> 'delete' AND NOT EXISTS (
    SELECT 1 FROM account_changes d WHERE d.id = c.id AND d.op = 'delete' AND d.seq > c.seq)),
kept AS (
  SELECT * FROM late c WHERE op <> 'update'
    OR EXISTS (SELECT 1 FROM late b WHERE b.id = c.id AND b.op <> 'update' AND b.seq < c.seq)
    OR (c.id IN (SELECT id FROM accounts) AND c.id NOT IN (SELECT id FROM account_changes WHERE op = 'delete'))),
written AS (
  SELECT id, arg_max(struct_pack(v := alias), seq) FILTER (WHERE field = 'alias') AS al,
         arg_max(struct_pack(v := is_active), seq) FILTER (WHERE field = 'is_active') AS ac
  FROM kept GROUP BY id),
gone AS (SELECT DISTINCT id FROM account_changes WHERE op = 'delete'),
base AS (SELECT * FROM accounts WHERE id NOT IN (SELECT id FROM gone))
SELECT coalesce(b.id, w.id) AS id, CASE WHEN al IS NULL THEN b.alias ELSE al.v END AS alias,
       CASE WHEN ac IS NULL THEN b.is_active ELSE ac.v END AS is_active, b.banned_status
FROM base b FULL JOIN written w ON w.id = b.id"""

# --- responses -----------------------------------------------------------------------


def _split(text: str) -> str:
    """reasoning, answer columns of a text column."""
    both = f"strpos({text}, {OPEN}) > 0 AND strpos({text}, {CLOSE}) > 0"
    return f"""CASE WHEN {both} THEN substr({text}, strpos({text}, {OPEN}) + 7,
              greatest(strpos({text}, {CLOSE}) - strpos({text}, {OPEN}) - 7, 0)) ELSE '' END AS reasoning,
         CASE WHEN {both} THEN ltrim(substr({text}, strpos({text}, {CLOSE}) + 8), {WS}) ELSE {text} END AS answer"""


def _without_closed(text: str) -> str:
    return f"regexp_replace({text}, '(?s)<think>.*?</think>', '', 'g')"


def _cut_open(text: str) -> str:
    return f"CASE WHEN strpos({text}, {OPEN}) > 0 THEN substr({text}, 1, strpos({text}, {OPEN}) - 1) ELSE {text} END"


def _marker(text: str) -> str:
    """1-based position of the first marker, 0 without one."""
    return f"coalesce(least(nullif(strpos({text}, {TOOL}), 0), nullif(strpos({text}, {CALLS}), 0)), 0)"


SQL["reasoning_split"] = f"SELECT response_id, {_split('text')} FROM responses"
SQL["reasoning_stripped"] = f"""
WITH closed AS (SELECT response_id, {_without_closed('text')} AS t FROM responses)
SELECT response_id, ltrim({_cut_open('t')}, {WS}) AS cut, ltrim(t, {WS}) AS kept FROM closed"""
SQL["tool_marker_split"] = f"""
WITH marked AS (SELECT *, {_marker('text')} AS p FROM responses)
SELECT response_id, CASE WHEN p > 0 THEN substr(text, 1, p - 1) ELSE text END AS answer,
       CASE WHEN p > 0 THEN substr(text, p) ELSE '' END AS tool_buffer, p > 0 AS has_marker FROM marked"""
BLOCKS = f"""
answers AS (SELECT response_id, {_split('text')} FROM responses),
blocks AS (
  SELECT response_id, unnest(regexp_extract_all({{source}}, '(?s)<tool_call>(.*?)</tool_call>', 1)) AS raw,
         generate_subscripts(regexp_extract_all({{source}}, '(?s)<tool_call>(.*?)</tool_call>', 1), 1) - 1 AS ord
  FROM {{table}}),
bodies_ AS (SELECT response_id, ord, trim(raw, {WS}) AS body FROM blocks),
typed AS (
  SELECT *, CASE WHEN starts_with(body, '{{{{') THEN 'json' WHEN contains(body, '<name') THEN 'name'
                 WHEN contains(body, '<tool_name>') THEN 'tool_name' WHEN regexp_matches(body, '<function=[^>\\n]+>') THEN 'function'
                 WHEN regexp_matches(body, '^<[a-zA-Z_][a-zA-Z0-9_]*>') THEN 'tag' ELSE 'none' END AS dialect FROM bodies_)"""


def _blocks(table: str, source: str) -> str:
    return BLOCKS.format(table=table, source=source)


SQL["tool_blocks"] = f"""
WITH {_blocks('responses', 'text')} SELECT response_id, ord, dialect, body FROM typed"""


def _call_id(ord_: str) -> str:
    return f"concat('call_', left(sha256(concat_ws(':', response_id, {ord_})), 8))"


# No response holds a block that fails in front of one that reads, so a call's number is its block's.
SQL["tool_calls_json"] = f"""
WITH {_blocks('responses', 'text')},
calls AS (SELECT response_id, ord, json_extract_string(body, '$.name') AS name, json_extract(body, '$.arguments') AS args
          FROM typed WHERE dialect = 'json' AND json_valid(body)),
keyed AS (SELECT *, unnest(json_keys(args)) AS key FROM calls WHERE name <> '')
SELECT response_id, ord, {_call_id('ord')} AS call_id, 'json' AS dialect, name, key,
       CAST(json_extract(args, '$.' || key) AS VARCHAR) AS value FROM keyed"""
_VALUE = f"CASE WHEN json_valid(trim(v, {WS})) THEN trim(v, {WS}) ELSE CAST(to_json(trim(v, {WS})) AS VARCHAR) END"


def _pairs(source: str, dialect: str, name: str, pattern: str, keys: str, value_group: int) -> str:
    return f"""
  SELECT response_id, ord, '{dialect}' AS dialect, trim({name}, {WS}) AS name,
         unnest({keys}) AS k, unnest(regexp_extract_all(body, '{pattern}', {value_group})) AS v
  FROM {source} WHERE dialect = '{dialect}'"""


_NAME = '(?s)<param(?:\\s+name="([^"]+)")?(?:\\s+key="([^"]+)")?[^>]*>(.*?)</param>'
_NAME_KEYS = (
    f"list_transform(list_zip(regexp_extract_all(body, '{_NAME}', 1), regexp_extract_all(body, '{_NAME}', 2)), "
    "lambda z: CASE WHEN z[1] <> '' THEN z[1] ELSE z[2] END)"
)
_ARG = "(?s)<arg_key>([^<]+)</arg_key>\\s*<arg_value>(.*?)</arg_value>"
_PAR = "(?s)<parameter=([^>\\n]+)>(.*?)(?:</parameter>|\\n</function>|\\z)"
_INV = '(?s)<invoke name="([^"]+)">(.*?)</invoke>'
_IPAR = '(?s)<parameter name="([^"]+)">(.*?)</parameter>'


def _markup(table: str, source: str) -> str:
    """CTEs ending in `pairs`: (response_id, ord, dialect, name, k, v) of the markup dialects."""
    return f"""{_blocks(table, source)},
lists AS (
  SELECT response_id, unnest(regexp_extract_all({source}, '(?s)<function_calls>(.*?)</function_calls>', 1)) AS block
  FROM {table} WHERE NOT contains({source}, {TOOL})),
invokes AS (
  SELECT response_id, 'invoke' AS dialect, unnest(regexp_extract_all(block, '{_INV}', 1)) AS name,
         unnest(regexp_extract_all(block, '{_INV}', 2)) AS body,
         generate_subscripts(regexp_extract_all(block, '{_INV}', 1), 1) - 1 AS ord FROM lists),
pairs AS ({_pairs('typed', 'name', "regexp_extract(body, '<name>([^<]+?)</name>', 1)", _NAME, _NAME_KEYS, 3)}
  UNION ALL {_pairs('typed', 'tool_name', "regexp_extract(body, '<tool_name>([^<]+)</tool_name>', 1)", _ARG,
                    f"regexp_extract_all(body, '{_ARG}', 1)", 2)}
  UNION ALL {_pairs('typed', 'function', "regexp_extract(body, '<function=([^>]+)>', 1)", _PAR,
                    f"regexp_extract_all(body, '{_PAR}', 1)", 2)}
  UNION ALL {_pairs('invokes', 'invoke', "name", _IPAR, f"regexp_extract_all(body, '{_IPAR}', 1)", 2)})"""


SQL["tool_calls_markup"] = f"""
WITH {_markup('answers', 'answer')}
SELECT response_id, ord, {_call_id('ord')} AS call_id, dialect, name, k AS key, {_VALUE} AS value FROM pairs"""
# RE2 has no back-references: elements without inner tags, whose two names are compared.
_LEAF = "(?s)<([a-zA-Z_][a-zA-Z0-9_]*)>([^<]*)</([a-zA-Z_][a-zA-Z0-9_]*)>"
TAGS = f"""
leaves AS (
  SELECT response_id, ord, dialect, regexp_extract(body, '^<([a-zA-Z_][a-zA-Z0-9_]*)>', 1) AS name,
         unnest(regexp_extract_all(body, '{_LEAF}', 1)) AS k, unnest(regexp_extract_all(body, '{_LEAF}', 2)) AS v,
         unnest(regexp_extract_all(body, '{_LEAF}', 3)) AS k2
  FROM typed WHERE dialect = 'tag')"""
SQL["tool_calls_tag"] = f"""
WITH {_blocks('answers', 'answer')}, {TAGS}
SELECT response_id, ord, name,
       '{{' || string_agg(CAST(to_json(k) AS VARCHAR) || ':' || {_VALUE}, ',' ORDER BY k) || '}}' AS arguments_json
FROM leaves WHERE k = k2 AND k <> name GROUP BY ALL"""
SQL["tool_usage_report"] = f"""
WITH {_blocks('answers', 'answer')},
named AS (
  SELECT response_id, dialect, CASE dialect
      WHEN 'json' THEN CASE WHEN json_valid(body) THEN json_extract_string(body, '$.name') END
      WHEN 'name' THEN regexp_extract(body, '<name>([^<]+?)</name>', 1)
      WHEN 'tool_name' THEN regexp_extract(body, '<tool_name>([^<]+)</tool_name>', 1)
      WHEN 'function' THEN regexp_extract(body, '<function=([^>]+)>', 1)
      WHEN 'tag' THEN regexp_extract(body, '^<([a-zA-Z0-9_]+)>', 1) END AS name FROM typed
  UNION ALL
  SELECT response_id, 'invoke', unnest(regexp_extract_all(answer, '<invoke name="([^"]+)">', 1))
  FROM answers WHERE contains(answer, {CALLS}) AND NOT contains(answer, {TOOL})),
good AS (SELECT * FROM named WHERE name IS NOT NULL),
bad AS (SELECT response_id FROM answers WHERE {_marker('answer')} > 0 AND response_id NOT IN (SELECT response_id FROM good))
SELECT name, dialect, count(*) AS calls, CAST(0 AS BIGINT) AS failed_responses FROM good GROUP BY ALL
UNION ALL SELECT NULL, NULL, CAST(0 AS BIGINT), count(*) FROM bad HAVING count(*) > 0"""

_J = "CAST(to_json({}) AS VARCHAR)".format
_USAGE = (
    "concat('{\"prompt_tokens\":', length(text), ',\"completion_tokens\":', kind, ',\"total_tokens\":', length(text) + kind, "
    "',\"completion_tokens_details\":{\"reasoning_tokens\":0}}')"
)
SQL["chat_export"] = f"""
WITH {_markup('responses', 'text')}, {TAGS},
args AS (
  SELECT response_id, ord, name, k, {_VALUE} AS value FROM pairs
  UNION ALL SELECT response_id, ord, name, k, {_VALUE} FROM leaves WHERE k = k2 AND k <> name
  UNION ALL
  SELECT response_id, ord, name, k, CAST(json_extract(a, '$.' || k) AS VARCHAR) FROM (
    SELECT response_id, ord, json_extract_string(body, '$.name') AS name, json_extract(body, '$.arguments') AS a,
           unnest(json_keys(json_extract(body, '$.arguments'))) AS k
    FROM typed WHERE dialect = 'json' AND json_valid(body))),
calls AS (
  SELECT response_id, ord, {_call_id('ord')} AS id, name,
         '{{' || string_agg({_J('k')} || ':' || value, ',' ORDER BY k) || '}}' AS args FROM args GROUP BY ALL),
lists_ AS (
  SELECT response_id,
    string_agg(concat('{{"id":', {_J('id')}, ',"type":"function","function":{{"name":', {_J('name')}, ',"arguments":', {_J('args')}, '}}}}'), ',' ORDER BY ord) AS functions,
    string_agg(concat('{{"type":"tool_use","id":', {_J('id')}, ',"name":', {_J('name')}, ',"input":', args, '}}'), ',' ORDER BY ord) AS uses
  FROM calls GROUP BY response_id),
closed AS (SELECT *, {_without_closed('text')} AS t FROM responses),
parts AS (
  SELECT c.response_id, c.text, c.kind, ltrim({_cut_open('c.t')}, {WS}) AS stripped, a.reasoning, a.answer, l.functions, l.uses
  FROM closed c JOIN answers a ON a.response_id = c.response_id LEFT JOIN lists_ l ON l.response_id = c.response_id)
SELECT response_id,
  concat('{{"id":"', response_id, '","object":"chat.completion","model":"flash","choices":[{{"index":0,"message":{{"role":"assistant","content":',
    CASE WHEN functions IS NULL THEN {_J('stripped')} ELSE concat('null,"tool_calls":[', functions, ']') END,
    '}},"finish_reason":"', CASE WHEN functions IS NULL THEN 'stop' ELSE 'tool_calls' END, '"}}],"usage":', {_USAGE}, '}}') AS openai,
  concat('{{"id":"', response_id, '","type":"message","role":"assistant","content":[',
    CASE WHEN reasoning <> '' THEN concat('{{"type":"thinking","thinking":', {_J('reasoning')}, '}},') ELSE '' END,
    '{{"type":"text","text":', {_J('answer')}, '}}', coalesce(',' || uses, ''), '],"model":"flash","stop_reason":"',
    CASE WHEN uses IS NULL THEN 'end_turn' ELSE 'tool_use' END, '","stop_sequence":null,"usage":{{"input_tokens":', length(text),
    ',"output_tokens":', kind, '}}}}') AS anthropic
FROM parts"""

# --- requests ------------------------------------------------------------------------

SQL["flattened_messages"] = f"""
WITH src AS (SELECT conv_id * 100 + turn AS req_id, conv_id, (conv_id + turn) % 5 AS kind, text FROM conversations),
msgs AS (
  SELECT req_id, 0 AS turn, 'system' AS role, 'be brief' AS text FROM src WHERE kind = 0
  UNION ALL SELECT req_id, 1, 'user', text FROM src WHERE kind = 0
  UNION ALL SELECT req_id, 0, 'user', text || chr(10) || 'b' FROM src WHERE kind = 1
  UNION ALL SELECT req_id, 0, 'assistant', concat('<tool_call>', chr(10), '{{"name":"f","arguments":{{"x":', conv_id, ',"a":',
                   CAST(to_json(text) AS VARCHAR), '}}}}', chr(10), '</tool_call>') FROM src WHERE kind = 2
  UNION ALL SELECT req_id, 1, 'user', '{fixed.TOOL_RESULT_LABEL}' || chr(10) || text FROM src WHERE kind = 2
  UNION ALL SELECT req_id, 0, 'user', '{fixed.TOOL_RESULT_LABEL}' || chr(10) || text || 'v' FROM src WHERE kind = 3
  UNION ALL SELECT req_id, 0, 'user', '[1]' FROM src WHERE kind = 4
  UNION ALL SELECT req_id, 1, 'user', text FROM src WHERE kind = 4)
SELECT req_id, CAST(turn AS BIGINT) AS turn, role, text FROM msgs"""
_MODEL = "coalesce(json_extract_string(body, '$.model'), '') AS model"
_COUNTS = """coalesce(CAST(json_extract(body, '$.stream') AS BOOLEAN), false) AS is_stream,
       coalesce(CAST(json_array_length(json_extract(body, '$.tools')) AS BIGINT), 0) AS n_tools"""
SQL["request_parameters_openai"] = f"""
SELECT req_id, {_MODEL}, coalesce(CAST(json_extract(body, '$.temperature') AS DOUBLE), 0.8) AS temperature,
       coalesce(CAST(json_extract(body, '$.top_p') AS DOUBLE), 0.95) AS top_p, kind = 3 AS thinking,
       coalesce(json_extract_string(body, '$.web_search'), 'disabled') AS web_search, {_COUNTS},
       '' AS system_prompt, CAST(json_array_length(json_extract(body, '$.messages')) AS BIGINT) AS n_messages
FROM bodies"""
SQL["request_parameters_anthropic"] = f"""
SELECT req_id, {_MODEL}, CAST(0.8 AS DOUBLE) AS temperature, CAST(0.95 AS DOUBLE) AS top_p, kind = 1 AS thinking,
       'disabled' AS web_search, {_COUNTS}, CASE WHEN kind = 0 THEN 'be brief' ELSE '' END AS system_prompt,
       CAST(CASE kind WHEN 1 THEN 1 WHEN 3 THEN 1 ELSE 2 END AS BIGINT) AS n_messages
FROM bodies"""
SQL["tool_catalog"] = """
WITH lines AS (
  SELECT p_brand AS brand, p_partkey, CASE p_partkey % 3
    WHEN 0 THEN concat('- ', replace(p_name, ' ', '_'), '(size*:integer, note:any): ', p_type)
    WHEN 1 THEN concat('- ', replace(p_name, ' ', '_'), '(n:number): ', left(repeat(p_name || ' ', 20), 120))
    ELSE concat('- ', replace(p_name, ' ', '_'), '(): ') END AS line FROM part)
SELECT brand, '[Tools]' || chr(10) || string_agg(line, chr(10) ORDER BY p_partkey) AS catalog FROM lines GROUP BY brand"""
SQL["redacted_text"] = """
SELECT doc_id, CASE doc_id % 5
  WHEN 0 THEN concat(text, chr(10), 'curl -b "sid=***; userId=***" -X GET')
  WHEN 1 THEN concat('curl -H ', chr(39), 'Cookie: serviceToken=***; userId=***; other_ph="***"', chr(39), ' -d a=b', chr(10), text)
  WHEN 2 THEN concat(text, chr(10), 'Cookie: plain=***; x_y=***', chr(10), 'curl --cookie only=*** --data k=v')
  WHEN 3 THEN concat('no command, key=value and token=*** ', text) ELSE text END AS text,
       CAST(CASE doc_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 3 ELSE 0 END AS BIGINT) AS cookie_hits,
       CAST(CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS sid_hits,
       CAST(CASE WHEN doc_id % 5 < 2 THEN 1 ELSE 0 END AS BIGINT) AS "userId_hits", doc_id % 5 < 3 AS has_command
FROM documents"""

SQL["redacted_commands"] = """
SELECT doc_id, CASE doc_id % 8
  WHEN 0 THEN concat(text, chr(10), 'curl -b $', chr(39), 'a=***; serviceToken=***', chr(39))
  WHEN 1 THEN concat('curl -H $', chr(39), 'cookie: serviceToken=***', chr(39), chr(10), text)
  WHEN 2 THEN concat(text, chr(10), 'curl -b', chr(39), 'serviceToken=***', chr(39), ' -X GET')
  WHEN 3 THEN concat('curl -sb ', chr(39), 'serviceToken=***', chr(39), chr(10), text)
  WHEN 4 THEN concat(text, chr(10), 'curl -b ', chr(92), chr(10), chr(39), 'serviceToken=***', chr(39))
  WHEN 5 THEN concat(text, chr(10), 'curl -H "cOOkie: serviceToken=***" -d a=b')
  WHEN 6 THEN concat(text, chr(10), 'curl -b "a=***; serviceToken=***"')
  ELSE text END AS text,
       CAST(CASE doc_id % 8 WHEN 0 THEN 2 WHEN 6 THEN 2 WHEN 7 THEN 0 ELSE 1 END AS BIGINT) AS cookie_hits, doc_id % 8 < 7 AS has_command
FROM documents"""

# --- captured streams ----------------------------------------------------------------

SQL["accounts_read_back"] = """
SELECT id, alias, is_active, CAST(NULL AS BIGINT) AS active_requests FROM accounts"""
SQL["sessions_read_live"] = """
SELECT id, account_id, requests FROM sessions WHERE requests >= 3"""
SQL["logs_read_by_day"] = """
SELECT id, endpoint, epoch_us(created_at) AS created_us FROM request_logs
WHERE created_at >= TIMESTAMP '2024-01-05 06:00:00' AND created_at < TIMESTAMP '2024-01-09 18:00:00'"""
SQL["logs_evolved"] = """
SELECT id, CAST(NULL AS BIGINT) AS account_id, CAST(NULL AS VARCHAR) AS status, endpoint, 1 AS extra FROM request_logs"""
SQL["event_chunks"] = """
SELECT response_id, seq, type, content, coalesce(prompt_tokens, CASE WHEN type = 'usage' THEN 0 END) AS prompt_tokens,
       coalesce(completion_tokens, CASE WHEN type = 'usage' THEN 0 END) AS completion_tokens,
       CASE WHEN type = 'usage' THEN CAST(0 AS BIGINT) END AS reasoning_tokens
FROM chunks WHERE type <> 'error'"""
SQL["event_chunks_from_files"] = SQL["event_chunks"]
SQL["served_models"] = "SELECT DISTINCT alias, model FROM model_aliases"
SQL["event_chunks_text_ids"] = """
SELECT 'r-' || response_id AS response_id, seq, type, content FROM chunks WHERE type <> 'error'"""
SQL["captures_numbered"] = """
WITH lines AS (SELECT source, lpad(CAST(doc_id AS VARCHAR), 12, '0') || ' ' || translate(coalesce(text, ''), chr(10) || chr(13), '  ') AS line FROM documents),
every AS (SELECT * FROM lines UNION ALL SELECT 'all', line FROM lines)
SELECT source, row_number() OVER (PARTITION BY source ORDER BY line) - 1 AS line_no, line FROM every"""
SQL["stream_chunks"] = """
WITH kept AS (SELECT * FROM chunks WHERE type <> 'error'),
ends AS (SELECT response_id, max(seq) AS last FROM kept GROUP BY response_id)
SELECT response_id, seq, type, content, coalesce(prompt_tokens, CASE WHEN type = 'usage' THEN 0 END) AS prompt_tokens,
       coalesce(completion_tokens, CASE WHEN type = 'usage' THEN 0 END) AS completion_tokens,
       CASE WHEN type = 'usage' THEN CAST(0 AS BIGINT) END AS total_tokens,
       CASE WHEN type = 'usage' THEN CAST(0 AS BIGINT) END AS reasoning_tokens FROM kept
UNION ALL SELECT response_id, last + 1, 'text', 'after', NULL, NULL, NULL, NULL FROM ends
UNION ALL SELECT response_id, last + 2, 'usage', NULL, 1, 2, 0, 0 FROM ends"""
SQL["stream_late_logs"] = """
SELECT account_id, count(*) AS logs, CAST(sum(id) AS BIGINT) AS id_sum FROM request_logs GROUP BY account_id"""


def _assembled(stop: bool) -> str:
    error = ", max(content) FILTER (WHERE type = 'error') AS error" if stop else ""
    return f"""
WITH ends AS (SELECT response_id, min(seq) FILTER (WHERE type = 'error') AS e FROM chunks GROUP BY response_id),
kept AS (SELECT c.* FROM chunks c JOIN ends USING (response_id) WHERE {'e IS NULL OR seq <= e' if stop else 'true'})
SELECT response_id, coalesce(string_agg(content, '' ORDER BY seq) FILTER (WHERE type = 'text'), '') AS text,
       max_by(prompt_tokens, seq) FILTER (WHERE type = 'usage') AS prompt_tokens,
       max_by(completion_tokens, seq) FILTER (WHERE type = 'usage') AS completion_tokens,
       bool_or(type = 'finish') AS finished{error}
FROM kept GROUP BY response_id"""


SQL["assembled_responses"] = _assembled(True)
SQL["assembled_ignoring_errors"] = _assembled(False)
PIECES = f"""
texts AS (SELECT response_id, seq, content AS t FROM chunks WHERE type = 'text' AND content <> ''),
firsts AS (
  SELECT *, min(seq) OVER (PARTITION BY response_id) AS f, first_value(t) OVER (PARTITION BY response_id ORDER BY seq) AS ft,
         min(CASE WHEN contains(t, {CLOSE}) THEN seq END) OVER (PARTITION BY response_id) AS c FROM texts),
opens AS (
  SELECT response_id, seq, c, contains(ft, {OPEN}) AS opened,
         CASE WHEN seq = f AND contains(ft, {OPEN}) THEN replace(t, {OPEN}, '') ELSE t END AS t FROM firsts),
closed_off AS (SELECT *, {_without_closed('t')} AS w FROM opens),
pieces AS (
  SELECT response_id, seq, opened, c, NOT opened OR coalesce(seq > c, false) AS past,
         CASE WHEN NOT opened OR seq > c THEN '' WHEN seq = c THEN substr(t, 1, strpos(t, {CLOSE}) - 1) ELSE t END AS reasoning,
         CASE WHEN NOT opened OR seq > c THEN {_cut_open('w')}
              WHEN seq = c THEN ltrim(substr(t, strpos(t, {CLOSE}) + 8), {WS}) ELSE '' END AS answer
  FROM closed_off),
joined AS (
  SELECT response_id, string_agg(reasoning, '' ORDER BY seq) AS reasoning, string_agg(answer, '' ORDER BY seq) AS answer,
         bool_or(opened) AS opened, bool_or(opened AND c IS NOT NULL) AS closed FROM pieces GROUP BY response_id)"""
SQL["chunk_reasoning"] = f"""
WITH {PIECES}
SELECT response_id, reasoning, answer, opened, closed, true AS finished,
       CASE WHEN opened THEN concat('<think>', reasoning, '</think>', answer) ELSE answer END AS content FROM joined"""
SQL["chunk_tool_buffer"] = f"""
WITH {PIECES}, marked AS (SELECT response_id, answer, {_marker('answer')} AS p FROM joined)
SELECT response_id, CASE WHEN p > 0 THEN substr(answer, 1, p - 1) ELSE answer END AS emitted,
       CASE WHEN p > 0 THEN substr(answer, p) ELSE '' END AS tool_buffer, true AS finished FROM marked"""
SQL["stream_segments"] = f"""
WITH {PIECES}, marked AS (SELECT *, {_marker('answer')} AS p FROM joined),
kinds AS (
  SELECT response_id, 'reasoning' AS kind, reasoning AS text FROM joined
  UNION ALL SELECT response_id, 'answer', CASE WHEN p > 0 THEN substr(answer, 1, p - 1) ELSE answer END FROM marked
  UNION ALL SELECT response_id, 'tool_buffer', CASE WHEN p > 0 THEN substr(answer, p) ELSE '' END FROM marked)
SELECT * FROM kinds WHERE text <> ''"""
CUT = f"""
WITH {PIECES},
so_far AS (
  SELECT response_id, seq, past, answer, string_agg(answer, '') OVER (PARTITION BY response_id ORDER BY seq) AS upto
  FROM pieces WHERE answer <> ''),
looked AS (SELECT *, {_marker('upto')} AS p FROM so_far),
opening AS (SELECT response_id, min(seq) AS o FROM looked WHERE past AND p > 0 GROUP BY response_id),
cuts AS (
  SELECT l.response_id, min(seq) AS cut_seq FROM looked l JOIN opening USING (response_id)
  WHERE seq > o AND (contains(substr(upto, p), '{fixed.TOOL_CLOSE}') OR contains(substr(upto, p), '{fixed.CALLS_CLOSE}'))
  GROUP BY l.response_id)
SELECT c.response_id, c.cut_seq, length(l.upto) AS kept_chars, length(j.answer) - length(l.upto) AS lost_chars,
       EXISTS (SELECT 1 FROM chunks u WHERE u.response_id = c.response_id AND u.type = 'usage' AND u.seq > c.cut_seq) AS usage_lost
FROM cuts c JOIN looked l ON l.response_id = c.response_id AND l.seq = c.cut_seq JOIN joined j ON j.response_id = c.response_id"""
SQL["early_cut"] = CUT
SQL["stream_early_cut"] = CUT
SQL["stream_live_usage"] = """
SELECT account_id, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS total_prompt_tokens,
       CAST(coalesce(sum(completion_tokens), 0) AS BIGINT) AS total_completion_tokens, count(*) AS total_requests
FROM request_logs WHERE account_id IS NOT NULL GROUP BY account_id"""


def oracle_texts() -> dict[str, str]:
    return {name: duckdb_with(sql) for name, sql in SQL.items()}
