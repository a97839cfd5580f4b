"""Input tables derived from the given ones (see FIXTURES.md).

The SQL texts are written for Spark and for DuckDB; an `Engine` holds the few words
that differ. All of them read their source tables whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from chatlog.session import configure, settled

START = "2024-01-01 00:00:00"
AS_OF = "2024-01-15 12:00:00"


@dataclass(frozen=True)
class Engine:
    spark: bool

    def number(self, column: str, path: str) -> str:
        if self.spark:
            return f"CAST(get_json_object({column}, '{path}') AS BIGINT)"
        return f"CAST(json_extract_string({column}, '{path}') AS BIGINT)"

    def sha(self, text: str) -> str:
        return f"sha2({text}, 256)" if self.spark else f"sha256({text})"

    def seconds(self, n: str) -> str:
        if self.spark:
            return f"timestampadd(SECOND, {n}, TIMESTAMP_NTZ '{START}')"
        return f"(TIMESTAMP '{START}' + to_seconds({n}))"

    def json(self, text: str) -> str:
        """A text as JSON string."""
        return f"to_json(CAST({text} AS VARIANT))" if self.spark else f"CAST(to_json({text}) AS VARCHAR)"

    def counted(self, source: str, n: str) -> str:
        """FROM clause: `source` with a column i = 0 .. n - 1."""
        if self.spark:
            return f"{source} LATERAL VIEW explode(sequence(0, CAST({n} AS INT) - 1)) t AS i"
        return f"{source}, unnest(range(0, CAST({n} AS BIGINT))) t(i)"


SPARK, DUCKDB = Engine(True), Engine(False)

# Ten kinds of assistant text; 6 and 7 alternate by conversation.
KIND = "(conv_id * 7 + turn) % 10"


def texts(e: Engine) -> dict[str, str]:
    """View bodies by name, in an order in which each reads earlier ones only."""
    k = e.number("props", "$.k")
    quiet = "event_type = 'error' OR event_id % 50 = 1"
    body = e.json("text")
    return {
        "accounts": f"""
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS alias,
       {e.sha("concat('key-', c_custkey)")} AS key_hash,
       c_custkey % 11 <> 0 AS is_active,
       CASE WHEN c_custkey % 22 = 0 THEN 'TEMPORARY' END AS banned_status,
       {e.seconds('c_custkey * 60')} AS created_at
FROM customer""",
        # A rename per account, a patch for some, and deletes; the rename sets the alias even to null.
        "account_changes": """
SELECT c_custkey AS id, 1 AS seq, 'update' AS op, CASE WHEN c_nationkey > 12 THEN c_mktsegment END AS alias,
       CAST(NULL AS BOOLEAN) AS is_active, 'alias' AS field FROM customer
UNION ALL SELECT c_custkey, 2, 'update', NULL, c_acctbal > 0, 'is_active' FROM customer WHERE c_nationkey < 5
UNION ALL SELECT c_custkey, 3, 'delete', NULL, NULL, NULL FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 4, 'upsert', 'back', NULL, 'alias' FROM customer WHERE c_acctbal < -500
UNION ALL SELECT c_custkey, 5, 'update', NULL, c_nationkey % 2 = 0, 'is_active' FROM customer WHERE c_acctbal < -200
UNION ALL SELECT c_custkey + 1000000000, 1, 'update', 'ghost', NULL, 'alias' FROM customer WHERE c_acctbal > 8000
UNION ALL SELECT c_custkey + 2000000000, 1, 'upsert', c_name, true, 'alias' FROM customer WHERE c_acctbal > 9000""",
        "request_logs": f"""
SELECT event_id AS id,
       CASE WHEN user_id % 10 = 3 THEN user_id + 1000000000 ELSE user_id END AS account_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(floor(user_id / 2) AS BIGINT) END AS session_id,
       CASE WHEN event_id % 2 = 0 THEN 'openai' ELSE 'anthropic' END AS endpoint,
       concat('alias-', event_id % 13) AS model_alias,
       CASE WHEN {quiet} THEN NULL ELSE CAST(floor(value * 10) AS BIGINT) END AS prompt_tokens,
       CASE WHEN {quiet} THEN NULL ELSE {k} * 3 END AS completion_tokens,
       CASE WHEN {quiet} THEN NULL ELSE {k} END AS reasoning_tokens,
       {k} * 600000 AS duration_ms,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
       CASE WHEN event_type <> 'error' OR event_id % 5 = 0 THEN NULL
            WHEN {k} % 8 = 0 THEN 400 WHEN {k} % 8 = 1 THEN 401 WHEN {k} % 8 = 2 THEN 403
            WHEN {k} % 8 = 3 THEN 451 WHEN {k} % 8 = 4 THEN 461 WHEN {k} % 8 = 5 THEN 429
            WHEN {k} % 8 = 6 THEN 503 ELSE 500 END AS http_status,
       CASE WHEN event_type <> 'error' THEN NULL
            WHEN event_id % 5 = 0 AND {k} % 2 = 0 THEN 'fetch failed: 403 Forbidden'
            WHEN event_id % 5 = 0 THEN 'socket hang up' ELSE 'upstream error' END AS error,
       ts AS created_at
FROM events""",
        "model_aliases": """
SELECT concat('alias-', i) AS alias, CASE WHEN i < 6 THEN 'flash' WHEN i < 10 THEN 'pro' ELSE 'omni' END AS model
FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11)) t(i)""",
        "model_capabilities": """
SELECT model, model = 'omni' AS is_omni, CAST(0.8 AS DOUBLE) AS default_temperature, 100000 AS max_tokens
FROM (VALUES ('flash'), ('pro'), ('omni')) t(model)""",
        "requests": f"""
SELECT conv_id, turn, conv_id * 100 + turn AS request_id,
       CAST(floor(conv_id / 2) AS BIGINT) % 20 AS account_id,
       CAST(floor(conv_id / 2) AS BIGINT) AS client_session_id,
       CASE WHEN (conv_id + turn) % 11 = 5 THEN NULL ELSE CAST(length(text) AS BIGINT) END AS prompt_tokens,
       {e.seconds('(conv_id * 100 + turn) * 150')} AS created_at
FROM conversations WHERE role = 'user'""",
        "sessions": """
SELECT client_session_id AS id, min(account_id) AS account_id, count(*) AS requests, max(created_at) AS last_used_at
FROM requests GROUP BY client_session_id""",
        "session_changes": """
SELECT client_session_id AS id, request_id AS seq, 'upsert' AS op, prompt_tokens, turn AS last_msg_count FROM requests
UNION ALL
SELECT client_session_id, min(request_id) + 1, 'delete', NULL, NULL FROM requests
GROUP BY client_session_id HAVING max(prompt_tokens) >= 300
UNION ALL SELECT client_session_id, min(request_id) + 2, 'update', 7, 99 FROM requests GROUP BY client_session_id
UNION ALL SELECT client_session_id + 1000000000, 1, 'update', 7, 99 FROM requests GROUP BY client_session_id""",
        "responses": f"""
SELECT conv_id * 100 + turn AS response_id, {KIND} AS kind,
  CASE {KIND}
    WHEN 1 THEN concat('<think>', split_part(text, chr(10), 1), '</think>', chr(10), text)
    WHEN 2 THEN concat('<think>', text)
    WHEN 3 THEN concat(text, '<tool_call>', chr(10), '{{"name": "lookup", "arguments": {{"id": ', conv_id, ', "deep": true}}}}', chr(10), '</tool_call> then ', text)
    WHEN 4 THEN concat('<think>plan</think>', text, '<tool_call><function=search><parameter=q>', conv_id, '</parameter><parameter=mode>fast</parameter></function></tool_call>')
    WHEN 5 THEN concat(text, '<tool_call><name>fetch</name><param name="id">', conv_id, '</param><param key="lang">x</param></tool_call>')
    WHEN 6 THEN concat(text, '<tool_call><tool_name>rank</tool_name><arguments><arg_key>top</arg_key><arg_value>', turn, '</arg_value></arguments></tool_call>')
    WHEN 7 THEN concat(text, '<tool_call><read><path>/a/', conv_id, '</path><limit>5</limit></read></tool_call>')
    WHEN 8 THEN concat('<function_calls><invoke name="a"><parameter name="x">', turn, '</parameter></invoke><invoke name="b"><parameter name="y">z</parameter></invoke></function_calls>', text)
    WHEN 9 THEN concat(text, '<tool_call>{{"name": "x", </tool_call>')
    ELSE text END AS text
FROM conversations WHERE role = 'assistant'""",
        # Text in pieces of 24 characters, for long responses an error chunk in fourth
        # place, then a usage and a finish chunk; numbered from 0 without gaps.
        "chunks": f"""
SELECT response_id, CAST(i + CASE WHEN i >= 3 AND length(text) > 1200 THEN 1 ELSE 0 END AS BIGINT) AS seq, 'text' AS type,
       substr(text, CAST(i * 24 + 1 AS INT), 24) AS content,
       CAST(NULL AS BIGINT) AS prompt_tokens, CAST(NULL AS BIGINT) AS completion_tokens
FROM {e.counted("responses", "ceil(length(text) / 24)")} WHERE length(text) > 0
UNION ALL
SELECT response_id, 3, 'error', '{{"status":429,"type":"rate_limit"}}', NULL, NULL FROM responses WHERE length(text) > 1200
UNION ALL
SELECT response_id, CAST(ceil(length(text) / 24) AS BIGINT) + CASE WHEN length(text) > 1200 THEN 1 ELSE 0 END, 'usage', NULL,
       CAST(length(text) AS BIGINT), CAST(kind AS BIGINT) FROM responses
UNION ALL
SELECT response_id, CAST(ceil(length(text) / 24) AS BIGINT) + CASE WHEN length(text) > 1200 THEN 2 ELSE 1 END, 'finish', NULL, NULL, NULL
FROM responses""",
        "bodies": f"""
SELECT conv_id * 100 + turn AS req_id, (conv_id + turn) % 5 AS kind, CASE (conv_id + turn) % 5
  WHEN 0 THEN concat('{{"system":"be brief","model":"alias-1","temperature":0.2,"messages":[{{"role":"user","content":', {body}, '}}]}}')
  WHEN 1 THEN concat('{{"thinking":{{"type":"enabled"}},"messages":[{{"role":"user","content":[{{"type":"text","text":', {body}, '}},{{"type":"image"}},{{"type":"text","text":"b"}}]}},{{"role":"assistant","content":""}}]}}')
  WHEN 2 THEN concat('{{"stream":true,"tools":[{{"name":"f"}}],"messages":[{{"role":"assistant","content":[{{"type":"tool_use","name":"f","input":{{"x":', conv_id, ',"a":', {body}, '}}}}]}},{{"role":"user","content":[{{"type":"tool_result","content":', {body}, '}}]}}]}}')
  WHEN 3 THEN concat('{{"reasoning_effort":"high","system":[{{"type":"text","text":"no"}}],"messages":[{{"role":"user","content":[{{"type":"tool_result","content":[{{"type":"text","text":', {body}, '}},{{"type":"image"}},{{"type":"text","text":"v"}}]}}]}}]}}')
  ELSE concat('{{"top_p":0.5,"web_search":"auto","messages":[{{"role":"user","content":"[1]"}},{{"role":"user","content":', {body}, '}}]}}') END AS body
FROM conversations""",
        "tool_defs": f"""
SELECT p_brand AS brand, p_partkey AS def_id, CASE p_partkey % 3
  WHEN 0 THEN concat('{{"type":"function","function":{{"name":"', replace(p_name, ' ', '_'), '","description":"', p_type, '","parameters":{{"properties":{{"size":{{"type":"integer"}},"note":{{}}}},"required":["size"]}}}}}}')
  WHEN 1 THEN concat('{{"name":"', replace(p_name, ' ', '_'), '","description":"', repeat(concat(p_name, ' '), 20), chr(92), 'nsecond","input_schema":{{"properties":{{"n":{{"type":"number"}}}}}}}}')
  ELSE concat('{{"name":"', replace(p_name, ' ', '_'), '"}}') END AS def
FROM part""",
        "redaction_input": """
SELECT doc_id, CASE doc_id % 5
  WHEN 0 THEN concat(text, chr(10), 'curl -b "sid=tok', doc_id, '; userId=', doc_id, '" -X GET')
  WHEN 1 THEN concat('curl -H ', chr(39), 'Cookie: serviceToken=SECRET', doc_id, '; userId=42; other_ph="SECRET', doc_id, '"', chr(39), ' -d a=b', chr(10), text)
  WHEN 2 THEN concat(text, chr(10), 'Cookie: plain=SECRET', doc_id, '; x_y=2', chr(10), 'curl --cookie only=SECRET', doc_id, ' --data k=v')
  WHEN 3 THEN concat('no command, key=value and token=SECRET', doc_id, ' ', text) ELSE text END AS text
FROM documents""",
        "redaction_commands": """
SELECT doc_id, CASE doc_id % 8
  WHEN 0 THEN concat(text, chr(10), 'curl -b $', chr(39), 'a=1; serviceToken=SECRET', doc_id, chr(39))
  WHEN 1 THEN concat('curl -H $', chr(39), 'cookie: serviceToken=SECRET', doc_id, chr(39), chr(10), text)
  WHEN 2 THEN concat(text, chr(10), 'curl -b', chr(39), 'serviceToken=SECRET', doc_id, chr(39), ' -X GET')
  WHEN 3 THEN concat('curl -sb ', chr(39), 'serviceToken=SECRET', doc_id, chr(39), chr(10), text)
  WHEN 4 THEN concat(text, chr(10), 'curl -b ', chr(92), chr(10), chr(39), 'serviceToken=SECRET', doc_id, chr(39))
  WHEN 5 THEN concat(text, chr(10), 'curl -H "cOOkie: serviceToken=SECRET', doc_id, '" -d a=b')
  WHEN 6 THEN concat(text, chr(10), 'curl -b "a=1', chr(92), '"; serviceToken=SECRET', doc_id, '"')
  ELSE text END AS text
FROM documents""",
    }


TABLES = ("conversations", "events", "customer", "part", "documents")


def _sources(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", sql)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A derived table as a DataFrame; `given` replaces source tables (a stream, say)."""
    given = given or {}
    if name in given:
        return given[name]
    if name in TABLES:
        return table(spark, sf_dir, name)
    bodies = texts(SPARK)
    sql = bodies[name]
    frames = {n: derived(spark, sf_dir, n, given) for n in _sources(sql, [*TABLES, *bodies])}
    quoted = sql.replace("{", "{{").replace("}", "}}")
    for n in frames:
        quoted = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", quoted)
    return spark.sql(quoted, **frames)


def duckdb_with(sql: str) -> str:
    """`sql` behind the CTEs of the derived tables it reads."""
    bodies = texts(DUCKDB)
    needed: list[str] = []

    def need(text: str) -> None:
        for n in _sources(text, bodies):
            if n not in needed:
                need(bodies[n])
                needed.append(n)

    need(sql)
    ctes = ",\n".join(f"{n} AS ({bodies[n].strip()})" for n in needed)
    if not ctes:
        return sql.strip()
    body = sql.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    if recursive:
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):].strip()}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[len('WITH'):].strip()}"
    return f"WITH {ctes}\n{body}"


def event_lines(chunks: DataFrame) -> DataFrame:
    """Chunks as captured event lines, three each, and a malformed data line at the end."""
    name = F.when(F.col("type") == "text", "message").otherwise(F.col("type"))
    usage = F.to_json(F.struct(
        F.col("prompt_tokens").alias("promptTokens"), F.col("completion_tokens").alias("completionTokens")
    ))
    data = (
        F.when(F.col("type") == "usage", usage)
        .when(F.col("type") == "text", F.to_json(F.struct("content"))).otherwise("{}")
    )
    lines = F.array(
        F.concat(F.lit("event: "), name), F.concat(F.lit("data: "), data), F.lit(""),
    )
    last = F.when(F.col("type") == "finish", F.array(F.lit("data: {broken"))).otherwise(F.array().cast("array<string>"))
    rows = chunks.select("response_id", "seq", F.posexplode(F.concat(lines, last)).alias("i", "line"))
    return rows.select("response_id", (F.col("seq") * 3 + F.col("i")).alias("line_no"), "line")


# Derived from texts by a union, and read by their operators in several passes.
_KEPT = ("chunks",)


def open_inputs(spark: SparkSession, sf_dir: str):
    """A function name -> DataFrame over one scale directory."""
    configure(spark)

    def get(name: str) -> DataFrame:
        df = derived(spark, sf_dir, name)
        return settled(df) if name in _KEPT else df

    return get
