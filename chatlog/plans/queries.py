"""Every operator as a query over one scale directory: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chatlog.operators import (
    accounts as acc, changes, concurrency, events, models, outcomes, redact, responses, sessions, tooldefs,
    transcript, usage,
)
from chatlog.operators.rollover import session_rollover as rollover
from chatlog.plans import inputs, replay
from chatlog.session import options, scratch_path, settled
from chatlog.sources import export, requests as bodies, schemas, tables
from chatlog.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ROLLOVER_LIMIT = 1000
CAPTURE_PART = 64 << 20
ROLLOVER_KEYS = ["account_id", "client_session_id"]


def query(fn: Callable) -> Callable:
    """Register `fn(get)`, where `get(name)` is an input table, under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(inputs.open_inputs(spark, sf_dir))
    return fn


def _us(c: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ column."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(c) if isinstance(c, str) else c)


def _as_of() -> Column:
    return F.lit(inputs.AS_OF).cast("timestamp_ntz")


# --- accounts and logs -------------------------------------------------------


@query
def usage_by_account(get):
    out = usage.usage_by_account(get("accounts"), get("request_logs"))
    return out.select("id", "alias", "is_active", "total_prompt_tokens", "total_completion_tokens", "total_requests")


@query
def monitor_summary(get):
    return usage.monitor_summary(get("accounts"), get("request_logs"), _as_of())


@query
def token_totals_rollup(get):
    return usage.token_totals(get("accounts"), get("request_logs"))


@query
def usage_trend_hourly(get):
    out = usage.usage_trend(get("request_logs"))
    return out.withColumn("bucket", _us("bucket")).withColumnRenamed("bucket", "bucket_us")


@query
def request_health(get):
    out = usage.request_health(get("request_logs"))
    rates = {c: F.round(c, 9) for c in ("error_rate", "reasoning_share")}
    return out.withColumns(rates)


@query
def request_health_by_account(get):
    known = F.when(F.col("account_id") < 1_000_000_000, F.col("account_id"))
    out = usage.request_health(get("request_logs").withColumn("account_id", known), ["account_id"])
    return out.select("account_id", "requests", "errors", "p50_ms", "p99_ms")


def _page(df: DataFrame) -> DataFrame:
    return df.select("id", "account_id", "endpoint", "status", "duration_ms", "error", _us("created_at").alias("created_us"))


@query
def logs_page(get):
    return _page(usage.page_logs(get("request_logs"), page=3, limit=50, status="success", endpoint="openai"))


@query
def logs_deep_page(get):
    return _page(usage.page_logs(get("request_logs"), page=61, limit=100, top_k_rows=1000))


@query
def logs_page_crowded(get):
    """A page deep inside one second that holds a day's logs."""
    crowded = get("request_logs").withColumn("created_at", F.date_trunc("day", "created_at").cast("timestamp_ntz"))
    return _page(usage.page_logs(crowded, page=31, limit=100, top_k_rows=1000))


@query
def logs_page_after(get):
    return _page(usage.page_after(get("request_logs"), _as_of(), 0, limit=80, status="error"))


@query
def log_counts(get):
    return usage.count_logs(get("request_logs"), status="error", endpoint="anthropic")


@query
def accounts_masked(get):
    out = acc.masked_view(acc.lookup(get("accounts"), active_only=True), {"key_hash": 20})
    return out.select("id", "label", "alias", "key_hash", _us("created_at").alias("created_us"))


@query
def accounts_newest_first(get):
    return acc.newest_first(get("accounts")).select("id", "alias", _us("created_at").alias("created_us"))


@query
def accounts_with_errors(get):
    failed = get("request_logs").filter("status = 'error'").select(F.col("account_id").alias("id"))
    return acc.lookup(get("accounts"), ids=failed).select("id", "alias", "is_active")


@query
def least_busy_account(get):
    busy = acc.with_active_requests(get("accounts"), get("request_logs"), _as_of())
    return acc.least_busy(busy).select("id", "alias", "active_requests")


@query
def concurrency_profile(get):
    out = concurrency.concurrency_profile(get("request_logs"))
    return out.select("account_id", _us("at").alias("at_us"), "in_flight")


@query
def concurrency_peaks(get):
    return concurrency.concurrency_peaks(concurrency.concurrency_profile(get("request_logs")))


@query
def resolved_models(get):
    out = models.resolve_models(
        get("request_logs"), get("model_aliases"), get("model_capabilities"), default="flash"
    )
    return out.select("id", "model_alias", "model_effective", "alias_known", "is_omni", "default_temperature", "max_tokens")


@query
def session_usage(get):
    joined = usage.logs_with_sessions(get("request_logs"), get("sessions"))
    return joined.groupBy("session_id", "session_account_id").agg(
        F.count("*").alias("logs"), F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens")
    )


@query
def session_token_totals(get):
    out = usage.session_token_totals(get("request_logs"))
    return out.select("session_id", "prompt_tokens", "requests", _us("last_used_at").alias("last_used_us"))


@query
def unique_key_report(get):
    return usage.uniqueness_report(get("requests"), ["account_id", "client_session_id"])


# --- transcripts ---------------------------------------------------------------


@query
def last_messages(get):
    return transcript.last_n_messages(get("conversations"), n=3).select("conv_id", "turn", "role", "from_end")


@query
def last_texts(get):
    conv = get("conversations")
    return transcript.last_user_message(conv).join(transcript.last_message(conv), "conv_id")


@query
def transcript_rendered(get):
    return transcript.render_transcript(get("conversations"))


@query
def transcript_bounded(get):
    return transcript.render_transcript(get("conversations"), n=4, max_chars=1500)


@query
def transcript_incremental(get):
    return transcript.render_incremental(get("conversations"))


@query
def first_system_prompt(get):
    return transcript.first_system_message(get("conversations"))


@query
def catalog_injected(get):
    return transcript.inject_tool_catalog(get("conversations"), "- f(a*:string): short")


@query
def replay_savings(get):
    return transcript.replay_savings(get("conversations"), n=4, max_chars=1500)


# --- sessions --------------------------------------------------------------------


@query
def history_chain_hash(get):
    return sessions.history_hash(get("conversations"))


def _continuity(get, mode):
    out = sessions.session_continuity(get("requests"), get("conversations"), mode)
    return out.select("request_id", "n_messages", "list_hash", "history_hash", "matches")


@query
def session_continuity(get):
    return _continuity(get, "append")


@query
def session_continuity_strict(get):
    return _continuity(get, "strict")


@query
def session_rollover(get):
    out = rollover(
        get("requests"), ROLLOVER_KEYS, ["request_id"], "prompt_tokens", limit=ROLLOVER_LIMIT,
    )
    return out.select("request_id", "account_id", "client_session_id", "generation", "session_tokens")


def _history(get):
    return sessions.session_history(get("requests"), get("conversations"), limit=ROLLOVER_LIMIT)


@query
def session_history(get):
    return _history(get).select("request_id", "reused", "generation", "session_tokens")


@query
def session_snapshot(get):
    live = sessions.live_sessions(sessions.session_snapshot(_history(get)))
    kept = sessions.expire_stale(live, _as_of(), ttl_days=7)
    return kept.select(
        "conversation_id", *ROLLOVER_KEYS, "generation", "requests", "prompt_tokens", "last_messages_hash", "last_msg_count",
        _us("created_at").alias("created_us"), _us("last_used_at").alias("last_used_us"),
    )


@query
def session_changes_applied(get):
    return tables.upsert_sessions(get("session_changes"), None).select("id", "prompt_tokens", "last_msg_count")


# --- outcomes ----------------------------------------------------------------------


@query
def outcome_classes(get):
    out = outcomes.classify_outcomes(get("request_logs"))
    return out.filter("status = 'error'").select(
        "id", "http_status", "outcome_type", "outcome_message", "client_status", "deactivates"
    )


@query
def account_state_final(get):
    classified = outcomes.classify_outcomes(get("request_logs"))
    out = outcomes.account_state(get("accounts"), classified, as_of=_as_of())
    return out.select("id", "alias", "is_active", "banned_status")


@query
def account_changes_applied(get):
    log = get("account_changes").withColumn("fields", F.array("field"))
    return changes.apply_account_changes(get("accounts"), log).select("id", "alias", "is_active", "banned_status")


@query
def account_state_history(get):
    out = outcomes.account_state_history(outcomes.classify_outcomes(get("request_logs")))
    return out.select(
        "id", _us("valid_from").alias("from_us"), _us("valid_to").alias("to_us"), "is_active", "banned_status"
    )


# --- responses -----------------------------------------------------------------------


@query
def reasoning_split(get):
    return responses.split_reasoning(get("responses")).select("response_id", "reasoning", "answer")


@query
def reasoning_stripped(get):
    cut = responses.strip_reasoning(get("responses"), "cut").withColumnRenamed("answer", "cut")
    return responses.strip_reasoning(cut, "keep").select("response_id", "cut", F.col("answer").alias("kept"))


@query
def tool_marker_split(get):
    out = responses.split_at_tool_marker(get("responses"))
    return out.select("response_id", "answer", "tool_buffer", "has_marker")


@query
def tool_blocks(get):
    return responses.extract_tool_blocks(get("responses"))


def _arguments(calls: DataFrame) -> DataFrame:
    """One row per argument; a call without arguments keeps one row."""
    rows = calls.select("response_id", "ord", "call_id", "dialect", "name", F.explode_outer("args").alias("arg"))
    return rows.select("response_id", "ord", "call_id", "dialect", "name", "arg.key", "arg.value")


@query
def tool_calls_json(get):
    calls = responses.extract_tool_calls(get("responses"), scan="all")
    return _arguments(calls.filter("dialect = 'json'"))


@query
def tool_calls_markup(get):
    calls = responses.extract_tool_calls(get("responses"))
    return _arguments(calls.filter("dialect in ('name', 'tool_name', 'function', 'invoke')"))


@query
def tool_calls_tag(get):
    calls = responses.extract_tool_calls(get("responses"))
    return calls.filter("dialect = 'tag'").select("response_id", "ord", "name", "arguments_json")


@query
def tool_usage_report(get):
    return responses.tool_usage_report(get("responses"))


@query
def chat_export(get):
    rows = get("responses").select(
        "response_id", "text", F.lit("flash").alias("model"), F.length("text").cast("bigint").alias("prompt_tokens"),
        F.col("kind").alias("completion_tokens"), F.lit(0).cast("bigint").alias("reasoning_tokens"),
        (F.length("text") + F.col("kind")).alias("total_tokens"),
    )
    first = export.export_chat_jsonl(rows, bodies.OPENAI, "strip").withColumnRenamed("record", "openai")
    second = export.export_chat_jsonl(rows, bodies.ANTHROPIC, "separate").withColumnRenamed("record", "anthropic")
    return first.join(second, "response_id")


# --- requests ------------------------------------------------------------------------


@query
def flattened_messages(get):
    return bodies.flatten_blocks(get("bodies"), "req_id")


def _parameters(get, dialect):
    out = bodies.parse_chat_requests(get("bodies"), dialect)
    return out.select(
        "req_id", "model", "temperature", "top_p", "thinking", "web_search", "is_stream",
        F.col("n_tools").cast("bigint").alias("n_tools"), "system_prompt",
        F.size("messages").cast("bigint").alias("n_messages"),
    )


@query
def request_parameters_openai(get):
    return _parameters(get, bodies.OPENAI)


@query
def request_parameters_anthropic(get):
    return _parameters(get, bodies.ANTHROPIC)


@query
def tool_catalog(get):
    return tooldefs.render_tool_catalog(get("tool_defs"), ["brand"], rules="[Tools]")


@query
def redacted_text(get):
    out = redact.redact_credentials(get("redaction_input"))
    return out.select("doc_id", "text", "cookie_hits", "sid_hits", "userId_hits", "has_command")


# --- tables written and read back ------------------------------------------------------


@query
def accounts_read_back(get):
    df = get("accounts")
    df.write.parquet(path := scratch_path(df.sparkSession, "accounts"))
    return tables.read_accounts(df.sparkSession, path).select("id", "alias", "is_active", "active_requests")


@query
def sessions_read_live(get):
    df = get("sessions").select(F.col("id").cast("string").alias("id"), "account_id", "requests", (F.col("requests") < 3).alias("is_expired"))
    df.write.parquet(path := scratch_path(df.sparkSession, "sessions"))
    return tables.read_sessions(df.sparkSession, path).select(F.col("id").cast("bigint").alias("id"), "account_id", "requests")


@query
def logs_read_by_day(get):
    df = get("request_logs").withColumn("session_id", F.col("session_id"))
    tables.append_request_logs(df, path := scratch_path(df.sparkSession, "logs"))
    out = tables.read_request_logs(df.sparkSession, path, since="2024-01-05 06:00:00", until="2024-01-09 18:00:00")
    return out.select("id", "endpoint", _us("created_at").alias("created_us"))


@query
def logs_evolved(get):
    old = get("request_logs").select("id", "endpoint", F.lit(1).alias("extra"))
    out = tables.evolve_schema(old, schemas.REQUEST_LOGS)
    return out.select("id", "account_id", "status", "endpoint", "extra")


@query
def event_chunks_from_files(get):
    lines = inputs.event_lines(get("chunks"))
    lines.write.json(path := scratch_path(lines.sparkSession, "lines"))
    out = events.parse_event_stream(tables.read_event_stream(lines.sparkSession, path))
    return out.select(
        "response_id", F.floor(F.col("seq") / 3).cast("bigint").alias("seq"), "type", "content",
        "prompt_tokens", "completion_tokens", "reasoning_tokens",
    )


@query
def redacted_commands(get):
    """Cookies in the forms that browsers and shells copy."""
    out = redact.redact_credentials(get("redaction_commands"))
    return out.select("doc_id", "text", "cookie_hits", "has_command")


@query
def served_models(get):
    return models.list_models(get("model_aliases"))


@query
def event_chunks_text_ids(get):
    """Ids that are no numbers, as the response records have them."""
    lines = inputs.event_lines(get("chunks")).withColumn("response_id", F.concat(F.lit("r-"), F.col("response_id").cast("string")))
    lines.write.json(path := scratch_path(lines.sparkSession, "lines"))
    out = events.parse_event_stream(tables.read_event_stream(lines.sparkSession, path, schemas.EVENT_LINES_BY_TEXT))
    return out.select("response_id", F.floor(F.col("seq") / 3).cast("bigint").alias("seq"), "type", "content")


@query
def captures_numbered(get):
    """Raw captures, one per kind of event and one of all messages, in parts of about CAPTURE_PART bytes, read in splits of 64 KiB."""
    spark = get("documents").sparkSession
    path = scratch_path(spark, "captures")
    text = F.coalesce("text", F.lit(""))
    for end in "\n\r":
        text = F.replace(text, F.lit(end), F.lit(" "))
    lines = get("documents").select("source", F.concat(F.format_string("%012d ", "doc_id"), text).alias("line"))
    every = lines.select(F.explode(F.array(F.lit("all"), "source")).alias("source"), "line")
    total = 2 * (lines.agg(F.sum(F.octet_length("line") + 1)).first()[0] or 0)
    # Parts by ranges of the lines, bounds by their beginnings: equal beginnings stay together.
    ranged = every.repartitionByRange(1 + total // CAPTURE_PART, "source", F.left("line", F.lit(64)))
    ranged.sortWithinPartitions("source", "line").write.partitionBy("source").text(path)
    rows = tables.read_raw_captures(spark, path, parts=True, split="64k")
    return rows.select(F.regexp_extract("response_id", "source=([^/]*)", 1).alias("source"), "line_no", "line")


# --- captured streams, batch ---------------------------------------------------------


@query
def event_chunks(get):
    out = events.parse_event_stream(inputs.event_lines(get("chunks")))
    return out.select(
        "response_id", F.floor(F.col("seq") / 3).cast("bigint").alias("seq"), "type", "content",
        "prompt_tokens", "completion_tokens", "reasoning_tokens",
    )


@query
def assembled_responses(get):
    return events.assemble_responses(get("chunks"), on_error="stop")


@query
def assembled_ignoring_errors(get):
    return events.assemble_responses(get("chunks"), on_error="ignore").drop("error")


@query
def chunk_reasoning(get):
    return events.segment_reasoning(get("chunks"), "passthrough")


@query
def chunk_tool_buffer(get):
    return events.segment_tool_buffer(get("chunks"))


@query
def early_cut(get):
    return events.early_cut(get("chunks"))


# --- streaming -----------------------------------------------------------------------


def stream_query(fn: Callable) -> Callable:
    """Register `fn(spark, sf_dir)`, a query that runs a stream over all its input.

    State partitions are fixed when a stream starts and adaptive execution does not merge
    them, so there are as many as the cluster has cores.
    """
    def run(spark, sf_dir):
        inputs.open_inputs(spark, sf_dir)
        cores = str(spark.sparkContext.defaultParallelism)
        with options(spark, {"spark.sql.shuffle.partitions": cores}):
            return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@stream_query
def stream_live_usage(spark, sf_dir):
    events_stream = replay.stream_table(spark, sf_dir, "events")
    logs = inputs.derived(spark, sf_dir, "request_logs", {"events": events_stream})
    path = scratch_path(spark, "live-usage")
    streams.append_logs(logs, f"{path}/logs", f"{path}/logs-checkpoint").awaitTermination()
    written = spark.readStream.schema(spark.read.parquet(f"{path}/logs").schema).parquet(f"{path}/logs")
    streams.write_updates(streams.live_usage(written), f"{path}/usage", f"{path}/usage-checkpoint", ["account_id"]).awaitTermination()
    latest = streams.latest_rows(spark, f"{path}/usage", ["account_id"])
    return latest.select(
        "account_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_prompt_tokens", "total_completion_tokens")],
        "total_requests",
    )


@stream_query
def stream_session_changes(spark, sf_dir):
    stream = replay.replayed(inputs.derived(spark, sf_dir, "session_changes"), "seq", slices=3)
    path = scratch_path(spark, "session-changes")
    streams.append_session_changes(stream, f"{path}/changes", f"{path}/checkpoint").awaitTermination()
    log = spark.read.schema(stream.schema).parquet(f"{path}/changes")
    return tables.upsert_sessions(log, None).select("id", "prompt_tokens", "last_msg_count")


@stream_query
def stream_usage_trend(spark, sf_dir):
    events_stream = replay.stream_table(spark, sf_dir, "events")
    logs = inputs.derived(spark, sf_dir, "request_logs", {"events": events_stream})
    path = scratch_path(spark, "live-trend")
    trend = streams.live_usage_trend(logs)
    streams.write_updates(trend, f"{path}/trend", f"{path}/checkpoint", ["bucket", "endpoint"]).awaitTermination()
    latest = streams.latest_rows(spark, f"{path}/trend", ["bucket", "endpoint"])
    return latest.select(
        F.unix_micros("bucket").alias("bucket_us"), "endpoint", "requests", "prompt_tokens", "completion_tokens"
    )


@stream_query
def stream_usage_trend_late(spark, sf_dir):
    """Logs newest first, so that all but the newest step come late: they correct the trend."""
    logs = inputs.derived(spark, sf_dir, "request_logs").withColumn("_age", -F.unix_micros(F.col("created_at").cast("timestamp")))
    path = scratch_path(spark, "late-trend")
    stream = replay.replayed(logs, "_age", slices=4).drop("_age")
    streams.write_usage_trend(stream, f"{path}/trend", f"{path}/checkpoint").awaitTermination()
    trend = streams.read_usage_trend(spark, f"{path}/trend")
    return trend.select(F.unix_micros("bucket").alias("bucket_us"), "endpoint", "requests", "prompt_tokens", "completion_tokens")


def _line_stream(spark, sf_dir):
    lines = inputs.event_lines(inputs.derived(spark, sf_dir, "chunks"))
    return replay.replayed(lines, "line_no", slices=3)


@stream_query
def stream_segments(spark, sf_dir):
    found = streams.drain(streams.stream_segments(_line_stream(spark, sf_dir)), "segments")
    return found.groupBy("response_id", "kind").agg(F.expr("listagg(text, '') within group (order by seq)").alias("text"))


@stream_query
def stream_chunks(spark, sf_dir):
    """Responses that go on after their finish chunk, cut before and behind it."""
    chunks = inputs.derived(spark, sf_dir, "chunks")
    last = chunks.groupBy("response_id").agg(F.max("seq").alias("seq"))
    none = F.lit(None).cast("bigint")
    more = last.select("response_id", F.col("seq") + 1, F.lit("text"), F.lit("after"), none, none).unionAll(
        last.select("response_id", F.col("seq") + 2, F.lit("usage"), F.lit(None).cast("string"), F.lit(1).cast("bigint"), F.lit(2).cast("bigint")))
    # The malformed line behind a finish chunk would have the number of the line that follows.
    lines = inputs.event_lines(chunks).filter("line <> 'data: {broken'").unionAll(inputs.event_lines(more.toDF(*chunks.columns)))
    found = streams.drain(streams.stream_chunks(replay.replayed(lines, "line_no", slices=3)), "chunks")
    return found.withColumn("seq", F.floor(F.col("seq") / 3).cast("bigint"))


@stream_query
def stream_late_logs(spark, sf_dir):
    """Logs newest first, a tenth of them twice; every id is kept once, however late."""
    logs = inputs.derived(spark, sf_dir, "request_logs").withColumn("_age", -F.unix_micros(F.col("created_at").cast("timestamp")))
    copies = logs.filter("id % 10 = 0").withColumn("_age", F.lit(0).cast("bigint"))
    stream = replay.replayed(logs.unionByName(copies), "_age", slices=3).drop("_age")
    path = scratch_path(spark, "late-logs")
    streams.append_logs(stream, f"{path}/logs", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/logs").groupBy("account_id").agg(F.count("*").alias("logs"), F.sum("id").alias("id_sum"))


@stream_query
def stream_early_cut(spark, sf_dir):
    chunks = inputs.derived(spark, sf_dir, "chunks").select("response_id", "seq", "type", "content")
    return streams.drain(streams.stream_early_cut(replay.replayed(chunks, "seq", slices=3)), "early-cut")


@stream_query
def stream_sessions(spark, sf_dir):
    get = inputs.open_inputs(spark, sf_dir)
    checked = sessions.session_continuity(get("requests"), get("conversations"), "strict").drop("matches", "created_at")
    stream = replay.replayed(checked, "request_id", slices=3)
    found = streams.drain(streams.stream_sessions(stream, limit=ROLLOVER_LIMIT), "sessions")
    return found.select("request_id", "reused", "generation", "session_tokens")


@stream_query
def stream_sessions_append(spark, sf_dir):
    get = inputs.open_inputs(spark, sf_dir)
    rows = sessions.with_prefixes(get("requests"), get("conversations")).drop("conv_id", "turn")
    # Arrival is not the order of the requests: the steps go by a hash, and the watermark waits for all.
    mixed = rows.withColumn("_step", F.pmod(F.xxhash64("request_id"), F.lit(3)).cast("int"))
    stream = replay.replayed(mixed, "_step", 3, replay.closing_row(mixed)).drop("_step")
    found = streams.drain(streams.stream_session_history(stream, limit=ROLLOVER_LIMIT, late="30000 days"), "sessions", event_time=True)
    return found.select("request_id", "reused", "generation", "session_tokens")
