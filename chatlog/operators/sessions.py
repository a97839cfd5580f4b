"""Sessions over the history of requests.

A request is (account_id, client_session_id, request_id, conv_id, turn,
prompt_tokens, created_at): its messages are those of `conv_id` up to `turn`, its
history all of them but the last. `request_id` orders the requests of a session key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog import fixed
from chatlog.functions.digest import LANES, digest_lane, list_digest, message_digest
from chatlog.operators.rollover import session_rollover
from chatlog.operators.scan import BY_ROWS, block_scan
from chatlog.session import settled

KEYS = ["account_id", "client_session_id"]


def history_hash(conv: DataFrame) -> DataFrame:
    """Per message: digests of the list up to and with it, and of the list before it.

    (conv_id, turn, n_messages, list_hash, history_hash). Running sums, so each
    message is hashed once and prefixes are never built.
    """
    hashed = conv.select("conv_id", "turn", message_digest("turn", "role", "text").alias("_d"))
    lanes = hashed.select("conv_id", "turn", *[digest_lane("_d", i).alias(f"own{i}") for i in range(len(LANES))])
    run = block_scan(
        lanes, ["conv_id"], ["turn"],
        sums={"n_messages": F.lit(1).cast("bigint"), **{lane: F.col(f"own{i}") for i, lane in enumerate(LANES)}},
    )
    before = [F.col(lane) - F.col(f"own{i}") for i, lane in enumerate(LANES)]
    return run.select(
        "conv_id", "turn", "n_messages",
        list_digest("n_messages", LANES).alias("list_hash"),
        list_digest(F.col("n_messages") - 1, before).alias("history_hash"),
    )


def session_continuity(
    requests: DataFrame,
    conv: DataFrame,
    mode: str = "append",
    block: Column | str = BY_ROWS,
) -> DataFrame:
    """Requests with list_hash, history_hash, n_messages and `matches`.

    A request leaves a list behind: all its messages if it ended with usage, else
    its history. `strict`: the next request matches if its history equals that list.
    `append`: it matches if its history begins with that list. The first request of a
    key matches nothing. Token limits are not looked at here.
    """
    rows, hashes = _with_hashes(requests, conv, mode)
    return _matched(rows, hashes, requests.columns, mode, block)


def _with_hashes(requests: DataFrame, conv: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Requests with the digests of their lists, written once, and the digests of all lists."""
    if mode not in ("strict", "append"):
        raise ValueError(f"mode must be 'strict' or 'append', not {mode!r}")
    hashes = settled(history_hash(conv)) if mode == "append" else history_hash(conv)
    # Narrow rows: ids, counts and hashes, read again by every later pass.
    return settled(requests.join(hashes, ["conv_id", "turn"])), hashes


def _matched(rows: DataFrame, hashes: DataFrame, columns: list[str], mode: str, block: Column | str) -> DataFrame:
    used = F.col("prompt_tokens").isNotNull()
    left = F.struct(
        F.when(used, F.col("list_hash")).otherwise(F.col("history_hash")).alias("hash"),
        F.when(used, F.col("n_messages")).otherwise(F.col("n_messages") - 1).alias("n"),
    )
    rows = block_scan(rows, KEYS, ["request_id"], block, lags={"_left": left})
    columns = [*columns, "n_messages", "list_hash", "history_hash"]
    stored, history = F.col("_left.hash"), F.col("n_messages") - 1
    if mode == "strict":
        matches = F.coalesce(stored == F.col("history_hash"), F.lit(False))
        return rows.select(*columns, matches.alias("matches"))
    # The request's own prefix of the stored length, by an equi-join on (conv_id, length).
    prefixes = hashes.select("conv_id", F.col("n_messages").alias("_n"), F.col("list_hash").alias("_prefix"))
    rows = rows.withColumn("_n", F.col("_left.n")).join(prefixes, ["conv_id", "_n"], "left")
    begins = (F.col("_n") == 0) | ((F.col("_n") <= history) & (F.col("_prefix") == stored))
    return rows.select(*columns, F.coalesce(begins, F.lit(False)).alias("matches"))


def with_prefixes(requests: DataFrame, conv: DataFrame) -> DataFrame:
    """Requests with n_messages, list_hash, history_hash and `prefix_hashes`, as a stream needs them.

    Entry i of `prefix_hashes` is the digest of the first i + 1 messages, up to the whole history. A
    request carries all its messages anyway; this is one short digest for each of them.
    """
    hashes = settled(history_hash(conv))
    every = hashes.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n_messages", "list_hash"))).alias("_all"))
    rows = requests.join(hashes, ["conv_id", "turn"]).join(every, "conv_id")
    prefixes = F.slice(F.col("_all.list_hash"), F.lit(1), F.greatest(F.col("n_messages") - 1, F.lit(0)).cast("int"))
    return rows.select(*requests.columns, "n_messages", "list_hash", "history_hash", prefixes.alias("prefix_hashes"))


def session_history(
    requests: DataFrame,
    conv: DataFrame,
    mode: str = "append",
    limit: int = fixed.SESSION_TOKEN_LIMIT,
    block: Column | str = BY_ROWS,
) -> DataFrame:
    """Requests with `reused`, `generation` (per key) and `session_tokens`.

    A request that does not match begins a new session whatever the tokens; one that
    does still begins one after the token limit.
    """
    rows, hashes = _with_hashes(requests, conv, mode)
    checked = _matched(rows, hashes, requests.columns, mode, block)
    run = session_rollover(
        checked, KEYS, ["request_id"], "prompt_tokens", block, limit, breaks=~F.col("matches"), counted=rows
    )
    return run.withColumn("reused", ~F.col("starts")).drop("matches", "starts")


def session_snapshot(history: DataFrame) -> DataFrame:
    """One row per session; only the last generation of a key is live.

    Every session has a conversation of its own upstream; its id is a digest of the session's.
    """
    history = settled(history)
    by_session = history.groupBy(*KEYS, "generation").agg(
        F.count("*").alias("requests"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.min("created_at").alias("created_at"),
        F.max("created_at").alias("last_used_at"),
        F.max_by(F.struct("list_hash", "n_messages"), "request_id").alias("last"),
    )
    newest = history.groupBy(*KEYS).agg(F.max("generation").alias("newest"))
    joined = by_session.join(newest, KEYS)
    name = F.concat_ws(":", *KEYS, "generation")
    return joined.select(
        F.sha2(name, 256).alias("id"), F.sha2(F.concat(F.lit("conversation:"), name), 256).alias("conversation_id"),
        *KEYS, "generation", "requests", "prompt_tokens",
        F.col("last.list_hash").alias("last_messages_hash"), F.col("last.n_messages").alias("last_msg_count"),
        "created_at", "last_used_at", (F.col("generation") < F.col("newest")).alias("is_expired"),
    )


def live_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.filter(~F.col("is_expired"))


def expire_stale(sessions: DataFrame, as_of, ttl_days: int = fixed.SESSION_TTL_DAYS) -> DataFrame:
    """Sessions used within `ttl_days` before `as_of`."""
    return sessions.filter(F.col("last_used_at") >= as_of - F.make_dt_interval(days=F.lit(ttl_days)))
