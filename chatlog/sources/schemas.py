"""Schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, N, D = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampNTZType(), T.DoubleType()


def _table(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Credentials are not carried; a key is known by its SHA-256 only.
ACCOUNTS = _table(
    id=L, alias=S, key_hash=S, is_active=B, banned_status=S, active_requests=L, created_at=N
)
SESSIONS = _table(
    id=S, conversation_id=S, account_id=L, client_session_id=L, generation=L, requests=L, prompt_tokens=L,
    last_messages_hash=S, last_msg_count=L, created_at=N, last_used_at=N, is_expired=B,
)
REQUEST_LOGS = _table(
    id=L, account_id=L, session_id=L, endpoint=S, model_alias=S, prompt_tokens=L, completion_tokens=L,
    reasoning_tokens=L, duration_ms=L, status=S, http_status=T.IntegerType(), error=S, created_at=N,
)
CONVERSATIONS = _table(conv_id=L, turn=L, role=S, text=S)
EVENT_LINES = _table(response_id=L, line_no=L, line=S)
EVENT_LINES_BY_TEXT = _table(response_id=S, line_no=L, line=S)
CHUNKS = _table(
    response_id=L, seq=L, type=S, content=S, prompt_tokens=L, completion_tokens=L, total_tokens=L,
    reasoning_tokens=L,
)
EVENTS = _table(event_id=L, ts=N, user_id=L, event_type=S, value=D, props=S)
