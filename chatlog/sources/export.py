"""Final response records in two chat dialects, as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog.functions import reasoning as R, toolcalls as C
from chatlog.functions.jsonvalue import quoted
from chatlog.sources.requests import OPENAI, _check


def _object(*members: tuple[str, Column | str]) -> Column:
    """JSON object text; members whose value is NULL are left out."""
    parts = [F.concat(F.lit(f'"{name}":'), F.lit(v) if isinstance(v, str) else v) for name, v in members]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _number(name: str, default: str | None = None) -> Column:
    text = F.col(name).cast("string")
    return text if default is None else F.coalesce(text, F.lit(default))


def export_chat_jsonl(
    responses: DataFrame,
    dialect: str,
    mode: str = "passthrough",
    tag_mode: str = "fixed",
    key: str = "response_id",
) -> DataFrame:
    """(key, record): one JSON record per response.

    `responses` has key, text, model and the usage columns (null without usage).
    First dialect: content is null where there are tool calls, usage is left out
    where there is none. Second dialect: content is a list of blocks, missing usage is 0.
    Tool calls are read from the text as the mode leaves it; `separate` changes the
    second dialect only.
    """
    _check(dialect)
    if mode not in ("passthrough", "strip", "separate"):
        raise ValueError(f"unknown mode {mode!r}")
    unclosed = "cut" if dialect == OPENAI else "keep"
    text = R.strip_reasoning("text", unclosed) if mode == "strip" else F.col("text")
    rows = responses.withColumn("_text", text).withColumn("_calls", C.tool_calls("_text", tag_mode))
    ids = F.transform("_calls", lambda c, i: F.struct(quoted(C.call_id(key, i)).alias("id"), c.alias("call")))
    rows = rows.withColumn("_calls", ids)
    called = F.size("_calls") > 0
    name = quoted(F.col(key).cast("string"))
    if dialect == OPENAI:
        functions = F.transform("_calls", lambda c: _object(
            ("id", c["id"]), ("type", '"function"'),
            ("function", _object(("name", quoted(c["call"]["name"])), ("arguments", quoted(c["call"]["arguments_json"])))),
        ))
        message = _object(
            ("role", '"assistant"'),
            ("content", F.when(called, "null").otherwise(quoted("_text"))),
            ("tool_calls", F.when(called, _list(functions))),
        )
        choice = _object(
            ("index", "0"), ("message", message),
            ("finish_reason", F.when(called, '"tool_calls"').otherwise('"stop"')),
        )
        usage = F.when(F.col("prompt_tokens").isNotNull(), _object(
            ("prompt_tokens", _number("prompt_tokens", "0")),
            ("completion_tokens", _number("completion_tokens", "0")),
            ("total_tokens", _number("total_tokens", "0")),
            ("completion_tokens_details", _object(("reasoning_tokens", _number("reasoning_tokens", "0")))),
        ))
        record = _object(
            ("id", name), ("object", '"chat.completion"'), ("model", quoted("model")),
            ("choices", _list(F.array(choice))), ("usage", usage),
        )
    else:
        split = R.split_reasoning("_text")
        body = split["answer"] if mode == "separate" else F.col("_text")
        thinking = F.when(split["reasoning"] != "", _object(
            ("type", '"thinking"'), ("thinking", quoted(split["reasoning"]))
        )) if mode == "separate" else F.lit(None).cast("string")
        uses = F.transform("_calls", lambda c: _object(
            ("type", '"tool_use"'), ("id", c["id"]), ("name", quoted(c["call"]["name"])),
            ("input", c["call"]["arguments_json"]),
        ))
        blocks = F.concat(
            F.array_compact(F.array(thinking, _object(("type", '"text"'), ("text", quoted(body))))), uses
        )
        usage = _object(
            ("input_tokens", _number("prompt_tokens", "0")), ("output_tokens", _number("completion_tokens", "0"))
        )
        record = _object(
            ("id", name), ("type", '"message"'), ("role", '"assistant"'), ("content", _list(blocks)),
            ("model", quoted("model")),
            ("stop_reason", F.when(called, '"tool_use"').otherwise('"end_turn"')),
            ("stop_sequence", "null"), ("usage", usage),
        )
    return rows.select(key, record.alias("record"))


def write_chat_jsonl(records: DataFrame, path: str) -> None:
    records.select(F.col("record").alias("value")).write.mode("errorifexists").text(path)
