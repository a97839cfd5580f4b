"""Responses (response_id, text): reasoning, answers and tool calls in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatlog.functions import reasoning as R, toolcalls as C


def split_reasoning(df: DataFrame, mode: str = "separate", text: str = "text") -> DataFrame:
    """Add `reasoning`, `answer` and, by the mode, `content`.

    passthrough: the text as it is; strip: without reasoning; separate: the answer.
    """
    parts = df.withColumn("_parts", R.split_reasoning(text))
    shown = {
        "passthrough": F.col(text), "strip": R.strip_reasoning(text), "separate": F.col("_parts.answer"),
    }
    if mode not in shown:
        raise ValueError(f"unknown mode {mode!r}")
    return parts.withColumns({
        "reasoning": F.col("_parts.reasoning"), "answer": F.col("_parts.answer"), "content": shown[mode],
    }).drop("_parts")


def strip_reasoning(df: DataFrame, unclosed: str = "cut", text: str = "text") -> DataFrame:
    return df.withColumn("answer", R.strip_reasoning(text, unclosed))


def split_at_tool_marker(df: DataFrame, text: str = "text") -> DataFrame:
    parts = df.withColumn("_parts", R.split_at_tool_marker(text))
    return parts.withColumns({
        "answer": F.col("_parts.answer"), "tool_buffer": F.col("_parts.tool_buffer"),
        "has_marker": R.has_tool_marker(text),
    }).drop("_parts")


def with_tool_calls(df: DataFrame, scan: str = "answer", tag_mode: str = "fixed", text: str = "text") -> DataFrame:
    """Add `calls` (array) and `tool_parse_failed`; `scan` = 'answer' skips reasoning."""
    if scan not in ("answer", "all"):
        raise ValueError(f"scan must be 'answer' or 'all', not {scan!r}")
    source = R.split_reasoning(text)["answer"] if scan == "answer" else F.col(text)
    found = df.withColumn("_scanned", source).withColumn("calls", C.tool_calls("_scanned", tag_mode))
    return found.withColumn("tool_parse_failed", C.tool_parse_failed("_scanned", "calls")).drop("_scanned")


def extract_tool_calls(df: DataFrame, scan: str = "answer", tag_mode: str = "fixed", key: str = "response_id") -> DataFrame:
    """One row per call: (response_id, ord, call_id, dialect, name, args, arguments_json)."""
    found = with_tool_calls(df, scan, tag_mode).select(key, F.posexplode("calls").alias("ord", "call"))
    return found.select(
        key, F.col("ord").cast("bigint").alias("ord"), C.call_id(key, "ord").alias("call_id"),
        "call.dialect", "call.name", "call.args", "call.arguments_json",
    )


def extract_tool_blocks(df: DataFrame, key: str = "response_id", text: str = "text") -> DataFrame:
    """One row per marked block, with the dialect its body is read in."""
    found = df.filter(R.has_tool_marker(text)).select(key, F.posexplode(C.tool_blocks(text)).alias("ord", "block"))
    return found.select(key, F.col("ord").cast("bigint").alias("ord"), "block.dialect", "block.body")


def tool_usage_report(df: DataFrame, scan: str = "answer", tag_mode: str = "fixed") -> DataFrame:
    """Calls per tool and dialect; unreadable responses count under a null name."""
    found = with_tool_calls(df, scan, tag_mode)
    empty = F.array(F.struct(F.lit(None).cast("string").alias("dialect"), F.lit(None).cast("string").alias("name")))
    named = F.transform("calls", lambda c: F.struct(c["dialect"].alias("dialect"), c["name"].alias("name")))
    rows = found.select(
        "tool_parse_failed", F.explode(F.when(F.col("tool_parse_failed"), empty).otherwise(named)).alias("call")
    )
    return rows.groupBy("call.name", "call.dialect").agg(
        F.count_if(~F.col("tool_parse_failed")).alias("calls"),
        F.count_if("tool_parse_failed").alias("failed_responses"),
    )
