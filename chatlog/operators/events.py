"""Captured response streams: event lines, chunks, and the responses in them.

Event lines are (response_id, line_no, line); chunks are (response_id, seq, type,
content, usage fields) with type text, usage, dialogId, finish or error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog import fixed
from chatlog.functions.jsonvalue import field, strict_json
from chatlog.functions.reasoning import cut_at_open, tool_marker_position, without_closed_blocks
from chatlog.functions.text import before_position, drop_nuls, from_position, locate, trim, trim_start
from chatlog.operators.scan import BLOCK, block_scan, ordered_concat, with_facts
from chatlog.operators.skew import salted_join
from chatlog.session import settled

# Pieces of text joined in one go.
BLOCK_ROWS = 4096
USAGE = {
    "prompt_tokens": "$.promptTokens",
    "completion_tokens": "$.completionTokens",
    "total_tokens": "$.totalTokens",
    "reasoning_tokens": "$.nativeUsage.completion_tokens_details.reasoning_tokens",
}
OPEN, CLOSE = fixed.THINK_OPEN, fixed.THINK_CLOSE


def usage_fields(data: Column) -> dict[str, Column]:
    """Token counts of a usage object (VARIANT), 0 where missing."""
    return {n: F.coalesce(field(data, path, "bigint"), F.lit(0).cast("bigint")) for n, path in USAGE.items()}


def normalize_usage(df: DataFrame, column: str = "usage_json") -> DataFrame:
    """Add the four token counts of a usage object held as JSON text."""
    return df.withColumn("_usage", strict_json(column)).withColumns(usage_fields(F.col("_usage"))).drop("_usage")


def event_name(line: Column) -> Column:
    """Name on an `event:` line, NULL on any other line."""
    return F.when(F.startswith(line, F.lit("event:")), trim(F.substr(line, F.lit(7))))


def chunk_columns(event: Column, data: Column) -> dict[str, Column]:
    """Chunk columns of a data line's JSON value under its event name."""
    kind = (
        F.when(event == "message", "text").when(event == "usage", "usage")
        .when(event == "finish", "finish").when(event == "dialogId", "dialogId")
    )
    content = field(data, "$.content", "string")
    usage = usage_fields(data)
    return {
        "type": kind,
        "content": F.when(kind == "text", F.coalesce(content, F.lit(""))).when(kind == "dialogId", content),
        **{n: F.when(kind == "usage", c) for n, c in usage.items()},
    }


def carry_event_name(lines: DataFrame) -> DataFrame:
    """Add `event`: the name of the last event line so far; blank lines do not reset it."""
    return block_scan(
        lines, ["response_id"], ["line_no"],
        lasts={"event": event_name(trim("line"))},
    )


def parse_event_stream(lines: DataFrame) -> DataFrame:
    """Chunks of event lines; malformed data and unknown events are skipped."""
    marked = F.contains("line", F.lit("event:")) | F.contains("line", F.lit("data:"))
    named = carry_event_name(lines.select("response_id", "line_no", trim("line").alias("line")).filter(marked))
    # A generator rather than a filter on the parsed value, which would parse it twice.
    data = F.transform(
        F.array(strict_json(trim(F.substr("line", F.lit(6))))),
        lambda d: F.struct(
            (d.isNotNull() & ~F.is_variant_null(d)).alias("valid"),
            *[c.alias(n) for n, c in chunk_columns(F.col("event"), d).items()],
        ),
    )
    known = F.filter(data, lambda c: c["valid"] & c["type"].isNotNull())
    chunks = named.filter(F.startswith("line", F.lit("data:"))).select(
        "response_id", F.col("line_no").alias("seq"), F.inline(known)
    )
    return chunks.drop("valid")


def stop_at_error(chunks: DataFrame) -> DataFrame:
    """Chunks up to and with the first error chunk of their response."""
    errors = chunks.filter("type = 'error'").groupBy("response_id").agg(F.min("seq").alias("_error"))
    rows = salted_join(chunks, errors, ["response_id"], spread_by="seq")
    return rows.filter(F.col("_error").isNull() | (F.col("seq") <= F.col("_error"))).drop("_error")


def assemble_responses(chunks: DataFrame, on_error: str = "stop") -> DataFrame:
    """(response_id, text, last usage, finished, error): text chunks joined in order.

    `stop` ends a response at its first error chunk, `ignore` reads on.
    """
    if on_error not in ("stop", "ignore"):
        raise ValueError(f"on_error must be 'stop' or 'ignore', not {on_error!r}")
    counts = [c for c in USAGE if c in chunks.columns]
    rows = chunks.select("response_id", "seq", "type", "content", *counts)
    if on_error == "stop":
        # The error of a response meets its blocks, so the blocks of a hot one stay apart.
        errors = chunks.groupBy("response_id").agg(
            F.min(F.when(F.col("type") == "error", F.col("seq"))).alias("_error"), F.max("seq").alias("_last"))
        rows = with_facts(rows, errors, ["response_id"], "seq", "_last", BLOCK_ROWS)
        rows = rows.filter(F.col("_error").isNull() | (F.col("seq") <= F.col("_error")))
    kind = F.col("type")
    joined = ordered_concat(
        rows.withColumn("_text", F.when(kind == "text", F.col("content"))), ["response_id"], "seq", {"text": "_text"},
        any_of={"finished": kind == "finish"}, head=BLOCK_ROWS,
        firsts={"_err": F.when(kind == "error", F.struct("seq", "content"))},
        finals={"_use": F.when(kind == "usage", F.struct("seq", *counts))},
    )
    return joined.select(
        "response_id", "text", *[F.col(f"_use.{c}").alias(c) for c in counts], "finished", F.col("_err.content").alias("error"))


def _drop_first_open(text: Column) -> Column:
    at = locate(OPEN, text)
    without = F.concat(before_position(text, at), from_position(text, at + len(OPEN)))
    return F.when(at > 0, without).otherwise(text)


def _facts(chunks: DataFrame) -> DataFrame:
    """Per response, in one pass: first non-empty text chunk `f`, `opened`, close chunk `c`, `finished`, last chunk and last usage.

    `opened` and `c` are null where there is no text.
    """
    kind = F.col("type")
    rows = chunks.select("response_id", "seq", "type", F.when(kind == "text", drop_nuls("content")).alias("t"))
    at = F.when(F.col("t") != "", F.col("seq"))
    facts = rows.groupBy("response_id").agg(
        F.min_by("t", at).alias("first"), F.min(at).alias("f"),
        F.min(F.when(F.contains("t", F.lit(CLOSE)), F.col("seq"))).alias("closed"),
        F.bool_or(kind == "finish").alias("finished"), F.max("seq").alias("last"),
        F.max(F.when(kind == "usage", F.col("seq"))).alias("last_usage"),
    )
    # Taking the open tag out of the first chunk may join a close tag together.
    joins = F.when(F.contains(_drop_first_open(F.col("first")), F.lit(CLOSE)), F.col("f"))
    return facts.select(
        "response_id", "f", F.contains(F.col("first"), F.lit(OPEN)).alias("opened"),
        F.least(F.col("closed"), joins).alias("c"), "finished", "last", "last_usage",
    )


def reasoning_pieces(chunks: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Text chunks with the part of each that is reasoning and the part that is answer.

    (response_id, _block, seq, reasoning, answer, past, opened, closed, finished): the first
    non-empty chunk decides whether there is reasoning; it ends at the first close tag.
    `past` is true for chunks read after that point. A response keeps a row without seq for
    a block without text. Facts join by block, so a hot response is never in one task.
    """
    facts = _facts(chunks) if facts is None else facts
    text = chunks.filter("type = 'text'").select("response_id", "seq", drop_nuls("content").alias("t"))
    rows = with_facts(text.filter("t <> ''"), facts, ["response_id"], "seq", "last", BLOCK_ROWS)
    first = F.col("opened") & (F.col("seq") == F.col("f"))
    rows = rows.withColumn("t", F.when(first, _drop_first_open(F.col("t"))).otherwise(F.col("t")))
    past = ~F.col("opened") | F.coalesce(F.col("seq") > F.col("c"), F.lit(False))
    at_close = F.coalesce(F.col("seq") == F.col("c"), F.lit(False))
    end = locate(CLOSE, "t")
    reasoning = F.when(past, "").when(at_close, before_position("t", end)).otherwise(F.col("t"))
    answer = (
        F.when(past, cut_at_open(without_closed_blocks("t")))
        .when(at_close, trim_start(from_position("t", end + len(CLOSE))))
        .otherwise("")
    )
    there = F.col("seq").isNotNull()
    return rows.select(
        "response_id", BLOCK, "seq", F.when(there, reasoning).alias("reasoning"), F.when(there, answer).alias("answer"),
        (there & past).alias("past"), F.coalesce("opened", F.lit(False)).alias("opened"),
        (F.coalesce("opened", F.lit(False)) & F.col("c").isNotNull()).alias("closed"), "finished",
    )


def segment_reasoning(chunks: DataFrame, mode: str = "separate") -> DataFrame:
    """(response_id, reasoning, answer, opened, closed, finished, content).

    `content` is what a client receives: the answer (`strip`, `separate`), or with
    `passthrough` the tagged reasoning in front of it, sent once the reasoning is
    closed or the response finished.
    """
    if mode not in ("passthrough", "strip", "separate"):
        raise ValueError(f"unknown mode {mode!r}")
    out = ordered_concat(
        reasoning_pieces(chunks), ["response_id"], "seq", {"reasoning": "reasoning", "answer": "answer"},
        any_of={n: F.col(n) for n in ("opened", "closed", "finished")}, head=BLOCK_ROWS,
    )
    tagged = F.concat(F.lit(OPEN), "reasoning", F.lit(CLOSE), "answer")
    shown = F.col("opened") & (F.col("closed") | F.col("finished"))
    content = F.when(shown, tagged).otherwise(F.col("answer")) if mode == "passthrough" else F.col("answer")
    return out.withColumn("content", content)


def segment_tool_buffer(chunks: DataFrame, holdback: int = fixed.MARKER_HOLDBACK) -> DataFrame:
    """(response_id, emitted, tool_buffer, finished): answer text sent on, and what is
    kept back from the first tool marker on.

    Without a finish chunk the last `holdback` characters are never sent, nor is
    answer text from the chunk that closed the reasoning if nothing followed it.
    """
    rows = ordered_concat(
        reasoning_pieces(chunks), ["response_id"], "seq", {"answer": "answer"},
        any_of={"looked": F.col("past") & (F.col("answer") != ""), "finished": F.col("finished")}, head=BLOCK_ROWS,
    )
    rows = rows.withColumn("at", tool_marker_position("answer"))
    seen = F.col("finished") | F.col("looked")
    held = F.greatest(F.length("answer") - holdback, F.lit(0))
    emitted = (
        F.when(~seen, "")
        .when(F.col("at") > 0, before_position("answer", F.col("at")))
        .when(F.col("finished"), F.col("answer"))
        .otherwise(F.left("answer", held))
    )
    buffer = F.when(seen & (F.col("at") > 0), from_position("answer", F.col("at"))).otherwise("")
    return rows.select("response_id", emitted.alias("emitted"), buffer.alias("tool_buffer"), "finished")


def early_cut(chunks: DataFrame) -> DataFrame:
    """Responses where reading stops at a closed tool call, and what that loses.

    (response_id, cut_seq, kept_chars, lost_chars, usage_lost). Reading stops at the
    first answer chunk after the one that opened the tool buffer at which the buffer
    holds a closing tag; that chunk is kept whole. Chunks are placed by their offsets
    in the joined answer, a running sum, so no response is folded in one task.

    A chunk read after the reasoning follows the opening one if the chunk before it was
    also read after the reasoning (its offset lies beyond the `lead`, the answer text of
    the chunk that closed the reasoning) and reached the end of the marker.
    """
    facts = settled(_facts(chunks))  # one row per response
    pieces = settled(reasoning_pieces(chunks, facts).filter(F.col("answer") != "").select("response_id", BLOCK, "seq", "past", "answer"))
    lead = F.when(~F.col("past"), F.col("answer"))
    joined = ordered_concat(
        pieces.withColumn("lead", lead), ["response_id"], "seq", {"text": "answer", "lead": "lead"}, head=BLOCK_ROWS
    )
    buffer = from_position("text", F.col("start"))
    opened = F.when(F.startswith(buffer, F.lit(fixed.TOOL_OPEN)), len(fixed.TOOL_OPEN)).otherwise(len(fixed.CALLS_OPEN))
    ends = [
        F.when(F.contains(buffer, F.lit(tag)), locate(tag, buffer) + len(tag) - 1)
        for tag in (fixed.TOOL_CLOSE, fixed.CALLS_CLOSE)
    ]
    marks = joined.withColumn("start", tool_marker_position("text")).filter("start > 0").select(
        "response_id", F.length("text").cast("bigint").alias("answer_chars"), F.length("lead").alias("lead_chars"),
        (F.col("start") - 1 + opened).alias("open_end"),
        (F.col("start") - 1 + F.least(*ends)).alias("close_end"),
    ).filter("close_end is not null")

    sizes = pieces.select("response_id", "seq", "past", F.length("answer").cast("bigint").alias("chars"))
    placed = block_scan(
        sizes, ["response_id"], ["seq"], sums={"upto": F.col("chars")}
    ).filter("past")
    met = salted_join(placed, marks, ["response_id"], spread_by="seq", how="inner", among=sizes)
    before = F.col("upto") - F.col("chars")
    here = (F.col("upto") >= F.col("close_end")) & (before >= F.col("open_end")) & (before > F.col("lead_chars"))
    cuts = met.filter(here).groupBy("response_id").agg(
        F.min("seq").alias("cut_seq"), F.min("upto").alias("kept_chars"), F.max("answer_chars").alias("answer_chars")
    )
    return cuts.join(facts.select("response_id", "last_usage"), "response_id", "left").select(
        "response_id", "cut_seq", "kept_chars", (F.col("answer_chars") - F.col("kept_chars")).alias("lost_chars"),
        F.coalesce(F.col("last_usage") > F.col("cut_seq"), F.lit(False)).alias("usage_lost"),
    )
