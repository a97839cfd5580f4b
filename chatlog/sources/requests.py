"""Request bodies in two dialects: parameters and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog import fixed
from chatlog.functions.jsonvalue import field, strict_json
from chatlog.functions.text import as_col
from chatlog.operators.scan import ordered_concat

OPENAI, ANTHROPIC = "openai", "anthropic"
_BLOCK = "array<struct<type:string,text:string,name:string,input:string,content:string>>"
_BODY = "struct<messages:array<struct<role:string,content:string>>>"


def _check(dialect: str) -> None:
    if dialect not in (OPENAI, ANTHROPIC):
        raise ValueError(f"dialect must be {OPENAI!r} or {ANTHROPIC!r}, not {dialect!r}")


def _kind(v: Column) -> Column:
    """First character of a VARIANT's JSON: quote for text, bracket for a list."""
    return F.left(F.to_json(v), F.lit(1))


def _truthy(v: Column) -> Column:
    return F.coalesce(~F.to_json(v).isin("null", "false", "0", '""'), F.lit(False))


def _block_text(raw: Column, v: Column) -> Column:
    """Text of one content block, NULL for kinds that are skipped.

    `raw` is the block with nested values as JSON text in their own key order, `v` the
    same block as VARIANT, which tells a string from a list.
    """
    content = field(v, "$.content")
    name, args = F.to_json(field(v, "$.name")), raw["input"]
    args = F.when(_kind(field(v, "$.input")) == '"', F.to_json(field(v, "$.input"))).otherwise(
        F.coalesce(args, F.when(field(v, "$.input").isNotNull(), F.lit("null")))
    )
    members = F.concat_ws(",", F.concat(F.lit('"name":'), name), F.concat(F.lit('"arguments":'), args))
    call = F.concat(F.lit(f"{fixed.TOOL_OPEN}\n{{"), members, F.lit(f"}}\n{fixed.TOOL_CLOSE}"))
    items = F.try_variant_get(content, "$", "array<variant>")
    texts = F.transform(
        F.filter(items, lambda i: field(i, "$.type", "string") == "text"),
        lambda i: F.coalesce(field(i, "$.text", "string"), F.lit("")),
    )
    result = (
        F.when(_kind(content) == '"', field(v, "$.content", "string"))
        .when(_kind(content) == "[", F.array_join(texts, ""))
        .when(content.isNull(), "undefined")
        .otherwise(F.coalesce(raw["content"], F.lit("null")))
    )
    kind = field(v, "$.type", "string")
    return (
        F.when(kind == "text", F.coalesce(field(v, "$.text", "string"), F.lit("")))
        .when(kind == "tool_use", call)
        .when(kind == "tool_result", F.concat(F.lit(fixed.TOOL_RESULT_LABEL + "\n"), result))
    )


def content_text(raw: Column, v: Column) -> Column:
    """Message content as text: a string as it is, blocks joined by newlines, else ''."""
    blocks = F.zip_with(
        F.from_json(raw, _BLOCK), F.try_variant_get(v, "$", "array<variant>"), _block_text
    )
    listed = F.array_join(F.filter(blocks, lambda b: b.isNotNull()), "\n")
    return F.when(_kind(v) == '"', F.try_variant_get(v, "$", "string")).when(_kind(v) == "[", listed).otherwise("")


def parse_messages(df: DataFrame, dialect: str, body: str = "body") -> DataFrame:
    """Add `messages` ARRAY<STRUCT<role, content>>; blocks are flattened in both dialects.

    The second dialect puts a string `system` first and drops empty messages.
    """
    _check(dialect)
    parsed = df.withColumns({"_v": strict_json(body), "_raw": F.from_json(body, _BODY)})
    values = F.try_variant_get("_v", "$.messages", "array<variant>")
    messages = F.zip_with(
        F.col("_raw.messages"), values,
        lambda raw, v: F.struct(
            field(v, "$.role", "string").alias("role"),
            content_text(raw["content"], field(v, "$.content")).alias("content"),
        ),
    )
    messages = F.coalesce(messages, F.array().cast("array<struct<role:string,content:string>>"))
    if dialect == ANTHROPIC:
        system = F.when(_kind(field(F.col("_v"), "$.system")) == '"', field(F.col("_v"), "$.system", "string"))
        first = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
        messages = F.filter(F.concat(first, messages), lambda m: F.coalesce(m["content"], F.lit("")) != "")
    return parsed.withColumn("messages", messages).drop("_v", "_raw")


def flatten_blocks(df: DataFrame, key: str, dialect: str = ANTHROPIC, body: str = "body") -> DataFrame:
    """One row per message: (key, turn, role, text)."""
    parsed = parse_messages(df, dialect, body)
    rows = parsed.select(key, F.posexplode("messages").alias("turn", "m"))
    return rows.select(key, F.col("turn").cast("bigint").alias("turn"), "m.role", F.col("m.content").alias("text"))


def tool_result_text(name, call_id, content) -> Column:
    """A tool-role message as a labelled block."""
    def text(c):
        return F.coalesce(as_col(c), F.lit(""))

    head = F.concat(F.lit(fixed.TOOL_RESULT_LABEL + " "), text(name), F.lit(" ("), text(call_id), F.lit("):\n"))
    return F.concat(head, text(content))


def render_tool_results(messages: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(key, tool_results): tool-role messages as labelled blocks, joined by blank lines.

    `messages` has role, name, tool_call_id and content; keys without any are left out.
    """
    rows = messages.filter("role = 'tool'").withColumn("block", tool_result_text("name", "tool_call_id", "content"))
    return ordered_concat(rows, [key], order, {"tool_results": "block"}, sep="\n\n")


def parse_chat_requests(df: DataFrame, dialect: str, body: str = "body", default_temperature=None) -> DataFrame:
    """Add the request's parameters with their defaults, and its messages.

    (model, temperature, top_p, thinking, web_search, is_stream, n_tools, system_prompt,
    messages, corrupt). `default_temperature` is a column of the resolved model's default.
    The second dialect has no temperature, top_p or search of its own.
    """
    _check(dialect)
    default = F.lit(fixed.DEFAULT_TEMPERATURE) if default_temperature is None else as_col(default_temperature)
    v = F.col("_v")
    out = parse_messages(df, dialect, body).withColumn("_v", strict_json(body))
    first = dialect == OPENAI
    temperature = F.coalesce(field(v, "$.temperature", "double"), default) if first else default
    top_p = F.lit(fixed.DEFAULT_TOP_P)
    search = F.lit(fixed.DEFAULT_WEB_SEARCH)
    if first:
        top_p = F.coalesce(field(v, "$.top_p", "double"), top_p)
        search = F.coalesce(field(v, "$.web_search", "string"), search)
        thinking = _truthy(field(v, "$.reasoning_effort"))
    else:
        thinking = F.coalesce(field(v, "$.thinking.type", "string") == "enabled", F.lit(False))
    tools = F.try_variant_get(v, "$.tools", "array<variant>")
    system = F.filter("messages", lambda m: m["role"] == "system")
    return out.withColumns({
        "model": F.coalesce(field(v, "$.model", "string"), F.lit("")),
        "temperature": temperature, "top_p": top_p, "thinking": thinking, "web_search": search,
        "is_stream": F.coalesce(field(v, "$.stream", "boolean"), F.lit(False)),
        "n_tools": F.coalesce(F.size(tools), F.lit(0)),
        "system_prompt": F.coalesce(F.try_element_at(system, F.lit(1))["content"], F.lit("")),
        "corrupt": v.isNull(),
    }).drop("_v")
