"""Finding and decoding tool calls in response text.

The dialects are told apart block by block. Everything is an array expression
over the blocks of one response, so the job is a single narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatlog import fixed
from chatlog.functions.jsonvalue import decode_argument, field, object_text, present, strict_json
from chatlog.functions.reasoning import has_tool_marker
from chatlog.functions.text import as_col, trim

ARGS_TYPE = "array<struct<key:string,value:string>>"


def _no_args() -> Column:
    return F.array().cast(ARGS_TYPE)


def _groups(c: Column, pattern: str, n: int) -> list[Column]:
    return [F.regexp_extract_all(c, F.lit(pattern), F.lit(i)) for i in range(1, n + 1)]


def _entries(keys: Column, values: Column, trim_keys: bool = True, drop_empty: bool = True) -> Column:
    """Argument entries from a list of keys and a list of raw values."""
    pairs = F.zip_with(
        keys, values,
        lambda k, v: F.struct((trim(k) if trim_keys else k).alias("key"), decode_argument(v).alias("value")),
    )
    return F.filter(pairs, lambda e: e["key"] != "") if drop_empty else pairs


def _clean_block(block: Column) -> Column:
    """Trim a block and take off one tool_result tag at either end."""
    lead = rf"^{fixed.WS}*{fixed.RESULT_OPEN}"
    tail = rf"{fixed.RESULT_CLOSE}{fixed.WS}*\z"
    return trim(F.regexp_replace(F.regexp_replace(block, lead, ""), tail, ""))


def _dialect(body: Column) -> Column:
    return (
        F.when(F.startswith(body, F.lit("{")), "json")
        .when(F.contains(body, F.lit("<name")), "name")
        .when(F.contains(body, F.lit("<tool_name>")), "tool_name")
        .when(F.regexp_like(body, F.lit(fixed.FUNCTION)), "function")
        .when(F.regexp_like(body, F.lit(fixed.TAG_NAME)), "tag")
        .otherwise("none")
    )


def _group1(body: Column, pattern: str) -> Column:
    """First group of the first match, NULL without a match."""
    return F.when(F.regexp_like(body, F.lit(pattern)), F.regexp_extract(body, pattern, 1))


def _json_name(value: Column) -> Column:
    """The call's name; values that count as false give NULL."""
    name = field(value, "$.name")
    text = F.to_json(name)
    falsy = text.isin("null", "false", "0", "0.0", '""')
    return F.when(~falsy, F.coalesce(field(value, "$.name", "string"), text))


def _json_args(value: Column) -> Column:
    args = [present(field(value, f"$.{key}")) for key in ("arguments", "parameters", "input")]
    return F.coalesce(*[F.to_json(a) for a in args], F.lit("{}"))


def _object_entries(text: Column) -> Column:
    """Entries of a JSON object text, sorted by key; none for other values."""
    members = F.from_json(text, "map<string,variant>")
    entries = F.transform(
        F.map_entries(members),
        lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("value")),
    )
    return F.when(F.startswith(text, F.lit("{")), F.array_sort(entries)).otherwise(_no_args())


def _tag_body(body: Column, tag_mode: str) -> Column:
    if tag_mode == "compat":
        return body
    if tag_mode == "fixed":
        return F.regexp_replace(body, fixed.TAG_NAME, "")
    raise ValueError(f"tag_mode must be 'fixed' or 'compat', not {tag_mode!r}")


def _markup_call(block: Column, tag_mode: str) -> Column:
    """STRUCT<name, args> of a block in one of the markup dialects."""
    body, dialect = block["body"], block["dialect"]
    by_name, by_key, raw = _groups(body, fixed.NAME_PARAM, 3)
    attr = F.zip_with(by_name, by_key, lambda n, k: F.when(n != "", n).otherwise(k))
    arg_keys, arg_values = _groups(body, fixed.TOOL_NAME_ARG, 2)
    par_keys, par_values = _groups(body, fixed.FUNCTION_PARAM, 2)
    tag_keys, tag_values = _groups(_tag_body(body, tag_mode), fixed.TAG_ELEMENT, 2)
    tag = _group1(body, fixed.TAG_NAME)
    name = (
        F.when(
            dialect == "name",
            F.nullif(trim(F.coalesce(_group1(body, fixed.NAME_ELEMENT), _group1(body, fixed.NAME_EQUALS))), F.lit("")),
        )
        .when(dialect == "tool_name", trim(_group1(body, fixed.TOOL_NAME)))
        .when(dialect == "function", trim(_group1(body, fixed.FUNCTION)))
        .when(dialect == "tag", tag)
    )
    args = (
        F.when(dialect == "name", _entries(attr, raw))
        .when(dialect == "tool_name", _entries(arg_keys, arg_values, drop_empty=False))
        .when(dialect == "function", _entries(par_keys, par_values))
        .when(dialect == "tag", F.filter(_entries(tag_keys, tag_values), lambda e: e["key"] != tag))
    )
    return F.struct(name.alias("name"), args.alias("args"))


def _read_block(block: Column, tag_mode: str) -> Column:
    """STRUCT<dialect, name, args, json_args> from STRUCT<body, dialect, json>."""
    is_json = block["dialect"] == "json"
    markup = _markup_call(block, tag_mode)
    return F.struct(
        block["dialect"].alias("dialect"),
        F.when(is_json, _json_name(block["json"])).otherwise(markup["name"]).alias("name"),
        markup["args"].alias("args"),
        F.when(is_json, _json_args(block["json"])).alias("json_args"),
    )


def _call(read: Column) -> Column:
    is_json = read["dialect"] == "json"
    return F.struct(
        read["dialect"].alias("dialect"), read["name"].alias("name"),
        F.when(is_json, _object_entries(read["json_args"])).otherwise(read["args"]).alias("args"),
        F.when(is_json, read["json_args"]).otherwise(object_text(read["args"])).alias("arguments_json"),
    )


def tool_blocks(c) -> Column:
    """ARRAY<STRUCT<body, dialect>> of the tool_call blocks of a text."""
    bodies = F.transform(F.regexp_extract_all(as_col(c), F.lit(fixed.TOOL_BLOCK), F.lit(1)), _clean_block)
    return F.transform(bodies, lambda b: F.struct(b.alias("body"), _dialect(b).alias("dialect")))


def _block_calls(text: Column, tag_mode: str) -> Column:
    blocks = F.transform(
        tool_blocks(text),
        lambda b: F.struct(
            b["body"].alias("body"), b["dialect"].alias("dialect"),
            F.when(b["dialect"] == "json", strict_json(b["body"])).alias("json"),
        ),
    )
    # One step per transform: later steps use the values of earlier ones as variables.
    read = F.transform(blocks, lambda b: _read_block(b, tag_mode))
    return F.transform(F.filter(read, lambda c: c["name"].isNotNull()), _call)


def _invoke_calls(text: Column) -> Column:
    blocks = F.regexp_extract_all(text, F.lit(fixed.CALLS_BLOCK), F.lit(1))

    def invokes(block: Column) -> Column:
        names, bodies = _groups(block, fixed.INVOKE, 2)
        return F.arrays_zip(names.alias("name"), bodies.alias("body"))

    def call(inv: Column) -> Column:
        keys, values = _groups(inv["body"], fixed.INVOKE_PARAM, 2)
        args = _entries(keys, values, trim_keys=False, drop_empty=False)
        return F.struct(F.lit("invoke").alias("dialect"), inv["name"].alias("name"), args.alias("args"))

    calls = F.transform(F.flatten(F.transform(blocks, invokes)), call)
    return F.transform(
        calls,
        lambda c: F.struct(
            c["dialect"].alias("dialect"), c["name"].alias("name"), c["args"].alias("args"),
            object_text(c["args"]).alias("arguments_json"),
        ),
    )


CALLS_TYPE = f"array<struct<dialect:string,name:string,args:{ARGS_TYPE},arguments_json:string>>"


def tool_calls(c, tag_mode: str = "fixed") -> Column:
    """ARRAY<STRUCT<dialect, name, args, arguments_json>> of the calls in a text.

    Text without a marker skips every regex. The invoke dialect is tried only
    where no tool_call marker occurs.
    """
    c = as_col(c)
    return (
        F.when(F.contains(c, F.lit(fixed.TOOL_OPEN)), _block_calls(c, tag_mode).cast(CALLS_TYPE))
        .when(F.contains(c, F.lit(fixed.CALLS_OPEN)), _invoke_calls(c).cast(CALLS_TYPE))
        .otherwise(F.array().cast(CALLS_TYPE))
    )


def tool_parse_failed(c, calls) -> Column:
    """A marker is there, but no call could be read."""
    return has_tool_marker(c) & (F.size(as_col(calls)) == 0)


def call_id(key, ord_) -> Column:
    """Deterministic call id from the response key and the call's ordinal."""
    source = F.concat_ws(":", as_col(key).cast("string"), as_col(ord_).cast("string"))
    return F.concat(F.lit("call_"), F.left(F.sha2(source, 256), F.lit(8)))
