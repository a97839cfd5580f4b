"""Tool catalogs rendered from tool definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog import fixed
from chatlog.functions.text import as_col
from chatlog.operators.scan import ordered_concat

_SCHEMA = "struct<properties:map<string,struct<type:string>>,required:array<string>>"
DEFINITION = (
    f"struct<name:string,description:string,input_schema:{_SCHEMA},"
    f"function:struct<name:string,description:string,parameters:{_SCHEMA}>>"
)

RULES = """[Tool rules]
You may call the tools below. Write each call on its own, like this:

<tool_call>
{"name": "tool", "arguments": {"parameter": "value"}}
</tool_call>

Several calls may follow each other. If no tool is needed, answer without one.

[Tools]"""


def _type_name(v: Column) -> Column:
    """`any` without a type; a list of types is written with commas."""
    listed = F.regexp_replace(v, r'[\[\]"]', "")
    return F.coalesce(F.when(F.startswith(v, F.lit("[")), listed).otherwise(v), F.lit("any"))


def tool_line(definition) -> Column:
    """`- name(p*:type, ...): first line of the description`."""
    d = F.from_json(as_col(definition), DEFINITION)
    fn = d["function"]
    nested = fn.isNotNull()
    name = F.when(nested, fn["name"]).otherwise(d["name"])
    schema = F.when(nested, fn["parameters"]).otherwise(d["input_schema"])
    text = F.coalesce(F.when(nested, fn["description"]).otherwise(d["description"]), F.lit(""))
    required = F.coalesce(schema["required"], F.array().cast("array<string>"))
    params = F.transform(
        F.map_entries(schema["properties"]),
        lambda e: F.concat(
            e["key"], F.when(F.array_contains(required, e["key"]), "*").otherwise(""), F.lit(":"),
            _type_name(e["value"]["type"]),
        ),
    )
    listed = F.coalesce(F.array_join(params, ", "), F.lit(""))
    brief = F.left(F.split_part(text, F.lit("\n"), F.lit(1)), F.lit(fixed.TOOL_DESCRIPTION_CHARS))
    return F.concat(F.lit("- "), F.coalesce(name, F.lit("")), F.lit("("), listed, F.lit("): "), brief)


def render_tool_catalog(
    defs: DataFrame, keys: list[str], order: str = "def_id", definition: str = "def", rules: str = RULES
) -> DataFrame:
    """(keys, catalog): the rules text and one line per tool, in the order of `order`."""
    lines = defs.select(*keys, order, tool_line(definition).alias("line"))
    joined = ordered_concat(lines, keys, order, {"lines": "line"}, sep="\n")
    return joined.select(*keys, F.concat_ws("\n", F.lit(rules), "lines").alias("catalog"))
