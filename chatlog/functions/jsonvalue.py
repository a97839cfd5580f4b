"""JSON values of any type, held as VARIANT and written as canonical text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from chatlog.functions.text import as_col, trim

# Closes the probe array of `strict_json`; no text to be parsed may hold it.
_END = "\u0001end\u0001"


def strict_json(c) -> Column:
    """VARIANT of a text that is one whole JSON value, NULL for anything else.

    `try_parse_json` stops after the first value and ignores what follows, so the
    text is parsed as the first item of an array that a known item must close.
    """
    c = as_col(c)
    wrapped = F.try_parse_json(F.concat(F.lit("["), c, F.lit(',"\\u0001end\\u0001"]')))

    def first(w: Column) -> Column:
        closed = F.try_variant_get(w, "$[1]", "string") == F.lit(_END)
        return F.when(closed, F.try_variant_get(w, "$[0]", "variant"))

    return F.when(~F.contains(c, F.lit(_END)), once(wrapped, first))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def present(v: Column) -> Column:
    """A VARIANT, with JSON null turned into SQL NULL."""
    return F.when(v.isNotNull() & ~F.is_variant_null(v), v)


def field(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def quoted(c) -> Column:
    """A string as JSON text."""
    return F.to_json(as_col(c).cast("string").cast("variant"))


def decode_argument(c) -> Column:
    """Tool argument text as JSON text: its JSON value if it is one, else a string."""
    return once(trim(c), lambda text: F.coalesce(F.to_json(strict_json(text)), quoted(text)))


def object_text(entries: Column) -> Column:
    """Canonical JSON object from ARRAY<STRUCT<key, value>> (value: JSON text).

    Keys are sorted; of a repeated key the last value stays. `entries` is used per
    key, so it should be a column or a lambda variable.
    """
    keys = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["key"])))

    def member(key: Column) -> Column:
        same = F.filter(entries, lambda e: e["key"] == key)
        return F.concat(quoted(key), F.lit(":"), F.element_at(same, -1)["value"])

    return F.concat(F.lit("{"), F.array_join(F.transform(keys, member), ","), F.lit("}"))
