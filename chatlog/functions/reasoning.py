"""Separating a model's reasoning from its answer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatlog import fixed
from chatlog.functions.text import (
    as_col, before_position, drop_nuls, first_of, from_position, locate, trim_start,
)

OPEN, CLOSE = fixed.THINK_OPEN, fixed.THINK_CLOSE


def without_closed_blocks(c) -> Column:
    """Remove closed think blocks; the regex runs only where there is a close tag."""
    c = as_col(c)
    return F.when(
        F.contains(c, F.lit(CLOSE)), F.regexp_replace(c, fixed.THINK_BLOCK, "")
    ).otherwise(c)


def cut_at_open(c) -> Column:
    c = as_col(c)
    at = locate(OPEN, c)
    return F.when(at > 0, before_position(c, at)).otherwise(c)


def strip_reasoning(c, unclosed: str = "cut") -> Column:
    """Answer without reasoning.

    `cut` also drops NUL characters and everything from an unclosed think tag on;
    `keep` removes closed blocks only.
    """
    if unclosed == "cut":
        return trim_start(cut_at_open(without_closed_blocks(drop_nuls(c))))
    if unclosed == "keep":
        return trim_start(without_closed_blocks(c))
    raise ValueError(f"unclosed must be 'cut' or 'keep', not {unclosed!r}")


def split_reasoning(c) -> Column:
    """STRUCT<reasoning, answer> by the first open and the first close tag."""
    c = as_col(c)
    start, end = locate(OPEN, c), locate(CLOSE, c)
    both = (start > 0) & (end > 0)
    inner = F.substr(
        c, (start + len(OPEN)).cast("int"),
        F.greatest(end - start - len(OPEN), F.lit(0)).cast("int"),
    )
    return F.struct(
        F.when(both, inner).otherwise("").alias("reasoning"),
        F.when(both, trim_start(from_position(c, end + len(CLOSE)))).otherwise(c).alias("answer"),
    )


def has_tool_marker(c) -> Column:
    c = as_col(c)
    return F.contains(c, F.lit(fixed.CALLS_OPEN)) | F.contains(c, F.lit(fixed.TOOL_OPEN))


def tool_marker_position(c) -> Column:
    """1-based position of the first tool marker, 0 if there is none."""
    return first_of(locate(fixed.CALLS_OPEN, c), locate(fixed.TOOL_OPEN, c))


def split_at_tool_marker(c) -> Column:
    """STRUCT<answer, tool_buffer>: the text before the first marker, and the rest."""
    c = as_col(c)
    at = tool_marker_position(c)
    return F.struct(
        F.when(at > 0, before_position(c, at)).otherwise(c).alias("answer"),
        F.when(at > 0, from_position(c, at)).otherwise("").alias("tool_buffer"),
    )
