"""Trimming, cutting and masking text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatlog import fixed


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim(c) -> Column:
    """Trim all Unicode white space (SQL `trim` alone takes spaces only)."""
    return F.trim(as_col(c), F.lit(fixed.WHITESPACE))


def trim_start(c) -> Column:
    return F.ltrim(as_col(c), F.lit(fixed.WHITESPACE))


def locate(needle: str, c) -> Column:
    """1-based position of `needle`, 0 if absent, as BIGINT."""
    return F.instr(as_col(c), F.lit(needle)).cast("bigint")


def first_of(*positions: Column) -> Column:
    """Smallest non-zero position, 0 if all are zero."""
    return F.coalesce(F.least(*[F.nullif(p, F.lit(0)) for p in positions], F.lit(None)), F.lit(0))


def from_position(c, start) -> Column:
    """Text from the 1-based position `start` to the end."""
    c = as_col(c)
    return F.substr(c, start.cast("int"))


def before_position(c, start) -> Column:
    """Text in front of the 1-based position `start`."""
    return F.left(as_col(c), (start - 1).cast("int"))


def prefix(c, n: int, missing: str = "-") -> Column:
    """First `n` characters; `missing` for null or empty text."""
    c = as_col(c)
    return F.coalesce(F.nullif(F.left(c, F.lit(n)), F.lit("")), F.lit(missing))


def drop_nuls(c) -> Column:
    return F.replace(as_col(c), F.lit("\0"), F.lit(""))
