"""Joins that keep a hot key out of a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALTS = 32


def salted_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: str, salts: int = SALTS, how: str = "left",
    among: DataFrame | None = None,
) -> DataFrame:
    """Join `rows` to a `lookup` of at most one row per key.

    Rows of one key are spread over `salts` tasks by a hash of `spread_by`; each lookup row is
    repeated for the salts that its key has among the rows, so the repeated lookup is never longer than
    the rows, whatever other keys the lookup has. `among` may give rows that hold all keys and
    `spread_by` of `rows` and are cheaper to read again. No plan broadcasts the lookup by an estimate
    of its files: where it turns out small, adaptive execution may.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    met = (rows if among is None else among).select(*keys, salt.alias("_salt")).distinct()
    repeated = lookup.join(met.hint("merge"), keys)
    return rows.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")
