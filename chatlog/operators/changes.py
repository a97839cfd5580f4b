"""Keyed updates: a base table and a change log give the new table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatlog.operators.skew import salted_join


def apply_changes(
    base: DataFrame | None,
    changes: DataFrame,
    key: str = "id",
    sets: list[str] | None = None,
    adds: list[str] | None = None,
    insert: bool = True,
) -> DataFrame:
    """Apply `changes` (key, seq, op, columns...) in the order of `seq` to `base`.

    op 'delete' removes the row, 'update' writes it if it is there at that point, and any
    other op writes it in any case. Columns in `sets` take the last value written, columns
    in `adds` the sum of the values written. A change writes the set columns listed in its
    array column `fields`, or without one its non-null columns. Rows of a key before its
    last delete do not count, and an update of an absent row does nothing. With
    `insert=False`, changes of unknown keys are dropped.

    The life of each key (last delete, first write after it, part of the base) meets the
    writes under a salted key and the rest is one combinable aggregate, so a much changed key
    reaches its task as few partial rows.
    """
    sets, adds = list(sets or []), list(adds or [])
    by_fields = "fields" in changes.columns
    removed = changes.filter(F.col("op") == "delete").groupBy(key).agg(F.max("seq").alias("_removed"))
    written = salted_join(changes.filter(F.col("op") != "delete"), removed, [key], spread_by="seq")
    written = written.filter(F.col("_removed").isNull() | (F.col("seq") > F.col("_removed")))
    lives = written.filter(F.col("op") != "update").groupBy(key).agg(F.min("seq").alias("_born"))
    if base is None:
        lives = lives.withColumn("_there", F.lit(None).cast("boolean"))
    else:
        lives = lives.join(base.select(key, F.lit(True).alias("_there")), key, "full_outer")
    alive = (F.col("_there") & F.col("_removed").isNull()) | (F.col("seq") > F.col("_born"))
    written = salted_join(written, lives, [key], spread_by="seq", among=changes.filter(F.col("op") != "delete"))
    written = written.filter((F.col("op") != "update") | F.coalesce(alive, F.lit(False)))

    aggregates = []
    for c in sets:
        wrote = F.array_contains("fields", c) if by_fields else F.col(c).isNotNull()
        aggregates.append(F.max_by(F.struct(c), F.when(wrote, F.col("seq"))).alias(f"_set_{c}"))
    aggregates += [F.sum(c).alias(f"_add_{c}") for c in adds]
    delta = written.groupBy(key).agg(F.count("*").alias("_changes"), *aggregates)
    if base is None:
        return delta.select(
            key, *[F.col(f"_set_{c}")[c].alias(c) for c in sets],
            *[F.coalesce(f"_add_{c}", F.lit(0)).alias(c) for c in adds],
        )

    merged = base.withColumn("_base", F.lit(True)).join(delta, key, "full_outer" if insert else "left")
    merged = merged.join(removed, key, "left")
    fresh = F.col("_removed").isNotNull() | F.col("_base").isNull()
    merged = merged.filter(~F.col("_removed").isNotNull() | F.col("_changes").isNotNull())
    columns = []
    for c in base.columns:
        old = F.when(~fresh, F.col(c))
        if c == key:
            columns.append(F.col(c))
        elif c in sets:
            new = F.col(f"_set_{c}")
            columns.append(F.when(new.isNotNull(), new[c]).otherwise(old).alias(c))
        elif c in adds:
            columns.append((F.coalesce(old, F.lit(0)) + F.coalesce(F.col(f"_add_{c}"), F.lit(0))).alias(c))
        else:
            columns.append(old.alias(c))
    return merged.select(*columns)


def apply_account_changes(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert, patch (only the given fields) and delete accounts."""
    columns = ("alias", "key_hash", "is_active", "banned_status")
    sets = [c for c in columns if c in base.columns and c in changes.columns]
    return apply_changes(base, changes, sets=sets)


def apply_session_changes(base: DataFrame | None, changes: DataFrame, key: str = "id") -> DataFrame:
    """Insert, update and delete sessions: prompt tokens add up, other columns are set."""
    known = {"id", "seq", "op", "fields", key, "prompt_tokens"}
    return apply_changes(
        base, changes, key=key, sets=[c for c in changes.columns if c not in known], adds=["prompt_tokens"]
    )
