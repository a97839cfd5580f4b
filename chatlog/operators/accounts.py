"""Account lists: lookup, order, masking, choice of the least busy one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatlog.functions.text import as_col, prefix


# Characters shown of long values.
PREFIXES = {"key_hash": 20, "error": 40, "session_id": 16}
LABEL_CHARS = 12


def lookup(
    df: DataFrame,
    ids=None,
    key_hash: str | None = None,
    active_only: bool = False,
    key: str = "id",
) -> DataFrame:
    """Rows by id (a list, or a DataFrame with the key column), key hash or activity."""
    if isinstance(ids, DataFrame):
        df = df.join(ids.select(key).distinct(), key, "left_semi")
    elif ids is not None:
        df = df.filter(F.col(key).isin(*ids))
    if key_hash is not None:
        df = df.filter(F.col("key_hash") == key_hash)
    return df.filter(F.col("is_active")) if active_only else df


def newest_first(df: DataFrame, column: str = "created_at", tie: str = "id") -> DataFrame:
    return df.orderBy(F.desc(column), tie)


def masked_view(df: DataFrame, rules: dict[str, int] | None = None) -> DataFrame:
    """Rows as they may be shown: prefixes of ids, hashes and errors, `-` for null.

    `rules` maps a column to the number of characters kept of it; by default those of
    the columns `df` has. Accounts get a label: the alias, or a prefix of the key hash.
    """
    rules = {c: n for c, n in PREFIXES.items() if c in df.columns} if rules is None else rules
    if {"alias", "key_hash"} <= set(df.columns):
        alias = F.nullif(F.col("alias"), F.lit(""))
        df = df.withColumns({
            "label": F.coalesce(alias, prefix("key_hash", LABEL_CHARS)), "alias": F.coalesce(alias, F.lit("-")),
        })
    return df.withColumns({column: prefix(as_col(column).cast("string"), n) for column, n in rules.items()})


def in_flight_at(logs: DataFrame, as_of) -> DataFrame:
    """Requests running at `as_of` per account: start <= as_of < end."""
    start = F.timestamp_add("MILLISECOND", -F.col("duration_ms"), F.col("created_at"))
    running = logs.filter(F.col("account_id").isNotNull() & (F.col("created_at") > as_of) & (start <= as_of))
    return running.groupBy("account_id").agg(F.count("*").alias("active_requests"))


def with_active_requests(accounts: DataFrame, logs: DataFrame, as_of) -> DataFrame:
    """Accounts with the number of their requests running at `as_of`."""
    busy = in_flight_at(logs, as_of).withColumnRenamed("account_id", "id")
    joined = accounts.join(busy, "id", "left")
    return joined.withColumn("active_requests", F.coalesce("active_requests", F.lit(0)))


def least_busy(accounts: DataFrame) -> DataFrame:
    """The active account with the fewest running requests; ties go to the lower id."""
    row = F.struct(*accounts.columns)
    best = accounts.filter("is_active").agg(F.min_by(row, F.struct("active_requests", "id")).alias("row"))
    return best.filter("row is not null").select("row.*")
