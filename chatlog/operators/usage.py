"""Usage, health and paging over the request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chatlog import fixed
from chatlog.operators.accounts import with_active_requests
from chatlog.operators.scan import block_scan, exact_quantiles

# Pages that end within this many rows are taken by a top-k; later ones by rank.
TOP_K_ROWS = 10_000


def tokens_by(logs: DataFrame, *keys: str) -> DataFrame:
    """Token sums and request counts; the map side combines before the shuffle."""
    return logs.groupBy(*keys).agg(
        F.sum("prompt_tokens").alias("total_prompt_tokens"),
        F.sum("completion_tokens").alias("total_completion_tokens"),
        F.count("id").alias("total_requests"),
    )


def accounts_with_usage(accounts: DataFrame, usage: DataFrame) -> DataFrame:
    """Every account with its sums, 0 where there are no logs; unknown accounts drop.

    `usage` is already one row per account, so the join moves no raw log rows and
    a busy account is one row like any other.
    """
    names = [c for c in usage.columns if c != "account_id"]
    joined = accounts.join(usage.withColumnRenamed("account_id", "id"), "id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in names})


def usage_by_account(accounts: DataFrame, logs: DataFrame) -> DataFrame:
    known = logs.filter(F.col("account_id").isNotNull())
    return accounts_with_usage(accounts, tokens_by(known, "account_id"))


def filter_logs(logs: DataFrame, account_id=None, status=None, endpoint=None) -> DataFrame:
    """AND of the filters given; an absent or empty one does not filter."""
    for column, value in (("account_id", account_id), ("status", status), ("endpoint", endpoint)):
        if value is not None and value != "":
            logs = logs.filter(F.col(column) == F.lit(value))
    return logs


def _log_condition(account_id=None, status=None, endpoint=None) -> Column:
    out = F.lit(True)
    for column, value in (("account_id", account_id), ("status", status), ("endpoint", endpoint)):
        if value is not None and value != "":
            out = out & (F.col(column) == F.lit(value))
    return out


def count_logs(logs: DataFrame, **filters) -> DataFrame:
    """Both counts in one pass: all logs, and those the filters keep."""
    return logs.agg(
        F.count("*").alias("total_all"),
        F.count_if(_log_condition(**filters)).alias("total_filtered"),
    )


def page_logs(
    logs: DataFrame, page: int = 1, limit: int = 50, top_k_rows: int = TOP_K_ROWS, **filters
) -> DataFrame:
    """One page, newest first, ties by id. Page and limit are brought into range.

    A page near the top is a top-k per task. A deep page would make that top-k hold
    every row before it, so it is found by rank instead.
    """
    page = max(int(page), 1)
    limit = min(max(int(limit), 1), fixed.MAX_PAGE_ROWS)
    offset = (page - 1) * limit
    rows = filter_logs(logs, **filters)
    if offset + limit <= top_k_rows:
        return rows.orderBy(F.desc("created_at"), "id").offset(offset).limit(limit)
    return _page_by_rank(rows, offset, limit)


def _page_by_rank(rows: DataFrame, offset: int, limit: int) -> DataFrame:
    """Rows offset+1 .. offset+limit: counts per hour, then per second of the hours
    the page touches, then only the rows of the seconds it touches are ranked.

    A page touches at most `limit` non-empty hours or seconds, which bounds the
    broadcast sides.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    second = F.timestamp_diff("SECOND", epoch, F.col("created_at"))
    rows = rows.withColumns({"_sec": second, "_hour": F.floor(second / 3600)})

    def touched(counts, unit, base, window):
        upto = base + F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, 0))
        ranked = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
        hit = ranked.filter((F.col("upto") > offset) & (F.col("before") < offset + limit))
        return hit.select(unit, "before")

    hours = rows.groupBy("_hour").agg(F.count("*").alias("n"))
    hours = touched(hours, "_hour", F.lit(0), Window.orderBy(F.desc("_hour")))
    seconds = rows.join(F.broadcast(hours), "_hour").groupBy("_hour", "before", "_sec")
    seconds = seconds.agg(F.count("*").alias("n")).withColumnRenamed("before", "base")
    seconds = touched(
        seconds, "_sec", F.col("base"), Window.partitionBy("_hour").orderBy(F.desc("_sec"))
    )
    # A crowded second is ranked in blocks.
    newest = -F.timestamp_diff("MICROSECOND", epoch, F.col("created_at"))
    near = rows.join(F.broadcast(seconds), "_sec").withColumn("_newest", newest)
    ranked = block_scan(near, ["_sec"], ["_newest", "id"], sums={"_row": F.lit(1).cast("bigint")})
    ranked = ranked.withColumn("_rank", F.col("before") + F.col("_row"))
    page = ranked.filter((F.col("_rank") > offset) & (F.col("_rank") <= offset + limit))
    return page.orderBy("_rank").drop("_rank", "_row", "_newest", "_sec", "_hour", "before")


def page_after(logs: DataFrame, created_at, id, limit: int = 50, **filters) -> DataFrame:
    """The page that follows a known last row: a filter and a top-k at any depth."""
    limit = min(max(int(limit), 1), fixed.MAX_PAGE_ROWS)
    at = F.lit(created_at)
    later = (F.col("created_at") < at) | ((F.col("created_at") == at) & (F.col("id") > F.lit(id)))
    return filter_logs(logs, **filters).filter(later).orderBy(F.desc("created_at"), "id").limit(limit)


def token_totals(accounts: DataFrame, logs: DataFrame) -> DataFrame:
    """Totals per account and, with a null account, over all of them."""
    usage = usage_by_account(accounts, logs)
    rolled = usage.rollup("id").agg(
        F.sum("total_prompt_tokens").alias("prompt_tokens"),
        F.sum("total_completion_tokens").alias("completion_tokens"),
        F.grouping("id").alias("level"),
    )
    return rolled.select(
        F.col("id").alias("account_id"), "prompt_tokens", "completion_tokens",
        (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
        (F.col("level") == 1).alias("is_grand_total"),
    )


def monitor_summary(accounts: DataFrame, logs: DataFrame, as_of) -> DataFrame:
    """Active accounts, requests running at `as_of`, requests of known accounts."""
    usage = usage_by_account(with_active_requests(accounts, logs, as_of), logs)
    return usage.agg(
        F.count_if("is_active").alias("active_accounts"),
        F.sum("active_requests").alias("active_requests"),
        F.sum("total_requests").alias("total_requests"),
    )


def usage_trend(logs: DataFrame, unit: str = "hour") -> DataFrame:
    """Requests and tokens per time bucket and endpoint."""
    return logs.groupBy(F.date_trunc(unit, "created_at").cast("timestamp_ntz").alias("bucket"), "endpoint").agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
    )


def request_health(logs: DataFrame, keys=("endpoint",)) -> DataFrame:
    """Error rate, duration quantiles, reasoning share, successes without usage."""
    keys = list(keys)
    ok = F.col("status") == "success"
    sums = logs.groupBy(*keys).agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(ok & F.col("prompt_tokens").isNull()).alias("suspect_success"),
        F.sum("reasoning_tokens").alias("reasoning"),
        F.sum("completion_tokens").alias("completion"),
    )
    times = exact_quantiles(
        logs, keys, "duration_ms",
        {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, width=60_000,
    )
    times = times.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]  # a null key is a group of its own
    return sums.join(times, same, "left").select(
        *keys, "requests", "errors", "suspect_success",
        (F.col("errors") / F.col("requests")).alias("error_rate"),
        F.when(F.col("completion") > 0, F.col("reasoning") / F.col("completion")).alias("reasoning_share"),
        "p50_ms", "p95_ms", "p99_ms",
    )


def session_token_totals(logs: DataFrame) -> DataFrame:
    """Per session: tokens, requests and last time of requests with usage."""
    used = logs.filter(F.col("session_id").isNotNull() & F.col("prompt_tokens").isNotNull())
    return used.groupBy("session_id").agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.count("*").alias("requests"),
        F.max("created_at").alias("last_used_at"),
    )


def logs_with_sessions(logs: DataFrame, sessions: DataFrame, spread: int = 1024) -> DataFrame:
    """Logs left-joined to their sessions; session columns get the prefix `session_`.

    Logs without a session match nothing, but a plain outer join would send them all
    to one task; a salt on their key spreads them.
    """
    renamed = sessions.select(
        F.col("id").alias("session_id"), F.lit(0).alias("_salt"),
        *[F.col(c).alias(f"session_{c}") for c in sessions.columns if c != "id"],
    )
    salt = F.when(
        F.col("session_id").isNull(), F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int")
    ).otherwise(0)
    return logs.withColumn("_salt", salt).join(renamed, ["session_id", "_salt"], "left").drop("_salt")


def uniqueness_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
