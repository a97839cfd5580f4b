"""Requests in flight over time, from the log's intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatlog import fixed
from chatlog.operators.scan import BLOCK, BY_ROWS, block_scan, time_blocks, with_blocks


def concurrency_profile(logs: DataFrame, block_minutes: int | None = None) -> DataFrame:
    """(account_id, at, in_flight) at each start or end, for half-open intervals.

    A sweep line: +1 at a start, -1 at an end, netted per account and instant, then a
    running sum, for busy accounts in blocks along the time. One shuffle to (account, block)
    serves the netting and the sum. Zero-length requests add nothing.
    """
    start = F.timestamp_add("MILLISECOND", -F.col("duration_ms"), F.col("created_at"))
    points = (
        logs.filter(F.col("account_id").isNotNull() & (F.col("duration_ms") > 0))
        .select("account_id", F.inline(F.array(
            F.struct(start.alias("at"), F.lit(1).alias("step")),
            F.struct(F.col("created_at").alias("at"), F.lit(-1).alias("step")),
        )))
    )
    block = time_blocks("at", block_minutes) if block_minutes else BY_ROWS
    points = with_blocks(points, ["account_id"], block, ["at"])
    net = points.repartition("account_id", BLOCK).groupBy("account_id", BLOCK, "at").agg(F.sum("step").alias("step"))
    swept = block_scan(
        net, ["account_id"], ["at"], None,
        sums={"in_flight": F.col("step")}, leads={"until": F.col("at")},
    )
    return swept.select("account_id", "at", "until", "in_flight")


def concurrency_peaks(profile: DataFrame, cap: int = fixed.MAX_CONCURRENT) -> DataFrame:
    """Per account: the highest number in flight, and the time spent at or over the cap."""
    held = F.timestamp_diff("MICROSECOND", F.col("at"), F.col("until"))
    return profile.groupBy("account_id").agg(
        F.max("in_flight").alias("max_in_flight"),
        F.coalesce(F.sum(F.when(F.col("in_flight") >= cap, held)), F.lit(0)).alias("us_at_cap"),
        F.count_if(F.col("in_flight") >= cap).alias("points_at_cap"),
    )
