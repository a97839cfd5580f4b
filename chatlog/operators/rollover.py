"""Token-limited sessions: a running sum with reset, without gathering a key.

Let q be the tokens used before a request, summed from the start of its key. A
session that starts at q = s ends before the first request with q >= s + L, where
L = limit + 1. On the line of q cut into cells of width L, a session therefore
starts at most once per cell, and where the next one starts depends on the offset
into the cell alone. A stretch of cells is then a step function from the offset a
chain enters with to the point it leaves for, with at most as many steps as its
first cell has distinct values of q (at most L). Stretches are solved in parallel
and the starts are marked in parallel. In between the step functions are chained by a
tree: FAN neighbours make one step function of the same kind, level by level up to one
per key, and on the way down each learns what its chain enters it with. So a task
holds at most FAN step functions, however long a key is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from chatlog import fixed
from chatlog.operators.scan import BY_ROWS, block_scan
from chatlog.session import settled

# Keys with at most this many requests are folded in one go.
GATHER = 10_000
# A stretch covers at most this many tokens, hence at most this many points.
STRETCH_POINTS = 1 << 24
# Neighbouring step functions that one task makes into one.
FAN = 16


def _next_start(q: np.ndarray, width: int) -> np.ndarray:
    """For each point, the index of the first point at least `width` further on."""
    return np.searchsorted(q, q + width, side="left")


def _exits(q: np.ndarray, width: int) -> np.ndarray:
    """For a chain that starts at each point: the target it leaves the stretch with."""
    jump, target = _next_start(q, width), q + width
    last = np.where(jump < len(q), jump, np.arange(len(q)))
    while True:  # pointer doubling: log2(cells) rounds
        further = last[last]
        if np.array_equal(further, last):
            return target[last]
        last = further


def _step_function(cells: int, width: int, keys: list[str]):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        q = np.sort(pdf["q"].to_numpy(dtype="int64"))
        begin = int(pdf["stretch"].iloc[0]) * cells * width
        exits = _exits(q, width)
        # Entry targets up to `upto` meet point i first; beyond the first cell one step is enough.
        steps = int(np.searchsorted(q, begin + width, side="left")) + 1
        steps = min(steps, len(q))
        out = pdf[keys + ["stretch"]].head(1)
        out = out.loc[out.index.repeat(steps)].reset_index(drop=True)
        return out.assign(upto=q[:steps], leaves=exits[:steps])

    return solve


def _functions(pdf: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(number, upto, leaves) of each step function in the rows, in order."""
    pdf = pdf.sort_values(["stretch", "upto"])
    stretch, upto, leaves = (pdf[c].to_numpy(dtype="int64") for c in ("stretch", "upto", "leaves"))
    names, begins = np.unique(stretch, return_index=True)
    parts = zip(names, np.split(upto, begins[1:]), np.split(leaves, begins[1:]))
    return [(int(n), u, v) for n, u, v in parts]


def _passed(target: np.ndarray, upto: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """What chains leave with that enter with these targets; beyond the last point nothing changes."""
    at = np.searchsorted(upto, target, side="left")
    return np.where(at < len(upto), leaves[np.minimum(at, len(upto) - 1)], target)


def _composed(keys: list[str], fan: int):
    """Neighbouring step functions to one, numbered one level up.

    A target that lies beyond the points of the first one is within its first cell, so it meets
    the first point of the second.
    """

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = _functions(pdf)
        _, upto, leaves = parts[-1]
        for _, first, left in reversed(parts[:-1]):
            leaves = np.append(_passed(left, upto, leaves), leaves[0])
            upto = np.append(first, upto[0])
        out = pdf[keys].head(1)
        out = out.loc[out.index.repeat(len(upto))].reset_index(drop=True)
        return out.assign(stretch=parts[0][0] // fan, upto=upto, leaves=leaves)

    return compose


def _entered(keys: list[str]):
    """The targets that neighbouring step functions are entered with, from that of the first."""

    def enter(steps: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        target = np.asarray([int(above["entry"].iloc[0])])
        names, entries = [], []
        for name, upto, leaves in _functions(steps):
            names.append(name)
            entries.append(int(target[0]))
            target = _passed(target, upto, leaves)
        out = steps[keys].head(1)
        out = out.loc[out.index.repeat(len(names))].reset_index(drop=True)
        return out.assign(stretch=names, entry=entries)

    return enter


def _chained(steps: DataFrame, keys: list[str], last: int, step_schema: T.StructType, entry_schema: T.StructType) -> DataFrame:
    """The target that the chain of each key enters each stretch with; `last` is the greatest stretch."""
    levels, up = [settled(steps)], F.floor(F.col("stretch") / FAN).cast("bigint").alias("_up")
    while last >= FAN:
        made = levels[-1].groupBy(*keys, up).applyInPandas(_composed(keys, FAN), step_schema)
        levels.append(settled(made))
        last //= FAN
    entries = levels[-1].select(*keys, F.lit(0).cast("bigint").alias("stretch"), F.lit(0).cast("bigint").alias("entry")).distinct()
    for level in reversed(levels):
        above = entries.withColumnRenamed("stretch", "_up").groupBy(*keys, "_up")
        entries = level.groupBy(*keys, up).cogroup(above).applyInPandas(_entered(keys), entry_schema)
    return entries


def _starts(width: int, keys: list[str]):
    def mark(points: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        q = np.sort(points["q"].to_numpy(dtype="int64"))
        jump = _next_start(q, width)
        at = int(np.searchsorted(q, int(entries["entry"].iloc[0]), side="left"))
        starts = []
        while at < len(q):
            starts.append(q[at])
            at = int(jump[at])
        out = points[keys].head(1)
        out = out.loc[out.index.repeat(len(starts))].reset_index(drop=True)
        return out.assign(q=np.asarray(starts, dtype="int64"))

    return mark


def _folded(requests: DataFrame, keys: list[str], order: list[str], own: Column, cut: Column, limit: int) -> DataFrame:
    """Generation, tokens and starts for keys with a bounded number of requests: one shuffle, no table.

    A fold over the requests of a key finds where sessions start; they are cut there and laid out again.
    """
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    others = [c for c in requests.columns if c not in keys]
    one = F.struct(F.struct(*order).alias("at"), "own", "upto", "cut", F.struct(*others).alias("row"))
    rows = requests.withColumns({"own": own, "cut": cut}).withColumn("upto", F.sum("own").over(so_far))
    listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("_all"))

    def step(acc: Column, r: Column) -> Column:
        before, i = r["upto"] - r["own"], acc["i"]
        begun = F.struct((i + 1).alias("i"), before.alias("base"), F.concat(acc["starts"], F.array(F.struct(i.alias("i"), before.alias("base")))).alias("starts"))
        goes_on = F.struct((i + 1).alias("i"), acc["base"].alias("base"), acc["starts"].alias("starts"))
        return F.when(acc["base"].isNull() | r["cut"] | (before - acc["base"] > limit), begun).otherwise(goes_on)

    none = F.lit(None).cast("bigint")
    zero = F.struct(F.lit(0).alias("i"), none.alias("base"), F.array().cast("array<struct<i:int,base:bigint>>").alias("starts"))
    found = listed.withColumn("_starts", F.aggregate("_all", zero, step)["starts"])

    def session(s: Column, number: Column) -> Column:
        end = F.coalesce(F.get("_starts", number + 1)["i"], F.size("_all"))
        return F.struct(number.cast("bigint").alias("generation"), s["base"].alias("base"), F.slice("_all", s["i"] + 1, end - s["i"]).alias("part"))

    cut_up = found.select(*keys, F.inline(F.transform("_starts", session)))
    laid = cut_up.select(*keys, "generation", "base", F.posexplode("part").alias("place", "r"))
    return laid.select(
        *[F.col(c) if c in keys else F.col("r.row")[c].alias(c) for c in requests.columns],
        "generation", (F.col("r.upto") - F.col("base")).alias("session_tokens"), (F.col("place") == 0).alias("starts"),
    )


def _stretched_starts(points: DataFrame, keys: list[str], width: int, cells: int, last: int) -> DataFrame:
    """Starts of keys of any size: solve stretches, chain their step functions, mark."""
    key_fields = [points.schema[k] for k in keys]

    def schema(*names):
        return T.StructType([*key_fields, *[T.StructField(n, T.LongType()) for n in names]])

    points = points.withColumn("stretch", F.floor(F.col("q") / (cells * width)).cast("bigint"))
    steps_of, entry_of = schema("stretch", "upto", "leaves"), schema("stretch", "entry")
    steps = points.groupBy(*keys, "stretch").applyInPandas(_step_function(cells, width, keys), steps_of)
    entries = _chained(steps, keys, last // (cells * width), steps_of, entry_of)
    return points.groupBy(*keys, "stretch").cogroup(entries.groupBy(*keys, "stretch")).applyInPandas(
        _starts(width, keys), schema("q")
    )


def _long_starts(
    requests: DataFrame, keys: list[str], order: list[str], own: Column, cut: Column, limit: int, block: Column | str, cells: int | None
) -> DataFrame:
    """Requests of keys of any size with `used_before` and `starts`: a new session begins here.

    A break adds a whole cell to q, so that no session reaches over it.
    """
    width = limit + 1
    # A stretch holds at most one point per token, which bounds its task's memory.
    cells = cells or max(1, STRETCH_POINTS // width)
    run = block_scan(
        requests.withColumn("_forced", cut), keys, order, block,
        sums={"_upto": own, "_breaks": F.col("_forced").cast("bigint")}, lags={"_earlier": F.lit(1)}, totals={"_tokens": own},
    )
    run = run.withColumns({
        "used_before": F.col("_upto") - own,
        "q": F.col("_upto") - own + F.col("_breaks") * width,
        "_forced": F.col("_forced") | F.col("_earlier").isNull(),
    })
    run = settled(run.drop("_upto", "_breaks", "_earlier"))
    # Without more tokens than the limit only breaks start sessions. Of requests with
    # equal q the first can start one.
    able = run.filter(F.col("_tokens") > limit)
    last = able.agg(F.max("q")).first()[0]
    if last is None:
        return run.select(*requests.columns, "used_before", F.col("_forced").alias("starts"))
    points = able.groupBy(*keys, "q").agg(F.min(F.struct(*order)).alias("_at"))
    starts = _stretched_starts(points.select(*keys, "q"), keys, width, cells, last)
    marked = starts.join(points, [*keys, "q"]).select(*keys, F.col("_at.*"), F.lit(True).alias("_marked"))
    joined = run.join(marked, [*keys, *order], "left")
    return joined.select(
        *requests.columns, "used_before", (F.col("_forced") | F.col("_marked").isNotNull()).alias("starts")
    )


def _long(
    requests: DataFrame, keys: list[str], order: list[str], own: Column, cut: Column, limit: int, block: Column | str, cells: int | None
) -> DataFrame:
    marked = settled(_long_starts(requests, keys, order, own, cut, limit, block, cells))
    run = block_scan(
        marked, keys, order, block,
        sums={"_number": F.col("starts").cast("bigint")}, lasts={"_base": F.when(F.col("starts"), F.col("used_before"))},
    )
    return run.select(
        *requests.columns, (F.col("_number") - 1).alias("generation"),
        (F.col("used_before") + own - F.col("_base")).cast("bigint").alias("session_tokens"), "starts",
    )


def session_rollover(
    requests: DataFrame,
    keys: list[str],
    order: list[str],
    tokens: str,
    block: Column | str = BY_ROWS,
    limit: int = fixed.SESSION_TOKEN_LIMIT,
    breaks: Column | None = None,
    gather: int = GATHER,
    cells: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add `generation` (0, 1, ... per key), `session_tokens` (up to and with the request)
    and `starts`: a new session begins at this request.

    The first request of a key starts one, as does any for which `breaks` holds; after
    that a request does if the tokens of its session before it exceed `limit`. Null
    tokens count as none. Keys with at most `gather` requests are folded whole; longer
    ones, if a count finds any, by stretches. `keys` are non-null, `order` is total within
    a key, and all columns can be sorted. `counted` is a table that is cheaper to count than `requests`
    and has the same number of rows for each key.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    own = F.coalesce(F.col(tokens), F.lit(0)).cast("bigint")
    cut = F.lit(False) if breaks is None else F.coalesce(breaks, F.lit(False))
    source = requests if counted is None else counted
    sizes = source.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > gather).select(*keys)
    if sizes.isEmpty():
        return _folded(requests, keys, order, own, cut, limit)
    requests, sizes = settled(requests), settled(sizes)
    short, long = (requests.join(sizes, keys, how) for how in ("left_anti", "left_semi"))
    found = _long(settled(long), keys, order, own, cut, limit, block, cells)
    return _folded(short, keys, order, own, cut, limit).unionByName(found)
