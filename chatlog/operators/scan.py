"""Ordered computations per key that do not put a large key into one task.

A plain window over a key sorts all its rows in one task, so a key holding a third
of a table would hold up the job. Here keys with many rows are found by a count, and
only their rows are cut into blocks that follow the order; the blocks are summarised
(a combinable aggregate), the summaries are scanned per key, and the rows are finished
block by block with the carried value. All other keys are one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chatlog.functions.text import as_col
from chatlog.session import settled

BLOCK = "_block"
# Keys with more rows than this are cut into blocks.
HOT_ROWS = 1_000_000


#: Cut large keys by numbers of rows, whatever their order columns hold.
BY_ROWS = "rows"
#: Rows of large keys per block, about.
BLOCK_ROWS = 250_000


def with_blocks(df: DataFrame, keys: list[str], block: Column | str = BY_ROWS, order: list[str] | None = None) -> DataFrame:
    """`df` with the column `_block` for rows of large keys, null for the others.

    Blocks never fall along `order`. By rows, the rows of large keys are dealt out by ranges of
    (key, order), which are drawn from a sample so that each holds about BLOCK_ROWS, and
    written once; without large keys nothing is joined or written. An expression of the order
    sets the blocks itself; then the large keys, fewer than n / HOT_ROWS, are broadcast.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > HOT_ROWS)
    if not isinstance(block, str):
        large = F.broadcast(sizes.select(*keys, F.lit(True).alias("_large")))
        value = F.when(F.col("_large"), F.coalesce(block, F.lit(0)))
        return df.join(large, keys, "left").withColumn(BLOCK, value).drop("_large")
    total = sizes.agg(F.sum("_rows")).first()[0]
    none = F.lit(None).cast("bigint").alias(BLOCK)
    if not total:
        return df.select("*", none)
    large = settled(sizes.select(*keys))
    hot = df.join(large, keys, "left_semi").repartitionByRange(-(-total // BLOCK_ROWS), *keys, *order)
    hot = settled(hot.withColumn(BLOCK, F.spark_partition_id().cast("bigint")))
    return df.join(large, keys, "left_anti").select("*", none).unionByName(hot)


def block_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block: Column | str | None = BY_ROWS,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    lasts_before: dict[str, Column] | None = None,
    lags: dict[str, Column] | None = None,
    leads: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ordered per-key columns to `df`.

    sums: inclusive running sum. lasts: last non-null value so far, the current row
    included; lasts_before: without it. lags / leads: value of the previous / next row.
    totals: sum over the whole key.

    `order` must be a total order within a key and `keys` non-null. `block` is as in
    `with_blocks`; None where `df` has been through it. The input is read for the count and
    for the rows, and again for the rows of large keys; `settled` cuts chains of scans.
    """
    groups = [dict(x or {}) for x in (sums, lasts, lasts_before, lags, leads, totals)]
    sums, lasts, lasts_before, lags, leads, totals = groups
    inputs = {f"_in_{name}": as_col(c) for group in groups for name, c in group.items()}
    columns = [c for c in df.columns if c != BLOCK]
    rows = (df if block is None else with_blocks(df, keys, block, order)).withColumns(inputs)
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    summary = {}
    for name in [*sums, *totals]:
        summary[f"_b_{name}"] = F.sum(f"_in_{name}")
    for name in [*lasts, *lasts_before]:
        value = F.col(f"_in_{name}")
        summary[f"_b_{name}"] = F.max_by(value, F.when(value.isNotNull(), at))
    for name in lags:
        summary[f"_b_{name}"] = F.max_by(F.struct(f"_in_{name}"), at)
    for name in leads:
        summary[f"_b_{name}"] = F.min_by(F.struct(f"_in_{name}"), at)
    blocks = rows.filter(F.col(BLOCK).isNotNull()).groupBy(*keys, BLOCK).agg(
        *[c.alias(n) for n, c in summary.items()]
    )

    over_blocks = Window.partitionBy(*keys).orderBy(BLOCK)
    earlier = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
    carry = {}
    for name in sums:
        carry[name] = F.sum(f"_b_{name}").over(earlier)
    for name in totals:
        carry[name] = F.sum(f"_b_{name}").over(Window.partitionBy(*keys))
    for name in [*lasts, *lasts_before]:
        carry[name] = F.last(f"_b_{name}", ignorenulls=True).over(earlier)
    for name in lags:
        carry[name] = F.lag(f"_b_{name}").over(over_blocks)[f"_in_{name}"]
    for name in leads:
        carry[name] = F.lead(f"_b_{name}").over(over_blocks)[f"_in_{name}"]
    carried = blocks.select(*keys, BLOCK, *[c.alias(f"_c_{n}") for n, c in carry.items()])

    # A null block, of a key in one block, meets no carry. A hash join leaves the rows
    # partitioned for the windows and sorts nothing; a partition holds few carries.
    joined = rows.join(carried.hint("shuffle_hash"), [*keys, BLOCK], "left")
    whole = Window.partitionBy(*keys, BLOCK)
    within = whole.orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {}
    for name in sums:
        out[name] = F.sum(f"_in_{name}").over(so_far) + F.coalesce(F.col(f"_c_{name}"), F.lit(0))
    for name in totals:
        out[name] = F.coalesce(F.col(f"_c_{name}"), F.sum(f"_in_{name}").over(whole))
    for name in lasts:
        out[name] = F.coalesce(F.last(f"_in_{name}", ignorenulls=True).over(so_far), F.col(f"_c_{name}"))
    for name in lasts_before:
        before = F.last(f"_in_{name}", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1))
        out[name] = F.coalesce(before, F.col(f"_c_{name}"))
    for name in lags:
        first = F.row_number().over(within) == 1
        out[name] = F.when(first, F.col(f"_c_{name}")).otherwise(F.lag(f"_in_{name}").over(within))
    for name in leads:
        final = F.lead(F.lit(1)).over(within).isNull()
        out[name] = F.when(final, F.col(f"_c_{name}")).otherwise(F.lead(f"_in_{name}").over(within))
    return joined.select(*columns, *[c.alias(n) for n, c in out.items()])


def blocks_of(order, size: int) -> Column:
    """Blocks of `size` consecutive values of a whole-number order column."""
    return F.floor(as_col(order) / F.lit(size)).cast("bigint")


def time_blocks(ts, minutes: int = 60) -> Column:
    """Blocks of a TIMESTAMP_NTZ column, numbered from the epoch."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MINUTE", epoch, as_col(ts)) / F.lit(minutes)).cast("bigint")


def ordered_concat(
    df: DataFrame,
    keys: list[str],
    order: str,
    texts: dict[str, str],
    sep: str = "",
    any_of: dict[str, Column] | None = None,
    head: int = 4096,
    firsts: dict[str, Column] | None = None,
    finals: dict[str, Column] | None = None,
) -> DataFrame:
    """Concatenate text columns of each key in the order of a whole-number column.

    `texts` maps output name to input column; nulls are skipped, and a key without
    text gets ''. Rows without an order come first. `any_of` adds flags that hold if
    they hold for any row of the key; `firsts` and `finals` add the least and the
    greatest non-null value of a column, a struct that begins with the order, say.
    Rows are joined block by block, `head` numbers each, and then the blocks, so no
    task sorts the rows of a long key. `df` may have its blocks already (`piece_blocks`).
    """
    any_of, firsts, finals = dict(any_of or {}), dict(firsts or {}), dict(finals or {})
    block = F.col(BLOCK) if BLOCK in df.columns else piece_blocks(order, head)
    extra = {**any_of, **firsts, **finals}
    df = df.select(*keys, block.alias(BLOCK), order, *dict.fromkeys(texts.values()), *[c.alias(n) for n, c in extra.items()])

    def joined(frame, by, order_col, columns):
        return frame.groupBy(*by).agg(
            *[
                F.expr(f"listagg(`{src}`, '{_literal(sep)}') within group (order by `{order_col}`)").alias(name)
                for name, src in columns.items()
            ],
            *[F.bool_or(n).alias(n) for n in any_of], *[F.min(n).alias(n) for n in firsts], *[F.max(n).alias(n) for n in finals],
        )

    parts = joined(df, [*keys, BLOCK], order, {f"_t_{n}": src for n, src in texts.items()})
    both = joined(parts, keys, BLOCK, {n: f"_t_{n}" for n in texts})
    return both.select(
        *keys, *[F.coalesce(n, F.lit("")).alias(n) for n in texts],
        *[F.coalesce(n, F.lit(False)).alias(n) for n in any_of], *firsts, *finals,
    )


def piece_blocks(order: str, head: int) -> Column:
    """The block of a row of `ordered_concat`."""
    return F.coalesce(blocks_of(order, head), F.lit(0).cast("bigint"))


def with_facts(rows: DataFrame, facts: DataFrame, keys: list[str], order: str, last: str, head: int) -> DataFrame:
    """`rows` with the `facts` of their key, one row per key, and their block.

    The facts are repeated for each block up to the one of `last`, the greatest order of
    the key, and joined by key and block, so the blocks of a long key stay apart. A key
    without rows keeps a row of nulls per block.
    """
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(blocks_of(last, head), F.lit(0).cast("bigint"))))
    return facts.withColumn(BLOCK, blocks).join(rows.withColumn(BLOCK, piece_blocks(order, head)), [*keys, BLOCK], "left")


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], width: int
) -> DataFrame:
    """Exact interpolated quantiles of a whole-number column per key.

    Rows shrink to counts per distinct value before anything is ordered, and the
    counts are ranked in blocks of `width` values, so few large groups do not end
    in few large tasks.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = block_scan(
        counts, keys, [value], blocks_of(value, width),
        sums={"_upto": F.col("_n")}, totals={"_total": F.col("_n")},
    )
    columns = []
    for name, q in quantiles.items():
        place = F.lit(q) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
            columns.append(F.max(F.when(here, F.col(value))).alias(f"_{side}_{name}"))
        columns.append(F.max(place - F.floor(place)).alias(f"_part_{name}"))
    found = ranked.groupBy(*keys).agg(*columns)
    return found.select(*keys, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n)
        for n in quantiles
    ])
