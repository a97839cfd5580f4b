"""Consecutive numbers for all rows of a table in a given order, without one task that holds them all."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from chatlog.session import settled

#: Copies of one row are numbered in blocks of this many.
COPY_BLOCK = 65_536


def number_rows(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """`rows` with `_at`, their place from 0 in `order`, and the number of rows.

    `rows` should be narrow and hold no column `_n`, `_part`, `_before`, `_block` or `_at`. Rows equal
    in every column are counted first and numbered one after the other, so a row repeated any
    number of times costs one row in the sort. Of rows equal in `order` but not in all columns any
    may come first. The sorted runs are partitions by range; the driver adds up one number per partition.
    """
    spark = rows.sparkSession
    grouped = settled(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = grouped.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("_before", T.LongType())])
    at, names = ranged.columns.index("_n"), schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = 0
        for batch in batches:
            ends = passed + np.cumsum(batch.column(at).to_numpy(zero_copy_only=False))
            if len(ends):
                before = np.concatenate(([passed], ends[:-1]))
                passed = int(ends[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], names=names)

    local = settled(ranged.mapInArrow(run, schema))
    sizes = sorted(tuple(r) for r in local.groupBy("_part").agg(F.sum("_n"), F.max("_n")).collect())  # one row a partition
    starts = [0, *accumulate(n for _, n, _ in sizes)]
    offsets = spark.createDataFrame([(p, s) for (p, _, _), s in zip(sizes, starts)], "_part int, _start bigint")
    placed = local.join(F.broadcast(offsets), "_part")
    placed = placed.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPY_BLOCK).cast("int"))))
    if max((m for _, _, m in sizes), default=0) > COPY_BLOCK:
        placed = placed.repartition("_before", "_part", "_block")
    first = F.col("_block").cast("bigint") * COPY_BLOCK
    inside = F.sequence(first, F.least(first + COPY_BLOCK, F.col("_n")) - 1)
    placed = placed.withColumn("_at", F.explode(inside)).withColumn("_at", F.col("_at") + F.col("_before") + F.col("_start"))
    return placed.select(*rows.columns, "_at"), starts[-1]
