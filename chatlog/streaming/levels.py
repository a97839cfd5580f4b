"""Tables that a stream adds to in every micro-batch, read from few folders however long it runs.

Micro-batch n writes its rows to level 0. Of every FAN neighbours at a level one folder is made
at the next, so n micro-batches are covered by at most FAN - 1 folders a level and log(n) levels, and
each row is merged once a level. Folders that are covered by a higher level are used again, 2 * FAN
a level in turn; a reader that has begun has at least FAN micro-batches left to finish.
A path belongs to one checkpoint: it is the numbers of its micro-batches that make a repeated one harmless.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

FAN = 8
_FOLDER = re.compile(r"/level=(-?\d+)/slot=\d+/upto=(-?\d+)/")


def begin(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty file that tells the columns, also where no row ever comes."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(f"{path}/level=-1/slot=0/upto=-1")


def _covering(files: list[str], fan: int, before: int | None) -> list[str]:
    """The files of the greatest folders: those that no folder of a higher level covers."""
    folders = {f: tuple(map(int, _FOLDER.search(f).groups())) for f in files}
    there = {(level, upto) for level, upto in folders.values() if level >= 0 and (before is None or upto < before)}
    levels = sorted({level for level, _ in there})

    def covered(level: int, upto: int) -> bool:
        # The folder of a higher level that holds micro-batch `upto` ends at the next multiple of its size.
        return any((up, (upto // fan**up + 1) * fan**up - 1) in there for up in levels if up > level)

    return [f for f, at in folders.items() if at[0] < 0 or at in there and not covered(*at)]


def read(spark: SparkSession, path: str, fan: int = FAN, before: int | None = None) -> DataFrame:
    """All rows, not merged over folders; with `before` only of earlier micro-batches."""
    files = _covering(spark.read.parquet(path).inputFiles(), fan, before)
    return spark.read.option("basePath", path).parquet(*files).drop("level", "slot", "upto")


def add(rows: DataFrame, path: str, number: int, merge: Callable[[DataFrame], DataFrame], fan: int = FAN) -> None:
    """Write the rows of a micro-batch, and merge what is full. `merge` is associative and keeps the columns."""
    spark, columns = rows.sparkSession, rows.columns

    def write(df: DataFrame, level: int) -> None:
        slot = (number + 1) // fan**level % (2 * fan)
        df.withColumn("upto", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "upto").parquet(f"{path}/level={level}/slot={slot}")

    write(rows, 0)
    level = 1
    while (number + 1) % fan**level == 0:
        below = spark.read.parquet(path).filter(F.col("level") == level - 1)
        below = below.filter((F.col("upto") > number - fan**level) & (F.col("upto") <= number))
        write(merge(below.select(*columns)), level)
        level += 1
