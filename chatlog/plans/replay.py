"""Batch tables as streams, for the streaming queries and their tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chatlog.session import scratch_path, settled


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream, be it one Parquet file or a directory of them."""
    path = f"{sf_dir}/{name}.parquet"
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if not table.inputFiles()[0].endswith(f"/{name}.parquet"):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def replayed(df: DataFrame, order: str, slices: int, closing: DataFrame | None = None) -> DataFrame:
    """`df` written to the shared folder in `slices` steps along `order`, read as a stream.

    The files of one step come before those of the next; a step is a micro-batch or more.
    The rows of `closing` come last.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "replay")
    df = settled(df)  # each step reads its part of it
    bounds = df.approxQuantile(order, [i / slices for i in range(1, slices)], 0.05) if slices > 1 else []
    edges = [None, *sorted(set(bounds)), None]
    for low, high in zip(edges, edges[1:]):
        part = df if low is None else df.filter(F.col(order) >= low)
        part = part if high is None else part.filter(F.col(order) < high)
        part.write.mode("append").parquet(path)
    if closing is not None:
        closing.select(df.columns).write.mode("append").parquet(path)
    files = max(1, spark.sparkContext.defaultParallelism)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def closing_row(df: DataFrame, time: str = "created_at") -> DataFrame:
    """One row of nulls but for a time a century ahead: it moves the event time past all others."""
    ahead = F.expr(f"max({time}) + INTERVAL 100 YEARS")
    return df.agg(ahead.alias(time)).select(*[
        (F.col(time) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
