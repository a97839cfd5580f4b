"""Table readers and writers: Parquet, partitioned by day where the table grows by time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from chatlog.operators.changes import apply_session_changes
from chatlog.session import options, settled
from chatlog.sources import schemas

TASK_BYTES = 16 << 20
FILE_BYTES = 4 << 20  # what opening a file counts for


def read_accounts(spark: SparkSession, path: str, schema: T.StructType = schemas.ACCOUNTS) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_sessions(
    spark: SparkSession, path: str, live: bool = True, schema: T.StructType = schemas.SESSIONS
) -> DataFrame:
    df = spark.read.schema(schema).parquet(path)
    return df.filter(~F.col("is_expired")) if live else df


def _day_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("day", T.DateType())])


def read_request_logs(
    spark: SparkSession, path: str, since=None, until=None, schema: T.StructType = schemas.REQUEST_LOGS
) -> DataFrame:
    """Logs with since <= created_at < until; only the days in range are listed and read."""
    df = spark.read.schema(_day_schema(schema)).parquet(path)
    if since is not None:
        at = F.lit(since).cast("timestamp_ntz")
        df = df.filter((F.col("day") >= at.cast("date")) & (F.col("created_at") >= at))
    if until is not None:
        at = F.lit(until).cast("timestamp_ntz")
        df = df.filter((F.col("day") <= at.cast("date")) & (F.col("created_at") < at))
    return df.drop("day")


def append_request_logs(df: DataFrame, path: str) -> None:
    """Append finished requests, partitioned by day.

    Rows are rebalanced by day: adaptive execution splits a busy day over tasks and
    puts quiet days together, so a day is neither one task nor many small files.
    """
    dated = df.withColumn("day", F.to_date("created_at")).hint("rebalance", F.col("day"))
    dated.write.mode("append").partitionBy("day").parquet(path)


def upsert_sessions(changes: DataFrame, base: DataFrame | None, path: str | None = None, key: str = "id") -> DataFrame:
    """Sessions after a change log; with `path`, written there as a new version.

    `path` must be a directory no reader uses yet: a version is never overwritten.
    """
    out = apply_session_changes(base, changes, key)
    if path is None:
        return out
    out.write.mode("errorifexists").parquet(path)
    return out.sparkSession.read.schema(out.schema).parquet(path)


def _with_ids(lines: DataFrame) -> DataFrame:
    """Lines whose ids were read; one that does not fit the schema's type would be null, and all such lines one response."""
    kind = lines.schema["response_id"].dataType.simpleString()
    wrong = F.raise_error(F.lit(f"an event line has no response_id of type {kind}: pass a schema with the right type"))
    return lines.withColumn("response_id", F.coalesce("response_id", wrong.cast(kind)))


def read_event_stream(spark: SparkSession, path: str, schema: T.StructType = schemas.EVENT_LINES) -> DataFrame:
    """Event lines kept as JSON records with their response and line number.

    `schema` gives the id's type, e.g. `schemas.EVENT_LINES_BY_TEXT`; a line without an id of it is an error.
    """
    return _with_ids(spark.read.schema(schema).json(path))


def stream_event_lines(
    spark: SparkSession, path: str, files_per_batch: int = 1000, schema: T.StructType = schemas.EVENT_LINES
) -> DataFrame:
    """The same as a stream of the files that arrive."""
    return _with_ids(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path))


def _numbered_in_runs(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """(run, number, end) of lines in the order they are read, from (file, start, length, size): those of its split and its own bytes.

    A run is what one task reads of a file without a gap, known by the start of its first split; `number`
    and `end`, the line's end in bytes, are counted from there.
    """
    file, split, after, run, passed, end = None, -1, -1, -1, 0, 0
    for files, starts, lengths, sizes in batches:
        if not len(files):
            yield pa.StructArray.from_arrays([pa.array([], pa.int64())] * 3, names=["run", "number", "end"])
            continue
        start, upto, total = np.asarray(starts), np.asarray(starts) + np.asarray(lengths), np.cumsum(np.asarray(sizes))
        same = np.append(files[0].as_py() == file, np.asarray(pc.equal(files[1:], files[:-1])))
        goes_on = same & ((start == np.append(split, start[:-1])) | (start == np.append(after, upto[:-1])))
        first, of = np.flatnonzero(~goes_on), np.cumsum(~goes_on)
        runs = np.append(run, start[first])[of]
        numbers = np.arange(len(start)) - np.append(-passed, first)[of]
        ends = total - np.append(-end, total[first] - np.asarray(sizes)[first])[of]
        yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (runs, numbers, ends)], names=["run", "number", "end"])
        file, split, after = files[-1].as_py(), start[-1], upto[-1]
        run, passed, end = runs[-1], numbers[-1] + 1, ends[-1]


def _lines_of_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, line, run, number, end) of all lines, many splits read by one task where they are short."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    size = int(str(text._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    tasks = max(spark.sparkContext.defaultParallelism, (size + len(text._jdf.inputFiles()) * FILE_BYTES) // TASK_BYTES)
    at = ("file_path", "file_block_start", "file_block_length", "file_size")
    text = text.select(*(F.col(f"_metadata.{x}").alias(x) for x in at), "value").coalesce(tasks)
    number = F.arrow_udf(_numbered_in_runs, "run bigint, number bigint, end bigint")
    place = number(*at[:3], F.octet_length("value").cast("bigint") + 1)
    text = text.select(F.col("file_path").alias("file"), F.col("file_size").alias("size"), F.col("value").alias("line"), place.alias("place"))
    return text.select("file", "size", "line", "place.*")


def read_raw_captures(spark: SparkSession, path: str, parts: bool = False, split: str | None = None) -> DataFrame:
    """(response_id, line_no, line) of raw captures, one file per response or, with `parts`, one folder.

    A large file is read by many tasks, in splits of `split` bytes or of the session's. Each task numbers the lines of the
    splits that it reads one after the other and writes them; the sums of the runs before it, one small row per run
    of the files that have several, make the line's number in the file.
    The response id is the path below `path` without its ending, so files of one name in
    several folders stay apart. An unfinished last line is not a line yet and is left out,
    but for compressed files, whose size does not tell.

    With `parts` the files of a folder are the parts of one response, which is too long for one file. They come in the
    order of their names, a shorter name first, and their lines are numbered on. The response id is the path of the folder.
    """
    with options(spark, {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1k"} if split else {}):
        local = settled(_lines_of_files(spark, path))
    runs = local.groupBy("file", "run").agg(
        (F.max("number") + 1).alias("lines"), F.max("end").alias("bytes"), F.max("size").alias("size"))
    before = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    lines_before = F.sum("lines").over(before)
    if parts:  # an unfinished line does not count for the parts that follow
        upto = F.sum("bytes").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        runs = runs.withColumn("kept", F.col("lines") - (upto == F.col("size") + 1).cast("int"))
        name = F.url_decode("file")
        folder = Window.partitionBy(F.regexp_replace("file", r"[^/]*\z", "")).orderBy(F.length(name), name, "run")
        lines_before = F.sum("kept").over(folder.rowsBetween(Window.unboundedPreceding, -1))
    offsets = settled(runs.select(
        "file", "run", lines_before.alias("lines_before"), F.sum("bytes").over(before).alias("bytes_before"),
    ).filter("lines_before IS NOT NULL"))
    rows = local.join(offsets, ["file", "run"], "left").filter(
        F.coalesce("bytes_before", F.lit(0)) + F.col("end") != F.col("size") + 1)
    root = "^.*?" + re.escape(re.sub(r"^\w+:/*", "", path.rstrip("/")).strip("/")) + "/"
    name = F.regexp_replace(F.url_decode("file"), root, "")
    return rows.select(
        F.regexp_replace(name, r"/[^/]*\z" if parts else r"\.[^.]*\z", "").alias("response_id"),
        (F.coalesce("lines_before", F.lit(0)) + F.col("number")).cast("bigint").alias("line_no"),
        "line",
    )


def evolve_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """`df` with the target's columns in its order; missing ones are null, others stay behind."""
    have = {f.name: f for f in df.schema.fields}
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ]
    extra = [F.col(name) for name in have if name not in target.fieldNames()]
    return df.select(*columns, *extra)
