"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key or map key: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the operators expect."""
    for key, value in OPTIONS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def options(spark: SparkSession, values: dict[str, str]):
    """Set SQL options for the length of a block, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` where it is set.

    Only a local session without that setting gets a folder of its own; on a cluster it would
    be another folder on every machine, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="chatlog-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_dir(spark)}/chatlog-{label}-{uuid.uuid4().hex}"


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Delete the intermediate tables made inside the block when it ends.

    Write or collect a query's result inside the block. The tables are managed tables of a
    database of their own in the shared folder, which is dropped with them.
    """
    name = f"chatlog_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'scratch')}'")
    token = _SCRATCH.set(name)
    try:
        yield spark
    finally:
        _SCRATCH.reset(token)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def settled(df: DataFrame) -> DataFrame:
    """`df` computed once, written to the shared folder and read back.

    For tables that several branches of an operator read: without it each level of a
    multi-pass operator would compute the level below it twice. Lineage ends here, lost
    executors cost no earlier step, and later passes read only the columns they need.
    """
    if name := _SCRATCH.get():
        table = f"{name}.t_{uuid.uuid4().hex}"
        df.write.format("parquet").saveAsTable(table)
        return df.sparkSession.table(table)
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
