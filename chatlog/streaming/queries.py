"""Streaming operators: streaming DataFrame in, streaming DataFrame out.

Responses are keyed by `response_id`; their rows are numbered from 0, so rows may
arrive in any order. A response whose numbers have a gap waits for `patience`, then
goes on without the missing rows; a finished one is forgotten after the same time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chatlog import fixed
from chatlog.session import options, scratch, scratch_path, settled
from chatlog.streaming import levels
from chatlog.streaming.processors import STORE, SegmentProcessor
from chatlog.streaming.readers import COUNTS, CutReader, InOrder, LineReader

PATIENCE_MS = 60 * 60 * 1000
STATE = "state string"
# How Spark names the folder of rows without a day.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def _keyed(
    step: Callable[[dict, tuple, list[tuple], bool], list[tuple]], number: str, columns: list[str], out: list[str],
    patience: int, reads_on: bool,
):
    """A function for `applyInPandasWithState` from a step over numbered rows.

    A call costs far more than the rows of a response, so it takes all responses of a bucket. Each has its own entry in
    the state and its own time. With `reads_on` a response that is done still takes rows, until it is forgotten.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        data = json.loads(state.get[0]) if state.exists else {"ids": [], "states": []}
        kept, now = dict(zip(data["ids"], data["states"])), state.getCurrentProcessingTimeMs()
        rows: dict[str | None, list[tuple]] = {}
        for pdf in batches:
            for response, *row in zip(*(pdf[c].tolist() for c in ("_id", number, *columns))):
                rows.setdefault(response, []).append(tuple(row))
        expired = [r for r, entry in kept.items() if r not in rows and entry["seen"] + patience < now]
        found = []
        for response in [*rows, *expired]:
            entry, late = kept.get(response, {}), response not in rows
            if late and entry.get("done"):
                del kept[response]
                continue
            if reads_on or not entry.get("done"):
                found += step(entry, (response,), rows.get(response, []), late)
            kept[response] = {**({"done": True} if entry.get("done") and not reads_on else entry), "seen": now}
        if not kept:
            state.remove()
        else:
            state.update((json.dumps({"ids": [*kept], "states": [*kept.values()]}),))
            state.setTimeoutDuration(max(1, min(entry["seen"] for entry in kept.values()) + patience - now))
        if found:
            yield pd.DataFrame(found, columns=out, dtype=object)

    return run


#: Buckets of responses: each is a call and a state, so few for the calls and many for what a row makes rewrite.
BUCKETS = 1 << 13


def _apply(stream: DataFrame, step, number: str, columns: list[str], schema: str, patience: int, reads_on: bool = False) -> DataFrame:
    """`schema` lists what follows the response id, whose type is that of the input."""
    kind, schema = stream.schema["response_id"].dataType, f"response_id string, {schema}"
    binary = isinstance(kind, T.BinaryType)
    rows = stream.select(
        F.pmod(F.xxhash64("response_id"), F.lit(BUCKETS)).alias("_bucket"),
        (F.base64("response_id") if binary else F.col("response_id").cast("string")).alias("_id"), number, *columns)
    names = [c.split()[0] for c in schema.split(", ")]
    found = rows.groupBy("_bucket").applyInPandasWithState(
        _keyed(step, number, columns, names, patience, reads_on), schema, STATE, "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    return found.withColumn("response_id", F.unbase64("response_id") if binary else F.col("response_id").cast(kind))


def stream_chunks(lines: DataFrame, patience: int = PATIENCE_MS) -> DataFrame:
    """Event lines to chunks (response_id, seq, type, content, token counts of usage chunks).

    As in batch, a response is read on after its finish chunk; how the lines are cut into
    micro-batches makes no difference.
    """

    def step(state, key, rows, late):
        order, reader, out = InOrder(state), LineReader(state), []
        order.add([(int(n), line) for n, line in rows])
        for number, line in order.ready(late):
            chunk = reader.read(line or "")
            if chunk:
                counts = reader.usage or dict.fromkeys(COUNTS)
                out.append((key[0], number, *chunk, *counts.values()))
                state["done"] = state.get("done") or chunk[0] == "finish"
        return out

    schema = "seq bigint, type string, content string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return _apply(lines, step, "line_no", ["line"], schema, patience, reads_on=True)


SEGMENTS = "seq bigint, kind string, text string"


def stream_segments(
    lines: DataFrame,
    mode: str = "separate",
    holdback: int = fixed.MARKER_HOLDBACK,
    patience: int = PATIENCE_MS,
) -> DataFrame:
    """Event lines to segments (response_id, seq, kind, text) of reasoning, answer and tool buffer.

    Texts of one kind, joined by seq, are what the batch operators give. Pieces of the tool buffer
    and of tagged reasoning are appended to list state, so a chunk costs the same however long its
    response is. Needs the RocksDB state store, which `write_stream` sets for a query.
    """
    if mode not in ("passthrough", "strip", "separate"):
        raise ValueError(f"unknown mode {mode!r}")
    kind = lines.schema["response_id"].dataType.simpleString()
    return lines.groupBy("response_id").transformWithStateInPandas(
        SegmentProcessor(holdback, mode, patience), f"response_id {kind}, {SEGMENTS}", "append", "ProcessingTime")


def stream_early_cut(chunks: DataFrame, patience: int = PATIENCE_MS) -> DataFrame:
    """Chunks to the early-cut report of each response, at its finish chunk."""

    def step(state, key, rows, late):
        order, reader, out = InOrder(state), CutReader(state), []
        order.add([(int(n), kind, content) for n, kind, content in rows])
        for number, kind, content in order.ready(late):
            report = reader.read(number, kind, content)
            if report:
                out.append((key[0], *report.values()))
        return out

    schema = "cut_seq bigint, kept_chars bigint, lost_chars bigint, usage_lost boolean"
    return _apply(chunks, step, "seq", ["type", "content"], schema, patience)


def stream_sessions(
    requests: DataFrame,
    limit: int = fixed.SESSION_TOKEN_LIMIT,
    ttl_days: int = fixed.SESSION_TTL_DAYS,
) -> DataFrame:
    """Requests as they finish, with `reused`, `generation` and `session_tokens`.

    Requests carry account_id, client_session_id, request_id and prompt_tokens, and the
    hashes `history_hash` and `list_hash`; one that does not continue the stored list, or
    comes after the token limit, starts a new generation. Requests of a key arrive in
    the order of request_id. The history of a key unused for `ttl_days` is forgotten, its
    generation is not, so generations stay distinct. The ids may be of any type.
    """
    keys = ("account_id", "client_session_id", "request_id")
    kinds = [f"{c} {requests.schema[c].dataType.simpleString()}" for c in keys]
    schema = ", ".join([*kinds, "reused boolean", "generation bigint", "session_tokens bigint"])

    def run(key, batches, state: GroupState):
        if state.hasTimedOut:
            kept = json.loads(state.get[0])
            state.update((json.dumps({**kept, "tokens": 0, "stored": None}),))
            return
        kept = json.loads(state.get[0]) if state.exists else None
        frames = [pdf for pdf in batches]
        pdf = pd.concat(frames).sort_values("request_id")
        out = []
        for row in pdf.itertuples(index=False):
            used = None if pd.isna(row.prompt_tokens) else int(row.prompt_tokens)
            reused = kept is not None and kept["stored"] is not None and kept["tokens"] <= limit and kept["stored"] == row.history_hash
            if not reused:
                kept = {"generation": kept["generation"] + 1 if kept else 0, "tokens": 0, "stored": row.history_hash}
            if used is not None:
                kept["tokens"] += used
                kept["stored"] = row.list_hash
            out.append((*key, row.request_id, reused, kept["generation"], kept["tokens"]))
        state.update((json.dumps(kept),))
        state.setTimeoutDuration(ttl_days * 24 * 3600 * 1000)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return requests.groupBy("account_id", "client_session_id").applyInPandasWithState(
        run, schema, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def _continues(kept: dict | None, request: list, limit: int, mode: str) -> bool:
    """Whether a request goes on with the session kept, as `sessions.session_history` has it."""
    _, _, _, n_messages, _, history_hash, prefixes = request
    if not kept or kept["stored"] is None or kept["tokens"] > limit:
        return False
    if mode == "strict":
        return kept["stored"] == history_hash
    n = kept["n"]
    return n == 0 or (n < n_messages and prefixes[n - 1] == kept["stored"])


def stream_session_history(
    requests: DataFrame,
    mode: str = "append",
    limit: int = fixed.SESSION_TOKEN_LIMIT,
    ttl_days: int = fixed.SESSION_TTL_DAYS,
    late: str = "1 hour",
) -> DataFrame:
    """The stream twin of `sessions.session_history`: requests with `reused`, `generation`, `session_tokens`.

    `requests` is what `sessions.with_prefixes` gives: account_id, client_session_id, request_id,
    prompt_tokens, created_at, n_messages, list_hash, history_hash and prefix_hashes. Event time
    decides, not arrival: a request is held until the watermark, `late` behind the newest created_at, has
    passed it, and the requests of a key are then read in the order of (created_at, request_id). So neither
    the cuts between micro-batches nor the order of rows within `late` change a result; rows that come
    later still are dropped, and counted by Spark. A session unused for `ttl_days` is not
    gone on with: its history and tokens are forgotten, its generation is kept for the next one. A row
    without request_id only moves the event time, so one with a late time ends a finite stream.
    """
    if mode not in ("strict", "append"):
        raise ValueError(f"mode must be 'strict' or 'append', not {mode!r}")
    keys = ("account_id", "client_session_id", "request_id")
    kinds = [f"{c} {requests.schema[c].dataType.simpleString()}" for c in keys]
    schema = ", ".join([*kinds, "reused boolean", "generation bigint", "session_tokens bigint"])
    columns = ["_at", "request_id", "prompt_tokens", "n_messages", "list_hash", "history_hash", "prefix_hashes"]
    ttl = ttl_days * 24 * 3600 * 1000
    names = [c.split()[0] for c in schema.split(", ")]

    def run(key, batches, state: GroupState):
        data = json.loads(state.get[0]) if state.exists else {"held": [], "kept": None}
        for pdf in batches:
            for at, request, tokens, n, *hashes, prefixes in zip(*(pdf[c].tolist() for c in columns)):
                if not pd.isna(request):
                    data["held"].append([int(at), request, None if pd.isna(tokens) else int(tokens), int(n), *hashes, list(prefixes)])
        passed, kept, out = state.getCurrentWatermarkMs(), data["kept"], []
        data["held"].sort(key=lambda r: (r[0], r[1]))
        while data["held"] and data["held"][0][0] <= passed:
            row = data["held"].pop(0)
            at, request, tokens, n, list_hash, history_hash, _ = row
            if kept and at - kept["at"] > ttl:
                kept["stored"], kept["tokens"] = None, 0
            reused = _continues(kept, row, limit, mode)
            if not reused:
                kept = {"generation": kept["generation"] + 1 if kept else 0, "tokens": 0}
            kept["tokens"] += tokens or 0
            kept["stored"], kept["n"] = (history_hash, n - 1) if tokens is None else (list_hash, n)
            kept["at"] = at
            out.append((*key, request, reused, kept["generation"], kept["tokens"]))
        if kept and not data["held"] and kept["stored"] is not None and passed > kept["at"] + ttl:
            kept["stored"], kept["tokens"] = None, 0
        data["kept"] = kept
        state.update((json.dumps(data),))
        if data["held"]:
            state.setTimeoutTimestamp(max(data["held"][0][0], passed + 1))
        elif kept and kept["stored"] is not None:
            state.setTimeoutTimestamp(max(kept["at"] + ttl, passed + 1))
        if out:
            yield pd.DataFrame(out, columns=names)

    timed = requests.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", late)
    timed = timed.withColumn("_at", F.unix_millis("created_at"))
    return timed.groupBy("account_id", "client_session_id").applyInPandasWithState(
        run, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def live_usage(logs: DataFrame) -> DataFrame:
    """Running token sums and request counts per account."""
    return logs.filter(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.sum("prompt_tokens").alias("total_prompt_tokens"),
        F.sum("completion_tokens").alias("total_completion_tokens"),
        F.count("id").alias("total_requests"),
    )


def live_usage_trend(logs: DataFrame, bucket: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Requests and tokens per tumbling window and endpoint; later rows are dropped, `write_usage_trend` keeps them."""
    timed = logs.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", late)
    return timed.groupBy(F.window("created_at", bucket).alias("w"), "endpoint").agg(
        F.count("*").alias("requests"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
    ).select(F.col("w.start").alias("bucket"), "endpoint", "requests", "prompt_tokens", "completion_tokens")


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, interval: str | None = None
) -> StreamingQuery:
    """Start an exactly-once append to Parquet; without `interval` it stops when all input is read."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with options(stream.sparkSession, STORE):
        return writer.trigger(**trigger).start()


def _days_there(spark: SparkSession, path: str, schema: T.StructType, days: list) -> DataFrame | None:
    """The rows of these days in the log, None if there are none; only folders of these days are listed."""
    names = [NULL_DAY if d is None else d.isoformat() for d in days]
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/day={{{','.join(names)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_logs(logs: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """The log sink: every id once, partitioned by day, however late a row comes.

    Copies have equal times, so a micro-batch is compared with the days it touches only: the ids there that
    it has too are looked up, which shuffles nothing while the ids of a micro-batch can be broadcast, and taken out.
    Rows without an id are all kept. Each row says in `written_by` which run and micro-batch wrote it, so of a
    micro-batch that is repeated, as after a lost driver, only the rows that are missing are written, with or
    without id. Nothing is left in the shared folder.
    """
    spark = logs.sparkSession
    dated = logs.withColumn("written_by", F.lit("")).withColumn("day", F.to_date("created_at"))
    spark.createDataFrame([], dated.schema).write.mode("ignore").partitionBy("day").parquet(path)

    def save(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession) as session:
            run = session.read.schema("id string").json(f"{checkpoint}/metadata").first()[0]
            mark = f"{run}:{number}"
            new = settled(batch.withColumn("written_by", F.lit(mark)))
            named, nameless = new.filter(F.col("id").isNotNull()).dropDuplicates(["id"]), new.filter(F.col("id").isNull())
            days = [r.day for r in new.select("day").distinct().collect()]
            there = _days_there(session, path, dated.schema, days) if days else None
            if there is not None:
                known = settled(there.join(named.select("id"), "id", "left_semi").select("id"))
                named = named.join(known, "id", "left_anti")
                repeated = there.filter((F.col("written_by") == mark) & F.col("id").isNull())
                nameless = nameless.exceptAll(repeated.select(*nameless.columns))
            rows = named.unionByName(nameless).hint("rebalance", F.col("day"))
            rows.write.mode("append").partitionBy("day").parquet(path)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return dated.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save).trigger(**trigger).start()


def append_session_changes(changes: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep a stream of session changes; `tables.upsert_sessions` over them gives the sessions.

    Changes are ordered by their own `seq`, so it does not matter in which micro-batch one
    arrives, and no micro-batch rewrites the table.
    """
    return write_stream(changes, path, checkpoint, interval=interval)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    columns = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("row"))
    return newest.select(*[F.col(c) if c in keys else F.col("row")[c].alias(c) for c in rows.columns])


def write_updates(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], interval: str | None = None
) -> StreamingQuery:
    """Keep the changed rows of an aggregate over `keys`, merged in levels (`streaming.levels`).

    `path` belongs to `checkpoint`: a repeated micro-batch writes its own folder again.
    """
    spark = stream.sparkSession
    levels.begin(spark, path, T.StructType([*stream.schema, T.StructField("batch", T.LongType())]))

    def save(batch: DataFrame, number: int) -> None:
        levels.add(batch.withColumn("batch", F.lit(number).cast("bigint")), path, number, lambda rows: _newest(rows, keys))

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(save).trigger(**trigger).start()
    )


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row of each key from what `write_updates` wrote."""
    return _newest(levels.read(spark, path), keys).drop("batch")


TREND = ["requests", "prompt_tokens", "completion_tokens", "late_requests"]


def _trend_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket", "endpoint").agg(*[F.sum(c).alias(c) for c in TREND], F.max("seen").alias("seen"))


def write_usage_trend(
    logs: DataFrame, path: str, checkpoint: str, bucket: str = "1 hour", late: str = "1 hour", interval: str | None = None
) -> StreamingQuery:
    """The usage trend with all rows, however late, and how many of them were late.

    Each micro-batch adds its sums per bucket and endpoint, merged in levels, so there is no state and nothing
    to drop. A row is late if its bucket had ended `late` before the newest time of earlier micro-batches, when a
    trend with that watermark would have closed it; it is counted and corrects the trend. Rows without
    `created_at` belong to no bucket.
    """
    spark = logs.sparkSession
    kinds = "bucket timestamp, endpoint string, " + ", ".join(f"{c} bigint" for c in TREND) + ", seen timestamp"
    levels.begin(spark, path, T.StructType.fromDDL(kinds))

    def save(batch: DataFrame, number: int) -> None:
        newest = levels.read(batch.sparkSession, path, before=number).agg(
            F.unix_micros(F.max("seen") - F.expr(f"INTERVAL {late}"))).first()[0]
        window = F.window(F.col("created_at").cast("timestamp"), bucket)
        behind = F.lit(False) if newest is None else F.col("w.end") <= F.timestamp_micros(F.lit(newest))
        sums = batch.withColumn("w", window).groupBy("w", "endpoint").agg(
            F.count("*").alias("requests"),
            *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in ("prompt_tokens", "completion_tokens")],
            F.max(F.col("created_at").cast("timestamp")).alias("seen"),
        )
        counted = F.when(behind, F.col("requests")).otherwise(0).cast("bigint").alias("late_requests")
        levels.add(sums.select(F.col("w.start").alias("bucket"), "endpoint", *TREND[:-1], counted, "seen"), path, number, _trend_sums)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return logs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save).trigger(**trigger).start()


def read_usage_trend(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, endpoint, requests, prompt_tokens, completion_tokens, late_requests) so far."""
    return _trend_sums(levels.read(spark, path)).drop("seen")


def held_rows(spark: SparkSession, checkpoint: str) -> int:
    """Rows or responses of a keyed stream run that are still held back, behind a gap in the numbers."""
    operators = [r[0] for r in spark.read.format("state-metadata").load(checkpoint).select("operatorName").distinct().collect()]
    if any(o.startswith("transformWithState") for o in operators):
        return spark.read.format("statestore").option("stateVarName", "held").load(checkpoint).count()
    kept = spark.read.format("statestore").load(checkpoint)
    state = F.get_json_object(F.to_json("value"), "$.groupState.state")
    buckets = kept.select(F.from_json(state, "states array<struct<held: map<string, string>>>").alias("s"))
    return buckets.select(F.explode("s.states.held").alias("held")).filter(F.size("held") > 0).count()


def drain(stream: DataFrame, label: str, gaps: bool = False, event_time: bool = False) -> DataFrame:
    """Run a streaming DataFrame over all its input and read back what it appended.

    Micro-batches without data only serve timers; without them the run ends with its input.
    So rows behind a gap in the numbers of their response are still held at the end; unless
    `gaps` allows that, it is an error. Timers of `event_time` end by themselves and do run.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    with options(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": str(event_time).lower()}):
        write_stream(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    if not gaps and not event_time and (held := held_rows(spark, f"{path}/checkpoint")):
        raise ValueError(f"{held} rows or responses are held back behind a gap in their numbers")
    return spark.read.schema(stream.schema).parquet(f"{path}/out")
