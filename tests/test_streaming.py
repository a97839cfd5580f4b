"""State machines and streaming operators against their batch forms."""

import json
import os
import random
import shutil

import pandas as pd
import pytest

from pyspark.sql import functions as F

from chatlog.operators import events
from chatlog.plans import inputs, replay
from chatlog.sources import tables
from chatlog.streaming import levels, queries as streams
from chatlog.session import options, shared_dir
from chatlog.streaming.readers import CutReader, InOrder, LineReader, MarkerReader, SegmentReader

TEXTS = [
    "plain answer", "", "<think>why</think>  answer", "<think>open end", "x<think>a</think>b<think>c</think>d<think>e",
    'go <tool_call>{"name":"f"}</tool_call> and more text that is long',
    "<think>p</think>go <function_calls><invoke name=\"a\"></invoke></function_calls> tail " + "z" * 40,
    "</think>a<think>b", "a \0<think>b</think>", "<tool_call>never closed", "text that ends in <tool_ca",
    "<think>p</think><tool_call>x</tool_call>", "</th<think>ink>odd",
]


def chunked(text, cuts):
    edges = [0, *sorted(cuts), len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:])]


def responses(n=120, seed=4):
    """Chunks of texts cut at random, some without usage or finish."""
    rng, rows = random.Random(seed), []
    for r in range(n):
        text = TEXTS[r % len(TEXTS)]
        parts = chunked(text, [rng.randrange(len(text) + 1) for _ in range(rng.randrange(6))])
        kinds = [("text", p) for p in parts]
        if rng.random() < 0.7:
            kinds.append(("usage", None))
        if rng.random() < 0.8:
            kinds.append(("finish", None))
        rows += [(r, i, kind, content) for i, (kind, content) in enumerate(kinds)]
    return rows


def read_segments(rows, mode="separate"):
    out, states = {}, {}
    for r, _, kind, content in rows:
        for k, t in SegmentReader(states.setdefault(r, {}), mode=mode).read(kind, content):
            out[r, k] = out.get((r, k), "") + t
    return out, {r for r, s in states.items() if s.get("done")}


def test_segments_equal_batch(spark):
    rows = responses()
    chunks = spark.createDataFrame(rows, "response_id long, seq long, type string, content string")
    found, done = read_segments(rows)
    tagged, stripped = read_segments(rows, "passthrough")[0], read_segments(rows, "strip")[0]
    front = {}
    for r in events.segment_reasoning(chunks, "passthrough").collect():
        assert r.reasoning == found.get((r.response_id, "reasoning"), "")
        front[r.response_id] = r.content[: len(r.content) - len(r.answer)]
    assert any(front.values())
    for r in events.segment_tool_buffer(chunks).collect():
        assert r.emitted == found.get((r.response_id, "answer"), "") == stripped.get((r.response_id, "answer"), "")
        assert front[r.response_id] + r.emitted == tagged.get((r.response_id, "answer"), "")
        if r.response_id in done:
            assert r.tool_buffer == found.get((r.response_id, "tool_buffer"), "")


def test_early_cut_equals_batch(spark):
    rows = responses(seed=5)
    ended = {r[0] for r in rows if r[2] == "finish"}
    rows = [r for r in rows if r[0] in ended]
    chunks = spark.createDataFrame(rows, "response_id long, seq long, type string, content string")
    want, states = {}, {}
    for r, seq, kind, content in rows:
        report = CutReader(states.setdefault(r, {})).read(seq, kind, content)
        if report:
            want[r] = tuple(report.values())
    got = {r[0]: tuple(r)[1:] for r in events.early_cut(chunks).collect()}
    assert got == want and want


def test_passthrough(spark):
    rows = [(1, 0, "text", "<think>a"), (1, 1, "text", "b</think> c"), (1, 2, "finish", None),
            (2, 0, "text", "<think>a"), (2, 1, "finish", None), (3, 0, "text", "<think>a")]
    chunks = spark.createDataFrame(rows, "response_id long, seq long, type string, content string")
    got = {r.response_id: r.content for r in events.segment_reasoning(chunks, "passthrough").collect()}
    assert got == {1: "<think>ab</think>c", 2: "<think>a</think>", 3: ""}


def test_assemble(spark):
    rows = [
        (1, 0, "text", "a", None), (1, 1, "usage", None, 5), (1, 2, "text", "b", None), (1, 3, "usage", None, 7),
        (2, 0, "text", "a", None), (2, 1, "error", "e", None), (2, 2, "text", "b", None), (2, 3, "usage", None, 1),
        (3, 0, "usage", None, 2),
    ]
    chunks = spark.createDataFrame(rows, "response_id long, seq long, type string, content string, prompt_tokens long")
    stop = {r[0]: tuple(r)[1:] for r in events.assemble_responses(chunks, "stop").collect()}
    assert stop == {1: ("ab", 7, False, None), 2: ("a", None, False, "e"), 3: ("", 2, False, None)}
    on = {r[0]: tuple(r)[1:3] for r in events.assemble_responses(chunks, "ignore").collect()}
    assert on[2] == ("ab", 1)


LINES = [
    "event: message", 'data: {"content":"a"}', "", 'data: {"content":"b"}', "data: {broken", "data: null",
    "event: other", 'data: {"content":"no"}', "  event:usage ", 'data:{"promptTokens":3,"nativeUsage":{"completion_tokens_details":{"reasoning_tokens":2}}}',
    "event: dialogId", 'data: {"content":"d1"}', "event: message", "data: {}", 'data: {"content":"x"} trailing', "event: finish", "data: {}",
]
CHUNKS = [("text", "a"), ("text", "b"), ("usage", None), ("dialogId", "d1"), ("text", ""), ("finish", None)]


def test_lines(spark):
    state = {}
    assert [c for c in (LineReader(state).read(line) for line in LINES) if c] == CHUNKS
    lines = spark.createDataFrame([(1, i, line) for i, line in enumerate(LINES)], "response_id long, line_no long, line string")
    got = events.parse_event_stream(lines).orderBy("seq").collect()
    assert [(r.type, r.content) for r in got] == CHUNKS
    usage = got[2]
    assert (usage.prompt_tokens, usage.completion_tokens, usage.reasoning_tokens) == (3, 0, 2)


def test_in_order():
    state, seen = {}, []
    for rows in ([(2, "c")], [(0, "a")], [(0, "again")], [(1, "b")], [(5, "f")]):
        order = InOrder(state)
        order.add(rows)
        seen += list(order.ready())
    assert seen == [(0, "a"), (1, "b"), (2, "c")]
    order = InOrder(state)
    order.add([])
    assert list(order.ready(all_held=True)) == [(5, "f")]


def test_stream_out_of_order(spark):
    """Rows of a response that come in any order over several micro-batches."""
    rows = [r for r in responses(26, seed=6)]
    ended = {r[0] for r in rows if r[2] == "finish"}
    rows = [r for r in rows if r[0] in ended]
    want, _ = read_segments(rows)
    chunks = spark.createDataFrame(rows, "response_id long, seq long, type string, content string")
    usage = chunks.withColumns({"prompt_tokens": F.lit(1), "completion_tokens": F.lit(1)})
    lines = inputs.event_lines(usage).withColumn("mixed", F.pmod(F.xxhash64("response_id", "line_no"), F.lit(1000)))
    stream = replay.replayed(lines, "mixed", slices=3).drop("mixed")
    found = streams.drain(streams.stream_segments(stream), "test")
    got = found.groupBy("response_id", "kind").agg(F.expr("listagg(text, '') within group (order by seq)").alias("text"))
    assert {(r.response_id, r.kind): r.text for r in got.collect()} == want


def test_line_files_as_stream(spark, tmp_path):
    rows = [(r, i, line) for r in (1, 2) for i, line in enumerate(LINES)]
    lines = spark.createDataFrame(rows, "response_id long, line_no long, line string")
    lines.write.json(str(tmp_path / "lines"))
    stream = tables.stream_event_lines(spark, str(tmp_path / "lines"))
    got = streams.drain(streams.stream_chunks(stream), "test").filter("response_id = 2").orderBy("seq").collect()
    assert [(r.type, r.content) for r in got] == CHUNKS


@pytest.mark.parametrize("times", (1, 2))
def test_rows_behind_the_end_in_later_micro_batches(spark, tmp_path, times):
    """Segments end at the finish chunk, chunks go on; rows may follow in any later micro-batch."""
    data = ["event: message", 'data: {"content":"so"}', "event: finish", "data: {}"]
    after = ["data: {broken", "event: message", 'data: {"content":"after"}']
    steps = [[(r, i, line) for r in range(5) for i, line in enumerate(data)]]
    steps += [[(r, len(data) + i, line) for r in range(5) for i, line in enumerate(after)]] * times
    for rows in steps:
        spark.createDataFrame(rows, "response_id long, line_no long, line string").coalesce(1).write.mode("append").json(f"{tmp_path}/lines")
    stream = tables.stream_event_lines(spark, f"{tmp_path}/lines", files_per_batch=1)
    got = streams.drain(streams.stream_segments(stream), "after-segments").collect()
    assert sorted((r.response_id, r.kind, r.text) for r in got) == [(r, "answer", "so") for r in range(5)]
    got = streams.drain(streams.stream_chunks(stream), "after-chunks").collect()
    assert sorted((r.response_id, r.seq, r.type, r.content) for r in got) == sorted(
        (r, *x) for r in range(5) for x in ((1, "text", "so"), (3, "finish", None), (6, "text", "after")))


def test_log_sink_drops_copies(spark, sf_dir, tmp_path):
    logs = inputs.open_inputs(spark, sf_dir)("request_logs")
    stream = replay.replayed(logs.unionByName(logs), "id", slices=2)
    streams.append_logs(stream, str(tmp_path / "logs"), str(tmp_path / "checkpoint")).awaitTermination()
    written = spark.read.parquet(str(tmp_path / "logs"))
    assert written.count() == logs.count() == written.select("id").distinct().count()
    assert "day" in written.columns


def test_log_sink_keeps_late_rows(spark, tmp_path):
    """Rows seven hours behind are kept, copies in other micro-batches are not."""
    for n, hour in enumerate((12, 11, 5)):
        rows = [(n * 10 + i, f"2024-03-01 {hour:02d}:00:{i:02d}") for i in range(10)] + ([(3, "2024-03-01 12:00:03")] if n else [])
        df = spark.createDataFrame(rows, "id long, at string").select("id", F.col("at").cast("timestamp_ntz").alias("created_at"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, created_at timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.append_logs(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(30))


def test_log_sink_repeats_a_batch(spark, tmp_path):
    """A micro-batch run again adds nothing, rows without id included, and mends what it had left out."""
    schema = "id long, note string, created_at timestamp_ntz"
    rows = [(1, "a"), (None, "x"), (None, "x"), (None, "y"), (2, "b")]
    days = ["2024-03-01 10:00:00", "2024-03-02 10:00:00", None]
    for n in range(2):
        df = spark.createDataFrame([(i, note, at) for i, note in rows for at in days[n:]], "id long, note string, at string")
        df = df.select(F.when(F.col("id").isNotNull(), F.col("id") + n * 10).alias("id"), "note", F.col("at").cast("timestamp_ntz").alias("created_at"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def run(out, checkpoint):
        streams.append_logs(stream, str(tmp_path / out), str(tmp_path / checkpoint)).awaitTermination()
        return sorted(map(str, spark.read.parquet(str(tmp_path / out)).select("id", "note", "created_at", "day").collect()))

    left = set(os.listdir(shared_dir(spark)))
    want = run("out", "checkpoint")
    assert sum("id=None" in r for r in want) == 15 and len(want) == 19  # ids once, whatever their day
    shutil.copytree(tmp_path / "checkpoint", tmp_path / "again", ignore=lambda folder, names: [n for n in names if folder.endswith("commits") and "1" in n])
    assert run("out", "again") == want
    written = spark.read.parquet(str(tmp_path / "out")).filter("written_by LIKE '%:1'").select("_metadata.file_name").distinct()
    lost = written.first()[0]
    shutil.copytree(tmp_path / "out", tmp_path / "torn", ignore=lambda folder, names: [n for n in names if lost in n])
    assert spark.read.parquet(str(tmp_path / "torn")).count() < len(want)
    shutil.copytree(tmp_path / "again", tmp_path / "third", ignore=lambda folder, names: [n for n in names if folder.endswith("commits") and "1" in n])
    assert run("torn", "third") == want
    assert set(os.listdir(shared_dir(spark))) == left


def test_levels_hold_few_folders(spark, tmp_path):
    """Twenty micro-batches, some empty, at a fan of two: sums and counts right after each, few folders, one repeated."""
    path, want, most = str(tmp_path / "t"), {}, 0
    schema = "k long, n long, seen long"

    def merge(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"), F.max("seen").alias("seen"))

    def add(number):
        rows = [] if number in (3, 4, 5) else [(number % 3, 2 ** number, number)]
        levels.add(spark.createDataFrame(rows, schema).coalesce(1), path, number, merge, fan=2)
        return rows

    levels.begin(spark, path, spark.createDataFrame([], schema).schema)
    for number in range(20):
        for k, n, _ in add(number):
            want[k] = want.get(k, 0) + n
        if number in (7, 12):
            add(number)
        got = levels.read(spark, path, fan=2)
        files = got.inputFiles()
        most = max(most, len({f.rsplit("/", 1)[0] for f in files}))
        assert {r.k: r.n for r in merge(got).collect()} == want
        earlier = merge(levels.read(spark, path, fan=2, before=number)).agg(F.sum("n"), F.max("seen")).first()
        assert earlier[0] == (sum(2 ** i for i in range(number) if i not in (3, 4, 5)) or None)
    assert most <= 6  # one for each of five levels, and the empty one
    assert len({file.parent for file in (tmp_path / "t").rglob("*.parquet")}) <= 5 * 4 + 1  # four slots a level


def test_late_rows_correct_the_trend(spark, tmp_path):
    rows = [(0, "2024-03-01 12:30:00", 5), (0, "2024-03-01 12:10:00", None), (1, "2024-03-01 11:30:00", 1), (1, "2024-03-01 10:59:59", 2),
            (2, "2024-03-01 10:00:00", 4), (2, "2024-03-01 12:59:00", 8), (2, None, 16)]
    for n in range(3):
        df = spark.createDataFrame([(at, v) for i, at, v in rows if i == n], "at string, v long").coalesce(1)
        df.select(F.col("at").cast("timestamp_ntz").alias("created_at"), F.lit("/c").alias("endpoint"), F.col("v").alias("prompt_tokens"),
                  F.col("v").alias("completion_tokens")).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.write_usage_trend(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = {r.bucket.hour: tuple(r)[2:] for r in streams.read_usage_trend(spark, str(tmp_path / "out")).collect()}
    # 12:30 less an hour is 11:30: the hour from 10 had closed, the hour from 11 had not.
    assert got == {12: (3, 13, 13, 0), 11: (1, 1, 1, 0), 10: (2, 6, 6, 2)}


def test_gap_at_the_end_is_an_error(spark):
    lines = spark.createDataFrame([("a", 0, "event: message"), ("a", 2, 'data: {"content":"x"}'), ("b", 0, "event: finish"), ("b", 1, "data: {}")],
                                  "response_id string, line_no long, line string")
    with pytest.raises(ValueError, match="held back behind a gap"):
        streams.drain(streams.stream_chunks(replay.replayed(lines, "line_no", slices=1)), "gap")
    found = streams.drain(streams.stream_chunks(replay.replayed(lines, "line_no", slices=1)), "gap", gaps=True)
    assert [(r.response_id, r.type) for r in found.collect()] == [("b", "finish")]


def test_chunks_do_not_depend_on_cuts(spark):
    """Usage behind the finish chunk, in one micro-batch and cut before and behind the finish; text ids."""
    lines = ["event: message", 'data: {"content":["a",{"b":"é"}]}', "event: finish", "data: {}", "event: usage", 'data: {"promptTokens":3}']
    df = spark.createDataFrame([("r", i, line) for i, line in enumerate(lines)], "response_id string, line_no long, line string")
    want = sorted((r.seq, r.type, r.content, r.prompt_tokens, r.reasoning_tokens) for r in events.parse_event_stream(df).collect())
    for slices in (1, 3, 6):
        found = streams.drain(streams.stream_chunks(replay.replayed(df, "line_no", slices=slices)), "cuts").collect()
        assert sorted((r.seq, r.type, r.content, r.prompt_tokens, r.reasoning_tokens) for r in found) == want
    assert want[-1][3:] == (3, 0) and want[0][2] == '["a",{"b":"é"}]'


class OneState:
    """What `_keyed` needs of a group state, at a time set by the test."""

    def __init__(self):
        self.value, self.now, self.timeout = None, 0, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        assert ms > 0
        self.timeout = self.now + ms


def test_responses_of_a_bucket_have_their_own_time():
    """Each response is read on or forgotten by its own patience, whatever comes for its neighbours."""
    def step(entry, key, rows, late):
        order = InOrder(entry)
        order.add(rows)
        out = [(key[0], n, x) for n, x in order.ready(late)]
        entry["done"] = entry.get("done") or any(x == "end" for _, _, x in out)
        return out

    run, state = streams._keyed(step, "n", ["x"], ["id", "n", "x"], 100, False), OneState()

    def at(now, *rows):
        state.now = now
        frame = [pd.DataFrame(rows, columns=["_id", "n", "x"], dtype=object)] if rows else []
        return [tuple(r) for f in run((0,), iter(frame), state) for r in f.itertuples(index=False)]

    assert at(0, ("a", 0, "p"), ("b", 1, "gap"), (None, 0, "end")) == [("a", 0, "p"), (None, 0, "end")]
    assert state.timeout == 100
    assert at(60, ("a", 1, "q"), (None, 1, "after the end")) == [("a", 1, "q")] and state.timeout == 100
    assert at(101) == [("b", 1, "gap")] and state.timeout == 160
    assert at(161) == [] and json.loads(state.value[0])["ids"] == ["a", "b"]  # the one that is done is forgotten
    assert at(200, ("b", 2, "end")) == [("b", 2, "end")] and at(400) == [] and json.loads(state.value[0])["ids"] == ["a"]


def test_many_responses_are_few_calls(spark, tmp_path, monkeypatch):
    """A call and a state per bucket, not per response; ids of any type, null ones too."""
    monkeypatch.setattr(streams, "BUCKETS", 4)
    data = ["event: message", 'data: {"content":"so"}', "event: usage", 'data: {"promptTokens":9007199254740993}', "event: finish", "data: {}"]
    rows = [(r or None, i, line) for r in range(60) for i, line in enumerate(data)]
    for kind in ("long", "string", "decimal(20,3)", "date", "binary"):
        ids = F.expr("date'2024-01-01' + cast(r as int)") if kind == "date" else F.col("r").cast("string").cast(kind) if kind == "binary" else F.col("r").cast(kind)
        lines = spark.createDataFrame(rows, "r long, line_no long, line string").withColumn("response_id", ids).drop("r")
        stream, folder = replay.replayed(lines, "line_no", slices=2), f"{tmp_path}/{kind}"
        with options(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
            streams.write_stream(streams.stream_chunks(stream), f"{folder}/out", f"{folder}/state").awaitTermination()
        assert spark.read.format("statestore").load(f"{folder}/state").count() <= 4 and streams.held_rows(spark, f"{folder}/state") == 0
        columns = ["response_id", "seq", "type", "content", "prompt_tokens"]
        got = spark.read.parquet(f"{folder}/out").select(*columns)
        want = events.parse_event_stream(lines).select(*columns)
        assert got.schema["response_id"].dataType == lines.schema["response_id"].dataType
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


# --- sessions by event time ------------------------------------------------------


def session_requests(spark, seed=3):
    """Requests whose lists go on, stop going on, lack usage, pass the limit or come after a long pause."""
    rng, rows = random.Random(seed), []
    for key in range(12):
        history, at = [], 0
        for i in range(rng.randrange(1, 14)):
            at += rng.choice([60, 3600, 8 * 86400 if key % 3 == 0 else 600])
            grown = history + [f"{key}:{rng.random()}" for _ in range(rng.randrange(1, 4))]
            if rng.random() < 0.2:
                grown = grown[1:] or grown
            digests = ["#".join(grown[:n]) for n in range(len(grown) + 1)]
            tokens = None if rng.random() < 0.2 else rng.randrange(60)
            rows.append((key % 4, key, 100 * key + i, tokens, 1_700_000_000 + at, len(grown), digests[-1], digests[-2], digests[1:-1]))
            history = grown
    schema = ("account_id long, client_session_id long, request_id long, prompt_tokens long, created long, n_messages long, "
              "list_hash string, history_hash string, prefix_hashes array<string>")
    return spark.createDataFrame(rows, schema).withColumn("created_at", F.timestamp_seconds("created")).drop("created"), rows


def folded_sessions(rows, mode, limit, ttl):
    out, kept = {}, {}
    for account, key, request, tokens, at, n, whole, before, prefixes in sorted(rows, key=lambda r: (r[1], r[2])):
        k = kept.get(key)
        if k and at - k["at"] > ttl:
            k["stored"], k["tokens"] = None, 0
        goes_on = bool(k) and k["stored"] is not None and k["tokens"] <= limit and (
            k["stored"] == before if mode == "strict" else [*prefixes, whole][:n - 1][k["n"] - 1:k["n"]] == [k["stored"]] or k["n"] == 0)
        if not goes_on:
            k = kept[key] = {"generation": k["generation"] + 1 if k else 0, "tokens": 0}
        k["tokens"] += tokens or 0
        k["stored"], k["n"], k["at"] = (before, n - 1, at) if tokens is None else (whole, n, at)
        out[request] = (goes_on, k["generation"], k["tokens"])
    return out


@pytest.mark.parametrize("mode, slices, seed", [("append", 1, 1), ("append", 4, 2), ("strict", 3, 3)])
def test_sessions_by_event_time_whatever_the_arrival(spark, mode, slices, seed):
    df, rows = session_requests(spark, seed)
    mixed = df.withColumn("_step", F.pmod(F.hash("request_id", F.lit(seed)), F.lit(slices)).cast("int"))
    stream = replay.replayed(mixed, "_step", slices, replay.closing_row(mixed)).drop("_step")
    run = streams.stream_session_history(stream, mode, limit=100, ttl_days=7, late="30000 days")
    got = streams.drain(run, "sessions-test", event_time=True).collect()
    assert len(got) == len(rows)
    want = folded_sessions(rows, mode, 100, 7 * 86400)
    assert {r.request_id: (r.reused, r.generation, r.session_tokens) for r in got} == want
    assert {True, False} == {v[0] for v in want.values()} and max(v[1] for v in want.values()) > 2


def test_sessions_in_order_need_no_lateness(spark):
    df, rows = session_requests(spark, 5)
    ordered = df.withColumn("_age", F.unix_timestamp("created_at"))
    stream = replay.replayed(ordered, "_age", 3, replay.closing_row(ordered)).drop("_age")
    got = streams.drain(streams.stream_session_history(stream, limit=100, late="0 seconds"), "sessions-order", event_time=True).collect()
    assert {r.request_id: (r.reused, r.generation, r.session_tokens) for r in got} == folded_sessions(rows, "append", 100, 7 * 86400)


# --- state of long responses -----------------------------------------------------


def test_state_of_a_long_response_grows_by_its_chunks_only(spark, tmp_path):
    n = 50_000
    texts = ["<think>why</think>", "so <tool_call>", *[f"piece {i} " for i in range(n)], "</tool_", "call> rest"]
    lines = ["event:message", *["data:" + json.dumps({"content": t}) for t in texts]]
    rows = spark.createDataFrame([(7, i, line) for i, line in enumerate(lines)], "response_id long, line_no long, line string")
    stream = replay.replayed(rows, "line_no", slices=5)
    with options(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
        streams.write_stream(streams.stream_segments(stream), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()

    def kept(name):
        reader = spark.read.format("statestore").option("stateVarName", name).option("flattenCollectionTypes", "true")
        return reader.load(f"{tmp_path}/state")

    head = kept("head").selectExpr("value.state").collect()
    assert len(head) == 1 and len(head[0][0]) < 500  # not rewritten with the response
    assert kept("buffer").count() == len(texts) - 1 and kept("held").count() == 0
    assert spark.read.parquet(f"{tmp_path}/out").groupBy("kind").count().count() == 2  # the buffer comes at the finish


def test_buffer_is_given_at_the_finish_whatever_the_cuts(spark):
    rng, rows, want = random.Random(8), [], {}
    for r in range(6):
        body = "<function_calls>" + "x" * rng.randrange(2000) + "</function_calls> tail"
        parts = chunked("hello " + body, [rng.randrange(len(body)) for _ in range(40)])
        events_ = [("message", json.dumps({"content": p})) for p in parts] + [("finish", "{}")]
        lines = [x for name, data in events_ for x in (f"event: {name}", f"data: {data}")]
        rows += [(f"r-{r}", i, line) for i, line in enumerate(lines)]
        want[f"r-{r}", "answer"], want[f"r-{r}", "tool_buffer"] = "hello ", body
    rng.shuffle(rows)
    df = spark.createDataFrame([(i % 4, *r) for i, r in enumerate(rows)], "step int, response_id string, line_no long, line string")
    stream = replay.replayed(df, "step", slices=4).drop("step")
    got = streams.drain(streams.stream_segments(stream, holdback=64), "segments-test").orderBy("seq").collect()
    found = {}
    for r in got:
        found[r.response_id, r.kind] = found.get((r.response_id, r.kind), "") + r.text
    assert found == want


@pytest.mark.parametrize("cut", range(1, 30))
def test_closing_tag_is_found_at_every_cut(cut):
    text = "<tool_call>" + "a</tool_cal" + "</tool_call>"
    state = {}
    reader = MarkerReader(state, 0)
    for part in (text[:max(cut, 11)], text[max(cut, 11):]):
        reader.read(part, True)
    assert reader.closed and reader.pieces.take("buffer") == text
