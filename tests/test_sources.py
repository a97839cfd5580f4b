"""Readers, writers, request bodies, export, transcripts."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatlog.operators import accounts, events, outcomes, sessions, tooldefs, transcript, usage
from chatlog.plans import inputs, queries
from chatlog.session import options
from chatlog.sources import export, requests, schemas, tables


@pytest.fixture(scope="module")
def get(spark, sf_dir):
    return inputs.open_inputs(spark, sf_dir)


def test_log_days(spark, get, tmp_path):
    path = str(tmp_path / "logs")
    logs = get("request_logs")
    tables.append_request_logs(logs, path)
    some = tables.read_request_logs(spark, path, since="2024-01-10", until="2024-01-12 06:00:00")
    want = logs.filter("created_at >= timestamp_ntz'2024-01-10' and created_at < timestamp_ntz'2024-01-12 06:00:00'")
    assert some.count() == want.count() > 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert tables.read_request_logs(spark, path).count() == logs.count()


def test_appends_are_rebalanced(spark, get):
    hinted = get("request_logs").hint("rebalance", F.col("created_at"))
    assert "REBALANCE_PARTITIONS_BY_COL" in hinted._jdf.queryExecution().executedPlan().toString()


def test_session_versions(spark, get, tmp_path):
    first = tables.upsert_sessions(get("session_changes"), None, str(tmp_path / "v1"))
    more = spark.createDataFrame([(0, 10**9, "delete", None, None), (1, 10**9, "upsert", 5, 3)], "id long, seq long, op string, prompt_tokens long, last_msg_count long")
    second = tables.upsert_sessions(more, first, str(tmp_path / "v2"))
    before = {r.id: r.prompt_tokens for r in first.collect()}
    after = {r.id: r.prompt_tokens for r in second.collect()}
    assert 0 not in after and after[1] == before.get(1, 0) + 5


def test_evolve_schema(spark):
    old = spark.createDataFrame([(1, "a")], "id long, alias string")
    new = tables.evolve_schema(old, schemas.ACCOUNTS)
    assert new.columns == schemas.ACCOUNTS.fieldNames()
    assert new.first().banned_status is None and new.first().alias == "a"
    assert tables.evolve_schema(new, schemas.ACCOUNTS).schema == new.schema


def test_raw_captures(spark, tmp_path):
    (tmp_path / "r1.txt").write_text("event: message\ndata: {}\nunfinished")
    rows = tables.read_raw_captures(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("r1", 0, "event: message"), ("r1", 1, "data: {}")]


@pytest.mark.parametrize("split", [17, 64, 1000])
def test_large_captures_are_read_in_splits(spark, tmp_path, split):
    """Lines of several files, with \\r, empty lines and many bytes a character, numbered as in the whole file."""
    rng = random.Random(split)
    want = []
    for name, ended in (("a/r1.txt", True), ("b/r1.txt", False), ("c.x.txt", True), ("one.txt", False), ("empty.txt", True)):
        lines = ["".join(rng.choice(["é", "x", "日", "\r", " "]) for _ in range(rng.randrange(12))) for _ in range(0 if "empty" in name else 120)]
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes("".join(x + "\n" for x in lines).encode() + (b"" if ended else b"left out"))
        want += [(name[:-4], i, x) for i, x in enumerate(lines)]
    with options(spark, {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}):
        rows = tables.read_raw_captures(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 3
        assert sorted(map(tuple, rows.collect())) == sorted(want)


@pytest.mark.parametrize("split", [17, 64, 1000])
def test_captures_in_parts(spark, tmp_path, split):
    """Lines are numbered on over the files of a folder, in the order of their names, without unfinished ones."""
    rng = random.Random(split)
    want = []
    for folder in ("k=a", "k=b b", "c/d"):
        n = 0
        (tmp_path / folder).mkdir(parents=True)
        for part in (1, 2, 9, 10, 11):
            ended, lines = rng.random() < 0.6, ["".join(rng.choice("éx日 ") for _ in range(rng.randrange(12))) for _ in range(0 if part == 2 else 40)]
            (tmp_path / folder / f"p {part}.txt").write_bytes("".join(x + "\n" for x in lines).encode() + (b"" if ended else b"left out"))
            want += [(folder, n + i, x) for i, x in enumerate(lines)]
            n += len(lines)
    with options(spark, {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}):
        assert sorted(map(tuple, tables.read_raw_captures(spark, str(tmp_path), parts=True).collect())) == sorted(want)


def test_captures_numbered_is_written_by_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    """No task reads a capture whole: all lines of a kind of event, and of all, come in parts."""
    spark.createDataFrame([(i % 50, "all" if i % 2 else None, f"{i % 7} é\n{'x' * (i % 90)}") for i in range(400)],
                          "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = []
    for size in (1 << 30, 4000):
        monkeypatch.setattr(queries, "CAPTURE_PART", size)
        monkeypatch.setattr(queries, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-{size}")
        found.append(sorted(map(tuple, queries.QUERIES["captures_numbered"](spark, str(tmp_path)).collect())))
        assert (len(list((tmp_path / f"captures-{size}" / "source=all").glob("*.txt"))) > 1) == (size == 4000)
    assert found[0] == found[1]
    lines = [f"{i % 50:012d} {i % 7} é {'x' * (i % 90)}" for i in range(400)]
    want = {"all": sorted(lines + lines[1::2]), "__HIVE_DEFAULT_PARTITION__": sorted(lines[::2])}
    assert found[0] == sorted((k, n, x) for k, v in want.items() for n, x in enumerate(v))


def test_lines_are_numbered_in_runs():
    """Batches of any length, splits without a gap and with one, files that follow each other."""
    rng = random.Random(5)
    rows, want, run, number, end = [], [], None, 0, 0
    for file in ("a", "b", "c"):
        last = None
        for k in range(12):
            if rng.random() < 0.3:
                continue
            for i in range(rng.randrange(1, 6)):
                if i == 0 and last != k - 1:
                    run, number, end = 10 * k, 0, 0
                last, size = k, rng.randrange(1, 30)
                rows.append((file, 10 * k, 10, size))
                end += size
                want.append({"run": run, "number": number, "end": end})
                number += 1
    for length in (1, 2, 7, len(rows)):
        batches = [rows[i:i + length] for i in range(0, len(rows), length)]
        arrays = [tuple(map(pa.array, zip(*b))) for b in batches]
        arrays.insert(1, tuple(a.slice(0, 0) for a in arrays[0]))
        got = list(tables._numbered_in_runs(iter(arrays)))
        assert [len(x) for x in got] == [len(a[0]) for a in arrays]
        assert [x for a in got for x in a.to_pylist()] == want


def test_captures_numbered_reads_many_splits_in_a_task(spark, tmp_path):
    """Splits are many times the tasks; lines longer than a split leave some without a line."""
    docs = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.expr("repeat(char(97 + id % 7), IF(id % 500 = 3, 200000, 1500))").alias("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.sparkContext.setJobGroup("captures", "captures")
    try:
        got = queries.QUERIES["captures_numbered"](spark, str(tmp_path)).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = [f"{i:012d} {chr(97 + i % 7) * (200000 if i % 500 == 3 else 1500)}" for i in range(4000)]
    assert sorted(map(tuple, got)) == [(k, n, x) for k in ("all", "s") for n, x in enumerate(want)]
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("captures") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) < 2 * 4000 * 1500 / 65536 / 5


def test_ids_that_are_no_numbers(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = spark.createDataFrame([("r-1", 0, "event: x"), ("r-2", 0, "event: y")], schemas.EVENT_LINES_BY_TEXT)
    lines.write.json(path)
    got = tables.read_event_stream(spark, path, schemas.EVENT_LINES_BY_TEXT)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, lines.collect()))
    with pytest.raises(Exception, match="no response_id of type bigint"):
        tables.read_event_stream(spark, path).collect()


def test_event_lines_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = spark.createDataFrame([(1, 0, "event: x"), (1, 1, 'data: {"a": "é"}')], schemas.EVENT_LINES)
    lines.write.json(path)
    assert sorted(map(tuple, tables.read_event_stream(spark, path).collect())) == sorted(map(tuple, lines.collect()))


def messages(spark, body, dialect="anthropic"):
    df = spark.createDataFrame([(1, json.dumps(body) if not isinstance(body, str) else body)], "id long, body string")
    return [(r.role, r.text) for r in requests.flatten_blocks(df, "id", dialect).orderBy("turn").collect()]


def test_flatten_blocks(spark):
    assert messages(spark, {"system": "s", "messages": [
        {"role": "user", "content": "[1]"}, {"role": "assistant", "content": ""}, {"role": "user"},
        {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "image"},
                                          {"type": "tool_use", "name": "f", "input": {"z": 1, "a": "é"}}]},
        {"role": "user", "content": [{"type": "tool_result", "content": {"b": 1, "a": [2]}},
                                     {"type": "tool_result", "content": "[x]"},
                                     {"type": "tool_result", "content": [{"type": "text", "text": "p"}, {"type": "text", "text": "q"}]}]},
    ]}) == [
        ("system", "s"), ("user", "[1]"),
        ("assistant", 'a\n<tool_call>\n{"name":"f","arguments":{"z":1,"a":"é"}}\n</tool_call>'),
        ("user", '[工具结果]\n{"b":1,"a":[2]}\n[工具结果]\n[x]\n[工具结果]\npq'),
    ]
    assert messages(spark, {"system": ["no"], "messages": []}) == []
    assert messages(spark, {"messages": [{"role": "user", "content": ""}]}, "openai") == [("user", "")]
    assert messages(spark, "{broken") == []


def test_request_defaults(spark):
    bodies = [
        (0, "{}"), (1, '{"temperature":0,"top_p":0.1,"reasoning_effort":"low","web_search":"auto","stream":true,"model":"m","tools":[{},{}]}'),
        (2, '{"temperature":null,"reasoning_effort":"","messages":[{"role":"system","content":"s"}]}'), (3, "{bad"),
    ]
    df = spark.createDataFrame(bodies, "id long, body string")
    rows = {r.id: r for r in requests.parse_chat_requests(df, "openai").collect()}
    assert (rows[0].temperature, rows[0].top_p, rows[0].thinking, rows[0].web_search, rows[0].is_stream, rows[0].n_tools) == (
        0.8, 0.95, False, "disabled", False, 0)
    assert (rows[1].temperature, rows[1].top_p, rows[1].thinking, rows[1].web_search, rows[1].is_stream, rows[1].n_tools) == (
        0.0, 0.1, True, "auto", True, 2)
    assert (rows[2].temperature, rows[2].thinking, rows[2].system_prompt) == (0.8, False, "s")
    assert rows[3].corrupt and not rows[0].corrupt


def test_export(spark):
    rows = [
        (1, "<think>w</think>hi", 3, 4), (2, 'a<tool_call>{"name":"f","arguments":{"b":1,"a":2}}</tool_call>', None, None),
    ]
    df = spark.createDataFrame(rows, "response_id long, text string, prompt_tokens long, completion_tokens long").withColumns({
        "model": F.lit("m"), "total_tokens": F.col("prompt_tokens"), "reasoning_tokens": F.lit(0)
    })
    first = {r.response_id: json.loads(r.record) for r in export.export_chat_jsonl(df, "openai", "strip").collect()}
    choice = first[1]["choices"][0]
    assert choice["message"] == {"role": "assistant", "content": "hi"} and choice["finish_reason"] == "stop"
    assert first[1]["usage"] == {
        "prompt_tokens": 3, "completion_tokens": 4, "total_tokens": 3, "completion_tokens_details": {"reasoning_tokens": 0}}
    choice = first[2]["choices"][0]
    assert choice["message"]["content"] is None and choice["finish_reason"] == "tool_calls" and "usage" not in first[2]
    assert json.loads(choice["message"]["tool_calls"][0]["function"]["arguments"]) == {"a": 2, "b": 1}
    second = {r.response_id: json.loads(r.record) for r in export.export_chat_jsonl(df, "anthropic", "separate").collect()}
    assert second[1]["content"] == [{"type": "thinking", "thinking": "w"}, {"type": "text", "text": "hi"}]
    assert second[1]["stop_sequence"] is None and second[1]["stop_reason"] == "end_turn"
    assert [b["type"] for b in second[2]["content"]] == ["text", "tool_use"]
    assert second[2]["content"][1]["input"] == {"a": 2, "b": 1}
    assert second[2]["usage"] == {"input_tokens": 0, "output_tokens": 0} and second[2]["stop_reason"] == "tool_use"


def test_write_records(spark, tmp_path):
    path = str(tmp_path / "records")
    records = spark.createDataFrame([(1, '{"id":"1"}'), (2, '{"id":"2"}')], "response_id long, record string")
    export.write_chat_jsonl(records, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ['{"id":"1"}', '{"id":"2"}']


def conversation(spark, *messages):
    rows = [(1, i, *m) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_transcript(spark):
    conv = conversation(spark, ("system", "S"), ("user", "a"), ("assistant", "b"), ("user", "c"))
    full = "[系统指令]\nS\n\n[对话历史]\nassistant: b\n\n[当前问题]\nc"
    assert transcript.render_transcript(conv, n=2).first().prompt == full
    sys = "[系统指令]\nS"
    rest = full[len(sys) + 2:]
    cut = transcript.render_transcript(conv, n=2, max_chars=len(sys) + 2 + 9).first().prompt
    assert cut == sys + "\n\n" + rest[-9:]
    assert transcript.render_transcript(conv, n=2, max_chars=5).first().prompt == full
    assert transcript.render_incremental(conv).first().prompt == "[系统指令]\nS\n\n[当前问题]\nc"
    alone = conversation(spark, ("system", "S"))
    assert transcript.render_transcript(alone).first().prompt == "[系统指令]\nS\n\n"
    assert transcript.render_incremental(conversation(spark, ("user", "u"))).first().prompt == "u"
    with pytest.raises(ValueError):
        transcript.last_n_messages(conv, 0)


def test_catalog(spark):
    conv = conversation(spark, ("user", "a"), ("system", "S"))
    got = {r.turn: (r.role, r.text) for r in transcript.inject_tool_catalog(conv, "C").collect()}
    assert got == {0: ("user", "a"), 1: ("system", "S\n\nC")}
    got = {r.turn: (r.role, r.text) for r in transcript.inject_tool_catalog(conversation(spark, ("user", "a")), "C").collect()}
    assert got == {-1: ("system", "C"), 0: ("user", "a")}
    defs = spark.createDataFrame([(1, 2, '{"name":"b"}'), (1, 1, '{"name":"a"}')], "req long, def_id long, def string")
    assert tooldefs.render_tool_catalog(defs, ["req"]).first().catalog.endswith("[Tools]\n- a(): \n- b(): ")


def test_account_patches(spark, get):
    base = spark.createDataFrame([(1, "a", True, None), (2, "b", True, None)], "id long, alias string, is_active boolean, banned_status string")
    logs = spark.createDataFrame(
        [(1, 1, "error", 451, "x", "2024-01-01 00:00:01"), (2, 2, "error", None, "got 401", "2024-01-01 00:00:01"),
         (3, 9, "error", 401, "x", "2024-01-01 00:00:01")],
        "id long, account_id long, status string, http_status int, error string, t string",
    ).withColumn("created_at", F.col("t").cast("timestamp_ntz"))
    patch = spark.sql("""SELECT 1L AS id, struct(timestamp_ntz'2024-01-02' AS at, 0L AS tie) AS seq, 'update' AS op,
                         true AS is_active, CAST(NULL AS STRING) AS banned_status, array('is_active') AS fields""")
    classified = outcomes.classify_outcomes(logs)
    state = {r.id: (r.is_active, r.banned_status) for r in outcomes.account_state(base, classified, patches=patch).collect()}
    assert state == {1: (True, "TEMPORARY"), 2: (False, None)}
    spans = outcomes.account_state_history(classified, patch).filter("id = 1").orderBy("valid_from").collect()
    assert [(r.is_active, r.banned_status, r.valid_to is None) for r in spans] == [
        (False, "TEMPORARY", False), (True, "TEMPORARY", True)]


def test_pages(spark, get):
    logs = get("request_logs")
    order = [r.id for r in logs.orderBy(F.desc("created_at"), "id").collect()]
    for page, limit in ((1, 50), (4, 70), (15, 70), (16, 70)):
        start = (page - 1) * limit
        for top in (0, 10**9):
            got = [r.id for r in usage.page_logs(logs, page, limit, top_k_rows=top).collect()]
            assert got == order[start:start + limit]
    assert [r.id for r in usage.page_logs(logs, -3, 0).collect()] == order[:1]
    last = logs.filter(F.col("id") == order[49]).first()
    assert [r.id for r in usage.page_after(logs, last.created_at, last.id).collect()] == order[50:100]


def test_continuity_modes(spark):
    conv = conversation(spark, ("user", "a"), ("user", "b"), ("assistant", "c"), ("user", "d"))
    reqs = spark.sql("""SELECT 1L AS account_id, 1L AS client_session_id, turn + 10 AS request_id, 1L AS conv_id, turn,
                        1L AS prompt_tokens, timestamp_ntz'2024-01-01' AS created_at FROM VALUES (0L), (1L), (3L) t(turn)""")
    for mode, want in (("strict", [False, True, False]), ("append", [False, True, True])):
        got = sessions.session_continuity(reqs, conv, mode).orderBy("request_id").collect()
        assert [r.matches for r in got] == want


def test_tool_results(spark):
    rows = [(1, 0, "tool", "f", "c1", "ok"), (1, 1, "user", None, None, "no"), (1, 2, "tool", None, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, name string, tool_call_id string, content string")
    assert requests.render_tool_results(df).first().tool_results == "[工具结果] f (c1):\nok\n\n[工具结果]  ():\nx"


def test_usage_objects(spark):
    text = '{"promptTokens":3,"totalTokens":null,"nativeUsage":{"completion_tokens_details":{"reasoning_tokens":2}}}'
    df = spark.createDataFrame([(1, text), (2, "{bad")], "id long, usage_json string")
    got = {r.id: (r.prompt_tokens, r.completion_tokens, r.total_tokens, r.reasoning_tokens) for r in events.normalize_usage(df).collect()}
    assert got == {1: (3, 0, 0, 2), 2: (0, 0, 0, 0)}


def test_masks(spark):
    df = spark.createDataFrame([("", "0123456789abcdefghijklmn", 1), ("al", None, 2)], "alias string, key_hash string, id long")
    got = [tuple(r) for r in accounts.masked_view(df).select("label", "alias", "key_hash").collect()]
    assert got == [("0123456789ab", "-", "0123456789abcdefghij"), ("al", "al", "-")]
