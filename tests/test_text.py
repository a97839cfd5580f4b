"""Hand-worked cases for the column functions."""

import json
import random
import re

import pytest

from chatlog.functions import jsonvalue, reasoning, text, toolcalls
from chatlog.operators import outcomes, redact, responses, tooldefs


def one(spark, value, column):
    """The value of a column over a single text."""
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).first().x


def test_trim_takes_unicode_space(spark):
    assert one(spark, "　 \n a b﻿\t", text.trim("t")) == "a b"
    assert one(spark, " a ", text.trim_start("t")) == "a "


@pytest.mark.parametrize("value, expected", [
    ("5", 5), ("true", True), ("[1]", [1]), ("x y", "x y"), ("01", "01"), ("", ""), ("null", None),
    ("5 6", "5 6"), ('{"a":1} x', '{"a":1} x'), ("1,2", "1,2"), ("5]", "5]"), ("5] x [6", "5] x [6"),
    (' {"b":1,"a":[1.5,"é"]} ', {"a": [1.5, "é"], "b": 1}), ("NaN", "NaN"), ('{"a":1,"a":2}', {"a": 2}),
    ('say "hi"', 'say "hi"'),
])
def test_decode_argument(spark, value, expected):
    assert json.loads(one(spark, value, jsonvalue.decode_argument("t"))) == expected


@pytest.mark.parametrize("value, why, answer", [
    ("abc", "", "abc"),
    ("p<think>x</think>  y", "x", "y"),
    ("<think>open", "", "<think>open"),
    ("<think></think>", "", ""),
])
def test_split_reasoning(spark, value, why, answer):
    got = one(spark, value, reasoning.split_reasoning("t"))
    assert (got.reasoning, got.answer) == (why, answer)


def test_split_with_close_in_front(spark):
    got = one(spark, "</think>a<think>b", reasoning.split_reasoning("t"))
    assert (got.reasoning, got.answer) == ("", "a<think>b")


@pytest.mark.parametrize("unclosed, expected", [("cut", "ac"), ("keep", "ac<think>d")])
def test_strip_reasoning(spark, unclosed, expected):
    assert one(spark, "a<think>b</think>c<think>d", reasoning.strip_reasoning("t", unclosed)) == expected


def test_strip_drops_nuls(spark):
    assert one(spark, "\0<think>x</think>\0\n y\0", reasoning.strip_reasoning("t")) == "y"


def test_marker_split_keeps_the_text(spark):
    for value in ("no marker", "a<tool_call>b", "a<function_calls>b<tool_call>c", "<tool_call>"):
        got = one(spark, value, reasoning.split_at_tool_marker("t"))
        assert got.answer + got.tool_buffer == value


def calls(spark, value, tag_mode="fixed"):
    found = one(spark, value, toolcalls.tool_calls("t", tag_mode))
    return [(c.dialect, c.name, json.loads(c.arguments_json)) for c in found]


@pytest.mark.parametrize("body, expected", [
    ('{"name":"f","arguments":null,"input":{"a":1}}', [("json", "f", {"a": 1})]),
    ('{"name":"f","parameters":{"b":[1,null]}}', [("json", "f", {"b": [1, None]})]),
    ('{"name":"f"}', [("json", "f", {})]),
    ('{"name":"f","arguments":"text"}', [("json", "f", "text")]),
    ('{"arguments":{}}', []), ('{"name":""}', []), ('{"name":null}', []), ('{"name":0}', []),
    ('{"name": "x", ', []), ('{"name":"f"} more', []),
    ("\n<tool_result>\n{\"name\":\"f\"}\n</tool_result>\n", [("json", "f", {})]),
    ("<name> f </name><param name=\"a\">1</param><param key=\"b\">x</param><param>lost</param>",
     [("name", "f", {"a": 1, "b": "x"})]),
    ("<name=f\n><param name=\"a\" key=\"z\">1</param>", [("name", "f", {"a": 1})]),
    ("<name> </name>", []),
    ("<tool_name>g</tool_name><arguments><arg_key>k</arg_key>\n <arg_value>1</arg_value>"
     "<arg_key>k</arg_key><arg_value>2</arg_value></arguments>", [("tool_name", "g", {"k": 2})]),
    ("<function=f><parameter=k>v", [("function", "f", {"k": "v"})]),
    ("<function=f>\n<parameter=k>\nv\n</function>", [("function", "f", {"k": "v"})]),
    ("<function=f><parameter=a>1</parameter><parameter=b>x y</parameter></function>",
     [("function", "f", {"a": 1, "b": "x y"})]),
    ("plain words", []),
])
def test_dialects(spark, body, expected):
    assert calls(spark, f"text <tool_call>{body}</tool_call> after") == expected


def test_tag_dialect(spark):
    closed = "<tool_call><read><path>/a/1</path><limit>5</limit></read></tool_call>"
    assert calls(spark, closed) == [("tag", "read", {"path": "/a/1", "limit": 5})]
    assert calls(spark, closed, "compat") == [("tag", "read", {})]
    open_ = "<tool_call><read><path>/a/1</path></tool_call>"
    assert calls(spark, open_) == calls(spark, open_, "compat") == [("tag", "read", {"path": "/a/1"})]


def test_invoke_dialect(spark):
    block = (
        '<function_calls><invoke name="a"><parameter name="x">1</parameter></invoke>'
        '<invoke name="b"></invoke></function_calls>'
    )
    assert calls(spark, block + block) == [("invoke", "a", {"x": 1}), ("invoke", "b", {})] * 2
    assert calls(spark, block + '<tool_call>{"name":"f"}</tool_call>') == [("json", "f", {})]
    assert calls(spark, block + "<tool_call>") == []


def test_failed_blocks_do_not_count(spark):
    value = '<tool_call>{bad</tool_call><tool_call>{"name":"f"}</tool_call>'
    rows = spark.createDataFrame([(7, value), (8, "<tool_call>{bad</tool_call>"), (9, "fine")], "response_id long, text string")
    found = responses.extract_tool_calls(rows).collect()
    assert [(r.response_id, r.ord, r.name) for r in found] == [(7, 0, "f")]
    flags = {r.response_id: r.tool_parse_failed for r in responses.with_tool_calls(rows).collect()}
    assert flags == {7: False, 8: True, 9: False}


def test_scan_skips_reasoning(spark):
    value = '<think><tool_call>{"name":"f"}</tool_call></think>done'
    rows = spark.createDataFrame([(1, value)], "response_id long, text string")
    assert responses.extract_tool_calls(rows, scan="answer").count() == 0
    assert responses.extract_tool_calls(rows, scan="all").count() == 1


def test_outcome_classes(spark):
    codes = [400, 401, 403, 451, 461, 429, 503, 500]
    rows = spark.createDataFrame([(c,) for c in codes], "s int")
    kinds = [r.k for r in rows.select(outcomes.outcome_type("s").alias("k")).collect()]
    assert kinds == [
        "bad_request", "auth", "auth", "banned_temporary", "banned_permanent", "rate_limit", "server_error", "unknown"
    ]
    statuses = [r.k for r in rows.select(outcomes.client_status(outcomes.outcome_type("s")).alias("k")).collect()]
    assert statuses == [502, 401, 401, 403, 403, 429, 502, 502]


@pytest.mark.parametrize("definition, line", [
    ('{"type":"function","function":{"name":"f","description":"short","parameters":'
     '{"properties":{"a":{"type":"string"},"b":{}},"required":["a"]}}}', "- f(a*:string, b:any): short"),
    ('{"name":"g","description":"' + "x" * 130 + '\\nsecond","input_schema":{"properties":{"n":{"type":"integer"}}}}',
     "- g(n:integer): " + "x" * 120),
    ('{"name":"h"}', "- h(): "),
    ('{"name":"h","input_schema":{"properties":{"z":{"type":["string","null"]},"a":{"type":"x"}}}}',
     "- h(z:string,null, a:x): "),
])
def test_tool_line(spark, definition, line):
    assert one(spark, definition, tooldefs.tool_line("t")) == line


@pytest.mark.parametrize("value, masked, sid, user, command", [
    ('curl -b "sid=tok1; userId=7" x', 'curl -b "sid=***; userId=***" x', 1, 1, True),
    ("curl -H Cookie: sid='t'; userId=12", "curl -H Cookie: sid='***'; userId=***", 1, 1, True),
    ("--cookie 'a=b' sid=x sid=y", "--cookie 'a=***' sid=*** sid=***", 2, 0, True),
    ("userId=abc and sids=1", "userId=abc and sids=1", 0, 0, False),
])
def test_redaction(spark, value, masked, sid, user, command):
    row = redact.redact_credentials(spark.createDataFrame([(value,)], "text string")).first()
    assert (row.text, row.sid_hits, row.userId_hits, row.has_command) == (masked, sid, user, command)


@pytest.mark.parametrize("value, masked, pairs", [
    ("curl -b 'serviceToken=SECRET1; userId=42; other_ph=SECRET2' -d a=b", "curl -b 'serviceToken=***; userId=***; other_ph=***' -d a=b", 3),
    ('curl --cookie="a=SECRET; b=SECRET" x=1', 'curl --cookie="a=***; b=***" x=1', 2),
    ('curl -H "cookie: a=SECRET==; b=\'SECRET\'" --data k=v', 'curl -H "cookie: a=***; b=\'***\'" --data k=v', 2),
    ("GET /\nCookie: q=SECRET SECRET; r=SECRET\nHost: a=b", "GET /\nCookie: q=***; r=***\nHost: a=b", 2),
    ("curl -b a=SECRET -b b=SECRET", "curl -b a=*** -b b=***", 2),
    ("no-b x=1 and --cookies y=2, cookie: z", "no-b x=1 and --cookies y=2, cookie: z", 0),
    ("curl -b 'open=SECRET; p=SECRET", "curl -b 'open=***; p=***", 2),
    ("curl -b $'a=SECRET; serviceToken=SECRET\\u0021'", "curl -b $'a=***; serviceToken=***'", 2),
    ("curl -H $'cookie: a=SECRET\\'SECRET; b=SECRET' -d x=y", "curl -H $'cookie: a=***; b=***' -d x=y", 2),
    ("curl -b'serviceToken=SECRET' -X GET", "curl -b'serviceToken=***' -X GET", 1),
    ("curl -bserviceToken=SECRET;ls x=y", "curl -bserviceToken=***;ls x=y", 1),
    ("curl -sb 'serviceToken=SECRET' k=v", "curl -sb 'serviceToken=***' k=v", 1),
    ("curl -b \\\n'serviceToken=SECRET' \\\n -d k=v", "curl -b \\\n'serviceToken=***' \\\n -d k=v", 1),
    ('curl -H "cOOkie: serviceToken=SECRET"', 'curl -H "cOOkie: serviceToken=***"', 1),
    ('curl -b "a=1\\"; serviceToken=SECRET" -d k=v', 'curl -b "a=***; serviceToken=***" -d k=v', 2),
    ('curl -b "a=\\"SECRET;SECRET\\"; b=SECRET" k=v', 'curl -b "a=***\\"; b=***" k=v', 2),
    ("curl -b 'a=SECRET'\"SECRET; b=SECRET\"SECRET k=v", "curl -b 'a=***; b=*** k=v", 2),
    ("curl -sSLH 'Cookie: a=SECRET' --header='COOKIE : b=SECRET' -H 'x: y=1'", "curl -sSLH 'Cookie: a=***' --header='COOKIE : b=***' -H 'x: y=1'", 2),
    ("curl --cookie \\\r\n  a=SECRET\\ SECRET k=v", "curl --cookie \\\r\n  a=*** k=v", 1),
    ("a well-known bob -about x=1, state-b, 2-b y=3", "a well-known bob -about x=1, state-b, 2-b y=3", 0),
])
def test_every_cookie_pair_is_masked(spark, value, masked, pairs):
    row = redact.redact_credentials(spark.createDataFrame([(value,)], "text string"), fields={}).first()
    assert (row.text, row.cookie_hits, row.has_command) == (masked, pairs, pairs > 0)


def test_no_secret_leaves_a_random_command(spark):
    """Cookies with values told apart from all else, in every way to write a word."""
    rng, rows = random.Random(11), []
    odd = ["'", '"', "\\", "!", " ", "$", "=", ",", "é", "-b "]

    def quoted(text):
        kind = rng.randrange(4)
        if kind == 0:
            return "'" + text.replace("'", "'\\''") + "'"
        if kind == 1:
            return '"' + re.sub(r'(["\\\\$])', r"\\\1", text) + '"'
        if kind == 2:
            return "$'" + re.sub(r"(['\\\\])", r"\\\1", text) + "'"
        return re.sub(r"([^A-Za-z0-9_=])", r"\\\1", text)

    for _ in range(400):
        cookie = "; ".join(f"n{i}=SECRET{''.join(rng.choice(odd) for _ in range(rng.randrange(3)))}SECRET" for i in range(rng.randrange(1, 4)))
        gap = rng.choice([" ", "  ", " \\\n ", "="])
        form = rng.randrange(4)
        if form == 0:
            word = rng.choice(["-b", "--cookie"]) + gap + quoted(cookie)
        elif form == 1:
            word = "-b" + quoted(cookie)
        elif form == 2:
            word = rng.choice(["-sb", "-kLb"]) + gap.replace("=", " ") + quoted(cookie)
        else:
            name = rng.choice(["cookie: ", "Cookie:", "COOKIE: "])
            body = name + cookie
            word = rng.choice(["-H", "--header"]) + gap + rng.choice(["'" + body.replace("'", "'\\''") + "'", "$'" + re.sub(r"(['\\\\])", r"\\\1", body) + "'"])
        rows.append((f"curl {word} -X GET 'https://h/p?q=kept'",))
    out = redact.redact_credentials(spark.createDataFrame(rows, "text string")).collect()
    leaks = [(a[0], r.text) for a, r in zip(rows, out) if "SECRET" in r.text or not r.has_command]
    assert not leaks, leaks[:3]


def test_redaction_of_null(spark):
    row = redact.redact_credentials(spark.createDataFrame([(None,)], "text string")).first()
    assert row.text is None
