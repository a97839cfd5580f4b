"""Formatting is undone by the parser, whatever the texts hold."""

import hashlib
import random

from chatlog.llm import chatformat

PARTS = ["[INST] ", " [/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE:", "]", "[/ROLE]", "\\", "\\b", "\\l", "\\a", "\\r", "\n", " ", "é", "🙂", "ok", "[", "<"]


def fixture():
    rng = random.Random(6)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            text = "".join(rng.choices(PARTS, k=rng.randrange(0, 9))) if conv % 3 else "plain text, nothing else"
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "a]b\\[", "", None]), rng.choice([text, text, text, None])))
    rows += [(70, 0, "user", "x"), (70, 0, "user", "x"), (70, 0, "assistant", "y"), (70, None, "system", "first"), (None, 1, "user", "no id"), (71, 0, "assistant", "z" * 300000)]
    rows += [(72, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(500)]
    return rows


def turns_of(rows, conv):
    own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
    return [(r, x) for _, r, x in sorted(own, key=lambda y: (y[0] is not None, y[0] or 0, y[1].encode(), y[2].encode()))]


def test_round_trip(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' AS _id", "1 AS formatted", "2 AS _turns")
    chats = chatformat.format_chats(df)
    done = {r["conv_id"]: r for r in chats.collect()}
    read = {r["conv_id"]: r for r in chatformat.read_back(chats).collect()}
    assert set(done) == {r[0] for r in rows} and all(r["round_trips"] for r in done.values())
    for conv in done:
        turns = turns_of(rows, conv)
        loss = "".join(x for r, x in turns if r == "assistant")
        r = read[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(done[conv]["formatted"])
    assert all(r["n_escaped"] == 0 for c, r in done.items() if c in (0, 3, 72)) and sum(r["n_escaped"] for r in done.values()) > 30


def test_foreign_marks_alone_need_no_escape(spark):
    df = spark.createDataFrame([(1, 0, "user", "</s> is fine here"), (1, 1, "assistant", "[INST] too")], "conv_id bigint, turn bigint, role string, text string")
    row = chatformat.format_chats(df).first()
    assert (row["n_escaped"], row["formatted"]) == (0, "[INST] </s> is fine here [/INST]<s>[INST] too</s>")
    assert [tuple(s) for s in row["loss_spans"]] == [(35, 45)]


def test_text_outside_the_grammar(spark):
    df = spark.createDataFrame([("junk",), ("[INST] a [/INST]x",), ("",)], "t string")
    assert [r[0] for r in df.select(chatformat.parse(df["t"])).collect()] == [None, None, []]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chatformat.read_back(chatformat.format_chats(df)).count() == 0
