"""Chat formatting that is checked by parsing it back.

A conversation is rendered as text, the text is parsed by a fixed grammar, and the recovered
turns are compared with the source. Turns that do not come back as they were are escaped, and
the whole is parsed and compared again. Escaping leaves no character that could begin a mark,
so one round settles every text; `round_trips` states the last comparison.

    conversation = turn*
    turn = "[INST] " text " [/INST]" | "<s>" text "</s>" | "<<SYS>>" text "<</SYS>>" | "[ROLE:" name "]" text "[/ROLE]"

Inside texts and names a backslash begins a pair: \\b is a backslash, \\l a [, \\a a <, \\r a ].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog.llm.common import indices, let, sums_before

MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE:", "]", "[/ROLE]")
PAIRS = [("\\", "\\b"), ("[", "\\l"), ("<", "\\a"), ("]", "\\r")]
TURN = r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>|<<SYS>>.*?<</SYS>>|\[ROLE:[^\]]*\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    for plain, pair in PAIRS:
        text = F.replace(text, F.lit(plain), F.lit(pair))
    return text


def unescape(text: Column) -> Column:
    for plain, pair in reversed(PAIRS):
        text = F.replace(text, F.lit(pair), F.lit(plain))
    return text


def _by_role(role: Column, known: dict, other: Column) -> Column:
    out = F.lit(None)
    for name, value in known.items():
        out = F.when(role == name, F.lit(value)) if name == "user" else out.when(role == name, F.lit(value))
    return out.otherwise(other)


def _opening(role: Column) -> Column:
    named = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    return _by_role(role, {r: m[0] for r, m in MARKS.items()}, named)


def _closing(role: Column) -> Column:
    return _by_role(role, {r: m[1] for r, m in MARKS.items()}, F.lit(OTHER[2]))


def _piece(role: Column, body: Column) -> Column:
    return F.concat(_opening(role), body, _closing(role))


def _turn_of(piece: Column) -> Column:
    """(role, text) of one parsed piece."""
    inner = lambda o, c: F.substring(piece, F.lit(len(o) + 1), F.length(piece) - len(o) - len(c))
    made = lambda role, body: F.struct(role.alias("role"), unescape(body).alias("text"))
    name_end = F.instr(piece, OTHER[1])
    out = None
    for role, (o, c) in MARKS.items():
        this = made(F.lit(role), inner(o, c))
        out = F.when(F.startswith(piece, F.lit(o)), this) if out is None else out.when(F.startswith(piece, F.lit(o)), this)
    return out.otherwise(made(
        unescape(F.substring(piece, F.lit(len(OTHER[0]) + 1), name_end - len(OTHER[0]) - 1)),
        F.substring(piece, name_end + 1, F.length(piece) - name_end - len(OTHER[2]))))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted text; null if the text is not of the grammar."""
    pieces = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))
    return let(pieces, lambda p: F.when(F.array_join(p, "") == formatted, F.transform(p, _turn_of)))


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: id, formatted, loss_spans, n_escaped, round_trips.

    Turns go by `turn` (null first), ties by role, then text; a repeated row is a turn of its
    own. Null role and text are empty. loss_spans are the (start, end) in code points of the
    assistant bodies within `formatted`, end exclusive. All rows of one conversation meet in
    one row, as its formatted text is one value.
    """
    rows = rows.select(
        F.col(conv_id).alias("_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chats = rows.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_t"))
    chats = chats.select("_id", F.transform("_t", lambda x: F.struct(x["role"], x["text"])).alias("_turns"))
    raw = F.array_join(F.transform("_turns", lambda x: _piece(x["role"], x["text"])), "")
    chats = chats.withColumn("_raw", raw)
    chats = chats.withColumn("_plain", F.coalesce(parse(F.col("_raw")) == F.col("_turns"), F.lit(False)))
    alone = lambda x: F.coalesce(parse(_piece(x["role"], x["text"])) == F.array(x), F.lit(False))
    body = F.transform("_turns", lambda x: F.when(F.col("_plain") | alone(x), x["text"]).otherwise(escape(x["text"])))
    chats = chats.withColumn("_bodies", body)
    chats = chats.withColumn("formatted", F.when(F.col("_plain"), F.col("_raw")).otherwise(F.array_join(
        F.transform("_turns", lambda x, i: _piece(x["role"], F.get("_bodies", i))), "")))
    lengths = F.transform("_turns", lambda x, i: (F.length(_opening(x["role"])) + F.length(F.get("_bodies", i)) + F.length(_closing(x["role"]))).cast("bigint"))
    spans = let(sums_before(lengths), lambda at: F.filter(F.transform(indices(F.size("_turns")), lambda i: let(
        F.get("_turns", i)["role"], lambda r: F.when(r == "assistant", F.struct(
            (F.get(at, i) + F.length(_opening(r))).alias("start"),
            (F.get(at, i) + F.length(_opening(r)) + F.length(F.get("_bodies", i))).alias("end"))))), lambda s: s.isNotNull()))
    changed = F.filter("_turns", lambda x, i: x["text"] != F.get("_bodies", i))
    return chats.select(
        F.col("_id").alias(conv_id), "formatted", spans.alias("loss_spans"), F.size(changed).alias("n_escaped"),
        F.when(F.col("_plain"), F.lit(True)).otherwise(F.coalesce(parse(F.col("formatted")) == F.col("_turns"), F.lit(False))).alias("round_trips"))


def read_back(chats: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """What the formatted text and its loss spans say, by the parser alone.

    The text under a span is the body of the piece that begins where the span says; a span that
    fits no piece gives null digests.
    """
    pieces = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0))
    df = chats.select(F.col(conv_id), "formatted", "loss_spans", pieces.alias("_p"))
    df = df.withColumn("_t", F.transform("_p", _turn_of))
    lengths = F.transform("_p", lambda p: F.length(p).cast("bigint"))
    places = let(sums_before(lengths), lambda at: F.filter(
        F.transform("_t", lambda t, i: F.when(t["role"] == "assistant", F.struct(
            (F.get(at, i) + F.lit(len(MARKS["assistant"][0]))).alias("start"),
            (F.get(at, i) + F.length(F.get("_p", i)) - F.lit(len(MARKS["assistant"][1]))).alias("end"), t["text"].alias("text")))),
        lambda x: x.isNotNull()))
    df = df.withColumn("_m", places)
    same = F.transform("_m", lambda x: F.struct(x["start"], x["end"])) == F.col("loss_spans")
    learnt = F.when(same, F.array_join(F.transform("_m", lambda x: x["text"]), ""))
    turns = F.array_join(F.transform("_t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    df = df.select(conv_id, "formatted", F.size("_t").cast("bigint").alias("n_turns"), turns.alias("_all"), learnt.alias("_loss"))
    return df.select(
        conv_id, "n_turns", F.sha2("_all", 256).alias("turns_sha256"), F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))
