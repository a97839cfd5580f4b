"""Prompts rendered from conversations (conv_id, turn, role, text).

`turn` is the 0-based position of a message in its conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chatlog import fixed
from chatlog.operators.scan import block_scan, ordered_concat
from chatlog.operators.skew import salted_join
from chatlog.session import settled



def last_n_messages(conv: DataFrame, n: int = fixed.MAX_REPLAY_MESSAGES) -> DataFrame:
    """All system messages and the last `n` others (`from_end` = 1 for the last).

    Spark limits each group before the shuffle, so a conversation of any length
    sends at most `n` rows per map task.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    rest = conv.filter("role <> 'system'").withColumn("from_end", F.row_number().over(newest))
    rest = rest.filter(F.col("from_end") <= n)
    system = conv.filter("role = 'system'").withColumn("from_end", F.lit(None).cast("int"))
    return rest.unionByName(system)


def last_user_message(conv: DataFrame) -> DataFrame:
    """Text of the last user message, '' without one."""
    text = F.max_by("text", F.when(F.col("role") == "user", F.col("turn")))
    return conv.groupBy("conv_id").agg(F.coalesce(text, F.lit("")).alias("last_user"))


def last_message(conv: DataFrame) -> DataFrame:
    """Role and text of the last message that is not a system message."""
    at = F.when(F.col("role") != "system", F.col("turn"))
    return conv.groupBy("conv_id").agg(
        F.max_by("role", at).alias("last_role"), F.max_by("text", at).alias("last_text")
    )


def first_system_message(conv: DataFrame) -> DataFrame:
    """Text of the first system message, '' without one."""
    text = F.min_by("text", F.when(F.col("role") == "system", F.col("turn")))
    return conv.groupBy("conv_id").agg(F.coalesce(text, F.lit("")).alias("system_prompt"))


def system_text(conv: DataFrame) -> DataFrame:
    """System messages of each conversation that has any, joined by newlines."""
    return ordered_concat(
        conv.filter("role = 'system'"), ["conv_id"], "turn", {"system_text": "text"}, sep="\n"
    )


def _section(label: str, body: Column) -> Column:
    return F.concat(F.lit(label + "\n"), body)


def render_transcript(
    conv: DataFrame,
    n: int = fixed.MAX_REPLAY_MESSAGES,
    max_chars: int = fixed.MAX_PROMPT_CHARS,
    system_label: str = fixed.SYSTEM_LABEL,
    history_label: str = fixed.HISTORY_LABEL,
    current_label: str = fixed.CURRENT_LABEL,
) -> DataFrame:
    """(conv_id, prompt): system, history and current sections.

    The system section stays whole; history and current together lose their front
    where they exceed what is left of `max_chars`.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    recent = conv.filter("role <> 'system'").withColumn("from_end", F.row_number().over(newest))
    recent = recent.filter(F.col("from_end") <= n).withColumn("line", F.concat_ws(": ", "role", "text"))
    dialog = recent.groupBy("conv_id").agg(
        F.expr("listagg(line, '\\n') within group (order by turn) filter (where from_end > 1)").alias("history"),
        F.max(F.when(F.col("from_end") == 1, F.col("text"))).alias("current"),
    )
    both = dialog.join(system_text(conv), "conv_id", "full_outer")
    sys = F.when(F.col("system_text") != "", _section(system_label, F.col("system_text")))
    rest = F.concat_ws(
        "\n\n", _section(history_label, F.col("history")), _section(current_label, F.col("current"))
    )
    both = both.select("conv_id", sys.alias("sys"), rest.alias("rest"))
    room = F.lit(max_chars) - F.length(F.coalesce("sys", F.lit(""))) - 2
    cut = F.when((room > 0) & (F.length("rest") > room), F.right("rest", room)).otherwise(F.col("rest"))
    prompt = F.when(F.col("sys").isNotNull(), F.concat("sys", F.lit("\n\n"), cut)).otherwise(cut)
    return both.select("conv_id", prompt.alias("prompt"))


def render_incremental(
    conv: DataFrame,
    system_label: str = fixed.SYSTEM_LABEL,
    current_label: str = fixed.CURRENT_LABEL,
) -> DataFrame:
    """(conv_id, prompt): the last user text, under the system section if there is one."""
    both = last_user_message(conv).join(system_text(conv), "conv_id", "left")
    framed = F.concat(
        _section(system_label, F.col("system_text")), F.lit("\n\n"), _section(current_label, F.col("last_user"))
    )
    return both.select("conv_id", F.coalesce(framed, F.col("last_user")).alias("prompt"))


def inject_tool_catalog(conv: DataFrame, catalog: str | DataFrame) -> DataFrame:
    """Append the catalog to the first system message, or put a system message at turn -1.

    `catalog` is one text, or a DataFrame (conv_id, catalog). Messages are matched on
    (conv_id, turn), so a long conversation is not gathered.
    """
    first = conv.groupBy("conv_id").agg(F.min(F.when(F.col("role") == "system", F.col("turn"))).alias("turn"))
    first = first.withColumn("_catalog", F.lit(catalog)) if isinstance(catalog, str) else first.join(
        catalog.select("conv_id", F.col("catalog").alias("_catalog")), "conv_id"
    )
    touched = conv.join(first.filter("turn is not null"), ["conv_id", "turn"], "left")
    text = F.when(F.col("_catalog").isNotNull(), F.concat_ws("\n\n", "text", "_catalog")).otherwise(F.col("text"))
    touched = touched.withColumn("text", text).select("conv_id", "turn", "role", "text")
    added = first.filter("turn is null").select(
        "conv_id", F.lit(-1).cast("bigint").alias("turn"), F.lit("system").alias("role"),
        F.col("_catalog").alias("text"),
    )
    return touched.unionByName(added)


def replay_lengths(
    conv: DataFrame,
    n: int = fixed.MAX_REPLAY_MESSAGES,
    max_chars: int = fixed.MAX_PROMPT_CHARS,
    system_label: str = fixed.SYSTEM_LABEL,
    history_label: str = fixed.HISTORY_LABEL,
    current_label: str = fixed.CURRENT_LABEL,
) -> DataFrame:
    """Per user turn: lengths of the full and of the incremental prompt up to that turn.

    Only lengths are moved, never the prompts: running sums give the size of the last
    `n` messages as a difference to the message `n` back, found by an equi-join.
    """
    is_sys = F.col("role") == "system"
    line = F.length("role") + 2 + F.length("text")
    sized = conv.select(
        "conv_id", "turn", "role", is_sys.alias("is_sys"), F.length("text").alias("chars"), line.alias("line")
    )
    def count_of(flag, size):
        return F.when(flag, size).otherwise(0)

    run = block_scan(
        sized, ["conv_id"], ["turn"],
        sums={
            "sys_count": count_of(F.col("is_sys"), F.lit(1)),
            "sys_chars": count_of(F.col("is_sys"), F.col("chars")),
            "seen": count_of(~F.col("is_sys"), F.lit(1)),
            "lines": count_of(~F.col("is_sys"), F.col("line") + 1),
        },
    )
    run = settled(run)
    users = run.filter("role = 'user'").withColumn("oldest", F.greatest(F.col("seen") - n, F.lit(0)))
    before = run.filter("role <> 'system'").select(
        "conv_id", F.col("seen").alias("oldest"), F.col("lines").alias("lines_before")
    )
    users = users.join(before, ["conv_id", "oldest"], "left")
    # System text: the messages plus a newline between two of them.
    sys_text = F.col("sys_chars") + F.greatest(F.col("sys_count") - 1, F.lit(0))
    sys = F.when(sys_text > 0, sys_text + len(system_label) + 1).otherwise(0)
    window = F.col("lines") - F.coalesce("lines_before", F.lit(0))
    own = F.col("line") + 1
    history = F.when(window > own, len(history_label) + 1 + (window - own - 1) + 2).otherwise(0)
    current = len(current_label) + 1 + F.col("chars")
    rest = history + current
    room = max_chars - sys - 2
    full = F.when(sys > 0, sys + 2).otherwise(0) + F.when((room > 0) & (rest > room), room).otherwise(rest)
    small = F.when(
        F.col("sys_count") > 0, sys_text + len(system_label) + 1 + 2 + current
    ).otherwise(F.col("chars"))
    return users.select(
        "conv_id", "turn", full.cast("bigint").alias("full_chars"), small.cast("bigint").alias("incremental_chars")
    )


def replay_savings(
    conv: DataFrame,
    continued: DataFrame | None = None,
    has_tools: Column | None = None,
    **options,
) -> DataFrame:
    """Per conversation: characters sent with full replay, sent as chosen, and saved.

    `continued` (conv_id, turn, reused) says which requests reuse their session; by
    default all but a conversation's first do. A request whose conversation
    `has_tools` is replayed in full always.
    """
    sizes = replay_lengths(conv, **options)
    if continued is None:
        first = conv.filter("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("_first"))
        sizes = salted_join(sizes, first, ["conv_id"], spread_by="turn", how="inner", among=conv)
        sizes = sizes.withColumn("reused", F.col("turn") > F.col("_first"))
    else:
        sizes = sizes.join(continued.select("conv_id", "turn", "reused"), ["conv_id", "turn"])
    short = F.col("reused") if has_tools is None else F.col("reused") & ~has_tools
    sent = F.when(short, F.col("incremental_chars")).otherwise(F.col("full_chars"))
    return sizes.groupBy("conv_id").agg(
        F.count("*").alias("requests"),
        F.sum("full_chars").alias("replay_chars"),
        F.sum(sent).alias("sent_chars"),
        (F.sum("full_chars") - F.sum(sent)).alias("saved_chars"),
    )
